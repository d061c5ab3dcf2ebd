"""Operators on small frames."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from jobtide import functions as fn
from jobtide import operators as op
from jobtide.operators.market import broadcast_threshold
from jobtide.schema import RAW, TARGET
from jobtide.sources import from_rows

DAY = dt.date(2024, 1, 1)
NOON = dt.datetime(2024, 1, 1, 12)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def stored(spark, *postings):
    base = {"title": "t", "published_date": DAY, "processed_at": NOON}
    return from_rows(spark, [{**base, **p} for p in postings], nullable(TARGET))


def nullable(schema):
    copy = type(schema).fromJson(schema.jsonValue())
    for field in copy.fields:
        field.nullable = True
    return copy


def test_normalize(spark):
    raw = from_rows(
        spark,
        [
            {
                "id": "1",
                "name": "Инженер",
                "area": ("Москва",),
                "salary": (100, 200, "RUR"),
                "description": "<b>x</b>",
                "key_skills": [("Docker",)],
                "published_at": "2024-01-15T23:30:00-0800",
            },
            {"id": "2"},
            {"name": "no id"},
        ],
        RAW,
    )
    result = op.normalize(raw, F.lit(NOON))
    assert result.columns == TARGET.names
    assert [f.dataType for f in result.schema] == [f.dataType for f in TARGET]
    assert rows(result) == [
        ("1", "Инженер", "Москва", 150, "x", ["Docker"], dt.date(2024, 1, 15), NOON),
        ("2", None, None, None, None, [], None, NOON),
    ]


def test_validation(spark):
    df = stored(
        spark,
        {"vacancy_id": "ok", "city": "ж" * 100},
        {"vacancy_id": "x" * 50},
        {"vacancy_id": "x" * 51, "city": "c" * 101},
        {"vacancy_id": None},
        {"vacancy_id": "t", "title": None},
    )
    valid, rejected = op.validate_target(df)
    assert rows(valid, "vacancy_id") == [("ok",), ("x" * 50,)]
    assert rows(rejected, "vacancy_id", "reject_reasons") == sorted(
        [
            ("x" * 51, ["id too long", "city too long"]),
            (None, ["id missing"]),
            ("t", ["title missing"]),
        ],
        key=repr,
    )


def test_clean_keeps_the_newest_valid_row(spark):
    df = stored(
        spark,
        {"vacancy_id": "1", "salary_rub": 1},
        {"vacancy_id": "1", "salary_rub": 2, "published_date": dt.date(2024, 2, 1)},
        {"vacancy_id": "1", "title": None, "published_date": dt.date(2024, 3, 1)},
        {"vacancy_id": "2", "published_date": None},
        {"vacancy_id": "2", "salary_rub": 7},
        {"vacancy_id": "2", "salary_rub": 7},
    )
    assert rows(op.clean(df), "vacancy_id", "salary_rub") == [("1", 2), ("2", 7)]


def test_delete_where(spark):
    ids = ["testA1", "test_1", "xtest_y", None, "v_1"]
    df = stored(spark, *[{"vacancy_id": i} for i in ids])
    assert rows(op.delete_where(df), "vacancy_id") == [("testA1",), ("v_1",)]


def test_update_where(spark):
    df = stored(
        spark,
        {"vacancy_id": "test_123456", "salary_rub": 150000},
        {"vacancy_id": "2", "salary_rub": 5},
        {"vacancy_id": None, "salary_rub": 6},
    )
    hit = F.col("vacancy_id") == "test_123456"
    changed = op.update_where(df, hit, {"salary_rub": 200000, "title": F.upper("title")})
    assert changed.schema == df.schema
    assert rows(changed, "vacancy_id", "salary_rub", "title") == sorted(
        [("test_123456", 200000, "T"), ("2", 5, "t"), (None, 6, "t")], key=repr
    )
    assert rows(df, "salary_rub") == [(150000,), (5,), (6,)]


def test_update_where_assignments_see_the_old_row(spark):
    df = stored(spark, {"vacancy_id": "1", "salary_rub": 1, "title": "a", "city": "b"})
    swapped = op.update_where(df, F.lit(True), {"title": F.col("city"), "city": F.col("title")})
    assert rows(swapped, "title", "city") == [("b", "a")]


def test_read_limit_and_cap_are_deterministic(spark):
    df = stored(
        spark,
        *[{"vacancy_id": f"{i:02d}", "published_date": DAY} for i in range(20)],
        {"vacancy_id": "late", "published_date": dt.date(2025, 1, 1)},
        {"vacancy_id": "none", "published_date": None},
    )
    shuffled = df.repartition(7, "title")
    assert [r[0] for r in op.read_limit(shuffled, 3).select("vacancy_id").collect()] == [
        "00",
        "01",
        "02",
    ]
    assert [r[0] for r in op.cap(shuffled, 3).select("vacancy_id").collect()] == [
        "late",
        "00",
        "01",
    ]


def simple(spark, *triples):
    return spark.createDataFrame(list(triples), "id string, title string, salary int")


TARGET_ROWS = [("1", "a", 10), ("2", "b", 20), ("3", "c", 30)]


def test_upsert_replaces_whole_rows(spark):
    batch = simple(spark, ("2", "B", None), ("4", "d", 4))
    merged = op.upsert(simple(spark, *TARGET_ROWS), batch, "id")
    expected = [("1", "a", 10), ("2", "B", None), ("3", "c", 30), ("4", "d", 4)]
    assert rows(merged) == expected
    assert rows(op.upsert(merged, batch, "id")) == expected


def test_upsert_with_duplicates(spark):
    target = simple(spark, *TARGET_ROWS)
    batch = simple(spark, ("2", "x", 1), ("2", "y", 2))
    with pytest.raises(PySparkException, match="duplicate key: 2"):
        op.upsert(target, batch, "id").collect()
    with pytest.raises(PySparkException, match="duplicate key"):
        op.upsert(target, batch, "id").count()
    latest = op.upsert(target, batch, "id", "latest", [F.desc("salary")])
    assert rows(latest) == [("1", "a", 10), ("2", "y", 2), ("3", "c", 30)]
    with pytest.raises(ValueError, match="needs an order"):
        op.upsert(target, batch, "id", "latest")
    with pytest.raises(ValueError, match="on_duplicate"):
        op.upsert(target, batch, "id", "first")


@pytest.mark.parametrize("seed", range(3))
def test_upserts_equal_a_dict(spark, seed):
    rng = random.Random(seed)
    model, table = {}, simple(spark, *TARGET_ROWS).where("false")
    for _ in range(4):
        batch = [
            (str(rng.randrange(30)), rng.choice(["a", "b", None]), rng.choice([None, i]))
            for i in range(rng.randrange(1, 25))
        ]
        numbered = [(*row, place) for place, row in enumerate(batch)]
        df = spark.createDataFrame(numbered, "id string, title string, salary int, place int")
        table = op.upsert(table, df, "id", "latest", [F.desc("place")])
        model |= {row[0]: row for row in batch}
    assert rows(table) == sorted(model.values(), key=repr)


def test_upsert_matches_columns_by_name(spark):
    batch = simple(spark, ("2", "B", 7)).select("salary", "id", "title")
    assert rows(op.upsert(simple(spark, ("2", "b", 1)), batch, "id")) == [("2", "B", 7)]


def test_append_new(spark):
    target = simple(spark, *TARGET_ROWS)
    assert op.append_new(target, simple(spark, ("4", "d", 4)), "id").count() == 4
    with pytest.raises(ValueError, match="'2'"):
        op.append_new(target, simple(spark, ("2", "d", 4)), "id")
    with pytest.raises(ValueError, match="'5'"):
        op.append_new(target, simple(spark, ("5", "d", 4), ("5", "e", 4)), "id")


def test_rate_join_equals_the_map(spark):
    raw = from_rows(
        spark,
        [
            {"id": str(i), "salary": (low, None, currency)}
            for i, (low, currency) in enumerate(
                [(100, "usd"), (100, None), (99, "KZT"), (5, "GBP"), (7, "Eur")]
            )
        ]
        + [{"id": "none"}],
        RAW,
    )
    by_map = op.normalize(raw, F.lit(NOON)).select("vacancy_id", "salary_rub")
    by_table = op.rate_join(raw, op.rates_table(spark)).select("id", "salary_rub")
    assert rows(by_table) == rows(by_map)


def test_enrich_gives_one_detail_per_item(spark):
    items = spark.createDataFrame(
        [("1", "a"), ("1", "b"), ("2", "c"), ("3", "d")], "id string, n string"
    )
    details = spark.createDataFrame(
        [("1", "x", 1), ("1", "y", 2), ("2", "z", 3)], "id string, n string, v int"
    )
    assert rows(op.enrich(items, details), "id", "n", "v") == [
        ("1", "y", 2),
        ("1", "y", 2),
        ("2", "z", 3),
    ]
    oldest = op.enrich(items, details, order_by=[F.asc("v")])
    assert rows(oldest, "id", "v") == [("1", 1), ("1", 1), ("2", 3)]
    missing = op.missing_details(items, details)
    assert rows(missing) == [("3", "d")]
    assert op.enrich(items, details).count() + missing.count() == items.count()


def test_missing_details_keeps_items_without_id(spark):
    items = spark.createDataFrame([("1",), (None,)], "id string")
    details = spark.createDataFrame([("1",), (None,)], "id string")
    assert rows(op.missing_details(items, details)) == [(None,)]


def test_collection_rate(spark):
    items = spark.range(3)
    assert rows(op.collection_rate(items, spark.range(2))) == [(3, 2, 66.7)]
    assert rows(op.collection_rate(spark.range(0), spark.range(0))) == [(0, 0, None)]


def test_pages(spark):
    pages = spark.createDataFrame(
        [
            (1, '{"found": 2, "items": [{"id": "a"}, {"id": "b"}]}'),
            (2, '{"found": 2, "items": []}'),
            (3, '{"found": 2}'),
            (4, "no json"),
        ],
        "page int, body string",
    )
    assert rows(op.page_items(pages)) == [(1, '{"id":"a"}'), (1, '{"id":"b"}')]
    arrays = [(1, [1, 1, None]), (2, []), (3, None)]
    lists = spark.createDataFrame(arrays, "p int, items array<int>")
    assert rows(op.explode_items(lists)) == [(1, 1), (1, 1), (1, None)]


def test_union_pages_keeps_duplicates(spark):
    a = spark.createDataFrame([("1", "x")], "id string, n string")
    b = spark.createDataFrame([("1",)], "id string")
    assert rows(op.union_pages(a, b, b)) == sorted([("1", "x"), ("1", None), ("1", None)], key=repr)


def test_published_since_includes_the_boundary(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    df = stored(spark, *[{"vacancy_id": str(d), "published_date": d} for d in [*days, None]])
    as_of = F.lit(dt.date(2024, 1, 3))
    assert op.published_since(df, 1, as_of).count() == 2
    assert op.published_since(df, 100_000, as_of).count() == 3
    for days in (0, -1):
        with pytest.raises(ValueError, match="days_back"):
            op.published_since(df, days, as_of)


def test_cap_takes_any_number(spark):
    df = spark.range(12_000).select(
        F.col("id").cast("string").alias("vacancy_id"), F.current_date().alias("published_date")
    )
    assert op.cap(df, 11_000).count() == 11_000 and op.cap(df, 0).count() == 0
    with pytest.raises(ValueError, match="n must be"):
        op.cap(df, -1)


@pytest.mark.parametrize("policy", ["error", "latest"])
def test_a_null_key_is_refused(spark, policy):
    target = simple(spark, *TARGET_ROWS)
    batch = simple(spark, ("1", "x", 1), (None, "y", 2))
    with pytest.raises(Exception, match="id is null"):
        op.upsert(target, batch, "id", policy, [F.desc("salary")]).collect()


def test_matches_query(spark):
    df = stored(
        spark,
        {"vacancy_id": "1", "title": "Senior DEVOPS"},
        {"vacancy_id": "2", "description": "we do devops"},
        {"vacancy_id": "3", "description": "dev ops"},
    )
    assert rows(op.matches_query(df), "vacancy_id") == [("1",), ("2",)]


def test_daily_stats(spark):
    df = stored(
        spark,
        {"vacancy_id": "1", "salary_rub": 2, "city": "a"},
        {"vacancy_id": "2", "salary_rub": 3, "city": "a"},
        {"vacancy_id": "3", "city": None},
        {"vacancy_id": "4", "published_date": dt.date(2024, 1, 2), "salary_rub": -2, "city": "b"},
        {"vacancy_id": "5", "published_date": dt.date(2024, 1, 2), "salary_rub": -3, "city": "c"},
        {"vacancy_id": "6", "published_date": None},
    )
    assert [tuple(r) for r in op.daily_stats(df).collect()] == [
        (None, 1, None, 0),
        (dt.date(2024, 1, 2), 2, -3, 2),
        (DAY, 3, 3, 1),
    ]


def test_daily_stats_of_large_sums(spark):
    # The float average of these would be 2147483646.5 rounded the wrong way or not at all.
    top = 2**31 - 1
    df = stored(
        spark, *[{"vacancy_id": str(i), "salary_rub": top - i % 2} for i in range(1001)]
    )
    assert op.daily_stats(df).first()["avg_salary"] == top


def test_processing_stats(spark):
    df = stored(spark, {"vacancy_id": "1", "salary_rub": 2}, {"vacancy_id": "2"})
    assert rows(op.processing_stats(df)) == [(2, 1)]
    assert rows(op.processing_stats(df.limit(0))) == [(0, 0)]


def test_market_metrics(spark):
    df = stored(
        spark,
        {"vacancy_id": "1", "salary_rub": 100, "city": "a", "skills": ["Docker", "Docker", "Go"]},
        {"vacancy_id": "2", "salary_rub": 201, "city": "a", "skills": ["Docker"]},
        {"vacancy_id": "3", "city": None, "skills": ["Python"]},
        {"vacancy_id": "4", "city": "b", "skills": [], "published_date": dt.date(2024, 1, 3)},
    )
    assert rows(op.salary_by_skill(df)) == [("Docker", 2, 150.5), ("Python", 1, None)]
    assert rows(op.by_city(df)) == [("a", 2, 50.0), ("b", 1, 25.0), (None, 1, 25.0)]
    assert [tuple(r) for r in op.skill_frequency(df).collect()] == [
        ("Docker", 2),
        ("Go", 1),
        ("Python", 1),
    ]
    assert rows(op.demand_trend(df)) == [
        (DAY, 3, None, 3.0),
        (dt.date(2024, 1, 2), 0, -3, 1.5),
        (dt.date(2024, 1, 3), 1, 1, 1.33),
    ]
    gap = stored(spark, *[{"vacancy_id": str(d), "published_date": dt.date(2024, 1, d)} for d in (1, 20)])
    trend = [tuple(r) for r in op.demand_trend(gap).orderBy("published_date").collect()]
    assert len(trend) == 20 and trend[-1] == (dt.date(2024, 1, 20), 1, 1, 0.14)
    assert op.demand_trend(gap.where("false")).collect() == []
    assert op.count_by_day(df).agg(F.sum("postings")).first()[0] == df.count()


def test_skills_from_vocabulary(spark):
    df = stored(
        spark,
        {"vacancy_id": "1", "description": "Docker docker; DOCKER, Go!"},
        {"vacancy_id": "2", "description": "dockerfile"},
    )
    words = spark.createDataFrame([("Docker",), ("Go",), ("Go",)], "skill string")
    assert rows(op.skills_from_vocabulary(df, words)) == [("1", "Docker"), ("1", "Go")]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_both_vocabulary_forms_agree(spark, data):
    parts = st.sampled_from(["C++", "c", "+", " ", ".net", "CI/CD", "é", "7", "node.js", "machine learning", "-", "\n", "x"])
    text = st.lists(parts, max_size=9).map("".join)
    texts = data.draw(st.lists(text, min_size=1, max_size=8))
    terms = data.draw(st.lists(st.lists(parts, min_size=1, max_size=3).map("".join), min_size=1, max_size=6, unique_by=str.lower))
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    listed = df.select("k", F.explode(fn.detect_skills(F.col("text"), terms)).alias("skill"))
    words = spark.createDataFrame([(t,) for t in terms], "skill string")
    assert rows(op.skills_from_vocabulary(df, words, "text", "k")) == rows(listed)


def test_changes_of_an_upsert(spark):
    schema = "vacancy_id string, title string, skills array<string>, n int"
    target = spark.createDataFrame([("1", "a", ["x"], 1), ("2", None, [], None), ("3", "c", None, 3), ("4", "d", [None], 4)], schema)
    batch = spark.createDataFrame(
        [("1", "a", ["x"], 1), ("2", None, [], 0), ("3", None, ["c"], 3), ("4", "d", [], 4), ("5", None, None, None)], schema
    ).select("n", "skills", "title", "vacancy_id")
    found = op.changes(target, batch)
    assert rows(found, "vacancy_id", "change") == [("1", "unchanged"), ("2", "replaced"), ("3", "replaced"), ("4", "replaced"), ("5", "inserted")]
    assert found.columns == [*batch.columns, "change"]
    assert rows(op.change_counts(found)) == [(1, 3, 1)]
    assert rows(op.change_counts(op.changes(target, batch.where("false")))) == [(0, 0, 0)]
    assert rows(op.change_counts(op.changes(target.where("false"), batch))) == [(5, 0, 0)]
    twice = batch.unionAll(batch.withColumn("n", F.col("n") + 1))
    with pytest.raises(PySparkException, match="duplicate key"):
        op.changes(target, twice).collect()
    latest = op.changes(target, twice, on_duplicate="latest", order_by=[F.desc_nulls_last("n"), "title"])
    assert rows(op.change_counts(latest)) == [(1, 4, 0)]


def test_terms_are_looked_up_by_their_rarest_word(spark):
    """Large vocabularies too: no term is lost where it is joined by a word."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)] + ["++", "#", " "]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(80)]
    terms = sorted({"".join(rng.choice([*words, " "]) + rng.choice([" ", ""]) for _ in range(rng.randrange(1, 4))).strip() or "w1" for _ in range(120)})
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    df = df.unionAll(df.where("k < 5"))  # rows of equal keys
    vocabulary = spark.createDataFrame([(t,) for t in [*terms, "W1 W2", "w1 w2"]], "skill string")
    listed = df.select("k", F.explode(fn.detect_skills(F.col("text"), [*terms, "W1 W2", "w1 w2"])).alias("skill"))
    want = rows(listed)
    assert rows(op.skills_from_vocabulary(df, vocabulary, "text", "k")) == want
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(op.skills_from_vocabulary(df, vocabulary, "text", "k")) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize(("said", "n"), [("-1", -1), ("10MB", 10 << 20), ("2g", 2 << 30), ("77b", 77), ("5", 5)])
def test_broadcast_threshold(said, n):
    class Session:
        conf = {"spark.sql.autoBroadcastJoinThreshold": said}

    assert broadcast_threshold(Session) == n


def test_trend_from_a_first_day(spark):
    df = stored(spark, *[{"vacancy_id": str(i), "published_date": d} for i, d in enumerate([dt.date(1, 1, 1), DAY, DAY, dt.date(2024, 1, 3)])])
    trend = rows(op.demand_trend(df, first_day=dt.date(2023, 1, 1)), "published_date", "postings")
    assert trend == [(DAY, 2), (dt.date(2024, 1, 2), 0), (dt.date(2024, 1, 3), 1)]


def test_computed_once(spark):
    df = spark.range(5).select((F.col("id") * 2).alias("a"), F.lit(None).cast("string").alias("b"))
    once = op.computed_once(df.withColumn("c", F.sqrt("a")))
    assert rows(once) == rows(df.withColumn("c", F.sqrt("a")))
    plan = once.where("c > 1").withColumn("d", F.col("c") + F.col("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("SQRT") == 1
