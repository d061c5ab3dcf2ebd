"""The plans Spark makes of the operators, and what they do with a hot key."""

import __spark_entry__ as entry
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from test_operators import rows
from test_sources import plan

from jobtide import operators as op
from jobtide import sources as src
from jobtide.operators.keyed import latest_dealt
from jobtide.plans import store as st
from jobtide.plans.batch import process_batch
from jobtide.plans.catalog import QUERIES
from jobtide.schema import KEY

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_and_no_pair_join(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for node in "EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin":
        assert node not in text


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def skewed(spark, shuffled_joins):
    """Adaptive execution takes small partitions for skewed ones."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def hot_items(spark, n=30_000):
    """A third of the rows under one id."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    return spark.range(0, n, 1, 8).select(key.alias("key"), F.col("id").alias("n"))


def final_plan(df):
    df.collect()
    return plan(df)


def test_normalisation_prunes_columns_and_pushes_filters(spark, tmp_path):
    path = str(tmp_path / "t")
    entry.queries()["normalize_postings"](spark, SF_DIR).write.parquet(path)
    df = spark.read.parquet(path)
    assert "Not(StringContains(vacancy_id,test_))" in plan(op.delete_where(df))
    assert "PushedFilters: [IsNotNull(salary_rub)]" in plan(op.with_salary(df))
    recent = plan(op.published_since(df, 30, F.lit("2001-08-01").cast("date")).select("city"))
    assert "GreaterThanOrEqual(published_date,2001-07-02)" in recent
    assert "ReadSchema: struct<city:string,published_date:date>" in recent
    assert "IsNotNull(title)" in plan(op.validate_target(df)[0])
    assert "ReadSchema: struct<salary_rub:int>" in plan(op.processing_stats(df))


def test_records_are_parsed_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "1"}')
    for side in src.read_raw(spark, str(tmp_path)):
        assert plan(side).count("from_json") == 1


def test_limits_are_top_n(spark):
    for name in "read_limit", "cap":
        assert "TakeOrderedAndProject" in plan(entry.queries()[name](spark, SF_DIR))


def test_stats_aggregate_before_the_shuffle(spark):
    text = plan(entry.queries()["daily_stats"](spark, SF_DIR))
    assert "partial_sum" in text and "partial_count" in text


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = hot_items(spark)
    latest = op.latest_per_key(df, "key", [F.desc("n")])
    assert plan(latest).count("WindowGroupLimit") == 2
    assert latest.where("key = 'hot'").collect() == [("hot", 29_997)]
    assert latest.count() == 20_001


def test_latest_dealt_sorts_behind_a_shuffle(spark):
    df = hot_items(spark)
    latest = latest_dealt(df, "key", [F.desc("n")], 3)
    text = plan(latest)
    # what is read is dealt before it is sorted, and the tasks are as many as asked for
    assert "Sort" not in text.rsplit("Exchange", 1)[1] and text.count("Exchange hashpartitioning") == 2
    assert latest.columns == df.columns and latest.rdd.getNumPartitions() == 3
    # saved in as many buckets it is not shuffled again
    assert plan(latest.repartition(3, "key")).count("Exchange hashpartitioning") == 2
    assert rows(latest) == rows(op.latest_per_key(df, "key", [F.desc("n")]))
    # of the hot key one row per reading task comes to its last one
    assert latest.where("key = 'hot'").collect() == [("hot", 29_997)]


def test_a_keyed_base_is_merged_without_a_sort_of_what_is_read(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(st, "save_keyed_table", lambda df, *rest: written.append((plan(df), rows(df, "vacancy_id", "title"))))
    store, line = str(tmp_path / "store"), '{"id": "%d", "name": "%s"}'
    for number, n in enumerate((6, 9)):
        (tmp_path / str(number)).write_text("\n".join(line % (k % n, f"t{number}") for k in range(20)))
        process_batch(spark, str(tmp_path / str(number)), store, number)
        assert st.compact(spark, store, "sorted_postings") == number
        if not number:
            (tmp_path / "store/base/upto=0/_COMPLETE").unlink()
    for text, _ in written:
        assert "Sort" not in text.rsplit("Exchange", 1)[1]
    assert [r for _, r in written] == [[(str(k), f"t{i}") for k in range(n)] for i, n in enumerate((6, 9))]


@pytest.mark.parametrize("unique", [True, False])
def test_hot_item_is_split_between_tasks(spark, skewed, tmp_path, unique):
    items = hot_items(spark)
    details = items.groupBy("key").agg(F.max("n").alias("v"))
    if not unique:
        details = details.unionAll(details.where("v % 2 = 0"))
    details.write.parquet(str(tmp_path / "details"))
    details = spark.read.parquet(str(tmp_path / "details"))
    joined = op.enrich(items, details, "key", details_unique=unique)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == items.count()


def test_hot_item_is_split_in_the_anti_join(spark, skewed):
    items = hot_items(spark)
    cold = items.where("key <> 'hot'")
    details = cold.where("n % 2 = 0").unionAll(cold.limit(5))
    missing = op.missing_details(items, details, "key")
    assert "skew=true" in final_plan(missing)
    expected = items.join(details.select("key").distinct(), "key", "left_anti")
    assert missing.count() == expected.count() > 10_000


def test_upsert_shuffles_keys_only(spark):
    df = entry.queries()["delete_where"](spark, SF_DIR)
    merged = plan(op.upsert(df, df.limit(5), KEY))
    assert "BroadcastHashJoin" in merged and "LeftAnti" in merged


def test_upsert_into_a_keyed_table_leaves_it_in_place(spark, shuffled_joins):
    df = entry.queries()["update_where"](spark, SF_DIR)
    src.save_keyed_table(df, "keyed_postings", buckets=4)
    target = spark.table("keyed_postings")
    batch = df.where("salary_rub > 1000000")
    merged = op.upsert(target, batch, KEY)
    left = plan(merged).split("LeftAnti")[1].split("HashAggregate")[0]
    assert "Exchange" not in left and "keyed_postings" in left
    assert merged.count() == df.count()
    src.drop_staging(spark, "keyed_postings")


def test_the_default_upsert_moves_no_rows_of_the_batch(spark):
    df = entry.queries()["update_where"](spark, SF_DIR)
    text = plan(op.upsert(df, df.withColumn("salary_rub", F.lit(1)), KEY))
    assert "SortAggregate" not in text


def test_key_clashes_counts_the_rows_once(spark):
    target = spark.range(0, 900).select(F.col("id").cast("string").alias(KEY))
    batch = spark.range(800, 1000).select((F.col("id") % 950).cast("string").alias(KEY))
    clashes = op.key_clashes(target, batch.unionAll(batch.limit(3)))
    found = clashes.collect()
    assert len(found) == len(set(found))
    final = plan(clashes)
    assert final.count("ReusedExchange") >= 1 or final.count("HashAggregate(keys") <= 4


@pytest.mark.parametrize("terms", [1, 3])
def test_a_word_in_every_text_is_split_between_tasks(spark, skewed, terms):
    texts = spark.range(0, 30_000, 1, 8).select(
        F.col("id").cast("string").alias("k"),
        F.concat(F.lit("hot C++ "), F.sha2(F.col("id").cast("string"), 256)).alias("text"),
    )
    words = ["hot", "C++", "hot C++"][:terms]
    vocabulary = spark.range(0, 20_000).select(F.sha2(F.col("id").cast("string"), 224).alias("skill"))
    vocabulary = vocabulary.unionAll(spark.createDataFrame([(w,) for w in words], "skill string"))
    found = op.skills_from_vocabulary(texts, vocabulary, "text", "k")
    # three hot words in four partitions are no exception any more
    assert terms > 1 or "skew=true" in final_plan(found)
    assert found.count() == 30_000 * terms


def test_merging_batches_does_not_read_the_base(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = spark.range(300).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("name"))
    for number, some in enumerate((rows, rows.where("id < 9"), rows.where("id > 290"))):
        some.write.json(str(tmp_path / f"in{number}"))
        process_batch(spark, str(tmp_path / f"in{number}"), store, number)
        if number == 0:
            st.compact(spark, store)
    expected = sorted(st.snapshot(spark, store).drop("processed_at").collect(), key=repr)
    # a base that could not be read would stop the merge
    base = tmp_path / "store/base/upto=0"
    files = {f: f.read_bytes() for f in base.rglob("*.parquet")}
    for f in files:
        f.write_bytes(b"none")
    assert st.merge_batches(spark, store) == 2 and st.latest_base(spark, store) == 0
    for f, content in files.items():
        f.write_bytes(content)
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    st.prune(spark, store)
    assert sorted(st.snapshot(spark, store).drop("processed_at").collect(), key=repr) == expected
    assert st.compact(spark, store) == 2
    st.prune(spark, store)
    assert not (tmp_path / "store/base/upto=0").exists()
    assert sorted(st.snapshot(spark, store).drop("processed_at").collect(), key=repr) == expected


def test_a_month_that_holds_most_rows_becomes_several_files(spark, tmp_path):
    path = str(tmp_path / "clustered")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "40KB")
    try:
        day = F.when(F.col("id") % 10 < 7, F.lit("2024-01-05")).otherwise(F.lit("2024-02-05"))
        df = spark.range(0, 40_000, 1, 8).select(
            F.col("id").cast("string").alias(KEY),
            day.cast("date").alias("published_date"),
            F.sha2(F.col("id").cast("string"), 256).alias("city"),
            F.col("id").cast("int").alias("salary_rub"),
        )
        src.clustered_write(df, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "clustered/published_month=2024-01").glob("*.parquet"))
    assert len(files) > 3
    assert spark.read.parquet(path).count() == 40_000
