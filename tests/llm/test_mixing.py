from collections import defaultdict

from helpers import ODD, frame, rows
from pyspark.sql import functions as F

from jobtide.llm import mixing
from jobtide.llm.text import words


def fill(sizes, weights=(1, 2, 3), most=3):
    """Targets by resharing the excess again and again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(order), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > most * sizes[s]}
        if not above:
            return out | share
        for s in above:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= above
    return out


def test_targets_equal_resharing(spark):
    for sizes in (
        {"a": 100, "b": 100, "c": 100, None: 50},
        {"a": 1000, "b": 1, "c": 2, "d": 3, "é": 40},
        {"a": 0, "b": 0},
        {"a": 5},
        {"b": 10, "a": 0, "c": 500, "Z": 7, "z": 1, None: 1},
    ):
        df = frame(spark, list(sizes.items()), "source string, size long")
        got = {r[0]: r[3] for r in rows(mixing.targets(df))}
        want = fill(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
        assert got.keys() == want.keys()
        for s in got:
            assert abs(got[s] - want[s]) < 1e-6, (sizes, got, want)


def test_sums_come_near_targets_and_reruns_agree(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        (F.pmod(F.xxhash64("id"), F.lit(300)) + 1).alias("n"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
    )
    got = mixing.copies(docs, F.col("n"))
    total, target, size = defaultdict(int), {}, defaultdict(int)
    for r in got.collect():
        assert 0 <= r["copies"] <= 3
        total[r["source"]] += r["copies"] * r["size"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    for s in total:
        assert abs(total[s] - target[s]) <= 300
        assert target[s] <= 3 * size[s]
    assert abs(sum(target.values()) - sum(size.values())) < 1e-3
    again = mixing.copies(docs.repartition(7), F.col("n"))
    assert got.exceptAll(again).isEmpty() and again.exceptAll(got).isEmpty()


def test_odds_follow_the_measure(spark):
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(1).alias("n"), F.when(F.col("id") < 2000, 9.0).otherwise(1.0).alias("m"))
    other = spark.range(4_000, 10_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("source"), F.lit(1).alias("n"), F.lit(1.0).alias("m"))
    got = mixing.copies(docs.union(other), F.col("n"), measure=F.col("m")).filter("source = 's'")
    heavy, light = (got.filter(c).agg(F.avg("copies")).first()[0] for c in ("doc_id < 2000", "doc_id >= 2000"))
    assert heavy > light + 0.2


def test_odd_rows_and_clashing_columns(spark):
    docs = frame(spark, [(k, t, "target", None if k == 4 else "s", 1) for k, t in ODD], "doc_id long, text string, target string, source string, copies long")
    got = mixing.copies(docs, F.size(words(F.col("text"))))
    assert got.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies"]
    assert got.count() == len(ODD)
    assert all(r["copies"] == 0 for r in got.collect() if r["size"] == 0)
    assert rows(mixing.copies(docs.limit(0), F.size(words(F.col("text"))))) == []
    empty = frame(spark, [(1, None, None, "a", 0)])
    assert rows(mixing.copies(empty, F.lit(0)).select("copies", "target")) == [(0, 0.0)]
    assert len(rows(mixing.repeated(got))) == sum(r["copies"] for r in got.collect())


def test_mixing_is_native_and_does_not_move_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = mixing.copies(docs, F.size(words(F.col("text"))))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
