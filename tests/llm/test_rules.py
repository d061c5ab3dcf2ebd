from collections import Counter

from conftest import TESTDATA
from helpers import ODD, WORD, frame, rows
from pyspark.sql import functions as F

from jobtide.llm import rules


def brute(text):
    words = WORD.findall(text or "")
    seen = Counter(zip(words, words[1:], words[2:]))
    repeated = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [s for s in (text or "").split("\n") if WORD.search(s)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def test_counts_equal_plain_python(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text")
    odd = [*ODD, (20, "a b c a b c"), (21, "a a a a a"), (22, "x\nx\n \nx y"), (23, "é|ß " * 3000), (24, " lead\x0btrail ")]
    docs = docs.union(frame(spark, odd, "doc_id long, text string"))
    want = sorted((k if k is not None else -1, *brute(t)) for k, t in rows(docs))
    got = rows(rules.counts(docs).select(F.coalesce("doc_id", F.lit(-1)), *rules.COUNTS[:5]))
    assert sorted(got) == want
    assert rows(rules.counts(docs.limit(0))) == []


def test_windows_themselves_are_compared_where_hashes_cannot(spark, monkeypatch):
    monkeypatch.setattr(rules, "_BITS", 3)  # texts of eight words or more take the other way
    texts = ["a b c a b c d e f a b", "x " * 40, "k l m n o p q r s t"]
    got = rows(rules.counts(frame(spark, list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "n_repeat_words"))
    assert sorted(got) == [(i, brute(t)[4]) for i, t in enumerate(texts)]


def test_learned_list_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/sf0.1/labels.parquet")
    counted = rules.counts(docs).cache()
    train = labels.filter("doc_id % 2 = 0")
    out = rules.verdicts(counted, train).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("NOT base_failed")
    found = {tuple(r[:2]): r[2] for r in rows(out.groupBy("quality", "kept").agg(F.count("*")))}
    assert found.get((1, False), 0) <= 0.01 * found[1, True]
    assert found.get((0, True), 0) <= 0.1 * found[0, False]
    counted.unpersist()


def test_no_labels_keep_what_passes_the_base(spark):
    docs = frame(spark, [(1, "w%d " * 3), (2, " ".join(f"w{i}" for i in range(60)))], "doc_id long, text string")
    labels = frame(spark, [], "doc_id long, quality int, toxic int")
    got = rows(rules.verdicts(rules.counts(docs), labels).select("doc_id", "base_failed", "kept", "rule").orderBy("doc_id"))
    assert got == [(1, True, False, None), (2, False, True, None)]


def test_decision_takes_the_first_rule(spark):
    low, high = rules.Condition("x", False, 2.0), rules.Condition("x", True, 1.0)
    df = spark.range(4).select(F.col("id").cast("double").alias("x"))
    got = rows(df.select(rules.decision([(low, high), (low,), (high,)])))
    assert got == [(2,), (1,), (3,), (3,)]
    assert str(low) == "x < 2"


def test_learning_is_native(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    plan = rules.counts(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
