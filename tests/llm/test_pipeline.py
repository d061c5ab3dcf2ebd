from collections import Counter

from conftest import TESTDATA
from helpers import frame, rows
from pyspark.sql import functions as F
from test_bagminhash import brute as near
from test_packing import VOCABULARY, check
from test_secrets import brute as spans_of
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from jobtide.llm import secrets, toxicity


def test_stages_on_documents(spark):
    sf_dir = f"{TESTDATA}/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = dict(rows(toxicity.scored(docs, model, name="s").select("doc_id", "s")))

    first = pipeline.toxic(spark, docs, sf_dir)
    assert first.schema == docs.schema
    assert {r["doc_id"] for r in first.collect()} == {k for k, s in score.items() if s < 0.7}

    second = pipeline.near_duplicates(spark, first, sf_dir)
    assert second.schema == docs.schema
    kept = sorted(k for k, c in near(rows(first.select("doc_id", "text"))) if k == c)
    assert sorted(r["doc_id"] for r in second.collect()) == kept

    third = pipeline.secrets(spark, second, sf_dir)
    assert third.schema == docs.schema
    texts = dict(rows(second.select("doc_id", "text")))
    masked = dict(rows(third.select("doc_id", "text")))
    assert masked.keys() == texts.keys()
    for k, t in texts.items():
        assert (masked[k] == t) == (not spans_of(t))
        assert not spans_of(masked[k], secrets.BASE)
    assert rows(third.filter("n_chars != length(text)")) == rows(second.filter("n_chars != length(text)"))

    fourth = pipeline.mix(spark, third, sf_dir)
    assert fourth.schema == docs.schema
    assert max(Counter(r["doc_id"] for r in fourth.collect()).values()) <= 3
    assert fourth.exceptAll(third.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("n")).isEmpty()

    fifth = pipeline.pack(spark, fourth, sf_dir)
    mixed = rows(fourth.select("doc_id", "text"))
    assert check(Tokenizer.from_file(VOCABULARY), mixed, rows(fifth)) < 0.01


def test_run_on_odd_documents(spark, tmp_path):
    odd = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (4, "token=abcdefghij"), (None, "no id"), (5, "one two three " * 200)]
    frame(spark, odd).write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, [], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.count() > 0
    nothing = frame(spark, []).filter("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, nothing, str(tmp_path)).collect() == []


def test_repeated_rows_leave_one(spark):
    docs = frame(spark, [(1, "a b c"), (1, "a b c"), (2, "a b c"), (None, "x y"), (7, "z")])
    assert sorted(rows(pipeline.near_duplicates(spark, docs, "").select("doc_id")), key=str) == [(1,), (7,), (None,)]


def test_rows_that_share_an_id_or_have_none_are_told_apart_by_words(spark):
    say = lambda w: " ".join(f"{w}{i}" for i in range(30))
    docs = [(None, say("a")), (None, say("b")), (None, say("b")), (3, say("c")), (3, say("d")), (2, say("c") + " more"), (None, say("c")), (9, None), (8, " ")]
    got = pipeline.near_duplicates(spark, frame(spark, docs).repartition(3), "")
    # the row (3, c) goes, as 2 is of its class, though another row of id 3 stays
    want = [(None, say("a")), (None, say("b")), (3, say("d")), (2, say("c") + " more"), (8, " ")]
    assert sorted(rows(got.select("doc_id", "text")), key=str) == sorted(want, key=str)


def test_the_copy_that_stays_is_fixed(spark):
    docs = frame(spark, [(1, "a b", "en", s, 3) for s in "pqrstu"])
    got = [rows(pipeline.near_duplicates(spark, docs.orderBy(o).coalesce(n), "")) for o, n in (("source", 1), (F.desc("source"), 1), ("source", 3))]
    assert len(got[0]) == 1 and got[0] == got[1] == got[2]


def test_columns_of_any_name_come_through(spark, tmp_path):
    """Names that operators use for their own columns, with values of other kinds."""
    extra = ["size", "copies", "_score", "score", "target", "source_size", "secrets", "_kinds", "_node", "_kept", "row", "n", "label", "k"]
    names = ["doc_id", "text", "lang", "source", "n_chars", *extra]
    say = lambda w: " ".join(f"{w}{i}" for i in range(60))
    texts = [say("a"), say("b") + " token=abcdefghij", say("c"), None]
    docs = spark.createDataFrame([(i, t, "en", "s", 5, *[f"{c}{i}" for c in extra]) for i, t in enumerate(texts)], ", ".join(f"`{c}` {'long' if c in ('doc_id', 'n_chars') else 'string'}" for c in names))
    frame(spark, [], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == names, name
        for r in docs.collect():
            assert [r[c] for c in extra] == [f"{c}{r['doc_id']}" for c in extra], name
    assert {r["doc_id"] for r in docs.collect()} == {0, 1, 2}


def test_mixing_moves_no_texts(spark, tmp_path):
    frame(spark, [(i, "a b c " * 50, "en", f"s{i % 3}", 300) for i in range(50)]).write.parquet(f"{tmp_path}/d")
    mixed = pipeline.mix(spark, spark.read.parquet(f"{tmp_path}/d"), "")
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    # rows meet what is known of their source where they are; what is below that join is narrow
    assert "Exchange" not in plan.split("BroadcastHashJoin")[0]
