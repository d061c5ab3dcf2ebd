import random
import time

import numpy as np
from conftest import TESTDATA
from helpers import ODD, frame, rows
from pyspark.sql import functions as F

from jobtide.llm import substring
from jobtide.llm.text import word_hashes


def brute(docs, width):
    first = {}
    split = [(k, (t or "").encode().split()) for k, t in docs]
    for k, w in split:
        if k is not None:
            for i in range(len(w) - width + 1):
                key = tuple(w[i : i + width])
                first[key] = min(k, first.get(key, k))
    out = []
    for k, w in split:
        gone = set()
        if k is not None:
            for i in range(len(w) - width + 1):
                if first[tuple(w[i : i + width])] < k:
                    gone.update(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((-1 if k is None else k, len(w), len(gone), kept))
    return sorted(out)


def got(docs, width, **options):
    found = substring.removed(docs, width, **options).select(F.coalesce("doc_id", F.lit(-1)), "n_words", "n_removed", "kept")
    return sorted(rows(found))


def test_documents_at_full_width(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text")
    want = brute(rows(docs), 50)
    assert sum(r[2] for r in want) > 0
    assert got(docs, 50) == want


def test_random_documents(spark):
    rng = random.Random(5)
    docs = []
    for k in range(120):
        words = [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 60))]
        if docs and rng.random() < 0.6:
            other = rng.choice(docs)[1].split()
            i = rng.randrange(0, len(other) + 1)
            words[5:5] = other[i : i + rng.randrange(1, 40)]
        docs.append((k, " ".join(words)))
    rng.shuffle(docs)
    df = frame(spark, docs, "doc_id long, text string").repartition(5)
    for options in ({}, {"per_chunk": 50}, {"per_chunk": 50, "per_bucket": 20}):
        assert got(df, 8, gram=3, **options) == brute(docs, 8)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    docs = [*ODD, (7, long), (8, "x " + long + " y"), (9, "a " * 500), (10, "a " * 100), (11, long[:400]), (None, long)]
    df = frame(spark, docs, "doc_id long, text string, kept string, n_words string").repartition(3)
    assert got(df, 50) == brute(docs, 50)
    assert got(df.limit(0), 50) == []


def test_one_passage_in_every_document(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(k, f"u{k} v{k} {passage} z{k}") for k in range(400)]
    df = frame(spark, docs, "doc_id long, text string").repartition(6)
    assert got(df, 50) == brute(docs, 50)
    # it goes on once per chunk, not once per document
    moved = substring.repeats(df, 50)
    assert moved.select("doc_id").distinct().count() == 399


def test_repeats_are_maximal_intervals(spark):
    words = " ".join(f"w{i}" for i in range(100))
    df = frame(spark, [(1, words), (2, "x " + words + " y")], "doc_id long, text string")
    spans = [r for r in rows(substring.removed(df).select("doc_id", "spans")) if r[1]]
    assert [(k, [(s["start"], s["end"]) for s in v]) for k, v in spans] == [(2, [(1, 101)])]


def test_hashes_do_not_depend_on_place():
    a, b = word_hashes(b"x y hello"), word_hashes("é  hello ".encode())
    assert a[2] == b[1] and len(set(a.tolist())) == 3
    assert word_hashes(b"").size == 0 and word_hashes(b" \t ").size == 0
    values = np.random.default_rng(1).integers(0, 1000, 300)
    for width in (1, 2, 7, 39):
        want = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert substring.sliding_min(values, width).tolist() == want


def test_a_common_line_is_dealt_to_many_buckets(spark):
    line = " ".join(f"p{i}" for i in range(30))
    docs = [(k, " ".join(f"u{k}x{i}" for i in range(25)) + f" {line} " + " ".join(f"v{k // 2}x{i}" for i in range(40))) for k in range(600)]
    df = frame(spark, docs, "doc_id long, text string").repartition(6)
    assert got(df, 50, per_bucket=1000) == brute(docs, 50)
    assert len(substring.hot_grams(df, 50, 12, 1000, 2_000_000, "doc_id", "text")) > 0
    moved = substring._moved(df, 50, 12, 1000, 2_000_000, "doc_id", "text")
    held = {}
    for r in moved.select("bucket", "low").collect():
        held[r["bucket"]] = held.get(r["bucket"], 0) + len(r["low"]) // 4
    # windows spread evenly, though most hold the line
    assert max(held.values()) < 1.5 * sum(held.values()) / len(held)


def test_many_equal_rows(spark):
    """Rows of one id and text find the same spans once, however many they are."""
    passage = " ".join(f"w{i}" for i in range(80))
    docs = [(1, passage)] + [(2, "x " + passage)] * 1500
    got_ = substring.removed(frame(spark, docs, "doc_id long, text string").repartition(4))
    start = time.perf_counter()
    assert got_.groupBy("doc_id", "n_removed").count().orderBy("doc_id").collect() == [(1, 0, 1), (2, 80, 1500)]
    assert time.perf_counter() - start < 15
