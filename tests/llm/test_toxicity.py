import itertools
import random
import zlib

import numpy as np
import pytest
from conftest import TESTDATA
from helpers import ODD, frame, rows
from pyspark.sql import functions as F

from jobtide.llm import toxicity


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{TESTDATA}/sf0.1/{t}.parquet") for t in ("documents", "labels")]


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.learn(*tables)


def test_held_out_accuracy(tables, model):
    docs, labels = tables
    held = docs.join(labels.filter(toxicity.held_out(F.col("doc_id"))), "doc_id")
    got = rows(toxicity.scored(held.select("doc_id", "text", "toxic"), model).select("toxic", F.col("score") >= 0.7))
    toxic = [p for y, p in got if y == 1]
    clean = [p for y, p in got if y == 0]
    assert len(toxic) > 100
    # one toxic text in twenty is so labelled without a word of it being so
    assert np.mean(toxic) >= 0.88 and np.mean(clean) <= 0.005


def test_obfuscated_words_are_restored(spark, model):
    restorer = toxicity.Restorer(model.language)
    for written, meant in (("1d10t", "idiot"), ("st*pid".replace("*", ".u"), "stupid"), ("m0r0n", "moron"), ("cl.o.w.n", "clown"), ("trrraaash", "trash"), ("$tupid", "stupid"), ("l0ser!!", "loser"), ("plain", "plain"), ("hello,", "hello")):
        assert restorer.word(written) == meant, written
    assert "idiot" in restorer.tokens("you i d i o t now") and "a" in restorer.tokens("a")
    clean = "The ore thion of ands the ing hat re onst " * 10
    docs = [(1, clean), (2, clean + " you 1d10t and m0r0n, what an i d i o t and l.o.s.e.r"), (3, clean + " you idiot and moron, loser")]
    score = dict(rows(toxicity.scored(frame(spark, docs), model).select("doc_id", "score")))
    assert score[1] < 0.2 and score[2] >= 0.7 and score[3] >= 0.7


def test_odd_rows_and_clashing_columns(spark, model):
    docs = frame(spark, [(k, t, "x") for k, t in [*ODD, (9, "idiot " * 40_000), (10, "0" * 100_000), (11, "a1" * 30_000)]], "doc_id long, text string, score string")
    got = toxicity.scored(docs, model)
    assert got.columns == ["doc_id", "text", "score"] and got.count() == len(ODD) + 3
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    assert toxicity.scored(docs.limit(0), model).collect() == []


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = frame(spark, [(i, "bad awful" if i % 2 else "good fine") for i in range(300)], "doc_id long, text string")
    all_labels = [(i, 1, i % 2) for i in range(300)]
    turned = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, q, y in all_labels]
    one, two = (toxicity.learn(docs, frame(spark, x, "doc_id long, quality int, toxic int")) for x in (all_labels, turned))
    assert one.weights == two.weights and one.fit == two.fit and "awful" in one.weights


def test_no_labels_and_no_documents(spark):
    docs = frame(spark, [(1, "idiot")], "doc_id long, text string")
    none = toxicity.learn(docs, frame(spark, [], "doc_id long, quality int, toxic int"))
    assert rows(toxicity.scored(docs, none).select(F.col("score") < 0.7)) == [(True,)]
    assert toxicity.learn(docs.limit(0), frame(spark, [(1, 1, 1)], "doc_id long, quality int, toxic int")).weights == {}
    assert toxicity.language_model(docs.limit(0)).shape == (28, 28, 28)


def test_the_language_model_counts_everything(spark):
    docs = frame(spark, [(1, "ab"), (2, None), (3, "AB é")], "doc_id long, text string")
    model = toxicity.language_model(docs.repartition(3))
    assert np.allclose(np.exp(model).sum(2), 1)
    assert model[0, 1, 2] > model[0, 1, 3] and toxicity.symbol("é") == 27


def test_viterbi_equals_enumeration(model):
    """The cheapest of all ways through the lattice, for short tokens."""
    restorer = toxicity.Restorer(model.language)
    rng = random.Random(6)

    def price(ways):
        a = b = 0
        cost = 0.0
        for letters, extra in ways:
            cost += extra
            for x in letters:
                s = toxicity.symbol(x)
                cost -= restorer.model[a][b][s]
                a, b = b, s
        return cost - restorer.model[a][b][0]

    for _ in range(150):
        token = "".join(rng.choice("a1d0t$3@.r!ll4") for _ in range(rng.randrange(1, 7)))
        ways = list(itertools.product(*restorer.options(token)))
        least = min(map(price, ways))
        said = restorer.decode(token)
        assert min(price(w) for w in ways if "".join(x for x, _ in w) == said) <= least + 1e-9, token


def test_repeated_keys_count_once_a_row(spark):
    """Rows of one labelled key come to the driver as counts, not one by one."""
    docs = frame(spark, [(i, "bad awful" if i % 2 else "good fine") for i in range(300)] + [(4, "good fine")] * 3000, "doc_id long, text string")
    labels = frame(spark, [(i, 1, i % 2) for i in range(300)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    assert "awful" in model.weights and model.fit[0] < 0
