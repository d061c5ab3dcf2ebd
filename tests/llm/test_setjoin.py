import random
import re

import numpy as np
import pytest
from conftest import TESTDATA
from helpers import ODD, frame, rows

from jobtide.llm import setjoin

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    n = min(4, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def brute(docs, percent=85):
    sets = [shingles(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in by[g] if j < i}:
            if 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(docs):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return sorted((-1 if k is None else k, len(s), least.get(root(i), -1)) for i, ((k, _), s) in enumerate(zip(docs, sets, strict=True)))


def got(docs, **options):
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows(setjoin.joined(docs, **options)))


def edited(rng, words, most):
    words = list(words)
    for _ in range(rng.randrange(most + 1)):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**9)}"
    return words


def test_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "text")
    want = brute(rows(docs))
    assert any(c != k for k, _, c in want)
    assert got(docs) == want


def test_odd_rows(spark):
    docs = [*ODD, (8, "One"), (9, "A b\nC\td"), (10, "a b c d e"), (None, "of no id"), (11, "w " * 30_000)]
    df = frame(spark, docs)
    assert got(df) == brute(docs)
    assert got(df.filter("false")) == []


@pytest.mark.parametrize("small", [3, 32])
def test_groups_of_near_copies(spark, small):
    """Long lists, whose members differ by up to a sixth, in chunks and buckets of a few."""
    rng = random.Random(small)
    docs = []
    for _ in range(3):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(60, 120))]
        mine = [base]
        for _ in range(60):
            mine.append(edited(rng, rng.choice(mine), 2))
        docs += [" ".join(w) for w in mine]
    docs += [docs[0], docs[70], docs[0].upper()] + [" ".join(f"w{rng.randrange(400)}" for _ in range(50)) for _ in range(20)]
    docs = list(enumerate(docs, 5))
    rng.shuffle(docs)
    df = frame(spark, docs, "doc_id long, text string").repartition(5)
    assert got(df, small=small, per_chunk=700, per_bucket=500) == brute(docs)


def test_a_frequent_passage_links_nothing(spark):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    docs = [(i, " ".join(passage + [f"d{rng.randrange(10**9)}" for _ in range(rng.randrange(5, 30))])) for i in range(150)]
    assert got(frame(spark, docs, "doc_id long, text string"), small=4, per_chunk=2_000) == brute(docs)


def test_probe_loses_no_link():
    """Every pair that could link by size and position is kept, and few others."""
    rng = np.random.default_rng(1)
    n = rng.integers(1, 60, 80)
    pos = (rng.random(80) * n).astype(np.int64)
    order = np.lexsort((pos, n))
    n, pos = n[order], pos[order]
    found = set(zip(*(x.tolist() for x in setjoin.probe(n, pos)), strict=True))
    for i in range(80):
        for j in range(i):
            need = setjoin.least_overlap(n[i], n[j])
            possible = 100 * n[j] >= 85 * n[i] and n[i] - pos[i] >= need and n[j] - pos[j] >= need
            assert ((i, j) in found) == possible


def test_overlaps_derived():
    rng = np.random.default_rng(2)
    base = rng.choice(10**6, 200, replace=False)
    sets = [np.unique(np.concatenate([rng.choice(base, 180, replace=False), rng.choice(10**6, 15)])).astype(np.uint64) for _ in range(40)]
    sets[7] = np.array([5], np.uint64)
    found = dict(setjoin.overlaps(sets[:25], sets[20:]))
    assert sorted(found) == list(range(25))
    for i, counts in found.items():
        assert counts.tolist() == [len(np.intersect1d(sets[i], s)) for s in sets[20:]]


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 9, "x"), (2, "a b c d e f", 8, "y")], "doc_id long, text string, n long, node string")
    assert got(df) == [(1, 3, 1), (2, 3, 1)]
