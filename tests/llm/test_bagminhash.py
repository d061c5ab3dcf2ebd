import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from conftest import TESTDATA
from helpers import ODD, WORD, frame, rows
from pyspark.sql import functions as F

from jobtide.llm import bagminhash
from jobtide.llm.components import components


def bag(text):
    w = WORD.findall(text or "")
    if len(w) < 5:
        return Counter([tuple(w)] if w else [])
    return Counter(zip(*(w[i:] for i in range(5))))


def brute(docs, least=0.8):
    """Class of each row by comparing every pair that shares a shingle."""
    bags = [bag(t) for _, t in docs]
    same = defaultdict(list)
    for i, b in enumerate(bags):
        for s in b:
            same[s].append(i)
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    texts = defaultdict(list)
    for i, (_, t) in enumerate(docs):
        texts[tuple(WORD.findall(t or ""))].append(i)
    for group in texts.values():
        for i in group[1:]:
            parent[find(i)] = find(group[0])
    pairs = {(i, j) for group in same.values() for a, i in enumerate(group) for j in group[a + 1 :]}
    for i, j in pairs:
        if find(i) != find(j):
            both = (bags[i] & bags[j]).total()
            if both >= least * (bags[i].total() + bags[j].total() - both):
                parent[find(i)] = find(j)
    keys = defaultdict(list)
    for i, (k, _) in enumerate(docs):
        keys[find(i)].append(k)
    least_key = {r: min((k for k in v if k is not None), default=None) for r, v in keys.items()}
    return sorted(((k, least_key[find(i)]) for i, (k, _) in enumerate(docs)), key=str)


def got(df, **options):
    return sorted(rows(bagminhash.classes(df, **options).select("doc_id", "class_id")), key=str)


def near_copies(n, seed, words=120, changes=2):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(changes + 1)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_classes_of_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "text")
    want = brute(rows(docs))
    assert sum(k != c for k, c in want) > 20
    assert got(docs) == want


def test_large_groups_of_near_copies(spark):
    texts = near_copies(150, 1) + near_copies(90, 2, changes=4) + near_copies(5, 3)
    rng = random.Random(4)
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    assert got(frame(spark, docs, "doc_id long, text string").repartition(4)) == brute(docs)


def test_odd_rows(spark):
    long = near_copies(2, 6, words=20_000, changes=50)
    docs = [*ODD, (8, "a b c d e"), (9, "a  b\tc d e"), (10, "a b c d f"), (11, "x " * 300), (12, "x " * 310), (13, long[0]), (14, long[1])]
    df = frame(spark, docs, "doc_id long, text string, node string, class_id string").repartition(3)
    assert got(df) == brute(docs)
    assert got(df.limit(0)) == []


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    elements = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = rng.integers(1, 9, 300), rng.integers(1, 9, 300)
    b[:100] = a[:100]
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    agree = []
    for salt in range(40):
        shifted = elements + np.uint64(salt * 7919)
        both = bagminhash.signatures(np.concatenate([shifted, shifted]), np.concatenate([a, b]), np.repeat([0, 1], 300), 2)
        agree.append((both[0] == both[1]).mean())
    assert abs(np.mean(agree) - want) < 4 * np.sqrt(want * (1 - want) / (40 * 128))


def test_signatures_do_not_depend_on_the_batch():
    elements = np.arange(1, 40, dtype=np.uint64)
    weights = np.arange(1, 40) % 5 + 1
    alone = bagminhash.signatures(elements, weights, np.zeros(39, int), 1)
    both = bagminhash.signatures(np.concatenate([elements, elements[:3]]), np.concatenate([weights, weights[:3]]), np.repeat([0, 1], [39, 3]), 2)
    assert (alone[0] == both[0]).all() and np.isfinite(both).all()


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(1, 300)]
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = rows(components(spark.createDataFrame(links, "a long, b long")))
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert sorted(found) == sorted((x, find(x)) for x in linked)
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []
    assert rows(components(spark.createDataFrame([(1, 1)], "a long, b long")).agg(F.count("*"))) == [(0,)]


def test_both_sides_of_a_large_bucket_are_dealt(spark):
    texts = near_copies(120, 8, changes=9) + near_copies(60, 9, words=60, changes=6) + near_copies(20, 10, words=20, changes=1)
    texts += [" ".join(f"e{i}" for i in range(n)) for n in (8, 9, 44, 54, 204, 254)]  # similarity 0.8 at the edges of size classes
    nodes = [bagminhash._node(t.encode()) for t in texts]
    split = [(7, v, len(t.split()) - 4, nodes[0] if i < 30 else v, nodes[0], len(texts)) for i, (v, t) in enumerate(zip(nodes, texts, strict=True))]
    split = spark.createDataFrame(split, "bucket long, node binary, n long, label binary, hub binary, c long").dropDuplicates(["node"])
    packed = spark.createDataFrame([(v, zlib.compress(t.encode())) for v, t in zip(nodes, texts, strict=True)], "node binary, packed binary").dropDuplicates(["node"])
    asked, members = bagminhash._dealt(split, packed, 0.8, block=10, part=20)
    most = [df.groupBy(*bagminhash.MEET).count().agg(F.max("count")).first()[0] for df in (asked, members)]
    assert most[0] <= 45 and most[1] <= 25
    label = {v: nodes[0] if i < 30 else v for i, v in reversed(list(enumerate(nodes)))}
    bags = {v: bag(t) for v, t in zip(nodes, texts, strict=True)}
    want = {(a, b) for a in bags for b in bags if a > b and label[a] != label[b] and (both := (bags[a] & bags[b]).total()) >= 0.8 * (bags[a].total() + bags[b].total() - both)}
    a, m = asked.withColumnRenamed("node", "x").drop("label", "packed"), members.withColumnRenamed("node", "y").drop("label", "packed")
    met = {(max(p), min(p)) for p in ((bytes(r["x"]), bytes(r["y"])) for r in a.join(m, list(bagminhash.MEET)).collect())}
    assert len(want) > 100 and want <= met
    got = {(bytes(r["a"]), bytes(r["b"])) for r in bagminhash._crossed(split, packed, 0.8).distinct().collect()}
    assert got == want
