import random
import re
import zlib
from collections import Counter

import pytest
from conftest import TESTDATA
from helpers import ODD, frame, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from jobtide.llm import variants


def single_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs, least=6, often=5, times=5):
    n = Counter()
    for key, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= least and c >= often}
    # words that are near share a word with one code point left out
    by = {}
    for w in n:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by.setdefault(v, set()).add(w)
    near = {w: set() for w in n}
    for group in by.values():
        for a in group:
            near[a] |= {b for b in group if single_edit(a, b)}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(docs, **options):
    return sorted(rows(variants.group(docs, **options)))


def test_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "text")
    want = brute(rows(docs))
    assert any(r[1] for r in want) and any(r[4] > 1 for r in want)
    assert got(docs) == want


@pytest.mark.parametrize("slot", [3, 4096])
def test_random_words(spark, slot):
    """Few letters, so that halves are shared by many; chains of forms; slots of a few words."""
    rng = random.Random(slot)
    words = ["".join(rng.choice("abÀß") for _ in range(rng.randrange(5, 9))) for _ in range(400)]
    docs = [(i, " ".join(rng.choice(words[: 1 + int(400 * rng.random() ** 4)]) for _ in range(60))) for i in range(150)]
    docs.append((999, "zzzzza " * 3 + "zzzzzb " * 7 + "zzzzzzb " * 20 + "zzzzzzßb " * 50))
    want = brute(docs, often=2, times=2)
    assert any(r[1] and r[2] != r[1] for r in want)
    assert got(frame(spark, docs, "doc_id long, text string").repartition(3), often=2, times=2, slot=slot) == want


def test_odd_rows(spark):
    docs = [*ODD, *[(i, "Letters lettres letters x" + "é" * 40) for i in range(9)], (20, "letters " * 50_000), (21, "ÉTUDES études " * 6)]
    df = frame(spark, docs)
    assert got(df) == brute(docs)
    assert got(df.filter("false")) == [] and got(df.limit(4)) == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "abcdefg " * 9, "x", 2)], "doc_id long, text string, word string, n long")
    assert [r[0] for r in got(df)] == ["abcdefg"]


@given(st.lists(st.text("abé", min_size=1, max_size=7), min_size=1, max_size=8, unique=True), st.lists(st.text("abé", min_size=1, max_size=7), min_size=1, max_size=8, unique=True))
@settings(max_examples=200, deadline=None)
def test_tile_of_two_blocks(a, b):
    edit, _ = variants.near(variants.codes(a), variants.codes(b))
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            assert x == y or edit[i, j] == single_edit(x, y)
