import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from conftest import TESTDATA
from helpers import ODD, frame, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from jobtide.llm import align


def tokens():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_table():
    kept = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, n = {chr(b): b for b in kept}, 0
    for b in range(256):
        if b not in kept:
            table[chr(256 + n)] = b
            n += 1
    return table


def encoded(text, a, b, table):
    """[(id, end)] of both sides, or nothing."""
    if not text:
        return [], []
    raw = f" {text}".encode()
    left = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        right.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
    out = []
    for side in (left, right):
        if b"".join(x for _, x in side) != raw:
            return [], []
        end, found = 0, []
        for i, x in side:
            end += len(x)
            found.append((i, end))
        out.append(found)
    return tuple(out)


def brute(docs):
    a, b = tokens()
    table = byte_table()
    per, held = [], Counter()
    for key, text in docs:
        left, right = encoded(text, a, b, table)
        common = sorted({e for _, e in left} & {e for _, e in right})
        groups, start = [], 0
        for end in common:
            groups.append(([i for i, e in left if start < e <= end], [i for i, e in right if start < e <= end]) if len(common) < 3000 else None)
            start = end
        if len(common) >= 3000:  # the same, in one pass
            groups, i, j = [], 0, 0
            for end in common:
                x, y = [], []
                while i < len(left) and left[i][1] <= end:
                    x.append(left[i][0])
                    i += 1
                while j < len(right) and right[j][1] <= end:
                    y.append(right[j][0])
                    j += 1
                groups.append((x, y))
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        held.update(links.keys())
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        per.append((key, len(left), len(right), len(groups), links, hashlib.sha256(said.encode()).hexdigest() if said else ""))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(n, most.get(x, 0))
    return sorted(
        (-1 if k is None else k, n, m, g, sum(links.values()), sum(t for p, t in links.items() if held[p] == most[p[0]]), sum(t * held[p] for p, t in links.items()), s)
        for k, n, m, g, links, s in per
    )


def got(docs, **options):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in rows(align.align(docs, **options)))


def test_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text")
    want = brute(rows(docs))
    assert any(r[1] for r in want) and any(r[5] < r[4] for r in want)
    assert got(docs.repartition(5), per_chunk=30_000) == want


def test_odd_rows(spark):
    docs = [
        *ODD, (8, "a  b"), (9, "<|endoftext|> </s> <0x41>"), (10, "▁ x"), (11, "日本語 😀 naïve ﬁ"), (12, "a" * 5000),
        (13, " lead"), (14, "tail \n\t"), (15, "\x00\x01 \x7f"), (16, "don't we'll " * 3000), (17, "the cat"), (18, "the cat the"),
    ]
    df = frame(spark, docs)
    assert got(df) == brute(docs)
    assert got(df, per_chunk=1) == brute(docs)
    assert got(df.filter("false")) == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([("x", "the cat", 9, "y", 3)], "doc_id string, text string, n_a long, chunk string, bucket int")
    (row,) = rows(align.align(df))
    assert row[0] == "x" and row[1] > 0


@given(st.lists(st.tuples(st.integers(1, 9), st.booleans(), st.booleans()), min_size=1, max_size=60), st.randoms())
@settings(max_examples=200, deadline=None)
def test_cuts_are_the_shared_ends(steps, rng):
    """Whatever the ends, the search finds all that are shared, and those only."""
    a, b, at = [], [], 0
    for width, left, right in steps:
        at += width
        a += [at] * left
        b += [at] * right
    a, b = np.array([*a, at + 1]), np.array([*b, at + 1])
    k = rng.randrange(len(a))
    low, high = np.array([0, k]), np.array([k, len(a)])
    assert align.shared_cuts(a, b, low, high).tolist() == np.isin(a, b).tolist()


def test_long_text_without_cuts():
    rng = random.Random(1)
    a = np.cumsum([rng.randrange(1, 4) * 2 for _ in range(100_000)])
    b = a - 1
    b[-7] += 1
    cut = align.shared_cuts(a, b, np.array([0]), np.array([len(a)]))
    assert np.flatnonzero(cut).tolist() == [len(a) - 7]
