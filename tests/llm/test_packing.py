import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import TESTDATA
from helpers import ODD, frame, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from jobtide.llm import packing

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def check(tokenizer, docs, pieces, width=1024):
    """Each id lies in one piece, crcs agree, sequences have no gap; the share of padding."""
    left = defaultdict(list)
    for key, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        left[key, len(ids)].append(ids)
    sequences = defaultdict(list)
    covered = defaultdict(list)
    for key, start, length, crc, total, sequence, offset in pieces:
        assert any(zlib.crc32(ids[start : start + length].tobytes()) == crc for ids in left[key, total])
        assert length > 0
        covered[key, total] += range(start, start + length)
        sequences[sequence].append((offset, length))
    for (key, total), texts in left.items():
        assert sorted(covered[key, total]) == sorted(i for _ in texts for i in range(total))
    padding = used = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= width
        used += at
        padding += 0 if at & (at - 1) == 0 else width - at
    return padding / max(1, used)


def test_round_trip_on_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    assert check(tokenizer, rows(docs.select("doc_id", "text")), rows(packing.pack(docs))) < 0.01


def test_odd_rows_long_texts_and_clashing_columns(spark, tokenizer):
    docs = [*ODD, (7, "word " * 30_000), (8, "x" * 5_000)]
    df = frame(spark, [(k, t) for k, t in docs], "doc_id long, text string, start string, sequence_id string").repartition(3)
    found = packing.pack(df)
    assert found.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check(tokenizer, docs, rows(found))
    assert rows(packing.pack(df.limit(0))) == []


def test_few_documents_are_cut():
    """With sizes that never fit together, windows are filled by cutting only when no more may be opened."""
    packer = packing.Packer(100, most_open=4)
    pieces = [p for i in range(40) for p in packer.place(i, 60)]
    assert packer.n_open <= 4
    pieces += packer.close()
    assert sum(p[2] for p in pieces) == 40 * 60
    uncut = packing.Packer(100, most_open=64)
    pieces = [p for i in range(64) for p in uncut.place(i, 50)]
    assert all(p[2] == 50 for p in pieces)


def test_the_level_keeps_squares_small():
    packer = packing.Packer(10)
    for size in (6, 6, 6, 7):
        list(packer.place(size, size))
    # closing one of the three windows of level 6 lowers the sum of squares most
    assert packer._levels(3) in (6, 7)
    assert packer._levels(4) == 6


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_ids_equal_those_of_the_library(text):
    encode = getattr(test_ids_equal_those_of_the_library, "encoder", None)
    if encode is None:
        encode = test_ids_equal_those_of_the_library.encoder = packing.Encoder(VOCABULARY)
    for t in (text, text + "<|endoftext|> é ñ ß  x", "  " + text.title() + "\n\n 12!?"):
        assert encode(t) == encode.tokenizer.encode(t, add_special_tokens=False).ids
