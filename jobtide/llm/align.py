"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

Both tokenizations of a text cut the same bytes. An interval of tokens is searched for an
end that both have, from its middle outwards, by bisect among the other's ends; the interval
falls apart there, and both halves are searched in turn. An interval without a shared end is
a group: its tokens of one side belong to its tokens of the other. All documents of a chunk
are searched at once, one step of the recursion at a time.

Which ids belong together is counted over the corpus. A chunk sends each pair of ids it has
linked once, with the number of its documents; what comes back are the counts over all
documents and whether a pair is the commonest of its first id. The documents themselves stay
with the chunk as numbers, so texts are read and encoded once.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.packing import Encoder
from jobtide.llm.text import mix64, saved

_FIGURES = ("n_a", "n_b", "n_groups", "n_links", "held")


def shared_cuts(a: np.ndarray, b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of the ends ``a`` are ends ``b`` too, within the intervals [low, high) of places in ``a``; both ascend."""
    cut = np.zeros(len(a), bool)
    while len(low):
        open_ = high > low
        low, high = low[open_], high[open_]
        middle = (low + high) // 2
        found = np.full(len(low), -1, np.int64)
        left, near, far = np.arange(len(low)), 0, 1
        while len(left):
            off = np.arange(near, far)
            off = np.column_stack([off, -off]).ravel() if near else off  # the nearest first
            probe = middle[left, None] + off
            inside = (probe >= low[left, None]) & (probe < high[left, None])
            ends = a[np.where(inside, probe, middle[left, None])]
            at = np.minimum(np.searchsorted(b, ends), len(b) - 1)
            hit = inside & (b[at] == ends)
            first = np.argmax(hit, axis=1)
            some = hit[np.arange(len(left)), first]
            found[left[some]] = probe[some, first[some]]
            left = left[~some]
            near, far = far, 2 * far
            left = left[(middle[left] + near < high[left]) | (middle[left] - near >= low[left])]
        split = found >= 0
        middle = found[split]
        cut[middle] = True
        # in their order, so that neighbours are looked up one after another
        low, high = np.column_stack([low[split], middle + 1]).ravel(), np.column_stack([middle, high[split]]).ravel()
    return cut


class Pair:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, first: str, second: str):
        import sentencepiece

        self.first = Encoder(first)
        self.first.tokenizer.encode_special_tokens = True
        with open(first, encoding="utf-8") as f:
            entries = json.load(f)["model"]["vocab"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        self.a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        self.b = [
            bytes([int(p[3:-1], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.second.id_to_piece(i) for i in range(self.second.get_piece_size()))
        ]

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of both; None where the tokens' bytes are not those of a space and the text."""
        if not text:
            return None
        whole = f" {text}"
        a, b = self.first(whole), self.second.encode(text, num_threads=1)
        raw = whole.encode()
        same = b"".join(map(self.a.__getitem__, a)) == raw == b"".join(map(self.b.__getitem__, b))
        return (a, b) if same else None


class _Chunk:
    """Token ids of some documents; documents without tokens have none."""

    def __init__(self):
        self.keys: list = []
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.n = 0

    def add(self, key, found) -> None:
        a, b = found or ((), ())
        self.keys.append(key)
        self.a.append(np.array(a, np.int64))
        self.b.append(np.array(b, np.int64))
        self.n += len(a) + len(b)

    def aligned(self, width_a: np.ndarray, width_b: np.ndarray, said: list[bytes]) -> tuple[dict, np.ndarray, np.ndarray]:
        """Per document its figures, digest and linked pairs (places among all pairs, and how often); all pairs, ascending, and how many documents hold each."""
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (self.a, self.b))
        a, b = np.concatenate(self.a), np.concatenate(self.b)
        ends_a, ends_b = np.cumsum(width_a[a]), np.cumsum(width_b[b])
        stop = np.cumsum(n_a)
        live = n_a > 0
        last = stop[live] - 1  # the text's end is shared
        cut = shared_cuts(ends_a, ends_b, (stop - n_a)[live], last) if live.any() else np.zeros(0, bool)
        cut[last] = True
        closes = np.zeros(len(b), bool)
        closes[np.searchsorted(ends_b, ends_a[cut])] = True
        of_a, of_b = np.cumsum(cut) - cut, np.cumsum(closes) - closes  # the group of each token
        doc = np.repeat(np.arange(len(n_a)), n_a)[cut]  # of each group
        in_a, in_b = np.bincount(of_a, minlength=len(doc)), np.bincount(of_b, minlength=len(doc))
        at, times, held, pairs, docs = _linked(a, b, of_a, of_b, in_a, in_b, doc, len(n_a), len(width_a), len(width_b))
        per = {
            "n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc, minlength=len(n_a)),
            "n_links": np.bincount(doc, in_a * in_b, minlength=len(n_a)).astype(np.int64), "held": held, "at": at, "times": times,
        }
        # of a group first the one side, then the other; ``said`` has each id before a comma and before the sign that ends its side
        place_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[of_a]
        place_b = np.arange(len(b)) + np.cumsum(in_a)[of_b]
        spoken = np.empty(len(a) + len(b), np.int64)
        spoken[place_a] = 2 * a + cut
        spoken[place_b] = 2 * (len(width_a) + b) + closes
        sizes = (n_a + n_b).tolist()
        per["groups"] = []
        for e, n in zip(np.cumsum(n_a + n_b).tolist(), sizes, strict=True):
            text = b"".join(map(said.__getitem__, spoken[e - n : e].tolist()))[:-1]
            per["groups"].append(hashlib.sha256(text).hexdigest() if n else "")
        return per, pairs, docs


def _linked(a, b, of_a, of_b, in_a, in_b, doc, n_docs, most_a, most_b) -> tuple[np.ndarray, ...]:
    """Linked pairs of ids: place and times per document, how many each document holds; all pairs, and how many documents hold each."""
    single = (in_a == 1) & (in_b == 1)
    one_a, one_b = single[of_a], single[of_b]
    # in larger groups equal ids are one entry with a number, so that long ones stay small
    own, times_a = np.unique(of_a[~one_a] * most_a + a[~one_a], return_counts=True)
    other, times_b = np.unique(of_b[~one_b] * most_b + b[~one_b], return_counts=True)
    group = own // most_a
    n_other = np.bincount(other // most_b, minlength=len(doc))
    reach = n_other[group]
    left = np.repeat(np.arange(len(own)), reach)
    right = np.arange(len(left)) - np.repeat(np.cumsum(reach) - reach, reach) + (np.cumsum(n_other) - n_other)[group][left]
    pair = np.concatenate([a[one_a] * most_b + b[one_b], (own % most_a)[left] * most_b + (other % most_b)[right]])
    times = np.concatenate([np.ones(int(single.sum()), np.int64), times_a[left] * times_b[right]])
    key = np.concatenate([doc[single], doc[group][left]]) * (most_a * most_b) + pair
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.add.reduceat(times[order], starts) if len(starts) else times
    key = key[starts]
    pairs, at, docs = np.unique(key % (most_a * most_b), return_inverse=True, return_counts=True)
    held = np.bincount(key // (most_a * most_b), minlength=n_docs)
    return at, times, held, (pairs // most_b << 32) | pairs % most_b, docs


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def align(
    docs: DataFrame, first: str | None = None, second: str | None = None, per_chunk: int = 2_000_000, per_bucket: int = 64_000_000,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each row of ``docs``.

    ``first`` is a byte-level vocabulary of the tokenizers library, applied to a space and the
    text; ``second`` a sentencepiece model that adds the space itself; both are paths that every
    executor can open. Neither takes special tokens' strings for more than text. Links join each
    token of a group's one side with each of its other side. A pair of ids counts the rows that
    hold it; n_best counts links whose pair no other pair of the same first id exceeds.

    Null and empty texts, and texts that either side does not reproduce byte for byte, have no
    tokens: zeros and an empty digest. Rows of equal or null keys are rows of their own; an empty
    table gives no rows; other columns are not looked at.
    """
    kind = docs.schema[key].dataType.simpleString()
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    n_buckets = max(64, int(size) // per_bucket + 1)
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    columns = ("chunk", "bucket", "pairs", "docs", "keys", *_FIGURES, "groups", "at", "times")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        chunk, pair, types = _Chunk(), None, None

        def packed() -> pa.RecordBatch:
            per, pairs, n = chunk.aligned(*widths, said)
            bucket = _bucket(pairs, n_buckets)
            # counts come back by bucket, and within one in ascending order
            rank = np.empty(len(pairs), "<u4")
            rank[np.argsort(bucket, kind="stable")] = np.arange(len(pairs))
            per |= {"at": rank[per["at"]].tobytes(), "times": per["times"].astype("<u4").tobytes()}
            rows = [{"chunk": number, "bucket": int(b), "pairs": pairs[bucket == b].astype("<u8").tobytes(), "docs": n[bucket == b].astype("<u4").tobytes()} for b in np.unique(bucket)]
            rows.append({"chunk": number, "keys": chunk.keys} | per)
            return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(columns, types, strict=True)], names=list(columns))

        for batch in batches:
            if pair is None:
                paths = default_vocabularies() if first is None or second is None else ("", "")
                pair = Pair(first or paths[0], second or paths[1])
                widths = [np.array([len(x) for x in side], np.int64) for side in (pair.a, pair.b)]
                said = [f"{i}{end}".encode() for side, close in zip((pair.a, pair.b), "|;", strict=True) for i in range(len(side)) for end in (",", close)]
                types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(batch.schema.field(0).type), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), pa.binary(), pa.binary()]
            for k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chunk.add(k, pair.encode(t or ""))
                if chunk.n >= per_chunk or len(chunk.keys) >= 100_000:
                    yield packed()
                    number += 1
                    chunk = _Chunk()
        if chunk.keys:
            yield packed()

    schema = ", ".join(["chunk long, bucket int, pairs binary, docs binary", f"keys array<{kind}>", *[f"{c} array<long>" for c in _FIGURES], "groups array<string>, at binary, times binary"])
    chunks = saved(source.mapInArrow(encoded, schema), "aligned")

    def counted(table: pa.Table) -> pa.Table:
        own, n = ([np.frombuffer(v, kind) for v in table[c].to_pylist()] for c, kind in (("pairs", "<u8"), ("docs", "<u4")))
        pairs, place = np.unique(np.concatenate(own), return_inverse=True)
        total = np.bincount(place, np.concatenate(n)).astype(np.int64)
        starts = np.flatnonzero(np.diff(pairs >> np.uint64(32), prepend=np.uint64(2**32 - 1)))
        most = np.repeat(np.maximum.reduceat(total, starts), np.diff(np.append(starts, len(pairs))))
        cuts = np.cumsum([len(v) for v in own])[:-1]
        split = lambda values: pa.array([v.tobytes() for v in np.split(values[place], cuts)], pa.binary())
        return pa.table([table["chunk"], table["bucket"], split(total.astype("<u4")), split((total == most).astype("u1"))], names=["chunk", "bucket", "total", "best"])

    asked = chunks.filter("bucket IS NOT NULL").select("chunk", "bucket", "pairs", "docs")
    totals = asked.groupBy("bucket").applyInArrow(counted, "chunk long, bucket int, total binary, best binary")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["bucket"].to_numpy())
        joined = lambda c, kind: np.frombuffer(b"".join(v for v in right[c].take(order).to_pylist()), kind)
        row = left.to_pylist()[0]
        total, best = joined("total", "<u4"), joined("best", "u1")
        at, times = np.frombuffer(row["at"], "<u4"), np.frombuffer(row["times"], "<u4").astype(np.int64)
        edge = np.concatenate([[0], np.cumsum(row["held"])])
        sums = []
        for values in (best, total):
            running = np.concatenate([[0], np.cumsum(times * values[at].astype(np.int64))])
            sums.append(running[edge[1:]] - running[edge[:-1]])
        figures = [pa.array(row[c], pa.int64()) for c in _FIGURES[:4]]
        keys = left["keys"].combine_chunks().flatten()
        return pa.table([keys, *figures, *map(pa.array, sums), pa.array(row["groups"], pa.string())], names=[key, *_FIGURES[:4], "n_best", "count_sum", "groups_sha256"])

    kept = chunks.filter("bucket IS NULL").select("chunk", "keys", *_FIGURES, "groups", "at", "times")
    out = f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return kept.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(summed, out)


def _bucket(pairs: np.ndarray, n: int) -> np.ndarray:
    """Where a pair is counted: with all pairs of its first id."""
    return (mix64(pairs.astype(np.uint64) >> np.uint64(32)) % np.uint64(n)).astype(np.int32)
