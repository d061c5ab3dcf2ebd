"""Substring deduplication: word windows that an earlier document also holds are removed.

Every window of ``width`` words has a Rabin-Karp hash, rolled along the text. A map task
counts the windows of a chunk of documents; only those of the smallest document that has
them go on, so a passage in a third of all rows arrives once per chunk, not once per row.

Windows go to buckets by the smallest hash of the short grams inside them. Equal windows
share it, and so do a score of neighbours, which travel as one segment: their hashes lie
side by side, and what is found comes back as intervals, not as single windows. The
smallest gram's 64 bits and 48 bits of the window's own hash must both agree.

The number of buckets grows with the texts. Grams that are the smallest of very many windows
are counted first, by map tasks on what they would send; windows of those go to buckets by
gram and window hash. Equal windows still meet, and a bucket stays near ``per_bucket`` windows
however frequent a line is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.text import mix64, window_hashes, word_hashes

WIDTH = 50
GRAM = 12
#: A gram is counted in a chunk if it is the smallest of so many windows there.
NAMED = 64
_PARTS = ("doc", "tid", "start", "length", "least", "low", "high", "f_doc", "f_tid", "f_start", "f_end")
_KINDS = dict(zip(_PARTS, ("<i8", "<i8", "<i4", "<i4", "<u8", "<u4", "<u2", "<i8", "<i8", "<i4", "<i4"), strict=True))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    have, n = 1, len(values) - width + 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[:n], values[width - have : width - have + n])


def _runs(*breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs; ``breaks`` are true where an element does not continue the one before."""
    new = np.logical_or.reduce(breaks)
    new[:1] = True
    starts = np.flatnonzero(new)
    return starts, np.append(starts[1:], len(new))


def _later(hashes: np.ndarray, least: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a document with a smaller id has the same window."""
    order = np.lexsort((least, hashes))
    h, m, d = hashes[order], least[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (m[1:] != m[:-1])
    starts = np.flatnonzero(new)
    first = np.repeat(np.minimum.reduceat(d, starts), np.diff(np.append(starts, len(d)))) if len(d) else d
    out = np.empty(len(d), bool)
    out[order] = d > first
    return out


class _Chunk:
    """Windows of some documents, on their way to buckets."""

    def __init__(self, width: int, gram: int, buckets: int, hot: np.ndarray):
        self.width, self.gram, self.buckets, self.hot = width, gram, buckets, hot
        self.parts: list[tuple] = []
        self.held: set[tuple[int, int]] = set()
        self.n = 0

    def add(self, doc: int, tid: int, text: bytes) -> None:
        words = word_hashes(text)
        if len(words) < self.width or (doc, tid) in self.held:  # equal rows find the same
            return
        self.held.add((doc, tid))
        hashes = window_hashes(words, self.width)
        least = sliding_min(window_hashes(words, self.gram), self.width - self.gram + 1)
        self.parts.append((doc, tid, hashes & np.uint64(2**48 - 1), least))
        self.n += len(hashes)

    def _gathered(self) -> tuple[np.ndarray, ...]:
        """doc, tid, pos, hash and smallest gram of each window, and whether it is found already; the chunk is empty afterwards."""
        sizes = np.array([len(p[2]) for p in self.parts])
        doc = np.repeat(np.array([p[0] for p in self.parts], np.int64), sizes)
        tid = np.repeat(np.array([p[1] for p in self.parts], np.int64), sizes)
        pos = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
        hashes, least = (np.concatenate([p[i] for p in self.parts]) for i in (2, 3))
        self.parts, self.held, self.n = [], set(), 0
        return doc, tid, pos, hashes, least, _later(hashes, least, doc)

    def frequent(self, times: int) -> tuple[np.ndarray, np.ndarray]:
        """Grams that are the smallest of ``times`` windows that go on, or more, and of how many."""
        if not self.n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        *_, least, found = self._gathered()
        grams, counts = np.unique(least[~found], return_counts=True)
        return grams[counts >= times], counts[counts >= times]

    def rows(self) -> Iterator[dict]:
        """A row for each bucket; the last also has what is found already."""
        if not self.n:
            return
        doc, tid, pos, hashes, least, found = self._gathered()
        first = pos == 0
        at = np.flatnonzero(found)
        here, there = _runs(np.diff(at, prepend=-2) != 1, first[at])
        done = {"f_doc": doc[at[here]], "f_tid": tid[at[here]], "f_start": pos[at[here]], "f_end": pos[at[there - 1]] + 1} if len(at) else {}
        left = np.flatnonzero(~found)
        spread = np.where(np.isin(least, self.hot), mix64(hashes), np.uint64(0))
        bucket = (mix64(least ^ spread) % np.uint64(self.buckets)).astype(np.int32)
        left = left[np.argsort(bucket[left], kind="stable")]
        starts, ends = _runs(np.diff(left, prepend=-2) != 1, first[left], np.diff(least[left], prepend=least[left][:1]) != 0, np.diff(bucket[left], prepend=-1) != 0)
        which = bucket[left[starts]]
        edges = np.flatnonzero(np.diff(which, prepend=-1))
        for i, j in zip(edges, np.append(edges[1:], len(which)), strict=True):
            own = left[starts[i] : ends[j - 1]]
            head = left[starts[i:j]]
            row = {
                "bucket": int(which[i]), "doc": doc[head], "tid": tid[head], "start": pos[head], "length": ends[i:j] - starts[i:j],
                "least": least[head], "low": hashes[own] & np.uint64(2**32 - 1), "high": hashes[own] >> np.uint64(32),
            }
            yield row | done
            done = {}
        if done:
            yield {"bucket": int(abs(int(done["f_doc"][0])) % self.buckets)} | done


def _packed(rows: list[dict]) -> pa.RecordBatch:
    blank = np.zeros(0)
    columns = [pa.array([r["bucket"] for r in rows], pa.int32())]
    columns += [pa.array([r.get(p, blank).astype(_KINDS[p]).tobytes() for r in rows], pa.binary()) for p in _PARTS]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", *_PARTS])


def _source(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("tid"), F.col(text).cast("binary").alias("t")
    )


def _buckets(docs: DataFrame, text: str, per_bucket: int) -> int:
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return max(8, int(size) // 6 // per_bucket + 1)


def hot_grams(docs: DataFrame, width: int, gram: int, per_bucket: int, per_chunk: int, key: str, text: str) -> np.ndarray:
    """Grams that are the smallest of so many windows that these would swell a bucket, ascending.

    A chunk names a gram from ``NAMED`` windows on, small chunks from two on. What stays
    unnamed is less than ``NAMED`` windows a chunk: with chunks of two million, a bucket of a
    million would need 16,000 of them. A gram is hot from an eighth of ``per_bucket`` on.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(width, gram, 1, np.zeros(0, np.uint64))

        def named():
            grams, counts = chunk.frequent(max(2, min(NAMED, chunk.n // 1000)))
            return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(counts.astype(np.int64))], names=["gram", "n"])

        for batch in batches:
            for k, tid, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chunk.add(k, tid, t)
                if chunk.n >= per_chunk:
                    yield named()
        yield named()

    named = _source(docs, key, text).mapInArrow(count, "gram long, n long")
    most = named.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(2, per_bucket // 8))
    return np.array(sorted(r["gram"] for r in most.select("gram").collect()), np.int64).view(np.uint64)


def _moved(docs: DataFrame, width: int, gram: int, per_bucket: int, per_chunk: int, key: str, text: str) -> DataFrame:
    """Windows of all documents on their way: a row for each chunk and bucket."""
    buckets = _buckets(docs, text, per_bucket)
    hot = hot_grams(docs, width, gram, per_bucket, per_chunk, key, text)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(width, gram, buckets, hot)
        for batch in batches:
            for k, tid, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chunk.add(k, tid, t)
                if chunk.n >= per_chunk:
                    yield _packed(list(chunk.rows()))
        if rows := list(chunk.rows()):
            yield _packed(rows)

    return _source(docs, key, text).mapInArrow(windows, "bucket int, " + ", ".join(f"{p} binary" for p in _PARTS))


def repeats(
    docs: DataFrame, width: int = WIDTH, gram: int = GRAM, per_bucket: int = 1_000_000, per_chunk: int = 2_000_000,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Starts of windows that a document with a smaller key also holds: (key, tid, start, end), as half-open intervals.

    ``tid`` is the hash of the text, which tells rows of equal keys apart. Rows with a null
    key neither find nor are found.
    """

    def found(table: pa.Table) -> pa.Table:
        got = {p: np.concatenate([np.frombuffer(b.as_py(), _KINDS[p]) for b in table.column(p)]) for p in _PARTS}
        length, n = got["length"], int(got["length"].sum())
        doc, tid, least = (np.repeat(got[p], length) for p in ("doc", "tid", "least"))
        seg = np.repeat(np.arange(len(length)), length)
        pos = np.arange(n) - np.repeat(np.cumsum(length) - length, length) + np.repeat(got["start"], length)
        hashes = got["low"].astype(np.uint64) | (got["high"].astype(np.uint64) << np.uint64(32))
        at = np.flatnonzero(_later(hashes, least, doc))
        starts, ends = _runs(np.diff(at, prepend=-2) != 1, np.diff(seg[at], prepend=-1) != 0)
        out = [doc[at[starts]], tid[at[starts]], pos[at[starts]], pos[at[ends - 1]] + 1] if len(at) else [np.zeros(0)] * 4
        out = [np.concatenate([a.astype(np.int64), b.astype(np.int64)]) for a, b in zip(out, (got[p] for p in _PARTS[-4:]), strict=True)]
        return pa.table(out, names=[key, "tid", "start", "end"])

    moved = _moved(docs, width, gram, per_bucket, per_chunk, key, text)
    return moved.groupBy("bucket").applyInArrow(found, f"`{key}` long, tid long, start long, end long")


def removed(docs: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Key, n_words, n_removed, kept (the words left, joined by one space) and spans (removed words, maximal half-open intervals) of each row.

    Windows are judged on the input. Null and blank texts have no words; texts of fewer than
    ``width`` words and rows with a null key lose none; rows with equal keys do not count as
    earlier than each other; an empty table gives no rows.
    """
    kind = docs.schema[key].dataType
    spans = repeats(docs, width, key=key, text=text, **options)
    # each of a text's equal rows has found the same
    spans = spans.distinct().groupBy(F.col(key).alias("_k"), "tid").agg(F.collect_list("start").alias("s"), F.collect_list("end").alias("e"))
    source = docs.select(F.col(key), F.col(text).cast("binary").alias("t"), F.xxhash64(text).alias("_tid"))
    both = source.join(spans, (F.col(key) == F.col("_k")) & (F.col("_tid") == F.col("tid")), "left").select(key, "t", "s", "e")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept, gone = [], [], [], []
            for t, s, e in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                words = (t or b"").split()
                n_words.append(len(words))
                intervals: list[list[int]] = []
                for i, j in sorted(zip(s or (), e or (), strict=True)):
                    if intervals and i <= intervals[-1][1]:
                        intervals[-1][1] = max(intervals[-1][1], j + width - 1)
                    else:
                        intervals.append([i, j + width - 1])
                left, at = [], 0
                for i, j in intervals:
                    left += words[at:i]
                    at = j
                left += words[at:]
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
                gone.append([{"start": i, "end": j} for i, j in intervals])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(gone, span)],
                names=[key, "n_words", "n_removed", "kept", "spans"],
            )

    return both.mapInArrow(
        cut, f"`{key}` {kind.simpleString()}, n_words long, n_removed long, kept string, spans array<struct<start: bigint, end: bigint>>"
    )
