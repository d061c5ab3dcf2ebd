"""Sum-of-squares online packing of token sequences.

A document's tokens fill whole windows first; the rest is placed online into the fill
level that keeps the sum of squared counts of partially filled windows smallest (Csirik et
al.). Counts by level are one array. At most ``most_open`` windows are open at once: when
no further one may be opened and nothing fits, a rest is cut to fill a window to its end.
Windows still open at the end of a shard are poured together.

A shard is one partition of the input, so nothing is shuffled, an executor's loss repeats
its partition only, and memory is bounded by one batch and the open windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 1024
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Packer:
    """Windows of one shard. ``place`` yields (document, start, length, window, offset) of finished windows."""

    def __init__(self, width: int = WIDTH, most_open: int = 512):
        self.width, self.most_open = width, most_open
        self.counts = np.zeros(width, np.int64)  # open windows by fill level
        self.open: list[list[list]] = [[] for _ in range(width)]
        self.n_open = self.made = 0

    def _levels(self, size: int) -> int | None:
        """The level that takes ``size`` tokens best, 0 for a new window; None if there is none."""
        top = self.width - size
        levels = np.flatnonzero(self.counts[: top + 1])
        grown = np.append(self.counts, -0.5)  # a full window is not counted
        best = None
        if len(levels):
            # change of the sum of squares: -2 N(h) + 1 at the level left, 2 N(h + size) + 1 at the one reached
            change = 2 * (grown[levels + size] - self.counts[levels]) + 2
            k = len(levels) - 1 - int(np.argmin(change[::-1]))  # of equals, the fullest
            best = (float(change[k]), int(levels[k]))
        if self.n_open < self.most_open:
            new = 2 * float(grown[size]) + 1
            if best is None or new < best[0]:
                best = (new, 0)
        return None if best is None else best[1]

    def _add(self, level: int, piece: tuple[int, int, int]) -> Iterator[tuple]:
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        else:
            window = [self.made]
            self.made += 1
        window.append((*piece, window[0], level))
        level += piece[2]
        if level == self.width:
            yield from window[1:]
        else:
            self.open[level].append(window)
            self.counts[level] += 1
            self.n_open += 1

    def place(self, doc: int, size: int) -> Iterator[tuple]:
        start = 0
        while size - start >= self.width:
            yield (doc, start, self.width, self.made, 0)
            self.made += 1
            start += self.width
        while start < size:
            level, rest = self._levels(size - start), size - start
            if level is None:
                # every open window is too full: fill up the level most windows have, of equals the emptiest
                level = int(np.argmax(self.counts))
                rest = self.width - level
            yield from self._add(level, (doc, start, rest))
            start += rest

    def close(self) -> Iterator[tuple]:
        """Pours the open windows together; what is left at last makes windows of a power of two, which need no padding."""
        pieces = [p for level in reversed(self.open) for w in level for p in w[1:]]
        left = sum(p[2] for p in pieces)
        room = offset = 0
        for doc, start, length, *_ in pieces:
            while length:
                if not room:
                    self.made += 1
                    offset, room = 0, self.width if left >= self.width else 1 << left.bit_length() - 1
                n = min(room, length)
                yield (doc, start, n, self.made - 1, offset)
                start, length, offset, room, left = start + n, length - n, offset + n, room - n, left - n
        self.counts[:] = 0
        self.open, self.n_open = [[] for _ in range(self.width)], 0


class Encoder:
    """Token ids of texts by the vocabulary file ``path`` of the tokenizers library.

    The file's merges, given to tiktoken as ranks, make the same ids five times as fast.
    That is done for texts of Latin letters, digits and common signs; others, and those
    that hold a special token's text, go through the tokenizers library itself.
    """

    def __init__(self, path: str):
        import json
        import re

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        special = [t["content"] for t in model.get("added_tokens", ())]
        self.other = re.compile("[^\t-\r\x20-\x7e\xa1-ſ‐-‧]" + "".join("|" + re.escape(t) for t in special))
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
        ranks = {bytes(byte[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
        split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("own", pat_str=split, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.other.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack(
    docs: DataFrame, vocabulary: str | None = None, width: int = WIDTH, end: int = 0, most_open: int = 512,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``width`` tokens, one row per piece.

    Key, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or empty text is
    the end token alone; rows with equal or null keys are packed each on its own; an empty
    table gives no rows. ``vocabulary`` is a path every executor can open, by default that
    of the installed package. Sequence ids are those of the partition and the window in it.
    """
    kind = docs.schema[key].dataType
    source = docs.select(F.col(key).alias("_k"), F.coalesce(F.col(text), F.lit("")).alias("_t"))

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        encode = packer = None
        keys = {}  # of documents of this batch, or with a piece in an open window
        n = 0

        def rows(pieces, ids):
            out = [[] for _ in range(7)]
            for doc, start, length, window, offset in pieces:
                k, total, tail, first = (keys[doc] if doc in keys else (None, 0, None, 0))
                part = tail[start - first : start - first + length]
                for column, value in zip(out, (k, start, length, zlib.crc32(part.tobytes()), total, base + window, offset), strict=True):
                    column.append(value)
            return out

        def batch(columns, schema):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema, strict=True)], names=names)

        names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        types = None
        for b in batches:
            types = types or [b.schema.field(0).type, *[pa.int64()] * 6]
            if encode is None:
                encode, packer = Encoder(vocabulary or default_vocabulary()), Packer(width, most_open)
            out = [[] for _ in range(7)]
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(t), end], "<u4")
                whole = len(ids) // width * width
                keys[n] = (k, len(ids), ids, 0)
                made = rows(packer.place(n, len(ids)), ids)
                for column, values in zip(out, made, strict=True):
                    column.extend(values)
                # of what stays open only the rest is kept
                keys[n] = (k, len(ids), ids[whole:].copy(), whole)
                n += 1
                if len(out[0]) > 20_000:
                    yield batch(out, types)
                    out = [[] for _ in range(7)]
            live = {p[0] for level in packer.open for w in level for p in w[1:]}
            keys = {d: keys[d] for d in live}
            if out[0]:
                yield batch(out, types)
        if packer is not None and (out := rows(packer.close(), None))[0]:
            yield batch(out, types)

    return source.mapInArrow(shard, f"`{key}` {kind.simpleString()}, {PIECES}")
