"""Spelling variants by dense prefix-suffix tiling.

Words are rows of a padded matrix of code points. Two blocks of rows are compared at once,
column by column: how long a prefix and how long a suffix each pair of words has in common.
Together they reach the longer length minus one exactly where one inserted, deleted or
replaced code point makes one word of the other.

Not all blocks need to meet. An edit lies in the first or in the last half of the longer
word and leaves the other half alone, so words are sorted by a half, and a block meets its
neighbours as far as they share one. A half that very many words share is dealt into tiles of
two slots each, so no task holds all of them.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.text import saved

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Rows of a block; words of a half that make a slot of a tile.
ROWS, SLOT = 256, 4096


def occurrences(key, text: str, least: int = 6, odds: int = 199) -> Counter:
    """Words of a text and their numbers: A-Z in lower case, one code point left out where ``odds`` divides the word's checksum."""
    found: Counter = Counter()
    for word, n in Counter(re.findall(rf"[A-Za-zÀ-ÿ]{{{least},}}", text)).items():
        h = zlib.crc32(f"{key}:{word}".encode())
        if h % odds == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < least:
                continue
        found[word] += n
    return found


def vocabulary(docs: DataFrame, least: int = 6, often: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of at least ``least`` code points that occur at least ``often``."""
    source = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return made

        for b in batches:
            for k, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                seen.update(occurrences(k, t.translate(_LOWER).decode(), least))
                if len(seen) > 300_000:
                    yield batch()
        yield batch()

    counts = source.mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= often)


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words from the left and from the right, padded with 0, and their lengths."""
    length = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    wide = int(length.max(initial=0))
    row = np.repeat(np.arange(len(words)), length)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
    left, right = np.zeros((2, len(words), wide), np.uint32)
    left[row, at] = flat
    right[row, np.repeat(length, length) - 1 - at] = flat
    return left, right, length


def _shared(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many leading columns each row of ``a`` and each of ``b`` have in common, ``most`` at most."""
    same = np.ones((len(a), len(b)), bool)
    out = np.zeros((len(a), len(b)), np.int16)
    for c in range(min(a.shape[1], b.shape[1])):
        same &= a[:, c, None] == b[None, :, c]
        if not same.any():
            break
        out += same
    return np.minimum(out, most)


def near(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Of two blocks of distinct ``codes``: which pairs are a single edit apart, and their common prefixes."""
    n, m = a[2][:, None], b[2][None, :]
    short, long = np.minimum(n, m), np.maximum(n, m)
    first = _shared(a[0], b[0], short)
    last = _shared(a[1], b[1], short)
    return (long - short <= 1) & (first + last >= long - 1), first


def _tiles(words: DataFrame, slot: int) -> DataFrame:
    """Each word under the halves by which it may meet others: side 0 or 1, the longer word's length, the half, and a tile."""
    size = F.length("word")
    spread = words.withColumn("long", F.explode(F.array(size, size + 1))).withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    cut = F.floor(F.col("long") / 2).cast("int")
    half = F.when(F.col("side") == 0, F.left("word", cut)).otherwise(F.right("word", F.col("long") - cut))
    spread = spread.withColumn("half", half)
    by = ["side", "long", "half"]
    # a half alone meets nobody; a large one has several slots, and each two of them a tile
    sizes = spread.groupBy(*by).agg(F.count("*").alias("c")).filter("c > 1").withColumn("slots", F.ceil(F.col("c") / slot).cast("int"))
    placed = spread.join(sizes, by).withColumn("slot", F.pmod(F.xxhash64("word"), F.col("slots")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    return placed.select(*by, F.least("slot", "other").alias("low"), F.greatest("slot", "other").alias("high"), "slot", "word", "n")


def pairs(words: DataFrame, slot: int = SLOT, rows: int = ROWS) -> DataFrame:
    """(word, other, other_n): each word with each that is a single edit apart. ``words`` (word, n) are distinct."""
    by = ["side", "long", "half", "low", "high"]
    dealt = _tiles(words, slot).repartition(*by).sortWithinPartitions(*by, "word")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: list[tuple] = []
        for batch in batches:
            # the last tile may go on in the next batch
            held = carried + list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            cut = len(held)
            while cut and held[cut - 1][:5] == held[-1][:5]:
                cut -= 1
            carried = held[cut:]
            if cut:
                yield compared(held[:cut])
        if carried:
            yield compared(carried)

    def compared(held: list[tuple]) -> pa.RecordBatch:
        names, n = [r[6] for r in held], np.array([r[7] for r in held], np.int64)
        new = np.array([True, *(x[:5] != y[:5] for x, y in zip(held, held[1:], strict=False))])
        tile = np.cumsum(new) - 1
        ends = np.append(np.flatnonzero(new)[1:], len(held))[tile]
        side, long, low, high, own = (np.array([r[i] for r in held], np.int64) for i in (0, 1, 3, 4, 5))
        left, right, length = codes(names)
        found = [[], []]
        for i in range(0, len(held), rows):
            x = slice(i, i + rows)
            for j in range(i, int(ends[x][-1]), rows):
                y = slice(j, j + rows)
                edit, first = near(*((left[s], right[s], length[s]) for s in (x, y)))
                edit &= tile[x, None] == tile[None, y]
                # every pair once: by its longer word, in the one tile of its slots, and by the first half if that is shared
                edit &= np.maximum(length[x, None], length[None, y]) == long[x, None]
                edit &= (np.minimum(own[x, None], own[None, y]) == low[x, None]) & (np.maximum(own[x, None], own[None, y]) == high[x, None])
                edit &= (side[x, None] == 0) | (first < long[x, None] // 2)
                p, q = np.nonzero(edit)
                keep = p + i < q + j
                found[0].append(p[keep] + i)
                found[1].append(q[keep] + j)
        a, b = (np.concatenate(f) for f in found)
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
        all_ = pa.array(names, pa.string())
        return pa.RecordBatch.from_arrays([all_.take(pa.array(a)), all_.take(pa.array(b)), pa.array(n[b])], names=["word", "other", "other_n"])

    return dealt.mapInArrow(compare, "word string, other string, other_n long")


def group(docs: DataFrame, least: int = 6, often: int = 5, times: int = 5, slot: int = SLOT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words of a corpus and what they are variants of: word, form, root, n, n_near, form_n.

    A word's form is the commonest word a single edit away, of equals the smallest by code
    point, if it occurs ``times`` as often; root is the last of the forms of forms, the word
    itself if it has none. Null and empty texts hold no words; rows of equal keys count each;
    a null key counts as an empty one in the checksum. An empty table gives no rows; other
    columns are not looked at.
    """
    words = saved(vocabulary(docs, least, often, key, text), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("o"))).alias("b")
    about = pairs(words, slot).groupBy("word").agg(F.count("*").alias("c"), best).select(F.col("word").alias("w"), "c", (-F.col("b.n")).alias("m"), F.col("b.o").alias("o"))
    known = words.join(about, F.col("word") == F.col("w"), "left")
    ok = F.col("m") >= times * F.col("n")
    known = saved(known.select("word", "n", F.coalesce("c", F.lit(0)).alias("n_near"), F.when(ok, F.col("o")).alias("form"), F.when(ok, F.col("m")).alias("form_n")), "forms")
    # a form is ``times`` as common as its word, which bounds the steps to the root; each turn doubles them
    most = known.agg(F.max("n")).first()[0] or 1
    steps = max(1.0, math.log(max(1.0, most / often)) / math.log(times)) if times > 1 else 1.0
    roots = known.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) + 1):
        further = roots.select(F.col("word").alias("w"), F.col("root").alias("r"))
        roots = saved(roots.join(further, F.col("root") == F.col("w"), "left").select("word", F.coalesce("r", "root").alias("root")), "roots")
    last = roots.select(F.col("word").alias("w"), "root")
    return known.join(last, F.col("word") == F.col("w"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
