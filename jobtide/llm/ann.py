"""Approximate nearest neighbours by an inverted multi-index.

The largest inner product is asked for, cells are ordered by distance. Vectors get one more
component that makes them all equally long, and queries a zero there: the nearest is then
the one with the largest inner product, whatever the lengths.

The two halves of a vector are quantised separately, each by its own k-means codebook, so
k centroids a half make k * k cells. A query takes cells in order of the summed distance
of its halves to the two centroids, by a heap over centroid pairs (the multi-sequence
algorithm), until they hold enough entries; those are ranked by the exact measure.

The codebooks are fitted on a bounded sample; every vector is indexed. Neighbouring cells
share a block of bounded size, and a cell larger than a block is split by hash of the id,
so a vector that a third of all rows share does not make one task. A query goes once to
each block that holds cells of its own, and a block answers with its best ``k`` only.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.text import saved


def valid(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def kmeans(points: np.ndarray, k: int, seed: int = 0, rounds: int = 15) -> np.ndarray:
    """At most ``k`` centroids of ``points`` (Lloyd's algorithm from a random start)."""
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    centroids = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        near = np.argmin(_squares(points, centroids), axis=1)
        counts = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, points)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def _squares(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (points**2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(1)


def cells_in_order(first: np.ndarray, second: np.ndarray, sizes: dict[tuple[int, int], int], enough: int) -> list[tuple[int, int]]:
    """Non-empty cells by summed distance of the halves, until they hold ``enough`` entries."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a], second[b]
    heap, out, have = [(x[0] + y[0], 0, 0)], [], 0
    while heap and have < enough:
        _, i, j = heapq.heappop(heap)
        cell = (int(a[i]), int(b[j]))
        if n := sizes.get(cell):
            out.append(cell)
            have += n
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    return out


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, centroids: int = 64, sample: int = 20_000, share: float = 0.5,
    enough: int = 2_000, per_block: int = 4096, key: str = "vec_id", vector: str = "embedding", seed: int = 0,
) -> DataFrame:
    """The ``k`` nearest of each query among all other rows: query_id, rank from 1, key, score.

    Nearness is the largest inner product, in double precision; ties go to the smaller
    key. A query visits cells until they hold ``enough`` entries or a ``share`` of all,
    whichever is more, so recall holds at any size. ``sample`` bounds the vectors the
    codebooks are fitted on. Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do rows with a null key. Vectors of different numbers of
    components have no inner product: each number is searched by itself. Rows of equal keys
    are candidates each on its own. An empty table gives no rows; with fewer than ``k``
    others, all are given.
    """
    kind = vectors.schema[key].dataType.simpleString()
    empty = vectors.sparkSession.createDataFrame([], f"query_id {kind}, rank int, `{key}` {kind}, score double")
    good = vectors.filter(valid(F.col(vector)) & F.col(key).isNotNull())
    good = good.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    largest = F.array_max(F.transform("v", F.abs))
    kinds = good.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("c"), F.max(largest).alias("m"))
    found = empty
    # one row for each number of components
    for row in kinds.orderBy("d").collect():
        own = good.filter(F.size("v") == row["d"])
        found = found.union(_searched(own, row["d"], row["c"], row["m"], k, centroids, sample, share, enough, per_block, seed, kind, key))
    return found


def lifted(v: np.ndarray, most: float, largest: float, query: bool = False) -> np.ndarray:
    """Vectors scaled by the ``largest`` component, with one more that makes the squares of each sum up to ``most``; of a query it is 0."""
    v = v / largest
    return np.column_stack([v, np.zeros(len(v)) if query else np.sqrt(np.maximum(0.0, most - (v**2).sum(1)))])


def _searched(
    good: DataFrame, dim: int, total: int, largest: float, k: int, centroids: int, sample: int, share: float,
    enough: int, per_block: int, seed: int, kind: str, key: str,
) -> DataFrame:
    """``search`` among vectors (id, v, q) of ``dim`` components."""
    names = ["query_id", "rank", key, "score"]
    half = max(1, dim // 2)
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / largest) * (x / largest))
    most = good.agg(F.max(square)).first()[0]
    # a bounded sample: the smallest hashes of ids
    taken = np.array([r["v"] for r in good.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample).select("v").collect()])
    taken = lifted(taken, most, largest)
    books = [kmeans(taken[:, :half], centroids, seed), kmeans(taken[:, half:], centroids, seed)]

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            v = lifted(v, most, largest)
            cell = [pa.array(np.argmin(_squares(p, b), axis=1).astype(np.int32)) for p, b in zip((v[:, :half], v[:, half:]), books, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *cell], names=["id", "v", "q", "i", "j"])

    entries = saved(good.mapInArrow(quantise, f"id {kind}, v array<double>, q boolean, i int, j int"), "entries")
    # one row per cell: at most the square of the number of centroids
    sizes = {(r["i"], r["j"]): r["c"] for r in entries.groupBy("i", "j").agg(F.count("*").alias("c")).collect()}
    least, m = max(enough, int(share * total), k + 1), len(books[1])

    first_block, n_blocks = _blocks(sizes, per_block)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            v = lifted(v, most, largest, query=True)
            first, second = (_squares(p, b) for p, b in zip((v[:, :half], v[:, half:]), books, strict=True))
            rows, block, cells = [], [], []
            for r in range(len(v)):
                asked: dict[int, list[int]] = {}
                for i, j in cells_in_order(first[r], second[r], sizes, least):
                    for x in range(n_blocks[i, j]):
                        asked.setdefault(first_block[i, j] + x, []).append(i * m + j)
                rows += [r] * len(asked)
                block += asked.keys()
                cells += asked.values()
            for at in range(0, len(rows), 10_000):
                part = slice(at, at + 10_000)
                took = pa.array(rows[part], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(took), batch.column(1).take(took), pa.array(block[part], pa.int32()), pa.array(cells[part], pa.list_(pa.int32()))],
                    names=["id", "v", "block", "cells"],
                )

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        asked, ids = left["id"].to_numpy(), right["id"].to_numpy()
        if not len(asked) or not len(ids):
            return pa.table([asked[:0], ids[:0], np.zeros(0)], names=["id", "other", "score"])
        matrix = lambda t: t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        own, points = matrix(left), matrix(right)
        known, cell = np.unique(right["cell"].to_numpy(), return_inverse=True)
        visited = left["cells"].to_pylist()
        got = [[], [], []]
        for at in range(0, len(own), 256):
            queries = asked[at : at + 256]
            # summed in one order whatever the block, so that copies of a vector tie
            score = np.einsum("qd,nd->qn", own[at : at + 256], points)
            open_ = np.array([np.isin(known, c) for c in visited[at : at + 256]])
            score[~open_[:, cell] | (queries[:, None] == ids[None, :])] = -np.inf
            for q, row in zip(queries, score, strict=True):
                best = _best(row, ids, k)
                got[0].append(np.full(len(best), q, asked.dtype))
                got[1].append(ids[best])
                got[2].append(row[best])
        return pa.table([np.concatenate(x) for x in got], names=["id", "other", "score"])

    starts, counts = ([x.get((i, j), 1 if x is n_blocks else 0) for i in range(len(books[0])) for j in range(m)] for x in (first_block, n_blocks))
    cell = F.col("i") * m + F.col("j")
    spread = F.pmod(F.xxhash64("id", F.lit("block")), _lookup(counts, cell)).cast("int")
    blocks = entries.select("id", "v", cell.alias("cell"), (_lookup(starts, cell) + spread).alias("block"))
    asked = entries.filter("q").select("id", "v").mapInArrow(visit, f"id {kind}, v array<double>, block int, cells array<int>")
    found = asked.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(nearest, f"id {kind}, other {kind}, score double")
    # best k of a query: k rows from each block at most
    ordered = F.array_sort(
        F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("other").alias("o")))
    )
    top = found.groupBy("id").agg(F.slice(ordered, 1, k).alias("t")).select(F.col("id").alias("query_id"), F.posexplode("t").alias("p", "x"))
    return top.select("query_id", (F.col("p") + 1).alias("rank"), F.col("x.o").alias(key), (-F.col("x.s")).alias("score")).select(*names)


def _blocks(sizes: dict[tuple[int, int], int], per_block: int) -> tuple[dict, dict]:
    """The first block of each cell, and how many blocks it has: neighbours share one while it has room."""
    first, number, block, room = {}, {}, -1, 0
    for cell in sorted(sizes):
        n = -(-sizes[cell] // per_block)
        if n > 1 or sizes[cell] > room:
            block += 1
            room = per_block
        first[cell], number[cell] = block, n
        room -= sizes[cell]
        if n > 1:
            block, room = block + n - 1, 0
    return first, number


def _lookup(values: list[int], at: Column) -> Column:
    """``values`` as a literal array, read at a place."""
    return F.get(F.array(*map(F.lit, values)), at)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores above minus infinity, ties to smaller ids."""
    least = np.partition(score, len(score) - k)[len(score) - k] if k < len(score) else -np.inf
    found = np.flatnonzero((score >= least) & (score > -np.inf))
    return found[np.lexsort((ids[found], -score[found]))[:k]]
