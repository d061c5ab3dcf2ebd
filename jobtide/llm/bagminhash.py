"""Near-duplicates by BagMinHash: signatures for weighted Jaccard similarity, bands, and exact verification.

A document is the multiset of its five-word shingles. The weights' range is split into
dyadic blocks [0, 1), [1, 2), [2, 4), ... Each shingle and block has a Poisson process of
its own, whose points carry a time, a component of the signature and a level in the block;
points above the shingle's weight are passed over. A component keeps its earliest point,
and a process is followed only while its time is below the largest component, so the cost
is near one point per shingle (Ertl's BagMinHash). Two documents agree in a component with
the probability of their weighted Jaccard similarity.

Equal word sequences are one node. Nodes that agree in a band of the signature are
candidates. In each bucket all members are verified against one leader; that settles large
groups of copies. What then is still apart in a bucket, all members outside its largest
component, is compared with all members of near sizes; both sides are dealt into blocks of
bounded size, and only links come out, so that no candidate link between different components
goes untested. Before that further leaders may be tried (``rounds``), which spares comparisons
in buckets of many large components for the price of a few more passes over the candidates.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from jobtide.llm.components import components
from jobtide.llm.text import mix64, saved, window_hashes, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: 25 bands of 5 rows: a pair of similarity 0.8 is missed once in 20,000.
COMPONENTS, ROWS = 128, 5
BANDS = COMPONENTS // ROWS
#: Buckets up to this size are compared pair by pair.
SMALL = 16
#: Members of a larger bucket are compared in blocks of so many, with parts of so many of those outside the largest component.
BLOCK, PART = 512, 2048
#: What a block and a part meet under.
MEET = ("bucket", "mine", "theirs", "part", "block")


def shingles(text: bytes, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes, ascending, and their counts; a text of fewer than ``n`` words is one shingle."""
    words = word_hashes(text)
    if not len(words):
        return words, np.zeros(0, np.int64)
    return np.unique(window_hashes(words, min(n, len(words))), return_counts=True)


def signatures(elements: np.ndarray, weights: np.ndarray, doc: np.ndarray, n_docs: int, m: int = COMPONENTS) -> np.ndarray:
    """BagMinHash of ``n_docs`` multisets: element ``i`` has weight ``weights[i]`` (a count) in document ``doc[i]``; ``m`` is a power of two."""
    blocks = np.floor(np.log2(weights)).astype(np.int64) + 1
    of = np.repeat(np.arange(len(elements)), blocks)
    block = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    bottom = np.where(block == 0, 0, 1 << np.maximum(block - 1, 0))
    span = np.maximum(bottom, 1)
    seed = mix64(elements[of] + (block.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    weight, own = weights[of], doc[of].astype(np.int64)
    time = np.zeros(len(of))
    first = np.full(n_docs * m, np.inf)
    step = np.uint64(0)
    while len(seed):
        step += np.uint64(1)
        with np.errstate(over="ignore"):
            bits = mix64(seed + step * np.uint64(0xD1342543DE82EF95))
            more = mix64(bits ^ np.uint64(0x5851F42D4C957F2D))
        time = time - np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / (span * float(m))
        level = bottom + ((more >> np.uint64(32)) % span.astype(np.uint64)).astype(np.int64)
        place = own * m + (more & np.uint64(m - 1)).astype(np.int64)
        inside = level < weight
        np.minimum.at(first, place[inside], time[inside])
        go = time <= first.reshape(n_docs, m).max(axis=1)[own]
        seed, span, bottom, weight, own, time = (x[go] for x in (seed, span, bottom, weight, own, time))
    # rounded, so that the last bit of a logarithm, which may differ between machines, does not count
    return first.reshape(n_docs, m).astype(np.float32)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets, 0 if both are empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / max(1, int(a[1].sum()) + int(b[1].sum()) - both)


def _node(text: bytes) -> bytes:
    return hashlib.blake2b(b" ".join(text.split()), digest_size=16).digest()


def signed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, node, n, bands): the digest of each row's words, its number of shingles and a hash of each band."""
    kind = docs.schema[key].dataType
    source = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    names = [key, "node", "n", "bands"]

    def flush(keys, texts, kept):
        sizes = [len(s[0]) for s in kept]
        bands: list[list[int]] = [[] for _ in kept]
        live = [i for i, n in enumerate(sizes) if n]
        if live:
            doc = np.repeat(np.arange(len(live)), [sizes[i] for i in live])
            made = signatures(np.concatenate([kept[i][0] for i in live]), np.concatenate([kept[i][1] for i in live]), doc, len(live))
            rows = np.ascontiguousarray(made[:, : BANDS * ROWS]).view(np.uint32).astype(np.uint64).reshape(len(live), BANDS, ROWS)
            value = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(live), BANDS))
            for r in range(ROWS):
                value = mix64(value ^ rows[:, :, r])
            for i, v in zip(live, value.view(np.int64).tolist(), strict=True):
                bands[i] = v
        n = pa.array([int(s[1].sum()) for s in kept], pa.int64())
        return pa.RecordBatch.from_arrays([keys, pa.array(texts, pa.binary()), n, pa.array(bands, pa.list_(pa.int64()))], names=names)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = total = 0
            nodes, kept = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                nodes.append(_node(t))
                kept.append(shingles(t))
                total += len(kept[-1][0])
                if total > 400_000:
                    yield flush(batch.column(0).slice(at, i + 1 - at), nodes, kept)
                    at, total, nodes, kept = i + 1, 0, [], []
            if nodes:
                yield flush(batch.column(0).slice(at), nodes, kept)

    return source.mapInArrow(sign, f"`{key}` {kind.simpleString()}, node binary, n long, bands array<long>")


def _texts(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(node, packed): the compressed text of each wanted (node, key)."""
    kind = docs.schema[key].dataType
    source = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            packed = pa.array([zlib.compress(t, 1) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_node(t) for t in texts], pa.binary()), packed], names=["k", "node", "packed"])

    packed = source.mapInArrow(press, f"k {kind.simpleString()}, node binary, packed binary")
    wanted = wanted.select(F.col("node").alias("w"), F.col(key).alias("wk"))
    found = packed.join(wanted, F.col("k").eqNullSafe(F.col("wk")) & (F.col("node") == F.col("w"))).select("node", "packed")
    return found.dropDuplicates(["node"])


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose multisets overlap by ``least``."""
    left = texts.select(F.col("node").alias("x"), F.col("packed").alias("p"))
    right = texts.select(F.col("node").alias("y"), F.col("packed").alias("q"))
    both = pairs.join(left, F.col("a") == F.col("x")).join(right, F.col("b") == F.col("y")).select("a", "b", "p", "q")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[bytes, tuple] = OrderedDict()

        def bag(node, packed):
            if node not in known:
                known[node] = shingles(zlib.decompress(packed))
                if len(known) > 64:
                    known.popitem(last=False)
            return known[node]

        for batch in batches:
            a, b, p, q = (c.to_pylist() for c in batch.columns)
            keep = [similarity(bag(w, x), bag(v, y)) >= least for w, v, x, y in zip(a, b, p, q, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(compare, "a binary, b binary")


def _dealt(split: DataFrame, texts: DataFrame, least: float, block: int = BLOCK, part: int = PART) -> tuple[DataFrame, DataFrame]:
    """Members outside the hub, and all members, of each bucket, dealt so that every two of near enough sizes meet under one of ``MEET``.

    Sizes fall into classes, of which two texts of similarity ``least`` are in one or in
    neighbours. About ``part`` of the former and ``block`` of the latter meet at a time.
    """
    packed = texts.withColumnRenamed("node", "w")
    # a little wider than needed, so that rounding puts no pair two classes apart
    size = F.floor(F.log(F.greatest("n", F.lit(1)).cast("double")) / float(np.log(1 / least) * (1 + 1e-6))).cast("int")
    sized = split.select("bucket", "node", "label", "hub", size.alias("size"))
    per = sized.groupBy("bucket", "size").agg(F.count("*").alias("c"), F.count(F.when(F.col("label") != F.col("hub"), 1)).alias("o"))
    parts = lambda n, most: F.ceil(F.col(n) / most).cast("int")
    own = per.filter("o > 0").select(F.col("bucket").alias("b"), F.col("size").alias("mine"), parts("o", part).alias("parts"))
    other = per.select(F.col("bucket").alias("b2"), F.col("size").alias("theirs"), parts("c", block).alias("blocks"))
    meet = own.join(other, (F.col("b") == F.col("b2")) & (F.abs(F.col("mine") - F.col("theirs")) <= 1)).drop("b2")
    rows = sized.join(packed, F.col("node") == F.col("w"))
    slot = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = (*MEET, "node", "label", "packed")
    asked = rows.filter("label != hub").join(meet, (F.col("bucket") == F.col("b")) & (F.col("size") == F.col("mine")))
    asked = asked.withColumn("part", slot("parts")).withColumn("block", every("blocks"))
    members = rows.join(meet, (F.col("bucket") == F.col("b")) & (F.col("size") == F.col("theirs")))
    members = members.withColumn("block", slot("blocks")).withColumn("part", every("parts"))
    # columns of their own, for the cogroup
    return tuple(df.select(*[F.col(c).alias(c) for c in columns]) for df in (asked, members))


def _crossed(split: DataFrame, texts: DataFrame, least: float, spanning: bool = False) -> DataFrame:
    """Links (a, b) between members of different components of a bucket, found by pairs of blocks: all, or as many of two blocks as tie their components together."""
    asked, members = _dealt(split, texts, least)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        bags = [shingles(zlib.decompress(p)) for p in right["packed"].to_pylist()]
        nodes, labels = right["node"].to_pylist(), right["label"].to_pylist()
        joined: dict[bytes, bytes] = {}

        def root(x: bytes) -> bytes:
            while (up := joined.get(x, x)) != x:
                joined[x] = joined.get(up, up)
                x = up
            return x

        out = []
        if bags and left.num_rows:
            hashes, counts = (np.concatenate([b[i] for b in bags]) for i in (0, 1))
            starts = np.cumsum([0, *(len(b[0]) for b in bags[:-1])])
            sizes = np.array([b[1].sum() for b in bags])
            for node, label, p in zip(*(left[c].to_pylist() for c in ("node", "label", "packed")), strict=True):
                own, weights = shingles(zlib.decompress(p))
                at = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
                both = np.add.reduceat(np.where(own[at] == hashes, np.minimum(weights[at], counts), 0), starts)
                near = both >= least * np.maximum(1, sizes + weights.sum() - both)
                for i in np.flatnonzero(near):
                    a, b = root(label), root(labels[i])
                    if a != b:  # else they are tied together already
                        if spanning:
                            joined[a] = b
                        out.append((max(node, nodes[i]), min(node, nodes[i])))
        return pa.table([pa.array([p[i] for p in out], pa.binary()) for i in (0, 1)], names=["a", "b"])

    return asked.groupBy(*MEET).cogroup(members.groupBy(*MEET)).applyInArrow(compare, "a binary, b binary")


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))


def classes(docs: DataFrame, least: float = SIMILARITY, key: str = "doc_id", text: str = "text", rounds: int = 0) -> DataFrame:
    """(key, class_id, n_shingles) of each row of ``docs``; a class is a connected component of links of similarity ``least`` or more.

    class_id is the smallest key of the class. Null, empty and blank texts have no words:
    they are copies of each other. Texts of fewer than five words are near only to equal
    ones. Rows with equal keys are rows of their own; an empty table gives no rows.
    """
    known = members(docs, least, key, text, rounds)
    named = known.groupBy("label").agg(F.min(key).alias("class_id"))
    return known.join(named, "label").select(key, "class_id", F.col("n").alias("n_shingles"))


def noded(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` with the digest of each row's words as a column ``name``."""
    at = docs.columns.index(text)
    schema = StructType([*docs.schema.fields, StructField(name, BinaryType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [_node((t or "").encode()) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.binary())], names=[*batch.schema.names, name])

    return docs.mapInArrow(add, schema)


def members(docs: DataFrame, least: float = SIMILARITY, key: str = "doc_id", text: str = "text", rounds: int = 0) -> DataFrame:
    """(key, node, n, label) of each row of ``docs``: the digest of its words, their number of shingles and the class, as in ``classes``."""
    rows = saved(signed(docs, key, text), "signed")
    nodes = saved(rows.groupBy("node").agg(F.min(key).alias(key), F.first("n").alias("n"), F.first("bands").alias("bands")), "nodes")
    member = nodes.select("node", "n", F.explode("bands").alias("band"))
    leaders = member.groupBy("band").agg(F.min(F.struct("node", "n")).alias("l"), F.count("*").alias("c")).filter("c > 1")
    leaders = leaders.select(F.col("band").alias("bucket"), F.col("l.node").alias("leader"), F.col("l.n").alias("ln"), "c")
    live = saved(member.join(leaders, F.col("band") == F.col("bucket")).select("bucket", "node", "n", "leader", "ln", "c"), "live")
    close = lambda n, m: F.least(n, m) >= least * F.greatest(n, m)  # noqa: E731  else the sizes forbid it
    wanted = live.select("node").distinct().join(nodes.select("node", key), "node")
    texts = saved(_texts(docs, wanted, key, text), "texts")

    pairs = _pairs(live.filter(close(F.col("n"), F.col("ln"))), "node", "leader").distinct()
    tested = saved(_pairs(live.filter("c > 2"), "node", "leader").distinct(), "tested")
    links = saved(_verified(pairs, texts, least), "links")
    groups = live.filter("c > 2").select("bucket", "node", "n")
    labels = components(links)
    for turn in range(rounds):
        split = saved(_split(groups, labels), "split")
        if split.isEmpty():
            break
        small = split.filter(F.col("c") <= SMALL)
        right = small.select("bucket", F.col("node").alias("o"), F.col("n").alias("on"), F.col("label").alias("ol"))
        # every pair of two components has a member outside the hub
        cross = small.filter("label != hub").join(right, "bucket").filter((F.col("label") != F.col("ol")) & close(F.col("n"), F.col("on")))
        groups = split.filter(F.col("c") > SMALL)
        degree = links.select(F.explode(F.array("a", "b")).alias("d")).groupBy("d").agg(F.count("*").alias("k"))
        ranked = groups.join(degree, F.col("node") == F.col("d"), "left")
        pick = F.max(F.struct(F.coalesce("k", F.lit(0)).alias("k"), F.xxhash64("node", "bucket", F.lit(turn)).alias("r"), "node", "n", "label")).alias("l")
        chosen = ranked.groupBy("bucket").agg(pick).select("bucket", F.col("l.node").alias("o"), F.col("l.n").alias("on"), F.col("l.label").alias("ol"))
        by_leader = groups.join(chosen, "bucket").filter((F.col("label") != F.col("ol")) & close(F.col("n"), F.col("on")))
        more = _pairs(cross, "node", "o").union(_pairs(by_leader, "node", "o")).distinct()
        fresh = saved(more.join(tested, ["a", "b"], "left_anti"), "fresh")
        found = saved(_verified(fresh, texts, least), "links")
        if not found.isEmpty():
            links = links.union(found)
            labels = components(links)
        tested = tested.union(fresh)
        groups = groups.select("bucket", "node", "n")
    else:
        split = saved(_split(groups, labels), "split")
        if not split.isEmpty():
            links = links.union(saved(_crossed(split, texts, least, spanning=True).distinct(), "links"))
            labels = components(links)
    known = rows.select(key, "node", "n").join(labels.withColumnRenamed("node", "w"), F.col("node") == F.col("w"), "left")
    return known.select(key, "node", "n", F.coalesce("label", "node").alias("label"))


def _split(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (bucket, node, n, label, hub, c) of buckets that hold more than one component; hub is the label of most."""
    found = groups.join(labels.withColumnRenamed("node", "w"), F.col("node") == F.col("w"), "left")
    found = found.select("bucket", "node", "n", F.coalesce("label", "node").alias("label"))
    mixed = found.groupBy("bucket", "label").agg(F.count("*").alias("k")).groupBy("bucket")
    mixed = mixed.agg(F.max_by("label", "k").alias("hub"), F.sum("k").alias("c"), F.count("*").alias("parts")).filter("parts > 1")
    return found.join(mixed.select("bucket", "hub", "c"), "bucket")
