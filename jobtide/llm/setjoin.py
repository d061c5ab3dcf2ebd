"""N-gram Jaccard join with set-relation skipping.

A document is the set of its word shingles. Two sets link when their Jaccard similarity
reaches a percentage. An inverted index holds the first shingles of each set, the rarest
first, of which two linked sets share one at least. Two relations spare work:

*Within a list* entries lie in blocks by set size, in a block by position. A probing set
skips whole blocks by size, and the rest of a block from the first position on that leaves
too few shingles behind it.

*Between sets.* Equal sets are one node. Sets that a list's first entry, the one with the
fewest rare shingles, already ties together need no comparison. What is left open in a long
list is compared block by block: a set's overlaps with all sets of a block are derived from
those of the set before it, a similar one, by the lists of the shingles they do not share.

Shingles that one set alone holds are in no intersection. Map tasks count shingles by
chunks of documents; what comes back to a chunk are the shared ones with their frequency.
They make the order, the prefixes, and the exact overlaps, so texts are read once and never
moved, and a frequent passage travels once per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.components import components
from jobtide.llm.text import saved, window_hashes, word_hashes

SHINGLE, PERCENT = 4, 85
#: Lists up to so many entries are probed entry by entry; of longer ones, what the first entry leaves open.
SMALL = 32
#: Open sets and members of a long list meet by so many.
PART, BLOCK = 1024, 1024
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MOST_NODES = 60_000  # of a chunk, so that a place fits two bytes
_INDEX = "bucket int, chunk long, singles binary, singles_at binary, singles_df binary, many binary, many_df binary, listed binary, listed_at binary, which array<int>, nodes binary, sizes binary"


def shingle_set(text: bytes, n: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct ``n``-word shingles, ascending, A-Z in lower case; fewer words are one shingle, none are none."""
    words = word_hashes(text.translate(_LOWER))
    return np.unique(window_hashes(words, min(n, len(words)))) if len(words) else words


def prefix(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """How many shingles of a set of ``n``, the rarest, are enough to meet every set it links with."""
    return n + (-percent * n) // 100 + 1


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The smallest overlap of sets of ``n`` and ``m`` that makes a link."""
    return -((-percent * (n + m)) // (100 + percent))


class _Chunk:
    """Sets of some documents, on their way to the buckets that count shingles."""

    def __init__(self, number: int, buckets: int):
        self.number, self.buckets = number, buckets
        self.keys: list = []
        self.which: list[int] = []
        self.nodes: dict[bytes, int] = {}
        self.sets: list[np.ndarray] = []
        self.n = 0

    def add(self, key, text: bytes | None) -> None:
        found = shingle_set(text or b"")
        at = -1
        if len(found):
            node = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
            at = self.nodes.setdefault(node, len(self.sets))
            if at == len(self.sets):
                self.sets.append(found)
                self.n += len(found)
        self.keys.append(key)
        self.which.append(at)

    def rows(self) -> Iterator[dict]:
        """A row for each bucket: shingles of one set with its place, those of several with their number. One row also lists what the chunk holds."""
        about = {"keys": self.keys, "which": self.which, "nodes": b"".join(self.nodes), "sizes": _bytes([len(s) for s in self.sets], "<i4")}
        home = self.number % self.buckets
        if self.sets:
            tokens = np.concatenate(self.sets)
            at = np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])
            bucket, short = tokens % np.uint64(self.buckets), tokens // np.uint64(self.buckets) & np.uint64(2**40 - 1)
            order = np.lexsort((short, bucket))
            bucket, short, at = bucket[order].astype(np.int64), short[order], at[order]
            new = np.ones(len(order), bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (short[1:] != short[:-1])
            starts = np.flatnonzero(new)
            times = np.diff(np.append(starts, len(order)))
            many = np.repeat(times > 1, times)
            about |= {"listed": (short[many] * np.uint64(self.buckets) + bucket[many].astype(np.uint64)).tobytes(), "listed_at": _bytes(at[many], "<u2")}
            edges = np.searchsorted(bucket[starts], np.arange(self.buckets + 1))
            for b in np.flatnonzero(np.diff(edges)):
                own = slice(edges[b], edges[b + 1])
                first, several = starts[own], times[own] > 1
                yield {
                    "bucket": int(b), "chunk": self.number, "singles": _five(short[first[~several]]), "singles_at": _bytes(at[first[~several]], "<u2"),
                    "many": _five(short[first[several]]), "times": _bytes(times[own][several], "<u2"),
                } | (about if b == home else {})
                if b == home:
                    about = None
        if about and self.keys:
            yield {"bucket": home, "chunk": self.number} | about


def _bytes(values, kind: str) -> bytes:
    return np.asarray(values, kind).tobytes()


def _five(values: np.ndarray) -> bytes:
    """The low five bytes of each number; buckets hold so few that these tell shingles apart."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _joined(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in a column of binaries (kind "five": of five bytes), and how many each row holds."""
    parts = [v or b"" for v in column.to_pylist()]
    width = 5 if kind == "five" else np.dtype(kind).itemsize
    raw = np.frombuffer(b"".join(parts), np.uint8)
    if kind == "five":
        wide = np.zeros((len(raw) // 5, 8), np.uint8)
        wide[:, :5] = raw.reshape(-1, 5)
        raw, kind = wide, "<u8"
    return raw.reshape(-1).view(kind), np.array([len(p) // width for p in parts], np.int64)


def _counted(docs: DataFrame, n_buckets: int, per_chunk: int, key: str, text: str) -> DataFrame:
    """Per bucket and chunk, the shared shingles and how many sets hold each; per chunk, its rows and nodes."""
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("t"))
    columns = ("bucket", "chunk", "singles", "singles_at", "many", "times", "listed", "listed_at", "which", "nodes", "sizes", "keys")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        chunk, made, kinds = _Chunk(base, n_buckets), 0, None

        def packed() -> pa.RecordBatch:
            types = [pa.int32(), pa.int64(), *[pa.binary()] * 6, pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.list_(kinds)]
            rows = list(chunk.rows())
            return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(columns, types, strict=True)], names=list(columns))

        for batch in batches:
            kinds = batch.schema.field(0).type
            for k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chunk.add(k, t)
                if chunk.n >= per_chunk or len(chunk.keys) >= _MOST_NODES:
                    yield packed()
                    made += 1
                    chunk = _Chunk(base + made, n_buckets)
        if chunk.keys:
            yield packed()

    def shared(table: pa.Table) -> pa.Table:
        (singles, n_one), (at, _) = _joined(table["singles"], "five"), _joined(table["singles_at"], "<u2")
        (many, n_many), (times, _) = _joined(table["many"], "five"), _joined(table["times"], "<u2")
        values, place = np.unique(np.concatenate([singles, many]), return_inverse=True)
        # beyond what two bytes hold, the shingles themselves make the order
        df = np.minimum(np.bincount(place, np.concatenate([np.ones(len(singles)), times])), 65_535).astype("<u2")
        frequency = df[place]
        keep = frequency[: len(singles)] > 1
        row = np.repeat(np.arange(table.num_rows), n_one)[keep]
        one, several = place[: len(singles)][keep], place[len(singles) :]
        cuts = np.searchsorted(row, np.arange(1, table.num_rows))
        ends = np.cumsum(n_many)[:-1]
        split = lambda values, at, put=np.ndarray.tobytes: pa.array([put(v) for v in np.split(values, at)], pa.binary())
        made = {
            "bucket": table["bucket"], "chunk": table["chunk"],
            "singles": split(values[one], cuts, _five), "singles_at": split(at[keep], cuts), "singles_df": split(df[one], cuts),
            "many": split(values[several], ends, _five), "many_df": split(df[several], ends),
        }
        return pa.table(made | {c: table[c] for c in ("listed", "listed_at", "which", "nodes", "sizes", "keys")})

    schema = "bucket int, chunk long, singles binary, singles_at binary, many binary, times binary, listed binary, listed_at binary, which array<int>, nodes binary, sizes binary"
    moved = source.mapInArrow(chunks, f"{schema}, keys array<{kind}>")
    return moved.groupBy("bucket").applyInArrow(shared, f"{_INDEX}, keys array<{kind}>")


def _rows(counted: DataFrame, key: str) -> DataFrame:
    """(key, node, n) of each row; node is null where the set is empty."""
    kind = counted.schema["keys"].dataType.elementType

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, nodes, sizes, keys = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                at = np.array(which[i].as_py(), np.int64)
                own, n = nodes[i].as_py(), np.append(np.frombuffer(sizes[i].as_py(), "<i4"), 0)
                digests = pa.array([own[16 * a : 16 * a + 16] if a >= 0 else None for a in at], pa.binary())
                yield pa.RecordBatch.from_arrays([keys[i].values, digests, pa.array(n[at].astype(np.int64))], names=[key, "node", "n"])

    homes = counted.filter("which IS NOT NULL").select("which", "nodes", "sizes", "keys")
    return homes.mapInArrow(listed, f"`{key}` {kind.simpleString()}, node binary, n long")


def _nodes(counted: DataFrame, n_buckets: int, percent: int) -> DataFrame:
    """(node, n, shared, lead) of sets whose prefix holds shared shingles: these in order, rarest first, and how many are in the prefix."""

    def assembled(table: pa.Table) -> pa.Table:
        join = lambda c, kind: _joined(table[c], kind)[0]
        bucket = table["bucket"].to_numpy().astype(np.uint64)

        def whole(c: str) -> np.ndarray:
            short, n = _joined(table[c], "five")
            return short * np.uint64(n_buckets) + np.repeat(bucket, n)

        many = whole("many")
        order = np.argsort(many)
        many, many_df = many[order], join("many_df", "<u2")[order]
        listed = join("listed", "<u8")
        tokens = np.concatenate([whole("singles"), listed])
        at = np.concatenate([join("singles_at", "<u2"), join("listed_at", "<u2")]).astype(np.int64)
        df = np.concatenate([join("singles_df", "<u2"), many_df[np.searchsorted(many, listed)] if len(listed) else many_df[:0]])
        sizes = join("sizes", "<i4").astype(np.int64)
        nodes = join("nodes", "V16")
        tokens = tokens[np.lexsort((tokens, df, at))]
        held = np.bincount(at, minlength=len(sizes))
        ends = np.cumsum(held)
        lead = np.minimum(prefix(sizes, percent) - (sizes - held), held)
        out = np.flatnonzero(lead > 0)
        own = [tokens[ends[i] - held[i] : ends[i]].tobytes() for i in out]
        return pa.table(
            [pa.array([nodes[i].tobytes() for i in out], pa.binary()), pa.array(sizes[out]), pa.array(own, pa.binary()), pa.array(lead[out])],
            names=["node", "n", "shared", "lead"],
        )

    found = counted.drop("keys", "which").groupBy("chunk").applyInArrow(assembled, "node binary, n long, shared binary, lead long")
    # equal sets of different chunks have the same shingles in the same order
    return found.groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "shared", "lead")])


def _entries(nodes: DataFrame) -> DataFrame:
    """The inverted index: (token, pos, n, node) for the shared shingles in each set's prefix."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, lead = (batch.column(i).to_numpy() for i in (1, 3))
            own = [np.frombuffer(s, "<u8") for s in batch.column(2).to_pylist()]
            if not own:
                continue
            row = np.repeat(np.arange(len(own)), lead)
            rank = np.arange(len(row)) - np.repeat(np.cumsum(lead) - lead, lead)
            alone = n - np.array([len(s) for s in own])
            tokens = np.concatenate([s[:k] for s, k in zip(own, lead, strict=True)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens), pa.array(alone[row] + rank), pa.array(n[row]), batch.column(0).take(pa.array(row))], names=["token", "pos", "n", "node"]
            )

    return nodes.mapInArrow(post, "token long, pos long, n long, node binary")


def probe(n: np.ndarray, pos: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in a list, ordered by (n, pos), that size and position leave possible; blocks are runs of equal ``n``."""
    starts = np.flatnonzero(np.diff(n, prepend=-1))
    ends = np.append(starts[1:], len(n))
    left, right = [], []
    for i in range(len(n)):
        for s, e in zip(starts, ends, strict=True):
            if s > i or 100 * n[s] < percent * n[i]:
                continue  # the whole block is too small, or holds later sets only
            need = least_overlap(n[i], n[s], percent)
            if n[i] - pos[i] < need:
                continue
            # shingles from the position on must suffice on this side too
            last = s + np.searchsorted(pos[s:e], n[s] - need, side="right")
            found = np.arange(s, min(last, i))
            left.append(np.full(len(found), i))
            right.append(found)
    blank = [np.zeros(0, np.int64)]
    return np.concatenate(left or blank), np.concatenate(right or blank)


def _candidates(entries: DataFrame, percent: int, small: int) -> DataFrame:
    """Pairs (a > b) to be verified: of short lists all that ``probe`` leaves, of longer ones each entry with the first."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, now, first = [], None, None  # entries of a list that may still be short; else its first one
        pairs: list[tuple[bytes, bytes]] = []

        def probed():
            if len(open_) < 2:
                return
            open_.sort(key=lambda e: (e[1], e[0]))
            pos, n = (np.array([e[i] for e in open_], np.int64) for i in (0, 1))
            pairs.extend((open_[i][2], open_[j][2]) for i, j in zip(*probe(n, pos, percent), strict=True))

        def tied(lead, entry):
            if 100 * min(lead[1], entry[1]) >= percent * max(lead[1], entry[1]):
                pairs.append((lead[2], entry[2]))

        def batch():
            done = pa.RecordBatch.from_arrays([pa.array([f(p) for p in pairs], pa.binary()) for f in (max, min)], names=["a", "b"])
            pairs.clear()
            return done

        for b in batches:
            for token, *entry in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if token != now:
                    probed()
                    open_, now, first = [], token, None
                if first is not None:
                    tied(first, entry)
                elif len(open_) < small:
                    open_.append(entry)
                else:
                    first = open_[0]
                    for e in [*open_[1:], entry]:
                        tied(first, e)
                    open_ = []
                if len(pairs) >= 10_000:
                    yield batch()
        probed()
        yield batch()

    dealt = entries.repartition("token").sortWithinPartitions("token", "pos", "n", "node")
    return dealt.mapInArrow(lists, "a binary, b binary").distinct()


def _verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    side = lambda a, p: nodes.select(F.col("node").alias(f"{a}_"), F.col("n").alias(f"{a}_n"), F.col("shared").alias(p))
    both = pairs.join(side("a", "p"), F.col("a") == F.col("a_")).join(side("b", "q"), F.col("b") == F.col("b_"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m, p, q = batch.columns
            need = least_overlap(n.to_numpy(), m.to_numpy(), percent)
            sets = zip(p.to_pylist(), q.to_pylist(), strict=True)
            found = [len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True)) for x, y in sets]
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(np.array(found, np.int64) >= need))

    return both.select("a", "b", "a_n", "b_n", "p", "q").mapInArrow(compare, "a binary, b binary")


def overlaps(asked: list[np.ndarray], members: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(place in ``asked``, its overlaps with all ``members``); sets are distinct numbers.

    Sets follow by their smallest numbers, so neighbours are alike. A set's overlaps are those
    of the one before, less the lists of what only that one holds, plus the lists of what only
    this one holds, where these are shorter than all its own lists.
    """
    m = len(members)
    owner = np.repeat(np.arange(m), [len(s) for s in members])
    joined = np.concatenate(members) if m else np.zeros(0, np.uint64)
    order = np.argsort(joined, kind="stable")
    tokens, starts, counts = np.unique(joined[order], return_index=True, return_counts=True)
    owner = owner[order]

    def summed(own: np.ndarray) -> np.ndarray:
        first, n = starts[own], counts[own]
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(owner[at], minlength=m)

    held = [np.flatnonzero(np.isin(tokens, s, assume_unique=True)) for s in asked]
    before, last = None, np.zeros(0, np.int64)
    for i in sorted(range(len(asked)), key=lambda i: held[i][:4].tolist()):
        own = held[i]
        more, less = np.setdiff1d(own, last, assume_unique=True), np.setdiff1d(last, own, assume_unique=True)
        if before is not None and counts[more].sum() + counts[less].sum() < counts[own].sum():
            before = before + summed(more) - summed(less)
        else:
            before = summed(own)
        last = own
        yield i, before


def _open(entries: DataFrame, labels: DataFrame, small: int) -> DataFrame:
    """Members (token, node, n, label, hub) of long lists that hold more than one component; hub is the commonest label."""
    sizes = entries.groupBy("token").agg(F.count("*").alias("c")).filter(F.col("c") > small).select(F.col("token").alias("l"))
    known = entries.join(sizes, F.col("token") == F.col("l")).join(labels.withColumnRenamed("node", "w"), F.col("node") == F.col("w"), "left")
    known = known.select("token", "node", "n", F.coalesce("label", "node").alias("label"))
    by_label = known.groupBy("token", "label").agg(F.count("*").alias("k")).groupBy("token")
    mixed = by_label.agg(F.max(F.struct("k", "label")).alias("most"), F.count("*").alias("parts")).filter("parts > 1")
    return known.join(mixed.select(F.col("token").alias("l"), F.col("most.label").alias("hub")), F.col("token") == F.col("l")).drop("l")


def _crossed(mixed: DataFrame, nodes: DataFrame, percent: int, block: int = BLOCK, part: int = PART) -> DataFrame:
    """Links between components of a long list: open sets, those outside its largest component, against all members of near sizes, block by block."""
    # linked sizes are in one class or in neighbouring ones; a little wider, so that rounding does no harm
    size = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent) * (1 + 1e-6))).cast("int")
    sized = mixed.withColumn("size", size)
    near = F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1))
    asked = sized.filter("label != hub").withColumn("class", near)
    n_asked = asked.groupBy("token", "class").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    n_members = sized.groupBy("token", F.col("size").alias("class")).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    meet = n_asked.join(n_members, ["token", "class"])
    slot = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = nodes.select(F.col("node").alias("w"), "shared")
    columns = ("token", "class", "part", "block", "node", "n", "label", "shared")
    left = asked.join(meet, ["token", "class"]).withColumn("part", slot("parts")).withColumn("block", every("blocks"))
    right = sized.withColumn("class", F.col("size")).join(meet, ["token", "class"]).withColumn("block", slot("blocks")).withColumn("part", every("parts"))
    left, right = (df.join(own, F.col("node") == F.col("w")).select(*[F.col(c).alias(c) for c in columns]) for df in (left, right))

    def compare(asked: pa.Table, members: pa.Table) -> pa.Table:
        if not asked.num_rows or not members.num_rows:
            return pa.table([pa.array([], pa.binary())] * 2, names=["a", "b"])
        sets = [[np.frombuffer(s, "<u8") for s in t["shared"].to_pylist()] for t in (asked, members)]
        n, m = asked["n"].to_numpy(), members["n"].to_numpy()
        label, others = asked["label"].to_pylist(), members["label"].to_pylist()
        node, other = asked["node"].to_pylist(), members["node"].to_pylist()
        joined: dict[bytes, bytes] = {}

        def root(x: bytes) -> bytes:
            while (up := joined.get(x, x)) != x:
                joined[x] = joined.get(up, up)
                x = up
            return x

        out = []
        for i, found in overlaps(*sets):
            for j in np.flatnonzero(found >= least_overlap(n[i], m, percent)):
                a, b = root(label[i]), root(others[j])
                if a != b:  # else they are tied together already
                    joined[a] = b
                    out.append((max(node[i], other[j]), min(node[i], other[j])))
        return pa.table([pa.array([p[i] for p in out], pa.binary()) for i in (0, 1)], names=["a", "b"])

    by = columns[:4]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(compare, "a binary, b binary")


def joined(
    docs: DataFrame, percent: int = PERCENT, per_bucket: int = 1_000_000, per_chunk: int = 1_000_000, small: int = SMALL,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(key, n_shingles, component_id) of each row: the size of its set, and the smallest key that links reach from it, its own included.

    Links join sets whose overlap is ``percent`` of their union or more. Null, empty and blank
    texts have an empty set, link with nothing and keep their own key; a text of fewer than
    four words is one shingle. Equal sets, and so repeated rows, are linked. Rows of equal or
    null keys are rows of their own; a null key is never the smallest if there is another. An
    empty table gives no rows; other columns are not looked at.
    """
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    n_buckets = max(8, int(size) // 6 // per_bucket + 1)
    counted = saved(_counted(docs, n_buckets, per_chunk, key, text), "counted")
    rows = _rows(counted, key)
    nodes = saved(_nodes(counted, n_buckets, percent), "nodes")
    entries = saved(_entries(nodes), "entries")
    links = saved(_verified(_candidates(entries, percent, small), nodes, percent), "links")
    labels = components(links)
    mixed = saved(_open(entries, labels, small), "open")
    if not mixed.isEmpty():
        labels = components(links.union(saved(_crossed(mixed, nodes, percent).distinct(), "links")))
    labelled = rows.join(labels.withColumnRenamed("node", "w"), F.col("node") == F.col("w"), "left")
    labelled = labelled.select(key, "n", F.coalesce("label", "node").alias("label"))
    least = labelled.filter("label IS NOT NULL").groupBy("label").agg(F.min(key).alias("least")).withColumnRenamed("label", "w")
    found = labelled.join(least, F.col("label") == F.col("w"), "left")
    component = F.when(F.col("label").isNull(), F.col(key)).otherwise(F.col("least"))
    return found.select(key, F.col("n").alias("n_shingles"), component.alias("component_id"))
