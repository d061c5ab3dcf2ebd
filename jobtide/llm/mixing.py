"""Mixing sources to target weights by Pareto order sampling.

Every source is given a share of all words; what a source cannot fill, because no
document may be repeated more than ``most`` times, is shared out again by weight. A
document is first taken a whole number of times, which is certain; the rest of its
source's target is a sample of fixed size without repeats. Documents get random odds
u / (1 - u), divided by their inclusion odds, and the smallest ranks are taken until the
words are reached (Rosen's Pareto design). Inclusion odds grow with a document's size, so
that the last document taken, by which the target is missed, tends to be a small one.

Only counts by source and by bin of rank are gathered; a rank is compared with its
source's cutoff, so documents are neither sorted nor moved, whatever a source's size: what
there is to know of the sources, a row of each, goes to every task, if they are not too many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins of rank by which the cutoff of a source is found; only the cutoff's own bin is sorted.
BINS = 4096
#: A table of one row per source is broadcast up to so many sources; beyond that Spark chooses.
SOURCES = 50_000


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """One row per source of (source, size): source_size, source_docs, target.

    Sources by code point, null last, take ``weights`` in turn. A target is at most
    ``most`` times its source's size; the excess is shared by weight until none is above.
    The windows here run over one row per source.
    """
    by = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("source_docs")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.array(*[F.lit(float(w)) for w in weights])[place % len(weights)]
    by = by.withColumn("weight", weight).withColumn("bound", F.col("source_size") * float(most))
    ranked = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("bound").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(ranked.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - before) / after
    by = by.withColumn("level", level).withColumn("nth", F.row_number().over(ranked))
    open_level = F.when(F.col("level") * F.col("weight") <= F.col("bound"), F.col("level"))
    final = F.min_by(open_level, F.when(open_level.isNotNull(), F.col("nth"))).over(everything)
    target = F.least("bound", F.col("weight") * final)
    return by.withColumn("target", target).select("source", "source_size", "source_docs", "target")


def _uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on key and seed only."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**48)


def copies(
    docs: DataFrame,
    size: Column,
    weights: tuple[float, ...] = (1, 2, 3),
    most: int = 3,
    key: str = "doc_id",
    source: str = "source",
    measure: Column | None = None,
    seed: int = 0,
) -> DataFrame:
    """``docs`` with size, source_size, target and copies, the times a document is taken.

    ``measure`` is what inclusion odds are proportional to, the size if not given.
    Documents of size 0 are never taken, null sizes count as 0, a null source is a source
    of its own, rows with equal keys are taken or left together, and an empty table gives
    an empty result. Columns of ``docs`` with one of the new names are replaced.
    """
    new = ("size", "source_size", "target", "copies")
    size = F.coalesce(size, F.lit(0)).cast("long")
    kept = [c for c in docs.columns if c.lower() not in new]
    sized = docs.select(*kept, size.alias("size"), *([] if measure is None else [measure.alias("_measure")]))
    sized = sized.withColumn("_measure", F.col("size" if measure is None else "_measure").cast("double"))
    narrow = sized.select(
        F.col(source).alias("source"), F.col(key).alias("key"), "size", F.coalesce("_measure", F.lit(0.0)).alias("m")
    )
    few = docs.select(source).distinct().limit(SOURCES + 1).count() <= SOURCES
    shipped = F.broadcast if few else lambda table: table  # so that documents of one source stay where they are
    by = targets(narrow, weights, most)
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    by = by.withColumn("whole", whole.cast("long"))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    by = by.withColumn("rest", F.when(F.col("whole") >= most, 0.0).otherwise(rest))
    share = F.try_divide("rest", "source_size")
    by = by.withColumn("odds", F.try_divide(F.try_divide(share, 1 - share), F.try_divide("source_size", "source_docs")))

    u = _uniform(F.col("key"), seed)
    ranked = narrow.filter("size > 0 and m > 0").join(
        shipped(by.filter("rest > 0").withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s"))
    )
    ranked = ranked.withColumn("rank", F.try_divide(u / (1 - u), F.col("odds") * F.col("m")))
    ranked = ranked.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS))
    counts = ranked.groupBy("source", "bin", "rest").agg(F.sum("size").alias("in_bin"))
    upward = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("below", F.sum("in_bin").over(upward) - F.col("in_bin"))
    edge = counts.filter("below < rest and rest <= below + in_bin").select(
        F.col("source").alias("s2"), F.col("bin").alias("edge"), "below"
    )
    inner = ranked.join(shipped(edge), F.col("source").eqNullSafe(F.col("s2")) & (F.col("bin") == F.col("edge")))
    inner = inner.groupBy("source", "rank", "rest", "below").agg(F.sum("size").alias("together"))
    upward = Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    inner = inner.withColumn("upto", F.col("below") + F.sum("together").over(upward))
    # the last one is taken if the target is nearer with it than without
    near = F.col("upto") - F.col("together") / 2 <= F.col("rest")
    cut = inner.groupBy("source").agg(F.max(F.when(near, F.col("rank"))).alias("inner_cut"))
    # where none of the bin is taken, all below it are
    cut = cut.join(edge, F.col("source").eqNullSafe(F.col("s2"))).select(F.col("source").alias("s3"), "edge", "inner_cut")

    by = by.join(cut, F.col("source").eqNullSafe(F.col("s3")), "left").select(
        F.col("source").alias("_source"), "source_size", "target", "whole", "odds", "edge", "inner_cut"
    )
    u = _uniform(F.col(key), seed)
    rank = F.try_divide(u / (1 - u), F.col("odds") * F.col("_measure"))  # null where nothing is drawn
    drawn = (F.floor(rank / (1 + rank) * BINS) < F.col("edge")) | (rank <= F.col("inner_cut"))
    drawn = (F.col("_measure") > 0) & F.coalesce(drawn, F.lit(False))
    taken = F.when(F.col("size") > 0, F.col("whole") + F.when(drawn, 1).otherwise(0)).otherwise(0)
    out = sized.join(shipped(by), F.col(source).eqNullSafe(F.col("_source")), "left")
    return out.select(*kept, "size", "source_size", "target", taken.cast("long").alias("copies"))


def repeated(docs: DataFrame, taken: str = "copies") -> DataFrame:
    """Each row as often as ``taken`` says; rows of 0 are left out."""
    rest = [c for c in docs.columns if c != taken]
    return docs.filter(F.col(taken) > 0).select(*rest, F.explode(F.sequence(F.lit(1), F.col(taken)))).select(*rest)
