"""Records of JSON arrays too large for one task.

A file is read in pieces that end at a closing brace, by as many tasks as it has blocks.
Whether a piece begins inside a string, and how deep, depends on all before it. Both are
sums: unescaped quotes modulo two, and brackets outside strings. So a block is summed up by
itself, once for each way it may begin; the blocks' sums, one row each, tell how every block
really begins; and within a block running sums find the pieces that end a record. Only what
lies across the edges of blocks is put together over a whole file.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_END = "}"


def _count(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def _depth(clean: Column, inside: bool, quotes: Column) -> Column:
    """How much deeper a piece and its closing brace lead, given whether it begins in a string."""
    rest = F.regexp_replace(clean, r'^[^"]*("|$)', "") if inside else clean
    outside = F.regexp_replace(rest, r'"[^"]*("|$)', "")
    closed = F.when((quotes + int(inside)) % 2 == 0, 1).otherwise(0)
    return _count(outside, "[{") - _count(outside, "]}") - closed


def _measured(pieces: DataFrame) -> DataFrame:
    """Pieces with their quotes, how many came before in the block, and the depth gained for either way to begin."""
    clean = F.regexp_replace("value", r"(?s)\\.", "")
    summed = pieces.withColumn("clean", clean).withColumn("quotes", _count(F.col("clean"), '"'))
    here = Window.partitionBy("file", "block").orderBy("place")
    earlier = F.sum("quotes").over(here.rowsBetween(Window.unboundedPreceding, -1))
    return summed.select(
        "file", "block", "place", "time", "value", "quotes",
        (F.coalesce(earlier, F.lit(0)) % 2).alias("before"),
        _depth(F.col("clean"), False, F.col("quotes")).alias("d0"),
        _depth(F.col("clean"), True, F.col("quotes")).alias("d1"),
    )


def _begins(measured: DataFrame) -> DataFrame:
    """How each block begins: (file, block, inside, depth). The ordered windows run over one row per block."""
    swapped = F.col("before") == 1
    blocks = measured.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"),
        F.sum(F.when(swapped, F.col("d1")).otherwise(F.col("d0"))).alias("d0"),
        F.sum(F.when(swapped, F.col("d0")).otherwise(F.col("d1"))).alias("d1"),
    )
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("quotes").over(order), F.lit(0)) % 2)
    gained = F.when(F.col("inside") == 1, F.col("d1")).otherwise(F.col("d0"))
    depth = F.coalesce(F.sum(gained).over(order), F.lit(0))
    return blocks.select(F.col("file").alias("_file"), F.col("block").alias("_block"), "inside", depth.alias("depth"))


def _stretches(measured: DataFrame, begins: DataFrame) -> DataFrame:
    """Text up to and with the end of each record, and what is left at the end of a block."""
    at = (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))
    pieces = measured.join(begins, at)
    inside = (F.col("before") + F.col("inside")) % 2
    gained = F.when(inside == 1, F.col("d1")).otherwise(F.col("d0"))
    here = Window.partitionBy("file", "block").orderBy("place")
    depth = F.col("depth") + F.sum(gained).over(here)
    ends = (depth == 1) & ((inside + F.col("quotes")) % 2 == 0)
    pieces = pieces.withColumn("ends", F.when(ends, 1).otherwise(0))
    nth = F.coalesce(F.sum("ends").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ordered = F.array_sort(F.collect_list(F.struct("place", "value")))
    text = F.array_join(F.transform(ordered, lambda p: p["value"]), _END)
    return pieces.withColumn("nth", nth).groupBy("file", "block", "nth").agg(
        F.first("time").alias("time"), text.alias("text"), F.max("ends").alias("ends")
    )


def _whole(stretches: DataFrame) -> DataFrame:
    """Stretches with those that belong together across the edges of blocks put together."""
    inner = stretches.where("nth > 0 AND ends = 1").select("file", "time", "text", "ends", F.lit(False).alias("first"))
    # at most two a block: the first, which ends what came before, and the one left open
    edges = stretches.where("nth = 0 OR ends = 0")
    order = Window.partitionBy("file").orderBy("block", "nth")
    number = F.coalesce(F.sum("ends").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = F.array_sort(F.collect_list(F.struct("block", "nth", "text")))
    edges = edges.withColumn("number", number).groupBy("file", "number").agg(
        F.first("time").alias("time"),
        F.array_join(F.transform(parts, lambda p: p["text"]), _END).alias("text"),
        F.max("ends").alias("ends"),
        (F.min("number") == 0).alias("first"),
    )
    return inner.unionByName(edges.select("file", "time", "text", "ends", "first"))


def split_arrays(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text of each element of the JSON arrays at ``path``: record, _readable, source_file, source_time, source_pos.

    A file is as many tasks as ``spark.sql.files.maxPartitionBytes`` makes of it; its text is
    moved once. Elements of any kind come as they stand, whatever they hold. A stretch
    of text that is no part of an array comes as one record that is not readable; what stands
    before and after it is kept. An empty file, or an empty array, has no records. The place
    within the file is not counted: it is 0, as with lines.
    """
    pieces = spark.read.text(path, lineSep=_END).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_modification_time").alias("time"),
        F.monotonically_increasing_id().alias("place"),
    )
    measured = _measured(pieces)
    found = _whole(_stretches(measured, _begins(measured)))
    last = F.col("ends") == 0
    # an element follows a bracket or a comma; after the last one the array is closed
    lead = F.when(F.col("first"), F.lit(r"^\s*\[")).otherwise(F.lit(r"^\s*,"))
    body = F.when(last, F.regexp_replace("text", r"\]\s*$", "")).otherwise(F.concat("text", F.lit(_END)))
    closed = ~last | F.col("text").rlike(r"\]\s*$")
    bare = last & ~F.col("first") & F.col("text").rlike(r"^\s*\]\s*$")
    inner = F.regexp_replace(body, lead, F.lit(""))
    # a comma calls for an element
    said = closed & F.rlike(body, lead) & (F.col("first") & last | inner.rlike(r"\S"))
    items = F.when(bare, F.array().cast("array<string>")).when(said, F.from_json(F.concat(F.lit("["), inner, F.lit("]")), "array<string>"))
    found = found.where(~(last & F.col("first") & ~F.col("text").rlike(r"\S")))
    found = found.withColumn("_items", items).withColumn("_readable", F.col("_items").isNotNull())
    return found.select(
        F.explode(F.coalesce("_items", F.array("text"))).alias("record"),
        "_readable",
        F.col("file").alias("source_file"),
        F.col("time").alias("source_time"),
        F.lit(0).alias("source_pos"),
    )
