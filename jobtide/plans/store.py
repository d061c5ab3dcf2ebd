"""The postings on disk: a base, and the batches that came after it.

    <store>/batches/batch_id=<n>/status=ok|rejected/   one directory per batch
    <store>/changes/upto=<n>/                          batches after the base up to n, merged
    <store>/base/upto=<n>/                             all batches up to n, merged

A batch is written once, without a shuffle, whatever the size of the base, and
writing it again after a failure replaces it. Reading merges the batches into the
base by key, the later batch winning. A directory counts when it holds the marker that
is written last; a batch's marker names the source that wrote it, so that no source
takes another's number and nothing is put behind the base, where it would not be read.

``merge_batches`` merges the batches among themselves and does not touch the base;
``compact`` writes a new base. ``prune`` removes what has been merged. One job at a time
writes to a store.

The base is clustered by month of publication, or, where the functions get the name
of a catalog table, bucketed by key: then merging batches too large for a broadcast
shuffles the batches and leaves the base in place. The files are in the store either
way and can be read without the catalog.
"""

import base64
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.operators.keyed import latest_dealt, latest_per_key, replace_rows
from jobtide.schema import KEY, TARGET
from jobtide.sources.tables import clustered_write, save_keyed_table

_ORIGIN = T.StructType(
    [
        T.StructField("source_time", T.TimestampType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("source_pos", T.IntegerType()),
    ]
)
ORIGIN = tuple(_ORIGIN.names)
BATCH = T.StructType(
    [
        *[T.StructField(f.name, f.dataType) for f in TARGET.fields],
        *_ORIGIN.fields,
        T.StructField("record", T.StringType()),
        T.StructField("reject_reasons", T.ArrayType(T.StringType())),
        T.StructField("batch_id", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)


def batch_path(store: str, batch_id: int) -> str:
    return f"{store}/batches/batch_id={batch_id}"


MARKER = "_COMPLETE"
#: Who wrote a directory is in a file's name, so that one listing tells it of all of them.
SOURCE = "_SOURCE."
#: A bucket of the base holds about so many bytes of rows or fewer: one task sorts it, in its memory.
BUCKET_BYTES = 128 << 20


def _files(spark: SparkSession, directory: str):
    """Hadoop's path and file system of a directory."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _marks(spark: SparkSession, directory: str, label: str) -> dict[int, str]:
    """Numbers of the complete ``label=<n>`` directories, in order, and who wrote them."""
    root, fs = _files(spark, directory)
    if not fs.exists(root):
        return {}
    jvm = spark.sparkContext._jvm
    complete, sources = [], {}
    for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{directory}/{label}=*/{{{MARKER},{SOURCE}*}}")):
        path = status.getPath()
        number = int(path.getParent().getName().split("=")[1])
        if path.getName() == MARKER:
            complete.append(number)
        else:
            sources[number] = _said(path.getName().removeprefix(SOURCE))
    return {n: sources.get(n, "") for n in sorted(complete)}


def _named(text: str) -> str:
    """A text as a part of a file's name."""
    return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")


def _said(name: str) -> str:
    return base64.urlsafe_b64decode(name + "=" * (-len(name) % 4)).decode()


def mark(spark: SparkSession, directory: str, text: str = "") -> None:
    """Declare a directory complete; ``text`` has 150 bytes at most, so that it fits a file's name."""
    if len(text.encode()) > 150:
        raise ValueError(f"too long for a marker: {text!r}")
    for name in ([f"{SOURCE}{_named(text)}"] if text else []) + [MARKER]:
        path, fs = _files(spark, f"{directory}/{name}")
        fs.create(path, True).close()


def batch_numbers(spark: SparkSession, store: str) -> dict[int, str]:
    """Complete batches, merged or not, with their sources."""
    return _marks(spark, f"{store}/batches", "batch_id")


def number_for(spark: SparkSession, store: str, source: str) -> int:
    """The number a source has already written under, or the next free one."""
    held = batch_numbers(spark, store)
    mine = [n for n, s in held.items() if s == source]
    return mine[0] if mine else max([*held, latest_base(spark, store)], default=-1) + 1


def claim(spark: SparkSession, store: str, batch_id: int, source: str) -> bool:
    """Whether a source may write a batch now; False if its own batch is merged already.

    Raises ValueError where writing would replace another source's batch, or put a new one
    behind what is merged.
    """
    held = batch_numbers(spark, store).get(batch_id)
    if held is not None and held != source:
        raise ValueError(f"batch {batch_id} was written by {held!r}, not by {source!r}")
    upto = max(latest_base(spark, store), latest_changes(spark, store))
    if batch_id > upto:
        return True
    if held is None:
        raise ValueError(f"batch {batch_id} comes after batches up to {upto} were merged")
    return False


def batches(spark: SparkSession, store: str, after: int = -1, upto: int | None = None) -> DataFrame | None:
    """Rows of the batches after a number, and up to one if given, both good and rejected."""
    numbers = [n for n in batch_numbers(spark, store) if n > after and (upto is None or n <= upto)]
    if not numbers:
        return None
    paths = [batch_path(store, n) for n in numbers]
    return spark.read.schema(BATCH).option("basePath", f"{store}/batches").parquet(*paths)


def latest_base(spark: SparkSession, store: str) -> int:
    """Number of the last batch in the newest base, -1 without one."""
    return max(_marks(spark, f"{store}/base", "upto"), default=-1)


def latest_changes(spark: SparkSession, store: str) -> int:
    """Number of the last batch among the merged ones, -1 without one."""
    return max(_marks(spark, f"{store}/changes", "upto"), default=-1)


def arrival_order() -> list[Column]:
    """Later batches first, then later files, then the last published.

    The place in a file does not count: lines have none, as a file is read in pieces, and
    the same records in one array give the same posting.
    """
    newest = ["batch_id", "source_time", "source_file", "published_date", "processed_at"]
    rest = sorted(set(TARGET.names) - {*newest, KEY})
    return [F.desc_nulls_last(c) for c in [*newest, *rest]]


def _changes(spark: SparkSession, store: str, upto: int, as_of: int | None = None) -> DataFrame | None:
    """Good rows of what came after a base: merged batches, and those after them."""
    columns = [*TARGET.names, *ORIGIN, "batch_id"]
    merged = latest_changes(spark, store)
    found = batches(spark, store, max(upto, merged), as_of)
    if found is not None:
        found = found.where("status = 'ok'").select(*columns)
    if merged <= upto:
        return found
    schema = T.StructType([f for f in BATCH.fields if f.name in columns])
    rows = spark.read.schema(schema).parquet(changes_path(store, merged)).select(*columns)
    return rows if found is None else rows.unionByName(found)


def changes_path(store: str, upto: int) -> str:
    return f"{store}/changes/upto={upto}"


def base_path(store: str, upto: int) -> str:
    return f"{store}/base/upto={upto}"


def has_state(spark: SparkSession, store: str, as_of: int) -> bool:
    """Whether the postings as of an earlier batch can still be told: no merge has taken in later ones."""
    return max(latest_base(spark, store), latest_changes(spark, store)) <= as_of


def scratch_path(store: str) -> str:
    """A new place beside the data, for what is written to be read once."""
    return f"{store}/_scratch/{uuid.uuid4().hex}"


def snapshot(spark: SparkSession, store: str, table: str | None = None, as_of: int | None = None) -> DataFrame:
    """Postings as of the last complete batch, or of an earlier one that ``has_state``."""
    if as_of is not None and not has_state(spark, store, as_of):
        raise ValueError(f"batches after {as_of} are merged: the postings as of it are not kept")
    return _merged(spark, store, table, as_of)


def _merged(
    spark: SparkSession, store: str, table: str | None, as_of: int | None = None, parts: int | None = None
) -> DataFrame:
    """Base and batches merged; the batches among themselves in so many parts by key, if given."""
    upto = latest_base(spark, store)
    if table and upto >= 0 and spark.catalog.tableExists(f"{table}_v{upto}"):
        base = spark.read.table(f"{table}_v{upto}").select(*TARGET.names)
    elif upto >= 0:
        base = spark.read.schema(TARGET).parquet(base_path(store, upto)).select(*TARGET.names)
    else:
        base = spark.createDataFrame([], TARGET)
    good = _changes(spark, store, upto, as_of)
    if good is None:
        return base
    order = arrival_order()
    newest = latest_dealt(good, KEY, order, parts) if parts else latest_per_key(good, KEY, order)
    newest = newest.select(*TARGET.names)
    if upto < 0:
        return newest
    return replace_rows(base, newest, good, KEY)


def rejects(spark: SparkSession, store: str) -> DataFrame:
    """Records set aside, with their text and the reasons."""
    found = batches(spark, store)
    if found is None:
        found = spark.createDataFrame([], BATCH)
    return found.where("status = 'rejected'").select(
        "record", "reject_reasons", "source_file", "batch_id"
    )


def merge_batches(spark: SparkSession, store: str) -> int:
    """Merge what came after the base into one set of rows; returns its last batch.

    Only the batches are read and moved, so this is cheap whatever the base; ``compact``
    is for when the changes have grown to a good part of it.
    """
    upto, number = latest_base(spark, store), max(batch_numbers(spark, store), default=-1)
    if number > max(upto, latest_changes(spark, store)):
        rows = latest_per_key(_changes(spark, store, upto), KEY, arrival_order())
        rows.write.mode("overwrite").parquet(changes_path(store, number))
        mark(spark, changes_path(store, number))
    return number


def _row_bytes(schema: T.StructType) -> Column:
    """About what a row takes in a task that sorts it: words for its columns, and its texts."""
    size = F.lit(8 * (len(schema) + 3))
    for field in schema:
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(field.name) + 8, F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            texts = F.octet_length(F.array_join(field.name, "")) + F.size(field.name) * 16 + 8
            size = size + F.coalesce(texts, F.lit(0))
    return size


def _held_bytes(spark: SparkSession, store: str) -> int:
    """About what the newest base and the good rows after it take in memory; one number per task is moved.

    Files do not tell: where values recur, they are a tenth of their rows and less.
    """
    upto = latest_base(spark, store)
    held = [_changes(spark, store, upto)]
    if upto >= 0:
        held.append(spark.read.schema(TARGET).parquet(base_path(store, upto)))
    sums = [rows.agg(F.sum(_row_bytes(rows.schema))).first()[0] for rows in held if rows is not None]
    return sum(s or 0 for s in sums)


def compact(
    spark: SparkSession, store: str, table: str | None = None, buckets: int | None = None
) -> int:
    """Merge all batches into a new base; returns the last batch it holds.

    With a ``table`` the base is bucketed by key and known to the catalog as
    ``<table>_v<n>``; without ``buckets`` there are as many as keep one below
    ``BUCKET_BYTES``, for which the rows are read once more. Bases and batches merged before
    stay until ``prune`` removes them.
    """
    upto = max(batch_numbers(spark, store), default=-1)
    if upto > latest_base(spark, store):
        # Overwriting only ever meets the remains of a compaction that failed.
        path = base_path(store, upto)
        if table:
            if buckets is None:
                buckets = _held_bytes(spark, store) // BUCKET_BYTES + 1
            merged = _merged(spark, store, table, parts=buckets)
            save_keyed_table(merged, f"{table}_v{upto}", KEY, buckets, path)
        else:
            clustered_write(snapshot(spark, store), path, mode="overwrite")
        mark(spark, path)
    return upto


def prune(spark: SparkSession, store: str) -> None:
    """Remove rows of batches, changes and bases that a newer base or merge holds.

    Rejected records stay, and so do the batches' markers. A catalog table over a removed
    base is the caller's to drop.
    """
    base, changes = latest_base(spark, store), latest_changes(spark, store)
    gone = [f"{batch_path(store, n)}/status=ok" for n in batch_numbers(spark, store) if n <= max(base, changes)]
    gone += [base_path(store, n) for n in _marks(spark, f"{store}/base", "upto") if n < base]
    gone += [changes_path(store, n) for n in _marks(spark, f"{store}/changes", "upto") if n < changes or n <= base]
    for directory in gone:
        path, fs = _files(spark, directory)
        fs.delete(path, True)
