"""Tables bucketed by key: what a batch has to do with is in the buckets of its keys."""

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.operators.keyed import key_clashes
from jobtide.schema import KEY


class Buckets(NamedTuple):
    """How a table is bucketed, and where its files are."""

    key: str
    count: int
    location: str


def buckets_of(spark: SparkSession, table: str) -> Buckets | None:
    """The bucketing of a table by a single column; None without."""
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    columns = re.findall(r"`([^`]+)`", said.get("Bucket Columns", ""))
    if len(columns) != 1:
        return None
    return Buckets(columns[0], int(said["Num Buckets"]), said["Location"])


def _files(spark: SparkSession, location: str) -> dict[int, list[str]]:
    """Data files of a bucketed table by bucket; Spark ends their names in it."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(location)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[int, list[str]] = {}
    for status in fs.listStatus(root):
        if match := re.search(r"_(\d{5,})(?:\.[^/]*)?$", status.getPath().getName()):
            found.setdefault(int(match[1]), []).append(status.getPath().toString())
    return found


def rows_beside(spark: SparkSession, table: str, keys: DataFrame, key: str = KEY) -> DataFrame:
    """Rows of a table in the buckets that ``keys`` fall into; the whole table if it is not bucketed by them.

    Which buckets these are is asked of the keys: one number per bucket comes to the driver.
    """
    whole = spark.read.table(table)
    known = buckets_of(spark, table)
    if known is None or known.key != key:
        return whole
    # the same hash as Spark's own bucketing, over the key in the table's type
    number = F.pmod(F.hash(F.col(key).cast(whole.schema[key].dataType)), F.lit(known.count))
    hit = {r[0] for r in keys.where(F.col(key).isNotNull()).select(number).distinct().collect()}
    if len(hit) == known.count:
        return whole
    files = [f for n, names in _files(spark, known.location).items() if n in hit for f in names]
    if not files:
        return whole.where(F.lit(False))
    return spark.read.schema(whole.schema).parquet(*files)


def bucket_clashes(rows: DataFrame, table: str, key: str = KEY) -> DataFrame:
    """``key_clashes`` with a table of the catalog, of which only the buckets of the rows' keys are read."""
    return key_clashes(rows_beside(rows.sparkSession, table, rows, key), rows, key)


def append_keyed(rows: DataFrame, table: str, key: str = KEY) -> None:
    """Insert rows into a table bucketed by key; raises, before anything is written, if a key is there already.

    Both the check and the write go by the buckets of the rows' keys, so they cost the same
    whatever the rest of the table holds. The rows are read more than once: stage them first
    if they are costly to compute.
    """
    spark = rows.sparkSession
    known = buckets_of(spark, table)
    if known is None or known.key != key:
        raise ValueError(f"{table} is not bucketed by {key}")
    clashes = bucket_clashes(rows, table, key).limit(5).collect()
    if clashes:
        raise ValueError(f"{key} already present or repeated: {[r[0] for r in clashes]}")
    own = rows.select(*spark.read.table(table).columns).repartition(known.count, key)
    own.write.mode("append").format("parquet").bucketBy(known.count, key).sortBy(key).saveAsTable(table)
