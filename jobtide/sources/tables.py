"""Target, staging and published tables."""

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.operators.keyed import OnDuplicate, check_no_clash, deduplicate
from jobtide.schema import KEY, TARGET


def from_rows(
    spark: SparkSession, rows: Iterable[Mapping[str, Any]], schema: T.StructType = TARGET
) -> DataFrame:
    """A few dicts as a DataFrame under a declared schema; absent keys are null."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def create_target(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Declare the target table if it is not there yet.

    Parquet tables do not enforce lengths or uniqueness; ``validate_target`` and
    the keyed operators do.
    """
    default = {"processed_at": " DEFAULT current_timestamp()"}
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}"
        f"{'' if f.nullable else ' NOT NULL'}{default.get(f.name, '')}"
        for f in TARGET.fields
    )
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{where}")


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A table or view of the catalog by name."""
    return spark.read.table(table)


def append(df: DataFrame, table: str, key: str = KEY) -> None:
    """Insert rows; raises, before anything is written, if a key is already there.

    The check reads the rows too: stage them first if they are costly to compute.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        check_no_clash(spark.read.table(table), df, key)
    df.write.mode("append").saveAsTable(table)


def overwrite(df: DataFrame, table: str) -> None:
    """Replace a table. Spark refuses one that the rows are read from."""
    df.write.mode("overwrite").saveAsTable(table)


def stage(df: DataFrame, prefix: str = "staging") -> str:
    """Write rows to a staging table of a name no other run uses; returns the name."""
    name = f"{prefix}_{uuid.uuid4().hex}"
    df.write.mode("errorifexists").saveAsTable(name)
    return name


def drop_staging(spark: SparkSession, name: str) -> None:
    """Remove a staging table or temporary view, if it is there."""
    if not spark.catalog.dropTempView(name):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def save_keyed_table(
    df: DataFrame, table: str, key: str = KEY, buckets: int = 200, path: str | None = None
) -> None:
    """Write a table bucketed by its key, so an upsert into it shuffles only the batch.

    A bucket is one file, and one task sorts its rows: take a number that keeps them near
    128 MB in memory, of which the file may be a tenth. With a ``path`` the files lie there,
    in place of what a failed attempt may have left.
    """
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    if path:
        writer.mode("overwrite").option("path", path).saveAsTable(table)
    else:
        writer.mode("errorifexists").saveAsTable(table)


def merge_into(
    source: DataFrame,
    table: str,
    key: str = KEY,
    on_duplicate: OnDuplicate = "error",
    order_by: Sequence[Column] = (),
) -> None:
    """Upsert in place, in one transaction, where the catalog has row-level changes.

    That takes a table format such as Delta or Iceberg; only files with matched
    rows are rewritten. For plain Parquet use ``upsert`` and ``publish``.
    """
    rows = deduplicate(source, key, on_duplicate, order_by).alias("source")
    matched = F.col(f"{table}.{key}") == F.col(f"source.{key}")
    rows.mergeInto(table, matched).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def publish(df: DataFrame, name: str, version: int, key: str = KEY, buckets: int = 200) -> str:
    """Write a new version of a table, then point the view ``name`` at it.

    Readers see the old version until the new one is whole. The old table stays
    for those still reading it; drop it with ``drop_staging`` later.
    """
    table = f"{name}_v{version}"
    save_keyed_table(df, table, key, buckets)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")
    return table


def clustered_write(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write by month of publication, sorted by city and salary within each file.

    A filter on the month reads its directories only, and the sorted files carry
    tight min/max statistics. The rebalance lets adaptive execution cut a month
    that holds much of the table into several files and merge small ones.
    """
    month = F.date_format("published_date", "yyyy-MM")
    (
        df.withColumn("published_month", month)
        .hint("rebalance", "published_month")
        .sortWithinPartitions("published_month", "city", "salary_rub")
        .write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .partitionBy("published_month")
        .parquet(path)
    )


def read_days(spark: SparkSession, path: str, first: dt.date, last: dt.date) -> DataFrame:
    """Postings of a clustered table published from the first to the last day.

    Spark cannot tell from the day which month's directory to read, so both are
    asked for.
    """
    month, day = F.col("published_month"), F.col("published_date")
    months = month.between(f"{first:%Y-%m}", f"{last:%Y-%m}")
    df = spark.read.parquet(path)
    return df.where(months & day.between(F.lit(first), F.lit(last))).drop("published_month")


def preview(df: DataFrame, n: int = 10) -> None:
    """Print the first rows in full width."""
    df.show(n, truncate=False)


def register_view(df: DataFrame, name: str) -> None:
    """Make a query available to SQL under a name, replacing an earlier one."""
    df.createOrReplaceTempView(name)
