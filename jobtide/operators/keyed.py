"""Operators that treat a column as the key of a table."""

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.schema import KEY

OnDuplicate = Literal["error", "latest"]


def _first_of(
    df: DataFrame, groups: Sequence[str | Column], order_by: Sequence[Column]
) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order_by))
    return df.withColumn("_rank", rank).where("_rank <= 1").drop("_rank")


def latest_per_key(df: DataFrame, key: str, order_by: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order, which should be total.

    Spark turns ``row_number() <= 1`` into a group limit that runs before the
    shuffle too, so a key that fills a third of the table sends one row per task.
    """
    return _first_of(df, [key], order_by)


def latest_dealt(df: DataFrame, key: str, order_by: Sequence[Column], parts: int) -> DataFrame:
    """``latest_per_key`` in ``parts`` partitions by the key, none of whose tasks sorts more than its part.

    The group limit before the shuffle sorts what a task has read, and files of recurring
    values hold many times their bytes. Here the rows are dealt by the key and the task that
    read them, and by the key alone after that: two shuffles, and a key that fills a third
    of the table still sends one row per reading task.
    """
    dealt = df.withColumn("_from", F.spark_partition_id()).repartition(parts, key, "_from")
    some = _first_of(dealt, [key, "_from"], order_by).drop("_from")
    return latest_per_key(some.repartition(parts, key), key, order_by)


def one_per_key(df: DataFrame, key: str, order_by: Sequence[Column]) -> DataFrame:
    """``latest_per_key`` for the right side of a join whose left side may be skewed.

    Grouping by the key and its hash leaves the same rows, but in a partitioning
    the join cannot reuse. The join then shuffles these rows itself, which is the
    plan in which adaptive execution splits a hot key of the left side.
    """
    return _first_of(df, [key, F.xxhash64(key)], order_by)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys present, for the same kind of join; copies merge before the shuffle."""
    keys = df.select(key, F.xxhash64(key).alias("_hash")).where(F.col(key).isNotNull())
    return keys.distinct().select(key)


def deduplicate(
    df: DataFrame, key: str, on_duplicate: OnDuplicate, order_by: Sequence[Column] = ()
) -> DataFrame:
    """One row per key: the first in order, or an error at run time if there are more.

    A null key is an error at run time under either policy.
    """
    missing = F.raise_error(f"{key} is null").cast("boolean")
    df = df.where(F.when(F.col(key).isNull(), missing).otherwise(True))
    if on_duplicate == "latest":
        if not order_by:
            raise ValueError("on_duplicate='latest' needs an order")
        return latest_per_key(df, key, order_by)
    if on_duplicate != "error":
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    # Only keys are counted, in a hash aggregate; the rows pass a filter untouched.
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    repeated = counted.where("_copies > 1").select(F.col(key).cast("string")).limit(1).scalar()
    raised = F.raise_error(F.concat(F.lit("duplicate key: "), repeated)).cast("boolean")
    return df.where(F.when(repeated.isNotNull(), raised).otherwise(True))


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str = KEY,
    on_duplicate: OnDuplicate = "error",
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """Target with the source's rows put in: new keys added, matched rows replaced.

    The whole row is replaced, nulls included. Only the key column of the source
    goes into the anti-join, so a batch below the broadcast threshold leaves the
    target unshuffled, and a target bucketed by the key is never shuffled. The
    source is read twice: stage one that is costly to compute.
    """
    rows = deduplicate(source, key, on_duplicate, order_by)
    return replace_rows(target, rows, source, key)


def replace_rows(
    target: DataFrame,
    rows: DataFrame,
    keys: DataFrame,
    key: str = KEY,
) -> DataFrame:
    """Target rows whose key is not among ``keys``, and the given rows.

    ``keys`` are the rows before duplicates went; their keys are cheaper to get. A
    target bucketed by the key is not shuffled; how its buckets meet the keys is for
    Spark to choose by the keys' size.
    """
    replaced = keys.select(key).distinct()
    untouched = target.join(replaced, key, "left_anti")
    return untouched.select(target.columns).unionByName(rows.select(target.columns))


def row_digest(columns: Sequence[str]) -> Column:
    """A digest of a row's values under these names; a null differs from any value."""
    values = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    return F.md5(values)


def changes(
    target: DataFrame,
    source: DataFrame,
    key: str = KEY,
    on_duplicate: OnDuplicate = "error",
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """What ``upsert`` would do: the source's rows with ``change``, inserted, replaced or unchanged.

    One join tells; of the target only keys and digests of the source's columns take part,
    and a batch below the broadcast threshold leaves the target where it is. A row is
    unchanged if all its values are equal, nulls included. Keys of the target are unique.
    """
    rows = deduplicate(source, key, on_duplicate, order_by)
    named = target.select(F.col(key).alias("_key"), row_digest(source.columns).alias("_old"))
    # the semi-join may broadcast the batch's keys; an outer join could not
    held = named.join(distinct_keys(source, key), F.col("_key") == F.col(key), "left_semi")
    found = rows.withColumn("_new", row_digest(source.columns)).join(held, F.col(key) == F.col("_key"), "left")
    change = (
        F.when(F.col("_key").isNull(), "inserted")
        .when(F.col("_old") == F.col("_new"), "unchanged")
        .otherwise("replaced")
    )
    return found.select(*source.columns, change.alias("change"))


def change_counts(changed: DataFrame) -> DataFrame:
    """Rows inserted, replaced and unchanged, in one row; 0 where there are none."""
    kinds = ("inserted", "replaced", "unchanged")
    return changed.agg(*[F.count(F.when(F.col("change") == k, 1)).alias(k) for k in kinds])


def key_clashes(target: DataFrame, rows: DataFrame, key: str = KEY) -> DataFrame:
    """Keys that rows to be inserted share with the target or among themselves.

    The rows' keys are counted once; both branches read that count, whose shuffle Spark
    reuses. A key comes once: a repeated one is left out of the second branch.
    """
    own = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    repeated = own.where("_copies > 1").select(key)
    taken = own.join(target.select(key), key, "left_semi").where("_copies = 1").select(key)
    return repeated.unionByName(taken)


def check_no_clash(target: DataFrame, rows: DataFrame, key: str = KEY) -> None:
    """Raise if inserting the rows would break the uniqueness of the key."""
    clashes = key_clashes(target, rows, key).limit(5).collect()
    if clashes:
        raise ValueError(f"{key} already present or repeated: {[r[0] for r in clashes]}")


def append_new(target: DataFrame, rows: DataFrame, key: str = KEY) -> DataFrame:
    """Target and the inserted rows; raises if a key is already there."""
    check_no_clash(target, rows, key)
    return target.unionByName(rows.select(target.columns))
