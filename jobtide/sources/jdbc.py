"""Tables behind JDBC.

The driver's JAR and the database are the caller's. Give a numeric, date or
timestamp column with its bounds, or a list of predicates; without either the
whole table comes through one connection.
"""

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Slices(NamedTuple):
    """Column and bounds by which a table is read in parallel."""

    column: str
    lower: int | str
    upper: int | str
    count: int


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    slices: Slices | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A table of a database; rows outside the bounds fall into the outer slices."""
    if slices and predicates:
        raise ValueError("give slices or predicates, not both")
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties))
    if slices:
        return spark.read.jdbc(
            url,
            table,
            column=slices.column,
            lowerBound=slices.lower,
            upperBound=slices.upper,
            numPartitions=slices.count,
            properties=dict(properties),
        )
    return spark.read.jdbc(url, table, properties=dict(properties))


def append(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], connections: int = 8
) -> None:
    """Insert rows; the database refuses a key that is already there."""
    options = {**properties, "numPartitions": str(connections)}
    df.write.jdbc(url, table, mode="append", properties=options)


def overwrite(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], connections: int = 8
) -> None:
    """Replace the rows of a table and keep its definition."""
    options = {**properties, "numPartitions": str(connections), "truncate": "true"}
    df.write.jdbc(url, table, mode="overwrite", properties=options)


def _literal(value) -> str:
    """A value as SQL of any dialect."""
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    return str(value)


def _bounds(df: DataFrame, column: str, count: int) -> list:
    """The values that cut a column into ``count`` parts of equal rows; a frequent one comes more than once."""
    if count < 2:
        return []
    shares = [i / count for i in range(1, count)]
    return df.agg(F.percentile_approx(column, shares, 1000 * count)).first()[0] or []


def even_slices(df: DataFrame, column: str, count: int, then: str | None = None) -> list[str]:
    """Predicates that cut a table into about ``count`` slices of equal rows, whatever the skew of a column.

    Every row is in exactly one slice, rows without a value in the first. ``df`` is the table, or
    what is known of its distribution; the column is a number, a date or a timestamp. Equal
    strides between the bounds put most rows of a skewed column into one slice; these bounds are
    quantiles. A value that fills more than one slice gets slices of its own, cut by
    ``then`` if that is given. Only bounds come to the driver.
    """
    if count < 1:
        raise ValueError(f"count must be 1 or more, not {count}")
    cuts = _bounds(df, column, count)
    # a value that is the bound of several slices fills all but one of them at least
    heavy = {v: cuts.count(v) for v in dict.fromkeys(cuts) if cuts.count(v) > 1}
    slices, low = [], None
    for v in dict.fromkeys(cuts):
        above = f"{column} > {_literal(low)}" if low is not None else ""
        upto = f"{column} {'<' if v in heavy else '<='} {_literal(v)}"
        slices.append(f"{above} AND {upto}" if above else f"({upto} OR {column} IS NULL)")
        if v in heavy:
            own = f"{column} = {_literal(v)}"
            inner = even_slices(df.where(own), then, heavy[v]) if then else ["1 = 1"]
            slices += [f"{own} AND {p}" for p in inner]
        low = v
    return [*slices, f"{column} > {_literal(low)}"] if cuts else ["1 = 1"]


def read_evenly(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    column: str,
    count: int,
    then: str | None = None,
) -> DataFrame:
    """A table of a database in slices of equal rows; its column is read once more for the bounds."""
    whole = spark.read.jdbc(url, table, properties=dict(properties))
    some = whole.select(*{column: None, **({then: None} if then else {})})
    return read_table(spark, url, table, properties, predicates=even_slices(some, column, count, then))
