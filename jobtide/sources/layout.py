"""Tables laid out so that a filter on either of several columns reads little of them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a string that count in its rank.
_HEAD = 7


def _number(df: DataFrame, column: str) -> Column:
    """A number that sorts as the column does; strings by their first bytes."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, _HEAD)), 2 * _HEAD, "0")
        return F.conv(head, 16, 10).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.col(column).cast("double")
    raise ValueError(f"{column} is {kind.simpleString()}: it has no order to cluster by")


def _rank(number: Column, bounds: Sequence[float], bits: int) -> Column:
    """How many of the ascending ``bounds`` a number exceeds, by bisection; a null exceeds none."""
    known = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(bits))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.coalesce(number > F.get(known, at + step - 1), F.lit(False)), at + step).otherwise(at)
    )


def z_order(df: DataFrame, columns: Sequence[str], bits: int = 8) -> Column:
    """The place of a row on the curve through the columns' quantiles: their ranks, bit by bit in turn.

    One pass over the columns finds ``2 ** bits - 1`` quantiles of each; that many numbers come
    to the driver, whatever the table. A column without a value takes no part.
    """
    if not 0 < bits * len(columns) < 63:
        raise ValueError("bits times columns must be 1 to 62")
    shares = F.array(*[F.lit(i / 2**bits) for i in range(1, 2**bits)])
    numbers = {c: _number(df, c) for c in columns}
    found = df.agg(*[F.percentile_approx(n, shares, 100 << bits).alias(c) for c, n in numbers.items()]).first()
    place = F.lit(0).cast("bigint")
    for nth, (c, number) in enumerate(numbers.items()):
        if found[c] is None:
            continue
        rank = _rank(number, found[c], bits)
        for bit in range(bits):
            at = bit * len(columns) + len(columns) - 1 - nth
            place = place + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint"), at)
    return place


def z_order_write(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = ("city", "salary_rub"),
    bits: int = 8,
    mode: str = "errorifexists",
    row_group_bytes: int = 128 << 20,
) -> None:
    """Write a table along the curve, so that each row group spans a small range of every column.

    A lookup by any one of the columns, or by several, reads the row groups whose statistics
    allow it: of n groups about the square root of n for one of two columns. Rows of one place
    are dealt over tasks by their own hash, so a value that fills a third of the table is no
    one task's. The rows are read twice: stage them first if they are costly to compute.
    """
    placed = df.withColumn("_place", z_order(df, columns, bits))
    tie = F.xxhash64(*df.columns)
    (
        placed.repartitionByRange("_place", tie)
        .sortWithinPartitions("_place", *columns)
        .drop("_place")
        .write.mode(mode)
        .option("parquet.block.size", row_group_bytes)
        .parquet(path)
    )
