"""Row filters and conditional updates.

Each returns a new DataFrame; where it is written is up to the caller.
"""

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.schema import KEY


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, whose columns are computed once however often what follows names them.

    Catalyst puts a column's expression wherever the column is named: into each condition,
    filter and sort key. Behind a generator it does not. Filters above do not reach the scan.
    """
    return df.select(F.explode(F.array(F.struct("*"))).alias("_row")).select("_row.*")


def with_salary(df: DataFrame) -> DataFrame:
    """Postings with a salary."""
    return df.where(F.col("salary_rub").isNotNull())


def delete_where(df: DataFrame, marker: str = "test_", column: str = KEY) -> DataFrame:
    """Drop the rows whose column contains the marker anywhere, or is null.

    The marker is plain text, so an underscore stands for itself.
    """
    return df.where(~F.col(column).contains(marker))


def update_where(df: DataFrame, predicate: Column, assignments: Mapping[str, Any]) -> DataFrame:
    """Replace columns where the predicate is true; null counts as false."""
    # All assignments see the row as it was before the update.
    return df.withColumns(
        {
            name: F.when(predicate, value if isinstance(value, Column) else F.lit(value))
            .otherwise(F.col(name))
            .cast(df.schema[name].dataType)
            for name, value in assignments.items()
        }
    )


def read_limit(df: DataFrame, n: int = 10, order_by: str | Column = KEY) -> DataFrame:
    """First n rows by a key, kept as a top-n so that nothing is sorted whole."""
    return df.orderBy(order_by).limit(n)
