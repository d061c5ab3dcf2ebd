"""Checks a posting has to pass, and what to do with those that fail."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions import has_keys
from jobtide.operators.keyed import latest_per_key
from jobtide.operators.rows import computed_once
from jobtide.schema import KEY, MAX_CITY_CHARS, MAX_ID_CHARS, REQUIRED_KEYS


def _rules() -> dict[str, Column]:
    key, title, city = F.col(KEY), F.col("title"), F.col("city")
    return {
        "id missing": key.isNotNull(),
        "id too long": F.length(key) <= MAX_ID_CHARS,
        "title missing": title.isNotNull(),
        "city too long": city.isNull() | (F.length(city) <= MAX_CITY_CHARS),
    }


def is_valid() -> Column:
    """Whether the target takes a row. Plain conditions, so null tests reach the scan."""
    # The length of a missing id is null, but the first rule has failed by then.
    return reduce(lambda a, b: a & b, _rules().values())


def reject_reasons() -> Column:
    """Array of the rules a stored posting breaks, empty for a valid one."""
    return F.array_compact(
        F.array(*[F.when(~rule, F.lit(reason)) for reason, rule in _rules().items()])
    )


def validate_target(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into rows the target takes and rows it refuses, with the reasons."""
    rejected = df.where(~is_valid()).withColumn("reject_reasons", reject_reasons())
    return df.where(is_valid()), rejected


def validate_required(
    df: DataFrame, record: str = "record", keys: Sequence[str] = REQUIRED_KEYS
) -> DataFrame:
    """Raw JSON records that carry all the required keys."""
    return df.where(has_keys(F.col(record), keys))


def newest_first(df: DataFrame) -> list[Column]:
    """Total order over stored postings: published last, then processed last.

    The remaining columns settle ties, so the row that stays does not depend on
    how the data was partitioned.
    """
    first = ["published_date", "processed_at"]
    rest = sorted(c for c in df.columns if c not in {*first, KEY})
    return [F.desc_nulls_last(c) for c in [*first, *rest]]


def clean(df: DataFrame) -> DataFrame:
    """Valid postings, one per id, the newest of each."""
    # rules, group limit and sort all name the columns
    valid, _ = validate_target(computed_once(df))
    return latest_per_key(valid, KEY, newest_first(valid))
