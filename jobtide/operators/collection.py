"""What a collection run does to its lists and details, on landed tables."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions import contains_text, period_start
from jobtide.operators.keyed import distinct_keys, one_per_key


def union_pages(*pages: DataFrame) -> DataFrame:
    """Pages one after another, duplicates kept, absent columns filled with null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def explode_items(pages: DataFrame, items: str = "items") -> DataFrame:
    """One row per element of a page's array; none for a null or empty array."""
    kept = [c for c in pages.columns if c != items]
    return pages.select(*kept, F.explode(items).alias("item"))


def page_items(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row per element of ``items`` in a JSON response, as JSON text."""
    response = F.from_json(body, "items array<string>")
    return explode_items(pages.withColumn("items", response.getField("items")).drop(body))


def matches_query(
    df: DataFrame, query: str = "DevOps", columns: Sequence[str] = ("title", "description")
) -> DataFrame:
    """Rows in which one of the columns contains the search text, case aside."""
    return df.where(reduce(lambda a, b: a | b, [contains_text(F.col(c), query) for c in columns]))


def published_since(
    df: DataFrame, days_back: int, as_of: Column, column: str = "published_date"
) -> DataFrame:
    """Rows of the last days before ``as_of``, the boundary day included; at least one day."""
    if days_back < 1:
        raise ValueError(f"days_back must be 1 or more, not {days_back}")
    return df.where(F.col(column) >= period_start(as_of, days_back))


def cap(
    df: DataFrame, n: int, published: str = "published_date", key: str = "vacancy_id"
) -> DataFrame:
    """The n latest postings."""
    if n < 0:
        raise ValueError(f"n must be 0 or more, not {n}")
    return df.orderBy(F.desc_nulls_last(published), key).limit(n)


def enrich(
    items: DataFrame,
    details: DataFrame,
    key: str = "id",
    details_unique: bool = False,
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """Attach to each list item its detail; items without one vanish.

    An item gets one detail even if several were collected, the first in
    ``order_by``, so copies on both sides never multiply. A table known to hold
    one detail per key skips that step. Fields on both sides come from the detail.
    """
    if not details_unique:
        rest = [F.desc_nulls_last(c) for c in details.columns if c != key]
        details = one_per_key(details, key, order_by or rest or [F.col(key)])
    shared = [c for c in items.columns if c in details.columns and c != key]
    return items.drop(*shared).join(details, key, "inner")


def missing_details(items: DataFrame, details: DataFrame, key: str = "id") -> DataFrame:
    """List items whose detail could not be collected."""
    return items.join(distinct_keys(details, key), key, "left_anti")


def collection_rate(items: DataFrame, details: DataFrame) -> DataFrame:
    """Details per hundred list items, one decimal; null for an empty list."""
    parts = items.select(F.lit(1).alias("listed"), F.lit(0).alias("detailed")).unionAll(
        details.select(F.lit(0), F.lit(1))
    )
    counts = parts.agg(
        F.coalesce(F.sum("listed"), F.lit(0)).alias("listed"),
        F.coalesce(F.sum("detailed"), F.lit(0)).alias("detailed"),
    )
    share = F.col("detailed") / F.nullif("listed", F.lit(0)) * 100
    return counts.withColumn("rate_pct", F.round(share, 1))
