"""Raw postings to stored postings."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import functions as fn
from jobtide.schema import KEY, RATES


def target_columns(
    processed_at: Column | None = None, rates: Mapping[str, float] = RATES
) -> list[Column]:
    """The target's columns as expressions over a raw posting, all native."""
    return [
        F.col("id").alias(KEY),
        F.col("name").alias("title"),
        F.col("area.name").alias("city"),
        fn.salary_rub(F.col("salary"), rates).alias("salary_rub"),
        fn.strip_html(F.col("description")).alias("description"),
        fn.skill_names(F.col("key_skills")).alias("skills"),
        fn.published_date(F.col("published_at")).alias("published_date"),
        (fn.processed_at() if processed_at is None else processed_at).alias("processed_at"),
    ]


def normalize(
    raw: DataFrame,
    processed_at: Column | None = None,
    rates: Mapping[str, float] = RATES,
) -> DataFrame:
    """Flatten raw postings that have an id to the columns of the target.

    One projection without a Python worker; the null test on the id reaches the
    scan.
    """
    return raw.where(F.col("id").isNotNull()).select(*target_columns(processed_at, rates))
