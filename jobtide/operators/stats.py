"""Counts of a run and the daily statistics."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_counts() -> list[Column]:
    """Aggregates a run reports; they also serve ``DataFrame.observe``."""
    return [
        F.count(F.lit(1)).alias("total"),
        F.count("salary_rub").alias("with_salary"),
    ]


def processing_stats(df: DataFrame) -> DataFrame:
    """Postings and postings with a salary, in one pass."""
    return df.agg(*run_counts())


def daily_stats(df: DataFrame) -> DataFrame:
    """Per published date: postings, average salary as int, distinct cities.

    Newest first, postings without a date before all others. The average rounds
    half away from zero in whole numbers, so neither the order of addition nor a
    sum beyond 2^53 can move it.
    """
    per_day = df.groupBy("published_date").agg(
        F.count(F.lit(1)).alias("total_vacancies"),
        F.sum(F.col("salary_rub").cast("bigint")).alias("_sum"),
        F.count("salary_rub").alias("_n"),
        F.countDistinct("city").alias("cities_count"),
    )
    return _reported(per_day)


def _reported(per_day: DataFrame) -> DataFrame:
    """The report of days with their number, and sum and number of salaries."""
    half_up = F.expr("(2 * abs(_sum) + _n) div nullif(2 * _n, 0)")
    average = F.when(F.col("_sum") < 0, -half_up).otherwise(half_up).cast("int")
    return per_day.select(
        "published_date", "total_vacancies", average.alias("avg_salary"), "cities_count"
    ).orderBy(F.desc_nulls_first("published_date"))


def day_counters(df: DataFrame) -> DataFrame:
    """Per day and city: postings, those with a salary, and the sum of salaries. Counters of parts add up."""
    return df.groupBy("published_date", "city").agg(
        F.count(F.lit(1)).alias("postings"),
        F.count("salary_rub").alias("paid"),
        F.coalesce(F.sum(F.col("salary_rub").cast("bigint")), F.lit(0)).cast("bigint").alias("salaries"),
    )


def daily_from_counters(counters: DataFrame) -> DataFrame:
    """``daily_stats`` from summed ``day_counters``; days and cities that have come to nothing do not count."""
    per_day = counters.groupBy("published_date").agg(
        F.sum("postings").alias("total_vacancies"),
        F.sum("salaries").alias("_sum"),
        F.sum("paid").alias("_n"),
        F.count(F.when(F.col("postings") > 0, F.col("city"))).alias("cities_count"),
    )
    return _reported(per_day.where("total_vacancies > 0"))
