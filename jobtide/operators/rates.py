"""Currency rates that come as a table."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.salary import salary_mid, whole_roubles
from jobtide.schema import RATES


def rates_table(spark: SparkSession, rates: Mapping[str, float] = RATES) -> DataFrame:
    """Rates as rows of currency and rate."""
    table = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    return spark.range(1).select(F.explode(table).alias("currency", "rate"))


def rate_join(raw: DataFrame, rates: DataFrame) -> DataFrame:
    """Add ``salary_rub`` to raw postings, looking the rate up in a table.

    ``rates`` holds one rate per currency. No hint: Spark broadcasts it while it
    is below the session's threshold, and otherwise adaptive execution splits the
    few currencies that every posting shares, for which the rates are grouped by
    a hash too (see ``one_per_key``).
    """
    name = F.upper("currency")
    known = rates.groupBy(name.alias("_currency"), F.xxhash64(name).alias("_hash")).agg(
        F.max("rate").alias("_rate")
    )
    matched = raw.join(known, F.upper("salary.currency") == F.col("_currency"), "left")
    amount = salary_mid(F.col("salary")) * F.coalesce("_rate", F.lit(1.0))
    salary = whole_roubles(amount)
    return matched.withColumn("salary_rub", salary).drop("_currency", "_hash", "_rate")
