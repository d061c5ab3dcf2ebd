"""A word index of text columns, written once and read by the words of a query."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions import tokens
from jobtide.operators.collection import matches_query
from jobtide.schema import KEY

TEXTS = ("title", "description")


def write_index(
    df: DataFrame, path: str, key: str = KEY, columns: Sequence[str] = TEXTS, mode: str = "errorifexists"
) -> None:
    """Write the postings (word, field, key) of the columns, sorted by word.

    Texts are read once; a row gives each of its words once. Files are cut by word and key, so
    a word that every row holds is many files, and a lookup reads the row groups that may hold
    its words. Rows with a null key are not found. ``mode="append"`` adds the rows of a batch.
    """
    fields = [F.struct(F.lit(c).alias("field"), tokens(F.col(c)).alias("words")) for c in columns]
    held = df.where(F.col(key).isNotNull()).select(key, F.explode(F.array(*fields)).alias("f"))
    postings = held.select(F.explode("f.words").alias("word"), F.col("f.field").alias("field"), key)
    tie = F.xxhash64(key)
    (
        postings.repartitionByRange("word", tie)
        .sortWithinPartitions("word", "field")
        .write.mode(mode)
        .parquet(path)
    )


def search(spark: SparkSession, path: str, query: str, key: str = KEY) -> DataFrame:
    """Keys of the rows of which one indexed column holds all words of a query, case aside.

    Only postings of these words are read; they meet by key, after a count in each task. A
    query without words finds nothing here: no posting speaks for it.
    """
    words = spark.range(1).select(tokens(F.lit(query)).alias("words")).first()["words"]
    if not words:
        return spark.read.parquet(path).select(key).where(F.lit(False))
    found = spark.read.parquet(path).where(F.col("word").isin(words))
    held = found.groupBy(key, "field").agg(F.count_distinct("word").alias("n")).where(F.col("n") == len(words))
    return held.select(key).distinct()


def find(df: DataFrame, path: str, query: str, key: str = KEY, columns: Sequence[str] = TEXTS) -> DataFrame:
    """Rows that hold a query of whole words as it stands, case aside: ``matches_query`` over what the index lets through.

    Differs from it only where the query's first or last word is a part of a longer word.
    """
    keys = search(df.sparkSession, path, query, key)
    return matches_query(df.join(keys, key, "left_semi"), query, columns)
