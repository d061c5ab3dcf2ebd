"""From raw documents to packed sequences, in five stages.

Toxic documents go, one document of each group of near-duplicates stays, secrets are
masked, sources are mixed to their weights, and what is left is packed. Each stage takes
(spark, docs, sf_dir) and all that the one before has kept; its result is written as
Parquet and read again, so a lost executor costs no more than its own stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import bagminhash, mixing, packing, toxicity
from jobtide.llm import secrets as secret_scans
from jobtide.llm.text import saved, table, words


def carried(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, and each row whole, so that no name of its other columns can clash."""
    return docs.select(*columns, F.struct(*docs.columns).alias("row"))


#: A document is rejected from this probability on.
TOXIC = 0.7


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic.

    Null and empty texts are not. Each of several rows of one id, or of none, is judged by its own
    text, and equal texts alike. An empty table stays empty, columns of any name stay as they are.
    """
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(carried(docs, "text"), model).filter(F.col("score") < TOXIC).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class, null the largest, then by words.

    A row that repeats another's id and words counts as its copy; rows that share an id,
    or have none, but differ in words are documents of their own. Null, empty and blank texts are
    copies of each other. An empty table stays empty, columns of any name stay as they are.
    """
    found = saved(bagminhash.members(docs), "members")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("l")
    kept = found.groupBy("label").agg(least).select(F.col("l.doc_id").alias("_kept"), F.col("l.node").alias("_of"))
    same = F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.col("_node") == F.col("_of"))
    left = bagminhash.noded(carried(docs, "doc_id", "text"), "_node").join(kept, same)
    unique = found.groupBy("doc_id", "node").agg(F.count("*").alias("n")).filter("n > 1").limit(1).isEmpty()
    if not unique:
        # the copy that stays does not depend on the order of rows
        left = left.groupBy("doc_id", "_node").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return left.select("row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked and n_chars counted anew where one was.

    Null and empty texts have none. Rows of one id, or of none, are masked each by its own text. An
    empty table stays empty, other columns of any name stay as they are.
    """
    found = secret_scans.scan(carried(docs, "doc_id", "text"))
    masked = found.withColumn("text", secret_scans.redacted(F.col("text"), F.col("secrets")))
    n_chars = F.when(F.size("secrets") > 0, F.length("text")).otherwise(F.col("row.n_chars")).cast("long")
    new = {"text": F.col("text"), "n_chars": n_chars}
    return masked.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, a row for each time.

    Null, empty and blank texts are never taken; a null source is a source of its own. Rows of one
    id are taken or left together. An empty table stays empty, columns of any name stay as they are.
    """
    sized = carried(docs, "doc_id", "source", "text").select("doc_id", "source", F.size(words(F.col("text"))).alias("n"), "row")
    return mixing.repeated(mixing.copies(sized, F.col("n")).select("row", "copies")).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens.

    Null and empty texts are an end token; each of several rows of one id, or of none, is packed. An
    empty table gives no rows.
    """
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mix),
    ("packing", pack),
]

#: Learned scores, signatures and token ids are beyond SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
