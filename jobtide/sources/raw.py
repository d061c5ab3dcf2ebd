"""Raw postings from landed JSON, one bad record at a time set aside.

Three forms are read. ``lines`` holds one record per line; such files split, so it
is the form for volume. ``array`` holds one JSON array per file; such a file is
one task and at most 2 GB of text, the limit of a string. ``split`` reads arrays of any
size by many tasks, for a shuffle of their text; it is for batches only.
"""

from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.schema import RAW
from jobtide.sources.arrays import split_arrays

Form = Literal["array", "lines", "split"]

_CORRUPT = "_corrupt_record"
_CHECKED = T.StructType([*RAW.fields, T.StructField(_CORRUPT, T.StringType())])


def raw_records(files: DataFrame, form: Form = "lines") -> DataFrame:
    """Text of each record, with the file it came from and its place in it.

    ``files`` is a text source, batch or streaming, read whole-text for arrays.
    A file that is no JSON array gives one record: its whole text.
    """
    source = files.select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_time"),
    )
    if form == "lines":
        return source.where(F.col("value").rlike(r"\S")).select(
            F.col("value").alias("record"),
            F.lit(True).alias("_readable"),
            "source_file",
            "source_time",
            F.lit(0).alias("source_pos"),
        )
    items = F.from_json("value", "array<string>")
    return (
        source.withColumn("_items", items)
        .withColumn("_readable", F.col("_items").isNotNull())
        .select(
            F.posexplode(F.coalesce("_items", F.array("value"))).alias("source_pos", "record"),
            "_readable",
            "source_file",
            "source_time",
        )
    )


def parse_records(records: DataFrame) -> DataFrame:
    """Add the declared fields and ``parse_error``, null for a good record."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    # A filter on a column of a generator stays above it. Behind a plain projection
    # it would go below, and each record would be parsed once more for every test.
    once = F.explode(F.array(F.from_json("record", _CHECKED, options)))
    parsed = records.select("*", once.alias("_raw"))
    error = (
        F.when(~F.col("_readable"), "file is not a JSON array")
        .when(F.col("_raw").isNull(), "record is not a JSON object")
        .when(F.col(f"_raw.{_CORRUPT}").isNotNull(), "record does not fit the schema")
    )
    return parsed.select(
        *[F.col(f"_raw.{name}") for name in RAW.names],
        *[c for c in records.columns if c != "_readable"],
        error.alias("parse_error"),
    )


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good postings, and rejected records with their text and the reason."""
    good = parsed.where(F.col("parse_error").isNull()).select(*RAW.names)
    rejected = parsed.where(F.col("parse_error").isNotNull()).select(
        "record", "source_file", "parse_error"
    )
    return good, rejected


def text_reader(reader, form: Form):
    """Options of the text source for a form; takes a batch or streaming reader."""
    if form not in ("array", "lines"):
        raise ValueError(f"form must be 'array' or 'lines' here, not {form!r}")
    return reader.format("text").option("wholetext", form == "array")


def landed_records(spark: SparkSession, path: str | list[str], form: Form) -> DataFrame:
    """Text of each landed record, as in ``raw_records``, of files or directories."""
    if form == "split":
        return split_arrays(spark, path)
    return raw_records(text_reader(spark.read, form).load(path), form)


def read_raw(
    spark: SparkSession, path: str | list[str], form: Form = "lines"
) -> tuple[DataFrame, DataFrame]:
    """Good and rejected raw postings of one or more files or directories.

    A path that does not exist raises at once.
    """
    return split_parsed(parse_records(landed_records(spark, path, form)))
