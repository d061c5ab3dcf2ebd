"""The landing directory: one batch per run."""

from typing import Literal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def land_raw(df: DataFrame, directory: str, run_ts: str) -> str | None:
    """Write one raw batch as JSON lines under ``run_ts=<run_ts>``.

    Keys with null values are written too, so that their presence survives. An
    existing run is never overwritten; an empty batch leaves nothing. The rows are
    computed once.
    """
    path = f"{directory.rstrip('/')}/run_ts={run_ts}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    if seen.get["n"]:
        return path
    spark = df.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return None


def newest_batches(
    spark: SparkSession, directory: str, unit: Literal["file", "run"] = "run"
) -> DataFrame:
    """The file modified last, or the run directory completed last: one row, or none.

    Only file names and times are listed, no content is read. A run counts when it holds
    ``_SUCCESS``; one still being written, or that failed half-way, is passed over.
    """
    if unit == "file":
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(directory)
            .select("path", "modificationTime")
        )
    else:
        jvm = spark.sparkContext._jvm
        marks = jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/*/_SUCCESS")
        fs = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        # one entry per run
        done = [
            (s.getPath().getParent().toString(), s.getModificationTime())
            for s in fs.globStatus(marks) or ()
        ]
        files = spark.createDataFrame(done, "path string, millis long").select(
            "path", F.timestamp_millis("millis").alias("modificationTime")
        )
    newest = files.agg(
        F.max_by("path", F.struct("modificationTime", "path")).alias("path"),
        F.max("modificationTime").alias("modified_at"),
    )
    return newest.where(F.col("path").isNotNull())


def latest_batch(
    spark: SparkSession, directory: str, unit: Literal["file", "run"] = "run"
) -> str:
    """Path of the newest batch; raises if nothing has landed."""
    row = newest_batches(spark, directory, unit).first()
    if row is None:
        raise FileNotFoundError(f"no batch in {directory}")
    return row["path"]
