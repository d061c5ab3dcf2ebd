"""Incremental ingestion of a landing directory."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from jobtide.plans.batch import prepare, write_batch
from jobtide.plans.store import number_for
from jobtide.sources.raw import Form, raw_records, text_reader


def ingest_new(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    form: Form = "lines",
    processed_at: Column | None = None,
    files_per_batch: int | None = None,
    report: Callable[[int, dict[str, int]], None] | None = None,
) -> None:
    """Put every landed file that was not seen before into the store, then stop.

    The checkpoint remembers the files. A micro-batch that is run again after a
    failure has the same files and gets the same place in the store, where it replaces what
    it wrote. Several landing directories, each with its checkpoint, may go into one store,
    one after another; a checkpoint that is made anew reads all files again, into new
    batches. Files may lie in sub-directories of ``landing``.
    """
    reader = text_reader(spark.readStream, form).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = prepare(raw_records(reader.load(landing), form), processed_at)

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        source = f"{query_id or checkpoint}/{batch_id}"
        counts = write_batch(batch, store, number_for(spark, store, source), source)
        if report:
            report(batch_id, counts)

    query = (
        rows.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
