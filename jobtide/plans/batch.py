"""The batch job: landed postings to the store."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobtide.operators.keyed import OnDuplicate
from jobtide.operators.normalize import target_columns
from jobtide.operators.validate import is_valid, reject_reasons
from jobtide.plans.store import ORIGIN, batch_path, claim, mark
from jobtide.schema import KEY, RATES, TARGET
from jobtide.sources.raw import Form, landed_records, parse_records


def prepare(
    records: DataFrame,
    processed_at: Column | None = None,
    rates: Mapping[str, float] = RATES,
) -> DataFrame:
    """Raw records to rows of a batch, each marked ok or rejected.

    A single projection over the records, with no shuffle: rejected records keep
    their text, good ones do not need it.
    """
    rows = parse_records(records).select(
        *target_columns(processed_at, rates), *ORIGIN, "record", "parse_error"
    )
    parsed = F.col("parse_error").isNull()
    ok = parsed & is_valid()
    reasons = F.when(parsed, reject_reasons()).otherwise(F.array("parse_error"))
    return rows.select(
        *TARGET.names,
        *ORIGIN,
        F.when(~ok, F.col("record")).alias("record"),
        F.when(~ok, reasons).alias("reject_reasons"),
        F.when(ok, "ok").otherwise("rejected").alias("status"),
    )


def write_batch(
    rows: DataFrame, store: str, batch_id: int, source: str = "batch"
) -> dict[str, int]:
    """Write one batch and return its counts, taken during the same write.

    The write replaces whatever an earlier attempt at this batch left behind. A batch of
    this source that has been merged already is not written again: its counts are 0.
    Raises where another source holds the number, or a new batch would come too late.
    """
    spark = rows.sparkSession
    if not claim(spark, store, batch_id, source):
        return {"records": 0, "total": 0, "with_salary": 0, "rejected": 0}
    seen = Observation()
    ok = F.col("status") == "ok"
    observed = rows.observe(
        seen,
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(ok, 1)).alias("total"),
        F.count(F.when(ok, F.col("salary_rub"))).alias("with_salary"),
        F.count(F.when(~ok, 1)).alias("rejected"),
    )
    (
        observed.write.mode("overwrite")
        # Replace the whole batch even in a session that overwrites by partition.
        .option("partitionOverwriteMode", "static")
        .partitionBy("status")
        .parquet(batch_path(store, batch_id))
    )
    mark(spark, batch_path(store, batch_id), source)
    return dict(seen.get)


def check_unique(rows: DataFrame) -> None:
    """Raise if a batch holds a key more than once."""
    repeated = (
        rows.where("status = 'ok'").groupBy(KEY).count().where("count > 1").limit(5).collect()
    )
    if repeated:
        raise ValueError(f"{KEY} repeated in the batch: {[r[0] for r in repeated]}")


def process_batch(
    spark: SparkSession,
    path: str | list[str],
    store: str,
    batch_id: int,
    form: Form = "lines",
    on_duplicate: OnDuplicate = "latest",
    processed_at: Column | None = None,
    source: str = "batch",
) -> dict[str, int]:
    """Read, normalise, check and store one landed batch; returns its counts.

    With ``on_duplicate="error"`` a key that comes twice stops the batch before
    anything is written, for which the files are read once more; otherwise the record of
    the later file, then the later published, wins when the store is read. ``source`` names who writes; a number belongs to the source that wrote it.
    """
    rows = prepare(landed_records(spark, path, form), processed_at)
    if on_duplicate == "error":
        check_unique(rows)
    return write_batch(rows, store, batch_id, source)
