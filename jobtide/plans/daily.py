"""Daily statistics kept up to date as batches arrive.

    <store>/daily/upto=<n>/   changes of the counters up to batch n, since the entry before

A counter is kept per day and city: postings, postings with a salary, and the sum of their
salaries. Counters add up, so a batch is worth its new rows less the rows they replace, and
reading adds the entries. A refresh reads the batches since the last one and, of the rows
before, those of the same keys; what did not change is not counted again. ``merge_days`` adds the
entries up into one. An entry counts when it holds the marker that is written last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.operators.keyed import distinct_keys
from jobtide.operators.stats import daily_from_counters, day_counters
from jobtide.plans import store as st
from jobtide.schema import KEY

_SCHEMA = "published_date date, city string, postings bigint, paid bigint, salaries bigint"


def _entries(spark: SparkSession, store: str) -> list[int]:
    return list(st._marks(spark, f"{store}/daily", "upto"))


def _entry(store: str, upto: int) -> str:
    return f"{store}/daily/upto={upto}"


def _whole(spark: SparkSession, store: str) -> list[int]:
    """The newest entry that counts from the beginning, and those after it."""
    marks = st._marks(spark, f"{store}/daily", "upto")
    start = max((n for n, text in marks.items() if text == "whole"), default=None)
    return [] if start is None else [n for n in marks if n >= start]


def _write(counters: DataFrame, spark: SparkSession, store: str, upto: int, text: str) -> None:
    """Counters of an entry; those that come to nothing are left out."""
    some = F.greatest(F.abs("postings"), F.abs("paid"), F.abs("salaries")) != 0
    counters.where(some).write.mode("overwrite").parquet(_entry(store, upto))
    st.mark(spark, _entry(store, upto), text)


def refresh_days(spark: SparkSession, store: str, table: str | None = None) -> int:
    """Count the batches that came since the last refresh; returns the last batch counted.

    If the rows before those batches can no longer be told apart, because a merge has
    taken the batches in since, everything is counted anew. A refresh that failed is simply run
    again; a batch that only repeats what is stored changes nothing.
    """
    upto = max(st.batch_numbers(spark, store), default=-1)
    held = _whole(spark, store)
    last = held[-1] if held else -1
    if last >= upto:
        return last
    if not held or not st.has_state(spark, store, last):
        _write(day_counters(st.snapshot(spark, store, table)), spark, store, upto, "whole")
        return upto
    changed = distinct_keys(st.batches(spark, store, after=last).where("status = 'ok'"), KEY)
    before = st.snapshot(spark, store, table, as_of=last).join(changed, KEY, "left_semi")
    after = st.snapshot(spark, store, table).join(changed, KEY, "left_semi")
    gone = day_counters(before)
    gone = gone.select("published_date", "city", *[(-F.col(c)).alias(c) for c in ("postings", "paid", "salaries")])
    _write(_summed(day_counters(after).unionByName(gone)), spark, store, upto, "change")
    return upto


def _summed(counters: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("postings", "paid", "salaries")]
    return counters.groupBy("published_date", "city").agg(*sums)


def _counters(spark: SparkSession, store: str) -> DataFrame:
    held = _whole(spark, store)
    if not held:
        return spark.createDataFrame([], _SCHEMA)
    return _summed(spark.read.schema(_SCHEMA).parquet(*[_entry(store, n) for n in held]))


def stored_days(spark: SparkSession, store: str) -> DataFrame:
    """``daily_stats`` of the store as of the last refresh, from the counters alone."""
    return daily_from_counters(_counters(spark, store))


def merge_days(spark: SparkSession, store: str) -> None:
    """Add all entries up into one, under the number of the last; the ones before are removed."""
    held = _whole(spark, store)
    if len(held) < 2:
        return
    # not in place: the last entry is one of those read
    name = st.scratch_path(store)
    _counters(spark, store).write.parquet(name)
    _write(spark.read.schema(_SCHEMA).parquet(name), spark, store, held[-1], "whole")
    for directory in [name, *[_entry(store, n) for n in _entries(spark, store) if n < held[-1]]]:
        path, fs = st._files(spark, directory)
        fs.delete(path, True)
