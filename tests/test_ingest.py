"""The store, the batch job and the stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from test_operators import rows
from test_sources import plan

from jobtide.operators import daily_stats
from jobtide.plans import store as st
from jobtide.plans.batch import process_batch
from jobtide.plans.daily import merge_days, refresh_days, stored_days
from jobtide.schema import KEY, TARGET
from jobtide.streaming import ingest_new


def at():
    return F.lit(dt.datetime(2024, 1, 1))


def posting(key, title="t", salary=None, day="2024-01-01"):
    return {
        "id": key,
        "name": title,
        "salary": salary and {"from": salary, "currency": "RUR"},
        "published_at": f"{day}T10:00:00+0300",
    }


def land(directory, name, *postings, form="lines"):
    directory.mkdir(exist_ok=True, parents=True)
    file = directory / name
    text = (
        json.dumps(postings) if form == "array" else "\n".join(json.dumps(p) for p in postings)
    )
    file.write_text(text)
    return str(file)


def current(spark, store):
    return rows(st.snapshot(spark, store), KEY, "title", "salary_rub")


@pytest.mark.parametrize("form", ["lines", "array"])
def test_batches(spark, tmp_path, form):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    assert current(spark, store) == []
    first = land(
        landing, "1", posting("1", salary=10), posting("2", salary=20), {"name": "no id"},
        posting("3", title=None), {"id": "4", "salary": {"from": 0.5}}, form=form,
    )
    counts = process_batch(spark, first, store, 0, form, processed_at=at())
    assert counts == {"records": 5, "total": 2, "with_salary": 2, "rejected": 3}
    assert current(spark, store) == [("1", "t", 10), ("2", "t", 20)]
    reasons = rows(st.rejects(spark, store), "reject_reasons")
    assert reasons == [
        (["id missing"],),
        (["record does not fit the schema"],),
        (["title missing"],),
    ]
    # The row is replaced as a whole, and a second run of a batch changes nothing.
    second = land(landing, "2", posting("2", "T"), posting("5"), form=form)
    expected = [("1", "t", 10), ("2", "T", None), ("5", "t", None)]
    for _ in range(2):
        process_batch(spark, second, store, 1, form, processed_at=at())
        assert current(spark, store) == expected
    assert st.snapshot(spark, store).columns == TARGET.names


def test_an_empty_batch(spark, tmp_path):
    store = str(tmp_path / "store")
    land(tmp_path / "landing", "1")
    counts = process_batch(spark, str(tmp_path / "landing"), store, 0)
    assert counts == {"records": 0, "total": 0, "with_salary": 0, "rejected": 0}
    assert current(spark, store) == [] and st.rejects(spark, store).count() == 0
    process_batch(spark, land(tmp_path / "landing", "2", posting("1")), store, 1)
    assert current(spark, store) == [("1", "t", None)]
    assert st.compact(spark, store) == 1


@pytest.mark.parametrize("form", ["lines", "array"])
def test_the_winner_does_not_depend_on_the_form(spark, tmp_path, form):
    store = str(tmp_path / "store")
    twice = [posting("1", "b"), posting("1", "a"), posting("2", "x", day="2024-01-02"), posting("2", "z")]
    both = land(tmp_path / "l", "1", *twice, form=form)
    with pytest.raises(ValueError, match="repeated in the batch"):
        process_batch(spark, both, store, 0, form, on_duplicate="error")
    assert current(spark, store) == []
    process_batch(spark, both, store, 0, form, processed_at=at())
    assert current(spark, store) == [("1", "b", None), ("2", "x", None)]


def test_a_late_retry_is_refused_or_skipped(spark, tmp_path):
    landing, store = tmp_path / "l", str(tmp_path / "store")
    paths = [land(landing, str(n), posting(str(n))) for n in range(3)]
    process_batch(spark, paths[1], store, 1)
    assert st.compact(spark, store) == 1
    with pytest.raises(ValueError, match="batch 0 comes after batches up to 1 were merged"):
        process_batch(spark, paths[0], store, 0)
    # its own batch again: it is in the base already
    assert process_batch(spark, paths[1], store, 1)["total"] == 0
    process_batch(spark, paths[2], store, 2)
    st.merge_batches(spark, store)
    assert process_batch(spark, paths[2], store, 2)["total"] == 0
    st.prune(spark, store)
    assert current(spark, store) == [("1", "t", None), ("2", "t", None)]


def test_a_number_belongs_to_its_source(spark, tmp_path):
    landing, store = tmp_path / "l", str(tmp_path / "store")
    first, second = (land(landing, n, posting(n)) for n in "ab")
    process_batch(spark, first, store, 0, source="a")
    with pytest.raises(ValueError, match="written by 'a', not by 'b'"):
        process_batch(spark, second, store, 0, source="b")
    process_batch(spark, first, store, 0, source="a")
    assert current(spark, store) == [("a", "t", None)]


def test_two_landings_and_a_renewed_checkpoint(spark, tmp_path):
    store = str(tmp_path / "store")

    def ingest(name, checkpoint):
        ingest_new(spark, str(tmp_path / name), store, str(tmp_path / checkpoint), processed_at=at())

    land(tmp_path / "a", "1", posting("1", "a"), posting("2", "a"))
    land(tmp_path / "b", "1", posting("2", "b"), posting("3", "b"))
    ingest("a", "ca")
    ingest("b", "cb")
    assert current(spark, store) == [("1", "a", None), ("2", "b", None), ("3", "b", None)]
    st.compact(spark, store)
    land(tmp_path / "a", "2", posting("3", "c"))
    ingest("a", "ca")
    expected = [("1", "a", None), ("2", "b", None), ("3", "c", None)]
    assert current(spark, store) == expected
    # a new checkpoint reads everything again, as one more batch
    ingest("a", "renewed")
    assert current(spark, store) == [("1", "a", None), ("2", "a", None), ("3", "c", None)]
    assert sorted(st.batch_numbers(spark, store)) == [0, 1, 2, 3]


def test_no_success_files_in_the_session(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        store = str(tmp_path / "store")
        process_batch(spark, land(tmp_path / "l", "1", posting("1")), store, 0)
        assert current(spark, store) == [("1", "t", None)]
        assert st.compact(spark, store) == 0
        assert current(spark, store) == [("1", "t", None)]
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_compaction_changes_no_row(spark, tmp_path):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    assert st.compact(spark, store) == -1
    batches = [
        [posting("1", "a", 1), posting("2", "a", 1)],
        [posting("2", "b"), posting("3", "b", 5, "2024-02-01")],
        [posting("1", "c", 7), posting("3", "c", None, "2023-01-01")],
    ]
    for number, postings in enumerate(batches):
        path = land(landing, str(number), *postings)
        process_batch(spark, path, store, number, processed_at=at())
        if number == 1:
            before = st.snapshot(spark, store)
            expected = rows(before)
            assert st.compact(spark, store) == 1
            assert rows(st.snapshot(spark, store)) == expected
    assert current(spark, store) == [("1", "c", 7), ("2", "b", None), ("3", "c", None)]
    assert st.compact(spark, store) == 2
    assert st.compact(spark, store) == 2
    assert current(spark, store) == [("1", "c", 7), ("2", "b", None), ("3", "c", None)]


def test_keyed_base_stays_in_place(spark, tmp_path):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    for number in range(3):
        some = [posting(str(k), f"t{number}", k + 1) for k in range(number, 40, number + 1)]
        process_batch(spark, land(landing, str(number), *some), store, number, processed_at=at())
        if number < 2:
            assert st.compact(spark, store, "base_postings", buckets=4) == number
    merged = st.snapshot(spark, store, "base_postings")
    found = rows(merged)
    base = plan(merged).split("LeftAnti")[1].split("HashAggregate")[0]
    # The base is not shuffled.
    assert "base_postings_v1" in base and "Exchange hashpartitioning" not in base
    spark.sql("DROP TABLE base_postings_v1")
    assert rows(st.snapshot(spark, store)) == found == rows(st.snapshot(spark, store, "none"))
    titles = {k: "t2" if k >= 2 and k % 3 == 2 else "t1" if k % 2 else "t0" for k in range(40)}
    assert current(spark, store) == sorted(
        [(str(k), title, k + 1) for k, title in titles.items()], key=repr
    )


def test_buckets_go_by_rows_not_by_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "BUCKET_BYTES", 1 << 18)
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    found, size = [], []
    for number, n in enumerate((400, 1600)):
        # long texts that all postings share: next to nothing in a file, 1,000 bytes in each row
        some = [posting(str(k), "t", k + 1) | {"description": "d" * 1000} for k in range(n)]
        path = land(landing, str(number), *some, posting("none", None))
        process_batch(spark, path, store, number, processed_at=at())
        assert st.compact(spark, store, "sized_postings") == number
        base = spark.read.table(f"sized_postings_v{number}")
        assert base.count() == n
        files = [p.name for p in (tmp_path / f"store/base/upto={number}").glob("*.parquet")]
        found.append(len(files))
        size.append(sum(p.stat().st_size for p in (tmp_path / "store").rglob("*.parquet")))
        held = base.groupBy(F.input_file_name()).agg(F.sum(F.octet_length("description")).alias("n"))
        # hashes deal the keys, so a bucket may have somewhat more than its share
        assert held.agg(F.max("n")).first()[0] <= 1.5 * st.BUCKET_BYTES
    assert size[0] < st.BUCKET_BYTES and found[0] == 2 and found[1] >= 4 * found[0]
    for number in range(2):
        spark.sql(f"DROP TABLE sized_postings_v{number}")
    assert current(spark, store) == sorted([(str(k), "t", k + 1) for k in range(1600)], key=repr)


def test_unfinished_directories_are_not_read(spark, tmp_path):
    store = str(tmp_path / "store")
    path = land(tmp_path / "landing", "1", posting("1"))
    process_batch(spark, path, store, 0)
    process_batch(spark, land(tmp_path / "landing", "2", posting("2")), store, 1)
    st.compact(spark, store)
    (tmp_path / "store/base/upto=1/_COMPLETE").unlink()
    (tmp_path / "store/batches/batch_id=1/_COMPLETE").unlink()
    assert current(spark, store) == [("1", "t", None)]
    assert st.compact(spark, store) == 0


@pytest.mark.parametrize("form", ["lines", "array"])
def test_stream(spark, tmp_path, form):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    checkpoint = str(tmp_path / "checkpoint")
    reports = []

    def ingest():
        ingest_new(
            spark, str(landing), store, checkpoint, form, at(), 1,
            lambda number, counts: reports.append((number, counts["total"], counts["rejected"])),
        )

    land(landing, "1.json", posting("1", "a"), posting("2", "a"), form=form)
    ingest()
    land(landing / "run_ts=x", "2.json", posting("2", "b"), {"id": None}, posting("3"), form=form)
    ingest()
    expected = [("1", "a", None), ("2", "b", None), ("3", "t", None)]
    assert current(spark, store) == expected
    ingest()
    assert current(spark, store) == expected
    assert reports == [(0, 2, 0), (1, 2, 1)]
    # The same files in one batch give the same postings.
    other = str(tmp_path / "other")
    files = [str(landing / "1.json"), str(landing / "run_ts=x/2.json")]
    process_batch(spark, files, other, 0, form, processed_at=at())
    assert current(spark, other) == expected


def test_a_batch_that_failed_after_its_write_is_replaced(spark, tmp_path):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    checkpoint = str(tmp_path / "checkpoint")
    seen = []

    def ingest(report=None):
        ingest_new(spark, str(landing), store, checkpoint, processed_at=at(), report=report)

    def crash(number, counts):
        seen.append((number, counts["total"]))
        raise RuntimeError("driver lost")

    land(landing, "1.json", posting("1"), {"id": "bad", "salary": 1})
    with pytest.raises(Exception, match="driver lost"):
        ingest(crash)
    # What lands in between belongs to the next batch.
    land(landing, "2.json", posting("2"))
    ingest(lambda number, counts: seen.append((number, counts["total"])))
    assert seen == [(0, 1), (0, 1), (1, 1)]
    assert current(spark, store) == [("1", "t", None), ("2", "t", None)]
    assert st.rejects(spark, store).count() == 1


def days(spark, store):
    return rows(stored_days(spark, store))


def test_days_kept_as_batches_arrive(spark, tmp_path):
    """Counters follow rows that are replaced, moved to another day or city, and repeated."""
    landing, store, checkpoint = tmp_path / "landing", str(tmp_path / "store"), str(tmp_path / "checkpoint")
    assert days(spark, store) == [] and refresh_days(spark, store) == -1

    def run(name, *postings):
        land(landing, name, *postings)
        ingest_new(spark, str(landing), store, checkpoint, processed_at=at())
        return refresh_days(spark, store)

    def same():
        assert days(spark, store) == rows(daily_stats(st.snapshot(spark, store)))
        return days(spark, store)

    def one(key, salary, day, city):
        return posting(key, salary=salary, day=day) | {"area": {"name": city}}

    run("1", one("1", 10, "2024-01-01", "a"), one("2", None, "2024-01-01", "b"), one("3", 7, "2024-01-02", None))
    assert len(same()) == 2
    # a new day, another city, a day that has no posting left, an id twice in a batch
    run("2", one("3", 9, "2024-01-03", "a"), one("1", 11, "2024-01-01", "b"), one("4", 1, "2024-01-03", "c"), one("4", 2, "2024-01-03", "d"))
    assert len(same()) == 2
    assert run("3", one("1", 11, "2024-01-01", "b")) == 2
    same()
    assert len(st._marks(spark, f"{store}/daily", "upto")) == 3
    merge_days(spark, store)
    assert len(st._marks(spark, f"{store}/daily", "upto")) == 1
    same()
    st.merge_batches(spark, store)
    run("4", one("2", 5, "2024-01-05", "b"))
    same()
    # a merge before the refresh takes the rows before with it: all is counted anew
    land(landing, "5", one("2", 6, "2024-01-05", "x"))
    ingest_new(spark, str(landing), store, checkpoint, processed_at=at())
    st.compact(spark, store)
    assert refresh_days(spark, store) == refresh_days(spark, store) == 4
    same()
    with pytest.raises(ValueError, match="merged"):
        st.snapshot(spark, store, as_of=2)


def test_a_source_is_told_by_names_alone(spark, tmp_path):
    store = str(tmp_path / "store")
    first = land(tmp_path / "landing", "1", posting("1"))
    process_batch(spark, first, store, 0, processed_at=at(), source="a/ö=1")
    assert st.batch_numbers(spark, store) == {0: "a/ö=1"}
    with pytest.raises(ValueError, match="too long"):
        st.mark(spark, store, "x" * 151)
