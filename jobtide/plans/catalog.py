"""Every operator as a query over the test tables."""

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide import functions as fn
from jobtide import operators as op
from jobtide import sources as src
from jobtide.plans import store as st
from jobtide.plans.adapter import (
    at,
    posting_id,
    postings,
    raw_postings,
    raw_revisions,
    revisions,
    table,
)
from jobtide.plans.batch import process_batch
from jobtide.plans.daily import refresh_days, stored_days
from jobtide.schema import KEY, RAW, TARGET
from jobtide.streaming import ingest_new

# Words of the test tables, in the place of real skills.
PART_SKILLS = ("widget", "bolt", "gear", "red", "anvil")
VOCABULARY = ("The", "license", "of and", "que", "C++", "the MIT License", "2.0", "$$$ the")
TEXT_SKILLS = ("The", "license", "of and", "que", "eaux", "C++")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def scratch(spark: SparkSession) -> str:
    """A new directory in the folder shared by the cluster, or a local one in tests."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    directory = f"{shared.rstrip('/')}/jobtide-{uuid.uuid4().hex}"
    # Hadoop removes it when the driver ends.
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return directory


def joined(column: str) -> Column:
    """An array as text; comparing arrays is not every checker's strength."""
    return F.array_join(column, "|", "<null>").alias(column)


# Normalisation


@query
def daily_stats(spark, sf_dir):
    return op.daily_stats(postings(spark, sf_dir, "city", "salary_rub", "published_date"))


@query
def normalize_postings(spark, sf_dir):
    df = postings(spark, sf_dir)
    return df.select(
        KEY, "title", "city", "salary_rub", "description", joined("skills"), "published_date"
    )


@query
def salary_rub(spark, sf_dir):
    raw = raw_postings(spark, sf_dir, "salary")
    return raw.select("id", fn.salary_rub(F.col("salary")).alias("salary_rub"))


@query
def rate_join(spark, sf_dir):
    raw = raw_postings(spark, sf_dir, "salary")
    return op.rate_join(raw, op.rates_table(spark)).select("id", "salary_rub")


@query
def processing_stats(spark, sf_dir):
    return op.processing_stats(postings(spark, sf_dir, "salary_rub"))


@query
def with_salary(spark, sf_dir):
    return op.with_salary(postings(spark, sf_dir, "salary_rub")).select(KEY, "salary_rub")


# Functions


@query
def strip_html(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", fn.strip_html(F.col("html")).alias("text"))


@query
def skill_names(spark, sf_dir):
    raw = raw_postings(spark, sf_dir, "key_skills")
    named = raw.select("id", fn.skill_names(F.col("key_skills")).alias("skills"))
    return named.select("id", F.size("skills").alias("n_skills"), joined("skills"))


@query
def format_skills(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    pieces = fn.format_skills(F.split("text", ","))
    return documents.select("doc_id", pieces.alias("skills")).select("doc_id", joined("skills"))


@query
def published_date(spark, sf_dir):
    raw = raw_postings(spark, sf_dir, "published_at")
    return raw.select("id", fn.published_date(F.col("published_at")).alias("published_date"))


@query
def parse_timestamp(spark, sf_dir):
    # A different spelling of the same kind of time for each type of event.
    day = F.substring(F.col("ts").cast("string"), 1, 10)
    time = F.substring(F.col("ts").cast("string"), 12, 8)
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.concat(day, F.lit("T"), time, F.lit("Z")))
        .when(kind == "click", F.concat(day, F.lit(" "), time, F.lit("+03:00")))
        .when(kind == "signup", F.concat(day, F.lit("T"), time, F.lit("-0530")))
        .when(
            kind == "purchase",
            F.concat(
                F.translate(day, "-", ""), F.lit("T"), F.translate(time, ":", ""), F.lit("+0300")
            ),
        )
        .otherwise(F.concat(F.lit("at "), day))
    )
    parsed = fn.parse_timestamp(text)
    return table(spark, sf_dir, "events").select(
        "event_id", F.unix_micros(parsed).alias("epoch_us")
    )


@query
def first_number(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", fn.first_number(F.col("text")).alias("number"))


@query
def detect_skills(spark, sf_dir):
    found = fn.detect_skills(F.col("text"), TEXT_SKILLS).alias("skills")
    return table(spark, sf_dir, "documents").select("doc_id", found).select(
        "doc_id", joined("skills")
    )


@query
def skills_from_vocabulary(spark, sf_dir):
    words = table(spark, sf_dir, "benchmark").select(
        F.explode(fn.tokens(F.col("text"))).alias("skill")
    )
    documents = table(spark, sf_dir, "documents")
    return op.skills_from_vocabulary(documents, words, text="text", key="doc_id")


@query
def vocabulary_terms(spark, sf_dir):
    terms = spark.createDataFrame([(t,) for t in VOCABULARY], "skill string")
    documents = table(spark, sf_dir, "documents")
    return op.skills_from_vocabulary(documents, terms, text="text", key="doc_id")


# Checks and row changes


@query
def validate_required(spark, sf_dir):
    raw = raw_postings(spark, sf_dir, "id", "name", "salary")
    records = raw.select("id", F.to_json(F.struct("id", "name", "salary")).alias("record"))
    return op.validate_required(records, keys=("id", "name", "salary")).select("id")


@query
def validate_target(spark, sf_dir):
    valid, _ = op.validate_target(postings(spark, sf_dir, "title", "city"))
    return valid.select(KEY, "title", "city")


def _number() -> Column:
    return F.regexp_extract(KEY, "[0-9]+", 0).cast("long")


def _spoiled(df: DataFrame, by: Column) -> DataFrame:
    """Rows that break each rule of the target, and some that break two, by a number."""
    columns = {
        "title": F.when(by % 5 != 0, F.col("title")),
        "city": F.when(by % 7 == 0, F.repeat(F.lit("c"), 101)).otherwise(F.col("city")),
        KEY: F.when(by % 11 == 0, F.rpad(KEY, 51, "x")).when(by % 13 != 0, F.col(KEY)),
    }
    return df.withColumns(columns)


@query
def rejected_postings(spark, sf_dir):
    _, rejected = op.validate_target(_spoiled(postings(spark, sf_dir, "title", "city"), _number()))
    return rejected.select(KEY, joined("reject_reasons"))


@query
def clean_postings(spark, sf_dir):
    # the newest revision of an id may be invalid, and then an older one stands
    cleaned = op.clean(_spoiled(op.computed_once(revisions(spark, sf_dir)), F.col("salary_rub")))
    return cleaned.select(KEY, "title", "salary_rub", joined("skills"), "published_date")


@query
def latest_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    newest = [F.desc("ts"), F.desc("event_id")]
    return op.latest_per_key(events, "user_id", newest).select(
        "user_id", "event_id", "event_type", "value"
    )


@query
def delete_where(spark, sf_dir):
    df = postings(spark, sf_dir, "title")
    return op.delete_where(df).select(KEY, "title")


@query
def update_where(spark, sf_dir):
    df = postings(spark, sf_dir, "salary_rub")
    updated = op.update_where(df, F.col(KEY) == "test_100", {"salary_rub": 200_000})
    return updated.select(KEY, "salary_rub")


@query
def read_limit(spark, sf_dir):
    df = postings(spark, sf_dir, "salary_rub", "published_date")
    return op.read_limit(df, 10).select(KEY, "salary_rub", "published_date")


# Keyed tables


@query
def append_new(spark, sf_dir):
    df = postings(spark, sf_dir, "salary_rub").select(KEY, "salary_rub")
    return op.append_new(op.delete_where(df), df.where(F.col(KEY).contains("test_")))


@query
def key_clashes(spark, sf_dir):
    target = postings(spark, sf_dir, "salary_rub")
    return op.key_clashes(op.delete_where(target), revisions(spark, sf_dir, "salary_rub"))


@query
def upsert(spark, sf_dir):
    target, batch = postings(spark, sf_dir), revisions(spark, sf_dir)
    merged = op.upsert(target, batch, on_duplicate="latest", order_by=op.newest_first(batch))
    return merged.select(
        KEY, "title", "city", "salary_rub", joined("skills"), "published_date"
    )


@query
def upsert_unique(spark, sf_dir):
    # the default policy, with a batch that holds each key once
    target = postings(spark, sf_dir, "title", "salary_rub").select(KEY, "title", "salary_rub")
    some = target.where(_number() % 3 == 0)
    new = some.select(F.concat(F.lit("new_"), KEY).alias(KEY), "title", "salary_rub")
    changed = some.withColumn("salary_rub", F.col("salary_rub") + 1).withColumn("title", F.lit(None))
    return op.upsert(target, changed.unionByName(new))


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Postings, and a batch of which a third is new, a third changed and a third as it was."""
    target = postings(spark, sf_dir, "title", "salary_rub", "skills").select(KEY, "title", "salary_rub", "skills")
    by = _number() % 30
    some = target.where(by.isin(0, 1, 2))
    name = F.when(by == 0, F.concat(F.lit("new_"), KEY)).otherwise(F.col(KEY))
    # a null for a value is a change, and so is a skill more
    title = F.when((by == 1) & (_number() % 4 != 0), F.lit(None)).otherwise(F.col("title"))
    skills = F.when((by == 1) & (_number() % 4 == 0), F.array_append("skills", F.lit(None))).otherwise(F.col("skills"))
    return target, some.select(name.alias(KEY), title.alias("title"), "salary_rub", skills.alias("skills"))


@query
def upsert_changes(spark, sf_dir):
    target, batch = _versions(spark, sf_dir)
    return op.changes(target, batch).select(KEY, "title", "salary_rub", F.size("skills").alias("n_skills"), "change")


@query
def upsert_counts(spark, sf_dir):
    return op.change_counts(op.changes(*_versions(spark, sf_dir)))


# Collection


@query
def enrich(spark, sf_dir):
    listed = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return op.enrich(listed, table(spark, sf_dir, "labels"), "doc_id")


@query
def missing_details(spark, sf_dir):
    listed = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return op.missing_details(listed, table(spark, sf_dir, "labels"), "doc_id")


@query
def collection_rate(spark, sf_dir):
    return op.collection_rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def union_pages(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
    )
    return op.union_pages(customers, suppliers)


@query
def explode_items(spark, sf_dir):
    pages = table(spark, sf_dir, "documents").select(
        "doc_id", F.filter(F.split("text", "\n"), lambda line: line != "").alias("items")
    )
    return op.explode_items(pages)


@query
def page_items(spark, sf_dir):
    names = F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("name")))
    body = F.to_json(F.struct(names.alias("items"), F.col("p_size").alias("found")))
    return op.page_items(table(spark, sf_dir, "part").select("p_partkey", body.alias("body")))


@query
def matches_query(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return op.matches_query(documents, "LICENSE", ("text", "source")).select("doc_id", "lang")


@query
def published_since(spark, sf_dir):
    df = postings(spark, sf_dir, "published_date")
    return op.published_since(df, 30, F.lit("2001-08-01").cast("date")).select(
        KEY, "published_date"
    )


@query
def cap(spark, sf_dir):
    df = postings(spark, sf_dir, "published_date", "salary_rub")
    return op.cap(df, 100).select(KEY, "published_date", "salary_rub")


@query
def published_in_years(spark, sf_dir):
    df = postings(spark, sf_dir, "published_date")
    return op.published_since(df, 1500, F.lit("2001-08-01").cast("date")).select(
        KEY, "published_date"
    )


@query
def cap_many(spark, sf_dir):
    df = postings(spark, sf_dir, "published_date", "salary_rub")
    return op.cap(df, 12_000).select(KEY, "published_date", "salary_rub")


# Market metrics


@query
def count_by_day(spark, sf_dir):
    return op.count_by_day(postings(spark, sf_dir, "published_date"))


@query
def salary_by_skill(spark, sf_dir):
    return op.salary_by_skill(postings(spark, sf_dir, "salary_rub", "skills"), PART_SKILLS)


@query
def by_city(spark, sf_dir):
    return op.by_city(postings(spark, sf_dir, "city"))


@query
def demand_trend(spark, sf_dir):
    return op.demand_trend(postings(spark, sf_dir, "published_date"))


@query
def skill_frequency(spark, sf_dir):
    return op.skill_frequency(postings(spark, sf_dir, "skills"))


# Landing, ingestion and storage: these write to a scratch directory and read back


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A posting per order as JSON; pending ones have a fraction for a salary."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    fraction = F.struct((F.floor("o_totalprice") + 0.5).alias("from"))
    whole = F.struct(F.floor("o_totalprice").cast("int").alias("from"))

    def record(salary: Column) -> Column:
        return F.to_json(
            F.struct(
                posting_id(key).alias("id"),
                F.col("o_orderpriority").alias("name"),
                salary.alias("salary"),
                F.col("o_orderstatus").alias("status"),
            )
        )

    pending = F.col("o_orderstatus") == "P"
    text = F.when(pending, record(fraction)).otherwise(record(whole))
    return orders.select(text.alias("value"), key.alias("key"))


def _land_mixed(spark: SparkSession, sf_dir: str) -> str:
    """The mixed postings as JSON lines."""
    path = scratch(spark)
    _mixed(spark, sf_dir).select("value").write.text(path)
    return path


def _land_arrays(spark: SparkSession, records: DataFrame) -> str:
    """JSON texts with a key as files of one array each, 2,000 keys to a file."""
    path = scratch(spark)
    items = F.concat(F.lit("["), F.array_join(F.collect_list("value"), ",\n"), F.lit("]"))
    files = records.groupBy(F.floor(F.col("key") / 2000).alias("part")).agg(items.alias("value"))
    files.write.partitionBy("part").text(path)
    return path


@query
def read_raw(spark, sf_dir):
    good, _ = src.read_raw(spark, _land_mixed(spark, sf_dir))
    return good.select("id", "name", F.col("salary.from").alias("salary_from"))


@query
def rejected_records(spark, sf_dir):
    _, rejected = src.read_raw(spark, _land_mixed(spark, sf_dir))
    return rejected.select(F.get_json_object("record", "$.id").alias("id"), "parse_error")


@query
def read_raw_array(spark, sf_dir):
    path = _land_arrays(spark, _mixed(spark, sf_dir))
    good, _ = src.read_raw(spark, path, "array")
    return good.select("id", "name", F.col("salary.from").alias("salary_from"))


@query
def read_raw_split(spark, sf_dir):
    path = _land_arrays(spark, _mixed(spark, sf_dir))
    good, _ = src.read_raw(spark, path, "split")
    return good.select("id", "name", F.col("salary.from").alias("salary_from"))


@query
def rejected_array(spark, sf_dir):
    # besides the misfits, elements that are no objects
    mixed = _mixed(spark, sf_dir)
    number = F.when(F.col("key") % 500 == 1, F.col("key").cast("string")).otherwise(F.col("value"))
    path = _land_arrays(spark, mixed.withColumn("value", number))
    _, rejected = src.read_raw(spark, path, "array")
    name = F.coalesce(F.get_json_object("record", "$.id"), F.col("record"))
    return rejected.select(name.alias("id"), "parse_error")


@query
def land_raw(spark, sf_dir):
    landed = src.land_raw(
        raw_postings(spark, sf_dir, "name", "salary", "key_skills"),
        scratch(spark),
        "20240101_000000",
    )
    back = spark.read.schema(RAW).json(landed)
    return back.select(
        "id", "name", F.col("salary.to").alias("salary_to"), joined("key_skills.name")
    ).withColumnRenamed("key_skills.name", "skills")


@query
def latest_batch(spark, sf_dir):
    landing = scratch(spark)
    src.land_raw(raw_postings(spark, sf_dir, "salary"), landing, "20240101_000000")
    src.land_raw(raw_revisions(spark, sf_dir), landing, "20240102_000000")
    good, _ = src.read_raw(spark, src.latest_batch(spark, landing))
    return good.select("id", "name", F.col("salary.from").alias("salary_from"))


def _urgent(
    spark: SparkSession, sf_dir: str, currency: str = "usd", times: int = 2
) -> DataFrame:
    """New versions of the postings paid in a currency: more pay, no city kept."""
    raw = raw_postings(spark, sf_dir, "name", "salary", "published_at")
    paid = F.col("salary").withField("to", F.col("salary.to") * times)
    raw = raw.where(F.col("salary.currency") == currency)
    return raw.withColumn("salary", paid.withField("from", F.lit(0)))


def _stored(df: DataFrame) -> DataFrame:
    return df.select(KEY, "title", "city", "salary_rub", "published_date")


@query
def process_postings(spark, sf_dir):
    landing, store = scratch(spark), scratch(spark)
    first = src.land_raw(raw_postings(spark, sf_dir), landing, "20240101_000000")
    process_batch(spark, first, store, 0, processed_at=at("2024-01-01"))
    return _stored(st.snapshot(spark, store))


@query
def ingest_postings(spark, sf_dir):
    landing, store, checkpoint = scratch(spark), scratch(spark), scratch(spark)
    src.land_raw(raw_postings(spark, sf_dir), landing, "20240101_000000")
    ingest_new(spark, landing, store, checkpoint, processed_at=at("2024-01-01"))
    st.compact(spark, store)
    src.land_raw(_urgent(spark, sf_dir), landing, "20240102_000000")
    ingest_new(spark, landing, store, checkpoint, processed_at=at("2024-01-02"))
    return _stored(st.snapshot(spark, store))


@query
def ingest_array(spark, sf_dir):
    raw = raw_postings(spark, sf_dir)
    whole = F.to_json(F.struct(*RAW.names), {"ignoreNullFields": "false"}).alias("value")
    number = F.regexp_extract("id", "[0-9]+", 0).cast("long").alias("key")
    landing, store = _land_arrays(spark, raw.select(whole, number)), scratch(spark)
    ingest_new(spark, landing, store, scratch(spark), "array", at("2024-01-01"))
    return _stored(st.snapshot(spark, store))


@query
def ingest_two_sources(spark, sf_dir):
    store, places = scratch(spark), [(scratch(spark), scratch(spark)) for _ in range(2)]

    def run(place, raw, day):
        src.land_raw(raw, place[0], day)
        ingest_new(spark, place[0], store, place[1], processed_at=at("2024-01-01"))

    run(places[0], raw_postings(spark, sf_dir), "1")
    run(places[1], _urgent(spark, sf_dir), "1")
    st.merge_batches(spark, store)
    st.compact(spark, store)
    # what comes from the first source after that is a new batch of the store
    run(places[0], _urgent(spark, sf_dir, "EUR", 3), "2")
    st.merge_batches(spark, store)
    st.prune(spark, store)
    return _stored(st.snapshot(spark, store))


@query
def keyed_snapshot(spark, sf_dir):
    landing, store, checkpoint = scratch(spark), scratch(spark), scratch(spark)
    name = f"postings_{uuid.uuid4().hex}"
    src.land_raw(raw_postings(spark, sf_dir), landing, "1")
    ingest_new(spark, landing, store, checkpoint, processed_at=at("2024-01-01"))
    st.compact(spark, store, name)
    src.land_raw(_urgent(spark, sf_dir), landing, "2")
    ingest_new(spark, landing, store, checkpoint, processed_at=at("2024-01-02"))
    merged = _stored(st.snapshot(spark, store, name))
    spark.sql(f"DROP TABLE {name}_v0")  # the files stay in the store
    return merged


@query
def daily_stats_kept(spark, sf_dir):
    # three batches, the later ones replacing rows of the earlier; counted as they come
    landing, store, checkpoint = scratch(spark), scratch(spark), scratch(spark)
    batches = [raw_postings(spark, sf_dir), _urgent(spark, sf_dir), _urgent(spark, sf_dir, "EUR", 3)]
    for day, raw in enumerate(batches, 1):
        src.land_raw(raw, landing, f"2024010{day}_000000")
        ingest_new(spark, landing, store, checkpoint, processed_at=at("2024-01-01"))
        refresh_days(spark, store)
    return stored_days(spark, store)


# Tables and views


@query
def target_table(spark, sf_dir):
    place, name = scratch(spark), f"target_{uuid.uuid4().hex}"
    src.create_target(spark, name, place)
    made = [{KEY: "made_1", "title": "made", "salary_rub": 150_000, "skills": ["Docker"]}]
    src.append(src.from_rows(spark, made), name)
    src.append(postings(spark, sf_dir).where("title IS NOT NULL").select(*TARGET.names), name)
    staged = src.stage(src.read_table(spark, name).where("salary_rub IS NOT NULL"))
    copy = f"{name}_paid"
    for _ in range(2):
        src.overwrite(src.read_table(spark, staged).select(KEY, "salary_rub"), copy)
    src.drop_staging(spark, staged)
    paid = src.read_table(spark, copy).agg(F.count("*"), F.sum("salary_rub")).first()
    spark.sql(f"DROP TABLE {copy}")
    spark.sql(f"DROP TABLE {name}")  # its files stay at their place
    return spark.read.schema(TARGET).parquet(place).select(
        KEY, "title", "salary_rub", F.lit(paid[0]).alias("n_paid"), F.lit(paid[1]).alias("sum_paid")
    )


@query
def stats_view(spark, sf_dir):
    name = f"postings_{uuid.uuid4().hex}"
    src.register_view(postings(spark, sf_dir, "salary_rub", "published_date"), name)
    found = spark.sql(
        f"SELECT published_date, count(*) AS postings, max(salary_rub) AS most FROM {name} "
        "GROUP BY published_date"
    )
    src.drop_staging(spark, name)
    return found


@query
def defaults(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    given = F.when(F.col("event_id") % 3 != 0, F.col("ts"))
    filled = fn.or_now(given)
    return events.select(
        "event_id",
        F.coalesce(filled == given, F.lit(False)).alias("kept"),
        (given.isNull() & (filled == fn.processed_at())).alias("filled"),
    )


@query
def clustered_postings(spark, sf_dir):
    path = scratch(spark)
    columns = (KEY, "city", "salary_rub", "published_date")
    src.clustered_write(postings(spark, sf_dir, *columns[1:]).select(*columns), path)
    days = src.read_days(spark, path, dt.date(2001, 6, 15), dt.date(2001, 7, 14))
    return days.select(*columns)


@query
def z_ordered_postings(spark, sf_dir):
    # looked up by either column alone
    path = scratch(spark)
    columns = (KEY, "city", "salary_rub", "published_date")
    src.z_order_write(postings(spark, sf_dir, *columns[1:]).select(*columns), path)
    back = spark.read.parquet(path)
    by_city = back.where(F.col("city") == "GERMANY").select(*columns, F.lit("city").alias("asked"))
    paid = back.where(F.col("salary_rub").between(20_000_000, 30_000_000))
    return by_city.unionByName(paid.select(*columns, F.lit("salary").alias("asked")))


@query
def bucket_clashes(spark, sf_dir):
    name = f"keyed_{uuid.uuid4().hex}"
    target = postings(spark, sf_dir, "salary_rub").select(KEY, "salary_rub")
    src.save_keyed_table(op.delete_where(target), name, KEY, 16, scratch(spark))
    # a few postings that are there, some that are not, and some that come twice
    batch = revisions(spark, sf_dir, "salary_rub").where(_number() % 97 == 5).select(KEY, "salary_rub")
    batch = batch.unionByName(target.where(F.col(KEY).isin("v_33", "test_100")))
    clashes = src.bucket_clashes(batch, name)
    spark.sql(f"DROP TABLE {name}")  # its files stay at their place
    return clashes


@query
def indexed_search(spark, sf_dir):
    path, documents = scratch(spark), table(spark, sf_dir, "documents")
    src.write_index(documents, path, "doc_id", ("text", "source"))
    found = [src.find(documents, path, q, "doc_id", ("text", "source")) for q in ("mit License", "SRC7", "licensed under the")]
    asked = [f.select("doc_id", "lang", F.lit(n).alias("query")) for n, f in enumerate(found)]
    return op.union_pages(*asked)


@query
def even_slices(spark, sf_dir):
    # one value fills nearly half of the column
    lines = table(spark, sf_dir, "lineitem")
    skewed = F.when(F.col("l_linenumber") <= 2, F.lit(1)).otherwise(F.col("l_quantity").cast("int"))
    rows = lines.select(skewed.alias("quantity"), F.col("l_orderkey").alias("key"))
    slices = src.even_slices(rows, "quantity", 8, then="key")
    held = F.array_compact(F.array(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(slices)]))
    per = rows.select(F.explode(held).alias("slice")).groupBy("slice").agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("rows"), (F.max("n") <= 1.5 * F.avg("n")).alias("even"))
