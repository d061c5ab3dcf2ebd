"""Raw postings out of the star-schema test tables.

An order stands for a posting: its customer's nation is the city, its price the
salary, and a part's name gives title and skills. A line item stands for a later
revision of its order's posting, so revisions repeat ids. Some values are made
null or malformed by rule, so that every operator meets them.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.operators.normalize import normalize
from jobtide.schema import KEY, RAW

_FIELD_OF = {
    KEY: "id",
    "title": "name",
    "city": "area",
    "salary_rub": "salary",
    "description": "description",
    "skills": "key_skills",
    "published_date": "published_at",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posting_id(key: Column) -> Column:
    prefix = F.when(key % 50 == 0, "test_").otherwise("v_")
    return F.concat(prefix, key.cast("string"))


def _moment(day: Column) -> Column:
    return F.concat(day.cast("date").cast("string"), F.lit("T10:30:00+0300"))


def _skills(name: Column) -> Column:
    return F.transform(F.split(name, " "), lambda w: F.struct(w.alias("name")))


def _description() -> Column:
    return F.concat(
        F.lit("<p>"), "p_name", F.lit("</p>\n<b>"), "p_brand", F.lit("</b> &amp; "), "p_type"
    )


def _salary(low: Column, high: Column, currency: Column) -> Column:
    return F.struct(low.alias("from"), high.alias("to"), currency.alias("currency"))


def _complete(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """The raw schema, with null for the fields not asked for."""
    return df.select(
        *[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW.fields]
    )


def raw_postings(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """One raw posting per order. Tables that the wanted fields do not need stay out."""
    wanted = wanted or tuple(RAW.names)
    df = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    if {"name", "description", "key_skills"} & set(wanted):
        part = table(spark, sf_dir, "part")
        parts = part.agg(F.count(F.lit(1))).scalar()
        df = df.join(part, key % parts == F.col("p_partkey"), "left")
    if "area" in wanted:
        customer = table(spark, sf_dir, "customer")
        nation = table(spark, sf_dir, "nation")
        df = df.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        df = df.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    price = F.floor("o_totalprice").cast("int")
    currency = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "usd")
        .when(F.col("o_orderpriority") == "2-HIGH", "EUR")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "RUR")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "KZT")
    )
    low = F.when(key % 4 != 0, price)
    high = F.when(key % 3 != 0, price + (key % 1000).cast("int"))
    published = F.when(key % 97 == 1, "unknown").when(key % 97 != 0, _moment(F.col("o_orderdate")))
    fields = {
        "id": lambda: posting_id(key),
        "name": lambda: F.when(key % 89 != 0, F.col("p_name")),
        "area": lambda: F.struct(F.col("n_name").alias("name")),
        "salary": lambda: F.when(key % 12 != 0, _salary(low, high, currency)),
        "description": _description,
        "key_skills": lambda: F.when(key % 7 != 0, _skills(F.col("p_name"))),
        "published_at": lambda: published,
    }
    return _complete(df, {name: fields[name]() for name in {"id", *wanted}})


def raw_revisions(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """One raw posting per line item, under the id of its order's posting."""
    wanted = wanted or tuple(RAW.names)
    df = table(spark, sf_dir, "lineitem")
    if {"name", "key_skills"} & set(wanted):
        part = table(spark, sf_dir, "part")
        df = df.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    currency = (
        F.when(F.col("l_returnflag") == "A", "usd")
        .when(F.col("l_returnflag") == "N", "EUR")
        .otherwise("RUB")
    )
    low = F.floor("l_extendedprice").cast("int")
    fields = {
        "id": lambda: posting_id(F.col("l_orderkey")),
        "name": lambda: F.col("p_name"),
        "salary": lambda: _salary(low, F.lit(None).cast("int"), currency),
        "key_skills": lambda: _skills(F.col("p_name")),
        "published_at": lambda: _moment(F.col("l_shipdate")),
    }
    return _complete(df, {n: fields[n]() for n in {"id", *wanted} & set(fields)})


def at(day: str) -> Column:
    """A fixed processing time."""
    return F.lit(dt.datetime.fromisoformat(day))


def postings(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Normalised postings with the given columns, or all of them."""
    raw = raw_postings(spark, sf_dir, *[_FIELD_OF[c] for c in columns])
    return normalize(raw, at("2024-01-01"))


def revisions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Normalised revisions, several per id, with the given columns or all of them."""
    raw = raw_revisions(spark, sf_dir, *[_FIELD_OF[c] for c in columns])
    return normalize(raw, at("2024-01-02"))
