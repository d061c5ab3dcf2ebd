"""Market metrics over stored postings."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobtide.functions.skills import NO_WORD, WORD_CHAR
from jobtide.schema import REPORTED_SKILLS

TREND_DAYS = 7
#: What a term takes in a broadcast, generously.
TERM_BYTES = 256


def count_by_day(df: DataFrame) -> DataFrame:
    """Postings per day."""
    return df.groupBy("published_date").agg(F.count(F.lit(1)).alias("postings"))


def _posting_skills(df: DataFrame) -> DataFrame:
    # Distinct within the row: a skill listed twice is still one posting.
    return df.withColumn("skill", F.explode(F.array_distinct("skills")))


def salary_by_skill(df: DataFrame, skills: Sequence[str] = REPORTED_SKILLS) -> DataFrame:
    """Postings and average salary for each of the named skills."""
    # The intersection also drops a skill's repetitions within a posting.
    named = F.array_intersect("skills", F.array(*[F.lit(s) for s in skills]))
    asked = df.select("salary_rub", F.explode(named).alias("skill"))
    total = F.sum(F.col("salary_rub").cast("bigint"))
    paid = F.count("salary_rub")
    return asked.groupBy("skill").agg(
        F.count(F.lit(1)).alias("postings"),
        F.round(total / F.nullif(paid, F.lit(0)), 2).alias("avg_salary"),
    )


def by_city(df: DataFrame) -> DataFrame:
    """Postings per city and their share of all postings in percent.

    The total is a subquery over the same counts, whose shuffle Spark reuses, so
    the cities never meet in one task.
    """
    cities = df.groupBy("city").agg(F.count(F.lit(1)).alias("postings"))
    total = cities.agg(F.sum("postings")).scalar()
    return cities.withColumn("share_pct", F.round(F.col("postings") * 100.0 / total, 2))


def demand_trend(df: DataFrame, days: int = TREND_DAYS, first_day: dt.date | None = None) -> DataFrame:
    """Postings per day, change from the day before, moving average over ``days`` days.

    Days without postings between the first and the last count as 0 and are listed. The
    ordered window runs over one row per calendar day, whatever the input: a posting of the
    year 1 makes 700,000 rows in one task. With a ``first_day`` postings before it do not count.
    """
    dated = F.col("published_date").isNotNull()
    daily = count_by_day(df.where(dated if first_day is None else F.col("published_date") >= F.lit(first_day)))
    span = daily.agg(F.min("published_date").alias("first"), F.max("published_date").alias("last"))
    every = F.explode(F.sequence("first", "last"))
    calendar = span.where("first IS NOT NULL").select(every.alias("published_date"))
    dense = calendar.join(daily, "published_date", "left")
    ordered = Window.orderBy("published_date")
    recent = ordered.rowsBetween(-(days - 1), 0)
    return dense.select(
        "published_date", F.coalesce("postings", F.lit(0)).cast("bigint").alias("postings")
    ).select(
        "published_date",
        "postings",
        (F.col("postings") - F.lag("postings").over(ordered)).alias("change"),
        F.round(F.avg("postings").over(recent), 2).alias("moving_avg"),
    )


def skill_frequency(df: DataFrame) -> DataFrame:
    """Postings that ask for each skill, the most wanted first."""
    counts = _posting_skills(df.select("skills")).groupBy("skill").agg(
        F.count(F.lit(1)).alias("postings")
    )
    return counts.orderBy(F.desc("postings"), "skill")


def skills_from_vocabulary(
    df: DataFrame,
    vocabulary: DataFrame,
    text: str = "description",
    key: str = "vacancy_id",
) -> DataFrame:
    """Pairs of posting and skill for a vocabulary kept as a table; the same as ``detect_skills``.

    ``vocabulary`` has a column ``skill``: words, terms with signs such as C++, or terms of
    several words. A term is looked up by one of its words only, the one that the fewest texts
    hold, and tested against the text where that word occurs. Terms of one word need no test;
    terms of signs alone are tested in every text. A text is cut into words once to count them,
    if there are terms to choose for, and once to look them up.

    A vocabulary below the session's broadcast threshold goes to every task, and texts stay
    where they are. Of a larger one the words meet in a join by equality; texts are moved once,
    and only if there are terms of several words or signs to be tested in them.
    """
    spark = df.sparkSession
    wanted = vocabulary.where(F.col("skill") != "").select("skill", F.lower("skill").alias("_term")).distinct()
    # words as long as none of the vocabulary's need not be looked up
    lengths = wanted.select(F.explode(_own("_term"))).agg(F.collect_set(F.length("col"))).first()[0]
    anchors = _anchored(df.select(F.lower(text).alias("_text")), wanted, lengths)
    shipped = broadcast_threshold(spark) // TERM_BYTES
    few = anchors.limit(shipped + 1).collect() if shipped > 0 else []
    columns = [key, "skill"]
    if 0 < len(few) <= shipped:
        # the texts have been read for these: they are not worked out again
        anchors = spark.createDataFrame(few, anchors.schema)
        rows = df.select(key, F.lower(text).alias("_text"))
        found = rows.withColumn("_word", F.explode(_words("_text", lengths))).join(F.broadcast(anchors), "_word")
        return found.where(F.col("_lone") | _holds("_text", "_term")).select(*columns)
    words = df.select(F.col(key), F.explode(_words(F.lower(text), lengths)).alias("_word"))
    candidates = words.join(anchors, "_word")
    lone = candidates.where("_lone").select(*columns)
    asked = candidates.where("NOT _lone").select(F.col(key).alias("_key"), "skill", "_term").distinct()
    found = df.select(key, F.lower(text).alias("_text")).join(asked, F.col(key).eqNullSafe(F.col("_key")))
    return lone.unionByName(found.where(_holds("_text", "_term")).select(*columns))


def broadcast_threshold(spark: SparkSession) -> int:
    """Bytes up to which the session broadcasts a side of a join; below 0 never."""
    said = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number = said.rstrip("bkmgtp")
    unit = said[len(number) :].rstrip("b")
    return int(number) << 10 * ("kmgtp".index(unit) + 1) if unit else int(number)


def _words(text: Column | str, lengths: Sequence[int]) -> Column:
    """Distinct words of a text in lower case that have one of the lengths; the empty word is in every text."""
    found = F.array_distinct(F.array_append(F.split(text, NO_WORD), F.lit("")))
    return F.filter(found, lambda w: F.length(w).isin(list(lengths)))


def _holds(text: str, term: str) -> Column:
    """Whether a text holds a term with no letter or digit beside it; the cheap test comes first."""
    quoted = F.concat(F.lit("\\Q"), F.replace(F.col(term), F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    pattern = F.concat(F.lit(f"(?<!{WORD_CHAR})"), quoted, F.lit(f"(?!{WORD_CHAR})"))
    return F.contains(F.col(text), F.col(term)) & F.rlike(F.col(text), pattern)


def _own(term: str) -> Column:
    """Distinct words of a term; the empty word if it has none."""
    words = F.array_remove(F.array_distinct(F.split(term, NO_WORD)), "")
    return F.when(F.size(words) > 0, words).otherwise(F.array(F.lit("")))


def _anchored(texts: DataFrame, wanted: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``wanted`` (skill, _term) with the word each is looked up by and whether that word is all of it.

    Of several words the one that the fewest ``texts`` hold is taken; terms with a word that no
    text holds are left out, as they cannot occur.
    """
    terms = wanted.select("skill", "_term", _own("_term").alias("_own"), F.col("_term").rlike(f"^{WORD_CHAR}+$").alias("_lone"))
    several = terms.where(F.size("_own") > 1)
    simple = terms.where(F.size("_own") == 1).select("skill", "_term", "_lone", F.get("_own", F.lit(0)).alias("_word"))
    if several.isEmpty():
        return simple
    asked = several.select("skill", "_term", "_lone", F.size("_own").alias("_n"), F.explode("_own").alias("_word"))
    held = texts.select(F.explode(_words("_text", lengths)).alias("_word")).join(asked.select("_word").distinct(), "_word", "left_semi")
    counted = held.groupBy("_word").agg(F.count(F.lit(1)).alias("_texts"))
    rarest = F.min(F.struct("_texts", "_word")).alias("_rarest")
    chosen = asked.join(counted, "_word").groupBy("skill", "_term", "_lone", "_n").agg(rarest, F.count(F.lit(1)).alias("_held"))
    return simple.unionByName(chosen.where("_held = _n").select("skill", "_term", "_lone", F.col("_rarest._word").alias("_word")))
