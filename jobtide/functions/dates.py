"""Date and time functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A date and a time of ISO-8601, each with separators or without, any character
# that is no digit between them, and an offset.
_DATE = r"(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(-\d)?|\d{4}W\d{2}\d?)"
_TIME = r"(\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?|\d{2}\d{2}(\d{2}([.,]\d+)?)?)"
_OFFSET = r"([+-]\d{2}(:\d{2}(:\d{2})?|\d{2}(\d{2})?)?)"
# The form the cast reads as it is.
_USUAL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})?\z"
_ISO = rf"(?s)^{_DATE}(\D{_TIME}{_OFFSET}?)?\z"


def published_date(text: Column) -> Column:
    """Date part of an ISO text as it is written; the offset is not applied.

    Malformed text gives null whatever the session's ANSI setting is.
    """
    return text.try_cast("date")


def _week_date(iso: Column) -> Column:
    """Day of an ISO year, week and weekday; a week the year lacks gives null."""
    part = [F.regexp_extract(iso, r"^(\d{4})-?W(\d{2})-?(\d)?", i) for i in (1, 2, 3)]
    year, week = part[0].cast("int"), part[1].cast("int")
    weekday = F.coalesce(F.nullif(part[2], F.lit("")).cast("int"), F.lit(1))
    # The fourth of January lies in the first week of its year.
    monday = F.trunc(F.concat(part[0], F.lit("-01-04")).try_cast("date"), "week")
    day = F.date_add(monday, (week - 1) * 7 + weekday - 1)
    fits = weekday.between(1, 7) & (F.weekofyear(day) == week) & (week >= 1)
    return F.when(fits & (F.extract(F.lit("YEAROFWEEK"), day) == year), day)


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 text, in any of its forms, to a timestamp; null if it is none.

    Text without an offset is read in the session's time zone. Python's reader also
    takes a blank before the offset or a point without digits; those give null.
    """
    usual = text.rlike(_USUAL)
    return F.when(usual, text).otherwise(_completed(text)).try_cast("timestamp")


def _completed(text: Column) -> Column:
    """ISO-8601 text with every separator, and a time down to the seconds."""
    iso = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    iso = F.when(iso.rlike(_ISO), iso)
    by_week = F.concat(
        _week_date(iso).cast("string"),
        F.regexp_replace(iso, r"^\d{4}(-W\d{2}(-\d)?|W\d{2}\d?)", ""),
    )
    by_day = F.regexp_replace(iso, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    iso = F.when(F.substring(iso, 5, 2).contains("W"), by_week).otherwise(by_day)
    time = r"(?s)^(.{10})\D(\d{2})"
    iso = F.regexp_replace(iso, time + r"(\d{2})(\d{2})", "$1T$2:$3:$4")
    iso = F.regexp_replace(iso, time + r"(\d{2})", "$1T$2:$3")
    iso = F.regexp_replace(iso, time + r"(?!:)", "$1T$2:00")
    iso = F.regexp_replace(iso, time + r"(:\d{2})(?!:\d{2})", "$1T$2$3:00")
    iso = F.regexp_replace(iso, r"(?s)^(.{10})\D", "$1T")
    return F.translate(iso, ",", ".")


def processed_at() -> Column:
    """The time of the job, the same for each of its rows."""
    return F.current_timestamp()


def or_now(time: Column) -> Column:
    """The given time, or the time of the job where there is none."""
    return F.coalesce(time, F.current_timestamp())


def period_start(as_of: Column, days_back: int) -> Column:
    """First day of a period of ``days_back`` days ending at ``as_of``."""
    return F.date_sub(as_of, days_back)
