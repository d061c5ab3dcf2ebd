"""Text functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_html(text: Column) -> Column:
    """Remove tags and put nothing in their place; entities stay as they are."""
    # No tag ends behind the last ">". Searching there too would read the rest of the
    # text once for every "<", which a text full of them turns into a stuck task.
    tail = F.substring_index(text, ">", -1)
    head = F.left(text, F.length(text) - F.length(tail))
    return F.concat(F.regexp_replace(head, "<[^>]+>", ""), tail)


def first_number(text: Column) -> Column:
    """First run of ASCII digits once commas and spaces are gone, as bigint.

    Sign and fraction are ignored. Null without digits or beyond bigint.
    """
    # The separators matter only behind the first digit, so the search can stop there.
    run = F.regexp_extract(text, "[0-9][0-9, ]*", 0)
    return F.nullif(F.translate(run, ", ", ""), F.lit("")).try_cast("bigint")


def contains_text(text: Column, query: str) -> Column:
    """Whether ``query`` occurs in the text, letter case aside."""
    return F.lower(text).contains(F.lower(F.lit(query)))
