"""Column to Column functions."""

from jobtide.functions.dates import (
    or_now,
    parse_timestamp,
    period_start,
    processed_at,
    published_date,
)
from jobtide.functions.records import has_keys
from jobtide.functions.salary import salary_rub
from jobtide.functions.skills import (
    detect_skills,
    format_skills,
    skill_names,
    tokens,
)
from jobtide.functions.text import contains_text, first_number, strip_html

__all__ = [
    "contains_text",
    "detect_skills",
    "first_number",
    "format_skills",
    "has_keys",
    "or_now",
    "parse_timestamp",
    "period_start",
    "processed_at",
    "published_date",
    "salary_rub",
    "skill_names",
    "strip_html",
    "tokens",
]
