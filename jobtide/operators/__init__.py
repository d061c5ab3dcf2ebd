"""DataFrame to DataFrame operators."""

from jobtide.operators.collection import (
    cap,
    collection_rate,
    enrich,
    explode_items,
    matches_query,
    missing_details,
    page_items,
    published_since,
    union_pages,
)
from jobtide.operators.keyed import (
    append_new,
    change_counts,
    changes,
    deduplicate,
    key_clashes,
    latest_per_key,
    upsert,
)
from jobtide.operators.market import (
    by_city,
    count_by_day,
    demand_trend,
    salary_by_skill,
    skill_frequency,
    skills_from_vocabulary,
)
from jobtide.operators.normalize import normalize
from jobtide.operators.rates import rate_join, rates_table
from jobtide.operators.rows import computed_once, delete_where, read_limit, update_where, with_salary
from jobtide.operators.stats import daily_stats, processing_stats
from jobtide.operators.validate import (
    clean,
    newest_first,
    validate_required,
    validate_target,
)

__all__ = [
    "append_new",
    "by_city",
    "cap",
    "change_counts",
    "changes",
    "clean",
    "collection_rate",
    "computed_once",
    "count_by_day",
    "daily_stats",
    "deduplicate",
    "delete_where",
    "demand_trend",
    "enrich",
    "explode_items",
    "key_clashes",
    "latest_per_key",
    "matches_query",
    "missing_details",
    "newest_first",
    "normalize",
    "page_items",
    "processing_stats",
    "published_since",
    "rate_join",
    "rates_table",
    "read_limit",
    "salary_by_skill",
    "skill_frequency",
    "skills_from_vocabulary",
    "union_pages",
    "update_where",
    "upsert",
    "validate_required",
    "validate_target",
    "with_salary",
]
