"""Reading raw postings, and reading and writing tables."""

from jobtide.sources.buckets import append_keyed, bucket_clashes, rows_beside
from jobtide.sources.jdbc import even_slices
from jobtide.sources.landing import land_raw, latest_batch, newest_batches
from jobtide.sources.layout import z_order, z_order_write
from jobtide.sources.raw import landed_records, parse_records, raw_records, read_raw, split_parsed
from jobtide.sources.search import find, search, write_index
from jobtide.sources.tables import (
    append,
    clustered_write,
    create_target,
    drop_staging,
    from_rows,
    merge_into,
    overwrite,
    preview,
    publish,
    read_days,
    read_table,
    register_view,
    save_keyed_table,
    stage,
)

__all__ = [
    "append",
    "append_keyed",
    "bucket_clashes",
    "clustered_write",
    "create_target",
    "drop_staging",
    "even_slices",
    "find",
    "from_rows",
    "land_raw",
    "landed_records",
    "latest_batch",
    "merge_into",
    "newest_batches",
    "overwrite",
    "parse_records",
    "preview",
    "publish",
    "raw_records",
    "read_days",
    "read_raw",
    "read_table",
    "register_view",
    "rows_beside",
    "save_keyed_table",
    "search",
    "split_parsed",
    "stage",
    "write_index",
    "z_order",
    "z_order_write",
]
