"""Raw JSON records."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.schema import REQUIRED_KEYS


def has_keys(record: Column, keys: Sequence[str] = REQUIRED_KEYS) -> Column:
    """Whether a JSON object carries every key; a key with a null value counts."""
    wanted = F.array(*[F.lit(key) for key in keys])
    absent = F.size(F.array_except(wanted, F.json_object_keys(record)))
    # Text that is no object has no keys at all, and a null size in ANSI mode.
    return F.coalesce(absent == 0, F.lit(False))
