"""Salary conversion."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.schema import RATES


def salary_mid(salary: Column) -> Column:
    """Mean of both bounds, or the one given, as double; 0 counts as not given."""
    # Cast before adding: the sum of two ints need not be an int.
    low = F.nullif(salary.getField("from").cast("double"), F.lit(0.0))
    high = F.nullif(salary.getField("to").cast("double"), F.lit(0.0))
    return F.coalesce((low + high) / 2, low, high)


def whole_roubles(amount: Column) -> Column:
    """Cut the fraction off; null where the amount does not fit an int."""
    return amount.try_cast("int")


def rate_of(currency: Column, rates: Mapping[str, float] = RATES) -> Column:
    """Rate of a currency whatever its letter case, 1.0 for one not listed."""
    table = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(currency)), F.lit(1.0))


def salary_rub(salary: Column, rates: Mapping[str, float] = RATES) -> Column:
    """Salary struct to whole roubles, null without a usable bound."""
    return whole_roubles(salary_mid(salary) * rate_of(salary.getField("currency"), rates))
