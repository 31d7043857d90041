"""Locations and kinds of employment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions import fixed


def guess_country(location: Column, default: Column | str | None = None, rules=None) -> Column:
    """The first rule that fits decides, else the default."""
    place = F.lower(F.coalesce(location, F.lit("")))
    fallback = default if isinstance(default, Column) else F.lit(default).cast("string")
    return F.coalesce(*(F.when(place.rlike("(?U)" + p), code) for code, p in (rules or fixed.COUNTRIES)), fallback)


def employment_type(values: Column, kinds=None) -> Column:
    """The first known kind in an array of strings."""
    lookup = F.create_map(*(F.lit(x) for pair in (kinds or fixed.EMPLOYMENT).items() for x in pair))
    found = F.array_compact(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.try_element_at(lookup, F.lower(F.trim(v)))))
    return F.get(found, F.lit(0))
