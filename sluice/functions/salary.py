"""Money: salary texts to ranges, ranges to USD a year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions import fixed

MONEY = "decimal(14,2)"


def to_number(digits: Column, k: Column) -> Column:
    """Digits with separators to a double; NULL where they make no number."""
    plain = F.when(digits.rlike(r"^\d{1,3}(\.\d{3})+$"), F.replace(digits, F.lit("."), F.lit(""))).otherwise(digits)
    number = F.replace(plain, F.lit(","), F.lit("")).try_cast("double")
    return F.when(F.coalesce(k, F.lit("")) != "", number * 1000).otherwise(number)


def currency_of(text: Column) -> Column:
    signs = [F.when(F.contains(text, F.lit(sign)), code) for sign, code in fixed.CURRENCY_SIGNS]
    word = F.nullif(F.upper(F.regexp_extract(text, "(?iU)" + fixed.CURRENCY_WORDS, 1)), F.lit(""))
    return F.coalesce(*signs, word, F.lit("USD"))


def period_of(text: Column) -> Column:
    return F.coalesce(*(F.when(F.lower(text).rlike("(?U)" + p), name) for name, p in fixed.PERIODS), F.lit("year"))


def parse_salary(text: Column) -> Column:
    """STRUCT(lo, hi, currency, period); all NULL where the text states no salary."""
    numbers, ks = (F.regexp_extract_all(text, F.lit(fixed.AMOUNT), F.lit(g)) for g in (1, 2))
    first, second = (to_number(F.get(numbers, F.lit(i)), F.get(ks, F.lit(i))) for i in (0, 1))
    both = F.size(numbers) >= 2
    shared_k = both & (F.get(ks, F.lit(1)) != "") & (F.get(ks, F.lit(0)) == "") & (first < 1000)
    first = F.when(shared_k, first * 1000).otherwise(first)
    lo = F.when(both, F.least(first, second)).otherwise(first)
    hi = F.when(both, F.greatest(first, second))
    period = period_of(text)
    broken = first.isNull() | (both & second.isNull())
    usable = F.coalesce((F.size(numbers) > 0) & ~broken & ~((period == "year") & (lo < 1000)), F.lit(False))
    return F.when(usable, F.struct(lo.alias("lo"), hi.alias("hi"), currency_of(text).alias("currency"), period.alias("period")))


def to_usd_year(amount: Column, currency: Column, period: Column, usd_per=None) -> Column:
    rates = F.create_map(*(F.lit(x) for pair in (usd_per or fixed.USD_PER).items() for x in pair))
    factors = F.create_map(*(F.lit(x) for pair in fixed.PER_YEAR.items() for x in pair))
    return F.round(amount.cast("double") * F.try_element_at(factors, period) * F.try_element_at(rates, currency), 2).cast(MONEY)


def stated(raw: Column) -> Column:
    """A stated amount as double: NULL for missing, empty, zero or not a number."""
    value = raw.cast("string").try_cast("double")
    return F.when(value != 0, value)
