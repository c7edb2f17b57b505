"""Order, placement and guarded values of columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """The listed columns that exist, in order, then all others as they stand."""
    order = list(order)
    return df.select(*[c for c in order if c in df.columns], *[c for c in df.columns if c not in order])


def placed_after(df: DataFrame, anchor: str, *names: str) -> DataFrame:
    """Move columns behind ``anchor`` (to the end where that is missing)."""
    rest = [c for c in df.columns if c not in names]
    at = rest.index(anchor) + 1 if anchor in rest else len(rest)
    return df.select(*rest[:at], *[n for n in names if n in df.columns], *rest[at:])


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that exist."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def remapped(value: Column, changes: dict[str, str]) -> Column:
    """Listed values replaced, all others and null kept."""
    if not changes:
        return value
    table = F.create_map(*[F.lit(x) for pair in changes.items() for x in pair])
    return F.coalesce(table[value], value)


def with_default(df: DataFrame, name: str, default: Column) -> DataFrame:
    """Add a column where it is missing, fill its nulls where not."""
    return df.withColumn(name, F.coalesce(F.col(name), default) if name in df.columns else default)


def unless(df: DataFrame, name: str, condition: Column) -> DataFrame:
    """Null a value where the condition holds; where it is unknown the value stays."""
    return df.withColumn(name, F.when(~F.coalesce(condition, F.lit(False)), F.col(name)))


def guarded_range(df: DataFrame, low: str, high: str, raw: str, ceiling: float = 500_000, floor: float = 1_000, far: float = 30_000) -> DataFrame:
    """Null implausible ends of a range, each rule on what the rules before left: ends above ``ceiling``,
    an upper end under the lower, a lower end under ``floor`` beside an upper above ``far``, and a lower
    end whose text is a single digit before a dash."""
    a, b = F.col(low), F.col(high)
    df = unless(df, high, b > ceiling)
    df = unless(df, low, a > ceiling)
    df = unless(df, high, a > b)
    df = unless(df, low, (a < floor) & (b > far))
    return unless(df, low, F.col(raw).rlike("^\\$[1-9]\\s*[-–]"))


def guarded_date(df: DataFrame, date: str, reference: str, most_days: int = 365) -> DataFrame:
    """Null a date more than so many days before the reference."""
    return unless(df, date, F.datediff(F.col(reference), F.col(date)) > most_days)


def emptied(df: DataFrame, names: Iterable[str], placeholders: Iterable[str]) -> DataFrame:
    """Null exact placeholder values, untrimmed, in the columns that exist."""
    values = list(placeholders)
    return df.withColumns({n: F.when(~F.coalesce(F.col(n).isin(values), F.lit(False)), F.col(n)) for n in names if n in df.columns})


def not_equal(value: Column, other: str) -> Column:
    """True where a value is not ``other``, also where it is null."""
    return ~value.eqNullSafe(F.lit(other))
