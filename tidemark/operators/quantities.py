"""Quantities printed in different units and scales to one unit.

The identity is ``yearly = amount x scale x times_per_year`` (for pay by the hour with weekly hours:
``x hours x 52``), for both ends of a range and, where another column says what a year's pay comes to (the
median of a grade, say), for that too. What is printed leaves some factors open: a thousands mark on one end
may or may not serve the other, a unit may stand on one end only, in the describing text or nowhere. All
combinations of scales and units are tried. A combination's residual is the absolute logarithm of the quotient
of its ends, plus that of its middle and the expected pay, plus ``MIXED`` where an end gets a unit that neither
it nor the text gives it. The smallest residual is taken; a row for which a combination with other amounts
comes as close is flagged, and so is one whose best combination is far from the expected pay.

The long describing text is searched by the JVM and only where the short one names no unit; Python sees
short texts, in Arrow batches. One scan, no shuffle. Amounts are whole ten-thousandths, so rounding is
exact.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns of each unit of time, in the order they are tried (fixed values).
UNIT_WORDS = {
    "hour": r"\bhour(?:ly|s)?\b|/\s?hr\b|\bp/h\b|\bph\b|\bp\.h\.|/\s?hour\b|/\s?h\b|\bhrly\b",
    "day": r"\bdaily\b|\bday\b|\bp/d\b|\bp\.d\.|\bpd\b",
    "week": r"\bweek(?:ly)?\b|/\s?wk\b|\bp\.w\.|\bp/w\b|\bpw\b",
    "fortnight": r"\bfortnight(?:ly)?\b|/\s?fn\b|\bp/f\b|\bp\.f\.|\bpf\b",
    "month": r"\bmonth(?:ly)?\b|\bp\.m\.|/\s?mth\b|\bp/m\b|\bpm\b",
    "year": r"\byear(?:ly)?\b|\bannum\b|\bannual(?:ly)?\b|\bp\.a\.?|\bpa\b|/\s?yr\b|/\s?pa\b|\bp/a\b",
}
#: Any unit, as the JVM tests it.
ANY_UNIT = "(?i)" + "|".join(UNIT_WORDS.values())
_NUMBER = r"\d{1,3}(?:[ ,]\d{3})+(?:\.\d+)?(?!\d)|\d+(?:\.\d+)?"
_HOURS = r"(\d{2}(?:\.\d+)?)\s?-?(?:h/wk|hrs?/wk|(?:hours?|hrs?)[ -](?:(?:per|a|each)\s)?week)"
_FOREIGN = re.compile(r"\b(?:NZD|USD|FJD|EUR|GBP|CAD|SGD|HKD|JPY|PGK|CHF|CNY|INR)\b|\b(?:NZ|US|CA|HK)\s?\$|[€£¥]|\b(?:euros?|pounds?|yen)\b", re.I)
#: What is paid on top starts at a plus sign or word.
_ON_TOP = re.compile(r"(?:\+|\bplus\b|\b(?:and|including|excluding|incl\.?|excl\.?|with) super|\binclusive of).*$", re.I | re.S)
_GRADES = re.compile(r"\b(?:APS|EL|SES|Executive Level|Level|Band|Grade|Class)\s*(?:Level\s*)?\d+\b|\d+(?:\.\d+)?\s*%", re.I)
_WEEKLY_HOURS = re.compile(r"[\[(,]?\s*(?:based on an? )?" + _HOURS + r"[\])]?", re.I)
_AMOUNT = re.compile(rf"({_NUMBER})(\s?k\b)?([^0-9]*)", re.I)
_UNITS = {name: re.compile(pattern, re.I) for name, pattern in UNIT_WORDS.items()}
#: A line that says what the printed amounts are for: a word for pay, then within the line a unit.
UNIT_LINE = (
    r"(?im)^[^a-z\n]*(?:[a-z]+ ){0,6}?(?:amounts?|figures?|rates?|sums?|pay|remuneration|salar(?:y|ies)|wages?)\b"
    r"[^.\n]{0,40}?\b(hour(?:ly)?|daily|day|week(?:ly)?|fortnight(?:ly)?|month(?:ly)?|year(?:ly)?|annum|annual(?:ly)?)\b"
)
#: Residual of a unit that is not printed where another one is: as much as a factor of about twelve.
MIXED = 2.5
#: Beyond this distance from the expected pay no combination counts as certain.
FAR = math.log(4)
#: Amounts are counted in this part of a dollar, times in the same part of one.
_PART = 10_000
#: Most amounts of one text whose open scales are all tried together.
_MOST_OPEN = 8


def unit_of(text: str) -> str | None:
    """The first unit of time named in ``text``."""
    found = [(m.start(), name) for name, pattern in _UNITS.items() if (m := pattern.search(text))]
    return min(found)[1] if found else None


def _parts(number: str) -> int:
    whole, _, rest = number.replace(",", "").replace(" ", "").partition(".")
    return int(whole) * _PART + int((rest + "0000")[:4])


def read_amounts(text: str) -> tuple[list[tuple[int, bool, str | None]], str | None, int | None]:
    """The first two amounts and later ones marked by a dollar sign (in parts, with a thousands mark or not, with their own unit or none), the unit
    before the first, and weekly hours (in parts)."""
    text = re.sub(r"[\u00a0\u2009\u202f]", " ", text)
    hours = _WEEKLY_HOURS.search(text)
    text = _GRADES.sub(" ", _ON_TOP.sub(" ", _WEEKLY_HOURS.sub(" ", text)))
    found = [m for k, m in enumerate(_AMOUNT.finditer(text)) if k < 2 or text[: m.start()].rstrip().endswith("$")]
    if any(len(m[1]) > 15 for m in found):
        return [], None, None  # no amount has so many digits
    amounts = [(_parts(m[1]), bool(m[2]), unit_of(m[3])) for m in found]
    return amounts, unit_of(text[: found[0].start()]) if found else None, _parts(hours[1]) if hours else None


def solve(
    amounts: list[tuple[int, bool, str | None]], head: str | None, described: str | None, hours: int | None,
    per_year: dict[str, int], tolerance: float, expected: float | None = None, assumed: str | None = "year",
) -> tuple[int, int, str, float, bool] | None:
    """The combination of units and scales with the smallest residual: low, high, unit, residual, unique.

    ``expected``: a year's pay known from elsewhere. ``assumed``: the unit that holds where none is printed;
    with None all units are alike then and the residual decides. Of more than two amounts the least and the
    greatest are the ends; of more than ``_MOST_OPEN`` the scales are taken as printed and the row counts as
    not unique. A printed unit that ``per_year`` lacks gives nothing."""
    if not amounts or min(a[0] for a in amounts) <= 0:
        return None
    stated = head or next((u for *_, u in amounts if u), None) or described or assumed
    if stated is not None and stated not in per_year and not (stated == "hour" and hours):
        return None

    def times(unit: str) -> int | None:
        return hours * 52 if unit == "hour" and hours else per_year[unit] * _PART if unit in per_year else None

    marks = any(m for _, m, _ in amounts)
    many = len(amounts) > _MOST_OPEN
    # ends without a unit of their own share one: the one stated, or at a price any other
    shared = [(stated, 0.0)] if stated else []
    if any(u is None for *_, u in amounts):
        shared += [(u, MIXED if stated else 0.0) for u in per_year if u != stated]
    options = []
    for unit, price in shared:
        ends = []
        for value, mark, own in amounts:
            if (by := times(own or unit)) is None:
                return None
            scales = (1000,) if mark else (1, 1000) if marks and not many else (1,)
            ends.append([((value * scale * by + _PART * _PART // 2) // (_PART * _PART), value * scale * by, own or unit) for scale in scales])
        for chosen in product(*ends):
            first, last = (chosen[0], chosen[-1]) if len(chosen) < 3 else (min(chosen, key=lambda e: e[1]), max(chosen, key=lambda e: e[1]))
            residual = price + abs(math.log(last[1]) - math.log(first[1]))
            if expected and expected > 0:
                residual += abs((math.log(first[1]) + math.log(last[1])) / 2 - math.log(expected * _PART * _PART))
            options.append((residual, first[0], last[0], chosen[0][2]))
    residual, a, b, unit = min(options)
    unique = not many and not any(r <= residual + tolerance and (x, y) != (a, b) for r, x, y, _ in options)
    if expected and expected > 0 and abs((math.log(max(a, 1)) + math.log(max(b, 1))) / 2 - math.log(expected)) > FAR:
        unique = False
    return min(a, b), max(a, b), unit, residual, unique


def to_common_unit(
    df: DataFrame, column: str, described_in: str, per_year: dict[str, int], into: str = "pay", tolerance: float = 0.05,
    expected: str | None = None, assumed: str | None = "year",
) -> DataFrame:
    """Add ``into``: ``struct<low BIGINT, high BIGINT, unit, residual DOUBLE, is_unique BOOLEAN>``.

    ``per_year`` says how often each unit falls in a year. Units come from ``column``, else from a line
    of ``described_in``, else ``assumed`` holds, or with None the residual decides. ``expected`` names a column
    with a year's pay known from elsewhere (null or not positive: unknown). Its fields are null for null or empty texts, texts without an
    amount, amounts in another named currency, amounts of zero or of more than 15 signs, and units not in ``per_year``. Ends are
    put in ascending order. Rows are kept as they are, repeated ones too.
    """

    @F.pandas_udf("low bigint, high bigint, unit string, residual double, is_unique boolean")
    def convert(texts: pd.Series, words: pd.Series, hours: pd.Series, known: pd.Series) -> pd.DataFrame:
        rows = []
        for text, word, hour, pay in zip(texts, words, hours, known):
            found = None
            if isinstance(text, str) and not _FOREIGN.search(text):
                amounts, head, own = read_amounts(text)
                described = unit_of(word) if isinstance(word, str) else None
                own = own or (_parts(hour) if isinstance(hour, str) and hour else None)
                found = solve(amounts, head, described, own, per_year, tolerance, float(pay) if pay == pay and pay is not None else None, assumed)
            rows.append(found or (None,) * 5)
        out = pd.DataFrame(rows, columns=["low", "high", "unit", "residual", "is_unique"])
        return out.astype({"low": "Int64", "high": "Int64", "residual": "float64", "is_unique": "boolean"})

    text, long = F.col(column), F.col(described_in)
    counts = text.rlike(r"\d")
    word = F.when(counts & ~text.rlike(ANY_UNIT), F.regexp_extract(F.regexp_replace(long, r"[ \t]+", " "), UNIT_LINE, 1))
    hours = F.when(counts & ~text.rlike(r"(?i)" + _HOURS), F.regexp_extract(long, r"(?i)\b" + _HOURS, 1))
    known = (F.col(expected) if expected else F.lit(None)).cast("double")
    # not deterministic: a filter on the result would otherwise convert every text twice
    return df.withColumn(into, convert.asNondeterministic()(F.when(counts, text), word, hours, known))


def units_map(units: DataFrame, most: int = 1000) -> dict[str, int]:
    """The small table of units as a map; more than ``most`` units is an error, as units of time are few."""
    rows: Iterable = units.where("unit_name is not null and times_per_year is not null").distinct().limit(most + 1).collect()
    found = {r["unit_name"].strip().lower(): int(r["times_per_year"]) for r in rows}
    if len(found) > most:
        raise ValueError(f"more than {most} units")
    return found


def has_unit(text: Column) -> Column:
    """Whether a short text names a unit of time."""
    return F.coalesce(text.rlike(ANY_UNIT), F.lit(False))
