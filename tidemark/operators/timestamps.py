"""Mixed timestamp formats and zones to one unambiguous form.

Every text is cut into tokens and the tokens into a mask, one character per token (digit runs by
their length, words by their meaning). Each distinct mask is turned once into a parser, a list of the
token positions that hold year, month, hour and so on; texts are then converted mask by mask, whole
columns at a time, with wall clocks turned into UTC through zone transition tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.zones import Zones, database_version, zone_files

MONTHS = "january february march april may june july august september october november december".split()
WEEKDAYS = "monday tuesday wednesday thursday friday saturday sunday".split()

#: Zone abbreviations taken at their word all year, as seconds east of UTC.
ABBREVIATIONS = {
    "utc": 0, "gmt": 0, "z": 0, "aest": 36000, "aedt": 39600, "acst": 34200, "acdt": 37800, "awst": 28800,
    "nzst": 43200, "nzdt": 46800,
}

#: Places and the zones whose clock they keep.
PLACES = {
    "canberra": "Australia/Sydney", "sydney": "Australia/Sydney", "melbourne": "Australia/Melbourne",
    "hobart": "Australia/Hobart", "brisbane": "Australia/Brisbane", "adelaide": "Australia/Adelaide",
    "darwin": "Australia/Darwin", "perth": "Australia/Perth", "auckland": "Pacific/Auckland",
    "wellington": "Pacific/Auckland", "london": "Europe/London",
}

_PART = r"[A-Za-z_]+(?:-[A-Za-z_]+)*"
_ZONE_PATH = rf"(?:Australia|Pacific|Antarctica|Arctic|Europe|America|Asia|Africa|Atlantic|Indian|Etc|US|Canada|Brazil|Chile|Mexico)/{_PART}(?:/{_PART})?(?:(?<=GMT)[+-]\d{{1,2}})?"
#: What looks like a zone's abbreviation; one that is not known leaves no instant.
_ABBREVIATION = re.compile(r"[A-Z]{2,4}T")
_TOKEN = re.compile(rf"{_ZONE_PATH}|[ap]\.\s?m\.?|[A-Za-z]+|\d+|\s+|.", re.IGNORECASE | re.DOTALL)


def _words() -> dict[str, tuple[str, int]]:
    known: dict[str, tuple[str, int]] = {}
    for i, name in enumerate(MONTHS, 1):
        known[name] = known[name[:3]] = ("b", i)
    known["sept"] = ("b", 9)
    for i, name in enumerate(WEEKDAYS):
        for short in {name, name[:3], name[:4], name[:5]}:
            known[short] = ("w", i)
    for name in ABBREVIATIONS:
        known[name] = ("z", 0)
    for name in PLACES:
        known[name] = ("c", 0)
    known |= {x: ("p", 0) for x in ("am", "a.m.", "a.m", "a. m.")} | {x: ("p", 12) for x in ("pm", "p.m.", "p.m", "p. m.")}
    known |= {x: ("o", 0) for x in ("st", "nd", "rd", "th")} | {x: ("h", 0) for x in ("hrs", "hours", "hr", "h")}
    return known | {"t": ("t", 0), "noon": ("n", 12), "midday": ("n", 12), "midnight": ("n", 0)}


_WORDS = _words()
#: Digit runs get one character each: 1-9 by length, then letters.
_RUN = {n: str(n) if n < 10 else chr(ord("A") + n - 10) for n in range(1, 36)}


def shape(text: str) -> tuple[str, list[str]]:
    """The mask of ``text`` and its tokens, one mask character for each token."""
    mask, tokens = [], []
    for token in _TOKEN.findall(text):
        low = token.lower()
        if token.isdigit() and token.isascii():
            kind = _RUN.get(len(token), "x")
        elif token.isspace():
            kind = " "
        elif low in _WORDS:
            kind = _WORDS[low][0]
        elif "/" in token and len(token) > 1:
            kind = "r"
        elif _ABBREVIATION.fullmatch(token):
            kind = "u"
        elif token[0].isalpha():
            kind = "x"
        else:
            kind = {"–": "-", "—": "-", "’": "'", "−": "-"}.get(token, token)
        mask.append(kind)
        tokens.append(token)
    return "".join(mask), tokens


@dataclass(frozen=True)
class Parser:
    """Token positions of each part, -1 where a text of this mask has none."""

    kind: str
    year: int = -1
    month: int = -1
    day: int = -1
    hour: int = -1
    minute: int = -1
    second: int = -1
    clock: int = -1
    half: int = -1
    noon: int = -1
    zone: int = -1
    sign: int = -1
    zone_hour: int = -1
    zone_minute: int = -1
    swap: bool = False


_DATES = [
    ("ymd", re.compile(r"(?<![1-9A-Z])(?P<year>4)(?P<s>[-/.])(?P<month>[12])(?P=s)(?P<day>[12])(?![1-9A-Z])")),
    ("words", re.compile(r"(?<![1-9A-Z:])(?P<day>[12])o?[ .,-]*(?P<month>b)[ .,-]*'?(?P<year>[24])(?![1-9A-Z:])")),
    ("words", re.compile(r"(?P<month>b)[ .]*(?P<day>[12])o?[ ,]+'?(?P<year>[24])(?![1-9A-Z:])")),
    ("words", re.compile(r"(?<![1-9A-Z:])(?P<year>4)[ -]+(?P<month>b)[ -]+(?P<day>[12])o?(?![1-9A-Z:])")),
    ("numbers", re.compile(r"(?<![1-9A-Z])(?P<day>[12])(?P<s>[-/.])(?P<month>[12])(?P=s)(?P<year>[24])(?![1-9A-Z])")),
    ("packed", re.compile(r"(?<![1-9A-Z])(?P<day>8|C|E)(?![1-9A-Z])")),
]
_TIMES = [
    re.compile(r"(?<![1-9A-Z:.])(?P<hour>[12]):(?P<minute>2)(?::(?P<second>2)(?:[.,][1-9A-Z])?)?(?: *(?P<half>p)| *h)?"),
    re.compile(r"(?<![1-9A-Z:.])(?P<hour>[12])[.](?P<minute>2)(?:(?: *(?P<half>p))| *h)"),
    re.compile(r"(?<![1-9A-Z:.])(?P<hour>[12]) *(?P<half>p)"),
    re.compile(r"t(?P<clock>[46])(?:[.,][1-9A-Z])?|(?<![1-9A-Z:.])(?P<clock2>4) *h"),
    re.compile(r"(?:(?<![1-9A-Z:.])2 +)?(?P<noon>n)"),
]
_OFFSET = re.compile(r" *(?P<sign>[+-])(?:(?P<zone_hour>[12]):(?P<zone_minute>2)|(?P<zone>4))(?![1-9A-Z:]| *h)")
_SHORT_OFFSET = re.compile(r"(?P<sign>[+-])(?P<zone_hour>2)(?![1-9A-Z:-])")


def parser_of(mask: str) -> Parser | None:
    """The parser of a mask, or None where texts of this shape hold no date."""
    if re.fullmatch(r" *-?[A-J] *", mask) and mask.strip(" -") in {_RUN[n] for n in (10, 13, 16, 19)}:
        return Parser("epoch", day=re.search("[A-J]", mask).start())
    for kind, pattern in _DATES:
        if found := pattern.search(mask):
            break
    else:
        return None
    at = {k: found.start(k) for k in ("year", "month", "day") if k in found.groupdict()}
    if kind == "packed":
        at["clock"] = -1 if found["day"] == "8" else found.start("day")
    start, end = found.span()
    rest = mask[:start] + "\x00" * (end - start) + mask[end:]
    for pattern in _TIMES:
        if time := pattern.search(rest):
            at |= {k.rstrip("2"): time.start(k) for k, v in time.groupdict().items() if v}
            tail = rest[time.end() :]
            if offset := (_OFFSET.match(tail) or _SHORT_OFFSET.match(tail)):
                at |= {k: time.end() + offset.start(k) for k, v in offset.groupdict().items() if v}
            break
    if "zone" not in at and "zone_hour" not in at and (zone := re.search("[zrc]", rest) or (re.match(r" *[(\[]? *u", rest[time.end() :]) if time else None)):
        at["zone"] = zone.start() if zone[0][-1] != "u" else time.end() + zone.end() - 1
    return Parser(kind, swap=kind == "numbers", **at)


class Normaliser:
    """Turns texts into closing forms; keeps one parser per mask for the life of a worker.

    ``zones``: the transition tables by lower-case name, ``default``: the one used without a zone. A text with
    a zone that ``zones`` does not know gives nothing and is marked.
    """

    def __init__(self, zones: Zones, default: str):
        self.zones, self.default = zones, default.lower()
        self.parsers: dict[str, Parser | None] = {}

    def __call__(self, texts: pd.Series) -> pd.DataFrame:
        n = len(texts)
        instant = np.zeros(n, dtype=np.int64)
        state = np.zeros(n, dtype=np.int8)  # 0 nothing, 1 a date, 2 an instant, -1 an unknown zone
        by_mask: dict[str, tuple[list[int], list[list[str]]]] = {}
        masks = np.full(n, None, dtype=object)
        for i, text in enumerate(texts):
            if isinstance(text, str) and any(c.isdigit() for c in text):
                mask, tokens = shape(text)
                masks[i] = mask
                rows, parts = by_mask.setdefault(mask, ([], []))
                rows.append(i)
                parts.append(tokens)
        for mask, (rows, parts) in by_mask.items():
            if mask not in self.parsers:
                self.parsers[mask] = parser_of(mask)
            if parser := self.parsers[mask]:
                seconds, what = self._convert(parser, np.array(parts, dtype=object))
                instant[rows], state[rows] = seconds, what
        return pd.DataFrame({"seconds": instant, "state": np.maximum(state, 0), "mask": masks, "unknown": state < 0})

    @staticmethod
    def _numbers(parts: np.ndarray, at: int, default: int = 0) -> np.ndarray:
        if at < 0:
            return np.full(len(parts), default, dtype=np.int64)
        return parts[:, at].astype(str).astype(np.int64)

    def _convert(self, p: Parser, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = len(parts)
        if p.kind == "epoch":
            count = self._numbers(parts, p.day)
            unit = {10: 1, 13: 1000, 16: 10**6, 19: 10**9}[len(parts[0, p.day])]
            negative = np.array([str(row[: p.day].tolist()).count("'-'") > 0 for row in parts]) if p.day else np.zeros(size, bool)
            return np.where(negative, -count, count) // unit, np.full(size, 2, dtype=np.int8)
        clock = None
        if p.kind == "packed":
            digits = parts[:, p.day].astype(str)
            year, month, day = (np.array([int(x[a:b]) for x in digits]) for a, b in ((0, 4), (4, 6), (6, 8)))
            if p.clock == p.day:
                clock = [x[8:] for x in digits]
        else:
            year, day = self._numbers(parts, p.year), self._numbers(parts, p.day)
            if p.kind == "words":
                month = np.array([_WORDS[x.lower()][1] for x in parts[:, p.month]])
            else:
                month = self._numbers(parts, p.month)
            if len(parts[0, p.year]) == 2:
                year = year + 2000
        if p.swap:
            turned = (month > 12) & (day <= 12)
            day, month = np.where(turned, month, day), np.where(turned, day, month)
        good = (month >= 1) & (month <= 12) & (day >= 1) & (year >= 1)
        first = ((np.where(good, year, 1970) - 1970) * 12 + np.where(good, month, 1) - 1).astype("datetime64[M]")
        length = ((first + 1).astype("datetime64[D]") - first.astype("datetime64[D]")).astype(np.int64)
        good &= day <= length
        wall = (first.astype("datetime64[D]").astype(np.int64) + np.where(good, day, 1) - 1) * 86400

        hour, minute, second = (self._numbers(parts, at) for at in (p.hour, p.minute, p.second))
        timed = p.hour >= 0 or p.clock >= 0 or p.noon >= 0
        if p.clock >= 0:
            clock = clock or parts[:, p.clock].astype(str).tolist()
            hour, minute = np.array([int(x[:2]) for x in clock]), np.array([int(x[2:4]) for x in clock])
            second = np.array([int(x[4:6] or 0) for x in clock])
        if p.noon >= 0:
            hour = np.array([_WORDS[x.lower()][1] for x in parts[:, p.noon]])
        if p.half >= 0:
            half = np.array([_WORDS[x.lower()][1] for x in parts[:, p.half]])
            hour = np.where(hour <= 12, hour % 12 + half, hour)
        real = (hour < 24) & (minute < 60) & (second < 60) | (hour == 24) & (minute == 0) & (second == 0)
        wall = wall + np.where(real, hour * 3600 + minute * 60 + second, 0)
        state = np.where(good, np.where(real & timed, 2, 1), 0).astype(np.int8)
        if not timed:
            return wall, state

        if p.sign >= 0:
            if p.zone >= 0:
                packed = self._numbers(parts, p.zone)
                east = packed // 100 * 3600 + packed % 100 * 60
            else:
                east = self._numbers(parts, p.zone_hour) * 3600 + self._numbers(parts, p.zone_minute) * 60
            east = np.where(np.isin(parts[:, p.sign], ["+"]), east, -east)
            return np.where(state == 2, wall - east, wall), state
        names = [x.lower() for x in parts[:, p.zone]] if p.zone >= 0 else [self.default] * size
        utc = wall.copy()
        for name in set(names):
            rows = np.array([x == name for x in names])
            if (table := self.zones.get(name)) is None:
                state[rows & (state == 2)] = -1
            else:
                utc[rows] = table.to_utc(wall[rows])
        return np.where(state == 2, utc, wall), state


def zone_tables() -> Zones:
    """All zones of the database, the abbreviations and the places."""
    return Zones(zone_files(), database_version(), ABBREVIATIONS, PLACES)


def normaliser_udf(default_zone: str = "Australia/Sydney") -> Callable[[Column], Column]:
    """A vectorised function: text to ``struct<closing_norm, instant_utc, plain_date, mask, zone_unknown>``."""
    convert = Normaliser(zone_tables(), default_zone)

    @F.pandas_udf("closing_norm string, instant_utc timestamp, plain_date date, mask string, zone_unknown boolean")
    def normalise(texts: pd.Series) -> pd.DataFrame:
        out = convert(texts)
        stamp = out.seconds.to_numpy().astype("datetime64[s]")
        state = out.state.to_numpy()
        days = np.datetime_as_string(stamp, unit="D").astype(object)
        full = np.char.add(np.datetime_as_string(stamp, unit="s"), "Z").astype(object)
        norm = np.where(state == 2, full, np.where(state == 1, days, None))
        return pd.DataFrame({
            "closing_norm": norm,
            "instant_utc": pd.Series(pd.to_datetime(stamp, utc=True, errors="coerce")).where(state == 2),
            "plain_date": pd.Series(stamp.astype("datetime64[D]").astype(object)).where(state == 1),
            "mask": out["mask"], "zone_unknown": out["unknown"],
        })

    return normalise.asNondeterministic()  # else a filter on the result would convert every text twice


def normalise_timestamps(df: DataFrame, column: str, into: str = "closing", default_zone: str = "Australia/Sydney") -> DataFrame:
    """Add ``into``, a struct with the normal form of ``df[column]``.

    ``closing_norm`` is ``yyyy-MM-ddTHH:mm:ssZ`` where a time of day is given and ``yyyy-MM-dd`` where
    not; ``instant_utc`` or ``plain_date`` hold the same as a value; ``zone_unknown`` marks a time of day whose
    zone is named but not known, which gives nulls. Null, empty and very long texts
    without a date, and dates that do not exist, give nulls. A real date with an impossible time is a
    plain date. No shuffle: equal texts are converted where they lie.
    """
    return df.withColumn(into, normaliser_udf(default_zone)(F.col(column)))
