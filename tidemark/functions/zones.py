"""Time-zone transition tables as plain arrays.

The driver reads the files of all zones of its database once and ships them with the function that uses
them (some 600 files, about 1 MB); a worker builds the table of a zone when it first meets it. Every executor
therefore converts by the same version of the rules, whatever its own database holds.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from importlib import resources
from io import BytesIO
from pathlib import Path
from zoneinfo import TZPATH, ZoneInfo, available_timezones

import numpy as np

#: First and last year the tables cover; outside, the first and last offset hold.
SPAN = (1970, 2100)


def database_version() -> str:
    """Version of the zone database the tables are made from, or ``unknown``."""
    for root in TZPATH:
        for name in ("tzdata.zi", "+VERSION", "version"):
            path = Path(root, name)
            if path.exists():
                first = path.read_text(errors="replace").splitlines()[:1]
                return (first[0] if first else "unknown").replace("# version", "").strip()
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "unknown"


@dataclass(frozen=True)
class ZoneTable:
    """Transitions of one zone: ``offsets[i]`` (seconds east) holds from ``starts[i]`` (UTC seconds)."""

    name: str
    starts: np.ndarray = field(repr=False)
    offsets: np.ndarray = field(repr=False)
    version: str = "unknown"

    @property
    def local_switch(self) -> np.ndarray:
        """Wall-clock seconds from which each next offset is taken.

        A repeated hour is read as its first passage and a skipped one by the offset before the jump.
        """
        return self.starts[1:] + np.maximum(self.offsets[:-1], self.offsets[1:])

    def to_utc(self, wall: np.ndarray) -> np.ndarray:
        """UTC seconds of wall-clock seconds."""
        return wall - self.offsets[np.searchsorted(self.local_switch, wall, side="right")]


def _offset(zone: ZoneInfo, at: int) -> int:
    moment = datetime.fromtimestamp(at, timezone.utc).astimezone(zone)
    return int(moment.utcoffset().total_seconds())


@lru_cache(maxsize=None)
def zone_table(name: str, file: bytes | None = None, version: str | None = None) -> ZoneTable:
    """Build the table of ``name`` by looking for offset changes and bisecting them to the second. ``file``:
    the zone's compiled rules, without which those of the database at hand are taken."""
    zone = ZoneInfo.from_file(BytesIO(file), key=name) if file else ZoneInfo(name)
    day = 86400
    start = int(datetime(SPAN[0], 1, 1, tzinfo=timezone.utc).timestamp())
    end = int((datetime(SPAN[1], 1, 1, tzinfo=timezone.utc) + timedelta(days=1)).timestamp())
    starts, offsets = [np.iinfo(np.int64).min // 4], [_offset(zone, start)]
    at = start
    while at < end:
        after = at + 7 * day
        if (new := _offset(zone, after)) != offsets[-1]:
            low, high = at, after
            while high - low > 1:
                middle = (low + high) // 2
                if _offset(zone, middle) == offsets[-1]:
                    low = middle
                else:
                    high = middle
            starts.append(high)
            offsets.append(new)
        at = after
    return ZoneTable(name, np.array(starts, dtype=np.int64), np.array(offsets, dtype=np.int64), version or database_version())


def fixed_table(name: str, seconds: int) -> ZoneTable:
    """A zone that never changes."""
    return ZoneTable(name, np.array([np.iinfo(np.int64).min // 4]), np.array([seconds]), "fixed")


@lru_cache(maxsize=1)
def zone_files() -> dict[str, bytes]:
    """The compiled rules of every zone of the database that is named by a region and place; short names
    such as EST, which mean different clocks in different countries, are left out."""
    found = {}
    for name in sorted(n for n in available_timezones() if "/" in n):
        place = next((p for p in (Path(root, name) for root in TZPATH) if p.is_file()), None)
        try:
            data = place.read_bytes() if place else resources.files("tzdata").joinpath("zoneinfo", *name.split("/")).read_bytes()
        except (OSError, ModuleNotFoundError):
            continue
        if data.startswith(b"TZif"):
            found[name] = data
    return found


@dataclass
class Zones:
    """Tables by lower-case name, built when first asked for: zones of the database, fixed offsets by
    abbreviation (seconds east) and places by the zone whose clock they keep."""

    files: dict[str, bytes]
    version: str
    fixed: dict[str, int] = field(default_factory=dict)
    places: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.names = {n.lower(): n for n in self.files}

    def get(self, name: str) -> ZoneTable | None:
        """The table of a name, None for a name that is not known."""
        name = self.places.get(name, name).lower()
        if name in self.fixed:
            return fixed_table(name, self.fixed[name])
        full = self.names.get(name)
        return zone_table(full, self.files[full], self.version) if full else None
