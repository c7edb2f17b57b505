"""Files from outside, through a fetcher the caller gives."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class Fetcher(Protocol):
    """Access to named files: whether one exists, and its content in pieces."""

    def head(self, url: str) -> bool:
        """Whether the file exists."""

    def get(self, url: str) -> Iterator[bytes]:
        """The content."""


def exists(fetcher: Fetcher, url: str) -> bool:
    """Whether a file is there; any failure means no."""
    try:
        return bool(fetcher.head(url))
    except Exception:  # noqa: BLE001
        return False


def download(fetcher: Fetcher, url: str, write: Callable[[Iterator[bytes]], None], tries: int = 3, pauses: tuple[float, ...] = (5.0, 10.0), sleep: Callable[[float], None] = time.sleep) -> bool:
    """Get a file, trying again after pauses; False if every try fails."""
    for attempt in range(tries):
        try:
            write(fetcher.get(url))
            return True
        except Exception:  # noqa: BLE001
            if attempt < tries - 1:
                sleep(pauses[min(attempt, len(pauses) - 1)])
    return False


def probe(names: DataFrame, make_fetcher: Callable[[], Fetcher], url: str, pause: float = 0.3) -> DataFrame:
    """``names`` with ``is_there``, one fetcher a task and a pause between calls."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher = make_fetcher()
        for part in parts:
            hits = []
            for u in part[url]:
                hits.append(exists(fetcher, u))
                time.sleep(pause)
            part["is_there"] = hits
            yield part

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in names.schema)
    return names.mapInPandas(run, f"{fields}, is_there boolean")
