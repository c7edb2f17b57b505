"""Keyed results of an outside classifier: what is pending, calls with retries, upserts, overrides.

The client is given by the caller: an object with ``classify(text) -> str``. Results are a table keyed by
(gazette_id, vacancy_no); rows that failed have no result and come up again.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import last_valid_object, safe_id
from tidemark.operators.relational import chunked, key_violations, upsert, without_keys

KEYS = ["gazette_id", "vacancy_no"]
ANSWER = "job_family string, confidence string, secondary_family string"


def checked_prompt(path: str, registry: str, version: str) -> str:
    """A prompt's text, if its SHA-256 is the one registered for the version; else an error."""
    text = Path(path).read_bytes()
    known = json.loads(Path(registry).read_text()).get(version)
    if known != hashlib.sha256(text).hexdigest():
        raise SystemExit(f"the prompt is not the one registered as {version}")
    return text.decode()


class Client(Protocol):
    """What a classifier offers."""

    def classify(self, text: str) -> str:
        """The answer to one text."""


def attached(rows: DataFrame, results: DataFrame, columns: list[str], keys: list[str] = KEYS) -> DataFrame:
    """Rows with their results; result keys are unique by ``tripwire``. Null keys match nothing."""
    return rows.join(results.select(*keys, *columns), keys, "left")


def pending(rows: DataFrame, results: DataFrame, pinned: DataFrame | None = None, keys: list[str] = KEYS) -> DataFrame:
    """Rows without a result, or with a null one that no override pins."""
    settled = results.where("job_family is not null").select(*keys)
    if pinned is not None:
        settled = settled.unionByName(pinned.select(*keys))
    return rows.join(settled.distinct(), keys, "left_anti")


def tripwire(results: DataFrame, rows: DataFrame, date: str, keys: list[str] = KEYS) -> DataFrame:
    """Keys with more than one result, and keys of rows that span several years, with a reason."""
    twice = key_violations(results, keys).select(*keys, F.lit("twice in results").alias("reason"))
    spans = rows.groupBy(*keys).agg(F.count_distinct(F.year(date)).alias("years")).where("years > 1").select(*keys, F.lit("several years").alias("reason"))
    return twice.unionByName(spans)


def overridden(results: DataFrame, overrides: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Results with override rows in place of the same keys; columns an override lacks become null."""
    return upsert(results, overrides, keys)


def reclassified(results: DataFrame, rows: DataFrame | None, agency: str | None = None, year: int | None = None, keys: list[str] = KEYS) -> DataFrame:
    """Results without those to be done again: all, or those of rows that match an agency pattern and year."""
    if rows is None or (agency is None and year is None):
        return results.limit(0)
    chosen = rows
    if agency is not None:
        chosen = chosen.where(F.coalesce(F.col("agency_canonical").rlike(f"(?i){agency}"), F.lit(False)))
    if year is not None:
        chosen = chosen.where(F.year(F.col("gazette_date").try_cast("date")) == year)
    return without_keys(results, chosen, keys)


def batches(rows: DataFrame, size: int, *order: str) -> DataFrame:
    """Rows with the number of their batch and an id safe for outside services."""
    return chunked(rows, size, *[F.col(c) for c in order]).withColumn("custom_id", safe_id(*[F.col(k) for k in KEYS]))


def called(rows: DataFrame, text: str, make_client: Callable[[], Client], families: list[str], tries: int = 3, pauses: tuple[float, ...] = (5.0, 10.0), keys: list[str] = KEYS) -> DataFrame:
    """Answers for rows, one client a task: key, raw answer and its parsed fields.

    A call is tried ``tries`` times; rows that fail every time are left out. An answer without a valid
    object gives null fields.
    """
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for part in parts:
            out = []
            for row in part.itertuples(index=False):
                for attempt in range(tries):
                    try:
                        out.append((*row[:-1], client.classify(row[-1])))
                        break
                    except Exception:  # noqa: BLE001 - any failure of the service counts
                        if attempt < tries - 1:
                            time.sleep(pauses[min(attempt, len(pauses) - 1)])
            yield pd.DataFrame(out, columns=[*keys, "raw_response"])

    schema = ", ".join([f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys] + ["raw_response string"])
    answers = rows.select(*keys, text).mapInPandas(run, schema)
    return answers.select(*keys, "raw_response", *answer_fields(F.col("raw_response"), families))


def answer_fields(answer: Column, families: list[str]) -> list[Column]:
    """Family (null unless allowed), confidence and second family of a raw answer; empty texts become null."""
    found = last_valid_object(answer, ANSWER, "job_family", families)
    family = F.when(found["job_family"].isin(families), found["job_family"])
    return [family.alias("job_family"), F.nullif(found["confidence"], F.lit("")).alias("job_family_confidence"), F.nullif(found["secondary_family"], F.lit("")).alias("job_family_secondary")]


def submitted(jobs: dict[int, str], batch_numbers: list[int], submit: Callable[[int], str], saved: Callable[[dict[int, str]], None]) -> dict[int, str]:
    """Submit each batch that has no job yet; ids are saved after each, so a stopped run goes on where it was."""
    for number in batch_numbers:
        if number not in jobs:
            jobs[number] = submit(number)
            saved(jobs)
    return jobs


def polled(jobs: dict[int, str], status: Callable[[str], bool], wait: float = 60.0, most: float = 7200.0, sleep: Callable[[float], None] = time.sleep) -> bool:
    """Wait until all jobs are done; passing errors are borne, False after ``most`` seconds."""
    spent = 0.0
    open_ = set(jobs.values())
    while open_:
        for job in sorted(open_):
            try:
                if status(job):
                    open_.discard(job)
            except OSError:
                continue
        if open_:
            if spent >= most:
                return False
            sleep(wait)
            spent += wait
    return True


def retrieved(answers: DataFrame, ids: DataFrame) -> DataFrame:
    """Answers ``(custom_id, raw_response, error)`` joined to their keys; unknown ids and errors are left out."""
    return ids.select(*KEYS, "custom_id").join(answers.where("error is null"), "custom_id").drop("error")
