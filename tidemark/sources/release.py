"""Publishing: data files, a sidecar that says what they are, and pushes that skip what is there."""

from __future__ import annotations

import hashlib
import json
import os
import subprocess

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.ledger import write_csv
from tidemark.sources.store import Store


def file_hash(path: str) -> str:
    """SHA-256 of a file, read in pieces of 1 MiB."""
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while piece := f.read(1 << 20):
            digest.update(piece)
    return digest.hexdigest()


def provenance(folder: str, stage: str, rows: int, **versions: str) -> dict[str, str]:
    """What made a release: the commit (marked if files were changed), stage, versions and row count; what
    cannot be found out is ``unknown``."""
    def git(*args: str) -> str:
        done = subprocess.run(["git", "-C", folder, *args], capture_output=True, text=True, check=False)
        return done.stdout.strip() if done.returncode == 0 else "unknown"

    commit = git("rev-parse", "HEAD")
    if commit != "unknown" and git("status", "--porcelain") not in ("", "unknown"):
        commit += "-dirty"
    return {"git_sha": commit, "stage": stage, "row_count": str(rows), **{k: v or "unknown" for k, v in versions.items()}}


def write_release(df: DataFrame, folder: str, name: str, notes: dict[str, str], partition_by: list[str] | None = None) -> None:
    """Parquet and gzip CSV below ``folder`` (on any file system), each written beside its place and renamed,
    and a sidecar JSON with size and hash of every file.

    ``notes`` are also kept in the footer of every parquet file, as metadata of the first column under
    ``release``, where ``notes_of`` finds them again.
    """
    spark = df.sparkSession
    store = Store(spark, folder)
    first = df.columns[0]
    noted = df.withMetadata(first, {**df.schema[first].metadata, "release": dict(notes)})
    for kind in ("parquet", "csv"):
        fresh = f"_{name}.{kind}.new"
        if kind == "parquet":
            w = noted.write.mode("overwrite")
            (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{folder}/{fresh}")
        else:
            df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(f"{folder}/{fresh}")
        store.replace(fresh, f"{name}.{kind}")
    files = [f for kind in ("parquet", "csv") for f in store.listed(f"{name}.{kind}")]
    entries = [{"key": key, "bytes": size, "sha256": store.digest(key)} for key, size in files]
    store.write(f"{name}.json", json.dumps({**notes, "files": entries}, indent=2).encode())


def notes_of(df: DataFrame) -> dict[str, str]:
    """What a release read back says about itself; empty for other tables."""
    return next((dict(f.metadata["release"]) for f in df.schema if "release" in f.metadata), {})


def write_audit(audit: DataFrame, folder: str, name: str, date: str) -> None:
    """An audit as CSV, all quoted, by body and falling share, under a stable and a dated name; an empty audit
    is written as well. Sorting is by range, so no task holds all rows but for the one file at the end, which
    an audit of repeated sentences fits."""
    rows = audit.orderBy(F.col("body").asc_nulls_last(), F.col("pct_of_bin").desc(), "key")
    for stem in (name, f"{name}-{date.replace('-', '')}"):
        write_csv(rows, f"{folder}/{stem}.csv")


def to_push(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Files ``(key, sha256)`` that the other side lacks or has with another hash."""
    return local.join(remote.select("key", "sha256"), ["key", "sha256"], "left_anti")


def write_snapshot(df: DataFrame, folder: str, date: str) -> None:
    """A dated copy; other dates are not touched."""
    stamped = df.withColumn("snapshot_date", F.lit(date))
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(folder)


def required(names: list[str], environment: dict[str, str] | None = None) -> dict[str, str]:
    """Settings from the environment; an error names all that are missing."""
    env = os.environ if environment is None else environment
    if missing := [n for n in names if not env.get(n)]:
        raise SystemExit("missing: " + ", ".join(missing))
    return {n: env[n] for n in names}


def step_summary(report: DataFrame, title: str, most: int = 50) -> str:
    """The first rows of a report as a Markdown table for a build's summary page; a last line says how many
    there are where not all are shown."""
    rows = report.limit(most + 1).collect()
    more = f"\n\nThe first {most} of {report.count()} rows." if len(rows) > most else ""
    rows = rows[:most]
    head = "| " + " | ".join(report.columns) + " |\n|" + " --- |" * len(report.columns)
    return f"### {title}\n\n{head}\n" + "\n".join("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows) + more


def warnings_of(findings: DataFrame, most: int = 50) -> list[str]:
    """Findings as annotation lines of a build service, the failures first; a last line tells of further ones."""
    rows = findings.orderBy("severity", "label", "detail").limit(most + 1).collect()
    lines = [f"::{'error' if r['severity'] == 'FAIL' else 'warning'}::{r['label']}: {r['n']} ({r['detail']})" for r in rows[:most]]
    return lines + ([f"::warning::more than {most} findings"] if len(rows) > most else [])
