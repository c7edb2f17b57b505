"""Command line: ``ingest``, ``build``, ``validate``, ``current`` and ``coverage``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from tidemark.operators import validate as V
from tidemark.operators.boilerplate import Thresholds
from tidemark.plans import pipeline, quality
from tidemark.session import session
from tidemark.sources.release import provenance, step_summary, write_release
from tidemark.streaming.ingest import ingest


def main(args: list[str] | None = None) -> int:
    """Run one command; 1 where validation fails."""
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("ingest", help="parse text files not seen yet")
    one.add_argument("folder"), one.add_argument("target"), one.add_argument("log"), one.add_argument("checkpoint")
    one.add_argument("--batch", type=int, default=100)
    one = commands.add_parser("build", help="raw notices and rule tables of a folder to a release")
    one.add_argument("tables"), one.add_argument("target")
    one.add_argument("--threshold", type=float, default=0.30), one.add_argument("--min-titles", type=int, default=3)
    one.add_argument("--global-threshold", type=float, default=0.40), one.add_argument("--global-min-titles", type=int, default=30)
    one.add_argument("--dry-run", action="store_true"), one.add_argument("--expectations", help="bounds both layers must meet")
    for name in ("validate", "current"):
        one = commands.add_parser(name, help="a release against expectations")
        one.add_argument("release"), one.add_argument("expectations")
    commands.add_parser("coverage", help="notices without a name").add_argument("release")
    given = parser.parse_args(args)
    spark = session()
    if given.command == "ingest":
        ingest(spark, given.folder, given.target, given.log, given.checkpoint, given.batch).awaitTermination()
    elif given.command == "build":
        limits = Thresholds(given.threshold, 10, given.min_titles, given.global_threshold, 500, given.global_min_titles)
        release = pipeline.build(spark.read.parquet(f"{given.tables}/gazette_vacancies_raw.parquet"), quality.build_inputs(spark, given.tables), {"combined": "weekly", "vacancy_only": "weekly"}, limits, expectations=V.load_expectations(given.expectations) if given.expectations else None)
        rows = release.count()
        print(f"{rows} rows")
        if not given.dry_run:
            write_release(release, given.target, "release", provenance(".", "build", rows, method="1"))
    elif given.command == "coverage":
        missing = V.coverage(spark.read.parquet(given.release), "agency_canonical", ["agency", "division"])
        print(step_summary(missing, "Notices without a name"))
    elif given.command == "current":
        print(V.print_current(spark.read.parquet(given.release), V.load_expectations(given.expectations)))
    else:
        found = V.validate(spark.read.parquet(given.release), V.load_expectations(given.expectations))
        rows = found.orderBy(F.col("severity"), "label").collect()
        for r in rows:
            print(f"{r['severity']}: {r['label']}: {r['n']} ({r['detail']})")
        return int(any(r["severity"] == V.FAIL for r in rows))
    return 0


if __name__ == "__main__":
    sys.exit(main())
