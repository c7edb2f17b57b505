"""Checks of a release as one aggregate: each check adds expressions, all run in a single pass.

Findings are rows ``(severity, label, detail, n)``; a caller stops on any FAIL.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.relational import compared, small_side

FAIL, WARN = "FAIL", "WARN"
FINDING = "severity string, label string, detail string, n bigint"


@dataclass(frozen=True)
class Check:
    """A value observed by an aggregate and the comparison under which it is a finding."""

    label: str
    severity: str
    observed: Column
    broken: str  # comparison that follows the value, such as ``> 0``
    detail: str


def load_expectations(path: str) -> dict:
    """Committed bounds; a missing or unreadable file is an error, there are no defaults."""
    return json.loads(Path(path).read_text())


def observed(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row for each check with the value observed, all in one pass."""
    one = df.agg(*[c.observed.cast("double").alias(f"c{i}") for i, c in enumerate(checks)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c.label).alias("label"), F.col(f"c{i}").alias("v")) for i, c in enumerate(checks)])))


def findings(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Findings of all checks over ``df``."""
    one = df.agg(*[c.observed.cast("double").alias(f"c{i}") for i, c in enumerate(checks)])
    rows = [
        F.when(F.expr(f"c{i} {c.broken}"), F.struct(
            F.lit(c.severity).alias("severity"), F.lit(c.label).alias("label"), F.lit(c.detail).alias("detail"), F.col(f"c{i}").cast("bigint").alias("n"),
        ))
        for i, c in enumerate(checks)
    ]
    return one.select(F.inline(F.filter(F.array(*rows), lambda x: x.isNotNull())))


def at_least(label: str, value: Column, bound: float, severity: str = FAIL) -> Check:
    """A lower bound."""
    return Check(label, severity, value, f"< {bound}", f"at least {bound:g} expected")


def at_most(label: str, value: Column, bound: float, severity: str = FAIL) -> Check:
    """An upper bound."""
    return Check(label, severity, value, f"> {bound}", f"at most {bound:g} expected")


def none(label: str, condition: Column, detail: str, severity: str = FAIL) -> Check:
    """No row may meet a condition."""
    return Check(label, severity, F.count_if(F.coalesce(condition, F.lit(False))), "> 0", detail)


def within(label: str, value: Column, low: float, high: float, severity: str = WARN) -> Check:
    """A range."""
    return Check(label, severity, F.when(value.between(low, high), F.lit(0)).otherwise(F.lit(1)), "> 0", f"between {low:g} and {high:g} expected")


def release_checks(df: DataFrame, expectations: dict) -> list[Check]:
    """The checks that the columns of ``df`` and the expectations allow; absent bounds are dormant."""
    c, e, checks = F.col, expectations, []
    if "min_release_rows" in e:
        checks.append(at_least("release rows", F.count(F.lit(1)), e["min_release_rows"]))
    for agency, bound in e.get("min_agency_rows", {}).items():
        checks.append(at_least(f"rows of {agency}", F.count_if(c("agency_canonical") == agency), bound))
    if e.get("max_agency_canonical_nulls") is not None:
        checks.append(at_most("agency_canonical nulls", F.count_if(c("agency_canonical").isNull()), e["max_agency_canonical_nulls"], WARN))
    if "gazette_type" in df.columns and e.get("gazette_types"):
        checks.append(none("gazette_type domain", ~c("gazette_type").isin(e["gazette_types"]), "unexpected value"))
    if {"salary_min", "salary_max"} <= set(df.columns):
        checks.append(none("salary inverted", c("salary_min") > c("salary_max"), "lower end above upper"))
        checks.append(none("salary ceiling", F.greatest("salary_min", "salary_max") > 500_000, "above 500,000"))
    if {"location", "location_normalised"} <= set(df.columns):
        checks.append(none("location gap", c("location").isNotNull() & c("location_normalised").isNull(), "location without its normal form"))
    if "division" in df.columns:
        checks.append(none("division artifacts", c("division").rlike(r"\d{4}\.pdf|Portfolio\)"), "file name or portfolio"))
    for name in ("location", "classification", "position_number", "office_arrangement", "office_arrangement_details", "agency_website"):
        if name in df.columns:
            checks.append(none(f"bleed in {name}", c(name).rlike(r"\S  [A-Z][a-z]"), "another field's label"))
    for name, kind in df.dtypes:
        if kind == "string":
            checks.append(none(f"empty {name}", c(name) == "", "empty text instead of null"))
    if (b := e.get("boilerplate_residual")) and "description_clean" in df.columns:
        recent = c("description_clean").isNotNull() & (c("gazette_date") >= F.lit(b["since"]).cast("date"))
        share = 100 * F.count_if(recent & F.contains(F.lower("description_clean"), F.lit(b["phrase"].lower()))) / F.nullif(F.count_if(recent), F.lit(0))
        checks.append(at_most("boilerplate residual", share, b["max_pct_of_descriptions_clean"], FAIL if b["max_pct_of_descriptions_clean"] < 1.0 else WARN))
    b = e.get("linkage")
    if b and (gone := {"is_affirmative_measure", "posting_group_id"} - set(df.columns)):
        checks.append(Check("linkage columns missing", FAIL, F.lit(len(gone)), "> 0", ", ".join(sorted(gone))))
    elif b:
        checks.append(at_least("special rows", F.count_if("is_affirmative_measure"), b["min_am_rows"], WARN))
        checks.append(within("linked groups", F.count_distinct("posting_group_id"), b["min_groups"], b["max_groups"]))
    if (b := e.get("posting_kind")) and "posting_kind" in df.columns:
        kinds = list(b["kinds"])
        checks.append(none("posting_kind domain", ~c("posting_kind").isin(kinds), "unexpected value"))
        for kind, (low, high) in b["kinds"].items():
            checks.append(within(f"posting_kind {kind}", F.count_if(c("posting_kind") == kind), low, high))
        checks.append(at_most("posting_kind share", 100.0 * F.count("posting_kind") / F.count(F.lit(1)), b["max_flagged_pct"], WARN))
    for rule in e.get("not_before", []):
        checks.append(none(f"{rule['agency']} too early", (c("agency_canonical") == rule["agency"]) & (c("gazette_date") < F.lit(rule["date"]).cast("date")), f"before {rule['date']}"))
    return checks


def validate(df: DataFrame, expectations: dict) -> DataFrame:
    """All release checks; the result is collected by callers, it has a few rows."""
    return findings(df, release_checks(df, expectations))


class ReleaseError(RuntimeError):
    """A release with findings that must stop it."""


def checked(df: DataFrame, expectations: dict) -> list:
    """The findings of all release checks, printed; a FAIL among them is an error that names all of those."""
    rows = validate(df, expectations).orderBy("severity", "label").collect()  # at most as many as checks
    for r in rows:
        print(f"{r['severity']}: {r['label']}: {r['n']} ({r['detail']})")
    if failed := [r["label"] for r in rows if r["severity"] == FAIL]:
        raise ReleaseError("; ".join(failed))
    return rows


def print_current(df: DataFrame, expectations: dict) -> str:
    """The observed value of each bound, as JSON."""
    return json.dumps({r["label"]: r["v"] for r in observed(df, release_checks(df, expectations)).collect()}, indent=2, sort_keys=True)


def lineage_findings(lineage: DataFrame, names: DataFrame, relations: list[str]) -> DataFrame:
    """Lineage rows with an unknown name, relation or date: ``(severity, label, detail, n)``."""
    side = names.select("name").distinct()
    parts = []
    for column in ("predecessor_canonical", "successor_canonical"):
        unknown = lineage.select(F.trim(column).alias("name")).join(small_side(side), "name", "left_anti")
        parts.append(unknown.groupBy(F.lit(FAIL).alias("severity"), F.lit(f"{column} unknown").alias("label"), F.col("name").alias("detail")).agg(F.count(F.lit(1)).alias("n")))
    odd = lineage.where(~F.coalesce(F.col("relation").isin(relations), F.lit(False)))
    parts.append(odd.groupBy(F.lit(FAIL).alias("severity"), F.lit("relation").alias("label"), F.col("relation").alias("detail")).agg(F.count(F.lit(1)).alias("n")))
    dated = lineage.where(F.try_to_date(F.col("effective_date").cast("string")).isNull())
    parts.append(dated.groupBy(F.lit(WARN).alias("severity"), F.lit("effective_date").alias("label"), F.col("predecessor_canonical").alias("detail")).agg(F.count(F.lit(1)).alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mismatches(rows: DataFrame, canonical: str, found: str, allowed: DataFrame, example: str) -> DataFrame:
    """Pairs of a row's name and another name found in it that are not allowed, with their count and up to
    three distinct ``examples``, the lowest in order. ``allowed(canonical, found)``; null matches null."""
    odd = rows.where(F.col(found).isNotNull() & ~F.col(found).eqNullSafe(F.col(canonical)))
    odd = odd.select(F.col(canonical).alias("canonical"), F.col(found).alias("found"), F.col(example).alias("example"))
    each = odd.groupBy("canonical", "found", "example").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("canonical", "found").orderBy(F.col("example").asc_nulls_last()))
    few = F.array_sort(F.collect_list(F.when(F.col("place") <= 3, F.col("example"))))
    pairs = each.withColumn("place", place).groupBy("canonical", "found").agg(F.sum("n").alias("n"), few.alias("examples"))
    side = allowed.select(F.col("canonical").alias("_c"), F.col("found").alias("_f")).distinct()
    return pairs.join(side, pairs["canonical"].eqNullSafe(side["_c"]) & (pairs["found"] == side["_f"]), "left_anti")


def reconciled(raw: DataFrame, log: DataFrame, keys: list[str], count: str, failed: list[str]) -> DataFrame:
    """Rows by key against a log of counts: differences and failed statuses as findings.

    Keys where null matches null; a log row of zero records without raw rows is as it should be.
    """
    have = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_raw"))
    told = log.groupBy(*keys).agg(F.sum(count).alias("n_log"), F.count_if(F.col("status").isin(failed)).alias("n_failed"))
    both = compared(have, told, keys)
    raw_n, log_n = F.coalesce("n_raw", F.lit(0)), F.coalesce("n_log", F.lit(0))
    label = F.when((F.col("side") == "left_only"), "rows without log").when((F.col("side") == "right_only") & (log_n > 0), "log without rows").when(raw_n != log_n, "counts differ")
    detail = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    bad = both.where(label.isNotNull()).select(F.lit(FAIL).alias("severity"), label.alias("label"), detail.alias("detail"), (raw_n - log_n).cast("bigint").alias("n"))
    late = both.where("n_failed > 0").select(F.lit(WARN).alias("severity"), F.lit("failed files").alias("label"), detail.alias("detail"), F.col("n_failed").cast("bigint").alias("n"))
    return bad.unionByName(late)


def coverage(rows: DataFrame, name: str, by: list[str]) -> DataFrame:
    """Rows without a name by other columns, the most frequent first."""
    return rows.where(F.col(name).isNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), *by)
