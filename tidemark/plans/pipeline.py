"""The whole way from raw notices to a release, one lazy plan for each layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import boilerplate as B
from tidemark.operators.classify import attached
from tidemark.operators.linkage import kind_of, linked
from tidemark.operators.relational import preferred_source, small_side
from tidemark.operators.resolve import Rules, overridden_rows, renamed_by_date, resolve_rows, with_group
from tidemark.operators.shaping import emptied, guarded_date, guarded_range, not_equal, ordered, placed_after, remapped, renamed, unless
from tidemark.operators.validate import checked
from tidemark.session import cut

#: Order of the release's columns.
RELEASE = (
    "gazette_id", "gazette_date", "gazette_type", "vacancy_no", "agency", "division", "branch", "agency_canonical", "agency_group", "ps_act_employer", "job_title", "is_affirmative_measure",
    "posting_group_id", "posting_kind", "job_type", "location", "location_normalised", "salary", "salary_min", "salary_max", "classification", "classification_code", "position_number",
    "closing_date_raw", "closing_date", "office_arrangement", "office_arrangement_details", "agency_website", "description", "description_clean", "duties_text",
    "job_family", "job_family_confidence", "job_family_secondary",
)
PLACEHOLDERS = ("", "N/A", "n/a", "-", "Not applicable")


@dataclass(frozen=True)
class Inputs:
    """What a build needs beside raw rows: name rules, portfolios ``(name)``, groups ``(name, grp)``, employers
    under their own act ``(name)``, and stored classifications or None. Optional tables of names:
    ``allowed(host, part)``, ``fallback(agency, name)``, ``fixed(key, name)`` for single vacancies,
    ``renames(column, value, name, before, to)`` by date and ``canonical(name, to)`` for names no longer used."""

    rules: Rules
    portfolios: DataFrame
    groups: DataFrame
    own_act: DataFrame
    results: DataFrame | None = None
    allowed: DataFrame | None = None
    fallback: DataFrame | None = None
    fixed: DataFrame | None = None
    renames: DataFrame | None = None
    canonical: DataFrame | None = None


def normalised(raw: DataFrame) -> DataFrame:
    """Raw rows with places, pay, dates, grades and duties read, each under its guards."""
    df = raw.withColumns({
        "location_normalised": T.sorted_parts(F.col("location")), "salary_min": T.first_amount(F.col("salary")), "salary_max": T.second_amount(F.col("salary")),
        "classification_clean": T.short_grade(F.col("classification")), "closing_date": T.first_date(F.col("closing_date_raw")), "duties_text": T.duties_section(F.col("description")),
    })
    return guarded_date(guarded_range(df, "salary_min", "salary_max", "salary"), "closing_date", "gazette_date")


def named(rows: DataFrame, inputs: Inputs) -> DataFrame:
    """Rows with canonical name, group and whether the body employs under the general act; null names stay
    null in all three. Placeholder texts and titles that are amounts become null."""
    keys = ["agency", "division", "branch"]
    texts = rows.select(*keys).distinct()
    known = resolve_rows(texts, inputs.rules, inputs.portfolios, keys, inputs.allowed, inputs.fallback).withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [rows[k].eqNullSafe(known[f"_{k}"]) for k in keys]
    df = rows.join(known, same[0] & same[1] & same[2], "left").drop(*[f"_{k}" for k in keys]).withColumnRenamed("canonical", "agency_canonical")
    if inputs.canonical is not None:
        moved = small_side(inputs.canonical.groupBy(F.col("name").alias("agency_canonical")).agg(F.min("to").alias("_to")))
        df = df.join(moved, "agency_canonical", "left").withColumn("agency_canonical", F.coalesce("_to", "agency_canonical")).drop("_to")
    if inputs.renames is not None:
        df = renamed_by_date(df, inputs.renames, "gazette_date")
    if inputs.fixed is not None:
        df = overridden_rows(df, inputs.fixed, "vacancy_no")
    df = with_group(df, "agency_canonical", inputs.groups)  # anew for every row, whatever changed its name
    own = small_side(inputs.own_act.select(F.col("name").alias("_own"), F.lit(True).alias("_is_own")).distinct())
    df = df.join(own, F.col("agency_canonical") == F.col("_own"), "left")
    df = df.withColumn("ps_act_employer", F.when(F.col("agency_canonical").isNotNull(), F.col("_is_own").isNull())).drop("_own", "_is_own")
    df = unless(df, "job_title", F.col("job_title").rlike(r"^\$\d"))
    df = unless(df, "description", F.trim("description") == "To Apply")
    return emptied(df, ["office_arrangement", "office_arrangement_details", "position_number", "branch", "division", "location"], PLACEHOLDERS)


def released(rows: DataFrame, types: dict[str, str], test_agency: str = "Test Agency") -> DataFrame:
    """One row a vacancy, weekly issues before daily ones, with linked groups and kinds of posting."""
    df = renamed(rows.drop("raw_vn_count"), {"classification_clean": "classification_code"})
    df = df.withColumn("gazette_type", remapped(F.col("gazette_type"), types)).where(not_equal(F.col("agency"), test_agency))
    daily = F.col("gazette_type").eqNullSafe(F.lit("daily"))
    order = (F.col("gazette_date").asc_nulls_last(), F.col("gazette_type"), F.xxhash64("agency", "job_title", "description"))
    df = preferred_source(df.where(~daily), df.where(daily), "vacancy_no", *order).withColumn("gazette_date", F.to_date("gazette_date"))
    df = linked(df, "job_title", ["agency_canonical", "classification_code", "closing_date"]).withColumnsRenamed({"is_special": "is_affirmative_measure", "group_id": "posting_group_id"})
    df = df.withColumn("posting_kind", kind_of(F.col("job_title"), F.col("classification_code")))
    return placed_after(df, "posting_group_id", "posting_kind")


def cleaned(rows: DataFrame, limits: B.Thresholds, protected: str | None = None) -> DataFrame:
    """``description_clean`` without repeated sentences, then contacts redacted in all three texts.

    Rows are keyed by a hash of their content, so the key is the same whenever a layer is computed again;
    equal rows share it and their text.
    """
    keyed = cut(rows.withColumn("_row", F.xxhash64(*[F.col(c) for c in rows.columns])))
    one = keyed.dropDuplicates(["_row"])
    parts = cut(B.sentence_rows(one, "_row", "agency_canonical", "vacancy_no", "job_title", "gazette_date", "description"))
    counts = B.frequencies(parts, one, "agency_canonical", "gazette_date", "description", limits)
    clean = B.stripped(parts, B.audit(counts, parts, limits, protected), protected).withColumnsRenamed({"row_id": "_id", "clean": "description_clean"})
    df = keyed.drop("description_clean").join(clean, F.col("_row") == F.col("_id"), "left").drop("_row", "_id")
    return df.withColumns({c: T.redact_contacts(F.col(c)) for c in ("description", "description_clean", "duties_text")})


def build(
    raw: DataFrame, inputs: Inputs, types: dict[str, str], limits: B.Thresholds = B.Thresholds(), protected: str | None = None, expectations: dict | None = None
) -> DataFrame:
    """Raw notices to the release, with stored classifications where there are any.

    ``expectations``: bounds that the layer of released rows and the cleaned one must meet; both are then
    stored before they are checked, and a FAIL stops the build (``ReleaseError``)."""
    df = released(named(normalised(raw), inputs), types)
    if expectations is not None:
        df = cut(df)
        checked(df, expectations)
    df = cleaned(df, limits, protected)
    if expectations is not None:
        df = cut(df)
        checked(df, expectations)
    if inputs.results is not None:
        df = attached(df, inputs.results, ["job_family", "job_family_confidence", "job_family_secondary"])
    else:
        df = df.withColumns({c: F.lit(None).cast("string") for c in ("job_family", "job_family_confidence", "job_family_secondary")})
    return ordered(df, RELEASE)
