"""Queries of this subpackage by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, packing, reading
from tidemark.llm.names import UNMATCHED, map_names
from tidemark.llm.personal import find_personal, redact
from tidemark.llm.repeats import cut_lines, repeated_lines, with_repeated
from tidemark.llm.subjects import assign_subjects, fitted
from tidemark.llm.tokens import with_token_counts
from tidemark.session import cut
from tidemark.sources.tables import table


def _resolved(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Notices without a canonical name, and the distinct pairs of their fields with what they mean."""
    notices = table(spark, sf_dir, "aps_gazette_vacancies", "notice_id", "agency", "division", "agency_canonical")
    register = table(spark, sf_dir, "agency_register").selectExpr("agency_canonical AS name", "short_name AS short", "portfolio AS `group`")
    known = table(spark, sf_dir, "agency_crosswalk").selectExpr("agency_raw AS printed", "agency_canonical AS name")
    counts = notices.where("agency_canonical is not null").groupBy(F.col("agency_canonical").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    open_ = notices.where("agency_canonical is null").selectExpr("notice_id", "agency AS first", "division AS second")
    return open_, map_names(open_, register, known, counts)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The register entry that agency and division mean, for every notice without one."""
    open_, pairs = _resolved(spark, sf_dir)
    same = open_["first"].eqNullSafe(pairs["first"]) & open_["second"].eqNullSafe(pairs["second"])
    return open_.join(pairs, same).select("notice_id", F.col("target").alias("agency_canonical")).distinct()


def p1_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entered values that mean no register entry, with how many rows hold them."""
    open_, pairs = _resolved(spark, sf_dir)
    same = open_["first"].eqNullSafe(pairs["first"]) & open_["second"].eqNullSafe(pairs["second"])
    missed = open_.join(pairs.where(F.col("target") == UNMATCHED), same)
    return missed.groupBy(F.upper(F.trim(open_["first"])).alias("agency")).agg(F.countDistinct("notice_id").alias("n_notices"))


def _notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "aps_gazette_vacancies", "notice_id", "agency_canonical", "description")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each repeated line of each notice."""
    lines, repeated = repeated_lines(_notices(spark, sf_dir), "notice_id", "agency_canonical", "description")
    marked = with_repeated(lines, repeated, "source").where("repeated is not null")
    kept = marked.select("doc", F.filter("keys", lambda k: F.array_contains("repeated", F.xxhash64(k))).alias("keys"))
    return kept.select(F.col("doc").alias("notice_id"), F.explode("keys").alias("line_key")).distinct()


def p6_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each notice with its description free of its agency's repeated lines."""
    notices = _notices(spark, sf_dir)
    _, repeated = repeated_lines(notices, "notice_id", "agency_canonical", "description")
    marked = with_repeated(notices, repeated, "agency_canonical")
    return marked.select("notice_id", cut_lines(F.col("description"), F.col("repeated")).alias("description_clean")).distinct()


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct piece of personal information in the texts of a notice."""
    notices = table(spark, sf_dir, "aps_gazette_vacancies", "notice_id", "description", "duties_text")
    found = find_personal(notices, "notice_id", ["description", "duties_text"])
    return found.withColumnRenamed("doc", "notice_id").distinct()


def p4_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each notice with typed placeholders in both of its texts."""
    notices = table(spark, sf_dir, "aps_gazette_vacancies", "notice_id", "description", "duties_text").distinct()
    return notices.select("notice_id", redact(F.col("description")).alias("description_clean"), redact(F.col("duties_text")).alias("duties_clean"))


def _families(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Notices with the stretch of their text that holds duties, and the families of those without one."""
    notices = table(spark, sf_dir, "aps_gazette_vacancies", "notice_id", "job_title", "description", "job_family", "job_family_secondary", "job_family_confidence")
    duties = F.split(F.col("description"), r"(?im)^\s*Eligibility\s*$", 2)[0]
    notices = notices.withColumn("duties", duties).drop("description")
    labelled = notices.where("job_family is not null and coalesce(job_family_confidence, 'low') <> 'low'")
    model = fitted(labelled, "duties", "job_family", "job_family_secondary", "notice_id", every=notices)
    return notices, assign_subjects(notices.where("job_family is null and duties is not null"), "notice_id", "duties", model, title="job_title")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each family to which at least two described duties of a notice without a family belong."""
    _, found = _families(spark, sf_dir)
    return found.select(F.col("doc").alias("notice_id"), F.col("subject").alias("job_family")).distinct()


def p5_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many notices describe work of each family, given or found."""
    notices, found = _families(spark, sf_dir)
    given = notices.where("job_family is not null").select("notice_id", "job_family", F.lit("given").alias("origin"))
    added = found.select(F.col("doc").alias("notice_id"), F.col("subject").alias("job_family"), F.lit("found").alias("origin"))
    both = given.unionByName(added).distinct()
    return both.groupBy("job_family", "origin").agg(F.count(F.lit(1)).alias("n_notices"))


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their sizes, without the texts; written once, as several steps read it."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return cut(with_token_counts(docs, "text").select(F.col("doc_id").alias("doc"), "source", "n_tokens"))


def _containers(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """Capacity by kind of container, a small table of settings; of a kind given twice the larger counts."""
    kinds = table(spark, sf_dir, "container_sizes").where("capacity_tokens > 0 and container_kind is not null")
    return {r["container_kind"]: r["size"] for r in kinds.groupBy("container_kind").agg(F.max("capacity_tokens").alias("size")).collect()}


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each text, or piece of an oversized text, lies, for every kind of container."""
    return packing.pack_kinds(_sized(spark, sf_dir), _containers(spark, sf_dir))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each kind are, and how far from the mixture."""
    kinds = _containers(spark, sf_dir)
    return packing.fill_reports(packing.pack_kinds(_sized(spark, sf_dir), kinds), kinds)


def p9_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stretches of documents drawn into each slot of each output shard."""
    return mixing.mix(_sized(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares reached by source, beside the targets."""
    return mixing.mix(_sized(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[1]


def _graded(spark: SparkSession, sf_dir: str, strict: bool = False) -> tuple[DataFrame, reading.Model]:
    model = reading.fitted(table(spark, sf_dir, "reading_samples"), "text", "reading_level", strict=strict)
    return reading.grade(table(spark, sf_dir, "documents", "doc_id", "source", "text"), "text", model), model


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The level of every document of running English."""
    return _graded(spark, sf_dir)[0].where("reading_level is not null").select("doc_id", "reading_level").distinct()


def p10_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source and level, beside the share of passages graded right that were not fitted on."""
    graded, model = _graded(spark, sf_dir, strict=True)
    return reading.profile(graded, "source").withColumn("agreement", F.lit(round(model.agreement, 4)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_misses, p4_found, p4_redacted, p5_found, p5_shares, p6_found, p6_cut, p8_packed, p8_fill, p9_mixed, p9_shares, p10_found, p10_profile)}

_LINES = """
WITH lines AS (
  SELECT DISTINCT notice_id, agency_canonical,
         trim(regexp_replace(lower(unnest(string_split(description, chr(10)))), '[^a-z]+', ' ', 'g')) AS line_key
  FROM aps_gazette_vacancies WHERE agency_canonical IS NOT NULL),
totals AS (SELECT agency_canonical, count(DISTINCT notice_id) AS n FROM aps_gazette_vacancies GROUP BY 1),
repeated AS (
  SELECT l.agency_canonical, line_key FROM lines l JOIN totals t ON l.agency_canonical = t.agency_canonical
  WHERE length(line_key) - length(replace(line_key, ' ', '')) >= 4
  GROUP BY l.agency_canonical, line_key, t.n HAVING count(DISTINCT notice_id) >= 5 AND count(DISTINCT notice_id) * 10 >= t.n)
"""
ORACLE: dict[str, str] = {
    "p6_found": _LINES + """SELECT DISTINCT notice_id, l.line_key FROM lines l
JOIN repeated r ON l.agency_canonical = r.agency_canonical AND l.line_key = r.line_key""",
}

