"""Queries of parsing, repeated sentences, name resolution, validation and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import boilerplate as B
from tidemark.operators import relational as R
from tidemark.operators import resolve as N
from tidemark.operators import validate as V
from tidemark.operators.linkage import copies_of
from tidemark.operators.notices import FOOTER, LABELS, marker_count, parse_gazette
from tidemark.plans import pipeline
from tidemark.session import cut, ensure_checkpoint_dir
from tidemark.sources.store import Store
from tidemark.sources.tables import table
from tidemark.streaming.ingest import quarter_counts, quarter_totals

RAW, RELEASE = "gazette_vacancies_raw", "aps_gazette_vacancies"
LIMITS = B.Thresholds(share=0.3, least_ads=5, least_titles=2, global_share=0.1, global_ads=20, global_titles=3)
PROTECTED = r"(?i)\b(?:multiple|various)\s+(?:positions|vacancies|roles)\b|expressions?\s+of\s+interest|employment\s+register"
EXPECTED = {
    "min_release_rows": 10**9, "min_agency_rows": {"Coastal Lights and Beacons Authority": 10, "Nobody": 1}, "max_agency_canonical_nulls": 1,
    "gazette_types": ["combined", "vacancy_only"], "boilerplate_residual": {"phrase": "merit list", "since": "2021-01-01", "max_pct_of_descriptions_clean": 0.5},
    "linkage": {"min_am_rows": 10**9, "min_groups": 1, "max_groups": 2},
    "posting_kind": {"kinds": {"register": (1, 2), "entry_program": (0, 10**9)}, "max_flagged_pct": 1.0},
    "not_before": [{"agency": "Noise and Vibration Commission", "date": "2023-07-01"}],
}


# ---------------------------------------------------------------- gazette text
def _gazettes(spark: SparkSession, d: str) -> DataFrame:
    """Raw notices set as gazette text, up to twenty to a file, with page headers between."""
    raw = table(spark, d, RAW).drop("raw_vn_count", "gazette_type").distinct()
    line = lambda c: F.when(F.coalesce(F.trim(c), F.lit("")) != "", F.concat(F.col(c), F.lit("\n\n")))
    columns = {x.replace("\n", " ").replace(" ", "_").lower(): x for x in LABELS if not x.startswith(("Future", "Job Description"))}
    fields = [F.when(F.coalesce(F.trim(c), F.lit("")) != "", F.concat(F.lit(f"{label}\n\n"), F.col(c), F.lit("\n\n"))) for c, label in columns.items()]
    notice = F.concat_ws(
        "", F.lit("\fAustralian Public Service Gazette\nPS12 Weekly Gazette.pdf\n\nPage 3 of 9\n"), F.lit("Vacancy "), F.col("vacancy_no"), F.lit("\n"),
        line("agency"), line("division"), line("branch"), F.lit("Closing Date: "), F.col("closing_date_raw"), F.lit("\n\n"), *fields,
        F.lit("Job Description\n\nhttps://jobs.example/apply\n"), F.col("description"), F.lit(f"\n\nTo Apply\nSee the site.\n\nThis notice is part of the electronic gazette; {FOOTER}\n\n"),
    )
    one = raw.select(F.concat_ws("-", "gazette_id", F.floor(F.col("notice_id") / 20)).alias("file"), F.struct("notice_id", F.xxhash64(notice), notice.alias("notice")).alias("n"))
    return one.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list("n")), lambda n: n["notice"]), "").alias("text"))


_FIELDS = ("vacancy_no", "agency", "division", "branch", "closing_date_raw", "job_title", "job_type", "location", "salary", "classification", "position_number", "office_arrangement", "office_arrangement_details", "agency_website", "description")


def q_parse_gazette(spark: SparkSession, d: str) -> DataFrame:
    """Gazette text parsed to rows again."""
    return parse_gazette(_gazettes(spark, d), "file", "text").select("file", *_FIELDS)


def q_parse_counts(spark: SparkSession, d: str) -> DataFrame:
    """Notices announced in each file, and those parsed."""
    files = _gazettes(spark, d)
    parsed = parse_gazette(files, "file", "text").groupBy("file").agg(F.count(F.lit(1)).alias("n_parsed"))
    return files.select("file", marker_count(F.col("text")).alias("n_marked")).join(parsed, "file", "left")


# ---------------------------------------------------------------- repeated sentences
def _sentences(spark: SparkSession, d: str, split=T.simple_sentences) -> tuple[DataFrame, DataFrame]:  # noqa: ANN001
    notices = table(spark, d, RELEASE, "notice_id", "agency_canonical", "vacancy_no", "job_title", "gazette_date", "description").distinct()
    rows = B.sentence_rows(notices, "notice_id", "agency_canonical", "vacancy_no", "job_title", "gazette_date", "description", split)
    return notices, cut(rows)  # split once, read by every step


def q_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of each notice, headings off, counted by key."""
    _, rows = _sentences(spark, d, T.sentences)
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("row_id").alias("n_notices"))


def q_boilerplate_audit(spark: SparkSession, d: str) -> DataFrame:
    """Sentences over the frequency thresholds, by body and for all."""
    notices, rows = _sentences(spark, d)
    counts = B.frequencies(rows, notices, "agency_canonical", "gazette_date", "description", LIMITS)
    return B.audit(counts, rows, LIMITS, PROTECTED)


def _stripped(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    notices, rows = _sentences(spark, d)
    counts = B.frequencies(rows, notices, "agency_canonical", "gazette_date", "description", LIMITS)
    return notices, B.stripped(rows, B.audit(counts, rows, LIMITS, PROTECTED), PROTECTED)


def q_boilerplate_apply(spark: SparkSession, d: str) -> DataFrame:
    """Descriptions without flagged sentences."""
    return _stripped(spark, d)[1].withColumnRenamed("row_id", "notice_id")


def q_boilerplate_stats(spark: SparkSession, d: str) -> DataFrame:
    """How much of the descriptions stays."""
    notices, clean = _stripped(spark, d)
    both = notices.join(clean, F.col("notice_id") == F.col("row_id"), "left")
    stats = both.agg(*B.strip_stats(F.col("description"), F.col("clean")))
    return stats.select("n_texts", "n_emptied", "kept_share", F.round(F.col("kept_quartiles")[1], 6).alias("kept_median"))


# ---------------------------------------------------------------- names
def _rules(spark: SparkSession, d: str) -> N.Rules:
    register = table(spark, d, "agency_register")
    crosswalk = table(spark, d, "agency_crosswalk")
    manual = register.where("short_name is not null").selectExpr("short_name AS raw", "agency_canonical AS name").distinct()
    prefixes = register.select(F.col("portfolio").alias("prefix")).distinct().selectExpr("prefix", "prefix AS ord", "CAST(NULL AS STRING) AS name")
    lineage = table(spark, d, "agency_lineage").where("relation = 'rename' and effective_date is not null")
    forward = lineage.select(T.squeeze(F.col("predecessor_canonical")).alias("name"), T.squeeze(F.col("successor_canonical")).alias("to"))
    return N.Rules(
        register.selectExpr("agency_canonical AS name", "agency_canonical AS ord").distinct(), manual, prefixes,
        register.selectExpr("portfolio AS raw").distinct(), forward, crosswalk.selectExpr("agency_raw AS raw", "agency_canonical AS name"),
    )


def build_inputs(spark: SparkSession, d: str) -> pipeline.Inputs:
    """Rule tables of a folder as inputs of a build."""
    register = table(spark, d, "agency_register")
    portfolios = register.select(F.col("portfolio").alias("name"))
    groups = register.selectExpr("agency_canonical AS name", "agency_group AS grp").distinct()
    return pipeline.Inputs(_rules(spark, d), portfolios, groups, register.where("not ps_act_employer").selectExpr("agency_canonical AS name").distinct())


def q_release(spark: SparkSession, d: str) -> DataFrame:
    """The whole build, from raw notices to the release."""
    return pipeline.build(table(spark, d, RAW).drop("notice_id").distinct(), build_inputs(spark, d), {"combined": "weekly", "vacancy_only": "weekly"}, LIMITS, PROTECTED)


def q_resolved_texts(spark: SparkSession, d: str) -> DataFrame:
    """Every printed name by the cascade of rules."""
    texts = table(spark, d, RELEASE, "agency").select(F.col("agency").alias("raw"))
    return N.resolve_texts(texts, _rules(spark, d))


def q_resolved_rows(spark: SparkSession, d: str) -> DataFrame:
    """Every notice by its three name fields."""
    rows = table(spark, d, RELEASE, "notice_id", "agency", "division", "branch").distinct()
    portfolios = table(spark, d, "agency_register").select(F.col("portfolio").alias("name"))
    return N.resolve_rows(rows, _rules(spark, d), portfolios, ["notice_id", "agency", "division", "branch"]).select("notice_id", "canonical")


def q_group_label(spark: SparkSession, d: str) -> DataFrame:
    """Notices by group of their body."""
    rows = table(spark, d, RELEASE, "agency_canonical")
    groups = table(spark, d, "agency_register").where("agency_group <> agency_canonical").selectExpr("agency_canonical AS name", "agency_group AS grp").distinct()
    return N.with_group(rows, "agency_canonical", groups).groupBy("agency_group").agg(F.count(F.lit(1)).alias("n"))


def q_lineage_edges(spark: SparkSession, d: str) -> DataFrame:
    """Changes gathered by old name and date, laid out as edges again."""
    lineage = table(spark, d, "agency_lineage").select(T.squeeze(F.col("predecessor_canonical")).alias("old"), T.squeeze(F.col("successor_canonical")).alias("new"), F.col("effective_date").alias("effective")).distinct()
    gathered = lineage.groupBy(F.array("old").alias("olds"), "effective").agg(F.array_sort(F.collect_set("new")).alias("news")).withColumn("relation", F.lit(None).cast("string"))
    return N.lineage_edges(gathered)


def q_copies(spark: SparkSession, d: str) -> DataFrame:
    """Notices that print a vacancy again."""
    rows = table(spark, d, RELEASE, "notice_id", "vacancy_no").distinct()
    return copies_of(rows, "vacancy_no", "notice_id")


# ---------------------------------------------------------------- validation
def q_validate(spark: SparkSession, d: str) -> DataFrame:
    """Findings of all release checks."""
    return V.validate(table(spark, d, RELEASE), EXPECTED).select("severity", "label", "n")


def q_mismatches(spark: SparkSession, d: str) -> DataFrame:
    """Notices whose division is exactly the name of another body than their own, less allowed pairs."""
    rows = table(spark, d, RELEASE, "notice_id", "agency_canonical", "division", "vacancy_no").distinct()
    names = table(spark, d, "agency_register").select(F.col("agency_canonical").alias("found")).distinct()
    exact = rows.join(R.small_side(names), F.col("division") == F.col("found"))
    allowed = table(spark, d, "agency_lineage").selectExpr("trim(predecessor_canonical) AS canonical", "trim(successor_canonical) AS found")
    pairs = V.mismatches(exact, "agency_canonical", "found", allowed, "vacancy_no")
    return pairs.select("canonical", "found", "n", F.try_element_at("examples", F.lit(1)).alias("first_example"))


def q_division_mismatches(spark: SparkSession, d: str) -> DataFrame:
    """Notices whose division starts with another body's name than their own, by the longest such name."""
    rows = table(spark, d, RELEASE, "notice_id", "agency_canonical", "division", "vacancy_no").distinct()
    divisions = rows.where("division is not null").select("division").distinct()
    starts = R.longest_start(divisions, "division", table(spark, d, "agency_register", "agency_canonical"), "agency_canonical", "found", ["division"])
    named = rows.join(starts, "division", "left")
    allowed = table(spark, d, "agency_lineage").selectExpr("trim(predecessor_canonical) AS canonical", "trim(successor_canonical) AS found")
    return V.mismatches(named, "agency_canonical", "found", allowed, "vacancy_no")


def q_reconciled(spark: SparkSession, d: str) -> DataFrame:
    """Raw rows by gazette against the counts the raw table itself tells."""
    raw = table(spark, d, RAW, "gazette_id", "gazette_date", "raw_vn_count")
    log = raw.groupBy("gazette_id", "gazette_date").agg(F.max("raw_vn_count").alias("record_count"), F.lit("parsed").alias("status"))
    return V.reconciled(raw, log, ["gazette_id", "gazette_date"], "record_count", ["error"]).groupBy("label").agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_rows"))


def q_lineage_check(spark: SparkSession, d: str) -> DataFrame:
    """Findings about the lineage table."""
    names = table(spark, d, "agency_register").selectExpr("agency_canonical AS name")
    return V.lineage_findings(table(spark, d, "agency_lineage"), names, ["split", "merge"])


def q_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Notices without a canonical name by printed name and division."""
    return V.coverage(table(spark, d, RELEASE, "agency", "division", "agency_canonical"), "agency_canonical", ["agency", "division"])


# ---------------------------------------------------------------- streams
def q_stream_quarters(spark: SparkSession, d: str) -> DataFrame:
    """Events by quarter, day and type, counted by a stream that runs until its source is read."""
    ensure_checkpoint_dir(spark)
    shared = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{uuid.uuid4().hex}"
    events = table(spark, d, "events", "event_type", "ts")
    events.select("event_type", F.col("ts").cast("timestamp").alias("ts")).write.parquet(f"{shared}/in")
    stream = spark.readStream.schema("event_type string, ts timestamp").parquet(f"{shared}/in")
    counts = quarter_counts(stream, "ts", "event_type")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{shared}/out/batch={number}")

    query = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{shared}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    totals = cut(quarter_totals(spark.read.parquet(f"{shared}/out"), "event_type"))
    Store(spark, shared).delete("")  # the copy, the state and the batches; the totals are checkpointed
    return totals


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

_NOTICES = r"""
n AS (SELECT DISTINCT notice_id, agency_canonical AS body, coalesce(vacancy_no, '') AS ad, job_title, gazette_date, description FROM aps_gazette_vacancies),
t AS (SELECT notice_id, body, ad, CASE WHEN gazette_date IS NULL THEN NULL ELSE year(gazette_date) || 'Q' || quarter(gazette_date) END AS quarter,
  trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(job_title, '')), '\s*-\s*[a-z][a-z ,]+(?:,\s*[a-z ]+)?$', ''), '^\d{4}\s*-\s*', ''), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS title,
  list_filter(list_transform(regexp_split_to_array(regexp_replace(description, '([.!?])\s+([A-Z])', '\1' || chr(30) || '\2', 'g'), '[\x1E\n]'), lambda x: trim(x)), lambda x: x <> '') AS parts FROM n WHERE description IS NOT NULL),
s AS (SELECT *, trim(regexp_replace(regexp_replace(lower(sentence), '[^\p{L}\p{N}_\s]', ' ', 'g'), '[\s\x{00A0}]+', ' ', 'g')) AS key
  FROM (SELECT notice_id, body, ad, quarter, title, unnest(parts) AS sentence, generate_subscripts(parts, 1) - 1 AS pos FROM t)),
m AS (SELECT * FROM s WHERE key <> ''),
sizes AS (SELECT coalesce(body, '__NONE__') AS body, quarter, count(*) AS bin_size FROM t WHERE quarter IS NOT NULL GROUP BY 1, 2
  UNION ALL SELECT '__GLOBAL__', quarter, count(*) FROM t WHERE quarter IS NOT NULL GROUP BY 2),
counts AS (SELECT body, quarter, key, count(DISTINCT ad) AS n_ads, count(DISTINCT title) AS n_titles FROM m WHERE quarter IS NOT NULL AND body IS NOT NULL GROUP BY 1, 2, 3
  UNION ALL SELECT '__GLOBAL__', quarter, key, count(DISTINCT ad), count(DISTINCT title) FROM m WHERE quarter IS NOT NULL GROUP BY 2, 3),
f AS (SELECT c.*, bin_size, n_ads / bin_size AS share FROM counts c JOIN sizes z ON c.body = z.body AND c.quarter = z.quarter
  WHERE bin_size >= CASE WHEN c.body = '__GLOBAL__' THEN 20 ELSE 5 END),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY body, key ORDER BY share DESC, quarter) AS k FROM f) WHERE k = 1 AND share >= CASE WHEN body = '__GLOBAL__' THEN 0.1 ELSE 0.3 END),
w AS (SELECT body, key, arg_min(sentence, (quarter, notice_id, pos)) AS sentence_original FROM m WHERE quarter IS NOT NULL AND body IS NOT NULL GROUP BY 1, 2
  UNION ALL SELECT '__GLOBAL__', key, arg_min(sentence, (quarter, notice_id, pos)) FROM m WHERE quarter IS NOT NULL GROUP BY 2),
audit AS (SELECT b.body, b.quarter, b.key, n_ads, bin_size, round(share * 100, 1) AS pct_of_bin, n_titles, n_titles >= CASE WHEN b.body = '__GLOBAL__' THEN 3 ELSE 2 END AS flagged,
  coalesce(regexp_matches(sentence_original, '(?i)\b(?:multiple|various)\s+(?:positions|vacancies|roles)\b|expressions?\s+of\s+interest|employment\s+register'), false) AS protected, sentence_original
  FROM b LEFT JOIN w ON b.body = w.body AND b.key = w.key),
clean AS (SELECT notice_id, nullif(coalesce(string_agg(sentence, ' ' ORDER BY pos) FILTER (WHERE
    regexp_matches(sentence, '(?i)\b(?:multiple|various)\s+(?:positions|vacancies|roles)\b|expressions?\s+of\s+interest|employment\s+register')
    OR NOT EXISTS (SELECT 1 FROM audit a WHERE a.flagged AND a.key = m.key AND (a.body = '__GLOBAL__' OR a.body = m.body))), ''), '') AS clean FROM m GROUP BY 1)
"""
_KEY = r"""trim(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace({0}, '[‘’]', '''', 'g'), '\s*\([A-Z][A-Z0-9\-]+\)\s*', ' ', 'g')), '['',.()\-/&]', ' ', 'g'), '[\s\x{{00A0}}]+', ' ', 'g'))"""
_CASCADE = f"""k AS (SELECT raw, {_KEY.format('raw')} AS key FROM x),
c AS (SELECT trim(agency_raw, ' ') AS raw, max(agency_canonical) AS name FROM agency_crosswalk WHERE agency_raw IS NOT NULL GROUP BY 1),
m AS (SELECT {_KEY.format('short_name')} AS key, min(agency_canonical) AS name FROM agency_register WHERE short_name IS NOT NULL GROUP BY 1),
g AS (SELECT DISTINCT agency_canonical AS name, {_KEY.format('agency_canonical')} AS key FROM agency_register), h AS (SELECT DISTINCT portfolio AS prefix, {_KEY.format('portfolio')} AS head FROM agency_register WHERE portfolio IS NOT NULL),
fw AS (SELECT trim(regexp_replace(predecessor_canonical, '\\s+', ' ', 'g')) AS name, min(trim(regexp_replace(successor_canonical, '\\s+', ' ', 'g'))) AS to_name FROM agency_lineage WHERE relation = 'rename' AND effective_date IS NOT NULL GROUP BY 1),
dd AS (SELECT k.raw, arg_max(g.name, length(g.key)) AS name FROM k JOIN g ON k.key = g.key OR starts_with(k.key, g.key || ' ') GROUP BY 1),
p AS (SELECT k.raw, min(h.prefix) AS prefix FROM k JOIN h ON k.key = h.head OR starts_with(k.key, h.head || ' ') GROUP BY 1),
pr AS (SELECT p.raw, p.prefix, trim(substr(k.key, length(h.head) + 1)) AS rest FROM p JOIN k ON p.raw = k.raw JOIN h ON h.prefix = p.prefix),
aa AS (SELECT pr.raw, arg_max(g.name, length(g.key)) AS name FROM pr JOIN g ON pr.rest = g.key OR starts_with(pr.rest, g.key || ' ') GROUP BY 1),
z AS (SELECT k.raw, k.key, c.raw IS NOT NULL AS known, c.name AS cname, m.name AS mname, coalesce(f1.to_name, dd.name) AS dname, pr.prefix, pr.rest, coalesce(f2.to_name, aa.name) AS aname,
  k.raw IN (SELECT portfolio FROM agency_register WHERE portfolio IS NOT NULL) AS never FROM k LEFT JOIN c ON c.raw = k.raw LEFT JOIN m ON m.key = k.key LEFT JOIN dd ON dd.raw = k.raw LEFT JOIN fw f1 ON f1.name = dd.name
  LEFT JOIN pr ON pr.raw = k.raw LEFT JOIN aa ON aa.raw = k.raw LEFT JOIN fw f2 ON f2.name = aa.name),
y AS (SELECT *, CASE WHEN raw = '' THEN 'empty' WHEN known THEN 'crosswalk' WHEN mname IS NOT NULL THEN 'manual' WHEN dname IS NOT NULL THEN CASE WHEN {_KEY.format('dname')} = key THEN 'exact' ELSE 'prefix' END
  WHEN never THEN 'division_required' WHEN prefix IS NOT NULL AND rest = '' THEN 'uncertain' WHEN prefix IS NOT NULL THEN CASE WHEN aname IS NOT NULL THEN 'portfolio_strip' ELSE 'uncertain_after_strip:' || prefix END ELSE 'uncertain' END AS method FROM z),
known AS (SELECT raw, CASE WHEN method = 'crosswalk' THEN cname WHEN method = 'manual' THEN mname WHEN method IN ('exact', 'prefix') THEN dname WHEN method = 'portfolio_strip' THEN aname END AS name, method FROM y)"""
_STRINGS = [
    "gazette_id", "gazette_type", "vacancy_no", "agency", "division", "branch", "agency_canonical", "agency_group", "job_title", "posting_group_id", "posting_kind", "job_type", "location", "location_normalised",
    "salary", "classification", "classification_code", "position_number", "closing_date_raw", "office_arrangement", "office_arrangement_details", "agency_website", "description", "description_clean",
    "duties_text", "job_family", "job_family_confidence", "job_family_secondary",
]
_BLED = ["location", "classification", "position_number", "office_arrangement", "office_arrangement_details", "agency_website"]
_CHECKS = [
    ("FAIL", "release rows", "count(*)", "< 1000000000"), ("FAIL", "rows of Coastal Lights and Beacons Authority", "count(*) FILTER (agency_canonical = 'Coastal Lights and Beacons Authority')", "< 10"),
    ("FAIL", "rows of Nobody", "count(*) FILTER (agency_canonical = 'Nobody')", "< 1"), ("WARN", "agency_canonical nulls", "count(*) FILTER (agency_canonical IS NULL)", "> 1"),
    ("FAIL", "gazette_type domain", "count(*) FILTER (gazette_type NOT IN ('combined', 'vacancy_only'))", "> 0"), ("FAIL", "salary inverted", "count(*) FILTER (salary_min > salary_max)", "> 0"),
    ("FAIL", "salary ceiling", "count(*) FILTER (greatest(salary_min, salary_max) > 500000)", "> 0"), ("FAIL", "location gap", "count(*) FILTER (location IS NOT NULL AND location_normalised IS NULL)", "> 0"),
    ("FAIL", "division artifacts", r"count(*) FILTER (regexp_matches(division, '\d{4}\.pdf|Portfolio\)'))", "> 0"),
    *[("FAIL", f"bleed in {c}", rf"count(*) FILTER (regexp_matches({c}, '\S  [A-Z][a-z]'))", "> 0") for c in _BLED], *[("FAIL", f"empty {c}", f"count(*) FILTER ({c} = '')", "> 0") for c in _STRINGS],
    ("FAIL", "boilerplate residual", "100.0 * count(*) FILTER (gazette_date >= DATE '2021-01-01' AND contains(lower(description_clean), 'merit list')) / nullif(count(*) FILTER (gazette_date >= DATE '2021-01-01' AND description_clean IS NOT NULL), 0)", "> 0.5"),
    ("WARN", "special rows", "count(*) FILTER (is_affirmative_measure)", "< 1000000000"), ("WARN", "linked groups", "CASE WHEN count(DISTINCT posting_group_id) BETWEEN 1 AND 2 THEN 0 ELSE 1 END", "> 0"),
    ("FAIL", "posting_kind domain", "count(*) FILTER (posting_kind NOT IN ('register', 'entry_program'))", "> 0"), ("WARN", "posting_kind register", "CASE WHEN count(*) FILTER (posting_kind = 'register') BETWEEN 1 AND 2 THEN 0 ELSE 1 END", "> 0"),
    ("WARN", "posting_kind share", "100.0 * count(posting_kind) / count(*)", "> 1"), ("FAIL", "Noise and Vibration Commission too early", "count(*) FILTER (agency_canonical = 'Noise and Vibration Commission' AND gazette_date < DATE '2023-07-01')", "> 0"),
]
ORACLE = {
    "q_parse_gazette": r"""
WITH r AS (SELECT DISTINCT * EXCLUDE (raw_vn_count, gazette_type) FROM gazette_vacancies_raw),
p AS (SELECT *, concat_ws('-', gazette_id, CAST(notice_id // 20 AS VARCHAR)) AS file, list_filter([trim(agency, ' '), trim(division, ' '), trim(branch, ' ')], lambda x: x IS NOT NULL AND x <> '') AS names FROM r),
q AS (SELECT *, names[1] AS a, CASE WHEN names[1] = names[2] THEN names[3] ELSE names[2] END AS d, CASE WHEN names[1] = names[2] THEN NULL ELSE names[3] END AS b FROM p)
SELECT file, vacancy_no, a AS agency, d AS division, b AS branch, nullif(trim(closing_date_raw, ' '), '') AS closing_date_raw, nullif(trim(job_title, ' '), '') AS job_title,
  CASE WHEN regexp_matches(job_type, '(?i)\b(?:ongoing|non.?ongoing|irregular|intermittent)\b') THEN trim(job_type, ' ') END AS job_type, nullif(trim(location, ' '), '') AS location, nullif(trim(salary, ' '), '') AS salary,
  nullif(trim(classification, ' '), '') AS classification, nullif(trim(position_number, ' '), '') AS position_number, nullif(trim(office_arrangement, ' '), '') AS office_arrangement,
  nullif(trim(office_arrangement_details, ' '), '') AS office_arrangement_details, CASE WHEN regexp_matches(agency_website, '^https?://') THEN trim(agency_website, ' ') END AS agency_website,
  coalesce(nullif(trim(regexp_replace(description, '[\s\x{00A0}]+', ' ', 'g')), ''), 'To Apply See the site.') AS description FROM q""",
    "q_parse_counts": "SELECT concat_ws('-', gazette_id, CAST(notice_id // 20 AS VARCHAR)) AS file, count(*) AS n_marked, count(*) AS n_parsed FROM (SELECT DISTINCT * EXCLUDE (raw_vn_count, gazette_type) FROM gazette_vacancies_raw) GROUP BY 1",
    "q_boilerplate_audit": f"WITH {_NOTICES} SELECT * FROM audit",
    "q_boilerplate_apply": f"WITH {_NOTICES} SELECT notice_id, clean FROM clean",
    "q_boilerplate_stats": f"""WITH {_NOTICES}
SELECT count(n.description) AS n_texts, count(*) FILTER (n.description IS NOT NULL AND clean IS NULL) AS n_emptied, round(sum(coalesce(length(clean), 0)) / sum(length(n.description)), 6) AS kept_share,
  round(quantile_cont(coalesce(length(clean), 0) / length(n.description), 0.5), 6) AS kept_median FROM n LEFT JOIN clean c ON n.notice_id = c.notice_id""",
    "q_resolved_texts": f"WITH x AS (SELECT DISTINCT trim(agency, ' ') AS raw FROM aps_gazette_vacancies WHERE agency IS NOT NULL), {_CASCADE} SELECT raw, name, method FROM known",
    "q_resolved_rows": f"""
WITH q AS (SELECT DISTINCT notice_id, agency, trim(coalesce(agency, ''), ' ') AS a, trim(coalesce(division, ''), ' ') AS d, trim(coalesce(branch, ''), ' ') AS b FROM aps_gazette_vacancies),
t AS (SELECT *, trim(d || ' ' || b, ' ') AS j, CASE WHEN b <> '' AND d <> '' THEN b || ' ' || d END AS bd, CASE WHEN d <> '' THEN a || ' ' || d END AS ad FROM q),
x AS (SELECT DISTINCT raw FROM (SELECT trim(unnest([a, j, d, b, bd, ad]), ' ') AS raw FROM t) WHERE raw <> ''), {_CASCADE},
n AS (SELECT raw, name FROM known WHERE name IS NOT NULL), sure AS (SELECT raw, name FROM known WHERE name IS NOT NULL AND method NOT IN ('portfolio_only', 'uncertain', 'division_required')),
o AS (SELECT t.notice_id, CASE WHEN agency LIKE '%.pdf' THEN 'file' WHEN a IN (SELECT portfolio FROM agency_register) THEN 'portfolio' ELSE 'agency' END AS way, na.name AS own,
  coalesce(nj.name, nd.name) AS file, coalesce(nj.name, nd.name, nb.name, nbd.name, nad.name) AS part, s.name AS branch
  FROM t LEFT JOIN n na ON na.raw = a LEFT JOIN n nj ON nj.raw = j LEFT JOIN n nd ON nd.raw = d LEFT JOIN n nb ON nb.raw = b LEFT JOIN n nbd ON nbd.raw = bd LEFT JOIN n nad ON nad.raw = ad LEFT JOIN sure s ON s.raw = b)
SELECT notice_id, CASE WHEN way = 'file' THEN file WHEN way = 'portfolio' THEN coalesce(part, branch) ELSE own END AS canonical FROM o""",
    "q_group_label": """
WITH g AS (SELECT agency_canonical AS name, min(agency_group) AS grp FROM agency_register WHERE agency_group <> agency_canonical GROUP BY 1)
SELECT coalesce(grp, agency_canonical) AS agency_group, count(*) AS n FROM aps_gazette_vacancies LEFT JOIN g ON name = agency_canonical GROUP BY 1""",
    "q_lineage_edges": r"""
WITH e AS (SELECT DISTINCT trim(regexp_replace(predecessor_canonical, '\s+', ' ', 'g')) AS predecessor, trim(regexp_replace(successor_canonical, '\s+', ' ', 'g')) AS successor, effective_date AS effective FROM agency_lineage)
SELECT predecessor, successor, effective, CASE WHEN count(*) OVER (PARTITION BY predecessor, effective) > 1 THEN 'split' ELSE 'rename' END AS relation FROM e""",
    "q_copies": """
WITH r AS (SELECT DISTINCT notice_id, vacancy_no FROM aps_gazette_vacancies)
SELECT notice_id, vacancy_no, CASE WHEN vacancy_no IS NULL THEN 1 ELSE count(*) OVER w END AS n_copies, vacancy_no IS NULL OR notice_id = min(notice_id) OVER w AS is_first FROM r WINDOW w AS (PARTITION BY vacancy_no)""",
    "q_validate": "WITH o AS (SELECT " + ", ".join(f"{v} AS c{i}" for i, (_, _, v, _) in enumerate(_CHECKS)) + " FROM aps_gazette_vacancies) "
    + " UNION ALL ".join(f"SELECT '{s}' AS severity, '{label}' AS label, CAST(trunc(c{i}) AS BIGINT) AS n FROM o WHERE c{i} {b}" for i, (s, label, _, b) in enumerate(_CHECKS)),
    "q_mismatches": """
WITH r AS (SELECT DISTINCT notice_id, agency_canonical, division, vacancy_no FROM aps_gazette_vacancies)
SELECT agency_canonical AS canonical, division AS found, count(*) AS n, min(vacancy_no) AS first_example FROM r
WHERE division IN (SELECT agency_canonical FROM agency_register) AND division IS DISTINCT FROM agency_canonical
  AND NOT EXISTS (SELECT 1 FROM agency_lineage l WHERE trim(l.predecessor_canonical, ' ') IS NOT DISTINCT FROM agency_canonical AND trim(l.successor_canonical, ' ') = division) GROUP BY 1, 2""",
    "q_division_mismatches": """
WITH r AS (SELECT DISTINCT notice_id, agency_canonical, division, vacancy_no FROM aps_gazette_vacancies),
g AS (SELECT DISTINCT agency_canonical AS name FROM agency_register WHERE agency_canonical IS NOT NULL),
s AS (SELECT division, arg_max(name, length(name)) AS found FROM (SELECT DISTINCT division FROM r) JOIN g ON starts_with(division, name) GROUP BY 1)
SELECT agency_canonical AS canonical, found, count(*) AS n, list_sort(list_distinct(list(vacancy_no)))[1:3] AS examples FROM r JOIN s USING (division)
WHERE found IS DISTINCT FROM agency_canonical
  AND NOT EXISTS (SELECT 1 FROM agency_lineage l WHERE trim(l.predecessor_canonical, ' ') IS NOT DISTINCT FROM agency_canonical AND trim(l.successor_canonical, ' ') = found) GROUP BY 1, 2""",
    "q_reconciled": """
WITH k AS (SELECT gazette_id, gazette_date, count(*) AS n_raw, max(raw_vn_count) AS n_log FROM gazette_vacancies_raw GROUP BY 1, 2)
SELECT 'counts differ' AS label, count(*) AS n_keys, CAST(sum(n_raw - coalesce(n_log, 0)) AS BIGINT) AS n_rows FROM k WHERE n_raw <> coalesce(n_log, 0) HAVING count(*) > 0""",
    "q_lineage_check": """
SELECT 'FAIL' AS severity, 'predecessor_canonical unknown' AS label, trim(predecessor_canonical, ' ') AS detail, count(*) AS n FROM agency_lineage WHERE trim(predecessor_canonical, ' ') NOT IN (SELECT agency_canonical FROM agency_register) GROUP BY 3 UNION ALL
SELECT 'FAIL', 'successor_canonical unknown', trim(successor_canonical, ' '), count(*) FROM agency_lineage WHERE trim(successor_canonical, ' ') NOT IN (SELECT agency_canonical FROM agency_register) GROUP BY 3 UNION ALL
SELECT 'FAIL', 'relation', relation, count(*) FROM agency_lineage WHERE coalesce(relation NOT IN ('split', 'merge'), true) GROUP BY 3 UNION ALL
SELECT 'WARN', 'effective_date', predecessor_canonical, count(*) FROM agency_lineage WHERE effective_date IS NULL GROUP BY 3""",
    "q_coverage": "SELECT agency, division, count(*) AS n FROM aps_gazette_vacancies WHERE agency_canonical IS NULL GROUP BY 1, 2",
    "q_stream_quarters": "SELECT CAST(date_trunc('quarter', ts) AS DATE) AS quarter, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
