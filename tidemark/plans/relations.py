"""Queries of joins, aggregations, windows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.text import name_key, squeeze
from tidemark.operators import relational as R
from tidemark.operators.classify import attached, batches, overridden, pending, reclassified, tripwire
from tidemark.operators.shaping import not_equal
from tidemark.sources.release import to_push
from tidemark.sources.tables import table

RAW, RELEASE = "gazette_vacancies_raw", "aps_gazette_vacancies"


def _results(spark: SparkSession, d: str) -> DataFrame:
    """Stored classifications: one for each key, the highest notice number."""
    rows = table(spark, d, RELEASE, "gazette_id", "vacancy_no", "notice_id", "job_family", "job_family_confidence").where("job_family is not null")
    best = F.max_by(F.struct("job_family", "job_family_confidence"), F.struct("notice_id", "job_family", "job_family_confidence"))
    return rows.groupBy("gazette_id", "vacancy_no").agg(best.alias("r")).select("gazette_id", "vacancy_no", "r.job_family", "r.job_family_confidence")


def q_first_per_key(spark: SparkSession, d: str) -> DataFrame:
    """The first weekly notice of each vacancy."""
    rows = table(spark, d, RAW, "notice_id", "vacancy_no", "gazette_date", "gazette_type").where(F.col("gazette_type") != "daily").distinct()
    return R.first_per_key(rows, ["vacancy_no"], F.col("gazette_date").asc_nulls_last(), F.col("notice_id")).select("vacancy_no", "notice_id")


def q_weekly_over_daily(spark: SparkSession, d: str) -> DataFrame:
    """Weekly notices once a vacancy, daily ones only where no weekly has the vacancy."""
    rows = table(spark, d, RAW, "notice_id", "vacancy_no", "gazette_date", "gazette_type").distinct()
    weekly, daily = rows.where(not_equal(F.col("gazette_type"), "daily")), rows.where(F.col("gazette_type") == "daily")
    return R.preferred_source(weekly, daily, "vacancy_no", F.col("gazette_date").asc_nulls_last(), F.col("notice_id")).select("vacancy_no", "notice_id", "gazette_type")


def q_last_status(spark: SparkSession, d: str) -> DataFrame:
    """The last event type of each user."""
    return R.latest(table(spark, d, "events", "user_id", "event_type", "ts", "event_id"), ["user_id"], "event_type", "ts", "event_id")


def q_null_profile(spark: SparkSession, d: str) -> DataFrame:
    """Nulls of every release column."""
    return R.null_profile(table(spark, d, RELEASE))


def q_top_share(spark: SparkSession, d: str) -> DataFrame:
    """The thirty most frequent printed names with their share."""
    return R.top_with_share(table(spark, d, RELEASE, "agency"), "agency", 30)


def q_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Quartiles of text length by source, interpolated."""
    docs = table(spark, d, "documents", "source", "text").where("text is not null")
    return docs.groupBy("source").agg(*[F.round(F.percentile(F.length("text"), F.lit(q / 100)), 4).alias(f"p{q}") for q in (25, 50, 75)])


def q_key_violations(spark: SparkSession, d: str) -> DataFrame:
    """Notice numbers printed more than once."""
    return R.key_violations(table(spark, d, RELEASE, "notice_id"), ["notice_id"])


def q_tripwire(spark: SparkSession, d: str) -> DataFrame:
    """Keys of notices that span years, or have two results."""
    rows = table(spark, d, RELEASE, "gazette_id", "vacancy_no", "gazette_date")
    results = _results(spark, d)
    return tripwire(results.unionByName(results.where("vacancy_no <= 'VN-00000050'")), rows, "gazette_date")


def q_distinct_names(spark: SparkSession, d: str) -> DataFrame:
    """All texts that may name a body, from two pools."""
    rows = table(spark, d, RELEASE, "agency", "division", "branch")
    joined = rows.where("agency is null").select(squeeze(F.concat_ws(" ", "division", "branch")).alias("text"))
    return rows.select(squeeze(F.col("agency")).alias("text")).distinct().union(joined.distinct()).where("text is not null and text <> ''").distinct()


def q_examples(spark: SparkSession, d: str) -> DataFrame:
    """The three lowest vacancy numbers for each name and grade."""
    rows = table(spark, d, RELEASE, "agency_canonical", "classification_code", "vacancy_no").distinct()
    place = F.row_number().over(Window.partitionBy("agency_canonical", "classification_code").orderBy("vacancy_no"))
    few = rows.withColumn("place", place).where("place <= 3")
    return few.groupBy("agency_canonical", "classification_code").agg(F.array_join(F.array_sort(F.collect_list("vacancy_no")), ",").alias("examples"))


def q_compared(spark: SparkSession, d: str) -> DataFrame:
    """Notices by gazette in the raw and the release table, nulls matching nulls."""
    raw = table(spark, d, RAW, "gazette_id", "gazette_date").groupBy("gazette_id", F.to_date("gazette_date").alias("day")).agg(F.count(F.lit(1)).alias("n_raw"))
    release = table(spark, d, RELEASE, "gazette_id", "gazette_date").groupBy("gazette_id", F.col("gazette_date").alias("day")).agg(F.count(F.lit(1)).alias("n_release"))
    return R.compared(raw, release, ["gazette_id", "day"])


def q_prefix_names(spark: SparkSession, d: str) -> DataFrame:
    """Register names that printed names begin with, at a word's end."""
    rows = table(spark, d, RELEASE, "agency").where("agency is not null").distinct()
    names = table(spark, d, "agency_register", "agency_canonical").distinct().withColumns({"key": name_key(F.col("agency_canonical")), "ord": F.col("agency_canonical")})
    return R.longest_prefix(rows, name_key(F.col("agency")), names, "key", "agency_canonical", "ord", ["agency"], "canonical")


def q_starts_with(spark: SparkSession, d: str) -> DataFrame:
    """The longest register name that a division begins with, whatever follows."""
    rows = table(spark, d, RELEASE, "division").where("division is not null").distinct()
    return R.longest_start(rows, "division", table(spark, d, "agency_register", "agency_canonical"), "agency_canonical", "found", ["division"])


def q_first_listed(spark: SparkSession, d: str) -> DataFrame:
    """The first of division with branch, division, branch and agency that the crosswalk knows."""
    rows = table(spark, d, RELEASE, "notice_id", "agency", "division", "branch").distinct()
    c = lambda x: F.trim(F.coalesce(F.col(x), F.lit("")))
    tries = [F.trim(F.concat_ws(" ", c("division"), c("branch"))), c("division"), c("branch"), c("agency")]
    known = table(spark, d, "agency_crosswalk", "agency_raw", "agency_canonical").distinct()
    return R.first_listed(rows, tries, known, "agency_raw", "agency_canonical", ["notice_id", "agency", "division", "branch"]).select("notice_id", "resolved")


def q_attached(spark: SparkSession, d: str) -> DataFrame:
    """Notices with their stored classification."""
    rows = table(spark, d, RELEASE, "notice_id", "gazette_id", "vacancy_no").distinct()
    return attached(rows, _results(spark, d), ["job_family", "job_family_confidence"])


def q_pending(spark: SparkSession, d: str) -> DataFrame:
    """Notices without a stored classification."""
    return pending(table(spark, d, RELEASE, "notice_id", "gazette_id", "vacancy_no").distinct(), _results(spark, d))


def q_overridden(spark: SparkSession, d: str) -> DataFrame:
    """Stored classifications with those of low confidence put right by hand."""
    results = _results(spark, d)
    fixed = results.where("job_family_confidence = 'low'").withColumns({"job_family": F.lit("POLICY"), "job_family_confidence": F.lit("high")})
    return overridden(results, fixed)


def q_reclassified(spark: SparkSession, d: str) -> DataFrame:
    """Stored classifications left after those of one body and year are cleared."""
    rows = table(spark, d, RELEASE, "gazette_id", "vacancy_no", "agency_canonical", "gazette_date")
    return reclassified(_results(spark, d), rows, "coastal", 2024)


def q_batches(spark: SparkSession, d: str) -> DataFrame:
    """Notices in batches of a thousand, by number."""
    rows = table(spark, d, RELEASE, "notice_id", "gazette_id", "vacancy_no").distinct()
    return batches(rows, 1000, "notice_id", "gazette_id", "vacancy_no").select("notice_id", F.col("chunk").cast("bigint").alias("chunk"), "custom_id")


def q_user_join(spark: SparkSession, d: str) -> DataFrame:
    """Orders and customers by nation and year."""
    orders = table(spark, d, "orders", "o_custkey", "o_orderdate").where("o_orderdate >= TIMESTAMP'1996-01-01'")
    per = orders.groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    who = table(spark, d, "customer", "c_custkey", "c_nationkey").join(R.small_side(table(spark, d, "nation", "n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return who.join(per, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("n_name", "year").agg(F.count(F.lit(1)).alias("n_customers"), F.sum("n").alias("n_orders"))


def q_role_count(spark: SparkSession, d: str) -> DataFrame:
    """Roles by body: linked postings count once."""
    rows = table(spark, d, RELEASE, "agency_canonical", "posting_group_id", "vacancy_no")
    return rows.groupBy("agency_canonical").agg(F.countDistinct(F.coalesce("posting_group_id", "vacancy_no")).alias("n_roles"))


def q_quarters(spark: SparkSession, d: str) -> DataFrame:
    """Notices by quarter and body."""
    rows = table(spark, d, RELEASE, "gazette_date", "agency_canonical").where("gazette_date is not null")
    quarter = F.concat(F.year("gazette_date").cast("string"), F.lit("Q"), F.quarter("gazette_date").cast("string"))
    return rows.groupBy(quarter.alias("quarter"), "agency_canonical").agg(F.count(F.lit(1)).alias("n"))


def q_to_push(spark: SparkSession, d: str) -> DataFrame:
    """Documents that a mirror lacks or has in another state."""
    docs = table(spark, d, "documents", "doc_id", "text")
    local = docs.select(F.col("doc_id").cast("string").alias("key"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    remote = docs.where("length(text) < 900").select(F.col("doc_id").cast("string").alias("key"), F.sha2("text", 256).alias("sha256"))
    return to_push(local, remote)


def q_set_difference(spark: SparkSession, d: str) -> DataFrame:
    """Sources of documents and of targets that the other has not."""
    have, want = table(spark, d, "documents", "source").where("source is not null").distinct(), table(spark, d, "mix_targets", "source").distinct()
    return have.exceptAll(want).withColumn("side", F.lit("no target")).unionByName(want.exceptAll(have).withColumn("side", F.lit("no documents")))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

_RESULTS = """
results AS (SELECT gazette_id, vacancy_no, job_family, job_family_confidence FROM (
  SELECT *, row_number() OVER (PARTITION BY gazette_id, vacancy_no ORDER BY notice_id DESC, job_family DESC, job_family_confidence DESC NULLS LAST) AS k
  FROM aps_gazette_vacancies WHERE job_family IS NOT NULL) WHERE k = 1)"""
_NAME = r"""trim(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace({0}, '[‘’]', '''', 'g'), '\s*\([A-Z][A-Z0-9\-]+\)\s*', ' ', 'g')), '['',.()\-/&]', ' ', 'g'), '[\s\x{{00A0}}]+', ' ', 'g'))"""
ORACLE = {
    "q_first_per_key": """
SELECT vacancy_no, notice_id FROM (SELECT *, row_number() OVER (PARTITION BY vacancy_no ORDER BY gazette_date ASC NULLS LAST, notice_id) AS k
  FROM (SELECT DISTINCT notice_id, vacancy_no, gazette_date, gazette_type FROM gazette_vacancies_raw WHERE gazette_type <> 'daily')) WHERE k = 1""",
    "q_weekly_over_daily": """
WITH r AS (SELECT DISTINCT notice_id, vacancy_no, gazette_date, gazette_type FROM gazette_vacancies_raw),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vacancy_no ORDER BY gazette_date ASC NULLS LAST, notice_id) AS k FROM r WHERE gazette_type IS DISTINCT FROM 'daily') WHERE k = 1)
SELECT vacancy_no, notice_id, gazette_type FROM w UNION ALL
SELECT vacancy_no, notice_id, gazette_type FROM r WHERE gazette_type = 'daily' AND NOT EXISTS (SELECT 1 FROM r x WHERE x.gazette_type IS DISTINCT FROM 'daily' AND x.vacancy_no = r.vacancy_no)""",
    "q_last_status": "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1",
    "q_null_profile": "SELECT name AS column_name, n AS n_null FROM (SELECT count(*) - count(COLUMNS(*)) FROM aps_gazette_vacancies) UNPIVOT INCLUDE NULLS (n FOR name IN (COLUMNS(*)))",
    "q_top_share": """
WITH c AS (SELECT agency, count(*) AS n FROM aps_gazette_vacancies GROUP BY 1), t AS (SELECT count(*) AS total FROM aps_gazette_vacancies)
SELECT agency, n, row_number() OVER (ORDER BY n DESC, agency ASC NULLS LAST) AS rank, round(n * 100.0 / (SELECT total FROM t), 4) AS pct
FROM c ORDER BY n DESC, agency ASC NULLS LAST LIMIT 30""",
    "q_quantiles": "SELECT source, " + ", ".join(f"round(quantile_cont(CAST(length(text) AS DOUBLE), {q / 100}), 4) AS p{q}" for q in (25, 50, 75)) + " FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "q_key_violations": "SELECT notice_id, count(*) AS n FROM aps_gazette_vacancies GROUP BY 1 HAVING count(*) > 1",
    "q_tripwire": f"""
WITH {_RESULTS}
SELECT gazette_id, vacancy_no, 'twice in results' AS reason FROM results WHERE vacancy_no <= 'VN-00000050' UNION ALL
SELECT gazette_id, vacancy_no, 'several years' FROM aps_gazette_vacancies GROUP BY 1, 2 HAVING count(DISTINCT year(gazette_date)) > 1""",
    "q_distinct_names": """
SELECT DISTINCT trim(regexp_replace(text, '[\\s\\x{00A0}]+', ' ', 'g')) AS text FROM (SELECT agency AS text FROM aps_gazette_vacancies UNION ALL
  SELECT concat_ws(' ', division, branch) FROM aps_gazette_vacancies WHERE agency IS NULL) WHERE trim(regexp_replace(text, '[\\s\\x{00A0}]+', ' ', 'g')) <> ''""",
    "q_examples": """
WITH r AS (SELECT DISTINCT agency_canonical, classification_code, vacancy_no FROM aps_gazette_vacancies),
k AS (SELECT *, row_number() OVER (PARTITION BY agency_canonical, classification_code ORDER BY vacancy_no) AS place FROM r)
SELECT agency_canonical, classification_code, string_agg(vacancy_no, ',' ORDER BY vacancy_no) AS examples FROM k WHERE place <= 3 GROUP BY 1, 2""",
    "q_compared": """
WITH a AS (SELECT gazette_id, CAST(gazette_date AS DATE) AS day, count(*) AS n_raw FROM gazette_vacancies_raw GROUP BY 1, 2),
b AS (SELECT gazette_id, gazette_date AS day, count(*) AS n_release FROM aps_gazette_vacancies GROUP BY 1, 2)
SELECT coalesce(a.gazette_id, b.gazette_id) AS gazette_id, coalesce(a.day, b.day) AS day, n_raw, n_release,
  CASE WHEN n_release IS NULL THEN 'left_only' WHEN n_raw IS NULL THEN 'right_only' ELSE 'both' END AS side
FROM a FULL OUTER JOIN b ON a.gazette_id IS NOT DISTINCT FROM b.gazette_id AND a.day IS NOT DISTINCT FROM b.day""",
    "q_prefix_names": f"""
WITH r AS (SELECT DISTINCT agency FROM aps_gazette_vacancies WHERE agency IS NOT NULL), n AS (SELECT DISTINCT agency_canonical, {_NAME.format('agency_canonical')} AS key FROM agency_register),
k AS (SELECT agency, {_NAME.format('agency')} AS key FROM r)
SELECT k.agency, arg_max(n.agency_canonical, length(n.key)) AS canonical FROM k LEFT JOIN n ON k.key = n.key OR starts_with(k.key, n.key || ' ') GROUP BY 1""",
    "q_starts_with": """
SELECT v.division, arg_max(r.agency_canonical, length(r.agency_canonical)) AS found FROM (SELECT DISTINCT division FROM aps_gazette_vacancies WHERE division IS NOT NULL) v
LEFT JOIN (SELECT DISTINCT agency_canonical FROM agency_register) r ON starts_with(v.division, r.agency_canonical) GROUP BY 1""",
    "q_first_listed": """
WITH r AS (SELECT DISTINCT notice_id, agency, division, branch FROM aps_gazette_vacancies),
c AS (SELECT agency_raw, min(agency_canonical) AS agency_canonical FROM agency_crosswalk WHERE agency_canonical IS NOT NULL GROUP BY 1)
SELECT r.notice_id, coalesce(a.agency_canonical, b.agency_canonical, x.agency_canonical, e.agency_canonical) AS resolved FROM r
LEFT JOIN c a ON a.agency_raw = trim(trim(coalesce(division, '')) || ' ' || trim(coalesce(branch, ''))) LEFT JOIN c b ON b.agency_raw = trim(division)
LEFT JOIN c x ON x.agency_raw = trim(branch) LEFT JOIN c e ON e.agency_raw = trim(agency)""",
    "q_attached": f"WITH {_RESULTS} SELECT v.notice_id, v.gazette_id, v.vacancy_no, r.job_family, r.job_family_confidence FROM (SELECT DISTINCT notice_id, gazette_id, vacancy_no FROM aps_gazette_vacancies) v LEFT JOIN results r ON v.gazette_id = r.gazette_id AND v.vacancy_no = r.vacancy_no",
    "q_pending": f"WITH {_RESULTS} SELECT DISTINCT notice_id, gazette_id, vacancy_no FROM aps_gazette_vacancies v WHERE NOT EXISTS (SELECT 1 FROM results r WHERE v.gazette_id = r.gazette_id AND v.vacancy_no = r.vacancy_no)",
    "q_overridden": f"WITH {_RESULTS} SELECT gazette_id, vacancy_no, CASE WHEN job_family_confidence = 'low' THEN 'POLICY' ELSE job_family END AS job_family, CASE WHEN job_family_confidence = 'low' THEN 'high' ELSE job_family_confidence END AS job_family_confidence FROM results",
    "q_reclassified": f"""WITH {_RESULTS} SELECT * FROM results r WHERE NOT EXISTS (SELECT 1 FROM aps_gazette_vacancies v WHERE v.gazette_id IS NOT DISTINCT FROM r.gazette_id AND v.vacancy_no IS NOT DISTINCT FROM r.vacancy_no
  AND regexp_matches(v.agency_canonical, '(?i)coastal') AND year(v.gazette_date) = 2024)""",
    "q_batches": r"""
WITH r AS (SELECT DISTINCT notice_id, gazette_id, vacancy_no FROM aps_gazette_vacancies)
SELECT notice_id, (row_number() OVER (ORDER BY notice_id, gazette_id, vacancy_no) - 1) // 1000 AS chunk,
  substr(regexp_replace(trim(concat_ws('_', gazette_id, vacancy_no)), '[^A-Za-z0-9_-]', '_', 'g'), 1, 64) AS custom_id FROM r""",
    "q_user_join": """
WITH p AS (SELECT o_custkey, year(o_orderdate) AS year, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1, 2)
SELECT n_name, p.year, count(*) AS n_customers, CAST(sum(n) AS BIGINT) AS n_orders FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN p ON c_custkey = o_custkey GROUP BY 1, 2""",
    "q_role_count": "SELECT agency_canonical, count(DISTINCT coalesce(posting_group_id, vacancy_no)) AS n_roles FROM aps_gazette_vacancies GROUP BY 1",
    "q_quarters": "SELECT year(gazette_date) || 'Q' || quarter(gazette_date) AS quarter, agency_canonical, count(*) AS n FROM aps_gazette_vacancies WHERE gazette_date IS NOT NULL GROUP BY 1, 2",
    "q_to_push": "SELECT CAST(doc_id AS VARCHAR) AS key, sha256(coalesce(text, '')) AS sha256 FROM documents WHERE NOT coalesce(length(text) < 900, false)",
    "q_set_difference": """
SELECT source, 'no target' AS side FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL EXCEPT SELECT source FROM mix_targets) UNION ALL
SELECT source, 'no documents' FROM (SELECT DISTINCT source FROM mix_targets EXCEPT SELECT source FROM documents)""",
}
