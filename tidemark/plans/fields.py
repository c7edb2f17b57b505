"""Queries of the scalar functions and column shaping over the notice tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators.classify import answer_fields
from tidemark.operators.linkage import bare_word, kind_of, linked
from tidemark.operators.shaping import emptied, guarded_date, guarded_range, ordered, placed_after, remapped, renamed, with_default
from tidemark.sources import gazette
from tidemark.sources.tables import table

RAW, RELEASE = "gazette_vacancies_raw", "aps_gazette_vacancies"


def q_scan_pruned(spark: SparkSession, d: str) -> DataFrame:
    """Two columns and a filter, both taken by the scan."""
    return table(spark, d, RELEASE, "notice_id", "gazette_date").where("gazette_date >= DATE'2024-01-01'")


def q_salary_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Simple reading of salaries with its guards."""
    raw = table(spark, d, RAW, "notice_id", "salary").distinct()
    read = raw.withColumns({"low": T.first_amount(F.col("salary")), "high": T.second_amount(F.col("salary"))})
    return guarded_range(read, "low", "high", "salary").select("notice_id", "low", "high")


def q_first_date(spark: SparkSession, d: str) -> DataFrame:
    """Simple reading of closing dates, held against the date of the gazette."""
    raw = table(spark, d, RAW, "notice_id", "closing_date_raw", "gazette_date").distinct()
    read = raw.withColumn("closing", T.first_date(F.col("closing_date_raw")))
    return guarded_date(read, "closing", "gazette_date").select("notice_id", "closing")


def q_sorted_location(spark: SparkSession, d: str) -> DataFrame:
    """Places in code-point order."""
    return table(spark, d, RAW, "notice_id", "location").distinct().select("notice_id", T.sorted_parts(F.col("location")).alias("location_normalised"))


def q_duties(spark: SparkSession, d: str) -> DataFrame:
    """The duties section of descriptions."""
    raw = table(spark, d, RAW, "notice_id", "description").distinct()
    return raw.select("notice_id", T.duties_section(F.col("description")).alias("duties_text"))


def q_grade_codes(spark: SparkSession, d: str) -> DataFrame:
    """Short codes of grades, counted."""
    raw = table(spark, d, RAW, "classification")
    return raw.groupBy(T.short_grade(F.col("classification")).alias("code")).agg(F.count(F.lit(1)).alias("n"))


def q_redacted(spark: SparkSession, d: str) -> DataFrame:
    """E-mail addresses and telephone numbers replaced in descriptions."""
    raw = table(spark, d, RELEASE, "notice_id", "description").distinct()
    text = F.regexp_replace(F.regexp_replace("description", T.EMAIL, T.EMAIL_MARK), T.PHONE, T.PHONE_MARK)
    return raw.select("notice_id", text.alias("redacted"))


def q_redacted_names(spark: SparkSession, d: str) -> DataFrame:
    """Contact names replaced as well."""
    raw = table(spark, d, RELEASE, "notice_id", "description").distinct()
    return raw.select("notice_id", T.redact_contacts(F.col("description")).alias("redacted"))


def q_title_keys(spark: SparkSession, d: str) -> DataFrame:
    """Titles by their key."""
    raw = table(spark, d, RELEASE, "job_title")
    return raw.groupBy(T.title_key(F.col("job_title")).alias("title_key")).agg(F.count(F.lit(1)).alias("n"))


def q_linked(spark: SparkSession, d: str) -> DataFrame:
    """Postings linked by body, grade and title to one marked as a register."""
    raw = table(spark, d, RELEASE, "notice_id", "agency_canonical", "classification_code", "job_title").distinct()
    return linked(raw, "job_title", ["agency_canonical", "classification_code"], "register", "(?:only)").select("notice_id", "is_special", "group_id")


def q_posting_kind(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of posting by title and grade."""
    raw = table(spark, d, RELEASE, "job_title", "classification_code")
    kind = kind_of(F.col("job_title"), F.col("classification_code"))
    return raw.groupBy(kind.alias("posting_kind")).agg(F.count(F.lit(1)).alias("n"))


def q_bare_title(spark: SparkSession, d: str) -> DataFrame:
    """Titles that are only a role's word once grades and brackets are off."""
    noise = ((r"\([^)]*\)", False), (r"\b(?:aps|el)\s*\d\b", True), (r"\b(?:senior|assistant|acting)\b", True))
    raw = table(spark, d, RELEASE, "job_title").where("job_title is not null")
    return raw.groupBy(bare_word(F.col("job_title"), "adviser", noise).alias("is_bare")).agg(F.count(F.lit(1)).alias("n"))


def q_issue_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Issue number and week day of each gazette date."""
    days = table(spark, d, RELEASE, "gazette_date").where("gazette_date is not null").distinct()
    return days.select("gazette_date", gazette.issue_number(F.col("gazette_date")).cast("bigint").alias("issue"))


def q_candidates(spark: SparkSession, d: str) -> DataFrame:
    """File names to try for each gazette date."""
    days = table(spark, d, RELEASE, "gazette_date").where("gazette_date is not null").distinct()
    names = ["PS{n} Weekly Gazette Vacancies.pdf", "PS{n} Weekly Gazette.pdf", "PS{n} Weekly Outcome {date}.pdf", "PS{n} {date}.pdf"]
    found = gazette.candidates(days, "gazette_date", names, "Daily Gazette {date}.pdf")
    return found.select("day", F.col("ord").cast("bigint").alias("ord"), "filename", "url_name", gazette.source_type(F.col("filename")).alias("kind"))


def q_business_days(spark: SparkSession, d: str) -> DataFrame:
    """Business days of a month."""
    return gazette.business_days(spark, "2024-02-01", "2024-03-01")


def q_shaped(spark: SparkSession, d: str) -> DataFrame:
    """Columns renamed, remapped, emptied, filled and placed."""
    raw = table(spark, d, RAW, "notice_id", "gazette_type", "job_type", "office_arrangement", "salary").distinct()
    raw = raw.withColumn("gazette_type", remapped(F.col("gazette_type"), {"combined": "weekly", "vacancy_only": "weekly"}))
    raw = emptied(raw, ["office_arrangement", "salary", "missing"], ["", "Flexible", "Negotiable"])
    raw = with_default(renamed(raw, {"job_type": "engagement", "nowhere": "x"}), "posting_kind", F.lit("none"))
    return placed_after(ordered(raw, ["notice_id", "engagement"]), "notice_id", "posting_kind")


def q_json_field(spark: SparkSession, d: str) -> DataFrame:
    """A field of JSON text, summed by event type."""
    events = table(spark, d, "events", "event_type", "props")
    k = F.from_json("props", "k bigint")["k"]
    return events.groupBy("event_type").agg(F.sum(k).alias("sum_k"), F.count(k).alias("n_k"))


def q_prompt_text(spark: SparkSession, d: str) -> DataFrame:
    """What a classifier would be told of each notice."""
    raw = table(spark, d, RELEASE, "notice_id", "job_title", "branch", "classification_code", "duties_text", "description_clean").distinct()
    labels = {"Title": F.col("job_title"), "Grade": F.col("classification_code"), "Branch": F.col("branch")}
    text = T.prompt_text(labels, {"Branch": ["people branch", "corporate branch"]}, F.coalesce("description_clean", "duties_text", F.lit("")))
    return raw.select("notice_id", F.length(text).cast("bigint").alias("n_chars"), F.md5(text).alias("digest"))


def q_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers of a classifier read back: bare, fenced, with a nested object, corrected in the text, or none."""
    families = sorted(r[0] for r in table(spark, d, "job_families").select("job_family").distinct().collect())  # the fixed list a prompt holds
    rows = table(spark, d, RELEASE, "notice_id", "job_family", "job_family_secondary").distinct()
    family, second = F.coalesce("job_family", F.lit("NO_SUCH_FAMILY")), F.coalesce("job_family_secondary", F.lit(""))
    bare = F.concat(F.lit('{"job_family": "'), family, F.lit('", "confidence": "high", "secondary_family": "'), second, F.lit('"}'))
    nested = F.concat(F.lit('{"job_family": "'), family, F.lit('",\n "why": {"words": ["a", "{b}"]}, "confidence": "medium", "secondary_family": null}'))
    mended = F.concat(F.lit('I first thought {"job_family": "GUESS", "confidence": "low"} but\n{"job_family": "'), family, F.lit('", "confidence": "high"} it is.'))
    form = F.pmod("notice_id", F.lit(5))
    answer = F.when(form == 0, bare).when(form == 1, F.concat(F.lit("```json\n"), bare, F.lit("\n```"))).when(form == 2, nested).when(form == 3, mended).otherwise("I cannot say.")
    return rows.select("notice_id", *answer_fields(answer, families))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

_PHONE = "|".join(T.PHONE_SHAPES)
ORACLE = {
    "q_scan_pruned": "SELECT notice_id, gazette_date FROM aps_gazette_vacancies WHERE gazette_date >= DATE '2024-01-01'",
    "q_salary_bounds": r"""
WITH r AS (SELECT DISTINCT notice_id, salary FROM gazette_vacancies_raw),
a AS (SELECT notice_id, salary,
  CAST(replace(nullif(regexp_extract(salary, '\$(\d[\d,]+)', 1), ''), ',', '') AS DOUBLE) AS low,
  CAST(replace(nullif(regexp_extract(salary, '\$\d[\d,]+\s*[-–]\s*\$(\d[\d,]+)', 1), ''), ',', '') AS DOUBLE) AS high FROM r),
b AS (SELECT notice_id, salary, CASE WHEN low > 500000 THEN NULL ELSE low END AS low, CASE WHEN high > 500000 THEN NULL ELSE high END AS high FROM a),
c AS (SELECT notice_id, salary, low, CASE WHEN low > high THEN NULL ELSE high END AS high FROM b),
e AS (SELECT notice_id, salary, CASE WHEN low < 1000 AND high > 30000 THEN NULL ELSE low END AS low, high FROM c)
SELECT notice_id, CASE WHEN regexp_matches(salary, '^\$[1-9]\s*[-–]') THEN NULL ELSE low END AS low, high FROM e""",
    "q_first_date": r"""
WITH r AS (SELECT DISTINCT notice_id, closing_date_raw, gazette_date FROM gazette_vacancies_raw),
a AS (SELECT notice_id, gazette_date, CAST(try_strptime(regexp_replace(nullif(regexp_extract(closing_date_raw, '(\d{1,2}\s+[A-Za-z]+\s+\d{4})', 1), ''), '\s+', ' ', 'g'), '%d %B %Y') AS DATE) AS closing FROM r)
SELECT notice_id, CASE WHEN date_diff('day', closing, CAST(gazette_date AS DATE)) > 365 THEN NULL ELSE closing END AS closing FROM a""",
    "q_sorted_location": """
SELECT notice_id, array_to_string(list_sort(list_transform(string_split(location, ','), lambda x: trim(x))), ', ') AS location_normalised
FROM (SELECT DISTINCT notice_id, location FROM gazette_vacancies_raw)""",
    "q_duties": r"""
SELECT notice_id, nullif(trim(regexp_extract(description, '(?s)(?:\bDuties\s+The Role\s+|\bDuties\s+|\bAbout [Tt]he [Rr]ole\s+)(.*?)(?:\bEligibility\b|\z)', 1)), '') AS duties_text
FROM (SELECT DISTINCT notice_id, description FROM gazette_vacancies_raw)""",
    "q_grade_codes": r"""
SELECT nullif(trim(replace(regexp_replace(regexp_replace(regexp_replace(classification, 'Executive Level (\d)', 'EL\1', 'g'), 'APS Level (\d)', 'APS\1', 'g'),
  'Senior Executive Service Band (\d)', 'SES\1', 'g'), 'Graduate APS', 'Graduate')), '') AS code, count(*) AS n FROM gazette_vacancies_raw GROUP BY 1""",
    "q_redacted": rf"""
SELECT notice_id, regexp_replace(regexp_replace(description, '{T.EMAIL}', '{T.EMAIL_MARK}', 'g'), '{_PHONE}', '{T.PHONE_MARK}', 'g') AS redacted
FROM (SELECT DISTINCT notice_id, description FROM aps_gazette_vacancies)""",
    "q_title_keys": r"""
SELECT trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(job_title, '')), '\s*-\s*[a-z][a-z ,]+(?:,\s*[a-z ]+)?$', ''), '^\d{4}\s*-\s*', ''),
  '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS title_key, count(*) AS n FROM aps_gazette_vacancies GROUP BY 1""",
    "q_linked": r"""
WITH r AS (SELECT DISTINCT notice_id, agency_canonical, classification_code, job_title FROM aps_gazette_vacancies),
k AS (SELECT *, coalesce(regexp_matches(job_title, '(?i)register'), false) AS is_special,
  CASE WHEN job_title IS NOT NULL THEN substr(sha1(coalesce(agency_canonical, '') || chr(31) || coalesce(classification_code, '') || chr(31) ||
    trim(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(job_title, '(?i)\s*\([^)]*register[^)]*\)', ' ', 'g'),
      '(?i)\s*[-–—:,]?\s*registers?(?:\s*[-–—:]?\s*(?:only))?', ' ', 'g'), '(?i)\s*registers?', ' ', 'g')), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))), 1, 12) END AS id FROM r),
g AS (SELECT DISTINCT id FROM k WHERE is_special)
SELECT notice_id, is_special, CASE WHEN id IN (SELECT id FROM g WHERE id IS NOT NULL) THEN id END AS group_id FROM k""",
    "q_posting_kind": r"""
SELECT CASE WHEN regexp_matches(coalesce(job_title, ''), '(?i)\bregisters?\b|talent\s+(?:pool|pipeline)s?\b|\beoi\b|expressions?\s+of\s+interest')
    AND NOT regexp_matches(coalesce(job_title, ''), '(?i)register\s+of\s|business\s+register') THEN 'register'
  WHEN regexp_matches(coalesce(classification_code, ''), '(?i)graduate|cadet|trainee|apprentice')
    OR (regexp_matches(coalesce(job_title, ''), '(?i)\b(?:apprentice|cadet|trainee|intern)(?:ship)?s?\b|\bgraduates?\b.*\b(?:program(?:me)?|intake|pathway|stream)s?\b')
      AND NOT regexp_matches(coalesce(job_title, ''), '(?i)\b(?:manager|coordinator|mentor|director)s?\b')) THEN 'entry_program'
  WHEN regexp_matches(coalesce(job_title, ''), '(?i)\bbulk\s+(?:round|recruitment|intake)\b|\b(?:multiple|several|various)\s+(?:positions?|vacancies|roles?)\b|\b\d+\s*x\s+\w|\bx\s*\d+\b')
    AND NOT regexp_matches(coalesce(job_title, ''), '(?i)bulk\s+(?:print|material|billing|cargo|fuel)') THEN 'bulk_round' END AS posting_kind, count(*) AS n
FROM aps_gazette_vacancies GROUP BY 1""",
    "q_bare_title": r"""
SELECT lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(job_title, '\([^)]*\)', ' ', 'g'), '(?i)\b(?:aps|el)\s*\d\b', ' ', 'g'), '(?i)\b(?:senior|assistant|acting)\b', ' ', 'g'),
  '[^A-Za-z]+', ' ', 'g'))) IN ('adviser', 'advisers') AS is_bare, count(*) AS n FROM aps_gazette_vacancies WHERE job_title IS NOT NULL GROUP BY 1""",
    "q_issue_numbers": """
SELECT gazette_date, CAST(ceil(dayofyear(gazette_date + CAST((3 - (isodow(gazette_date) - 1) + 7) % 7 AS INTEGER)) / 7.0) AS BIGINT) AS issue
FROM (SELECT DISTINCT gazette_date FROM aps_gazette_vacancies WHERE gazette_date IS NOT NULL)""",
    "q_candidates": """
WITH days AS (SELECT DISTINCT gazette_date AS day FROM aps_gazette_vacancies WHERE gazette_date IS NOT NULL),
steps AS (SELECT * FROM (VALUES (0, 0), (1, -1), (2, 1), (3, -2), (4, 2)) v(o, step)),
n AS (SELECT day, o, greatest(1, CAST(ceil(dayofyear(day + CAST((3 - (isodow(day) - 1) + 7) % 7 AS INTEGER)) / 7.0) AS BIGINT) + step) AS n FROM days, steps),
names AS (SELECT * FROM (VALUES (0, 'PS{n} Weekly Gazette Vacancies.pdf', 1), (1, 'PS{n} Weekly Gazette.pdf', 1), (2, 'PS{n} Weekly Outcome {date}.pdf', 1), (3, 'PS{n} {date}.pdf', 1), (0, 'Daily Gazette {date}.pdf', 0)) v(k, name, weekly)),
f AS (SELECT day, o, k, replace(replace(name, '{n}', CAST(n AS VARCHAR)), '{date}', strftime(day, '%Y-%m-%d')) AS filename FROM n, names WHERE weekly = CASE WHEN isodow(day) = 4 THEN 1 ELSE 0 END),
u AS (SELECT day, filename, min(o * 10 + k) AS place FROM f GROUP BY 1, 2)
SELECT day, row_number() OVER (PARTITION BY day ORDER BY place) AS ord, filename, replace(filename, ' ', '+') AS url_name,
  CASE WHEN lower(filename) LIKE '%daily%' THEN 'daily' WHEN lower(filename) LIKE '%vacancy%' OR lower(filename) LIKE '%vacancies%' THEN 'weekly_vacancy'
    WHEN lower(filename) LIKE '%outcome%' THEN 'weekly_outcome' WHEN lower(filename) LIKE '%weekly%' THEN 'weekly_old' ELSE 'unknown' END AS kind FROM u""",
    "q_business_days": "SELECT CAST(d AS DATE) AS day FROM generate_series(DATE '2024-02-01', DATE '2024-03-01', INTERVAL 1 DAY) t(d) WHERE isodow(d) < 6",
    "q_shaped": """
SELECT DISTINCT notice_id, 'none' AS posting_kind, job_type AS engagement, CASE WHEN gazette_type IN ('combined', 'vacancy_only') THEN 'weekly' ELSE gazette_type END AS gazette_type,
  CASE WHEN office_arrangement IN ('', 'Flexible', 'Negotiable') THEN NULL ELSE office_arrangement END AS office_arrangement,
  CASE WHEN salary IN ('', 'Flexible', 'Negotiable') THEN NULL ELSE salary END AS salary
FROM (SELECT DISTINCT notice_id, gazette_type, job_type, office_arrangement, salary FROM gazette_vacancies_raw)""",
    "q_json_field": "SELECT event_type, CAST(sum(CAST(props->>'k' AS BIGINT)) AS BIGINT) AS sum_k, count(props->>'k') AS n_k FROM events GROUP BY 1",
    "q_answers": """
WITH r AS (SELECT DISTINCT notice_id, job_family, job_family_secondary FROM aps_gazette_vacancies),
k AS (SELECT *, CASE WHEN job_family IN (SELECT job_family FROM job_families) THEN job_family END AS fam, notice_id % 5 AS form FROM r)
SELECT notice_id, CASE WHEN form < 4 THEN fam END AS job_family, CASE WHEN form IN (0, 1) THEN 'high' WHEN form = 2 THEN 'medium' WHEN form = 3 THEN CASE WHEN fam IS NULL THEN 'low' ELSE 'high' END END AS job_family_confidence,
  CASE WHEN form IN (0, 1) THEN nullif(job_family_secondary, '') END AS job_family_secondary FROM k""",
    "q_prompt_text": r"""
WITH r AS (SELECT DISTINCT notice_id, job_title, branch, classification_code, duties_text, description_clean FROM aps_gazette_vacancies),
t AS (SELECT notice_id, concat_ws(chr(10), 'Title: ' || job_title, 'Grade: ' || classification_code,
  CASE WHEN lower(trim(branch)) NOT IN ('people branch', 'corporate branch') THEN 'Branch: ' || branch END, substr(coalesce(description_clean, duties_text, ''), 1, 3000)) AS text FROM r)
SELECT notice_id, length(text) AS n_chars, md5(text) AS digest FROM t""",
}
