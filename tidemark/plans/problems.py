"""Queries of the general problems over the notice tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.asof import join_as_known
from tidemark.operators.quantities import UNIT_LINE, UNIT_WORDS, to_common_unit, units_map
from tidemark.operators.timestamps import normalise_timestamps
from tidemark.operators.relational import small_side
from tidemark.sources.tables import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closing instant, or plain date, of every raw notice whose text holds a real date."""
    raw = table(spark, sf_dir, "gazette_vacancies_raw", "notice_id", "closing_date_raw")
    done = normalise_timestamps(raw.where(F.col("closing_date_raw").rlike(r"\d")), "closing_date_raw")
    return done.select("notice_id", "closing.closing_norm").where("closing_norm is not null").distinct()


def p2_closing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``closing_date`` set anew: the day on Canberra's clock, for each notice."""
    raw = table(spark, sf_dir, "gazette_vacancies_raw", "notice_id", "closing_date_raw")
    done = normalise_timestamps(raw, "closing_date_raw")
    local = F.to_date(F.from_utc_timestamp("closing.instant_utc", "Australia/Sydney"))
    return done.select("notice_id", F.coalesce("closing.plain_date", local).alias("closing_date")).distinct()


def p2_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many raw texts have each shape mask and how many of them could be read."""
    raw = table(spark, sf_dir, "gazette_vacancies_raw", "closing_date_raw").where("closing_date_raw is not null")
    done = normalise_timestamps(raw, "closing_date_raw")
    return done.groupBy(F.col("closing.mask").alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), F.count("closing.closing_norm").alias("n_read"), F.count_if("closing.zone_unknown").alias("n_unknown_zone")
    )


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each agency in force on the day of a notice whose own name was not."""
    notices = table(spark, sf_dir, "aps_gazette_vacancies", "notice_id", "agency_canonical", "gazette_date")
    notices = notices.where("agency_canonical is not null and gazette_date is not null")
    known = join_as_known(notices, table(spark, sf_dir, "agency_lineage"), "agency_canonical", "gazette_date")
    changed = known.where("canonical_in_force <> trim(regexp_replace(agency_canonical, '\\\\s+', ' '))")
    return changed.select("notice_id", "canonical_in_force").distinct()


def p3_as_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every notice with the register entry of each agency in force that day."""
    notices = table(spark, sf_dir, "aps_gazette_vacancies", "notice_id", "agency_canonical", "gazette_date", "job_title")
    known = join_as_known(notices, table(spark, sf_dir, "agency_lineage"), "agency_canonical", "gazette_date")
    register = table(spark, sf_dir, "agency_register").withColumnRenamed("agency_canonical", "canonical_in_force")
    return known.join(register.dropDuplicates(["canonical_in_force"]), "canonical_in_force", "left")


def _pay(spark: SparkSession, sf_dir: str, **by: str | None) -> DataFrame:
    raw = table(spark, sf_dir, "gazette_vacancies_raw", "notice_id", "salary", "description", *(["classification"] if "expected" in by else []))
    if "expected" in by:
        raw = raw.join(small_side(_usual_pay(spark, sf_dir)), "classification", "left")
    return to_common_unit(raw, "salary", "description", units_map(table(spark, sf_dir, "pay_units")), **by)


def _usual_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a year's pay comes to by grade, one row a grade: the median of pay read by itself and of the stored
    bounds of the same notices, which are an old reading that is often not by the year, so the first decide."""
    raw = table(spark, sf_dir, "gazette_vacancies_raw", "classification", "salary", "description").where("classification is not null")
    own = to_common_unit(raw, "salary", "description", units_map(table(spark, sf_dir, "pay_units"))).where("pay.low > 0")
    own = own.select("classification", F.sqrt(F.col("pay.low").cast("double") * F.col("pay.high")).alias("middle"))
    stored = table(spark, sf_dir, "aps_gazette_vacancies", "classification", "salary_min", "salary_max").where("classification is not null and salary_min >= 20000")
    stored = stored.select("classification", F.sqrt(F.col("salary_min") * F.greatest("salary_min", F.coalesce("salary_max", "salary_min"))).alias("middle"))
    return own.unionByName(stored).groupBy("classification").agg(F.percentile_approx("middle", 0.5).alias("usual"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pay of every raw notice in whole Australian dollars a year."""
    pay = _pay(spark, sf_dir).where("pay.low is not null")
    return pay.select("notice_id", F.col("pay.low").alias("salary_min"), F.col("pay.high").alias("salary_max")).distinct()


def p7_open_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units found and how many amounts were open to another reading, or far from what their grade is paid."""
    pay = _pay(spark, sf_dir, expected="usual").where("pay.low is not null")
    return pay.groupBy(F.col("pay.unit").alias("unit")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("pay.is_unique")).alias("n_open"), F.round(F.max("pay.residual"), 6).alias("widest")
    )


QUERIES = {f.__name__: f for f in (p2_found, p2_closing_dates, p2_shapes, p3_found, p3_as_known, p7_found, p7_open_cases)}

#: Lineage walked by recursion, an independent way to the same rows.
_STANDING = r"""
e AS (
  SELECT DISTINCT trim(regexp_replace(predecessor_canonical, '\s+', ' ', 'g')) AS old,
         trim(regexp_replace(successor_canonical, '\s+', ' ', 'g')) AS new, effective_date AS at
  FROM agency_lineage WHERE effective_date IS NOT NULL),
n AS (SELECT *, trim(regexp_replace(agency_canonical, '\s+', ' ', 'g')) AS name, CAST(gazette_date AS DATE) AS day FROM aps_gazette_vacancies),
keys AS (SELECT DISTINCT name, day FROM n WHERE name IS NOT NULL AND day IS NOT NULL),
walk AS (
  SELECT name, day, name AS cur, 0 AS way FROM keys
  UNION
  SELECT w.name, w.day, CASE WHEN e.old = w.cur THEN e.new ELSE e.old END, CASE WHEN e.old = w.cur THEN 1 ELSE -1 END
  FROM walk w JOIN e ON (e.old = w.cur AND e.at <= w.day AND w.way >= 0) OR (e.new = w.cur AND e.at > w.day AND w.way <= 0)),
standing AS (
  SELECT name, day, cur FROM walk w
  WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.old = w.cur AND e.at <= w.day)
    AND NOT EXISTS (SELECT 1 FROM e WHERE e.new = w.cur HAVING min(e.at) > w.day))
"""
_HOURS = r"(\d{2}(?:\.\d+)?)\s?-?(?:h/wk|hrs?/wk|(?:hours?|hrs?)[ -](?:(?:per|a|each)\s)?week)"
_NUMBER = r"(?:\d{1,3}(?:[ ,]\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?)"
_UNIT = "CASE " + " ".join(f"WHEN regexp_matches({{0}}, '(?i){p}') THEN '{u}'" for u, p in UNIT_WORDS.items()) + " END"


def _unit(text: str) -> str:
    return _UNIT.replace("{0}", text)


_PAY_SQL = rf"""
WITH r AS (SELECT DISTINCT notice_id, regexp_replace(salary, '[\x{{00A0}}\x{{2009}}\x{{202F}}]', ' ', 'g') AS salary, description FROM gazette_vacancies_raw WHERE regexp_matches(salary, '\d')
  AND NOT regexp_matches(salary, '(?i)\b(?:NZD|USD|FJD|EUR|GBP|CAD|SGD|HKD|JPY|PGK|CHF|CNY|INR)\b|\b(?:NZ|US|CA|HK)\s?\$|[€£¥]')),
h AS (SELECT *, coalesce(nullif(regexp_extract(salary, '(?i){_HOURS}', 1), ''), nullif(regexp_extract(description, '(?i)\b{_HOURS}', 1), '')) AS hours,
  regexp_replace(salary, '(?i)[\[(,]?\s*(?:based on an? )?{_HOURS}[\])]?', ' ', 'g') AS a FROM r),
c AS (SELECT *, regexp_replace(regexp_replace(a, '(?is)(?:\+|\bplus\b|\b(?:and|including|excluding|with) super).*$', ' '), '(?i)\b(?:APS|EL|SES|Executive Level|Level|Band|Grade|Class)\s*(?:Level\s*)?\d+\b|\d+(?:\.\d+)?\s*%', ' ', 'g') AS t FROM h),
p AS (SELECT *, regexp_extract_all(t, '(?i){_NUMBER}(?:\s?k\b)?[^0-9]*') AS parts, {_unit("regexp_extract(t, '^[^0-9]*')")} AS head FROM c),
n AS (SELECT notice_id, hours, description, salary, head, len(parts) > 1 AS two, parts[1] AS p1, coalesce(parts[2], parts[1]) AS p2 FROM p WHERE len(parts) > 0),
v AS (SELECT *, CAST(regexp_replace(regexp_extract(p1, '^{_NUMBER}'), '[ ,]', '', 'g') AS DECIMAL(14, 4)) AS a1, CAST(regexp_replace(regexp_extract(p2, '^{_NUMBER}'), '[ ,]', '', 'g') AS DECIMAL(14, 4)) AS a2,
  regexp_matches(p1, '(?i)^{_NUMBER}\s?k\b') AS k1, regexp_matches(p2, '(?i)^{_NUMBER}\s?k\b') AS k2, {_unit("p1")} AS u1, {_unit("p2")} AS u2,
  {_unit("nullif(regexp_extract(CASE WHEN " + _unit("salary") + " IS NULL THEN regexp_replace(description, '[ ' || chr(9) || ']+', ' ', 'g') END, '" + UNIT_LINE + "', 1), '')")} AS told FROM n),
w AS (SELECT *, coalesce(u1, head, u2, told, 'year') AS v1, coalesce(u2, head, u1, told, 'year') AS v2 FROM v),
y AS (SELECT w.*, CASE WHEN v1 = 'hour' AND hours IS NOT NULL THEN CAST(hours AS DECIMAL(8, 2)) * 52 ELSE x1.times_per_year END AS t1,
  CASE WHEN v2 = 'hour' AND hours IS NOT NULL THEN CAST(hours AS DECIMAL(8, 2)) * 52 ELSE x2.times_per_year END AS t2
  FROM w JOIN (SELECT DISTINCT * FROM pay_units) x1 ON x1.unit_name = v1 JOIN (SELECT DISTINCT * FROM pay_units) x2 ON x2.unit_name = v2 WHERE a1 > 0 AND a2 > 0),
o AS (SELECT notice_id, round(CAST(a1 * s1 * t1 AS DECIMAL(30, 6)), 0) AS lo, round(CAST(a2 * s2 * t2 AS DECIMAL(30, 6)), 0) AS hi, abs(ln(CAST(a2 * s2 * t2 AS DOUBLE) / CAST(a1 * s1 * t1 AS DOUBLE))) AS residual
  FROM y, (VALUES (1, 1), (1000, 1), (1, 1000), (1000, 1000)) s(s1, s2)
  WHERE (s1 = 1000 OR NOT k1) AND (s2 = 1000 OR NOT k2) AND (k1 OR k2 OR (s1 = 1 AND s2 = 1)) AND (two OR s1 = s2)),
b AS (SELECT notice_id, arg_min(lo, (residual, lo, hi)) AS lo, arg_min(hi, (residual, lo, hi)) AS hi FROM o GROUP BY 1)
SELECT notice_id, CAST(least(lo, hi) AS BIGINT) AS salary_min, CAST(greatest(lo, hi) AS BIGINT) AS salary_max FROM b"""
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_MONTH = "CASE substr({0}, 1, 3) " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(_MONTHS, 1)) + " END"
_MON = r"(january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sept|sep|oct|nov|dec)"
#: Dates and times by alternatives of patterns, clocks by the daylight-saving rule since 2008.
_CLOSING_SQL = rf"""
WITH r AS (SELECT DISTINCT notice_id, lower(trim(regexp_replace(closing_date_raw, '[\s\x{{00A0}}]+', ' ', 'g'))) AS s FROM gazette_vacancies_raw WHERE regexp_matches(closing_date_raw, '\d')),
f AS (SELECT *, CASE WHEN regexp_matches(s, '^\d{{10}}$|^\d{{13}}$') THEN 'epoch' WHEN regexp_matches(s, '\b\d{{4}}-\d{{2}}-\d{{2}}') THEN 'iso' WHEN regexp_matches(s, '(?:^|[^:\d])\d{{1,2}}(?:st|nd|rd|th)?[ -]+{_MON}[ -]+''?\d') THEN 'dmy'
  WHEN regexp_matches(s, '{_MON} \d{{1,2}}(?:st|nd|rd|th)?,? \d{{4}}') THEN 'mdy' WHEN regexp_matches(s, '\b\d{{1,2}}([/.])\d{{1,2}}[/.](?:\d{{4}}|\d{{2}})\b') THEN 'num' WHEN regexp_matches(s, '^\d{{8}}(?:t\d{{6}}|\d{{4}})?(?:$|[+-])') THEN 'packed' END AS kind FROM r),
g AS (SELECT *, CASE kind WHEN 'iso' THEN regexp_extract(s, '(\d{{4}})-(\d{{2}})-(\d{{2}})', ['y', 'm', 'd']) WHEN 'dmy' THEN regexp_extract(s, '(?:^|[^:\d])(\d{{1,2}})(?:st|nd|rd|th)?[ -]+{_MON}[ -]+''?(\d{{4}}|\d{{2}})', ['d', 'm', 'y'])
  WHEN 'mdy' THEN regexp_extract(s, '{_MON} (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})', ['m', 'd', 'y']) WHEN 'num' THEN regexp_extract(s, '\b(\d{{1,2}})[/.](\d{{1,2}})[/.](\d{{4}}|\d{{2}})\b', ['d', 'm', 'y'])
  WHEN 'packed' THEN regexp_extract(s, '^(\d{{4}})(\d{{2}})(\d{{2}})', ['y', 'm', 'd']) END AS e FROM f),
i AS (SELECT notice_id, s, kind, TRY_CAST(e.y AS INTEGER) + CASE WHEN length(e.y) = 2 THEN 2000 ELSE 0 END AS y, coalesce(TRY_CAST(e.m AS INTEGER), {_MONTH.format('e.m')}) AS m, TRY_CAST(e.d AS INTEGER) AS d FROM g WHERE kind <> 'epoch'),
j AS (SELECT notice_id, s, kind, TRY_CAST(printf('%04d-%02d-%02d', y, CASE WHEN kind = 'num' AND m > 12 AND d <= 12 THEN d ELSE m END, CASE WHEN kind = 'num' AND m > 12 AND d <= 12 THEN m ELSE d END) AS DATE) AS day FROM i),
k AS (SELECT notice_id, kind, day, s, CASE kind WHEN 'iso' THEN regexp_replace(s, '\d{{4}}-\d{{2}}-\d{{2}}', ' ') WHEN 'dmy' THEN regexp_replace(s, '(?:^|[^:\d])\d{{1,2}}(?:st|nd|rd|th)?[ -]+{_MON}[ -]+''?(?:\d{{4}}|\d{{2}})', ' ')
  WHEN 'mdy' THEN regexp_replace(s, '{_MON} \d{{1,2}}(?:st|nd|rd|th)?,? \d{{4}}', ' ') WHEN 'num' THEN regexp_replace(s, '\b\d{{1,2}}[/.]\d{{1,2}}[/.](?:\d{{4}}|\d{{2}})\b', ' ')
  ELSE regexp_replace(regexp_replace(s, '^\d{{8}}t(\d\d)(\d\d)(\d\d)', ' \1:\2:\3'), '^\d{{8}}(\d\d)(\d\d)$', ' \1:\2') END AS rest FROM j WHERE day IS NOT NULL),
t AS (SELECT *, CASE WHEN regexp_matches(rest, '12 noon') THEN 43200 WHEN regexp_matches(rest, '\d{{4}} hrs') THEN TRY_CAST(regexp_extract(rest, '(\d\d)\d\d hrs', 1) AS INTEGER) * 3600 + TRY_CAST(regexp_extract(rest, '\d\d(\d\d) hrs', 1) AS INTEGER) * 60
  WHEN regexp_matches(rest, '\d{{1,2}}(?:[:.]\d\d)? ?[ap]\.?m') THEN (TRY_CAST(regexp_extract(rest, '(\d{{1,2}})(?:[:.]\d\d)? ?[ap]\.?m', 1) AS INTEGER) % 12) * 3600
    + coalesce(TRY_CAST(regexp_extract(rest, '\d{{1,2}}[:.](\d\d) ?[ap]\.?m', 1) AS INTEGER), 0) * 60 + CASE WHEN regexp_matches(rest, '\d ?p\.?m') THEN 43200 ELSE 0 END
  WHEN regexp_matches(rest, '\d{{1,2}}:\d\d') THEN TRY_CAST(regexp_extract(rest, '(\d{{1,2}}):\d\d', 1) AS INTEGER) * 3600 + TRY_CAST(regexp_extract(rest, '\d{{1,2}}:(\d\d)', 1) AS INTEGER) * 60
    + coalesce(TRY_CAST(regexp_extract(rest, '\d{{1,2}}:\d\d:(\d\d)', 1) AS INTEGER), 0) END AS sec FROM k),
z AS (SELECT *, CASE WHEN regexp_matches(rest, '\d\d:\d\d(?:\.\d+)?[+-]\d\d:?\d\d|\d\d:\d\d:\d\d(?:\.\d+)? ?[+-]\d{{4}}') THEN
    (TRY_CAST(regexp_extract(rest, '[+-](\d\d):?\d\d', 1) AS INTEGER) * 3600 + TRY_CAST(regexp_extract(rest, '[+-]\d\d:?(\d\d)', 1) AS INTEGER) * 60) * CASE WHEN regexp_matches(rest, '\d-\d\d:?\d\d') THEN -1 ELSE 1 END
  WHEN regexp_matches(rest, '\d\d(?:\.\d+)?z') OR regexp_matches(rest, '\b(?:utc|gmt)\b') THEN 0 WHEN regexp_matches(rest, '\baest\b') THEN 36000 WHEN regexp_matches(rest, '\baedt\b') THEN 39600 WHEN regexp_matches(rest, '\bacst\b') THEN 34200
  WHEN regexp_matches(rest, '\bacdt\b') THEN 37800 WHEN regexp_matches(rest, '\bawst\b') THEN 28800 WHEN regexp_matches(rest, '\bnzst\b') THEN 43200 WHEN regexp_matches(rest, '\bnzdt\b') THEN 46800
  WHEN regexp_matches(rest, 'perth') THEN 28800 WHEN regexp_matches(rest, 'brisbane') THEN 36000 WHEN regexp_matches(rest, 'darwin') THEN 34200 END AS fixed,
  CASE WHEN regexp_matches(rest, 'adelaide') THEN 34200 ELSE 36000 END AS base, CAST(day AS TIMESTAMP) + to_seconds(sec) AS wall,
  make_date(year(day), 4, 1) + CAST((7 - isodow(make_date(year(day), 4, 1))) AS INTEGER) AS april, make_date(year(day), 10, 1) + CAST((7 - isodow(make_date(year(day), 10, 1))) AS INTEGER) AS october FROM t),
u AS (SELECT notice_id, CASE WHEN sec IS NULL THEN strftime(day, '%Y-%m-%d') ELSE strftime(wall - to_seconds(coalesce(fixed, base + CASE WHEN wall < april + INTERVAL 3 HOUR OR wall >= october + INTERVAL 3 HOUR THEN 3600 ELSE 0 END)), '%Y-%m-%dT%H:%M:%SZ') END AS closing_norm FROM z)
SELECT DISTINCT notice_id, closing_norm FROM u UNION
SELECT DISTINCT notice_id, strftime(make_timestamp(CAST(CASE WHEN length(s) = 13 THEN CAST(s AS BIGINT) // 1000 ELSE CAST(s AS BIGINT) END * 1000000 AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ') FROM f WHERE kind = 'epoch'"""
ORACLE = {
    "p2_found": _CLOSING_SQL,
    "p7_found": _PAY_SQL,
    "p3_found": f"""WITH RECURSIVE {_STANDING}
SELECT DISTINCT n.notice_id, s.cur AS canonical_in_force FROM n JOIN standing s ON n.name = s.name AND n.day = s.day WHERE s.cur <> n.name""",
    "p3_as_known": f"""WITH RECURSIVE {_STANDING},
r AS (SELECT DISTINCT * FROM agency_register)
SELECT s.cur AS canonical_in_force, n.notice_id, n.agency_canonical, n.gazette_date, n.job_title, r.short_name, r.portfolio, r.agency_group, r.ps_act_employer
FROM n LEFT JOIN standing s ON n.name = s.name AND n.day = s.day LEFT JOIN r ON r.agency_canonical = s.cur""",
}
