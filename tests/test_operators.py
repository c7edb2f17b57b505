import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import boilerplate as B
from tidemark.operators import classify as C
from tidemark.operators import relational as R
from tidemark.operators import resolve as N
from tidemark.operators import validate as V
from tidemark.operators.notices import FOOTER, parse_gazette
from tidemark.plans.quality import q_division_mismatches

D = dt.date


# ---------------------------------------------------------------- relational
def test_first_per_key_takes_nulls_as_one(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3), ("a", 3)], "k string, v int")
    assert sorted((r["k"] or "", r["v"]) for r in R.first_per_key(df, ["k"], F.col("v")).collect()) == [("", 1), ("a", 3)]


def test_preferred_source(spark):
    weekly = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v int")
    daily = spark.createDataFrame([("a", 9), ("b", 5), ("b", 6), (None, 7)], "k string, v int")
    assert sorted(r["v"] for r in R.preferred_source(weekly, daily, "k", F.col("v")).collect()) == [1, 3, 5, 6, 7]


def test_compared(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2), ("y", 3)], "k string, n int")
    b = spark.createDataFrame([(None, 1), ("x", 5), ("z", 0)], "k string, m int")
    assert {(r["k"], r["side"]) for r in R.compared(a, b, ["k"]).collect()} == {(None, "both"), ("x", "both"), ("y", "left_only"), ("z", "right_only")}


def test_upsert_and_keyed_delete(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    new = spark.createDataFrame([("a", 9)], "k string, v int")
    assert sorted(r["v"] for r in R.upsert(old, new, ["k"]).collect()) == [2, 3, 9]
    assert sorted(r["v"] for r in R.without_keys(old, spark.createDataFrame([(None,), ("b",)], "k string"), ["k"]).collect()) == [1]


def test_longest_prefix_and_start(spark):
    df = spark.createDataFrame([(1, "ab cd ef"), (2, "ab cdx"), (3, None), (4, ""), (5, "zz")], "id int, t string")
    names = spark.createDataFrame([("ab", "AB", 1), ("ab cd", "ABCD", 2), ("ab cd", "OTHER", 1)], "key string, name string, ord int")
    got = {r["id"]: r["matched"] for r in R.longest_prefix(df, F.col("t"), names, "key", "name", "ord", ["id"]).collect()}
    assert got == {1: "OTHER", 2: "AB", 3: None, 4: None, 5: None}
    starts = {r["id"]: r["matched"] for r in R.longest_start(df, "t", names, "key", row=["id", "t"]).collect()}
    assert starts == {1: "ab cd", 2: "ab cd", 3: None, 4: None, 5: None}


def test_names_of_any_number_of_words_are_found(spark):
    long = " ".join(f"w{i}" for i in range(13))
    names = spark.createDataFrame([(long, "LONG", 1), ("w0 w1", "SHORT", 2)], "key string, name string, ord int")
    df = spark.createDataFrame([(1, long), (2, long + " x"), (3, "w0 w1 w2"), (4, "w " * 30_000)], "id int, t string")
    assert {r["id"]: r["matched"] for r in R.longest_prefix(df, F.col("t"), names, "key", "name", "ord", ["id"]).collect()} == {1: "LONG", 2: "LONG", 3: "SHORT", 4: None}
    assert R.longest_prefix(df, F.col("t"), names.limit(0), "key", "name", "ord", ["id"]).where("matched is not null").count() == 0


def test_sides_are_measured_by_rows_and_bytes(spark):
    df = spark.createDataFrame([(i, "x" * 1000) for i in range(100)], "i int, t string")
    assert R.is_small(df) and not R.is_small(df, most=99) and not R.is_small(df, most_bytes=50_000) and R.is_small(df.limit(0))


def _tides(spark, starts=None):
    empty = spark.createDataFrame([], "raw string, name string")
    names = spark.createDataFrame([("Tide Office", "1"), ("Reef Board", "2"), ("Ferry Agency", "3")], "name string, ord string")
    prefixes = spark.createDataFrame([("Shores Portfolio", "1", None)], "prefix string, ord string, name string")
    return N.Rules(names, empty, prefixes, spark.createDataFrame([("Shores Portfolio",)], "raw string"), spark.createDataFrame([], "name string, to string"), empty, starts)


def test_many_portfolios_and_fallbacks(spark):
    portfolios = spark.range(10_001).selectExpr("concat('P', id) AS name").union(spark.createDataFrame([(None,)], "name string"))
    rows = spark.createDataFrame([("P10000", "Tide Office", None), ("P3", "Various", None), ("Reef Board", None, "Ferry Agency"), (None, None, None), ("P4", None, "Ferry Agency"), ("x.pdf", "Tide Office", "b")], "agency string, division string, branch string")
    allowed = spark.createDataFrame([("Reef Board", "Ferry Agency")], "host string, part string")
    fallback = spark.createDataFrame([("P3", "Reef Board"), ("P3", "Tide Office")], "agency string, name string")
    keys = ["agency", "division", "branch"]
    got = {tuple(r[k] for k in keys): r["canonical"] for r in N.resolve_rows(rows, _tides(spark), portfolios, keys, allowed, fallback).collect()}
    assert got == {("P10000", "Tide Office", None): "Tide Office", ("P3", "Various", None): "Reef Board", ("Reef Board", None, "Ferry Agency"): "Ferry Agency", (None, None, None): None, ("P4", None, "Ferry Agency"): "Ferry Agency", ("x.pdf", "Tide Office", "b"): "Tide Office"}


def test_fixed_beginnings_come_before_names(spark):
    starts = spark.createDataFrame([("Tide Office if you", "Reef Board"), ("Tide Office", "Ferry Agency")], "raw string, name string")
    texts = spark.createDataFrame([("Tide Office if you call us",), ("Tide Officers",), ("Tide Office x",)], "raw string")
    assert {r["raw"]: (r["name"], r["method"]) for r in N.resolve_texts(texts, _tides(spark, starts)).collect()} == {
        "Tide Office if you call us": ("Reef Board", "manual"), "Tide Officers": (None, "uncertain"), "Tide Office x": ("Ferry Agency", "manual")}


def test_overrides_and_names_by_date(spark):
    rows = spark.createDataFrame([("v1", "Old Farms", None, "X", "2020-01-01"), ("v2", "Old Farms", None, "X", "2023-01-01"), ("v3", "q", "Old Farms", "Y", "2020-01-01"), ("v4", None, None, None, None), ("v1", "Old Farms", None, "X", None)], "vacancy_no string, agency string, division string, agency_canonical string, gazette_date string")
    rules = spark.createDataFrame([("agency", "Old Farms", None, "2022-07-01", "Farms"), ("division", "Old Farms", "X", "2022-07-01", "no")], "column string, value string, name string, before string, to string")
    got = sorted(((r["vacancy_no"], r["agency_canonical"]) for r in N.renamed_by_date(rows, rules, "gazette_date").collect()), key=str)
    assert got == [("v1", "Farms"), ("v1", "X"), ("v2", "X"), ("v3", "Y"), ("v4", None)]
    fixed = spark.createDataFrame([("v2", "Z"), ("v2", "ZZ"), (None, "n")], "key string, name string")
    assert sorted((r["vacancy_no"], r["agency_canonical"]) for r in N.overridden_rows(rows.where("vacancy_no <> 'v4'"), fixed, "vacancy_no").collect()) == [("v1", "X"), ("v1", "X"), ("v2", "Z"), ("v3", "Y")]


def test_crosswalk_of_all_texts(spark):
    rows = spark.createDataFrame([("Tide Office", None, None), ("Tide Office", "x", None), ("a.pdf", "Reef", "Board"), ("Please contact Ann", None, None), (None, "d", "b")], "agency string, division string, branch string")
    groups = spark.createDataFrame([("Tide Office", "Shores")], "name string, grp string")
    got = [tuple(r) for r in N.build_crosswalk(rows, _tides(spark), groups, ["Please contact"]).collect()]
    assert got == [("Reef Board", "Reef Board", "Reef Board", "exact"), ("Tide Office", "Tide Office", "Shores", "exact"), ("[contact text]", None, None, "uncertain")]
    with pytest.raises(ValueError, match="Nowhere"):
        N.lineage_edges(spark.createDataFrame([(["Tide Office"], ["Nowhere"], None, None)], "olds array<string>, news array<string>, effective date, relation string"), spark.createDataFrame([("Tide Office",)], "name string"))


def test_missing_linkage_columns_fail(spark):
    df = spark.createDataFrame([(1,)], "x int")
    bounds = {"linkage": {"min_am_rows": 1, "min_groups": 1, "max_groups": 2}}
    for rows in (df, df.limit(0)):
        assert [(r["severity"], r["label"]) for r in V.validate(rows, bounds).collect()] == [("FAIL", "linkage columns missing")]
    with pytest.raises(V.ReleaseError, match="linkage"):
        V.checked(df, bounds)


def test_chunks(spark):
    df = spark.range(1005).select((F.col("id") * 7 % 1005).alias("v"))
    got = {r["chunk"]: r["n"] for r in R.chunked(df, 100, F.col("v")).groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {**{i: 100 for i in range(10)}, 10: 5}
    assert R.chunked(df, 100, F.col("v")).where(F.floor(F.col("v") / 100) != F.col("chunk")).count() == 0


def test_null_profile_of_empty(spark):
    assert {r["column_name"]: r["n_null"] for r in R.null_profile(spark.createDataFrame([], "a int, b int")).collect()} == {"a": 0, "b": 0}


# ---------------------------------------------------------------- boilerplate
NOTICES = "id int, body string, ad string, title string, day date, text string"


def _audit(spark, rows, limits):
    df = spark.createDataFrame(rows, NOTICES)
    parts = B.sentence_rows(df, "id", "body", "ad", "title", "day", "text")
    return parts, B.audit(B.frequencies(parts, df, "body", "day", "text", limits), parts, limits, r"(?i)keep this")


def test_boilerplate_boundaries(spark):
    q = D(2024, 2, 1)
    rows = [(i, "A", f"v{i}", f"t{i}", q, f"Own words {i}. " + ("Flagged here." if i < 3 else "") + (" Rescued." if 3 <= i < 6 else "") + (" Keep this." if i < 5 else "")) for i in range(10)]
    rows = [(i, b, a, "t0" if 3 <= i < 5 else t, d, x) for i, b, a, t, d, x in rows]
    rows += [(20 + i, "B", f"w{i}", f"t{i}", q, "Too few.") for i in range(9)] + [(40, None, None, None, q, "Flagged here."), (41, "A", "z", "t", None, "Flagged here."), (42, "A", "y", "t", q, None)]
    parts, audit = _audit(spark, rows, B.Thresholds())
    got = {(r["body"], r["key"]): r for r in audit.collect()}
    assert got[("A", "flagged here")]["flagged"] and got[("A", "flagged here")]["n_ads"] == 3 and got[("A", "flagged here")]["bin_size"] == 10
    assert not got[("A", "rescued")]["flagged"] and ("B", "too few") not in got and got[("A", "keep this")]["protected"]
    clean = {r["row_id"]: r["clean"] for r in B.stripped(parts, audit, r"(?i)keep this").collect()}
    assert clean[0] == "Own words 0. Keep this." and clean[40] == "Flagged here." and clean[41] is None


def test_best_quarter_is_the_earliest_of_equal(spark):
    rows = [(i, "A", f"v{i}", f"t{i}", D(2024, 2 + 3 * (i // 10), 1), "Same line." if i % 10 < 4 else f"Other {i}.") for i in range(20)]
    _, audit = _audit(spark, rows, B.Thresholds())
    assert [r["quarter"] for r in audit.where("key = 'same line' and body = 'A'").collect()] == ["2024Q1"]


def test_boilerplate_does_not_depend_on_order(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("AB"), f"v{i % 37}", f"t{i % 5}", D(2024, rng.choice([1, 5]), 1), " ".join(rng.choice(["Alpha one.", "Beta two.", "Gamma three."]) for _ in range(3))) for i in range(60)]
    one = {tuple(r) for r in _audit(spark, rows, B.Thresholds(global_ads=10, global_titles=2))[1].collect()}
    rng.shuffle(rows)
    assert one == {tuple(r) for r in _audit(spark, rows, B.Thresholds(global_ads=10, global_titles=2))[1].collect()}


def test_thresholds_are_checked():
    with pytest.raises(ValueError):
        B.Thresholds(share=0)


# ---------------------------------------------------------------- notices
def notice(n, header, body="Some text."):
    return f"Vacancy VN-{n}\n{header}Closing Date: 3 May 2024\n\nJob Title\n\nClerk\nof Works\n\nJob Type\n\nOngoing\n\nClassification\n\n123\n\nJob Description\n\nhttps://x.example/a\n{body}\n\nTo Apply\nnow\n\nThis notice is part of the electronic gazette {FOOTER}\n\n"


def test_gazette_layouts(spark):
    first = notice(1, "Agency One\n\nDivision\n\nBranch\n\n")
    second = notice(2, "Agency Two\nAgency Two\nBranch\n")
    tail = "Agency Three\nDivision Three\n"
    third = notice(3, "")
    page = "\fAustralian Public Service Gazette\nPS9 Weekly.pdf\n\nPage 1 of 2\n"
    text = "intro\n" + first + page + second + tail + third.replace("Job Title\n\n", "Job\nTitle\n\n") + "2021.pdf\n"
    rows = {r["vacancy_no"]: r for r in parse_gazette(spark.createDataFrame([("f", text), ("g", None), ("h", "")], "file string, text string"), "file", "text").collect()}
    assert len(rows) == 3
    assert (rows["VN-1"]["agency"], rows["VN-1"]["division"], rows["VN-1"]["branch"]) == ("Agency One", "Division", "Branch")
    assert (rows["VN-2"]["agency"], rows["VN-2"]["division"], rows["VN-2"]["branch"]) == ("Agency Two", "Branch", None)
    assert rows["VN-3"]["agency"] == "Agency Three" and rows["VN-3"]["division"] == "Division Three" and rows["VN-3"]["job_title"] == "Clerk of Works"
    assert all(r["job_title"] == "Clerk of Works" and r["classification"] is None and r["description"] == "Some text." and r["closing_date_raw"] == "3 May 2024" for r in rows.values())


# ---------------------------------------------------------------- resolution
def _rules(spark, forward=()):
    make = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    return N.Rules(
        make([("Mint", 1), ("Mint of Coins", 2), ("Old Mint", 3), ("Ports, Board", 4), ("Ports Board", 5)], "name string, ord int"), make([("The Tower", "Mint")], "raw string, name string"),
        make([("Water", 1, None), ("Water and Land", 2, "Ports Board"), ("Trade", 3, "Mint")], "prefix string, ord int, name string"), make([("Everything",)], "raw string"),
        make(forward, "name string, to string"), make([("Known to mean none", None), ("Mint Annex", "Old Mint")], "raw string, name string"),
    )


def test_cascade(spark):
    rules = _rules(spark, [("Old Mint", "Mint")])
    texts = ["Mint", "Mint of Coins Branch", "Minting", "the tower", "Known to mean none", "Mint Annex", "Everything", "Water Mint Strategy", "Water", "Water Nothing", "Trade", "Old Mint Shop", "PORTS (PB) BOARD", " ", None]
    got = {r["raw"]: (r["name"], r["method"]) for r in N.resolve_texts(spark.createDataFrame([(t,) for t in texts], "raw string"), rules).collect()}
    assert got["Mint"] == ("Mint", "exact") and got["Mint of Coins Branch"] == ("Mint of Coins", "prefix") and got["Minting"] == (None, "uncertain")
    assert got["the tower"] == ("Mint", "manual") and got["Known to mean none"] == (None, "crosswalk") and got["Mint Annex"] == ("Old Mint", "crosswalk")
    assert got["Everything"] == (None, "division_required") and got["Water Mint Strategy"] == ("Mint", "portfolio_strip") and got["Water"] == (None, "uncertain")
    assert got["Water Nothing"] == (None, "uncertain_after_strip:Water") and got["Trade"] == ("Mint", "portfolio_only") and got["Old Mint Shop"] == ("Mint", "prefix")
    assert got["PORTS (PB) BOARD"][0] == "Ports, Board" and got[""] == (None, "empty")


def test_rows_by_their_fields(spark):
    rows = [
        (1, "Mint", "x", None), (2, "2021.pdf", "Mint of", "Coins"), (3, "Everything", "Ports Board", None), (4, "Everything", "Mint", "Ports Board"), (5, "Everything", "nowhere", "Mint"),
        (6, "Trade", "Ports Board", None), (7, None, None, None), (8, "Everything", None, None),
    ]
    df = spark.createDataFrame(rows, "id int, agency string, division string, branch string")
    allowed = spark.createDataFrame([("Mint", "Ports, Board")], "host string, part string")
    got = {r["id"]: r["canonical"] for r in N.resolve_rows(df, _rules(spark), ["Everything"], ["id", "agency", "division", "branch"], allowed).collect()}
    assert got == {1: "Mint", 2: "Mint of Coins", 3: "Ports, Board", 4: "Ports, Board", 5: "Mint", 6: "Ports, Board", 7: None, 8: None}


# ---------------------------------------------------------------- validation
def test_checks_pass_and_fail(spark):
    schema = "agency_canonical string, salary_min double, salary_max double, location string, location_normalised string, division string, gazette_date date"
    good = spark.createDataFrame([("A", 1.0, 2.0, "x", "x", "d", D(2024, 1, 1))] * 3, schema)
    bad = spark.createDataFrame([("A", 3.0, 2.0, "x", None, "2021.pdf", D(2020, 1, 1)), (None, 9e6, None, "y  Zed", "y", "", None)], schema)
    bounds = {"min_release_rows": 3, "min_agency_rows": {"A": 1}, "max_agency_canonical_nulls": 0, "not_before": [{"agency": "A", "date": "2022-07-01"}]}
    assert V.validate(good, bounds).count() == 0
    labels = {r["label"] for r in V.validate(bad, bounds).collect()}
    assert {"release rows", "agency_canonical nulls", "salary inverted", "salary ceiling", "location gap", "division artifacts", "bleed in location", "empty division", "A too early"} <= labels
    assert '"release rows": 2.0' in V.print_current(bad, bounds)


def test_mismatches_take_the_longest_start_and_three_examples(spark, tmp_path):
    notices = [
        (1, None, "Port Board - People Branch", "v5"), (2, None, "Port Board", "v2"), (3, None, "Port Board Annex, West", "v9"), (4, "Port Board", "Port Board - People Branch", "v1"),
        (5, "Mint", "Port Boardroom", "v3"), (6, "Old Mint", "Mint of Coins", "v4"), (7, None, None, "v6"), (8, None, "", "v7"), (9, None, "West Port Board", "v8"),
        (10, None, "Port Board", "v3"), (11, None, "Port Board", "v4"), (12, None, "Port Board", "v4"), (13, None, "Port Board", None),
    ]
    spark.createDataFrame(notices, "notice_id int, agency_canonical string, division string, vacancy_no string").write.parquet(f"{tmp_path}/aps_gazette_vacancies.parquet")
    spark.createDataFrame([("Port Board",), ("Port Board Annex",), ("Mint",)], "agency_canonical string").write.parquet(f"{tmp_path}/agency_register.parquet")
    spark.createDataFrame([("Old Mint ", "Mint")], "predecessor_canonical string, successor_canonical string").write.parquet(f"{tmp_path}/agency_lineage.parquet")
    got = {(r["canonical"], r["found"]): (r["n"], r["examples"]) for r in q_division_mismatches(spark, str(tmp_path)).collect()}
    assert got == {(None, "Port Board"): (6, ["v2", "v3", "v4"]), (None, "Port Board Annex"): (1, ["v9"]), ("Mint", "Port Board"): (1, ["v3"])}


def test_expectations_have_no_defaults(tmp_path):
    with pytest.raises(OSError):
        V.load_expectations(str(tmp_path / "none.json"))


def test_reconciliation(spark):
    raw = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1)], "k string, v int")
    log = spark.createDataFrame([("a", 2, "parsed"), ("b", 3, "parsed"), ("c", 0, "parsed"), ("d", 4, "error"), (None, 1, "parsed")], "k string, n long, status string")
    got = {(r["severity"], r["label"], r["detail"]) for r in V.reconciled(raw, log, ["k"], "n", ["error"]).collect()}
    assert got == {("FAIL", "counts differ", "b"), ("FAIL", "log without rows", "d"), ("WARN", "failed files", "d")}


# ---------------------------------------------------------------- classification
class Stub:
    def __init__(self):
        self.calls = 0

    def classify(self, text):
        self.calls += 1
        if text == "bad":
            raise OSError("no")
        return '{"job_family": "' + text + '", "confidence": "high"}'


def test_calls_results_and_overrides(spark):
    rows = spark.createDataFrame([("g", "1", "A"), ("g", "2", "bad"), ("g", "3", "odd")], "gazette_id string, vacancy_no string, text string")
    got = {r["vacancy_no"]: r for r in C.called(rows, "text", Stub, ["A", "B"], pauses=(0.0, 0.0)).collect()}
    assert set(got) == {"1", "3"} and got["1"]["job_family"] == "A" and got["3"]["job_family"] is None
    results = spark.createDataFrame([("g", "1", "A"), ("g", "3", None)], "gazette_id string, vacancy_no string, job_family string")
    assert {r["vacancy_no"] for r in C.pending(rows, results).collect()} == {"2", "3"}
    assert {r["vacancy_no"] for r in C.pending(rows, results, results.where("vacancy_no = '3'")).collect()} == {"2"}
    fixed = spark.createDataFrame([("g", "1", "B")], "gazette_id string, vacancy_no string, job_family string")
    assert {(r["vacancy_no"], r["job_family"]) for r in C.overridden(results, fixed).collect()} == {("1", "B"), ("3", None)}
    assert C.reclassified(results, None).count() == 0


def test_jobs_resume_and_time_out():
    saved = []
    jobs = C.submitted({1: "old"}, [1, 2, 3], lambda n: f"job{n}", lambda j: saved.append(dict(j)))
    assert jobs == {1: "old", 2: "job2", 3: "job3"} and len(saved) == 2
    assert C.polled(jobs, lambda j: True, sleep=lambda s: None) and not C.polled(jobs, lambda j: False, 60, 120, sleep=lambda s: None)


def test_unknown_ids_and_errors_are_left_out(spark):
    ids = spark.createDataFrame([("g", "1", "c1"), ("g", "2", "c2")], "gazette_id string, vacancy_no string, custom_id string")
    answers = spark.createDataFrame([("c1", "x", None), ("c2", None, "e"), ("c9", "y", None)], "custom_id string, raw_response string, error string")
    assert [r["vacancy_no"] for r in C.retrieved(answers, ids).collect()] == ["1"]
