import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators.classify import answer_fields
from tidemark.operators.linkage import bare_word, copies_of, kind_of, linked
from tidemark.operators.shaping import guarded_date, guarded_range, not_equal, ordered, placed_after, remapped, unless, with_default


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("raw", "low", "high"), [
    ("$95,000 - $110,000", 95000, 110000), ("$58,542 - $6,411,616", 58542, None), ("$101,322 - $110", 101322, None), ("$90 - $101,031", None, 101031),
    ("$1 - $100", None, None), (None, None, None), ("", None, None), ("no pay", None, None),
])
def test_range_guards(spark, raw, low, high):
    df = spark.createDataFrame([(raw,)], "salary string").withColumns({"low": T.first_amount(F.col("salary")), "high": T.second_amount(F.col("salary"))})
    row = guarded_range(df, "low", "high", "salary").first()
    if raw == "$1 - $100":
        assert row["low"] is None
    else:
        assert (row["low"], row["high"]) == (low, high)


@pytest.mark.parametrize(("raw", "want"), [("Friday 23 May 2025", dt.date(2025, 5, 23)), ("23 May 2025 11:59pm AEST", dt.date(2025, 5, 23)), ("23 Foo 2025", None), (None, None), ("31 February 2025", None)])
def test_first_date(spark, raw, want):
    assert one(spark, T.first_date, raw) == want


def test_date_guard_keeps_365_days(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1), dt.date(2023, 1, 1)), (dt.date(2021, 12, 31), dt.date(2023, 1, 1)), (None, dt.date(2023, 1, 1)), (dt.date(2021, 1, 1), None)], "c date, g date")
    assert [r["c"] for r in guarded_date(df, "c", "g").collect()] == [dt.date(2022, 1, 1), None, None, dt.date(2021, 1, 1)]


@pytest.mark.parametrize(("raw", "want"), [("B, A", "A, B"), (None, None), ("a,,b", ", a, b"), ("b,b,A", "A, b, b")])
def test_sorted_parts(spark, raw, want):
    assert one(spark, T.sorted_parts, raw) == want


def test_short_grade(spark):
    assert one(spark, T.short_grade, "APS Level 5;APS Level 6") == "APS5;APS6" and one(spark, T.short_grade, " ") is None


@pytest.mark.parametrize(("raw", "want"), [
    ("Duties The Role do it Eligibility x", "do it"), ("x About the Role do it Eligibility", "do it"), ("months The Role no", None), ("Duties only", "only"), (None, None), ("Duties  Eligibility", None),
])
def test_duties(spark, raw, want):
    assert one(spark, T.duties_section, raw) == want


def test_unicode_keys(spark):
    assert one(spark, T.plain_key, "Café – ÉLAN, 2!") == "café élan 2"
    assert one(spark, T.name_key, "Children’s  Office (ABC) & Co.") == "children's office co".replace("'", " ")


def test_redaction_examples(spark):
    assert one(spark, T.redact_contacts, "Please contact Jane Smith (02)") == f"Please contact {T.NAME_MARK} (02)"
    assert one(spark, T.redact_contacts, "Please contact Jane Smith on 02") == "Please contact Jane Smith on 02"
    assert one(spark, T.redact_contacts, "mail a.b@c.example or 0412 345 678") == f"mail {T.EMAIL_MARK} or {T.PHONE_MARK}"


def test_redaction_twice_changes_nothing(spark):
    rng = random.Random(2)
    words = ["please contact", "Contact Officer", "Jane", "SMITH", "de", "for enquiries", "a@b.example", "0412 345 678", "(02)", ",", ":", "on", "officer", "\n", "É"]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(12))),) for _ in range(400)] + [(None,), ("",)]
    df = spark.createDataFrame(rows, "x string").select(T.redact_contacts(F.col("x")).alias("y"))
    assert df.where(~T.redact_contacts(F.col("y")).eqNullSafe(F.col("y"))).count() == 0


def test_sentences(spark):
    got = one(spark, T.sentences, "About the Role We have a number of roles. It is good! About the Antarctic Division\nDuties The Role do this\r\n\n  Notes\nx")
    assert got == ["We have a number of roles.", "It is good!", "do this", "Notes", "x"] or got == ["We have a number of roles.", "It is good!", "do this", "x"]
    assert one(spark, T.sentences, "About the Australian Antarctic Division") == [] and one(spark, T.sentences, None) is None


def test_last_valid_object(spark):
    f = lambda x: T.last_valid_object(x, "job_family string", "job_family", ["A", "B"])["job_family"]
    assert one(spark, f, '```json\n{"job_family": "X"}\n{"job_family": "B"}```') == "B"
    assert one(spark, f, '{"job_family": "X"} {"job_family": "Y"}') == "X" and one(spark, f, "none") is None and one(spark, f, None) is None


def test_answers(spark):
    cases = [
        ('{"job_family": "A", "confidence": "high", "secondary_family": "B"}', ("A", "high", "B")), ('{"job_family": "A", "why": {"x": [1, "}"]}, "secondary_family": "B"}', ("A", None, "B")), ("```\n{\"job_family\": \"B\"}\n```", ("B", None, None)),
        ('x {"job_family": "Z", "confidence": "low"} y {"job_family": ""}', (None, "low", None)), ('{"job_family": "A"} then {"job_family": "B", "secondary_family": ""}', ("B", None, None)), ("[1]", (None, None, None)), ("", (None, None, None)), (None, (None, None, None)),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r["i"]: tuple(r)[1:] for r in df.select("i", *answer_fields(F.col("t"), ["A", "B"])).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_prompt_text_prints_what_is_missing(spark):
    df = spark.createDataFrame([(None, None, "b")], "a string, c string, t string")
    text = T.prompt_text({"A": F.col("a"), "C": F.col("c")}, {"C": ["x"]}, F.col("t"), missing="nan")
    assert df.select(text).first()[0] == "A: nan\nb"


def test_ids(spark):
    assert one(spark, lambda x: T.safe_id(F.lit("PS1"), x), "VN-1") == "PS1_VN-1" and len(one(spark, lambda x: T.safe_id(x), "é" * 99)) == 64
    assert one(spark, lambda x: T.group_id(x, F.lit("a")), None) == one(spark, lambda x: T.group_id(F.lit(""), F.lit("a")), None)


def test_linked(spark):
    rows = [(1, "X (Affirmative Measures - Disability)", "k"), (2, "X - Affirmative Measures Indigenous", "k"), (3, "X", "k"), (4, "X", "other"), (5, None, "k"), (6, "Y", "k")]
    got = {r["id"]: r for r in linked(spark.createDataFrame(rows, "id int, title string, key string"), "title", ["key"]).collect()}
    assert got[1]["group_id"] == got[2]["group_id"] == got[3]["group_id"] is not None
    assert got[4]["group_id"] is None and got[5]["group_id"] is None and got[6]["group_id"] is None and not got[5]["is_special"]


@pytest.mark.parametrize(("title", "other", "want"), [
    ("2 x Anthropologists", None, "bulk_round"), ("X3 (x2)", None, "bulk_round"), ("Passport Bulk Print", None, None), ("Temporary Employment Register", None, "register"),
    ("Apprentice Turf Manager", "Apprentice APS (Trades)", "entry_program"), ("Apprentice Manager", None, None), (None, None, None),
])
def test_kinds(spark, title, other, want):
    df = spark.createDataFrame([(title, other)], "t string, o string")
    assert df.select(kind_of(F.col("t"), F.col("o")).alias("k")).first()["k"] == want


def test_bare_word(spark):
    noise = ((r"\([^)]*\)", False), (r"\b(?:aps|el)\s*\d\b", True), (r"\b[A-Z]{2,6}\b", False))
    assert one(spark, lambda x: bare_word(x, "graduate", noise), "NDIA APS4 Graduate (AM - First Nations)") is True
    assert one(spark, lambda x: bare_word(x, "graduate", noise), "Graduate Manager") is False and one(spark, lambda x: bare_word(x, "graduate", noise), None) is False


def test_copies(spark):
    rows = [(1, "a"), (2, "a"), (3, None), (4, None)]
    got = {r["id"]: (r["n_copies"], r["is_first"]) for r in copies_of(spark.createDataFrame(rows, "id int, k string"), "k", "id").collect()}
    assert got == {1: (2, True), 2: (2, False), 3: (1, True), 4: (1, True)}


def test_shaping(spark):
    df = spark.createDataFrame([("a", None, 1)], "x string, y string, z int")
    assert ordered(df, ["z", "nope", "x"]).columns == ["z", "x", "y"] and placed_after(df, "x", "z").columns == ["x", "z", "y"] and placed_after(df, "none", "x").columns == ["y", "z", "x"]
    assert df.select(remapped(F.col("y"), {"a": "b"})).first()[0] is None and df.select(remapped(F.col("x"), {"a": "b"})).first()[0] == "b"
    assert with_default(df, "y", F.lit("d")).first()["y"] == "d" and df.where(not_equal(F.col("y"), "a")).count() == 1 and unless(df, "x", F.col("y") == "q").first()["x"] == "a"


def test_pattern_shapes_have_no_boundaries():
    assert re.search(T.PHONE, "90412345678")


def plain_redaction(text):
    """The rule for contact names, word by word."""
    text = re.sub(T.EMAIL, T.EMAIL_MARK, text)
    text = re.sub(T.PHONE, T.PHONE_MARK, text)
    out, at = [], 0
    lead = re.compile(r"(?:please\s+contact|contact\s+officer|for\s+enquiries)[\s:,–-]*", re.I)
    while m := lead.search(text, at):
        words, end = [], m.end()
        if not re.match(r"officer\b", text[end:], re.I):
            while len(words) < 4 and (w := re.compile(r"[A-Za-z]{2,}" if not words else r"\s+[A-Za-z]{2,}").match(text, end)):
                words.append(w[0].strip())
                end = w.end()
        if len(words) < 2:
            out.append(text[at : m.start() + 1])
            at = m.start() + 1
            continue
        out.append(text[at : m.end()])
        out.append(T.NAME_MARK if all(w[0].isupper() for w in words) else text[m.end() : end])
        at = end
    return "".join(out) + text[at:]


def test_redaction_against_the_plain_rule(spark):
    rng = random.Random(7)
    words = ["please contact", "Contact Officer", "For Enquiries", "Jane", "SMITH", "de", "van", "Lee", "a@b.example", "0412 345 678", "(02)", ",", ":", "-", "on", "officer", "\n", "x"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(14)))) for i in range(3000)]
    got = {r["i"]: r["y"] for r in spark.createDataFrame(rows, "i int, x string").select("i", T.redact_contacts(F.col("x")).alias("y")).collect()}
    assert all(got[i] == plain_redaction(x) for i, x in rows), next((x, got[i], plain_redaction(x)) for i, x in rows if got[i] != plain_redaction(x))


def test_sentences_keep_every_word_but_headings(spark):
    rng = random.Random(8)
    words = ["Work", "is", "good.", "Yes!", "Really?", "we", "The", "notes", "e.g.", "\n", "\n\n", "Team"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(25)))) for i in range(1000)]
    got = {r["i"]: r["s"] for r in spark.createDataFrame(rows, "i int, x string").select("i", T.sentences(F.col("x")).alias("s")).collect()}
    for i, x in rows:
        want = [p.strip() for line in x.split("\n") for p in re.split(r"(?<=[.!?])\s+(?=[A-Z])", line.strip()) if p.strip()]
        want = [re.sub(r"^(?:(?:Notes)\s+)+", "", p, flags=re.I) for p in want]
        assert got[i] == [p for p in want if p], x
