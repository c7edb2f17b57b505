"""Gazette text to rows: page headers off, labels mended, notices split, fields extracted and guarded.

Everything is column expressions over one row per document, then one row per notice.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.patterns import unicode_pattern as up
from tidemark.functions.text import or_null

# ---------------------------------------------------------------- fixed values
# Labels, endings and shapes of the printed gazette, as they must be for its text to be read.
LABELS = (
    "Job Title", "Job Type", "Location", "Salary", "Future Merit\nLocations", "Office Arrangement", "Office Arrangement\nDetails",
    "Classification", "Position Number", "Agency Website", "Job Description",
)
ENDINGS = ("\nTo Apply\n", "\nPosition Contact\n", "\nAgency Recruitment Site\n", "\nThis notice is part")
FOOTER = "applicants found suitable may be offered similar employment opportunities by other Australian Public Service agencies"
LINK = r"(?:https?://|www\.|\S+@\S+\.\S+)\S*"
ANY_LINK = r"^(?:https?://|www\.|\S+@\S+\.\S+|[a-zA-Z0-9][\w.-]*\.[a-z]{2,}/)\S*\n"
MASTHEAD = r"Australian Public Service Gazette[\n ]PS\d+ [^\n]+\n"
PAGE = r"Page \d+ of \d+\n"
ORPHAN = r"^\d{4}\.pdf\n"
WRAPPED = ("Job Title", "Job Description", "Office Arrangement", "Position Number", "Agency Website")
KINDS_OF_JOB = r"\b(?:ongoing|non.?ongoing|irregular|intermittent)\b"
GRADE_START = r"^(?:APS|EL|SES)\s*\d|^Executive Level|^Senior Executive Service"
# ---------------------------------------------------------------- end of fixed values


def without_page_furniture(text: Column) -> Column:
    """Page headers and footers taken out; the order matters, as one uncovers the next."""
    for pattern, by in (
        (rf"\f{MASTHEAD}", ""), (rf"^\n{PAGE}", "\n"), (rf"^{PAGE}", ""), (r"\f", ""), (ORPHAN, ""), (rf"^{MASTHEAD}", ""),
    ):
        text = F.regexp_replace(text, up(pattern, many_lines=True), by)
    return text


def mended_labels(text: Column) -> Column:
    """Labels that wrapped over lines joined again, also round a link."""
    text = F.regexp_replace(text, up(r"\bJob\n(https?://\S+)\nDescription\n"), "Job Description\n\n$1\n\n")
    for label in WRAPPED:
        text = F.regexp_replace(text, up(r"\b" + label.replace(" ", r"\n") + r"\b"), label)
    text = F.regexp_replace(text, up(r"\bFuture\nMerit\nLocations\b"), "Future Merit\nLocations")
    return F.regexp_replace(text, up(r"\bOffice\nArrangement Details\b|\bOffice Arrangement\nDetails\b"), "Office Arrangement\nDetails")


def split_notices(docs: DataFrame, row: str, text: str) -> DataFrame:
    """One row per notice: ``(row, pos, notice)``.

    A notice begins at a line ``Vacancy VN-``. Where it has no body's name before its closing date, the
    lines after the standard footer of the block before it are its header.
    """
    parts = docs.select(row, F.posexplode(F.split(F.col(text), r"(?m)(?=^Vacancy VN-)", -1)).alias("pos", "part"))
    parts = parts.withColumn("before", F.lag("part").over(Window.partitionBy(row).orderBy("pos"))).where(F.trim("part").startswith("Vacancy VN-"))
    head = F.regexp_extract("part", up(r"\A\s*Vacancy VN-[^\n]*\n(.*?)^Closing Date:", many_lines=True, dot_all=True), 1)
    own = F.exists(F.split(head, "\n"), lambda x: (F.trim(x) != "") & ~F.trim(x).startswith("http"))
    tail = F.when(F.instr("before", FOOTER) > 0, F.trim(F.substring_index("before", FOOTER, -1), F.lit(" \n\t")))
    tail = or_null(F.trim(F.regexp_replace(tail, up(ORPHAN, many_lines=True), ""), F.lit(" \n\t")))
    graft = F.regexp_replace("part", up(r"\A(\s*Vacancy VN-[^\n]*\n)"), "$1\u0001")
    graft = F.replace(graft, F.lit("\u0001"), F.concat(F.coalesce(tail, F.lit("")), F.lit("\n")))
    return parts.select(row, "pos", F.when(F.coalesce(own, F.lit(False)) | tail.isNull(), F.col("part")).otherwise(graft).alias("notice"))


def labelled(text: Column, label: str) -> Column:
    """The value under a label, up to the next label, the footer or the end; lines joined by blanks."""
    others = "|".join(re.escape(x) for x in LABELS)
    pattern = rf"^{re.escape(label)}\n\n(.*?)(?=\n\n(?:{others})\n|\nThis notice is part|\nClosing Date:|\z)"
    value = F.trim(F.regexp_extract(text, up(pattern, many_lines=True, dot_all=True), 1), F.lit(" \n\t"))
    return or_null(F.trim(F.replace(value, F.lit("\n"), F.lit(" "))))


def described(text: Column) -> Column:
    """The description: what follows its label, and the first link if any, up to an ending; collapsed."""
    after = F.regexp_extract(text, up(r"^Job Description\n(.*)\z", many_lines=True, dot_all=True), 1)
    linked = F.regexp_extract(after, up(rf"{ANY_LINK}(.*)\z", many_lines=True, dot_all=True), 1)
    body = F.ltrim(F.when(after.rlike(up(ANY_LINK, many_lines=True)), linked).otherwise(after), F.lit("\n"))
    for ending in ENDINGS:
        body = F.substring_index(body, ending, 1)
    return or_null(F.trim(F.regexp_replace(body, up(r"\s+"), " ")))


def _header(text: Column) -> Column:
    at = F.instr(text, "\nJob Title\n")
    block = F.when(at > 1, F.substring_index(text, "\nJob Title\n", 1)).otherwise(F.substring(text, 1, 500))
    for pattern in (r"\AVacancy VN-\d+\n", r"^Closing Date:.*\n", rf"^{LINK}\n"):
        block = F.regexp_replace(block, up(pattern, many_lines=True), "")
    return block


def parse_notices(notices: DataFrame) -> DataFrame:
    """Fields of ``notice``: the 14 labelled and header fields, the number and the raw closing date."""
    n = notices.withColumn("notice", F.ltrim(F.col("notice"), F.lit(" \n\t")))
    segments = F.filter(F.split(_header(F.col("notice")), r"\n\s*\n"), lambda s: F.trim(s, F.lit(" \n\t")) != "")
    n = n.withColumn("_segments", F.transform(segments, lambda s: F.filter(F.transform(F.split(s, "\n"), lambda x: F.trim(x)), lambda x: x != "")))
    single = F.size("_segments") == 1
    names = F.when(single, F.col("_segments")[0]).otherwise(F.transform("_segments", lambda s: F.array_join(s, " ")))
    n = n.withColumn("_names", names)
    footer = F.regexp_extract("notice", up(FOOTER + r"\n\n(.+?)(?:\n\n|\z)", dot_all=True), 1)
    n = n.withColumn("_footer", F.filter(F.transform(F.split(footer, "\n"), lambda x: F.trim(x)), lambda x: x != ""))
    part = lambda i: F.try_element_at("_names", F.lit(i))
    n = n.withColumns({"agency": part(1), "division": part(2), "branch": part(3)})
    # a division that repeats the body, or only closes its portfolio, gives way to the branch
    shift = (F.col("agency") == F.col("division")) | F.col("division").rlike(r"Portfolio\)$")
    shift = F.coalesce(shift, F.lit(False))
    n = n.withColumns({"division": F.when(shift, F.col("branch")).otherwise(F.col("division")), "branch": F.when(~shift, F.col("branch"))})
    none = F.col("agency").isNull()
    n = n.withColumns({
        "agency": F.coalesce("agency", F.try_element_at("_footer", F.lit(1))),
        "division": F.when(none, F.try_element_at("_footer", F.lit(2))).otherwise(F.col("division")), "branch": F.when(~none, F.col("branch")),
    })
    text = F.regexp_replace("notice", up(r"\nThis notice is part of the electronic.*\z", dot_all=True), "")
    text = F.regexp_replace(text, up(r"(https?://\S+)([ \t]{2,})(Job Description\n)"), "$1\n\n$3")
    text = F.regexp_replace(text, up(r"^(Job Description)([ \t]+)(https?://\S+\n)", many_lines=True), "$1\n\n$3")
    n = n.withColumn("_text", F.trim(text, F.lit(" \n\t")))
    fields = {x.replace("\n", " ").replace(" ", "_").lower(): labelled(F.col("_text"), x) for x in LABELS if not x.startswith(("Future", "Job Description"))}
    n = n.withColumns({
        "vacancy_no": or_null(F.regexp_extract("notice", r"\AVacancy (VN-\d+)", 1)),
        "closing_date_raw": or_null(F.trim(F.regexp_extract("notice", r"(?m)^Closing Date:(.*)$", 1))), "description": described(F.col("_text")), **fields,
    })
    return guarded(n.drop("_segments", "_names", "_footer", "_text", "notice"))


def guarded(rows: DataFrame) -> DataFrame:
    """Null fields that hold a label, a number in place of a grade, another field's text and the like."""
    flat = [x.replace("\n", " ") for x in LABELS]
    bleed = "^(?:" + "|".join(re.escape(x) for x in flat) + ")  "
    c = F.col
    bad = {
        "location": c("location").rlike(bleed),
        "classification": c("classification").isin(flat) | c("classification").rlike(r"^\d+$") | c("classification").rlike(bleed),
        "position_number": c("position_number").isin(flat) | c("position_number").rlike(bleed) | c("position_number").rlike("^https?://"),
        "office_arrangement": c("office_arrangement").isin(flat) | c("office_arrangement").rlike(bleed) | c("office_arrangement").rlike(GRADE_START),
        "office_arrangement_details": c("office_arrangement_details").isin(flat) | c("office_arrangement_details").rlike(bleed),
        "agency_website": c("agency_website").isin(flat) | c("agency_website").rlike(bleed) | ~c("agency_website").rlike("^https?://"),
        "job_type": ~c("job_type").rlike(up(KINDS_OF_JOB, ignore_case=True)),
    }
    return rows.withColumns({name: F.when(~condition, c(name)) for name, condition in bad.items()})


def marker_count(text: Column) -> Column:
    """How many notices a text announces, to be held against the rows parsed."""
    return F.regexp_count(text, F.lit(r"(?m)^Vacancy VN-")).cast("bigint")


def parse_gazette(docs: DataFrame, row: str, text: str) -> DataFrame:
    """All of it: documents to guarded notice rows with ``row`` and ``pos``. A null or empty text gives none."""
    clean = docs.withColumn("_clean", mended_labels(without_page_furniture(F.col(text))))
    return parse_notices(split_notices(clean, row, "_clean"))
