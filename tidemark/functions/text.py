"""Column functions for notice fields and free text. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.patterns import unicode_pattern as up

# ---------------------------------------------------------------- fixed values
# Patterns and marks that must be these for results to agree with earlier releases of the data.
EMAIL_MARK, PHONE_MARK, NAME_MARK = "[email redacted]", "[phone redacted]", "[name redacted]"
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
PHONE_SHAPES = (
    r"\+61[\s\-.]?4\d{2}[\s\-.]?\d{3}[\s\-.]?\d{3}",
    r"04\d{2}[\s\-.]?\d{3}[\s\-.]?\d{3}",
    r"\+61[\s\-.]?\d[\s\-.]?\d{4}[\s\-.]?\d{4}",
    r"\(\s*0\d\s*\)[\s\-.]?\d{4}[\s\-.]?\d{4}",
    r"0\d[\s\-.]?\d{4}[\s\-.]?\d{4}",
    r"1[38]00[\s\-.]?\d{3}[\s\-.]?\d{3}",
    r"13[\s\-.]?\d{2}[\s\-.]?\d{2}",
)
CONTACT_PHRASES = ("please contact", "contact officer", "for enquiries")
CONTACT_NAME = r"[A-Za-z]{2,}(?:\s+[A-Za-z]{2,}){1,3}"
DUTIES_START = r"\bDuties\s+The Role\s+|\bDuties\s+|\bAbout [Tt]he [Rr]ole\s+|(?<![a-zA-Z] )The Role\s+"
DUTIES_END = r"\bEligibility\b"
GRADES = ((r"Executive Level (\d)", "EL$1"), (r"APS Level (\d)", "APS$1"), (r"Senior Executive Service Band (\d)", "SES$1"), ("Graduate APS", "Graduate"))
TITLE_PLACE, TITLE_YEAR = r"\s*-\s*[a-z][a-z ,]+(?:,\s*[a-z ]+)?$", r"^\d{4}\s*-\s*"
ACRONYM, NAME_PUNCTUATION = r"\s*\([A-Z][A-Z0-9\-]+\)\s*", r"[',.()\-/&]"
SENTENCE_END = r"(?<=[.!?])\s+(?=[A-Z])"
SECTION_LABELS = r"^(?:(?:Duties(?:\s+The\s+Role)?|Eligibility|Notes)\s+)+"
HEADING = r"^About\s+(?:the|our|us)\b"
HEADING_NOUNS = (
    r"(?:(?:team|role|position|department|division|branch|group|directorate|unit|agency|organisation|organization|section|office|program|programme|"
    r"authority|commission|bureau|area|tribunal|person)s?|opportunit(?:y|ies))"
)
SENTENCE_STARTERS = r"(?:the|this|that|these|those|it|they|we|you|our|your|a|an)"
FUSED_HEADING = (
    rf"^(About\s+(?:the|our|us)\s+(?:[A-Za-z][\w'&-]*\s+){{0,3}}?{HEADING_NOUNS}(?:\s+of\s+(?:(?!{SENTENCE_STARTERS}\b)[A-Za-z][\w'&-]*)"
    rf"(?:\s+(?!{SENTENCE_STARTERS}\b)[A-Za-z][\w'&-]*){{0,4}})?)\s*:?\s+(?=\S)"
)
# ---------------------------------------------------------------- end of fixed values

PHONE = "|".join(PHONE_SHAPES)


def or_null(text: Column) -> Column:
    """Null where a text is empty."""
    return F.nullif(text, F.lit(""))


def squeeze(text: Column) -> Column:
    """White space collapsed to single blanks, ends trimmed."""
    return F.trim(F.regexp_replace(text, up(r"\s+"), " "))


def strip(text: Column) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(text, up(r"\A\s+|\s+\z"), "")


# ---------------------------------------------------------------- amounts, dates, places, grades
def first_amount(text: Column) -> Column:
    """The first dollar amount of two digits or more; decimals are left out."""
    return F.replace(or_null(F.regexp_extract(text, r"\$(\d[\d,]+)", 1)), F.lit(","), F.lit("")).try_cast("double")


def second_amount(text: Column) -> Column:
    """The upper end of ``$a - $b`` (hyphen or en dash, a sign on both ends)."""
    found = or_null(F.regexp_extract(text, "\\$\\d[\\d,]+\\s*[-–]\\s*\\$(\\d[\\d,]+)", 1))
    return F.replace(found, F.lit(","), F.lit("")).try_cast("double")


def first_date(text: Column) -> Column:
    """The first ``d month yyyy`` as a date; null where that one is no real date."""
    return F.try_to_date(or_null(F.regexp_extract(text, r"(\d{1,2}\s+[A-Za-z]+\s+\d{4})", 1)), "d MMMM yyyy")


def sorted_parts(text: Column, separator: str = ",") -> Column:
    """The parts of a list in code-point order, trimmed and joined by comma and blank; blanks and
    repetitions stay."""
    parts = F.transform(F.split(text, separator), lambda x: F.trim(x))
    return F.array_join(F.array_sort(parts), ", ")


def section(text: Column, start: str, end: str) -> Column:
    """The stretch after the first match of ``start`` up to the next of ``end`` or the end of the text."""
    return or_null(F.trim(F.regexp_extract(text, up(rf"(?:{start})(.*?)(?:{end}|\z)", dot_all=True), 1)))


def duties_section(text: Column) -> Column:
    """The duties of a description, without their heading."""
    return section(text, DUTIES_START, DUTIES_END)


def short_grade(text: Column) -> Column:
    """Long names of grades as codes, in place."""
    for long, short in GRADES:
        text = F.regexp_replace(text, long, short)
    return or_null(F.trim(text))


# ---------------------------------------------------------------- keys and titles
def plain_key(text: Column) -> Column:
    """Lower case, everything but word characters and blanks a blank, collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), up(r"[^\w\s]"), " "), up(r"\s+"), " "))


def name_key(text: Column) -> Column:
    """Key of a body's name: straight quotes, no acronym in brackets, lower case, no punctuation."""
    text = F.regexp_replace(text, "[‘’]", "'")
    text = F.regexp_replace(text, ACRONYM, " ")
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), NAME_PUNCTUATION, " "), up(r"\s+"), " "))


def title_key(title: Column) -> Column:
    """Key of a title without a place at its end and a year at its start; null gives the empty text."""
    text = F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), TITLE_PLACE, "")
    return plain_key(F.regexp_replace(text, TITLE_YEAR, ""))


def without_phrase(title: Column, phrase: str, target: str) -> Column:
    """A title without a bracketed phrase, one set off by a dash with its target group, or a bare one."""
    for pattern in (rf"\s*\([^)]*{phrase}[^)]*\)", rf"\s*[-–—:,]?\s*{phrase}s?(?:\s*[-–—:]?\s*{target})?", rf"\s*{phrase}s?"):
        title = F.regexp_replace(title, up(pattern, ignore_case=True), " ")
    return plain_key(title)


def group_id(*parts: Column, length: int = 12) -> Column:
    """Hash of the parts joined by the unit separator, nulls as empty texts; the first hex digits."""
    return F.substring(F.sha1(F.concat_ws(chr(31), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, length)


def safe_id(*parts: Column, length: int = 64) -> Column:
    """Parts joined by underscores, odd characters replaced, cut to length; different parts may collide."""
    return F.substring(F.regexp_replace(F.trim(F.concat_ws("_", *parts)), "[^A-Za-z0-9_-]", "_"), 1, length)


def prompt_text(labels: dict[str, Column], skip: dict[str, list[str]], body: Column, most: int = 3000, missing: str | None = None) -> Column:
    """Labelled lines for a classifier and the start of a body; listed values of a field are left out. A null
    field drops its line, or is printed as ``missing`` where that is given and the field has no list."""
    lines = []
    for label, value in labels.items():
        line = F.concat(F.lit(f"{label}: "), value if missing is None or label in skip else F.coalesce(value, F.lit(missing)))
        lines.append(F.when(~F.lower(F.trim(value)).isin(skip[label]), line) if label in skip else line)
    return F.concat_ws("\n", *lines, F.substring(body, 1, most))


def last_valid_object(text: Column, schema: str, field: str, allowed: list[str]) -> Column:
    """The JSON object of an answer: fences off, the whole text is tried first, then each flat object in it.
    The last one whose ``field`` is allowed wins, else the first that parses (null for null and for none)."""
    bare = F.regexp_replace(F.regexp_replace(strip(text), up(r"\A```(?:json)?\s*"), ""), up(r"\s*```\z"), "")
    tried = F.concat(F.array(bare), F.regexp_extract_all(bare, F.lit(r"(\{[^{}]+\})"), F.lit(1)))
    # from_json is lenient at the ends, so only what is one object from end to end is parsed
    whole = F.filter(tried, lambda x: x.rlike(up(r"\A\s*\{.*\}\s*\z", dot_all=True)) & F.try_parse_json(x).isNotNull())
    parsed = F.filter(F.transform(whole, lambda x: F.from_json(x, schema)), lambda x: x.isNotNull())
    good = F.filter(parsed, lambda x: x[field].isin(allowed))
    return F.coalesce(F.try_element_at(good, F.lit(-1)), F.try_element_at(parsed, F.lit(1)))


# ---------------------------------------------------------------- redaction
def redact_contacts(text: Column, prefixes: tuple[str, ...] = CONTACT_PHRASES) -> Column:
    """E-mail addresses, telephone numbers and names after contact phrases replaced; doing it twice
    changes nothing more.

    A name is two to four words after a phrase, as many as there are, taken as a whole; it stays where one
    of the words does not begin with a capital. Three replacements: candidates are marked, marks round
    capitalised words are turned into the placeholder, left-over marks go.
    """
    text = F.regexp_replace(text, EMAIL, EMAIL_MARK)
    text = F.regexp_replace(text, PHONE, PHONE_MARK)
    lead = "|".join(p.replace(" ", r"\s+") for p in prefixes)
    spot = up(rf"((?:{lead})[\s:,–-]*)(?!officer\b)({CONTACT_NAME})", ignore_case=True)
    text = F.regexp_replace(text, spot, "$1\u0001$2\u0002")
    text = F.regexp_replace(text, up("\u0001[A-Z]\\w*+(?:\\s+[A-Z]\\w*+)*\u0002"), NAME_MARK)
    return F.regexp_replace(text, "[\u0001\u0002]", "")


# ---------------------------------------------------------------- sentences


def sentences(text: Column) -> Column:
    """A text as an array of sentences: lines, cut after an ending before a capital; a heading fused to
    its first sentence is cut off and dropped, section labels are removed, headings alone go.

    Null gives null, a text of headings only an empty array.
    """
    text = F.regexp_replace(text, "\r\n?", "\n")
    # a heading is parted from what follows by the same mark that parts sentences
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: strip(x)), lambda x: x != "")
    parts = F.flatten(F.transform(lines, lambda x: F.split(x, up(SENTENCE_END))))
    units = F.flatten(F.transform(parts, lambda x: F.split(F.regexp_replace(strip(x), up(FUSED_HEADING, ignore_case=True), "$1\u001e"), "\u001e")))
    kept = F.filter(units, lambda x: ~strip(x).rlike(up(HEADING, ignore_case=True)))
    return F.filter(F.transform(kept, lambda x: strip(F.regexp_replace(strip(x), up(SECTION_LABELS, ignore_case=True), ""))), lambda x: x != "")


def simple_sentences(text: Column) -> Column:
    """Sentences by a rule that other engines share: lines, cut where an ending, white space and a
    capital follow one another."""
    marked = F.regexp_replace(text, r"([.!?])\s+([A-Z])", "$1\u001e$2")
    return F.filter(F.transform(F.split(marked, "[\u001e\n]"), lambda x: strip(x)), lambda x: x != "")
