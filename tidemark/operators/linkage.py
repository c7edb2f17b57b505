"""Links between postings of one role, and kinds of posting by title rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.patterns import unicode_pattern as up
from tidemark.functions.text import group_id, without_phrase

#: The phrase that marks a special round of a role, and who it may be for.
SPECIAL, TARGET = r"affirmative\s+measure", r"(?:indigenous|first\s+nations|aboriginal|disability)(?:\s+\w+)?"


def is_special(title: Column, phrase: str = SPECIAL) -> Column:
    """Whether a title names a special round; null titles do not."""
    return F.coalesce(title.rlike(up(phrase, ignore_case=True)), F.lit(False))


def linked(rows: DataFrame, title: str, keys: list[str], phrase: str = SPECIAL, target: str = TARGET) -> DataFrame:
    """``rows`` with ``is_special`` and ``group_id``: a hash of the keys and the title without the phrase,
    for all rows that share it with at least one special row; null for others and for null titles.

    The special flag is aggregated before it is joined back, so that a key many rows share costs little.
    """
    flagged = rows.withColumns({"is_special": is_special(F.col(title), phrase), "_id": F.when(F.col(title).isNotNull(), group_id(*[F.col(k) for k in keys], without_phrase(F.col(title), phrase, target)))})
    groups = flagged.where("is_special").select("_id").distinct().withColumn("_linked", F.lit(True))
    out = flagged.join(groups, "_id", "left")
    return out.withColumn("group_id", F.when(F.col("_linked"), F.col("_id"))).drop("_id", "_linked")


@dataclass(frozen=True)
class Kind:
    """One kind of posting: it applies where ``include`` matches and ``exclude`` does not, or where the
    other column matches ``always``."""

    name: str
    include: str
    exclude: str | None = None
    always: str | None = None


#: A small general rule set; callers give their own.
KINDS = (
    Kind("register", r"\bregisters?\b|talent\s+(?:pool|pipeline)s?\b|\beoi\b|expressions?\s+of\s+interest", r"register\s+of\s|business\s+register"),
    Kind("entry_program", r"\b(?:apprentice|cadet|trainee|intern)(?:ship)?s?\b|\bgraduates?\b.*\b(?:program(?:me)?|intake|pathway|stream)s?\b", r"\b(?:manager|coordinator|mentor|director)s?\b", r"graduate|cadet|trainee|apprentice"),
    Kind("bulk_round", r"\bbulk\s+(?:round|recruitment|intake)\b|\b(?:multiple|several|various)\s+(?:positions?|vacancies|roles?)\b|\b\d+\s*x\s+\w|\bx\s*\d+\b", r"bulk\s+(?:print|material|billing|cargo|fuel)"),
)


def kind_of(title: Column, other: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """The first kind that applies, null where none does; null texts match nothing."""
    def hit(text: Column, pattern: str | None) -> Column:
        return F.coalesce(text.rlike(up(pattern, ignore_case=True)), F.lit(False)) if pattern else F.lit(False)

    out = None
    for k in kinds:
        condition = hit(other, k.always) | (hit(title, k.include) & ~hit(title, k.exclude))
        out = F.when(condition, k.name) if out is None else out.when(condition, k.name)
    return out


def bare_word(title: Column, word: str, noise: tuple[tuple[str, bool], ...]) -> Column:
    """Whether a title is only ``word`` once decorations are taken off, in order; ``noise`` says for each
    pattern whether case is ignored."""
    text = title
    for pattern, ignore in noise:
        text = F.regexp_replace(text, up(pattern, ignore_case=ignore), " ")
    text = F.lower(F.trim(F.regexp_replace(text, "[^A-Za-z]+", " ")))
    return F.coalesce(text.isin(word, f"{word}s"), F.lit(False))


def copies_of(rows: DataFrame, key: str, order: str) -> DataFrame:
    """``rows`` with ``n_copies`` of the key and whether a row is the first of them; null keys stand alone."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_copies"), F.min(order).alias("_first"))
    out = rows.join(counts, key, "left").withColumn("n_copies", F.coalesce("n_copies", F.lit(1)))
    return out.withColumn("is_first", F.col("_first").isNull() | (F.col(order) == F.col("_first"))).drop("_first")


def previous_in(rows: DataFrame, keys: list[str], order: str, value: str, into: str) -> DataFrame:
    """``rows`` with the value of the row before it; keys are documents or the like, bounded in rows."""
    return rows.withColumn(into, F.lag(value).over(Window.partitionBy(*keys).orderBy(order)))
