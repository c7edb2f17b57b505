"""Sentences repeated across the notices of one body, or of all, in a quarter.

Sentences are split once and counted by (body, quarter, sentence) and, summed from that, by (quarter,
sentence). The best quarter of a sentence is the one with the highest share
of notices, the earliest of equal ones; a sentence is flagged there if enough different titles use it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import plain_key, sentences, title_key
from tidemark.operators.relational import small_side
from tidemark.session import cut

#: Name under which sentences of the whole corpus are listed.
EVERYONE = "__GLOBAL__"


@dataclass(frozen=True)
class Thresholds:
    """Least share of a quarter's notices, least notices of a quarter, least different titles."""

    share: float = 0.30
    least_ads: int = 10
    least_titles: int = 3
    global_share: float = 0.40
    global_ads: int = 500
    global_titles: int = 30

    def __post_init__(self) -> None:
        if not (0 < self.share <= 1 and 0 < self.global_share <= 1):
            raise ValueError("shares lie above 0 and up to 1")
        if min(self.least_ads, self.least_titles, self.global_ads, self.global_titles) < 1:
            raise ValueError("counts are 1 at least")


def quarter_of(date: Column) -> Column:
    """Calendar quarter, as 2025Q3."""
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def sentence_rows(notices: DataFrame, row: str, body: str, ad: str, title: str, date: str, text: str, split=sentences) -> DataFrame:  # noqa: ANN001
    """One row for each sentence of each notice: ``(row_id, body, ad, title, quarter, pos, sentence, key)``."""
    base = notices.where(F.col(text).isNotNull()).select(
        F.col(row).alias("row_id"), F.col(body).alias("body"), F.coalesce(F.col(ad).cast("string"), F.lit("")).alias("ad"),
        title_key(F.col(title)).alias("title"), quarter_of(F.col(date)).alias("quarter"), F.posexplode(split(F.col(text))).alias("pos", "sentence"),
    )
    return base.withColumn("key", plain_key(F.col("sentence"))).where("key <> ''")


def bin_sizes(notices: DataFrame, body: str, date: str, text: str) -> DataFrame:
    """``(body, quarter, bin_size)``: notices with a text; EVERYONE for the whole corpus. Notices without a
    body count for the whole corpus only."""
    sizes = notices.where(F.col(text).isNotNull() & F.col(date).isNotNull()).groupBy(F.col(body).alias("body"), quarter_of(F.col(date)).alias("quarter")).agg(F.count(F.lit(1)).alias("bin_size"))
    every = sizes.groupBy("quarter").agg(F.sum("bin_size").alias("bin_size")).select(F.lit(EVERYONE).alias("body"), "quarter", "bin_size")
    return sizes.where("body is not null").unionByName(every)


def frequencies(rows: DataFrame, notices: DataFrame, body: str, date: str, text: str, limits: Thresholds) -> DataFrame:
    """``(body, quarter, key, n_ads, n_titles, bin_size)`` of all sentences that may reach their threshold.

    Mentions are counted first, for bodies and, summed from those, for the corpus. A sentence has at least
    as many mentions as notices, so those with too few mentions need no distinct count; what is left is a
    small part of all sentences, and only its rows are counted by distinct notice and title.
    """
    dated = rows.where("quarter is not null")
    mentions = dated.groupBy("body", "quarter", "key").agg(F.count(F.lit(1)).alias("n"))
    every = mentions.groupBy("quarter", "key").agg(F.sum("n").alias("n")).select(F.lit(EVERYONE).alias("body"), "quarter", "key", "n")
    sizes = small_side(cut(bin_sizes(notices, body, date, text)))
    global_ = F.col("body") == EVERYONE
    enough = F.col("bin_size") >= F.when(global_, limits.global_ads).otherwise(limits.least_ads)
    often = F.col("n") >= F.col("bin_size") * F.when(global_, limits.global_share).otherwise(limits.share)
    may = cut(mentions.where("body is not null").unionByName(every).join(sizes, ["body", "quarter"]).where(enough & often).drop("n"))
    exact = [F.count_distinct("ad").alias("n_ads"), F.count_distinct("title").alias("n_titles")]
    own = dated.join(small_side(may.where(~global_)), ["body", "quarter", "key"]).groupBy("body", "quarter", "key", "bin_size").agg(*exact)
    whole = dated.drop("body").join(small_side(may.where(global_)), ["quarter", "key"]).groupBy("body", "quarter", "key", "bin_size").agg(*exact)
    return own.unionByName(whole)


def audit(counts: DataFrame, rows: DataFrame, limits: Thresholds, protected: str | None = None) -> DataFrame:
    """Every sentence over the frequency threshold in its best quarter, with ``flagged`` and
    ``protected``, and the wording first met (by quarter, row and place)."""
    everyone = F.col("body") == EVERYONE
    least_ads = F.when(everyone, limits.global_ads).otherwise(limits.least_ads)
    share = F.when(everyone, limits.global_share).otherwise(limits.share)
    titles = F.when(everyone, limits.global_titles).otherwise(limits.least_titles)
    best = F.row_number().over(Window.partitionBy("body", "key").orderBy(F.col("share").desc(), "quarter"))
    over = counts.where(F.col("bin_size") >= least_ads).withColumn("share", F.col("n_ads") / F.col("bin_size"))
    over = over.withColumn("_best", best).where("_best = 1").drop("_best").where(F.col("share") >= share)
    over = cut(over.withColumn("flagged", F.col("n_titles") >= titles))
    wanted = over.select("key").distinct()
    met = rows.where("quarter is not null").join(small_side(wanted), "key", "left_semi")
    first = F.min_by("sentence", F.struct("quarter", "row_id", "pos"))
    own = met.where("body is not null").groupBy("body", "key").agg(first.alias("sentence_original"))
    every = met.groupBy("key").agg(first.alias("sentence_original")).select(F.lit(EVERYONE).alias("body"), "key", "sentence_original")
    out = over.join(own.unionByName(every), ["body", "key"], "left").withColumn("pct_of_bin", F.round(F.col("share") * 100, 1))
    guard = F.coalesce(F.col("sentence_original").rlike(protected), F.lit(False)) if protected else F.lit(False)
    return out.withColumn("protected", guard).select("body", "quarter", "key", "n_ads", "bin_size", "pct_of_bin", "n_titles", "flagged", "protected", "sentence_original")


def stripped(rows: DataFrame, flagged: DataFrame, protected: str | None = None) -> DataFrame:
    """``(row_id, clean)``: the sentences of each row that are protected or flagged neither for its body
    nor for everyone, joined by blanks in order; null where none is left. Rows without a body meet the
    corpus-wide list only."""
    keys = cut(flagged.where("flagged").select("body", "key").distinct())
    own = keys.where(F.col("body") != EVERYONE).withColumn("_own", F.lit(True))
    every = keys.where(F.col("body") == EVERYONE).select("key", F.lit(True).alias("_all"))
    marked = rows.join(small_side(own), ["body", "key"], "left").join(small_side(every), "key", "left")
    guard = F.col("sentence").rlike(protected) if protected else F.lit(False)
    kept = F.when(guard | (F.col("_own").isNull() & F.col("_all").isNull()), F.struct("pos", "sentence"))
    gathered = marked.groupBy("row_id").agg(F.array_sort(F.collect_list(kept)).alias("_kept"))  # one notice's sentences
    return gathered.select("row_id", F.nullif(F.array_join(F.transform("_kept", lambda x: x["sentence"]), " "), F.lit("")).alias("clean"))


def strip_stats(before: Column, after: Column) -> list[Column]:
    """Aggregates: rows, rows emptied, share of characters kept and its quartiles."""
    kept = F.coalesce(F.length(after), F.lit(0)) / F.length(before)
    return [
        F.count(before).alias("n_texts"), F.count_if(before.isNotNull() & after.isNull()).alias("n_emptied"),
        F.round(F.sum(F.coalesce(F.length(after), F.lit(0))) / F.sum(F.length(before)), 6).alias("kept_share"),
        F.percentile(kept, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("kept_quartiles"),
    ]
