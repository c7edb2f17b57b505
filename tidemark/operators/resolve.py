"""Printed names of bodies to canonical names by rule tables.

Every distinct text is resolved once by a cascade of lookups, all of them equality joins; rows then join
the resolved texts. Rule tables are DataFrames, so nothing here knows any particular body.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import name_key
from tidemark.operators.relational import MOST_BROADCAST, MOST_BYTES, first_listed_of, is_small, longest_prefix, small_side
from tidemark.session import cut


@dataclass(frozen=True)
class Rules:
    """Rule tables. ``names(name, ord)``: canonical names in order of preference; ``manual(raw, name)``:
    fixed answers; ``prefixes(prefix, ord, name)``: portfolios in order, with the name they mean alone or
    null; ``undecided(raw)``: portfolios that never name a body; ``forward(name, to)``: later names;
    ``crosswalk(raw, name)``: known texts, a null name meaning that they are known to mean none;
    ``starts(raw, name)`` or None: fixed answers for texts that begin so, up to a word's end."""

    names: DataFrame
    manual: DataFrame
    prefixes: DataFrame
    undecided: DataFrame
    forward: DataFrame
    crosswalk: DataFrame
    starts: DataFrame | None = None

    @cached_property
    def bounded(self) -> bool:
        """Whether all rule tables together are small enough to be broadcast, measured once in one job."""
        tables = [self.names, self.manual, self.prefixes, self.undecided, self.forward, self.crosswalk, *([] if self.starts is None else [self.starts])]
        texts = [t.select(F.to_json(F.struct(*[F.col(c).cast("string") for c in t.columns])).alias("text")) for t in tables]
        every = texts[0]
        for t in texts[1:]:
            every = every.unionByName(t)
        return is_small(every, MOST_BROADCAST, MOST_BYTES)

    def side(self, df: DataFrame) -> DataFrame:
        """A table no larger than the rule tables, broadcast if these are small."""
        return F.broadcast(df) if self.bounded else df


def resolve_texts(texts: DataFrame, rules: Rules) -> DataFrame:
    """Distinct ``raw`` texts with ``name`` and ``method``.

    In order: empty; a crosswalk entry (even one that means none); manual, also by how a text begins (the
    longest listed beginning wins); exact or longest name the text
    begins with at a word's end; undecided; the first portfolio the text begins with, alone or with a name
    after it. The first portfolio that fits ends the search. Later names replace those found by prefix.
    """
    t = texts.select(F.trim("raw").alias("raw")).where("raw is not null").distinct().withColumn("key", name_key(F.col("raw")))
    known = rules.crosswalk.groupBy(F.trim("raw").alias("raw")).agg(F.max("name").alias("_known")).withColumn("_found", F.lit(True))
    t = t.join(rules.side(known), "raw", "left")
    manual = rules.manual.groupBy(name_key(F.col("raw")).alias("key")).agg(F.min("name").alias("_manual"))
    t = t.join(rules.side(manual), "key", "left")
    if rules.starts is not None:
        starts = rules.starts.select(name_key(F.col("raw")).alias("key"), "name", F.col("name").alias("ord"))
        t = longest_prefix(t, F.col("key"), starts, "key", "name", "ord", ["raw"], "_begun", rules.bounded).withColumn("_manual", F.coalesce("_manual", "_begun")).drop("_begun")
    names = rules.names.select("name", "ord", name_key(F.col("name")).alias("key"))
    t = longest_prefix(t, F.col("key"), names, "key", "name", "ord", ["raw"], "_direct", rules.bounded)
    never = rules.undecided.select(F.trim("raw").alias("raw"), F.lit(True).alias("_never")).distinct()
    t = t.join(rules.side(never), "raw", "left")
    # the first listed portfolio that the key begins with: word prefixes meet portfolio keys by equality
    heads = rules.prefixes.select("prefix", "ord", "name", name_key(F.col("prefix")).alias("_head"))
    words = F.split("key", " ")
    most_words = heads.agg(F.max(F.size(F.split("_head", " ")))).first()[0] or 1
    laid = t.select("raw", "key", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.size(words), F.lit(most_words))), lambda i: F.array_join(F.slice(words, 1, i), " "))).alias("_head"))
    hit = laid.join(rules.side(heads), "_head").groupBy("raw").agg(F.min(F.struct("ord", "prefix", "name", "_head")).alias("_p"))
    t = t.join(hit, "raw", "left").withColumn("_rest", F.trim(F.expr("substring(key, length(_p._head) + 1)")))
    t = longest_prefix(t, F.col("_rest"), names, "key", "name", "ord", ["raw"], "_after", rules.bounded)
    later = rules.forward.groupBy("name").agg(F.min("to").alias("to"))
    for c in ("_direct", "_after"):
        moved = rules.side(later.select(F.col("name").alias(c), F.col("to").alias(f"{c}_to")))
        t = t.join(moved, c, "left").withColumn(c, F.coalesce(f"{c}_to", c)).drop(f"{c}_to")
    exact = name_key(F.col("_direct")) == F.col("key")
    c = F.col
    alone = c("_p").isNotNull() & (c("_rest") == "")
    method = (
        F.when(c("raw") == "", "empty").when(c("_found"), "crosswalk").when(c("_manual").isNotNull(), "manual")
        .when(c("_direct").isNotNull(), F.when(exact, "exact").otherwise("prefix")).when(c("_never"), "division_required")
        .when(alone, F.when(c("_p.name").isNotNull(), "portfolio_only").otherwise("uncertain"))
        .when(c("_p").isNotNull(), F.when(c("_after").isNotNull(), "portfolio_strip").otherwise(F.concat(F.lit("uncertain_after_strip:"), c("_p.prefix"))))
        .otherwise("uncertain")
    )
    t = t.withColumn("method", method)
    name = (
        F.when(c("method") == "crosswalk", c("_known")).when(c("method") == "manual", c("_manual")).when(c("method").isin("exact", "prefix"), c("_direct"))
        .when(c("method") == "portfolio_only", c("_p.name")).when(c("method") == "portfolio_strip", c("_after"))
    )
    return t.select("raw", name.alias("name"), "method")


def tried_texts(agency: Column, division: Column, branch: Column) -> dict[str, list[Column]]:
    """What is tried, in order, for rows whose body stands in the agency, in the division because the
    agency is a file name, or in the division because the agency is only a portfolio."""
    a, d, b = (F.coalesce(F.trim(x), F.lit("")) for x in (agency, division, branch))
    joined = F.trim(F.concat_ws(" ", d, b))
    return {
        "agency": [a], "file": [joined, d],
        "portfolio": [joined, d, b, F.when((b != "") & (d != ""), F.concat_ws(" ", b, d)), F.when(d != "", F.concat_ws(" ", a, d))],
    }


def resolve_rows(
    rows: DataFrame, rules: Rules, portfolios: DataFrame | list[str], row: list[str], allowed: DataFrame | None = None, fallback: DataFrame | None = None
) -> DataFrame:
    """``rows(agency, division, branch)`` with ``canonical``.

    Each row belongs to one of three ways (``tried_texts``). A row whose agency was only one of
    ``portfolios(name)``, or of a list, and that has a division is tried again by its division, and that answer wins if there
    is one. A branch that names a body by itself wins over the division's where ``allowed(host, part)`` lists
    the pair, or where nothing else was found. Where nothing was found at all, ``fallback(agency, name)`` gives
    the name of an agency text. Null texts match nothing.
    """
    if not isinstance(portfolios, DataFrame):
        portfolios = rows.sparkSession.createDataFrame([(p,) for p in portfolios], "name string")
    tries = tried_texts(F.col("agency"), F.col("division"), F.col("branch"))
    every = F.array(*[x for ways in tries.values() for x in ways], F.trim(F.coalesce("branch", F.lit(""))))
    texts = rows.select(F.explode(F.array_distinct(every)).alias("raw")).where("raw <> ''").distinct()
    known = cut(resolve_texts(texts, rules))
    listed = small_side(portfolios.where("name is not null").select(F.trim("name").alias("_p"), F.lit(True).alias("_listed")).distinct())
    out = rows.withColumn("_p", F.trim("agency")).join(listed, "_p", "left")
    way = F.when(F.col("agency").endswith(".pdf"), "file").when(F.col("_listed"), "portfolio").otherwise("agency")
    out = first_listed_of(out.withColumn("_way", way), {f"_{n}": columns for n, columns in tries.items()}, known, "raw", "name", row)
    how = known.select(F.col("raw").alias("_a"), F.col("method").alias("_how"))
    sure = known.where("name is not null and method not in ('portfolio_only', 'uncertain', 'division_required')").select(F.col("raw").alias("_b"), F.col("name").alias("_part"))
    if is_small(known):  # no more rows than texts; the two sides below are parts of it
        how, sure = F.broadcast(how), F.broadcast(sure)
    out = out.withColumn("_a", F.trim("agency")).join(how, "_a", "left")
    out = out.withColumn("_b", F.trim("branch")).join(sure, "_b", "left")
    refined = F.when(F.col("_how") == "portfolio_only", F.coalesce("_portfolio", "_agency")).otherwise(F.col("_agency"))
    base = F.when(F.col("_way") == "file", F.col("_file")).when(F.col("_way") == "portfolio", F.col("_portfolio")).otherwise(refined)
    out = out.withColumn("_base", base)
    takes = F.col("_base").isNull() & (F.col("_way") == "portfolio")
    if allowed is not None:
        pairs = small_side(allowed.select(F.col("host").alias("_base"), F.col("part").alias("_part"), F.lit(True).alias("_allowed")).distinct())
        out = out.join(pairs, ["_base", "_part"], "left")
        takes = takes | F.col("_allowed")
    out = out.withColumn("canonical", F.when(F.coalesce(takes, F.lit(False)), F.coalesce("_part", "_base")).otherwise(F.col("_base")))
    if fallback is not None:
        last = small_side(fallback.groupBy(F.trim("agency").alias("_p")).agg(F.min("name").alias("_last")))
        out = out.join(last, "_p", "left").withColumn("canonical", F.coalesce("canonical", "_last"))
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def overridden_rows(rows: DataFrame, fixed: DataFrame, key: str, name: str = "agency_canonical") -> DataFrame:
    """``rows`` with the names that ``fixed(key, name)`` gives for single rows; a null key matches nothing, of
    a key listed twice the lower name counts."""
    side = small_side(fixed.where(F.col("key").isNotNull()).groupBy(F.col("key").alias("_key")).agg(F.min("name").alias("_fixed")))
    return rows.join(side, rows[key] == F.col("_key"), "left").withColumn(name, F.coalesce("_fixed", name)).drop("_key", "_fixed")


def renamed_by_date(rows: DataFrame, rules: DataFrame, date: str, name: str = "agency_canonical") -> DataFrame:
    """``rows`` whose name, or printed text, stood for another body on their day.

    ``rules(column, value, name, before, to)``: where ``column`` (``agency`` or ``division``) holds ``value``,
    the row's name is ``name`` (or any, where that is null) and the day lies before ``before``, the name
    becomes ``to``. Rules are laid out as equalities, so each row meets only the rules of its own texts; of
    several that apply the one with the earliest ``before`` wins. Rows without a day stay as they are.
    """
    texts = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).alias("_value")) for c in ("agency", "division") if c in rows.columns])
    side = small_side(rules.select(F.col("column").alias("_column"), F.col("value").alias("_value"), F.col("name").alias("_name"), F.col("before").cast("date").alias("_before"), F.col("to").alias("_to")))
    keys = [c for c in ("agency", "division") if c in rows.columns] + [name, date]
    laid = rows.select(*keys).distinct().select(*keys, F.inline(texts)).where("_value is not null").join(side, ["_column", "_value"])
    fits = (F.col(date).cast("date") < F.col("_before")) & (F.col("_name").isNull() | F.col("_name").eqNullSafe(F.col(name)))
    best = laid.where(fits).groupBy(*keys).agg(F.min(F.struct("_before", "_to"))["_to"].alias("_to"))
    side = best.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & rows[k].eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(side, same, "left").withColumn(name, F.coalesce("_to", name)).drop("_to", *[f"_k_{k}" for k in keys])


def build_crosswalk(rows: DataFrame, rules: Rules, groups: DataFrame, contact: list[str] | None = None) -> DataFrame:
    """``(agency_raw, agency_canonical, agency_group, match_method)`` of every distinct agency text, and of
    division and branch together where the agency is a file name; texts that begin with a phrase of
    ``contact`` are hidden behind a mark. One row for each text, in its order."""
    a, joined = F.trim("agency"), F.trim(F.concat_ws(" ", F.trim("division"), F.trim("branch")))
    pool = rows.select(F.when(F.col("agency").endswith(".pdf"), joined).otherwise(a).alias("raw")).where("raw <> ''").distinct()
    found = with_group(resolve_texts(pool, rules), "name", groups)
    shown = hidden_contact(F.col("raw"), contact or [])
    return found.select(shown.alias("agency_raw"), F.col("name").alias("agency_canonical"), "agency_group", F.col("method").alias("match_method")).distinct().orderBy("agency_raw", "agency_canonical")


def with_group(rows: DataFrame, name: str, groups: DataFrame, into: str = "agency_group") -> DataFrame:
    """The group of a name, itself where none is listed, null for null. ``groups(name, grp)``."""
    side = groups.groupBy(F.col("name").alias("_name")).agg(F.min("grp").alias("_grp"))
    return rows.join(small_side(side), F.col(name) == F.col("_name"), "left").withColumn(into, F.coalesce("_grp", name)).drop("_name", "_grp")


def lineage_edges(changes: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """``changes(olds ARRAY, news ARRAY, effective, relation)`` as one row per pair of old and new name; the
    relation is as given, else a split if there are several new names, else a rename. A name that
    ``names(name)``, if given, lacks is an error that lists up to twenty of them."""
    if names is not None:
        used = changes.select(F.explode(F.concat("olds", "news")).alias("name")).where("name is not null").distinct()
        unknown = [r[0] for r in used.join(names.select("name"), "name", "left_anti").orderBy("name").limit(20).collect()]
        if unknown:
            raise ValueError("unknown names: " + ", ".join(unknown))
    relation = F.coalesce("relation", F.when(F.size("news") > 1, "split").otherwise("rename"))
    return changes.select(F.explode("olds").alias("predecessor"), "news", "effective", relation.alias("relation")).select("predecessor", F.explode("news").alias("successor"), "effective", "relation")


def hidden_contact(raw: Column, starts: list[str], mark: str = "[contact text]") -> Column:
    """A raw key replaced where it begins with a phrase of contact text."""
    hit = F.lit(False)
    for s in starts:
        hit = hit | raw.startswith(s)
    return F.when(hit, mark).otherwise(raw)
