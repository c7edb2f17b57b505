"""Attributes as known at event time.

``versions_of`` turns a table of dated changes into a timeline: for each name the dates at which
anything about it changes, numbered from 1 (0: before the first), and for each number the attributes
then valid. ``join_as_known`` gives every event the number of changes up to its date and joins the
attributes on name and number, so nothing that became known later can reach an event.

Numbers are counted over narrow rows only: the distinct (name, date) pairs of the events together with
the changes. A name that holds a third of all events therefore weighs no more than its days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut

#: Open ends of an interval.
_EVER, _NEVER = "DATE'0001-01-01'", "DATE'9999-12-31'"


def tidy_name(name: Column) -> Column:
    """Name without stray white space; null where nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(name, r"\s+", " ")), F.lit(""))


def changes(lineage: DataFrame) -> DataFrame:
    """Distinct dated changes ``(old, new, at)``; changes without a date or a name have not happened."""
    return (
        lineage.select(
            tidy_name(F.col("predecessor_canonical")).alias("old"),
            tidy_name(F.col("successor_canonical")).alias("new"),
            F.col("effective_date").cast("date").alias("at"),
        )
        .where("old is not null and new is not null and at is not null and old <> new")
        .distinct()
    )


def _reach(edges: DataFrame, forward: bool) -> DataFrame:
    """All names a name leads to, with the date bounding each path: ``(name, other, bound)``.

    Forward, the bound is the latest date on the path (the other stands for the name from then on);
    backward, the earliest (it stood for it before). Paths must keep the order of time, so loops end.
    """
    source, target = ("old", "new") if forward else ("new", "old")
    step = edges.select(F.col(source).alias("name"), F.col(target).alias("other"), F.col("at").alias("bound"))
    hop = edges.select(F.col(source).alias("other"), F.col(target).alias("next"), F.col("at"))
    known = new = cut(step.distinct())
    while not new.isEmpty():
        on_time = F.col("at") >= F.col("bound") if forward else F.col("at") <= F.col("bound")
        further = new.join(hop, "other").where(on_time & (F.col("next") != F.col("name")))
        further = further.select("name", F.col("next").alias("other"), F.col("at").alias("bound")).distinct()
        new = cut(further.join(known, ["name", "other", "bound"], "left_anti"))
        known = known.unionByName(new)
    return known


def intervals(lineage: DataFrame) -> DataFrame:
    """``(name, in_force, since, until)``: which name stands for ``name`` on days in [since, until)."""
    edges = changes(lineage)
    ends = edges.groupBy(F.col("old").alias("in_force")).agg(F.min("at").alias("ended"))
    births = edges.groupBy(F.col("new").alias("in_force")).agg(F.min("at").alias("began"))
    names = edges.select(F.col("old").alias("name")).union(edges.select(F.col("new").alias("name"))).distinct()
    own = names.select("name", F.col("name").alias("in_force"), F.expr(_EVER).alias("since"), F.expr(_NEVER).alias("until"))
    later = _reach(edges, True).select("name", F.col("other").alias("in_force"), F.col("bound").alias("since"), F.expr(_NEVER).alias("until"))
    earlier = _reach(edges, False).select("name", F.col("other").alias("in_force"), F.expr(_EVER).alias("since"), F.col("bound").alias("until"))
    return (
        own.unionByName(later).unionByName(earlier)
        .join(ends, "in_force", "left").join(births, "in_force", "left")
        .select(
            "name", "in_force",
            F.greatest("since", F.coalesce("began", F.expr(_EVER))).alias("since"),
            F.least("until", F.coalesce("ended", F.expr(_NEVER))).alias("until"),
        )
        .where("since < until").distinct()
    )


def versions_of(timeline: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Change points ``(name, at)`` and attributes ``(name, version, in_force)`` of an interval table."""
    points = (
        timeline.select("name", F.col("since").alias("at")).union(timeline.select("name", F.col("until").alias("at")))
        .where(f"at > {_EVER} and at < {_NEVER}").distinct()
    )
    numbered = points.withColumn("version", F.row_number().over(Window.partitionBy("name").orderBy("at")).cast("bigint"))
    first = timeline.select("name").distinct().select("name", F.expr(_EVER).alias("at"), F.lit(0).cast("bigint").alias("version"))
    starts = first.unionByName(numbered)
    attributes = (
        starts.join(timeline, "name").where("at >= since and at < until").select("name", "version", "in_force").distinct()
    )
    return points, attributes


def number_events(events: DataFrame, points: DataFrame, name: str, date: str) -> DataFrame:
    """Distinct ``(name, date, version)`` of the events: the count of changes up to and on the date."""
    marks = events.select(F.col(name).alias("name"), F.col(date).cast("date").alias("at")).where("name is not null and at is not null")
    marks = marks.distinct().select("name", "at", F.lit(0).alias("change"), F.lit(True).alias("is_event"))
    steps = points.select("name", "at", F.lit(1).alias("change"), F.lit(False).alias("is_event"))
    upto = Window.partitionBy("name").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = marks.unionByName(steps).withColumn("version", F.sum("change").over(upto).cast("bigint"))
    return counted.where("is_event").select("name", "at", "version")


def join_as_known(events: DataFrame, lineage: DataFrame, name: str, date: str, into: str = "canonical_in_force") -> DataFrame:
    """Every event with each name in force for ``events[name]`` on ``events[date]``.

    One row per event and name in force. A name without changes is in force itself. Events with a null
    name or date get a null; blank names are treated as null. Repeated events stay repeated; columns of
    the events keep their names, save that a column named ``into`` is replaced.
    """
    points, attributes = versions_of(cut(intervals(lineage)))
    keyed = events.drop(into).withColumns({"__asof_name": tidy_name(F.col(name)), "__asof_at": F.col(date).cast("date")})
    numbers = number_events(keyed, points, "__asof_name", "__asof_at")
    # narrow rows meet their attributes first; a missing entry means a name that never changed
    known = numbers.join(attributes, ["name", "version"], "left").select(
        F.col("name").alias("__asof_name"), F.col("at").alias("__asof_at"), F.coalesce("in_force", "name").alias(into)
    )
    return keyed.join(known, ["__asof_name", "__asof_at"], "left").drop("__asof_name", "__asof_at")
