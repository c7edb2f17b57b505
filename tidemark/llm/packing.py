"""Filling containers of fixed capacity with whole texts, at a controlled mixture.

Items are spread over shards by a hash, so that a shard holds a bounded number of tokens whatever the
sources are. In a shard each source has a queue ordered by size. Every window (container) credits each
source with its share of the capacity. The source with the largest deficit opens it with its largest item; while
items above half the capacity are left, of which no two fit together, it is the source with the largest
deficit among those that have one. Then the source with the largest deficit that has a fitting item gives
its largest fitting one, until nothing fits. Deficits are carried from window to window, and from shard to
shard by running sums over the narrow table of tokens by shard and source, in which sources are rows.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.sums import sums_before

#: Most tokens a shard holds, on average.
SHARD_TOKENS = 2_000_000
_PLACED = "container string, position int, doc {doc}, source string, piece int, token_start bigint, token_end bigint"


def pieces(items: DataFrame, capacity: int | dict[str, int]) -> DataFrame:
    """``(container_kind, capacity, doc, source, piece, token_start, token_end)``: for each kind of container
    one row for each item, several where an item exceeds the capacity (all but the last then fill a container
    each). Items without tokens or a key give none."""
    kinds = capacity if isinstance(capacity, dict) else {"": capacity}
    sizes = F.array(*[F.struct(F.lit(k).alias("container_kind"), F.lit(int(c)).cast("bigint").alias("capacity")) for k, c in sorted(kinds.items())])
    narrow = items.where("n_tokens > 0 and doc is not null").select("doc", F.coalesce("source", F.lit("")).alias("source"), "n_tokens", F.inline(sizes))
    split = narrow.select("*", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n_tokens") / F.col("capacity")).cast("int") - 1)).alias("piece"))
    return split.select(
        "container_kind", "capacity", "doc", "source", "piece", (F.col("piece") * F.col("capacity")).alias("token_start"),
        F.least(F.col("n_tokens"), (F.col("piece") + 1) * F.col("capacity")).alias("token_end"),
    )


def fill(sizes: dict[str, list[tuple[int, int]]], capacity: int, shares: dict[str, float], deficits: dict[str, float]) -> Iterator[list[tuple[str, int]]]:
    """Windows as lists of ``(source, row)``. ``sizes``: by source ``(size, row)`` in ascending order, each
    at most the capacity; used up. ``deficits`` are changed in place."""
    queues = {s: q for s, q in sizes.items() if q}
    while queues:
        for s in deficits:
            deficits[s] += shares.get(s, 0.0) * capacity
        owed = lambda s: (deficits.get(s, 0.0), s)
        large = [s for s in queues if 2 * queues[s][-1][0] > capacity]
        first = max(large or queues, key=owed)
        room, window, take = capacity, [], (first, len(queues[first]) - 1)
        while take:
            source, at = take
            size, row = queues[source].pop(at)
            if not queues[source]:
                del queues[source]
            window.append((source, row))
            room -= size
            deficits[source] = deficits.get(source, 0.0) - size
            fitting = [s for s in queues if queues[s][0][0] <= room] if room else ()
            take = None
            if fitting:
                source = max(fitting, key=owed)
                take = (source, bisect_right(queues[source], (room, 1 << 62)) - 1)
        yield window


def pack(items: DataFrame, capacity: int, shares: dict[str, float] | DataFrame | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Place every piece of ``items(doc, source, n_tokens)`` in containers of one kind: ``(container,
    position, doc, source, piece, token_start, token_end)``; see ``pack_kinds``."""
    return pack_kinds(items, {"": capacity}, shares, shard_tokens).drop("container_kind")


def pack_kinds(items: DataFrame, kinds: dict[str, int], shares: dict[str, float] | DataFrame | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Place every piece of ``items(doc, source, n_tokens)`` in containers of every kind (``kinds``: capacity by
    name): ``(container_kind, container, position, doc, source, piece, token_start, token_end)``.

    ``shares``: target share of tokens by source, also as a table ``(source, share)``; without it the
    sources' own shares, and 0 for sources it lacks. A null source is a source of its own, named by the
    empty text. Items are never split unless they exceed the capacity; items without tokens or a key are not
    placed; an item given twice is placed twice.
    """
    if not kinds or min(kinds.values()) < 1:
        raise ValueError("a container must hold something")
    spark = items.sparkSession
    rows = pieces(items, kinds)
    size = F.col("token_end") - F.col("token_start")
    full = rows.where(size == F.col("capacity")).select(
        "container_kind", F.concat_ws("-", F.lit("f"), F.col("doc").cast("string"), F.col("piece").cast("string")).alias("container"), F.lit(0).alias("position"), "doc", "source", "piece", "token_start", "token_end"
    )
    # one row for each kind, whatever the sources
    loose = {r["container_kind"]: r["n"] for r in rows.where(size < F.col("capacity")).groupBy("container_kind").agg(F.sum(size).alias("n")).collect()}
    shards = F.create_map(*[x for k in sorted(kinds) for x in (F.lit(k), F.lit(max(1, math.ceil(loose.get(k, 0) / shard_tokens))))])
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc", "piece"), shards[F.col("container_kind")].cast("bigint")))
    open_ = rows.where(size < F.col("capacity"))

    # what each source of a shard is owed when it begins: target share of all tokens before it and of the full
    # pieces of the shard itself, less its own; sources that a shard lacks need no row there
    narrow = rows.groupBy("container_kind", "shard", "source").agg(F.sum(size).alias("n"), F.sum(F.when(size == F.col("capacity"), size).otherwise(0)).alias("n_full"))
    if shares is None:
        own = narrow.groupBy("container_kind", "source").agg(F.sum("n").alias("own"))
        target = own.join(F.broadcast(own.groupBy("container_kind").agg(F.sum("own").alias("all"))), "container_kind").select("container_kind", "source", (F.col("own") / F.col("all")).alias("share"))
        on = ["container_kind", "source"]
    else:
        if isinstance(shares, dict):
            shares = spark.createDataFrame([(s, float(x)) for s, x in shares.items()], "source string, share double")
        target = shares.select(F.coalesce("source", F.lit("")).alias("source"), "share").groupBy("source").agg(F.max("share").alias("share"))
        on = ["source"]
    totals = narrow.groupBy("container_kind", "shard").agg(F.sum("n").alias("n"), F.sum("n_full").alias("all_full"))
    totals = sums_before(totals, ["container_kind"], "shard", {"all_before": F.col("n")}).select("container_kind", "shard", "all_before", "all_full")
    mine = sums_before(narrow, ["container_kind", "source"], "shard", {"own_before": F.col("n")}).select("container_kind", "shard", "source", "own_before", "n_full")
    share = F.coalesce("share", F.lit(0.0))
    owed = mine.join(totals, ["container_kind", "shard"]).join(target, on, "left").select(
        F.col("container_kind").alias("kind"), F.col("shard").alias("at"), F.col("source").alias("source"), share.alias("share"), (share * (F.col("all_before") + F.col("all_full")) - F.col("own_before") - F.col("n_full")).alias("owed")
    )

    def place(items: pd.DataFrame, owed: pd.DataFrame) -> pd.DataFrame:
        columns = ["container_kind", "container", "position", "doc", "source", "piece", "token_start", "token_end"]
        if not len(items):
            return pd.DataFrame(columns=columns)
        items = items.sort_values(["doc", "piece"], kind="stable").reset_index(drop=True)
        queues: dict[str, list[tuple[int, int]]] = {}
        for row, (source, a, b) in enumerate(zip(items["source"], items["token_start"], items["token_end"])):
            queues.setdefault(source, []).append((int(b - a), row))
        for q in queues.values():
            q.sort()
        held = owed[owed["source"].isin(queues.keys())]  # sources with full pieces only wait for nothing
        target, debts = dict(zip(held["source"], held["share"])), dict(zip(held["source"], held["owed"]))
        order, names, places = [], [], []
        shard = int(items["shard"].iloc[0])
        for k, window in enumerate(fill(queues, int(items["capacity"].iloc[0]), target, debts)):
            for position, (_, row) in enumerate(window):
                order.append(row)
                names.append(f"{shard}-{k}")
                places.append(position)
        out = items.loc[order, ["container_kind", "doc", "source", "piece", "token_start", "token_end"]]
        out.insert(1, "position", places)
        out.insert(1, "container", names)
        return out[columns]

    schema = "container_kind string, " + _PLACED.format(doc=items.schema["doc"].dataType.simpleString())
    placed = open_.groupBy("container_kind", "shard").cogroup(owed.groupBy("kind", "at")).applyInPandas(place, schema)
    return placed.unionByName(full)


def fill_report(placed: DataFrame, capacity: int, shares: dict[str, float] | None = None) -> DataFrame:
    """``fill_reports`` of one kind of container: one row, also where nothing is placed."""
    one = fill_reports(placed.withColumn("container_kind", F.lit("")), {"": capacity}, shares)
    return one.drop("container_kind", "capacity")


def fill_reports(placed: DataFrame, kinds: dict[str, int], shares: dict[str, float] | None = None) -> DataFrame:
    """One row a kind: containers, tokens, filled share, the least number of containers possible, and the
    mean and largest deviation of a container, which is the mean over sources of the absolute difference
    between its share of tokens and the target. ``shares``: the targets; without it the overall shares."""
    spark = placed.sparkSession
    each = placed.groupBy("container_kind", "container", "source").agg(F.sum(F.col("token_end") - F.col("token_start")).alias("n"))
    capacity = spark.createDataFrame([(k, int(c)) for k, c in kinds.items()], "container_kind string, capacity bigint")
    if shares is None:
        overall = each.groupBy("container_kind", "source").agg(F.sum("n").alias("n"))
        targets = overall.join(F.broadcast(overall.groupBy("container_kind").agg(F.sum("n").alias("total"))), "container_kind").select("container_kind", "source", (F.col("n") / F.col("total")).alias("target"))
    else:
        targets = capacity.select("container_kind", F.inline(F.array(*[F.struct(F.lit(s).alias("source"), F.lit(float(x)).alias("target")) for s, x in shares.items()])))
    # a source that a container lacks deviates by its target: all targets at first, corrected for those it has
    totals = targets.groupBy("container_kind").agg(F.sum("target").alias("targets"), F.greatest(F.count(F.lit(1)), F.lit(1)).alias("sources"))
    sized = each.join(each.groupBy("container_kind", "container").agg(F.sum("n").alias("all")), ["container_kind", "container"]).join(targets, ["container_kind", "source"], "left")
    target = F.coalesce("target", F.lit(0.0))
    used = sized.groupBy("container_kind", "container").agg(F.sum("n").alias("n"), F.sum(F.abs(F.col("n") / F.col("all") - target) - target).alias("off"))
    used = used.join(F.broadcast(totals), "container_kind").withColumn("deviation", (F.col("off") + F.col("targets")) / F.col("sources"))
    found = used.groupBy("container_kind").agg(
        F.count(F.lit(1)).alias("containers"), F.sum("n").alias("tokens"), F.max("n").alias("fullest"),
        F.round(F.avg("deviation"), 6).alias("mean_deviation"), F.round(F.max("deviation"), 6).alias("largest_deviation"),
    )
    return capacity.join(found, "container_kind", "left").select(
        F.coalesce("containers", F.lit(0)).alias("containers"), "tokens", "fullest", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 6).alias("filled"),
        F.ceil(F.col("tokens") / F.col("capacity")).alias("least_containers"), "mean_deviation", "largest_deviation", "container_kind", "capacity",
    )
