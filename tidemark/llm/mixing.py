"""Mixing sources to target weights.

The tokens of each source are laid end to end and cut into blocks of fixed length. The output has a
number of shards; each draws how many blocks it takes from each source (multinomial), the draws are
numbered through by cumulative sums, and a number becomes a block of the source by a keyed permutation
of the block indices, another one for each repetition. Blocks are joined to the output by index, so
nothing is shuffled but the pieces asked for, and no source is ever gathered in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.sums import sums_before

#: Items of one bucket of the prefix sums, on average.
BUCKET_ITEMS = 50_000


@dataclass(frozen=True)
class Settings:
    """``block``: tokens of a block; ``shard_blocks``: blocks of an output shard; ``total``: tokens of the
    output (None: as many as the targeted sources hold once); ``seed``: of all draws; ``most_targets``: as
    each shard draws from all targets at once, more of them are an error."""

    block: int = 256
    shard_blocks: int = 1024
    total: int | None = None
    seed: int = 17
    most_targets: int = 100_000


def laid_out(items: DataFrame, bucket_items: int = BUCKET_ITEMS) -> DataFrame:
    """``items(doc, source, n_tokens)`` with ``begin``, the tokens of its source before it.

    Sums run over buckets first and inside a bucket then; a source of any size is split over many.
    """
    count = items.count()
    buckets = max(1, math.ceil(count / bucket_items))
    keyed = items.withColumn("bucket", F.pmod(F.xxhash64("doc"), F.lit(buckets)).cast("int"))
    sums = keyed.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("n"))
    sums = sums_before(sums, ["source"], "bucket", {"base": F.col("n")}).select("source", "bucket", "base")
    inside = Window.partitionBy("source", "bucket").orderBy(F.xxhash64("doc", F.lit(1)), "doc").rowsBetween(Window.unboundedPreceding, -1)
    keyed = keyed.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return keyed.join(sums, ["source", "bucket"]).select("doc", "source", "n_tokens", (F.col("base") + F.col("within")).alias("begin"))


def block_pieces(placed: DataFrame, block: int) -> DataFrame:
    """``(source, block, doc, token_start, token_end)``: the stretches of items that make up each block."""
    first, last = F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("n_tokens") - 1) / block)
    cut = placed.where("n_tokens > 0").select("doc", "source", "n_tokens", "begin", F.explode(F.sequence(first, last)).alias("block"))
    return cut.select(
        "source", "block", "doc",
        F.greatest(F.lit(0), F.col("block") * block - F.col("begin")).cast("bigint").alias("token_start"),
        F.least(F.col("n_tokens"), (F.col("block") + 1) * block - F.col("begin")).cast("bigint").alias("token_end"),
    )


def shares_within_caps(target: dict[str, float], room: dict[str, int], blocks: int) -> dict[str, float]:
    """Shares of the output: targets, save that no source exceeds its room; what is cut off goes to the
    other sources in proportion to their targets."""
    shares = {s: 0.0 for s in target}
    open_ = {s for s, t in target.items() if t > 0 and room.get(s, 0) > 0}
    left = 1.0
    while open_ and left > 1e-12:
        weight = sum(target[s] for s in open_)
        full = {s for s in open_ if shares[s] + left * target[s] / weight >= room[s] / blocks}
        if not full:
            for s in open_:
                shares[s] += left * target[s] / weight
            break
        for s in full:
            shares[s] = room[s] / blocks
        open_ -= full
        left = 1.0 - sum(shares.values()) - 0.0
        for s in open_:
            shares[s] = 0.0
        left = 1.0 - sum(shares[s] for s in target if s not in open_)
    return shares


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of ``range(size)`` at ``index``, row by row: a Feistel network over the next
    even power of two, walked until it lands inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            h, m, k, x = half[todo], mask[todo], key[todo].astype(np.uint64), out[todo]
            left, right = x >> h, x & m
            for r in range(4):
                f = (right + k + np.uint64(r + 1)) * np.uint64(0x9E3779B97F4A7C15)
                f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & m)
            out[todo] = (left << h) | right
            todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def mix(items: DataFrame, targets: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Draw blocks of ``items(doc, source, n_tokens)`` to the shares of ``targets(source, target_share,
    max_repeats)``.

    Returns ``(shard, slot, source, block, repeat, doc, token_start, token_end)``, the stretches that make
    up each slot of each shard, and a report by source. Sources without a target are not drawn; targets
    without items, or with more than their capped items can give, are met as far as possible and the rest
    goes to the other sources in proportion. A source's last block may be shorter. Null sources and items
    without tokens are left out; of a target given twice the larger share counts.
    """
    spark = items.sparkSession
    wanted = targets.where("source is not null and target_share > 0 and max_repeats > 0").groupBy("source")
    wanted = wanted.agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    goal = {r["source"]: (float(r["target_share"]), int(r["max_repeats"])) for r in wanted.limit(settings.most_targets + 1).collect()}
    if len(goal) > settings.most_targets:
        raise ValueError(f"more than {settings.most_targets:,} targets")
    placed = laid_out(items.where("n_tokens > 0").join(F.broadcast(wanted.select("source")), "source", "left_semi"))
    have = {r["source"]: int(r["n"]) for r in placed.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    held = {s: math.ceil(n / settings.block) for s, n in have.items()}
    room = {s: held[s] * goal[s][1] for s in held}
    asked = math.ceil((settings.total or sum(have.values())) / settings.block)
    blocks = min(asked, sum(room.values()))
    shares = shares_within_caps({s: goal[s][0] for s in goal}, room, max(1, blocks))
    names = sorted(s for s in shares if shares[s] > 0)
    weights = np.array([shares[s] for s in names])
    weights = weights / weights.sum() if len(names) else weights
    shards = math.ceil(blocks / settings.shard_blocks)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for shard in batch["id"]:
                size = min(settings.shard_blocks, blocks - int(shard) * settings.shard_blocks)
                counts = np.random.default_rng([settings.seed, int(shard)]).multinomial(size, weights)
                rows += [(int(shard), s, int(n)) for s, n in zip(names, counts)]
            yield pd.DataFrame(rows, columns=["shard", "source", "n"])

    counts = spark.range(shards if names else 0).mapInPandas(draw, "shard bigint, source string, n bigint")
    drawn = {r["source"]: int(r["n"]) for r in counts.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    # chance may draw a capped source beyond its room: what is too much is handed to sources with room left
    moves, given = [], {s: min(drawn.get(s, 0), room[s]) for s in names}
    for s in names:
        over, at = drawn.get(s, 0) - room[s], room[s]
        for other in sorted(names, key=lambda o: given[o] - room[o]):
            if over <= 0:
                break
            if take := min(over, room[other] - given[other]) if other != s else 0:
                moves.append((s, at, at + take, other, given[other]))
                given[other] += take
                at, over = at + take, over - take

    numbered = sums_before(counts.where("n > 0"), ["source"], "shard", {"base": F.col("n")})
    slots = numbered.select("shard", "source", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("n") - 1)).alias("number"))
    place = {n: i for i, n in enumerate(names)}
    ranges: dict[str, list[tuple]] = {}
    for s, a, b, other, start in moves:
        ranges.setdefault(s, []).append((a, b, other, start))

    @F.pandas_udf("source string, block bigint, repeat bigint, number bigint")
    def block_of(source: pd.Series, number: pd.Series) -> pd.DataFrame:
        taken, at = source.to_numpy(dtype=object).copy(), number.to_numpy(dtype=np.int64).copy()
        for s in ranges.keys() & set(taken):  # what is beyond a source's room comes from others
            mine = np.flatnonzero(taken == s)
            for a, b, other, start in ranges[s]:
                moved = mine[(at[mine] >= a) & (at[mine] < b) & (taken[mine] == s)]
                at[moved] += start - a
                taken[moved] = other
        size = np.array([held[s] for s in taken], dtype=np.int64)
        turn = at // np.maximum(size, 1)
        key = np.array([place[s] for s in taken], dtype=np.int64) * 1_000_003 + turn * 7919 + settings.seed
        return pd.DataFrame({"source": taken, "block": permute(at % np.maximum(size, 1), size, key), "repeat": turn, "number": at})

    slots = slots.select("shard", block_of.asNondeterministic()("source", "number").alias("b")).select("shard", "b.*")
    mixed_up = Window.partitionBy("shard").orderBy(F.xxhash64("shard", "source", "number"), "source", "number")
    slots = slots.withColumn("slot", F.row_number().over(mixed_up) - 1).select("shard", "slot", "source", "block", "repeat")
    drawn_pieces = slots.join(block_pieces(placed, settings.block), ["source", "block"])
    drawn_pieces = drawn_pieces.select("shard", "slot", "source", "block", "repeat", "doc", "token_start", "token_end")

    reached = drawn_pieces.groupBy("source").agg(F.sum(F.col("token_end") - F.col("token_start")).alias("tokens"), (F.max("repeat") + 1).alias("repeats"))
    table = [(s, goal[s][0], goal[s][1], have.get(s, 0)) for s in sorted(goal)]
    report = spark.createDataFrame(table, "source string, target_share double, max_repeats bigint, tokens_held bigint")
    whole = F.sum("tokens").over(Window.partitionBy(F.lit(1)))  # as many rows as targets
    report = report.join(reached, "source", "left").withColumn("all_tokens", whole).select(
        "source", "target_share", F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
        "tokens_held", F.coalesce("repeats", F.lit(0)).alias("repeats"), "max_repeats",
    )
    return drawn_pieces, report
