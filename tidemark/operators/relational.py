"""Joins, deduplication and set operations with defined treatment of nulls and ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows and bytes a lookup side may have to be broadcast outright; beyond them Spark plans the join by size.
MOST_BROADCAST, MOST_BYTES = 200_000, 64_000_000


def is_small(df: DataFrame, most: int = MOST_BROADCAST, most_bytes: int = MOST_BYTES) -> bool:
    """Whether ``df`` has at most so many rows and bytes. Rows are counted and measured where they lie, up to
    the bound; one row reaches the driver. ``df`` is run, so it should be a stored or cheap table."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) if not k.startswith(("array", "struct", "map")) else F.length(F.to_json(F.struct(F.col(f"`{c}`")))) for c, k in df.dtypes]
    size = sum(texts[1:], texts[0]) if texts else F.lit(0)
    found = df.limit(most + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("size")).first()
    return found["n"] <= most and found["size"] <= most_bytes


def small_side(df: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """``df`` with a broadcast hint if it is small, else as it is."""
    return F.broadcast(df) if is_small(df, most) else df


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by a total order; null keys are one key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest(df: DataFrame, keys: list[str], value: str, *order: str) -> DataFrame:
    """The last value of each key; aggregates before the shuffle, so a hot key costs little."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def preferred_source(first: DataFrame, second: DataFrame, key: str, *order: Column) -> DataFrame:
    """Rows of ``first``, one per key, and rows of ``second`` whose key ``first`` has not.

    Rows of ``second`` are not deduplicated; null keys of ``first`` are one key, those of ``second`` stay.
    """
    extra = second.join(first.where(F.col(key).isNotNull()).select(key).distinct(), key, "left_anti")
    return first_per_key(first, [key], *order).unionByName(extra.select(*first.columns))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new``, and of ``old`` those without a row in ``new``; null keys match nothing."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def without_keys(df: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not listed; null in a key matches null."""
    side = gone.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = [df[k].eqNullSafe(side[f"_{k}"]) for k in keys]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return df.join(side, condition, "left_anti")


def compared(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on keys where null matches null, with ``side``: left_only, right_only or both."""
    a = left.withColumn("_l", F.lit(True))
    b = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys], F.lit(True).alias("_r"))
    condition = a[keys[0]].eqNullSafe(b[f"_{keys[0]}"])
    for k in keys[1:]:
        condition = condition & a[k].eqNullSafe(b[f"_{k}"])
    side = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("both")
    both = a.join(b, condition, "full_outer").withColumn("side", side)
    values = [c for c in (*left.columns, *right.columns) if c not in keys]
    return both.select(*[F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) for k in keys], *values, "side")


def joined_back(df: DataFrame, found: DataFrame, row: list[str]) -> DataFrame:
    """``df`` with what was found for its rows; null in a row's key matches null."""
    side = found.withColumnsRenamed({r: f"_key_{r}" for r in row})
    condition = df[row[0]].eqNullSafe(F.col(f"_key_{row[0]}"))
    for r in row[1:]:
        condition = condition & df[r].eqNullSafe(F.col(f"_key_{r}"))
    return df.join(side, condition, "left").drop(*[f"_key_{r}" for r in row])


def longest_prefix(df: DataFrame, text: Column, names: DataFrame, key: str, target: str, rank: str, row: list[str], into: str = "matched", bounded: bool = False) -> DataFrame:
    """``df`` with the target whose key is the longest prefix of ``text`` ending at a word's end.

    Word prefixes are laid out and joined by equality, so no pair of row and name is tried in vain. Of
    equal keys the lower ``rank`` wins. ``row``: columns that together name a row of ``df``. No prefix is
    laid out that has more words than the longest name. ``bounded``: the caller knows that ``names`` is small.
    """
    words = F.split(text, " ")
    most_words = names.agg(F.max(F.size(F.split(key, " ")))).first()[0] or 1
    prefixes = F.transform(F.sequence(F.lit(1), F.least(F.size(words), F.lit(most_words))), lambda i: F.array_join(F.slice(words, 1, i), " "))
    laid = df.where(text.isNotNull() & (text != "")).select(*row, F.explode(F.array_distinct(prefixes)).alias("_prefix"))
    side = names.groupBy(F.col(key).alias("_prefix")).agg(F.min(F.struct(rank, target)).alias("_hit"))
    best = laid.join(F.broadcast(side) if bounded else small_side(side), "_prefix").groupBy(*row).agg(F.max_by(f"_hit.{target}", F.length("_prefix")).alias(into))
    return joined_back(df, best, row)


def longest_start(df: DataFrame, text: str, names: DataFrame, name: str, into: str = "matched", row: list[str] | None = None) -> DataFrame:
    """``df`` with the longest name its text starts with, whatever follows.

    Names are grouped by length; the text's start of each length is compared by equality, so the work is
    one hash lookup for each row and different length of a name (of which there are at most as many as the
    longest name has letters).
    """
    lengths = names.select(F.array_sort(F.collect_set(F.length(name)))).first()[0]
    known = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    starts = F.transform(F.filter(known, lambda n: n <= F.length(text)), lambda n: F.substring(F.col(text), F.lit(1), n))
    row = row or df.columns
    laid = df.select(*row, F.explode(starts).alias("_start")).distinct()
    side = names.select(F.col(name).alias("_start")).where("_start is not null").distinct()
    best = laid.join(small_side(side), "_start").groupBy(*row).agg(F.max_by("_start", F.length("_start")).alias(into))
    return joined_back(df, best, row)


def first_listed(df: DataFrame, tries: list[Column], known: DataFrame, key: str, target: str, row: list[str], into: str = "resolved") -> DataFrame:
    """``df`` with the target of the first of several tried texts that is known."""
    return first_listed_of(df, {into: tries}, known, key, target, row)


def first_listed_of(df: DataFrame, tries: dict[str, list[Column]], known: DataFrame, key: str, target: str, row: list[str]) -> DataFrame:
    """``df`` with, for each name, the target of the first of its tried texts that is known.

    All tries of all names are laid out with their place and joined once; the lowest place of a name wins.
    """
    every = F.array(*[F.struct(F.lit(n).alias("_name"), F.lit(i).alias("_place"), x.alias("_try")) for n, columns in tries.items() for i, x in enumerate(columns)])
    laid = df.select(*row, F.inline(every)).where("_try is not null and _try <> ''")
    side = known.where(F.col(target).isNotNull()).groupBy(F.col(key).alias("_try")).agg(F.min(target).alias("_target"))
    first = [F.min(F.when(F.col("_name") == n, F.struct("_place", "_target")))["_target"].alias(n) for n in tries]
    best = laid.join(small_side(side), "_try").groupBy(*row).agg(*first)
    return joined_back(df, best, row)


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has, with the count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def chunked(df: DataFrame, size: int, *order: Column) -> DataFrame:
    """``df`` with ``chunk``, batches of ``size`` rows by a total order.

    Places are counted by range partition and summed over partitions, so no task holds all rows.
    """
    ranked = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    from tidemark.session import cut

    ranked = cut(ranked)
    sizes = ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as partitions
    base = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranked.join(F.broadcast(base), "_part").withColumn("chunk", F.floor((F.col("_base") + place) / size)).drop("_part", "_base")


def top_with_share(df: DataFrame, key: str, most: int) -> DataFrame:
    """The most frequent values with rank, count and share of all rows; ties by value."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.select(F.count(F.lit(1)).alias("n")).first()["n"]
    top = counts.orderBy(F.col("n").desc(), F.col(key).asc_nulls_last()).limit(most)
    rank = F.row_number().over(Window.orderBy(F.col("n").desc(), F.col(key).asc_nulls_last()))  # over the top rows only
    return top.select(key, "n", rank.cast("bigint").alias("rank"), F.round(F.col("n") * 100.0 / total, 4).alias("pct"))


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls of every column, counted in one pass: ``(column_name, n_null)``."""
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("n_null")) for c in df.columns])
    return one.select(F.inline(pairs))
