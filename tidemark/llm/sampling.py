"""Bounded samples that do not depend on how rows are laid out."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def sample_rows(rows: DataFrame, key: str, most: int) -> list[Row]:
    """At most ``most`` distinct rows, those with the lowest hashes of ``key``.

    Rows are counted and a threshold on the hash is set that lets a tenth more through; so about as many
    reach the driver as are asked for, whatever the number of partitions. Rows without a key are left out.
    """
    keyed = rows.where(F.col(key).isNotNull())
    total = keyed.select(key).count()
    share = min(1.0, (1.1 * most + 50) / max(1, total))
    low = int(-(2**63) + share * (2**64 - 1))
    hashed = keyed.withColumn("_hash", F.xxhash64(key))
    found = hashed.where(F.col("_hash") <= F.lit(min(low, 2**63 - 1))).distinct().collect()
    return sorted(found, key=lambda r: (r["_hash"], str(r)))[:most]


def quotas(sizes: dict[str, int], most: int) -> dict[str, int]:
    """How many rows each group gives so that about ``most`` are drawn: equal parts, and what small groups
    leave over goes to the larger ones. No group is left without a row."""
    out, left = {}, most
    for k, (group, n) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        out[group] = min(n, max(1, left // (len(sizes) - k)))
        left -= out[group]
    return out


def sample_groups(rows: DataFrame, key: str, group: str, most: int, most_groups: int = 1000) -> list[Row]:
    """At most ``most`` distinct rows spread evenly over the groups, in each those with the lowest hashes
    of ``key``; a group with few rows gives all of them.

    Keys are counted by group and each group has its threshold on the hash, as in ``sample_rows``. Rows
    without a key or group are left out; more groups than ``most_groups`` or ``most`` is an error.
    """
    keyed = rows.where(F.col(key).isNotNull() & F.col(group).isNotNull())
    bound = min(most, most_groups)
    sizes = {r[0]: r[1] for r in keyed.groupBy(group).agg(F.countDistinct(key)).limit(bound + 1).collect()}
    if len(sizes) > bound:
        raise ValueError(f"more than {bound:,} groups")
    wanted = quotas(sizes, most)
    lows = [(g, int(-(2**63) + min(1.0, (q + 4 * math.sqrt(q) + 10) / sizes[g] if q < sizes[g] else 1.0) * (2**64 - 1))) for g, q in wanted.items()]
    side = rows.sparkSession.createDataFrame([(g, min(low, 2**63 - 1)) for g, low in lows], "_group string, _low bigint")
    hashed = keyed.withColumn("_hash", F.xxhash64(key)).join(F.broadcast(side), F.col(group) == F.col("_group"))
    drawn: dict[str, list[Row]] = {g: [] for g in wanted}
    for r in hashed.where("_hash <= _low").drop("_group", "_low").distinct().collect():
        drawn[r[group]].append(r)
    kept = [r for g, found in drawn.items() for r in sorted(found, key=lambda r: (r["_hash"], str(r)))[: wanted[g]]]
    return sorted(kept, key=lambda r: (r["_hash"], str(r)))
