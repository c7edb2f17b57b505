"""Running sums that no single task holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Steps of the order that one group of the lower level holds.
WIDTH = 1_000


def sums_before(df: DataFrame, keys: list[str], order: str, values: dict[str, Column], width: int = WIDTH) -> DataFrame:
    """``df(keys, order, ...)``, one row for each key and step, with the sums of ``values`` over the earlier
    steps of its key (0 at the first).

    Steps are whole numbers from 0. They are summed by groups of ``width`` steps, groups are summed up to each
    group, and steps inside their group; so a key of any number of steps is split over as many tasks as it
    has groups, and one row for each group is the most that one task sees of a key.
    """
    df = df.withColumn("_group", F.floor(F.col(order) / width))
    names = list(values)
    groups = df.groupBy(*keys, "_group").agg(*[F.sum(v).alias(n) for n, v in values.items()])
    before = Window.partitionBy(*keys).orderBy("_group") if keys else Window.partitionBy(F.lit(0)).orderBy("_group")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(*keys, "_group", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_base_{n}") for n in names])
    inside = Window.partitionBy(*keys, "_group").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({f"_in_{n}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for n, v in values.items()})
    out = df.join(groups, [*keys, "_group"])
    return out.withColumns({n: F.col(f"_base_{n}") + F.col(f"_in_{n}") for n in names}).drop("_group", *[f"_{p}_{n}" for p in ("base", "in") for n in names])
