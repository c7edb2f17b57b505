"""Calendar of a weekly gazette and the file names to look for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def issue_number(date: Column) -> Column:
    """Number of the issue: that of the next Thursday's week of the year."""
    thursday = F.date_add(date, F.pmod(F.lit(3) - F.weekday(date), F.lit(7)).cast("int"))
    return F.ceil(F.dayofyear(thursday) / 7).cast("int")


def encoded(name: Column) -> Column:
    """A file name for a URL: blanks become plus signs, all else stays."""
    return F.replace(name, F.lit(" "), F.lit("+"))


def source_type(name: Column) -> Column:
    """Type of a file by parts of its name, the first that fits."""
    low = F.lower(name)
    return (
        F.when(F.contains(low, F.lit("daily")), "daily").when(F.contains(low, F.lit("vacancy")) | F.contains(low, F.lit("vacancies")), "weekly_vacancy")
        .when(F.contains(low, F.lit("outcome")), "weekly_outcome").when(F.contains(low, F.lit("weekly")), "weekly_old").otherwise("unknown")
    )


def business_days(spark: SparkSession, first: str, last: str) -> DataFrame:
    """``day``: all days from Monday to Friday in a range, its ends included."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    return days.where(F.weekday("day") < 5)


def candidates(days: DataFrame, day: str, templates_weekly: list[str], template_daily: str) -> DataFrame:
    """File names to try for each day, ``(day, ord, filename, url_name)``: the issue number and its
    neighbours, the weekly names on Thursdays and the daily one else; each name once, at its first place.

    Templates have the places ``{n}`` and ``{date}``; numbers start at 1.
    """
    offsets = F.posexplode(F.array(*[F.lit(x) for x in (0, -1, 1, -2, 2)])).alias("_o", "_offset")
    rows = days.select(F.col(day).alias("day"), offsets).withColumn("_n", F.greatest(F.lit(1), issue_number(F.col("day")) + F.col("_offset")))
    names = F.when(F.weekday("day") == 3, F.array(*[F.lit(t) for t in templates_weekly])).otherwise(F.array(F.lit(template_daily)))
    rows = rows.select("day", "_o", "_n", F.posexplode(names).alias("_k", "_t"))
    filled = F.replace(F.replace("_t", F.lit("{n}"), F.col("_n").cast("string")), F.lit("{date}"), F.date_format("day", "yyyy-MM-dd"))
    rows = rows.withColumn("filename", filled).groupBy("day", "filename").agg(F.min(F.struct("_o", "_k")).alias("_at"))
    place = F.row_number().over(Window.partitionBy("day").orderBy("_at"))  # at most 20 names a day
    return rows.select("day", place.alias("ord"), "filename", encoded(F.col("filename")).alias("url_name"))


def to_probe(days: DataFrame, manifest: DataFrame, today: str, again_days: int = 28, floor: str = "2020-01-01") -> DataFrame:
    """Days still to be looked for: not in the manifest, or only as not found and still young enough."""
    settled = (F.col("status") != "not_found") | (F.col("gazette_date").cast("date") < F.date_sub(F.lit(today).cast("date"), again_days))
    done = manifest.where(settled).select(F.col("gazette_date").cast("date").alias("day")).distinct()
    return days.where(F.col("day") >= F.lit(floor).cast("date")).join(done, "day", "left_anti")


def probed(manifest: DataFrame, found: DataFrame, tried: DataFrame) -> DataFrame:
    """The manifest after a round: found files replace their day's mark, days without any get one."""
    old = manifest.join(found.select("gazette_date").distinct(), "gazette_date", "left_anti") if manifest is not None else found.limit(0)
    kept = manifest.join(found.select("gazette_date").distinct(), "gazette_date", "left_semi").where("status <> 'not_found'")
    empty = tried.select(F.col("day").cast("string").alias("gazette_date")).join(found.select("gazette_date").distinct(), "gazette_date", "left_anti")
    marks = empty.join(old.select("gazette_date").distinct(), "gazette_date", "left_anti").select("gazette_date", F.lit(None).cast("string").alias("gazette_id"), F.lit("none").alias("gazette_type"), F.lit(None).cast("string").alias("filename"), F.lit(None).cast("string").alias("url"), F.lit("not_found").alias("status"))
    return old.unionByName(kept).unionByName(found).unionByName(marks).select("gazette_date", "gazette_id", "gazette_type", "filename", "url", "status")
