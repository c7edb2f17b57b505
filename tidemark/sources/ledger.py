"""Append-only ledgers where the last row of a key counts, and files put in place whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.relational import first_per_key, latest
from tidemark.session import cut
from tidemark.sources.store import Store

MANIFEST = "gazette_date string, gazette_id string, gazette_type string, filename string, url string, status string"
PARSE_LOG = "filename string, gazette_date string, gazette_id string, gazette_type string, record_count bigint, vn_count bigint, status string"


def _placed(spark: SparkSession, path: str) -> tuple[Store, str]:
    folder, _, name = path.rpartition("/")
    return Store(spark, folder or "."), name


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A ledger with ``line_no``, its order (small files, one line a row); a missing one is empty."""
    store, name = _placed(spark, path)
    if not store.exists(name):
        return spark.createDataFrame([], schema + ", line_no bigint")
    lines = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return lines.coalesce(1).withColumn("line_no", F.monotonically_increasing_id())


def write_csv(df: DataFrame, path: str) -> None:
    """A table as one CSV file, all quoted, put in place by renaming; rows in their order. The one file is
    written by a task, nothing passes through the driver; an empty table gives the header alone."""
    store, name = _placed(df.sparkSession, path)
    parts = f"_{name}.parts"
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    w = text.coalesce(1).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').option("lineSep", "\r\n").option("emptyValue", "").option("nullValue", "")
    w.csv(f"{path.rpartition('/')[0] or '.'}/{parts}")
    written = [key for key, size in store.listed(parts, "part-*.csv") if size]
    if written:
        store.replace(written[0], name)
    else:
        store.write(name, (",".join(f'"{c}"' for c in df.columns) + "\r\n").encode())
    store.delete(parts)


def append_csv(df: DataFrame, path: str, schema: str) -> None:
    """Add rows to a ledger, with a header if it is new; the ledger is written anew and renamed, so a reader
    never meets half of it."""
    spark = df.sparkSession
    store, name = _placed(spark, path)
    if not store.exists(name):
        write_csv(df, path)
        return
    old = read_csv(spark, path, schema).withColumn("_new", F.lit(0))
    names = [c for c in old.columns if c not in ("line_no", "_new")]
    fresh = df.select(*[F.col(c).cast(old.schema[c].dataType) if c in df.columns else F.lit(None).cast(old.schema[c].dataType).alias(c) for c in names])
    fresh = fresh.coalesce(1).withColumns({"line_no": F.monotonically_increasing_id(), "_new": F.lit(1)})
    write_csv(cut(old.unionByName(fresh)).coalesce(1).sortWithinPartitions("_new", "line_no").select(*names), path)


def append_sorted(old: DataFrame | None, new: DataFrame, path: str, date: str = "gazette_date", key: str = "vacancy_no") -> None:
    """Old and new rows together, by date and key with nulls last, as parquet that replaces what was there."""
    both = new if old is None else old.unionByName(new, allowMissingColumns=True)
    store, name = _placed(new.sparkSession, path)
    fresh = f"_{name}.new"
    both.orderBy(F.col(date).asc_nulls_last(), F.col(key).asc_nulls_last()).write.mode("overwrite").parquet(f"{path.rpartition('/')[0] or '.'}/{fresh}")
    store.replace(fresh, name)


def settled_manifest(rows: DataFrame) -> DataFrame:
    """The last row for each date and type, in order."""
    return first_per_key(rows, ["gazette_date", "gazette_type"], F.col("line_no").desc()).orderBy("gazette_date", "gazette_type")


def done_files(log: DataFrame) -> DataFrame:
    """Files whose latest status is ``parsed``."""
    return latest(log, ["filename"], "status", "line_no").where("status = 'parsed'").select("filename")


def compacted(log: DataFrame) -> DataFrame:
    """The last row for each file, by date and file."""
    return first_per_key(log, ["filename"], F.col("line_no").desc()).orderBy("gazette_date", "filename")


def pending_files(manifest: DataFrame, log: DataFrame, types: list[str], most: int | None = None) -> DataFrame:
    """Downloaded files of the parsed types that are not done, oldest first; ``most`` is a batch's size."""
    rows = manifest.where((F.col("status") == "downloaded") & F.col("gazette_type").isin(types))
    rows = rows.join(done_files(log), "filename", "left_anti").orderBy("gazette_date", "filename")
    return rows.limit(most) if most else rows
