"""Incremental ingestion by Structured Streaming.

Files are found once by the file source's checkpoint; each micro-batch writes its rows before its log
rows, both under the batch's number, so a batch run again replaces itself. Files that failed are tried
again from the log, as a file source never offers a file twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.notices import marker_count, parse_gazette
from tidemark.session import cut
from tidemark.sources.documents import extracted
from tidemark.sources.ledger import pending_files


def file_stream(spark: SparkSession, folder: str, most: int = 100) -> DataFrame:
    """Text files as a stream of ``(path, text)``, at most so many in a batch."""
    stream = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", most).load(folder)
    return stream.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def write_batch(target: str, log: str) -> Callable[[DataFrame, int], None]:
    """Writes a batch's parsed rows, then its log rows; written again under the same number it replaces itself."""
    def write(batch: DataFrame, number: int) -> None:
        rows = parse_gazette(batch, "path", "text").withColumn("batch", F.lit(number))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)
        spark = batch.sparkSession
        written = spark.read.parquet(target).where(F.col("batch") == number).groupBy("path").agg(F.count(F.lit(1)).alias("record_count"))
        told = batch.select("path", marker_count(F.col("text")).alias("vn_count")).join(written, "path", "left")
        told = told.withColumns({"record_count": F.coalesce("record_count", F.lit(0)), "status": F.lit("parsed"), "batch": F.lit(number)})
        told.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(log)

    return write


def ingest(spark: SparkSession, folder: str, target: str, log: str, checkpoint: str, most: int = 100) -> StreamingQuery:
    """Parse all files not seen yet and stop."""
    stream = file_stream(spark, folder, most)
    return stream.writeStream.foreachBatch(write_batch(target, log)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def quarter_counts(events: DataFrame, time: str, key: str, late: str = "28 days") -> DataFrame:
    """Counts by day, calendar quarter and key of a stream; events later than ``late`` are left out.

    A calendar quarter is no window of fixed length, so days are the windows by which the watermark drops
    state: what is held is ``late`` and no more. Write in ``update`` mode and sum with ``quarter_totals``.
    """
    quarter = F.date_trunc("QUARTER", time)
    return events.withWatermark(time, late).groupBy(F.window(time, "1 day")["start"].alias("day"), quarter.alias("quarter"), key).agg(F.count(F.lit(1)).alias("n"))


def quarter_totals(updates: DataFrame, key: str, batch: str = "batch") -> DataFrame:
    """Counts by quarter and key from the written updates: of each day the last batch counts."""
    days = updates.groupBy("day", "quarter", key).agg(F.max_by("n", batch).alias("n"))
    return days.groupBy(F.to_date("quarter").alias("quarter"), key).agg(F.sum("n").alias("n"))


def first_seen(events: DataFrame, keys: list[str], time: str, late: str = "28 days") -> DataFrame:
    """Each key's first event of a stream, keys being remembered for ``late``."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def parse_pending(manifest: DataFrame, log: DataFrame, files: DataFrame, extract: Callable[[bytes], str], types: list[str], most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """One batch from the ledger: rows parsed of the files still pending, and the log rows to append.

    ``files(filename, content)`` are the files at hand. A pending file that is not there is logged as
    ``missing_pdf``, one that cannot be read as ``error``; both come up again, as only ``parsed`` settles a
    file. Write the rows before the log: a run that stops between the two parses the files again.
    """
    wanted = pending_files(manifest, log, types, most)
    have = cut(extracted(wanted.select("filename").join(files, "filename").select(F.col("filename").alias("path"), "content"), extract))
    texts = have.where("status = 'parsed'").join(wanted.withColumnRenamed("filename", "path"), "path").select("path", "text", "gazette_id", F.col("gazette_date").cast("timestamp").alias("gazette_date"), "gazette_type")
    rows = parse_gazette(texts, "path", "text").join(texts.select("path", "gazette_id", "gazette_date", "gazette_type", marker_count(F.col("text")).alias("raw_vn_count")), "path")
    counts = rows.groupBy("path").agg(F.count(F.lit(1)).alias("record_count"))
    told = wanted.select("filename", "gazette_date", "gazette_id", "gazette_type").join(have.select(F.col("path").alias("filename"), F.col("status").alias("_status"), marker_count(F.col("text")).alias("vn_count")), "filename", "left")
    told = told.join(counts.withColumnRenamed("path", "filename"), "filename", "left")
    entries = told.select(
        "filename", "gazette_date", "gazette_id", "gazette_type", F.coalesce("record_count", F.lit(0)).alias("record_count"), F.coalesce("vn_count", F.lit(0)).alias("vn_count"),
        F.coalesce("_status", F.lit("missing_pdf")).alias("status"),
    )
    return rows, entries


def dropped(log: DataFrame) -> DataFrame:
    """Files of which fewer notices were parsed than they announce."""
    return log.where("status = 'parsed' and record_count <> vn_count").select("filename", "record_count", "vn_count")
