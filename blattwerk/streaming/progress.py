"""Structured Streaming over progress events and event tables.

Every function takes a streaming or a static frame and returns one; the caller starts the query. Sinks that
keep one row a key (latest wins, last lines) go through ``foreachBatch`` and a table, so a lost executor or a
restart replays from the checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blattwerk.sources.parse import progress


def event_stream(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    """Lines of JSON files as they arrive; whole lines only, which the file source sees to."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)


def table_stream(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A folder of Parquet files as a stream with the columns of ``like``."""
    return spark.readStream.schema(like.schema).parquet(path)


def progress_events(lines: DataFrame, col: str = "value") -> DataFrame:
    """Known progress events of JSON lines; other lines, types and fields are passed over."""
    return lines.select(progress(F.col(col)).alias("e")).where("e IS NOT NULL").select("e.*")


def progress_totals(events: DataFrame) -> DataFrame:
    """``pages, derailed, seconds, of`` so far; a running aggregate (output mode complete or update)."""
    page = F.col("kind") == "page"
    return events.agg(F.count_if(page).alias("pages"), F.count_if(page & F.col("derailed")).alias("derailed"), F.sum(F.when(page, F.col("seconds"))).alias("seconds"), F.max("of").alias("of"))


def debounced(events: DataFrame, ts: str, key: str, gap: str = "500 milliseconds", late: str = "10 minutes") -> DataFrame:
    """``key, start, end, events`` of bursts: what follows within ``gap`` is one burst. Late rows are taken up to ``late``."""
    e = events.withWatermark(ts, late) if events.isStreaming else events
    w = F.session_window(ts, gap)
    return e.groupBy(key, w.alias("w")).agg(F.count(F.lit(1)).alias("events")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def windowed(events: DataFrame, ts: str, length: str, slide: str | None = None, late: str = "1 hour", by: tuple[str, ...] = ()) -> DataFrame:
    """``start, end`` and number of events of tumbling or sliding windows, with a watermark on streams."""
    e = events.withWatermark(ts, late) if events.isStreaming else events
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    return e.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("events")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "events")


def latest_wins(requests: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """``key, value`` of the last request of each key: those before it are dropped."""
    return requests.groupBy(key).agg(F.max_by(value, F.struct(at, value)).alias(value))


def last_lines(lines: DataFrame, key: str, at: str, n: int = 5) -> DataFrame:
    """The last ``n`` lines of each channel. On streams call it on each micro-batch (see :func:`keep_latest`)."""
    return lines.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(at)))).where(F.col("_r") <= n).drop("_r")


def keep_latest(target: str, key: str, at: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that keeps the last row of each key in the Parquet folder ``target``.

    Each batch writes a folder of its own number and rewrites nothing that is read, so a replayed batch gives
    the same state. ``current(spark, target)`` reads it.
    """

    def write(batch: DataFrame, number: int) -> None:
        order = Window.partitionBy(key).orderBy(F.desc(at))
        batch.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r").write.mode("overwrite").parquet(f"{target}/batch={number}")

    return write


def current(spark: SparkSession, target: str, key: str, at: str) -> DataFrame:
    rows = spark.read.parquet(target)
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(at), F.desc("batch")))).where("_r = 1").drop("_r")


def until_cancelled(pages: DataFrame, key: str, order: str, cancelled: Column) -> DataFrame:
    """The pages of each run before its first cancelled one: what a graceful cancel leaves."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return pages.withColumn("_c", F.max(F.coalesce(cancelled, F.lit(False)).cast("int")).over(w)).where("_c = 0").drop("_c")


def drain(stream: DataFrame, name: str, folder: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there into a table in memory and returns it: for tests and replays."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", folder).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)
