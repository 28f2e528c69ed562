"""Structured Streaming forms of the batch operators: logs that resume, micro-batches, windows over event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def files(spark: SparkSession, path: str, schema: str, form: str = "json", per_batch: int | None = None) -> DataFrame:
    """New files of a folder as a stream; each is read once, whole."""
    r = spark.readStream.schema(schema).format(form)
    return (r.option("maxFilesPerTrigger", per_batch) if per_batch else r).load(path)


def once_per_id(rows: DataFrame, key: str, at: str | None = None, late: str = "1 hour") -> DataFrame:
    """Rows whose id has not come before; with an event time ``at``, ids are forgotten once they are too old to come again."""
    if at is None:
        return rows.dropDuplicates([key])
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def unprocessed(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of a stream whose id a finished table does not have."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def event_windows(events: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """``(start, event_type, n, total)`` of tumbling (or sliding) windows over ``ts``."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    g = events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """``(user_id, start, end, n)`` of each user's sessions: runs of events no further apart than ``gap``."""
    g = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def append_to(rows: DataFrame, path: str, checkpoint: str, form: str = "parquet") -> StreamingQuery:
    """Runs what there is to its end, each row once, whatever is restarted in between."""
    return rows.writeStream.format(form).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start(path)


def in_batches(rows: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hands each micro-batch to ``work`` with its number, by which ``work`` can tell a repeated one."""
    return rows.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def quiet(query: StreamingQuery, batches: int = 1) -> bool:
    """True once the last ``batches`` progress reports brought no rows."""
    seen = query.recentProgress[-batches:]
    return len(seen) == batches and all(p["numInputRows"] == 0 for p in seen)
