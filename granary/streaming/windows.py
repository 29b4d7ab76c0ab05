"""Event-time windows over live events, what came too late for them, and joins of two streams.

An arrival is closed off by the watermark: the latest event time that earlier micro-batches have seen, less a
delay. A window is final, and appended, once the watermark has passed its end; an event whose windows
are all final is late and goes to a table of its own instead of vanishing.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from granary.streaming.keyed_state import state_settings

TIME = "event_time"


def _watermarked(events: DataFrame, time: str, delay: str) -> DataFrame:
    """Watermarks need points in time: local times are read in the session's time zone, and given back in it."""
    return events.where(F.col(time).isNotNull()).withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def _totals(events: DataFrame, window: Column, keys: Sequence[str], delay: str) -> DataFrame:
    dated = _watermarked(events, TIME, delay)
    totals = dated.groupBy(window.alias("_window"), *keys).agg(
        F.count(F.lit(1)).alias("events"), F.sum("units_donated").cast("long").alias("units"))
    start, end = [F.col(f"_window.{c}").cast("timestamp_ntz").alias(f"window_{c}") for c in ("start", "end")]
    return totals.select(*keys, start, end, "events", "units")


def tumbling(events: DataFrame, keys: Sequence[str], length: str, delay: str) -> DataFrame:
    """Events and units per key and window; windows of equal length, one after the other."""
    return _totals(events, F.window(TIME, length), keys, delay)


def sliding(events: DataFrame, keys: Sequence[str], length: str, step: str, delay: str) -> DataFrame:
    """The same for windows that overlap: an event counts in each window that is not final yet."""
    return _totals(events, F.window(TIME, length, step), keys, delay)


def sessions(events: DataFrame, keys: Sequence[str], gap: str, delay: str) -> DataFrame:
    """The same for runs of events of a key, ended by a pause of at least ``gap``."""
    return _totals(events, F.session_window(TIME, gap), keys, delay)


def append_final(totals: DataFrame, path: str, checkpoint: str, name: str) -> StreamingQuery:
    """Append final rows to Parquet until what has arrived is read; open windows stay in the state store and are
    carried on by the next run."""
    with state_settings(totals.sparkSession):
        return (
            totals.writeStream.format("parquet").outputMode("append").queryName(name)
            .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )


def divert_late(events: DataFrame, length: str, delay: str, late: str, checkpoint: str, name: str) -> StreamingQuery:
    """Write the events that ``tumbling`` of the same length and delay does not count, with the watermark they missed.

    The watermark of a batch follows from the latest times of earlier batches, one row each in a table beside
    the late rows. A batch owns its folder in both and replaces it whole, so a replay changes nothing.
    """
    spark, seen = events.sparkSession, f"{late.rstrip('/')}_seen"

    def low_water(batch_id: int) -> Column:
        try:
            past = spark.read.schema("latest timestamp_ntz, batch_id long").parquet(seen)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return F.lit(None).cast("timestamp_ntz")
        latest = past.where(F.col("batch_id") < batch_id).agg(F.max("latest")).first()[0]  # one row per batch
        return F.date_trunc("millisecond", F.lit(latest).cast("timestamp_ntz")).cast("timestamp_ntz") - F.expr(f"interval {delay}")

    def handle(batch: DataFrame, batch_id: int) -> None:
        dated = batch.where(F.col(TIME).isNotNull())
        missed = dated.withColumn("low_water", low_water(batch_id)).where(F.window(TIME, length).getField("end") <= F.col("low_water"))
        missed.write.mode("overwrite").parquet(f"{late.rstrip('/')}/batch_id={batch_id}")
        dated.agg(F.max(TIME).alias("latest")).write.mode("overwrite").parquet(f"{seen}/batch_id={batch_id}")

    return (
        events.writeStream.foreachBatch(handle).queryName(name)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def with_follow_up(events: DataFrame, later: DataFrame, key: str, within: str, delay: str) -> DataFrame:
    """Every event with the later one of the same key that comes within some time of it, or with none.

    Both streams are watermarked, so an event leaves the state, without a partner if none came, once
    partners that might still come would be late. ``later`` has ``key``, ``later_time`` and other columns.
    """
    left = _watermarked(events.where(F.col(key).isNotNull()), TIME, delay)
    right = _watermarked(later.withColumnRenamed(key, "_key"), "later_time", delay)
    near = (F.col(key) == F.col("_key")) & (F.col("later_time") >= F.col(TIME)) & (F.col("later_time") <= F.col(TIME) + F.expr(f"interval {within}"))
    met = left.join(right, near, "left_outer").drop("_key")
    return met.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (TIME, "later_time")})
