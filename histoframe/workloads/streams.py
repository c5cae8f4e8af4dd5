"""Structured Streaming queries over the given tables as arriving files."""

from __future__ import annotations

from pyspark.sql import functions as F

from histoframe.session import scratch_path
from histoframe.streaming import extract as SE
from histoframe.streaming import status as SS
from histoframe.workloads import inputs as I
from histoframe.workloads import workload
from histoframe.workloads.patches import TILE, image_panel, mean_sql
from histoframe.workloads.status import LATEST


def _events(spark, sf):
    raw = SS.event_stream(spark, sf, I.table(spark, sf, "events").schema, "events.parquet")
    return raw.select(*I.task_columns())


@workload("live_status", f"WITH {LATEST} SELECT slide_id, stage, task_key, status, ts, event_id FROM latest")
def live_status(spark, sf):
    """Final state of the stream; must equal the batch answer."""
    return SS.run_to_table(SS.latest_status(_events(spark, sf)), SS.TASK, "live-status")


@workload(
    "live_status_hourly",
    "SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour, stage, status, COUNT(*) AS n FROM task_events GROUP BY 1, 2, 3",
)
def live_status_hourly(spark, sf):
    out = SS.run_to_table(SS.hourly_counts(_events(spark, sf)), ["hour", "stage", "status"], "live-hourly")
    return out.withColumn("hour", F.unix_timestamp("hour"))


@workload(
    "live_hourly_released",
    "SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour, stage, status, COUNT(*) AS n FROM task_events GROUP BY 1, 2, 3",
)
def live_hourly_released(spark, sf):
    """Events in eight files out of order: counts of closed and open hours and late rows together are the batch answer."""
    folder = scratch_path(spark, "arrivals")
    events = I.table(spark, sf, "events")
    events.repartition(8, F.col("event_id") % 8).write.parquet(folder)
    arriving = SS.event_stream(spark, folder, events.schema, files_per_batch=2).select(*I.task_columns())
    counts, late = SS.hourly_with_late(arriving, "2 HOURS")
    every = counts.unionByName(late.drop("batch")).groupBy("hour", "stage", "status").agg(F.sum("n").alias("n"))
    return every.withColumn("hour", F.unix_timestamp("hour"))


@workload("incremental_extract", f"WITH {mean_sql(TILE, TILE)} SELECT slide_id, patch_id, c, ROUND(value, 6) AS value FROM long")
def incremental_extract(spark, sf):
    """Slides arrive as a stream of the supplier table."""
    raw = SS.event_stream(spark, sf, I.table(spark, sf, "supplier").schema, "supplier.parquet")
    arrivals = raw.select(F.col("s_suppkey").cast("int").alias("slide_id"))
    pixels = I.pixels(spark, sf)
    out = SE.extract_once(
        arrivals, lambda new: pixels.join(new, "slide_id", "left_semi"), I.slides(spark, sf), image_panel(spark, sf), TILE, TILE
    )
    return out.withColumn("value", F.round("value", 6))
