"""Incremental extraction: only what is new since the last run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histoframe.operators import patches as G
from histoframe.session import scratch_path


def incremental_extract(
    arrivals: DataFrame, pixels_of: Callable[[DataFrame], DataFrame], slides: DataFrame, panel: DataFrame, size: int, stride: int,
    path: str, checkpoint: str,
) -> None:
    """Mean-marker features of newly arrived slides: every patch and every panel channel (slide_id, idx), 0 where blank.

    ``arrivals`` streams rows with slide_id. The checkpoint remembers what
    was processed, so a second run does only later arrivals. A batch has its
    own folder, which a repeated batch writes anew; of a slide that arrives
    again the last batch counts (``read_extracted``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        new = batch.select("slide_id").distinct()
        mine = slides.join(new, "slide_id", "left_semi")
        values = G.feature_long(G.mean_marker(pixels_of(new), mine, panel, size, stride))
        values.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = arrivals.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()


def read_extracted(spark: SparkSession, path: str) -> DataFrame:
    """(slide_id, patch_id, c, value) of every slide, out of its last batch."""
    stored = spark.read.schema("slide_id int, patch_id int, c int, value double, batch bigint").parquet(path)
    last = stored.groupBy("slide_id").agg(F.max("batch").alias("batch"))
    return stored.join(last, ["slide_id", "batch"]).select("slide_id", "patch_id", "c", "value")


def extract_once(
    arrivals: DataFrame, pixels_of: Callable[[DataFrame], DataFrame], slides: DataFrame, panel: DataFrame, size: int, stride: int
) -> DataFrame:
    """Drain the arrivals and read all features written so far."""
    spark = arrivals.sparkSession
    path, checkpoint = scratch_path(spark, "extract"), scratch_path(spark, "extract-checkpoint")
    incremental_extract(arrivals, pixels_of, slides, panel, size, stride, path, checkpoint)
    return read_extracted(spark, path)
