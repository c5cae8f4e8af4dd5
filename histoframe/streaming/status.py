"""Live task status and hourly activity out of a stream of task events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from histoframe.operators.status import TASK
from histoframe.session import scratch_path


def event_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder as a stream, new ones picked up as they land."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def latest_status(events: DataFrame) -> DataFrame:
    """Streaming aggregate: the last state of every task.

    State is one row per task, so it is bounded by the ledger's keys.
    """
    last = F.max_by(F.struct("status", "ts", "event_id"), F.struct("ts", "event_id"))
    return events.groupBy(*TASK).agg(last.alias("last")).select(*TASK, "last.*")


def hourly_counts(events: DataFrame) -> DataFrame:
    """Events per stage and status in one-hour windows, however late they come.

    Without a watermark nothing is dropped; state is one row per hour, stage
    and status.
    """
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .groupBy(F.window("ts", "1 hour").alias("w"), "stage", "status")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("hour"), "stage", "status", "n")
    )


def _stage_table(spark: SparkSession, path: str, batch: int, kind: str, schema: StructType) -> DataFrame:
    """Rows of one kind that a batch has written; none before the first batch."""
    if batch < 0:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema.fields, StructField("kind", StringType())])).parquet(f"{path}/batch={batch}")
    return rows.filter(F.col("kind") == kind).drop("kind")


def hourly_with_late(events: DataFrame, delay: str, name: str = "hourly") -> tuple[DataFrame, DataFrame]:
    """Hourly counts whose state is released, and the rows that came too late for it: (counts, late).

    The watermark of a batch is the newest time of the batches before it less
    ``delay``. An hour that ends by then is closed: its count is written once
    and leaves the state, which holds open hours only. Rows of a closed hour
    go to ``late``, counted per batch, so counts and late rows together are
    every row. Both have hour, stage, status, n; ``late`` the batch as well.

    A batch reads nothing but its rows and the folder of the batch before,
    and writes one folder; a repeated batch writes the same one again.
    """
    spark = events.sparkSession
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).select(F.date_trunc("hour", "ts").alias("hour"), "stage", "status", "ts")
    schema = StructType([*[f for f in rows.schema.fields if f.name != "ts"], StructField("n", LongType())])
    key = ["hour", "stage", "status"]

    def write(batch: DataFrame, batch_id: int) -> None:
        before = batch.sparkSession.read.schema("newest timestamp").parquet(f"{path}-clock/batch={batch_id - 1}").first()[0] if batch_id else None
        mark = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        closed = F.coalesce(F.col("hour") + F.expr("INTERVAL 1 HOUR") <= mark, F.lit(False))
        seen = Observation()
        counted = batch.observe(seen, F.max("ts").alias("newest")).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        late = counted.filter(closed).select(*key, "n", F.lit("late").alias("kind"))
        state = _stage_table(batch.sparkSession, path, batch_id - 1, "open", schema)
        merged = state.unionByName(counted.filter(~closed)).groupBy(*key).agg(F.sum("n").alias("n"))
        kept = merged.withColumn("kind", F.when(closed, "closed").otherwise("open"))
        kept.unionByName(late).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        newest = max((t for t in (before, seen.get["newest"]) if t is not None), default=None)
        clock = batch.sparkSession.createDataFrame([(newest,)], "newest timestamp")
        clock.coalesce(1).write.mode("overwrite").parquet(f"{path}-clock/batch={batch_id}")

    query = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    written = StructType([*schema.fields, StructField("kind", StringType()), StructField("batch", IntegerType())])
    every = spark.read.option("basePath", path).schema(written).parquet(path)
    last = every.agg(F.max("batch")).first()[0]
    counts = every.filter((F.col("kind") == "closed") | ((F.col("kind") == "open") & (F.col("batch") == F.lit(last)))).select(*key, "n")
    return counts, every.filter("kind = 'late'").select(*key, "n", "batch")


def run_to_table(result: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Drain a streaming aggregate into a table and read its final state.

    Each batch appends its updated rows under its batch number; writing a
    batch again replaces the same folder, so a retry changes nothing. The
    newest batch of a key is its current value.
    """
    spark = result.sparkSession
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        result.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    )
    query.awaitTermination()
    schema = StructType([*result.schema.fields, StructField("batch", IntegerType())])
    rows = spark.read.option("basePath", path).schema(schema).parquet(path)
    rest = [c for c in result.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_v")).select(*keys, "_v.*")
