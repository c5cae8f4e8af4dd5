"""Task ledger, cohort status and reconciliation tables.

The ledger is append-only; "latest" is always ``max_by`` over (ts, event_id),
an aggregate with map-side combine, so a task with very many events never
sits in one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histoframe.functions import numeric as X

STAGES = ("ingest", "tissue", "cells", "patch", "extract")
SCALAR_STAGES = ("ingest", "cells")
DOWNSTREAM_STAGES = ("tissue", "cells", "patch", "extract")
TASK = ["slide_id", "stage", "task_key"]

# Age at which a running task counts as dead, and the tissue
# method taken when several are present and none is asked for.
STALE_HOURS = 24
DEFAULT_TISSUE_METHOD = "otsu"


def latest_tasks(ledger: DataFrame) -> DataFrame:
    """Current state of every task."""
    rest = [c for c in ledger.columns if c not in (*TASK, "ts", "event_id")]
    last = F.max_by(F.struct("ts", "event_id", *rest), F.struct("ts", "event_id")).alias("last")
    return ledger.groupBy(*TASK).agg(last).select(*TASK, "last.*")


def stage_rollup(tasks: DataFrame, slides: DataFrame) -> DataFrame:
    """One status per slide and stage: error, running, all completed, pending.

    A stage without tasks is pending; the error is that of the first failed
    key.
    """
    status = F.col("status")
    rolled = tasks.groupBy("slide_id", "stage").agg(
        F.count(F.lit(1)).alias("n_tasks"),
        F.bool_or(status == "error").alias("_err"),
        F.bool_or(status == "running").alias("_run"),
        F.bool_and(status == "completed").alias("_done"),
        F.min_by("error", F.when(status == "error", F.col("task_key"))).alias("error"),
    )
    verdict = (
        F.when(F.col("_err"), F.lit("error"))
        .when(F.col("_run"), F.lit("running"))
        .when(F.col("_done"), F.lit("completed"))
        .otherwise(F.lit("pending"))
    )
    every = slides.select("slide_id", F.explode(F.array(*[F.lit(s) for s in STAGES])).alias("stage"))
    return every.join(rolled, ["slide_id", "stage"], "left").select(
        "slide_id", "stage", verdict.alias("status"), F.coalesce("n_tasks", F.lit(0)).cast("bigint").alias("n_tasks"), "error"
    )


def missing_outputs(tasks: DataFrame, listing: DataFrame) -> DataFrame:
    """Completed tasks whose recorded output is not in the listing."""
    done = tasks.filter("status = 'completed'").select(*TASK, F.col("output").alias("path"))
    return done.join(listing.select("slide_id", "path"), ["slide_id", "path"], "left_anti").select(*TASK, "path")


def exploded_outputs(tasks: DataFrame) -> DataFrame:
    """One row per recorded output of tasks that keep them as a map."""
    return tasks.select(*TASK, "status", F.explode("outputs").alias("output_name", "output"))


def orphan_groups(groups: DataFrame, tasks: DataFrame) -> DataFrame:
    """Output groups on disk without a completed task."""
    done = tasks.filter("status = 'completed'").select(*TASK)
    return groups.select(*TASK).distinct().join(done, TASK, "left_anti")


def drift_messages(tasks: DataFrame, listing: DataFrame, groups: DataFrame) -> DataFrame:
    """Both directions of drift as messages."""
    label = F.when(F.col("stage").isin(*SCALAR_STAGES), F.col("stage")).otherwise(
        F.concat("stage", F.lit("["), "task_key", F.lit("]"))
    )
    gone = missing_outputs(tasks, listing).select(
        "slide_id", F.concat(label, F.lit(": completed but '"), "path", F.lit("' missing")).alias("message")
    )
    extra = orphan_groups(groups, tasks).select(
        "slide_id", F.concat(label, F.lit(": present but not completed")).alias("message")
    )
    return gone.unionByName(extra)


def issue_list(rollup: DataFrame, drift: DataFrame) -> DataFrame:
    """One row per errored stage and per drift message."""
    errors = rollup.filter("status = 'error'").select(
        "slide_id", F.lit("error").alias("kind"), F.concat("stage", F.lit(": "), F.coalesce("error", F.lit("?"))).alias("message")
    )
    return errors.unionByName(drift.select("slide_id", F.lit("drift").alias("kind"), "message"))


def cohort_status(rollup: DataFrame, drift: DataFrame) -> DataFrame:
    """Slide by stage table with the number of drift messages."""
    wide = rollup.groupBy("slide_id").pivot("stage", list(STAGES)).agg(F.first("status"))
    counts = drift.groupBy("slide_id").agg(F.count(F.lit(1)).alias("n_drift"))
    return wide.join(counts, "slide_id", "left").fillna(0, ["n_drift"])


def stage_done_counts(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("stage").agg(
        F.count_if(F.col("status") == "completed").alias("n_done"), F.count(F.lit(1)).alias("n_slides")
    )


def cohort_tally(status: DataFrame) -> DataFrame:
    """Slides, drift issues and errored stages of the cohort."""
    errors = sum((F.col(s) == "error").cast("int") for s in STAGES)
    return status.agg(
        F.count(F.lit(1)).alias("n_slides"), F.sum("n_drift").alias("n_drift"), F.sum(errors).alias("n_errors")
    )


def work_list(wanted: DataFrame, tasks: DataFrame, listing: DataFrame) -> DataFrame:
    """Wanted tasks still to run.

    Done means completed and, for the stages with a load-bearing output,
    that output present; a deleted output runs again.
    """
    present = listing.select("slide_id", F.col("path").alias("output")).withColumn("_there", F.lit(True))
    done = (
        tasks.filter("status = 'completed'")
        .join(present, ["slide_id", "output"], "left")
        .filter(F.col("_there").isNotNull() | (F.col("stage") == "extract"))
        .select(*TASK)
    )
    return wanted.select(*TASK).join(done, TASK, "left_anti")


def fold_runs(events: DataFrame) -> DataFrame:
    """Runs out of appended start and finish rows; the last row of a run wins."""
    last = F.max_by(F.struct("status", "finished_at", "error"), F.col("seq")).alias("last")
    runs = events.groupBy("run_id").agg(
        F.min_by("tool", "seq").alias("tool"), F.min_by("started_at", "seq").alias("started_at"), F.min_by("args", "seq").alias("args"), last
    )
    return runs.select("run_id", "tool", "started_at", "args", "last.*")


def json_args(*cols: Column | str) -> Column:
    """Run arguments as JSON text; unknown types are written as text."""
    return F.to_json(F.struct(*cols))


def newest_first(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id"))


def with_duration(tasks: DataFrame) -> DataFrame:
    seconds = X.duration_seconds(F.col("started_at"), F.col("completed_at"))
    return tasks.withColumn("duration_s", seconds).withColumn("duration", X.human_duration(F.col("duration_s")))


def stale_running(tasks: DataFrame, now: Column, hours: int = STALE_HOURS) -> DataFrame:
    """Tasks that say running but have not moved for a day, to the microsecond."""
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))
    return tasks.filter((F.col("status") == "running") & (age > hours * 3_600_000_000)).select(*TASK, "ts")


def edited(recorded: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Recorded against current geometry hash; stale when derived is older or absent."""
    joined = current.join(recorded, list(keys), "left")
    stale = F.col("derived_at").isNull() | (F.col("derived_at") < F.col("source_at"))
    changed = F.col("recorded_hash").isNotNull() & (F.col("recorded_hash") != F.col("current_hash"))
    return joined.select(*keys, changed.alias("edited"), stale.alias("stale"))


def split_good_bad(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows that fail with their reason; none stops the rest."""
    judged = df.withColumn("reason", reason)
    return judged.filter("reason IS NULL").drop("reason"), judged.filter("reason IS NOT NULL")


def pick_tissue_method(methods: DataFrame, requested: Column) -> DataFrame:
    """The one method present, else the requested one, else the default.

    ``problem`` says why nothing could be picked.
    """
    present = F.col("present")
    return (
        methods.groupBy("slide_id")
        .agg(F.array_sort(F.collect_set("method")).alias("present"), F.max(requested).alias("requested"))
        .select(
            "slide_id",
            F.when(F.size(present) == 1, present[0])
            .when(F.col("requested").isNotNull(), F.when(F.array_contains(present, F.col("requested")), F.col("requested")))
            .when(F.array_contains(present, F.lit(DEFAULT_TISSUE_METHOD)), F.lit(DEFAULT_TISSUE_METHOD))
            .alias("method"),
            F.when(F.size(present) == 1, F.lit(None).cast("string"))
            .when(F.col("requested").isNotNull() & ~F.array_contains(present, F.col("requested")), F.lit("requested_missing"))
            .when(F.col("requested").isNull() & ~F.array_contains(present, F.lit(DEFAULT_TISSUE_METHOD)), F.lit("ambiguous"))
            .alias("problem"),
        )
    )
