"""Session set-up, shared scratch space and lineage cutting."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def get_session(app: str = "histoframe", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are tuned for.

    Joins carry no broadcast hints: the static threshold and AQE's runtime
    sizes decide, so a dimension that outgrows the limit falls back to a
    shuffled join (and AQE's skew split) instead of breaking the executors.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "32MB",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine is a fresh
    local folder made; a cluster has to name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path under the shared root for a table written and read back."""
    return os.path.join(shared_root(spark), "histoframe", f"{name}-{uuid.uuid4().hex}")


def drop_scratch(spark: SparkSession) -> bool:
    """Delete the tables that operators have written under the shared root; results not yet read are lost."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(shared_root(spark), "histoframe"))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` has written, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in sorted({os.path.dirname(f) for f in df.inputFiles()}):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def has_folder(spark: SparkSession, path: str) -> bool:
    """Whether something is stored there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def counted(df: DataFrame, name: str, where: Column | None = None) -> tuple[DataFrame, int]:
    """``materialize``, with the number of rows (for which ``where`` holds) counted while they are written."""
    seen = Observation()
    n = F.count(F.lit(1)) if where is None else F.count_if(where)
    return materialize(df.observe(seen, n.alias("n")), name), seen.get["n"]


def materialize(df: DataFrame, name: str = "cut") -> DataFrame:
    """Written table in the shared folder, read back: one pass over the input."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut a plan's history so that it survives the loss of any executor.

    A written table rather than ``checkpoint()``: an eager checkpoint
    computes its input twice, a table once, and readers of the table prune
    columns.
    """
    return materialize(df)
