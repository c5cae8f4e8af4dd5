"""Feature sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def compare_marker_sets(stored: DataFrame, requested: DataFrame, keys: Sequence[str]) -> DataFrame:
    """skip where the stored markers are the requested ones, error where they differ."""
    same = F.array_sort("markers_used") == F.array_sort("requested")
    action = F.when(F.col("markers_used").isNull(), F.lit("run")).when(same, F.lit("skip")).otherwise(F.lit("error"))
    return requested.join(stored, list(keys), "left").withColumn("action", action)


def join_positions(features: DataFrame, patches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Feature rows with the place of their patch."""
    return features.join(patches.select(*keys, "x", "y"), list(keys))


def join_bucketed(spark: SparkSession, tables: Sequence[str], keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Tables that ``write_bucketed`` has cut alike, joined on their keys bucket by bucket."""
    return reduce(lambda a, b: a.join(b, list(keys), how), [spark.table(t) for t in tables])


def feature_inventory(features: DataFrame) -> DataFrame:
    """Stored feature sets with their shape."""
    return features.groupBy("slide_id", "slug", "encoder", "variant").agg(
        F.count(F.lit(1)).alias("n_patches"), F.max(F.size("features")).alias("n_features")
    )


def mean_vector(df: DataFrame, keys: Sequence[str], vector: str = "features") -> DataFrame:
    """Element-wise mean of all vectors of a group.

    Dimensions are averaged as rows, so a large group combines map-side;
    only the mean vector itself is put together again.
    """
    means = df.select(*keys, F.posexplode(vector).alias("dim", "v")).groupBy(*keys, "dim").agg(F.avg("v").alias("v"))
    packed = F.array_sort(F.collect_list(F.struct("dim", "v")))
    return means.groupBy(*keys).agg(packed.alias("_p")).select(*keys, F.transform("_p", lambda s: s["v"]).alias(vector))


def marker_provenance(panel: DataFrame, mapped: DataFrame) -> DataFrame:
    """Markers a feature set used, dropped or had no embedding for, per slide.

    ``mapped`` is (slide_id, idx, status) with kept, dropped or skipped.
    """
    rows = panel.join(mapped.select("slide_id", "idx", "status"), ["slide_id", "idx"])

    def names(status: str) -> Column:
        found = F.collect_list(F.when(F.col("status") == status, F.struct("idx", "marker")))
        return F.transform(F.array_sort(found), lambda s: s["marker"])

    return rows.groupBy("slide_id").agg(
        names("kept").alias("markers_used"), names("dropped").alias("markers_dropped"), names("skipped").alias("markers_no_embedding")
    )
