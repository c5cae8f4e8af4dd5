"""Cohort statistics of novel markers: partials per slide, pooling, reuse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoframe.functions import names as N
from histoframe.functions import numeric as X
from histoframe.session import materialize


def region_keys(mask: DataFrame, slides: DataFrame) -> DataFrame:
    """Reuse signature of each slide's tissue: frame, tissue pixels, scaling."""
    counted = mask.groupBy("slide_id").agg(F.count(F.lit(1)).alias("n_tissue"))
    divisor = X.dtype_divisor(F.col("dtype"))
    key = F.format_string("(%d, %d):%d:%s", F.col("height"), F.col("width"), F.coalesce("n_tissue", F.lit(0).cast("bigint")), divisor.cast("string"))
    return slides.join(counted, "slide_id", "left").select(
        "slide_id", F.coalesce("n_tissue", F.lit(0).cast("bigint")).alias("n_tissue"), divisor.alias("divisor"), key.alias("region_key")
    )


def unique_targets(targets: DataFrame) -> DataFrame:
    """One channel per (slide, marker); the last on the panel wins."""
    return targets.groupBy("slide_id", "marker").agg(F.max("idx").alias("idx"))


def novel_partials(pixels: DataFrame, mask: DataFrame, slides: DataFrame, targets: DataFrame) -> DataFrame:
    """(n, mean, var) of each target channel over the tissue, zeros included.

    ``targets`` is (slide_id, idx, marker). Only non-zero tissue pixels are
    read; n comes from the mask. Their mean and variance are merged with the
    zeros by the pooling formula, so no power sums cancel.
    """
    targets = unique_targets(targets)
    wanted = targets.select("slide_id", F.col("idx").alias("c"))
    seen = pixels.join(wanted, ["slide_id", "c"], "left_semi").join(mask, ["slide_id", "y", "x"], "left_semi")
    v = F.col("v").cast("double")
    sums = seen.groupBy("slide_id", "c").agg(F.count("v").alias("_n"), F.avg(v).alias("_m"), F.var_samp(v).alias("_v"))
    n, div = F.col("n_tissue"), F.col("divisor")
    n1, m1 = F.coalesce("_n", F.lit(0)), F.coalesce("_m", X.d(0)) / div
    mean = n1 * m1 / n
    spread = (n1 - 1) * F.coalesce("_v", X.d(0)) / (div * div) + n1 * (n - n1) / n * m1 * m1
    var = spread / (n - 1)
    return (
        targets.join(region_keys(mask, slides), "slide_id")
        .join(sums.withColumnRenamed("c", "idx"), ["slide_id", "idx"], "left")
        .select(
            "slide_id",
            "marker",
            "region_key",
            n.alias("n"),
            F.when(n > 0, mean).otherwise(X.d(0)).alias("mean"),
            F.when(n > 1, F.greatest(var, X.d(0))).otherwise(X.d(0)).alias("var"),
        )
    )


def pool_stats(partials: DataFrame) -> DataFrame:
    """Exact mean and sample deviation of the union of all partials, by name key.

    A key without a single tissue pixel in any slide has no statistics and is
    an error.
    """
    key = N.match_key(F.col("marker"))
    n = F.col("n").cast("double")
    centre = partials.groupBy(key.alias("key")).agg(F.sum("n").alias("total"), F.sum(n * F.col("mean")).alias("_sum"))
    centre = centre.select("key", "total", (F.col("_sum") / F.nullif(F.col("total").cast("double"), X.d(0))).alias("mean"))
    back = partials.withColumn("key", key).withColumnRenamed("mean", "_m").join(centre, "key")
    spread = F.sum((n - 1) * F.col("var") + n * (F.col("_m") - F.col("mean")) * (F.col("_m") - F.col("mean")))
    pooled = back.groupBy("key", "total", "mean").agg(spread.alias("_ss"))
    total = F.when(F.col("total") > 0, F.col("total")).otherwise(F.raise_error(F.concat(F.lit("no tissue pixels for marker "), F.col("key"))))
    std = F.when(F.col("total") > 1, F.sqrt(F.greatest(F.col("_ss") / (F.col("total") - 1), X.d(0)))).otherwise(X.d(0))
    return pooled.select("key", total.alias("n"), "mean", std.alias("std"))


def fill_blank_stats(additional: DataFrame, pooled: DataFrame) -> DataFrame:
    """Blank mean and std cells filled from pooled values; others untouched."""
    stats = pooled.select("key", F.col("mean").alias("_mean"), F.col("std").alias("_std"))
    joined = additional.withColumn("key", N.match_key(F.col("marker_name"))).join(stats, "key", "left")
    return joined.withColumns(
        {c: N.fill_blank(F.col(c), F.col(f"_{c}")) for c in ("mean", "std")}
    ).drop("key", "_mean", "_std")


def incomplete_rows(additional: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Novel-marker rows that leave a required text column blank."""
    blanks = F.filter(
        F.array(*[F.when(N.is_blank_cell(F.col(c)), F.lit(c)) for c in required]), lambda c: c.isNotNull()
    )
    return additional.select("marker_name", F.array_join(blanks, ",").alias("blank_columns")).filter("blank_columns <> ''")


def prepare_cohort(
    pixels: DataFrame, mask: DataFrame, slides: DataFrame, targets: DataFrame, stored: DataFrame, additional: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Novel-marker pass over a cohort: (filled table, partials to keep).

    Only markers whose row still lacks a statistic are computed. A slide's
    stored partials are reused when their region key is current and they
    cover every target; pixels are read for the remaining slides alone.
    """
    blank = N.is_blank_cell(F.col("mean")) | N.is_blank_cell(F.col("std"))
    needed = additional.filter(blank).select(N.match_key(F.col("marker_name")).alias("key")).distinct()
    todo = unique_targets(targets).withColumn("key", N.match_key(F.col("marker"))).join(needed, "key", "left_semi").drop("key")
    current = region_keys(mask, slides).select("slide_id", "region_key")
    usable = stored.join(current, ["slide_id", "region_key"], "left_semi")
    covered = (
        todo.join(usable.select("slide_id", "marker", F.lit(1).alias("_has")), ["slide_id", "marker"], "left")
        .groupBy("slide_id")
        .agg(F.bool_and(F.col("_has").isNotNull()).alias("reuse"))
        .filter("reuse")
        .select("slide_id")
    )
    reused = usable.join(todo.select("slide_id", "marker"), ["slide_id", "marker"], "left_semi").join(covered, "slide_id", "left_semi")
    fresh_targets = todo.join(covered, "slide_id", "left_anti")
    fresh = novel_partials(pixels, mask, slides, fresh_targets)
    partials = reused.select("slide_id", "marker", "region_key", "n", "mean", "var", F.lit(True).alias("reused")).unionByName(
        fresh.withColumn("reused", F.lit(False))
    )
    partials = materialize(partials, "partials")
    return fill_blank_stats(additional, pool_stats(partials)), partials
