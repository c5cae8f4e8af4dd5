"""Patch and extract stage: mean-marker features with their provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoframe.operators import patches as G
from histoframe.sources import sinks


def extract_mean_marker(
    pixels: DataFrame, slides: DataFrame, panel: DataFrame, path: str, size: int, stride: int, slug: str, variant: str = "markers_all"
) -> None:
    """Write the mean-marker feature set of every slide of ``slides``."""
    keys = {"slug": F.lit(slug), "encoder": F.lit("mean_marker"), "variant": F.lit(variant)}
    features = G.mean_marker(pixels, slides, panel, size, stride).drop("channels").withColumns(keys)
    used = panel.groupBy("slide_id").agg(F.array_sort(F.collect_list(F.struct("idx", "marker"))).alias("_m"))
    meta = (
        used.join(slides.select("slide_id"), "slide_id", "left_semi")
        .select("slide_id", F.transform("_m", lambda m: m["marker"]).alias("markers_used"))
        .withColumns({**keys, "encoder_version": F.lit("1"), "patch_mode": F.lit("grid"), "extracted_at": F.current_timestamp()})
    )
    sinks.write_features(features, meta, path)
