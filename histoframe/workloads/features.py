"""Feature-set and plug-in queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from histoframe.operators import features as V
from histoframe.operators import markers as M
from histoframe.plans import encoders as P
from histoframe.plans.extract import extract_mean_marker
from histoframe.plans.tissue import segment_tissue
from histoframe.session import scratch_path
from histoframe.sources import sinks
from histoframe.workloads import inputs as I
from histoframe.workloads import workload
from histoframe.workloads.patches import SIZE, STRIDE, TILE, grid_sql, image_panel, inside, mean_sql

SLUG = "0.5mpp_16px"


def _stored(spark, sf):
    """Feature set written through the extract stage."""
    path = scratch_path(spark, "features")
    extract_mean_marker(I.pixels(spark, sf), I.slides(spark, sf), image_panel(spark, sf), path, TILE, TILE, SLUG)
    return path


VEC = "string_agg(CAST(CAST(ROUND(value * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY c)"


@workload("src_features", f"WITH {mean_sql(TILE, TILE)} SELECT slide_id, patch_id, '{SLUG}' AS slug, 'mean_marker' AS encoder, 'markers_all' AS variant, {VEC} AS micro FROM long GROUP BY 1, 2")
def src_features(spark, sf):
    found = sinks.read_features(spark, _stored(spark, sf), "mean_marker", SLUG)
    micro = F.transform("features", lambda v: F.round(v * 1000000).cast("bigint").cast("string"))
    return found.select("slide_id", "patch_id", "slug", "encoder", "variant", F.array_join(micro, ",").alias("micro"))


@workload(
    "sink_features",
    f"""SELECT slide_id, '{SLUG}' AS slug, 'mean_marker' AS encoder, 'markers_all' AS variant, 'grid' AS patch_mode, 5 AS schema_version,
            string_agg(marker, ',' ORDER BY idx) AS markers_used FROM panel WHERE idx < 7 AND COALESCE(keep, TRUE) GROUP BY 1""",
)
def sink_features(spark, sf):
    """Provenance stored next to a feature set."""
    meta = spark.read.parquet(f"{_stored(spark, sf)}/meta")
    return meta.select("slide_id", "slug", "encoder", "variant", "patch_mode", "schema_version", F.array_join("markers_used", ",").alias("markers_used"))


@workload(
    "feature_inventory",
    f"""WITH {mean_sql(TILE, TILE)} SELECT slide_id, '{SLUG}' AS slug, 'mean_marker' AS encoder, 'markers_all' AS variant,
            COUNT(DISTINCT patch_id) AS n_patches, CAST(COUNT(DISTINCT c) AS INT) AS n_features FROM long GROUP BY 1""",
)
def feature_inventory(spark, sf):
    return V.feature_inventory(spark.read.parquet(f"{_stored(spark, sf)}/features"))


@workload(
    "uni_post_mean",
    """SELECT label, CAST(dim AS INT) AS dim, ROUND(AVG(v), 6) AS v FROM (SELECT label, unnest(features) AS v, unnest(range(len(features))) AS dim FROM cell_features) GROUP BY 1, 2""",
)
def uni_post_mean(spark, sf):
    means = V.mean_vector(I.cell_features(spark, sf), ["label"])
    return means.select("label", F.posexplode("features").alias("dim", "v")).withColumn("v", F.round("v", 6))


@workload(
    "marker_provenance",
    """WITH s AS (SELECT slide_id, idx, marker, CASE WHEN regexp_matches(marker, 'hoechst|empty|blank|draq') THEN 'skipped'
            WHEN marker IN (SELECT name FROM vocabulary) OR REPLACE(marker, '_', '') IN (SELECT REPLACE(name, '_', '') FROM vocabulary) THEN 'kept' ELSE 'dropped' END AS status FROM panel)
       SELECT slide_id, COALESCE(string_agg(marker, ',' ORDER BY idx) FILTER (status = 'kept'), '') AS markers_used,
              COALESCE(string_agg(marker, ',' ORDER BY idx) FILTER (status = 'dropped'), '') AS markers_dropped,
              COALESCE(string_agg(marker, ',' ORDER BY idx) FILTER (status = 'skipped'), '') AS markers_no_embedding FROM s GROUP BY 1""",
)
def marker_provenance(spark, sf):
    panel = I.panel(spark, sf).select("slide_id", "idx", "marker")
    no_alias = I.aliases(spark, sf).filter("alias = ''")
    mapped = M.compact_vocab(panel, I.vocabulary(spark, sf), no_alias, raw="marker")
    out = V.marker_provenance(panel, mapped)
    return out.select("slide_id", *[F.array_join(c, ",").alias(c) for c in out.columns[1:]])


def _mean_encoder():
    """Mean of the non-zero pixels, as a plug-in, defined here so it pickles whole."""

    class MeanEncoder(P.Encoder):
        name, version, required_markers = "numpy_mean", "1", ("dapi",)

        def forward(self, model, batch, markers):  # noqa: ANN001, ANN202
            return batch.sum((2, 3)) / 65535.0 / (1e-6 + (batch != 0).sum((2, 3)))

    return MeanEncoder()


@workload(
    "encode",
    f"""WITH {grid_sql(TILE, TILE)}, agg AS (SELECT g.slide_id, patch_id, c, SUM(v) / 65535::DOUBLE / (1e-6::DOUBLE + COUNT(*)) AS value FROM pixels p JOIN grid g ON {inside(TILE)} GROUP BY 1, 2, 3)
        SELECT g.slide_id, g.patch_id, CAST(k AS INT) AS c, ROUND(COALESCE(value, 0), 6) AS value
        FROM grid g CROSS JOIN range(7) t(k) LEFT JOIN agg a ON a.slide_id = g.slide_id AND a.patch_id = g.patch_id AND a.c = k""",
)
def encode(spark, sf):
    """A numpy encoder through the batch plug-in equals the relational mean."""
    tensors = P.patch_tensors(I.pixels(spark, sf), I.slides(spark, sf), TILE, TILE)
    out = P.encode(tensors, _mean_encoder(), list(range(7)), [f"m{i}" for i in range(7)], TILE)
    return out.select("slide_id", "patch_id", F.posexplode("features").alias("c", "value")).withColumn("value", F.round("value", 6))


def _threshold_segmenter():
    class Bright(P.Segmenter):
        def segment(self, planes):  # noqa: ANN001, ANN202
            return (planes.max(0) > 30000).astype("float64")

    return Bright()


@workload("segmenter_plugin", "SELECT DISTINCT slide_id, y, x FROM pixels WHERE v > 30000")
def segmenter_plugin(spark, sf):
    return segment_tissue(I.pixels(spark, sf), I.slides(spark, sf), _threshold_segmenter(), list(range(7)), SIZE, STRIDE)
