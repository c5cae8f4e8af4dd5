"""Cell-table, mask and label queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from histoframe.operators import cells as C
from histoframe.operators import words as W
from histoframe.session import scratch_path
from histoframe.sources import sinks
from histoframe.workloads import inputs as I
from histoframe.workloads import workload
from histoframe.workloads.patches import CELLS


def _cells(spark, sf):
    return C.cell_table(I.cell_px(spark, sf))


def _round(df):
    return df.withColumn("x", F.round("x", 6)).withColumn("y", F.round("y", 6))


@workload("cell_table", f"WITH {CELLS} SELECT slide_id, cell_id, ROUND(x, 6) AS x, ROUND(y, 6) AS y, cell_area FROM cells")
def cell_table(spark, sf):
    return _round(_cells(spark, sf))


@workload("sink_cell_table", f"WITH {CELLS} SELECT slide_id, cell_id, ROUND(x, 6) AS x, ROUND(y, 6) AS y, cell_area FROM cells")
def sink_cell_table(spark, sf):
    path = scratch_path(spark, "cells")
    sinks.write_cell_table(_round(_cells(spark, sf)), path, "csv")
    return sinks.read_cell_table(spark, path, "csv")


LABELS = """labels_in AS (SELECT CAST(l_suppkey AS INT) AS slide_id, CAST(l_orderkey % 45 AS INT) AS cell_id, MAX(l_returnflag || l_linestatus) AS label
    FROM lineitem GROUP BY 1, 2)"""


def labels_in(spark, sf):
    li = I.table(spark, sf, "lineitem")
    return li.groupBy(
        F.col("l_suppkey").cast("int").alias("slide_id"), (F.col("l_orderkey") % 45).cast("int").alias("cell_id")
    ).agg(F.max(F.concat("l_returnflag", "l_linestatus")).alias("label"))


@workload("label_semi", f"WITH {CELLS}, {LABELS} SELECT l.* FROM labels_in l WHERE (slide_id, cell_id) IN (SELECT slide_id, cell_id FROM cells)")
def label_semi(spark, sf):
    return C.known_labels(labels_in(spark, sf), _cells(spark, sf))


@workload(
    "label_dropped",
    f"WITH {CELLS}, {LABELS} SELECT l.slide_id, COUNT(*) AS n_dropped FROM labels_in l WHERE (slide_id, cell_id) NOT IN (SELECT slide_id, cell_id FROM cells) GROUP BY 1",
)
def label_dropped(spark, sf):
    return C.unknown_label_count(labels_in(spark, sf), _cells(spark, sf))


@workload("rename_annotation", "SELECT CAST(l_suppkey AS INT) AS slide_id, l_partkey AS cell_id, l_returnflag AS label FROM lineitem")
def rename_annotation(spark, sf):
    return sinks.as_labels(I.table(spark, sf, "lineitem").withColumn("slide_id", F.col("l_suppkey").cast("int")), "l_partkey", "l_returnflag")


STORED = f"""{LABELS}, stored AS (SELECT slide_id, cell_id, 'maps' AS label_set, 'old' AS label FROM labels_in
    UNION ALL SELECT slide_id, cell_id, 'c14', label FROM labels_in WHERE cell_id < 20)"""


@workload(
    "sink_label_set",
    f"WITH {STORED} SELECT slide_id, cell_id, label_set, label FROM stored WHERE label_set <> 'maps' UNION ALL SELECT slide_id, cell_id, 'maps', label FROM labels_in WHERE cell_id > 10",
)
def sink_label_set(spark, sf):
    """Two sets written, one replaced on disk by partition overwrite."""
    labels, path = labels_in(spark, sf), scratch_path(spark, "labels")
    sinks.write_label_set(labels.withColumn("label", F.lit("old")), path, "maps")
    sinks.write_label_set(labels.filter("cell_id < 20"), path, "c14")
    sinks.write_label_set(labels.filter("cell_id > 10"), path, "maps")
    return spark.read.parquet(path).select("slide_id", "cell_id", "label_set", "label")


@workload(
    "labelset_union",
    f"WITH {STORED} SELECT slide_id, cell_id, label_set, label FROM stored WHERE label_set <> 'maps' UNION ALL SELECT slide_id, cell_id, 'maps', label FROM labels_in",
)
def labelset_union(spark, sf):
    labels = labels_in(spark, sf)
    stored = labels.select("slide_id", "cell_id", F.lit("maps").alias("label_set"), F.lit("old").alias("label")).unionByName(
        labels.filter("cell_id < 20").withColumn("label_set", F.lit("c14"))
    )
    return C.replace_label_set(stored, labels, "maps")


SUPPLIED = f"supplied AS (SELECT slide_id, cell_id, x + (cell_id % 5) * 1.5::DOUBLE - 2 AS x, y + (cell_id % 3) * 2 - 1 AS y FROM cells)"


@workload(
    "centroid_override",
    f"""WITH {CELLS}, {SUPPLIED}, hit AS (
            SELECT s.* FROM supplied s JOIN cell_px m ON m.slide_id = s.slide_id AND m.cell_id = s.cell_id
                AND m.y = GREATEST(0, LEAST(CAST(round_even(s.y, 0) AS INT), 47)) AND m.x = GREATEST(0, LEAST(CAST(round_even(s.x, 0) AS INT), 47)))
        SELECT c.slide_id, c.cell_id, ROUND(COALESCE(h.x, c.x), 6) AS x, ROUND(COALESCE(h.y, c.y), 6) AS y, cell_area, h.x IS NOT NULL AS overridden
        FROM cells c LEFT JOIN hit h ON h.slide_id = c.slide_id AND h.cell_id = c.cell_id""",
)
def centroid_override(spark, sf):
    cells = _cells(spark, sf)
    cid = F.col("cell_id")
    supplied = cells.select(
        "slide_id", "cell_id", (F.col("x") + (cid % 5) * F.lit(1.5).cast("double") - 2).alias("x"), (F.col("y") + (cid % 3) * 2 - 1).alias("y")
    )
    return _round(C.centroid_override(cells, supplied, I.cell_px(spark, sf), I.slides(spark, sf)))


KEPT = f"""{CELLS}, kept AS (
    SELECT c.*, row_number() OVER (PARTITION BY c.slide_id ORDER BY c.cell_id) AS new_id FROM cells c
    JOIN tissue_px t ON t.slide_id = c.slide_id AND t.y = CAST(round_even(c.y, 0) AS INT) AND t.x = CAST(round_even(c.x, 0) AS INT))"""


@workload("restrict_to_tissue", f"WITH {KEPT} SELECT slide_id, cell_id, ROUND(x, 6) AS x, ROUND(y, 6) AS y, cell_area, new_id FROM kept")
def restrict_to_tissue(spark, sf):
    return _round(C.restrict_to_tissue(_cells(spark, sf), I.tissue_px(spark, sf), I.slides(spark, sf)))


@workload("remap_mask", f"WITH {KEPT} SELECT slide_id, m.y, m.x, new_id AS cell_id FROM cell_px m JOIN kept k USING (slide_id, cell_id)")
def remap_mask(spark, sf):
    mask = I.cell_px(spark, sf)
    kept = C.restrict_to_tissue(C.cell_table(mask), I.tissue_px(spark, sf), I.slides(spark, sf))
    return C.remap_mask(mask, kept)


@workload(
    "dense_relabel",
    f"""WITH {CELLS} SELECT slide_id, cell_id, row_number() OVER (PARTITION BY slide_id ORDER BY cell_id) AS new_id FROM cells WHERE cell_area > 12""",
)
def dense_relabel(spark, sf):
    return C.dense_relabel(_cells(spark, sf).filter("cell_area > 12")).select("slide_id", "cell_id", "new_id")


@workload(
    "feature_cell_join",
    f"""WITH {CELLS}, {LABELS} SELECT c.slide_id, c.cell_id, cell_area, COALESCE(label, '-') AS label, ROUND(c.x, 6) AS x, ROUND(c.y, 6) AS y
        FROM cells c LEFT JOIN labels_in l ON l.slide_id = c.slide_id AND l.cell_id = c.cell_id""",
)
def feature_cell_join(spark, sf):
    cells = _cells(spark, sf)
    joined = C.annotate(cells.select("slide_id", "cell_id", "cell_area"), labels_in(spark, sf), cells)
    return _round(joined).fillna("-", ["label"])


@workload(
    "mask_edges",
    """SELECT m.slide_id, m.y, m.x, m.cell_id FROM cell_px m WHERE EXISTS (
            SELECT 1 FROM (VALUES (-1, 0), (1, 0), (0, -1), (0, 1)) d(dy, dx)
            WHERE m.y + dy BETWEEN 0 AND 47 AND m.x + dx BETWEEN 0 AND 47 AND NOT EXISTS (
                SELECT 1 FROM cell_px o WHERE o.slide_id = m.slide_id AND o.y = m.y + dy AND o.x = m.x + dx AND o.cell_id = m.cell_id))""",
)
def mask_edges(spark, sf):
    return C.mask_edges(I.cell_px(spark, sf), I.slides(spark, sf))


@workload(
    "cell_mask_validate",
    """SELECT slide_id, CASE WHEN MIN(cell_id - CASE WHEN slide_id % 7 = 0 THEN 3 ELSE 0 END) < 0 THEN 'negative_id' ELSE 'shape_mismatch' END AS problem
       FROM cell_px GROUP BY 1 HAVING MIN(cell_id - CASE WHEN slide_id % 7 = 0 THEN 3 ELSE 0 END) < 0 OR MAX(x + CASE WHEN slide_id % 5 = 0 THEN 3 ELSE 0 END) >= 48""",
)
def cell_mask_validate(spark, sf):
    bad = I.cell_px(spark, sf).withColumn("cell_id", F.col("cell_id") - F.when(F.col("slide_id") % 7 == 0, 3).otherwise(0))
    return C.mask_problems(bad.withColumn("x", F.col("x") + F.when(F.col("slide_id") % 5 == 0, 3).otherwise(0)), I.slides(spark, sf))


@workload("mask_binarize", "SELECT slide_id, y, x FROM pixels GROUP BY 1, 2, 3 HAVING MAX(v) - 20000 > 0")
def mask_binarize(spark, sf):
    values = I.pixels(spark, sf).groupBy("slide_id", "y", "x").agg((F.max("v") - 20000).alias("v"))
    return C.binarize(values, I.slides(spark, sf))


@workload("mask_union", "SELECT slide_id, y, x FROM tissue_px UNION SELECT slide_id, y, x FROM pixels")
def mask_union(spark, sf):
    """Masks go in as they come, with repeated pixels: their rows are made distinct once, as words."""
    return W.union_of(I.tissue_lines(spark, sf), I.pixel_lines(spark, sf))
