"""Cell tables, masks and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoframe.operators.ranking import id_rank


def cell_table(cell_px: DataFrame) -> DataFrame:
    """Centroid and area of every cell of a mask."""
    return cell_px.filter("cell_id <> 0").groupBy("slide_id", "cell_id").agg(
        F.avg("x").alias("x"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("cell_area")
    )


def clipped(at: Column, extent: Column) -> Column:
    """Half-even rounded coordinate kept inside the frame."""
    return F.greatest(F.lit(0), F.least(F.bround(at).cast("int"), extent - 1))


def at_pixel(cells: DataFrame, slides: DataFrame) -> DataFrame:
    """Cells with the pixel their centroid falls on, as (_y, _x)."""
    dims = slides.select("slide_id", "height", "width")
    return (
        cells.join(dims, "slide_id")
        .withColumn("_y", clipped(F.col("y"), F.col("height")))
        .withColumn("_x", clipped(F.col("x"), F.col("width")))
        .drop("height", "width")
    )


def centroid_override(cells: DataFrame, supplied: DataFrame, cell_px: DataFrame, slides: DataFrame) -> DataFrame:
    """Supplied points replace centroids where the mask there is that cell."""
    hit = (
        at_pixel(supplied, slides)
        .join(cell_px.select("slide_id", "cell_id", F.col("y").alias("_y"), F.col("x").alias("_x")), ["slide_id", "cell_id", "_y", "_x"], "left_semi")
        .select("slide_id", "cell_id", F.col("x").alias("_sx"), F.col("y").alias("_sy"))
    )
    return cells.join(hit, ["slide_id", "cell_id"], "left").select(
        "slide_id", "cell_id", F.coalesce("_sx", "x").alias("x"), F.coalesce("_sy", "y").alias("y"), "cell_area",
        F.col("_sx").isNotNull().alias("overridden"),
    )


def dense_relabel(cells: DataFrame) -> DataFrame:
    """Consecutive ids 1..N per slide in the old order."""
    return id_rank(cells, ["slide_id"], "cell_id", "new_id")


def restrict_to_tissue(cells: DataFrame, tissue: DataFrame, slides: DataFrame) -> DataFrame:
    """Cells whose centroid pixel is tissue, relabelled 1..N per slide."""
    on = tissue.select("slide_id", F.col("y").alias("_y"), F.col("x").alias("_x"))
    kept = at_pixel(cells, slides).join(on, ["slide_id", "_y", "_x"], "left_semi").drop("_y", "_x")
    return dense_relabel(kept)


def remap_mask(cell_px: DataFrame, relabelled: DataFrame) -> DataFrame:
    """Mask pixels under their new ids; pixels of dropped cells go."""
    ids = relabelled.select("slide_id", "cell_id", "new_id")
    return cell_px.join(ids, ["slide_id", "cell_id"]).select("slide_id", "y", "x", F.col("new_id").alias("cell_id"))


def known_labels(labels: DataFrame, cells: DataFrame) -> DataFrame:
    """Labels of cells that exist in the mask."""
    return labels.join(cells.select("slide_id", "cell_id"), ["slide_id", "cell_id"], "left_semi")


def unknown_label_count(labels: DataFrame, cells: DataFrame) -> DataFrame:
    gone = labels.join(cells.select("slide_id", "cell_id"), ["slide_id", "cell_id"], "left_anti")
    return gone.groupBy("slide_id").agg(F.count(F.lit(1)).alias("n_dropped"))


def replace_label_set(stored: DataFrame, new: DataFrame, label_set: str) -> DataFrame:
    """Stored labels with one label set replaced whole."""
    return stored.filter(F.col("label_set") != label_set).unionByName(new.withColumn("label_set", F.lit(label_set)))


def annotate(features: DataFrame, labels: DataFrame, cells: DataFrame) -> DataFrame:
    """Feature rows with label and centroid; unlabelled cells stay, null."""
    keys = ["slide_id", "cell_id"]
    return features.join(labels.select(*keys, "label"), keys, "left").join(cells.select(*keys, "x", "y"), keys, "left")


def mask_edges(cell_px: DataFrame, slides: DataFrame) -> DataFrame:
    """Inner boundary: cell pixels with another id among their 4 neighbours.

    Neighbours come from two windows, one inside each row and one inside
    each column; what lies off the frame is no neighbour.
    """
    dims = slides.select("slide_id", "height", "width")
    out = cell_px.join(dims, "slide_id")
    differs = F.lit(False)
    for axis, other, extent in (("x", "y", "width"), ("y", "x", "height")):
        order = Window.partitionBy("slide_id", other).orderBy(axis)
        for shift, inside in ((-1, F.col(axis) > 0), (1, F.col(axis) < F.col(extent) - 1)):
            fn = F.lag if shift < 0 else F.lead
            next_to = fn(axis).over(order) == F.col(axis) + shift
            same = F.coalesce(next_to & (fn("cell_id").over(order) == F.col("cell_id")), F.lit(False))
            name = f"_{axis}{shift}"
            out = out.withColumn(name, inside & ~same)
            differs = differs | F.col(name)
    return out.filter(differs & (F.col("cell_id") != 0)).select("slide_id", "y", "x", "cell_id")


def mask_problems(cell_px: DataFrame, slides: DataFrame) -> DataFrame:
    """Slides whose imported mask has negative ids or leaves the frame."""
    seen = cell_px.groupBy("slide_id").agg(
        F.min("cell_id").alias("min_id"), F.min(F.least("y", "x")).alias("min_at"), F.max("y").alias("max_y"), F.max("x").alias("max_x")
    )
    problem = F.when(F.col("min_id") < 0, F.lit("negative_id")).when(
        (F.col("min_at") < 0) | (F.col("max_y") >= F.col("height")) | (F.col("max_x") >= F.col("width")), F.lit("shape_mismatch")
    )
    return (
        seen.join(slides.select("slide_id", "height", "width"), "slide_id")
        .withColumn("problem", problem)
        .filter(F.col("problem").isNotNull())
        .select("slide_id", "problem")
    )


def binarize(mask_values: DataFrame, slides: DataFrame) -> DataFrame:
    """Tissue pixels of an imported mask; a pixel off the frame is an error."""
    inside = F.col("y").between(0, F.col("height") - 1) & F.col("x").between(0, F.col("width") - 1)
    checked = F.when(inside, F.col("v") > 0).otherwise(F.raise_error(F.lit("mask and slide differ in shape")).cast("boolean"))
    return mask_values.join(slides.select("slide_id", "height", "width"), "slide_id").filter(checked).select("slide_id", "y", "x")


def window(df: DataFrame, y0: int, y1: int, x0: int, x1: int) -> DataFrame:
    """Rows inside a rectangle; ranges on y and x reach the scan."""
    if not (0 <= y0 < y1 and 0 <= x0 < x1):
        raise ValueError(f"bad window rows {y0}:{y1}, columns {x0}:{x1}")
    return df.filter((F.col("y") >= y0) & (F.col("y") < y1) & (F.col("x") >= x0) & (F.col("x") < x1))
