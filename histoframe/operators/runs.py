"""Binary masks as row runs, and the raster algebra on them.

A mask is (slide_id, y, x0, x1): maximal runs of set pixels inside a row,
both ends included. A run stands for hundreds of pixels, so connected
components, holes and closings move far fewer rows than pixel relations.
All windows stay inside one row of one slide.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoframe.session import counted, cut_lineage

ROW = ["slide_id", "y"]
BUCKET = 64  # columns per bucket when runs of neighbouring rows meet
STRIP, TILE = 512, 1024  # columns and least rows of a tile of a dilation
SMALL_RADIUS = 4  # up to here a run is dilated by its copies in the rows around it
LABEL_ROWS, LABEL_COLUMNS = 256, 1024  # a tile in which components are found at once


def to_runs(mask: DataFrame) -> DataFrame:
    """Distinct mask pixels to maximal runs."""
    order = Window.partitionBy(*ROW).orderBy("x")
    island = F.col("x") - F.row_number().over(order)
    return (
        mask.select(*ROW, "x", island.alias("_island"))
        .groupBy(*ROW, "_island")
        .agg(F.min("x").alias("x0"), F.max("x").alias("x1"))
        .drop("_island")
    )


def to_pixels(runs: DataFrame) -> DataFrame:
    keep = [c for c in runs.columns if c not in ("x0", "x1")]
    return runs.select(*keep, F.explode(F.sequence("x0", "x1")).alias("x"))


def merge_runs(runs: DataFrame) -> DataFrame:
    """Overlapping or touching runs of a row joined into maximal ones."""
    order = Window.partitionBy(*ROW).orderBy("x0", "x1")
    before = F.max("x1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(F.col("x0") <= before + 1, 0).otherwise(1)
    group = F.sum("_start").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        runs.select(*ROW, "x0", "x1", starts.alias("_start"))
        .select(*ROW, "x0", "x1", group.alias("_group"))
        .groupBy(*ROW, "_group")
        .agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"))
        .drop("_group")
    )


def clip_runs(runs: DataFrame, slides: DataFrame) -> DataFrame:
    dims = slides.select("slide_id", "height", "width")
    return (
        runs.join(dims, "slide_id")
        .filter((F.col("y") >= 0) & (F.col("y") < F.col("height")) & (F.col("x1") >= 0) & (F.col("x0") < F.col("width")))
        .select(*ROW, F.greatest("x0", F.lit(0)).alias("x0"), F.least("x1", F.col("width") - 1).alias("x1"))
    )


def complement(runs: DataFrame, slides: DataFrame) -> DataFrame:
    """Runs of the background over the whole frame, without a dense grid.

    Each row gains a sentinel run at its right edge; the gap before every
    run, sentinel included, is a background run.
    """
    rows = slides.select(
        "slide_id", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y"), F.col("width").alias("x0"), F.col("width").alias("x1")
    )
    order = Window.partitionBy(*ROW).orderBy("x0")
    gap_start = F.coalesce(F.lag("x1").over(order) + 1, F.lit(0))
    return (
        runs.select(*ROW, "x0", "x1")
        .unionByName(rows)
        .select(*ROW, gap_start.alias("x0"), (F.col("x0") - 1).alias("x1"))
        .filter("x0 <= x1")
    )


def union_runs(*masks: DataFrame) -> DataFrame:
    out = masks[0].select(*ROW, "x0", "x1")
    for m in masks[1:]:
        out = out.unionByName(m.select(*ROW, "x0", "x1"))
    return merge_runs(out)


# ------------------------------------------------------------- components


def _run_id() -> Column:
    """One number per run: 23 bits of slide, 20 each of row and column; values beyond them are an error."""
    number = (
        F.shiftleft(F.col("slide_id").cast("bigint"), 40)
        + F.shiftleft(F.col("y").cast("bigint"), 20)
        + F.col("x0").cast("bigint")
    )
    fits = F.col("slide_id").between(0, (1 << 23) - 1) & F.col("y").between(0, (1 << 20) - 1) & F.col("x0").between(0, (1 << 20) - 1)
    return F.when(fits, number).otherwise(F.raise_error(F.lit("run outside the range of slide ids or frame sizes")))


def run_edges(runs: DataFrame, diagonal: bool) -> DataFrame:
    """Pairs of touching runs in neighbouring rows.

    Runs meet through column buckets: an equi join on (slide, row, bucket)
    with at most 32 runs a side, so no row of the mask becomes a hot key.
    """
    reach = 1 if diagonal else 0
    wide = runs.select(*ROW, "x0", "x1", "run")
    low = F.floor((F.col("x0") - reach) / BUCKET)
    high = F.floor((F.col("x1") + reach) / BUCKET)
    upper = wide.select("slide_id", F.col("y").alias("_y"), F.col("x0").alias("a0"), F.col("x1").alias("a1"), F.col("run").alias("src"),
                        F.explode(F.sequence(low, high)).alias("_b"))
    lower = wide.select("slide_id", (F.col("y") - 1).alias("_y"), F.col("x0").alias("b0"), F.col("x1").alias("b1"), F.col("run").alias("dst"),
                        F.explode(F.sequence(F.floor(F.col("x0") / BUCKET), F.floor(F.col("x1") / BUCKET))).alias("_b"))
    touch = (F.col("a0") <= F.col("b1") + reach) & (F.col("b0") <= F.col("a1") + reach)
    return upper.join(lower, ["slide_id", "_y", "_b"]).filter(touch).select("src", "dst").distinct()


def connected_roots(nodes: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): smallest node of each connected component.

    Alternates large-star and small-star steps (Kiveris et al., 2014), which
    converge in a logarithmic number of rounds, each checkpointed reliably,
    until all edges point straight at a root.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.select(F.col("src").alias("u"), F.col("dst").alias("v"))
        if large:
            both = both.unionByName(pairs.select(F.col("dst").alias("u"), F.col("src").alias("v")))
        else:
            both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
        joined = both.join(low, "u")
        if large:
            moved = joined.filter("v > u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
        else:
            moved = joined.select(F.col("v").alias("src"), F.col("m").alias("dst")).unionByName(
                low.select(F.col("u").alias("src"), F.col("m").alias("dst"))
            )
        return moved.filter("src <> dst").distinct()

    def settled(pairs: DataFrame) -> bool:
        """Every source has one target and no target is itself a source."""
        roles = pairs.select(F.inline(F.array(
            F.struct(F.col("src").alias("node"), F.lit(1).alias("as_src"), F.lit(0).alias("as_dst")),
            F.struct(F.col("dst").alias("node"), F.lit(0).alias("as_src"), F.lit(1).alias("as_dst")),
        )))
        per_node = roles.groupBy("node").agg(F.sum("as_src").alias("n_src"), F.max("as_dst").alias("is_dst"))
        return per_node.filter("n_src > 1 OR (n_src = 1 AND is_dst = 1)").isEmpty()

    pairs = edges.filter("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    for _ in range(max_rounds):
        pairs = cut_lineage(star(star(pairs, True), False))
        if settled(pairs):
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = pairs.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _tile_labels(reach: int) -> Callable[[Iterator], Iterator]:
    """Pieces in order of tile, row and column, with the first piece of their component inside the tile as ``local``."""

    def first_of(slide, band, strip, y, x0, x1):  # noqa: ANN001, ANN202 - numpy columns of whole tiles
        import numpy as np

        new = np.ones(len(y), bool)
        new[1:] = (np.diff(slide) != 0) | (np.diff(band) != 0) | (np.diff(strip) != 0) | (np.diff(y) != 0)
        row, starts, wide = np.cumsum(new) - 1, np.flatnonzero(new), 1 << 21
        beneath = np.zeros(len(starts), bool)
        same = [np.diff(column[starts]) == 0 for column in (slide, band, strip)]
        beneath[:-1] = same[0] & same[1] & same[2] & (np.diff(y[starts]) == 1)
        upper = np.flatnonzero(beneath[row])
        base = (row[upper] + 1) * wide
        left = np.searchsorted(row * wide + x1, base + x0[upper] - reach, "left")
        met = np.searchsorted(row * wide + x0, base + x1[upper] + reach, "right") - left
        src, dst = np.repeat(upper, met), np.arange(met.sum()) + np.repeat(left - (np.cumsum(met) - met), met)
        root = np.arange(len(y))
        while True:
            apart = root[src] != root[dst]
            if not apart.any():
                return root
            src, dst = src[apart], dst[apart]
            np.minimum.at(root, np.maximum(root[src], root[dst]), np.minimum(root[src], root[dst]))
            while (root[root] != root).any():
                root = root[root]

    def label(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tile, rest = ("slide_id", "band", "strip"), None

        def labelled(table):  # noqa: ANN001, ANN202 - Arrow table
            columns = [table[name].to_numpy().astype("int64") for name in (*tile, "y", "x0", "x1")]
            local = table["piece"].to_numpy()[first_of(*columns)]
            return table.append_column("local", pa.array(local)).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
            last = sum((table[name].to_numpy() == table[name][-1].as_py()).astype(int) for name in tile) == len(tile)
            whole = table.num_rows - int(last.sum())
            rest = table.slice(whole)
            if whole:
                yield from labelled(table.slice(0, whole))
        if rest is not None:
            yield from labelled(rest)

    return label


def label_runs(runs: DataFrame, diagonal: bool = False) -> DataFrame:
    """Runs with ``comp``, the id of their component's first run in raster order.

    Runs are cut at the borders of tiles of a stated size. Components inside a
    tile come out of one pass over its sorted pieces; only pieces at borders
    between tiles then link components in rounds over the whole table.
    """
    reach, tile = int(diagonal), ["slide_id", "band", "strip"]
    at = F.col("strip") * LABEL_COLUMNS
    cut = runs.select(
        *ROW, F.col("x0").alias("r0"), F.col("x1").alias("r1"), F.floor(F.col("y") / LABEL_ROWS).alias("band"),
        F.explode(F.sequence(F.floor(F.col("x0") / LABEL_COLUMNS), F.floor(F.col("x1") / LABEL_COLUMNS))).alias("strip"),
    )
    cut = cut.withColumns({"x0": F.greatest("r0", at), "x1": F.least("r1", at + (LABEL_COLUMNS - 1))}).withColumn("piece", _run_id())
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_pieces = cut.repartition(parts, *tile).sortWithinPartitions(*tile, "y", "x0")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sorted_pieces.schema)
    labelled = cut_lineage(sorted_pieces.mapInArrow(_tile_labels(reach), f"{schema}, local bigint")).withColumn("comp", F.col("local"))

    y, x0, x1 = F.col("y"), F.col("x0"), F.col("x1")
    above, left = (y % LABEL_ROWS == 0) & (y > 0), (x0 % LABEL_COLUMNS == 0) & (x0 > 0)
    below, right = y % LABEL_ROWS == LABEL_ROWS - 1, x1 % LABEL_COLUMNS == LABEL_COLUMNS - 1
    near = labelled.filter(above | below | left | right).select(*ROW, "x0", "x1", F.col("local").alias("run"))
    ends = near.filter(right).select(*ROW, (x1 + 1).alias("x0"), F.col("run").alias("src"))
    along = near.filter(left).select(*ROW, "x0", F.col("run").alias("dst")).join(ends, [*ROW, "x0"]).select("src", "dst")
    links, n_links = counted(run_edges(near, diagonal).unionByName(along).filter("src <> dst").distinct(), "links")
    if n_links:
        ends = links.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
        roots = cut_lineage(connected_roots(ends, links)).select(F.col("node").alias("local"), "root")
        labelled = labelled.join(roots, "local", "left").withColumn("comp", F.coalesce("root", "local"))
    return labelled.filter("x0 = r0").select(*ROW, F.col("r0").alias("x0"), F.col("r1").alias("x1"), "comp")


def connected_components(mask: DataFrame, diagonal: bool = False) -> DataFrame:
    """Mask pixels with the number of their component, 1.. in raster order."""
    from histoframe.operators.ranking import id_rank

    labelled = label_runs(to_runs(mask), diagonal)
    numbers = id_rank(labelled.select("slide_id", "comp").distinct(), ["slide_id"], "comp", "component", width=1 << 32)
    return to_pixels(labelled.join(numbers, ["slide_id", "comp"]).select(*ROW, "x0", "x1", "component"))


def component_area(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("slide_id", "comp").agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("area"))


def remove_small(runs: DataFrame, min_area: DataFrame, diagonal: bool = False) -> DataFrame:
    """Runs of components with at least (slide_id, min_area) pixels."""
    labelled = label_runs(runs, diagonal)
    big = component_area(labelled).join(min_area, "slide_id").filter("area >= min_area").select("slide_id", "comp")
    return labelled.join(big, ["slide_id", "comp"], "left_semi").select(*ROW, "x0", "x1")


def fill_holes(runs: DataFrame, slides: DataFrame, max_area: DataFrame | None = None, diagonal: bool = True) -> DataFrame:
    """Bounded background components up to (slide_id, max_area) filled.

    A component touching the frame's border is never a hole.
    """
    background = label_runs(complement(runs, slides), diagonal).join(slides.select("slide_id", "height", "width"), "slide_id")
    border = (F.col("y") == 0) | (F.col("y") == F.col("height") - 1) | (F.col("x0") == 0) | (F.col("x1") == F.col("width") - 1)
    holes = background.groupBy("slide_id", "comp").agg(
        F.bool_or(border).alias("_border"), F.sum(F.col("x1") - F.col("x0") + 1).alias("area")
    ).filter("NOT _border")
    if max_area is not None:
        holes = holes.join(max_area, "slide_id").filter("area <= max_area")
    return union_runs(runs, background.join(holes.select("slide_id", "comp"), ["slide_id", "comp"], "left_semi"))


# -------------------------------------------------------------- morphology


def _grown(piece):  # noqa: ANN001, ANN202 - pandas frames
    """Dilated runs of one tile's own rows from all runs near it in one strip of columns.

    The vertical distance to the nearest set pixel of the column comes first
    (one pass down, one up); it says how far a column reaches to both sides,
    and a row's reaches are joined by a running sum of starts and ends.
    """
    import numpy as np
    import pandas as pd

    r, tile, rows = int(piece["radius"].iloc[0]), int(piece["tile"].iloc[0]), int(piece["tile_rows"].iloc[0])
    ys, starts, stops = (piece[name].to_numpy() for name in ("y", "x0", "x1"))
    first, last = max(tile * rows, ys.min() - r), min((tile + 1) * rows - 1, ys.max() + r)
    top, left, columns = min(first, ys.min()), starts.min(), stops.max() - starts.min() + 1
    mask = np.zeros((max(last, ys.max()) - top + 1, columns), bool)
    for y, x0, x1 in zip(ys - top, starts - left, stops - left):
        mask[y, x0 : x1 + 1] = True
    far = np.where(mask, 0, r + 1)
    for y in range(1, len(far)):
        np.minimum(far[y], far[y - 1] + 1, out=far[y])
    for y in range(len(far) - 2, -1, -1):
        np.minimum(far[y], far[y + 1] + 1, out=far[y])
    far = far[first - top : last - top + 1]
    reach = np.array([math.isqrt(r * r - d * d) for d in range(r + 1)])
    out = []
    width = columns + 2 * r + 1
    for at in range(0, len(far), 256):
        part = far[at : at + 256]
        y, x = np.nonzero(part <= r)
        w, n = reach[part[y, x]], len(part)
        edges = np.bincount(y * width + x + r - w, minlength=n * width) - np.bincount(y * width + x + r + w + 1, minlength=n * width)
        covered = np.zeros((n, width + 1), np.int8)
        covered[:, 1:] = edges.reshape(n, width).cumsum(axis=1) > 0
        turn = np.diff(covered, axis=1)
        (row, start), stop = np.nonzero(turn == 1), np.nonzero(turn == -1)[1]
        out.append(pd.DataFrame({"y": row + at + first, "x0": start + left - r, "x1": stop - 1 + left - r}))
    found = pd.concat(out)
    found.insert(0, "slide_id", piece["slide_id"].iloc[0])
    return found


def _pieces(runs: DataFrame, slides: DataFrame) -> DataFrame:
    """Runs cut into strips of columns, with each tile of rows that they can reach; three tiles at most."""
    rows = F.greatest(F.lit(TILE), F.col("radius") * 2)
    strips = F.sequence(F.floor(F.col("x0") / STRIP), F.floor(F.col("x1") / STRIP))
    tiles = F.sequence(F.floor((F.col("y") - F.col("radius")) / F.col("tile_rows")), F.floor((F.col("y") + F.col("radius")) / F.col("tile_rows")))
    return (
        runs.select(*ROW, "x0", "x1")
        .join(slides.select("slide_id", F.col("radius").cast("int").alias("radius"), rows.cast("int").alias("tile_rows")), "slide_id")
        .select(*ROW, "x0", "x1", "radius", "tile_rows", F.explode(strips).alias("strip"))
        .select("*", F.explode(tiles).alias("tile"))
        .withColumns({"x0": F.greatest("x0", F.col("strip") * STRIP), "x1": F.least("x1", (F.col("strip") + 1) * STRIP - 1)})
    )


def _lifted(runs: DataFrame, slides: DataFrame) -> DataFrame:
    """Every run once per row of the disk, as wide as the disk is there."""
    r, dy = F.col("radius"), F.col("dy")
    reach = F.floor(F.sqrt(r * r - dy * dy))
    copies = runs.select(*ROW, "x0", "x1").join(slides.select("slide_id", F.col("radius").cast("int").alias("radius")), "slide_id")
    copies = copies.select(*ROW, "x0", "x1", "radius", F.explode(F.sequence(-r, r)).alias("dy"))
    return copies.select("slide_id", (F.col("y") + dy).alias("y"), (F.col("x0") - reach).alias("x0"), (F.col("x1") + reach).alias("x1"))


def _in_tiles(runs: DataFrame, slides: DataFrame) -> DataFrame:
    """Dilated runs out of distance transforms of tiles."""
    # A stated number of partitions: few bytes a tile, but much work, so they must not be put together.
    key = ["slide_id", "tile", "strip"]
    pieces = _pieces(runs, slides).repartition(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)
    return pieces.groupBy(*key).applyInPandas(_grown, "slide_id bigint, y bigint, x0 bigint, x1 bigint")


def dilate(runs: DataFrame, slides: DataFrame) -> DataFrame:
    """Dilation by each slide's disk of ``radius`` pixels.

    A disk up to ``SMALL_RADIUS`` copies a run to the rows it reaches. Larger
    ones take a separable distance transform in tiles at least as tall as the
    disk, so a piece of a run goes to three of them at most whatever the
    radius, and a tile returns joined runs.
    """
    small = F.col("radius") <= SMALL_RADIUS
    seen = slides.agg(F.count_if(small).alias("small"), F.count_if(~small).alias("large")).first()
    if seen["small"] and seen["large"]:
        runs = cut_lineage(runs)
    ways = [(_lifted, small, seen["small"] or not seen["large"]), (_in_tiles, ~small, seen["large"])]
    grown = [way(runs, slides.filter(mine)).select([F.col(f.name).cast(f.dataType) for f in runs.select(*ROW, "x0", "x1").schema]) for way, mine, used in ways if used]
    return merge_runs(clip_runs(grown[0] if len(grown) == 1 else grown[0].unionByName(grown[1]), slides))


def close_runs(runs: DataFrame, slides: DataFrame) -> DataFrame:
    """Closing by each slide's disk; what lies off the frame neither grows nor erodes."""
    grown = dilate(runs, slides)
    return complement(dilate(complement(grown, slides), slides), slides)


def cleanup(runs: DataFrame, slides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Small components off, small holes filled, light closing: (mask, counts).

    ``slides`` brings min_area, max_hole and radius in pixels. ``counts`` has
    the components of every stage; the labels that pick small components
    also give the first two counts.
    """
    raw = label_runs(runs, diagonal=True)
    big = component_area(raw).join(slides.select("slide_id", "min_area"), "slide_id").withColumn("_big", F.col("area") >= F.col("min_area"))
    kept = raw.join(big.filter("_big").select("slide_id", "comp"), ["slide_id", "comp"], "left_semi").select(*ROW, "x0", "x1")
    filled = cut_lineage(fill_holes(kept, slides, slides.select("slide_id", F.col("max_hole").alias("max_area"))))
    closed = close_runs(filled, slides)
    counts = big.groupBy("slide_id").agg(F.count(F.lit(1)).alias("raw"), F.count_if("_big").alias("min_area"))
    for name, stage in (("hole_fill", filled), ("closing", closed)):
        n = label_runs(stage, diagonal=True).groupBy("slide_id").agg(F.count_distinct("comp").alias(name))
        counts = counts.join(n, "slide_id", "left")
    return closed, slides.select("slide_id").join(counts, "slide_id", "left").fillna(0)


def region_stats(runs: DataFrame, diagonal: bool = True) -> DataFrame:
    """Area, bounding box and number of boundary pixels of every component.

    Boundary pixels lack a set 4-neighbour: all but those inside a run that
    the rows above and below cover as well.
    """
    labelled = label_runs(runs, diagonal)
    stats = labelled.groupBy("slide_id", "comp").agg(
        F.sum(F.col("x1") - F.col("x0") + 1).alias("area"),
        F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
    )
    found = stats.join(covered_pixels(labelled), ["slide_id", "comp"], "left")
    return found.withColumn("n_boundary", F.col("area") - F.coalesce("n_covered", F.lit(0))).drop("n_covered")


def covered_pixels(labelled: DataFrame) -> DataFrame:
    """(slide_id, comp, n_covered): pixels inside their run with a set pixel above and below.

    A sweep over the ends of runs: in every row those of its own runs, one
    pixel narrower at both sides, and of the rows next to it. Between two
    ends the number of rows that cover the place stays the same.
    """

    def ends(dy: int, shrink: int) -> Column:
        own = F.lit(dy == 0)
        return F.array(
            F.struct((F.col("y") + dy).alias("y"), (F.col("x0") + shrink).alias("x"), F.lit(1).alias("step"), F.when(own, F.col("comp")).alias("own")),
            F.struct((F.col("y") + dy).alias("y"), (F.col("x1") + 1 - shrink).alias("x"), F.lit(-1).alias("step"), F.lit(None).cast("bigint").alias("own")),
        )

    inner = F.when(F.col("x1") - F.col("x0") >= 2, ends(0, 1)).otherwise(F.array())
    every = labelled.select("slide_id", F.inline(F.concat(inner, ends(-1, 0), ends(1, 0))))
    along = Window.partitionBy(*ROW).orderBy("x", "step")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    swept = every.select(
        "slide_id", F.sum("step").over(so_far).alias("covers"), F.last("own", ignorenulls=True).over(so_far).alias("comp"), (F.lead("x").over(along) - F.col("x")).alias("length")
    )
    return swept.filter("covers = 3").groupBy("slide_id", "comp").agg(F.sum("length").alias("n_covered"))
