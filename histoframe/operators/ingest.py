"""Metadata of incoming images: selection, resolution, agreement checks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histoframe.functions import numeric as X

# Fixed value: microns by which files of one slide may differ.
MPP_AGREEMENT = 1e-6

#: Crossings of rings and lines, and words of runs, that a task draws at once.
MOST_CROSSINGS = 1 << 20


def filter_inputs(inputs: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Inputs by exact entry name; include first, then exclude."""
    out = inputs
    if include:
        out = out.filter(F.col("name").isin(*include))
    if exclude:
        out = out.filter(~F.col("name").isin(*exclude))
    return out


def unmatched_names(wanted: DataFrame, inputs: DataFrame) -> DataFrame:
    """Names of a filter table that no input has."""
    return wanted.select("name").distinct().join(inputs.select("name"), "name", "left_anti")


def resolve_mpp(images: DataFrame, overrides: DataFrame, global_mpp: float | None = None) -> DataFrame:
    """Resolution of each image: override, then source, then global.

    An image without any has ``mpp`` null and problem ``no_mpp``; a value
    outside the usual range is only flagged.
    """
    lo, hi = X.MPP_USUAL_RANGE
    value = F.coalesce("_override", "source_mpp", F.lit(global_mpp).cast("double"))
    joined = images.join(overrides.select("image", F.col("mpp").alias("_override")), "image", "left")
    return (
        joined.withColumn("mpp", value)
        .withColumn("origin", F.when(F.col("_override").isNotNull(), "override").when(F.col("source_mpp").isNotNull(), "source").when(F.col("mpp").isNotNull(), "global").otherwise("none"))
        .withColumn("problem", F.when(F.col("mpp").isNull(), "no_mpp").when(~F.col("mpp").between(X.d(lo), X.d(hi)), "unusual").otherwise(""))
        .drop("_override")
    )


def mpp_agreement(files: DataFrame) -> DataFrame:
    """One resolution per folder: none, agreed, mixed with none, or differing."""
    stats = files.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("mpp").alias("n_tagged"),
        F.min_by("mpp", F.when(F.col("mpp").isNotNull(), F.col("file"))).alias("_first"),
        F.min("mpp").alias("_lo"),
        F.max("mpp").alias("_hi"),
    )
    spread = F.greatest(F.col("_hi") - F.col("_first"), F.col("_first") - F.col("_lo"))
    state = (
        F.when(F.col("n_tagged") == 0, "none")
        .when(F.col("n_tagged") < F.col("n"), "mixed")
        .when(spread > MPP_AGREEMENT, "disagree")
        .otherwise("agreed")
    )
    return stats.select("folder", state.alias("state"), F.when(state == "agreed", F.col("_first")).alias("mpp"))


def shape_agreement(files: DataFrame) -> DataFrame:
    """Folders whose files do not share one (height, width)."""
    return (
        files.groupBy("folder")
        .agg(F.count_distinct("height", "width").alias("n_shapes"))
        .withColumn("uniform", F.col("n_shapes") == 1)
    )


def pick_channel_names(images: DataFrame) -> DataFrame:
    """Name of every channel slot of an image.

    ``ome_names`` where their number fits ``n_slots``, else ``labels`` where
    theirs does, else null. Cycle is the slot over the slots of a cycle.
    """
    none = F.transform(F.sequence(F.lit(1), F.col("n_slots")), lambda _: F.lit(None).cast("string"))
    names = (
        F.when(F.size("ome_names") == F.col("n_slots"), F.col("ome_names"))
        .when(F.size("labels") == F.col("n_slots"), F.col("labels"))
        .otherwise(none)
    )
    return images.select("image", "n_per_cycle", F.posexplode(names).alias("idx", "raw")).select(
        "image", "idx", "raw", F.floor(F.col("idx") / F.col("n_per_cycle")).cast("int").alias("cycle")
    )


def override_names(channels: DataFrame, names: DataFrame) -> DataFrame:
    """Channel names replaced by a list of the same length; else an error."""
    n_have = channels.groupBy("image").agg(F.count(F.lit(1)).alias("_have"))
    n_given = names.select(F.count(F.lit(1))).scalar()
    joined = channels.join(n_have, "image").join(names.select("idx", F.col("raw").alias("_new")), "idx", "left")
    fits = F.when(F.col("_have") == n_given, F.col("_new")).otherwise(
        F.raise_error(F.concat(F.lit("channel list does not fit image "), F.col("image")))
    )
    return joined.withColumn("raw", fits).drop("_have", "_new")


def match_artifacts(slides: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Artifact file of each slide by stem: one, none (skip) or several (error)."""
    by_stem = artifacts.groupBy("stem").agg(F.count(F.lit(1)).alias("_n"), F.min("file").alias("_file"))
    state = F.when(F.col("_n").isNull(), "skip").when(F.col("_n") > 1, "ambiguous").otherwise("found")
    return slides.join(by_stem, "stem", "left").select(
        *slides.columns, state.alias("state"), F.when(state == "found", F.col("_file")).alias("file")
    )


def rasterize_polygons(
    vertices: DataFrame, slides: DataFrame, keys: Sequence[str] = ("slide_id",), union: Sequence[str] | None = None
) -> DataFrame:
    """Pixels inside polygons, drawn ring by ring in file order.

    ``vertices`` has the keys, feature, part, ring, vertex, x, y. Every edge
    is expanded to the scan lines (pixel centres) it crosses; crossings of
    one ring on one line pair up in x order; each pair becomes a run of
    pixels. An outline (ring 0) sets its pixels and a hole clears them,
    whatever drew them before, so the last ring over a pixel decides.
    ``union`` names some of the keys: pixels of all drawings that share them,
    each once.
    """
    from pyspark.sql import Window

    poly = [*keys, "feature", "part", "ring"]
    ring = Window.partitionBy(*poly).orderBy("vertex")
    whole = Window.partitionBy(*poly).orderBy("vertex").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = vertices.select(
        *poly, F.col("x").alias("x0"), F.col("y").alias("y0"),
        F.coalesce(F.lead("x").over(ring), F.first("x").over(whole)).alias("x1"),
        F.coalesce(F.lead("y").over(ring), F.first("y").over(whole)).alias("y1"),
    ).filter("y0 <> y1")
    half = X.d(0.5)
    lo = F.ceil(F.least("y0", "y1") - half).cast("int")
    hi = (F.ceil(F.greatest("y0", "y1") - half) - 1).cast("int")
    lines = edges.filter(lo <= hi).withColumn("y", F.explode(F.sequence(lo, hi)))
    at = F.col("x0") + (F.col("y") + half - F.col("y0")) * (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
    order = Window.partitionBy(*poly, "y").orderBy("at")
    crossings = lines.withColumn("at", at).select(
        *poly, "y", "at", F.lead("at").over(order).alias("to"), F.row_number().over(order).alias("n")
    )
    first = F.greatest(F.lit(0), F.ceil(F.col("at") - half).cast("int"))
    last = F.least(F.col("width") - 1, (F.ceil(F.col("to") - half) - 1).cast("int"))
    runs = (
        crossings.filter("n % 2 = 1")
        .join(slides.select("slide_id", "height", "width"), "slide_id")
        .filter((first <= last) & F.col("y").between(0, F.col("height") - 1))
    )
    # 64 columns are one number: a line's rings are drawn over it in file order, bit by bit.
    words = F.explode(F.sequence(F.shiftright(first, 6), F.shiftright(last, 6))).alias("word")
    parts = runs.select(*poly, "y", first.alias("_first"), last.alias("_last"), words)
    low = F.greatest(F.lit(0), F.col("_first") - F.col("word") * 64)
    high = F.least(F.lit(63), F.col("_last") - F.col("word") * 64)
    bits = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), F.lit(63) - (high - low))
    drawn = parts.select(*poly, "y", "word", F.call_function("shiftleft", bits, low).alias("bits"))
    rings = drawn.groupBy(*poly, "y", "word").agg(F.bit_or("bits").alias("bits"))
    order = F.array_sort(F.collect_list(F.struct("feature", "part", "ring", "bits")))

    def draw(seen: Column, ring: Column) -> Column:
        return F.when(ring["ring"] == 0, seen.bitwiseOR(ring["bits"])).otherwise(seen.bitwiseAND(F.bitwise_not(ring["bits"])))

    words = rings.groupBy(*keys, "y", "word").agg(F.aggregate(order, F.lit(0).cast("bigint"), draw).alias("bits"))
    return _word_pixels(words, keys, union)


def _word_pixels(words: DataFrame, keys: Sequence[str], union: Sequence[str] | None) -> DataFrame:
    """Pixels of (keys, y, word, bits), or those of all words that share the keys of ``union``, each once."""
    if union is not None:
        words = words.groupBy(*union, "y", "word").agg(F.bit_or("bits").alias("bits"))
    names = keys if union is None else union
    is_set = F.call_function("shiftrightunsigned", F.col("bits"), F.col("_bit")).bitwiseAND(F.lit(1)) == 1
    pixels = words.filter("bits <> 0").select(*names, "y", "word", "bits", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("_bit"))
    return pixels.filter(is_set).select(*names, "y", (F.col("word") * 64 + F.col("_bit")).cast("int").alias("x"))


def _edges(drawing, heights):  # noqa: ANN001, ANN202 - Arrow column and numpy rows
    """(drawing, ring, outline) of each ring, and (ring, x0, y0, x1, y1, first line, lines) of the edges that cross lines of the frame."""
    import numpy as np

    def opened(lists):  # noqa: ANN001, ANN202 - Arrow column of lists
        return lists.flatten(), np.asarray(lists.value_parent_indices())

    features, of_drawing = opened(drawing)
    parts, of_feature = opened(features)
    rings, of_part = opened(parts)
    points, of_ring = opened(rings)
    numbers, of_point = opened(points)
    owner = of_drawing[of_feature[of_part]]
    outline = np.arange(len(of_part)) == np.searchsorted(of_part, of_part)
    size, numbers = np.bincount(of_point, minlength=len(points)), np.append(numbers.to_numpy(zero_copy_only=False).astype(float), np.nan)
    at = np.where(size >= 2, np.cumsum(size) - size, len(numbers) - 1)
    x, y = numbers[at], numbers[np.minimum(at + 1, len(numbers) - 1)]
    whole = np.isfinite(x) & np.isfinite(y)
    x, y, ring = x[whole], y[whole], of_ring[whole]
    after = np.arange(1, len(ring) + 1)
    ends = np.flatnonzero(np.append(np.diff(ring) > 0, np.ones(min(1, len(ring)), bool)))
    after[ends] = np.searchsorted(ring, ring[ends])
    edge = (ring, x, y, x[after], y[after])
    low = np.clip(np.ceil(np.minimum(y, edge[4]) - 0.5), 0, heights[owner[ring]])
    high = np.clip(np.ceil(np.maximum(y, edge[4]) - 0.5), 0, heights[owner[ring]])
    crosses = low < high
    return (owner, outline), tuple(c[crosses] for c in (*edge, low.astype("int64"), (high - low).astype("int64")))


def _stretches(sizes, places, most: int):  # noqa: ANN001, ANN202 - numpy rows
    """Slices of rows whose sizes sum up to ``most`` or that are one place; rows of a place are together."""
    import numpy as np

    ends = np.flatnonzero(np.append(np.diff(places) != 0, True)) + 1 if len(places) else np.empty(0, int)
    total, start = np.append(0, np.cumsum(sizes))[ends], 0
    while start < len(ends):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + most, "right")))
        yield slice(ends[start - 1] if start else 0, ends[stop - 1])
        start = stop


def _counted_up(sizes):  # noqa: ANN001, ANN202 - numpy rows
    """Each row's index as often as its size says, and the counts from 0 beside it."""
    import numpy as np

    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def drawn_words(drawing, heights, widths):  # noqa: ANN001, ANN201 - Arrow column and numpy rows
    """(drawing, y, word, bits) of the pixels that are set once all rings of each drawing are drawn in their order."""
    import numpy as np

    (owner, outline), edges = _edges(drawing, heights)
    for some in _stretches(edges[-1], owner[edges[0]], MOST_CROSSINGS):
        ring, x0, y0, x1, y1, low, lines = (c[some] for c in edges)
        e, line = _counted_up(lines)
        y, ring = low[e] + line, ring[e]
        at = x0[e] + (y + 0.5 - y0[e]) * (x1[e] - x0[e]) / (y1[e] - y0[e])
        order = np.lexsort((at, y, ring))
        ring, y, at = ring[order][::2], y[order][::2], at[order]
        # A closed ring crosses the middle of a line an even number of times.
        last = np.clip(np.ceil(at[1::2] - 0.5), 0, widths[owner[ring]]).astype("int64") - 1
        first = np.clip(np.ceil(at[::2] - 0.5), 0, widths[owner[ring]]).astype("int64")
        order = np.lexsort((ring, y, owner[ring]))
        order = order[(first <= last)[order]]
        ring, y, first, last = ring[order], y[order], first[order], last[order]
        of = owner[ring]
        n_words = (last >> 6) - (first >> 6) + 1
        for part in _stretches(n_words, np.cumsum(np.append(0, (np.diff(of) != 0) | (np.diff(y) != 0)))[: len(of)], MOST_CROSSINGS):
            run, word = _counted_up(n_words[part])
            run += part.start
            word += first[run] >> 6
            begin, end = np.maximum(first[run] - word * 64, 0), np.minimum(last[run] - word * 64, 63)
            bits = (np.uint64(2**64 - 1) >> (63 - (end - begin)).astype("uint64")) << begin.astype("uint64")
            order = np.lexsort((ring[run], word, y[run], of[run]))
            run, word, bits = run[order], word[order], bits[order]
            sets = outline[ring[run]]
            new = np.append(True, (np.diff(of[run]) != 0) | (np.diff(y[run]) != 0) | (np.diff(word) != 0))[: len(run)]
            starts = np.flatnonzero(new)
            left, drawn, live, k = np.diff(np.append(starts, len(run))), np.zeros(len(starts), "uint64"), np.arange(len(starts)), 0
            while len(live):
                now = starts[live] + k
                drawn[live] = np.where(sets[now], drawn[live] | bits[now], drawn[live] & ~bits[now])
                k += 1
                live = live[left[live] > k]
            kept = drawn != 0
            at_row = run[starts][kept]
            yield of[at_row], y[at_row], word[starts][kept], drawn[kept]


def rasterize_drawings(drawings: DataFrame, slides: DataFrame, keys: Sequence[str] = ("slide_id",), union: Sequence[str] | None = None) -> DataFrame:
    """Pixels inside polygons as of ``rasterize_polygons``, of rows that hold a whole ``drawing`` each (``geojson_drawings``).

    A task draws one row after the other, so nothing but the words of 64
    columns that are left set is shuffled, and only where drawings are united.
    Points without two finite numbers are left out of their ring, lines and
    columns off the frame are never drawn.
    """
    framed = drawings.join(slides.select("slide_id", F.col("height").cast("bigint").alias("_height"), F.col("width").cast("bigint").alias("_width")), "slide_id")

    def draw(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            *held, heights, widths, drawing = batch.columns
            for of, y, word, bits in drawn_words(drawing, heights.to_numpy(), widths.to_numpy()):
                columns = [c.take(pa.array(of)) for c in held] + [pa.array(y.astype("int32")), pa.array(word.astype("int32")), pa.array(bits.view("int64"))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keys, "y", "word", "bits"])

    rows = framed.select(*keys, "_height", "_width", "drawing")
    kinds = ", ".join(f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in keys)
    return _word_pixels(rows.mapInArrow(draw, f"{kinds}, y int, word int, bits bigint"), keys, union)
