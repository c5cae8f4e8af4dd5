"""Readers: pixels, cohort listings, metadata files, registries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histoframe.functions import names as N
from histoframe.functions import numeric as X

# Registry columns.
REGISTRY_COLUMNS = ("marker_name", "compartment", "family", "compartment_desc", "family_desc", "marker_full_name")

# Columns of the novel-marker table.
ADDITIONAL_REQUIRED = ("marker_name", "compartment", "family", "family_desc", "marker_full_name")
ADDITIONAL_OPTIONAL = ("compartment_desc",)
ADDITIONAL_STATS = ("mean", "std")


def read_pixels(spark: SparkSession, path: str, slides: Sequence[int] | None = None, channels: Sequence[int] | None = None) -> DataFrame:
    """Pixel table partitioned by slide and channel; both filters prune folders."""
    df = spark.read.parquet(path)
    if slides is not None:
        df = df.filter(F.col("slide_id").isin(*slides))
    if channels is not None:
        df = df.filter(F.col("c").isin(*channels))
    return df


def read_splits(spark: SparkSession, path: str, fold: int | None = None, split: str | None = None) -> DataFrame:
    """Folds as written by ``write_splits``; fold and split prune folders."""
    df = spark.read.parquet(path)
    if fold is not None:
        df = df.filter(F.col("fold") == fold)
    if split is not None:
        df = df.filter(F.col("split") == split)
    return df


def list_inputs(spark: SparkSession, folder: str, pattern: str = "*.tif*", recursive: bool = True) -> DataFrame:
    """Image files under a folder; only the listing is read, never the content."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
        .select("path", "modificationTime", "length")
    )
    name = F.element_at(F.split("path", "/"), -1)
    return files.withColumn("name", name).withColumn("stem", N.output_stem(name)).withColumn("slide_hash", N.path_hash(F.col("path")))


def parse_ome(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Channel names and mpp out of a column of OME-XML; bad XML gives nulls.

    ``from_xml`` decides whether the text parses; XPath only sees text that did.
    """
    parses = F.from_xml(F.col(xml), "_corrupt STRING, Image STRING", {"columnNameOfCorruptRecord": "_corrupt"})
    good = F.when(parses["_corrupt"].isNull() & parses.isNotNull(), F.col(xml))
    root = "//*[local-name()='Pixels']"
    size = F.xpath_string(good, F.lit(f"{root}/@PhysicalSizeX"))
    unit = F.nullif(F.xpath_string(good, F.lit(f"{root}/@PhysicalSizeXUnit")), F.lit(""))
    names = F.xpath(good, F.lit("//*[local-name()='Channel']/@Name"))
    return df.select(
        "*",
        F.when(F.size(names) > 0, names).alias("channel_names"),
        X.to_microns(F.nullif(size, F.lit("")).try_cast("double"), unit).alias("mpp"),
    )


def require_columns(df: DataFrame, wanted: Sequence[str], what: str) -> DataFrame:
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")
    return df


def read_mpp_csv(spark: SparkSession, path: str) -> DataFrame:
    """Per-image resolution overrides; the last row of an image wins."""
    rows = spark.read.option("header", True).csv(path)
    require_columns(rows, ("image", "mpp"), "resolution table")
    # A place that is one number combines in a hash map, one with the file's name in it would sort all rows; so each file comes first.
    placed = rows.select("image", F.col("mpp").cast("double").alias("mpp"), F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_row"))
    by_file = placed.groupBy("image", "_file").agg(F.max_by("mpp", "_row").alias("mpp"))
    return by_file.groupBy("image").agg(F.max_by("mpp", "_file").alias("mpp"))


def read_channel_names(spark: SparkSession, path: str) -> DataFrame:
    """One name per line with its place in the file; blank lines dropped."""
    whole = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    lines = F.filter(F.transform(F.split("value", "\r\n|\r|\n"), N.strip), lambda s: s != "")
    return whole.select("file", F.posexplode(lines).alias("idx", "raw"))


def read_registry(spark: SparkSession, path: str, columns: Sequence[str] = REGISTRY_COLUMNS) -> DataFrame:
    """Registry table; ``#`` rows are comments."""
    df = spark.read.option("header", True).option("comment", "#").csv(path)
    return require_columns(df, columns, "registry").select(*columns)


def read_additional_markers(spark: SparkSession, path: str) -> DataFrame:
    """Novel-marker table as text; absent optional columns come back blank."""
    return complete_additional(spark.read.option("header", True).csv(path))


def complete_additional(df: DataFrame) -> DataFrame:
    require_columns(df, ADDITIONAL_REQUIRED, "novel-marker table")
    text = [F.coalesce(F.col(c), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c)
            for c in (*ADDITIONAL_REQUIRED, *ADDITIONAL_OPTIONAL)]
    stats = [F.when(~N.is_blank_cell(F.col(c)), F.col(c).try_cast("double")).alias(c) if c in df.columns
             else F.lit(None).cast("double").alias(c) for c in ADDITIONAL_STATS]
    return df.select(*text, *stats)


GEOMETRY = "struct<type: string, coordinates: string>"
FEATURES = f"struct<features: array<struct<geometry: {GEOMETRY}>>>"


def _polygons(geo: Column) -> Column:
    """Parts of a geometry as arrays of rings of points; null where it is of another type.

    Coordinates stay text until the geometry type is known.
    """
    poly = "array<array<array<double>>>"
    return F.when(geo["type"] == "Polygon", F.array(F.from_json(geo["coordinates"], poly))).when(
        geo["type"] == "MultiPolygon", F.from_json(geo["coordinates"], f"array<{poly}>")
    )


def geojson_drawings(df: DataFrame, text: str = "json", keys: Sequence[str] = ()) -> DataFrame:
    """One row per document, its polygons in ``drawing``: features of parts of rings of points, in file order."""
    features = F.from_json(text, FEATURES)["features"]
    return df.select(*keys, F.transform(features, lambda f: _polygons(f["geometry"])).alias("drawing"))


def geojson_rings(df: DataFrame, text: str = "json", keys: Sequence[str] = ()) -> DataFrame:
    """Polygon and MultiPolygon features to one row per ring, its points in an array, in file order.

    Other geometry types are ignored. ring 0 is the outline, later rings are
    holes.
    """
    feats = df.select(*keys, F.posexplode(F.from_json(text, FEATURES)["features"]).alias("feature", "f"))
    parts = feats.select(*keys, "feature", F.posexplode(_polygons(F.col("f.geometry"))).alias("part", "rings"))
    return parts.select(*keys, "feature", "part", F.posexplode("rings").alias("ring", "points"))


def ring_vertices(rings: DataFrame) -> DataFrame:
    """One row per vertex of ``points``, in order."""
    kept = [c for c in rings.columns if c != "points"]
    return rings.select(*kept, F.posexplode("points").alias("vertex", "p")).select(
        *kept, "vertex", F.col("p")[0].alias("x"), F.col("p")[1].alias("y")
    )


def flatten_geojson(df: DataFrame, text: str = "json", keys: Sequence[str] = ()) -> DataFrame:
    """Polygon and MultiPolygon features to one row per vertex, in file order."""
    return ring_vertices(geojson_rings(df, text, keys))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.option("wholetext", True).text(path)
    return flatten_geojson(files.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("json")), "json", ["file"])


STATE_SCHEMA = (
    "struct<name: string, tasks: map<string, string>, _corrupt: string>"
)


def parse_state(df: DataFrame, text: str = "json") -> DataFrame:
    """Task states out of state JSON: unknown fields kept, bad text flagged.

    Open content stays in a VARIANT; a document that does not parse gives a
    row with ``readable = false`` and no tasks instead of an error.
    """
    doc = F.try_parse_json(F.col(text))
    return df.withColumn("state", doc).withColumn("readable", doc.isNotNull())


TASK = "struct<status: string, started_at: string, completed_at: string, error: string, outputs: map<string, string>>"
SCALAR_STAGES, KEYED_STAGES = ("ingest", "cells"), ("tissue", "patch", "extract")


def state_tasks(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per recorded task of every readable state; absent = pending."""
    good = states.filter("readable")

    def default(task: Column) -> Column:
        return F.coalesce(task["status"], F.lit("pending"))

    parts = []
    for stage in SCALAR_STAGES:
        task = F.from_json(F.to_json(F.try_variant_get("state", f"$.tasks.{stage}", "variant")), TASK)
        parts.append(good.select(*keys, F.lit(stage).alias("stage"), F.lit("").alias("task_key"), task.alias("task")))
    for stage in KEYED_STAGES:
        tasks = F.from_json(F.to_json(F.try_variant_get("state", f"$.tasks.{stage}", "variant")), f"map<string, {TASK}>")
        parts.append(good.select(*keys, F.lit(stage).alias("stage"), F.explode(tasks).alias("task_key", "task")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        *keys,
        "stage",
        "task_key",
        default(F.col("task")).alias("status"),
        F.col("task.started_at").try_cast("timestamp").alias("started_at"),
        F.col("task.completed_at").try_cast("timestamp").alias("completed_at"),
        F.col("task.error").alias("error"),
        F.col("task.outputs").alias("outputs"),
    )
