"""Input relations derived from the given tables.

One slide per supplier and 48 x 48 pixels per slide: the number of slides
grows with the data. ``VIEW_SQL`` says the same for the SQL checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAME = 48
CELL_PITCH = 8


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def slides(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    return s.select(
        F.col("s_suppkey").cast("int").alias("slide_id"),
        F.col("s_name").alias("name"),
        F.lit(FRAME).alias("height"),
        F.lit(FRAME).alias("width"),
        (F.lit(0.25).cast("double") + (F.col("s_nationkey") % 4) * F.lit(0.125).cast("double")).alias("mpp"),
        F.when(F.col("s_nationkey") % 3 == 0, "uint8").when(F.col("s_nationkey") % 3 == 1, "uint16").otherwise("float32").alias("dtype"),
        F.concat(F.lit("/slides/"), F.col("s_name"), F.lit(".ome.tiff")).alias("path"),
    )


def pixels(spark: SparkSession, sf: str) -> DataFrame:
    """(slide_id, c, y, x, v): sparse 16-bit image, absent = 0."""
    li = table(spark, sf, "lineitem")
    return li.groupBy(
        F.col("l_suppkey").cast("int").alias("slide_id"),
        (F.col("l_linenumber") - 1).alias("c"),
        (F.col("l_orderkey") % FRAME).cast("int").alias("y"),
        (F.col("l_partkey") % FRAME).cast("int").alias("x"),
    ).agg(F.max((F.col("l_quantity") * 1000).cast("int")).alias("v"))


def _places(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("l_suppkey").cast("int").alias("slide_id"),
        (F.col("l_orderkey") % FRAME).cast("int").alias("y"),
        (F.col("l_partkey") % FRAME).cast("int").alias("x"),
    )


def pixel_lines(spark: SparkSession, sf: str) -> DataFrame:
    """(slide_id, y, x) of ``pixels`` with repeats: one row per line."""
    return _places(table(spark, sf, "lineitem"))


def tissue_lines(spark: SparkSession, sf: str) -> DataFrame:
    """(slide_id, y, x) of ``tissue_px`` with repeats: one row per bright enough line."""
    return _places(table(spark, sf, "lineitem").filter(F.col("l_quantity") > 10))


def tissue_px(spark: SparkSession, sf: str) -> DataFrame:
    """(slide_id, y, x): pixels with a bright enough line."""
    return tissue_lines(spark, sf).distinct()


def cell_px(spark: SparkSession, sf: str) -> DataFrame:
    """(slide_id, y, x, cell_id): one cell per 8 x 8 tile, ragged outline."""
    return pixels(spark, sf).select("slide_id", "y", "x").distinct().withColumn(
        "cell_id",
        (1 + F.floor(F.col("y") / CELL_PITCH) * (FRAME // CELL_PITCH) + F.floor(F.col("x") / CELL_PITCH)).cast("int"),
    )


def channels(spark: SparkSession, sf: str) -> DataFrame:
    """(slide_id, idx, raw, hint): twenty channels a slide, four spellings, QC names."""
    p = table(spark, sf, "part")
    key, size, name = F.col("p_partkey"), F.col("p_size"), F.col("p_name")
    raw = (
        F.when(size == 1, F.lit("DAPI"))
        .when(size == 2, F.concat(F.lit("HOECHST"), (key % 3).cast("string")))
        .when(size == 3, F.lit("Blank"))
        .when(size == 4, F.concat(F.lit("emptyA488-"), (key % 2).cast("string")))
        .when(size == 5, F.concat(name, F.lit(" x")))
        .when(key % 4 == 0, F.upper(name))
        .when(key % 4 == 1, F.replace(name, F.lit(" "), F.lit("-")))
        .when(key % 4 == 2, F.concat(F.lit("("), name, F.lit(")")))
        .otherwise(name)
    )
    return p.select(
        F.floor(key / 20).cast("int").alias("slide_id"),
        (key % 20).cast("int").alias("idx"),
        raw.alias("raw"),
        F.col("p_type").alias("hint"),
    )


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """(pos, marker_name, family): one row per part name."""
    p = table(spark, sf, "part")
    return p.groupBy(F.col("p_name").alias("marker_name")).agg(
        F.min("p_partkey").alias("pos"), F.min("p_type").alias("family")
    )


def edited_map(spark: SparkSession, sf: str) -> DataFrame:
    """A user-edited marker map: right, wrong, blank and novel rows."""
    pos = F.col("pos")
    names = channels(spark, sf).groupBy("raw").agg(F.min(F.col("slide_id") * 20 + F.col("idx")).cast("bigint").alias("pos"))
    clean = F.replace(F.lower("raw"), F.lit("-"), F.lit(" "))
    return names.select(
        F.col("raw").alias("original_name"),
        F.when(pos % 7 == 0, F.lit(""))
        .when(pos % 7 == 1, F.lit("Novel"))
        .when(pos % 7 == 2, F.lit("No such marker"))
        .when(pos % 7 == 3, F.lit(" small ring "))
        .otherwise(clean)
        .alias("mapped_canonical_name"),
        F.when(pos % 5 == 0, F.lit("review")).when(pos % 5 == 1, F.lit("NOVEL")).otherwise(F.lit("RESOLVED")).alias("status"),
        F.when(pos % 6 == 0, F.lit("No")).when(pos % 6 == 1, F.lit("")).otherwise(F.lit("yes")).alias("keep_for_analysis"),
    )


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Channels as stored after ingest: marker, match and keep filled."""
    ch = channels(spark, sf)
    clean = F.translate(F.lower("raw"), "- :()", "_____")
    return ch.select(
        "slide_id",
        "idx",
        "raw",
        "hint",
        clean.alias("marker"),
        F.when(F.col("hint") == "PROMO", F.lit("REVIEW")).otherwise(F.lit("RESOLVED")).alias("match"),
        F.when(F.col("hint") == "SMALL", F.lit(None).cast("boolean")).otherwise(F.col("hint") != "LARGE").alias("keep"),
    )


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """(name, marker_id, mean, std): part names but the old ones, plus dapi."""
    p = table(spark, sf, "part").filter(~F.col("p_name").like("old %"))
    rows = p.groupBy(F.replace("p_name", F.lit(" "), F.lit("_")).alias("name")).agg(
        F.min("p_partkey").alias("pos"),
        (2 * F.min("p_partkey") + 400).cast("int").alias("marker_id"),
        F.round(F.avg("p_retailprice") / 10000, 4).alias("mean"),
        F.round(F.max("p_retailprice") / 20000, 4).alias("std"),
    )
    dapi = table(spark, sf, "part").agg(F.lit("dapi").alias("name"), F.lit(-1).cast("bigint").alias("pos"),
                                        F.lit(4).alias("marker_id"), F.round(F.avg(F.lit(0.08).cast("double")), 4).alias("mean"),
                                        F.round(F.avg(F.lit(0.15).cast("double")), 4).alias("std"))
    return rows.unionByName(dapi)


def aliases(spark: SparkSession, sf: str) -> DataFrame:
    """(alias, name): old part names read as new ones; per-cycle stains as dapi."""
    p = table(spark, sf, "part")
    old = p.filter(F.col("p_name").like("old %") & ~F.col("p_name").like("% bolt")).select(
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("alias"),
        F.replace(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("old_"), F.lit("new_")).alias("name"),
    )
    stains = p.filter("p_size = 2").select(
        F.concat(F.lit("hoechst"), (F.col("p_partkey") % 3).cast("string")).alias("alias"), F.lit("dapi").alias("name")
    )
    return old.union(stains).distinct()


def task_events(spark: SparkSession, sf: str) -> DataFrame:
    """Append-only task ledger from the event stream."""
    e = table(spark, sf, "events")
    return e.select(*task_columns())


def task_columns() -> list:
    """Columns of the ledger over the event columns; also the streams use them."""
    kind, eid = F.col("event_type"), F.col("event_id")
    stage = F.element_at(
        F.array(*[F.lit(s) for s in ("ingest", "tissue", "cells", "patch", "extract")]), ((eid % 5) + 1).cast("int")
    )
    status = F.when(kind == "error", "error").when(kind == "click", "running").when(kind == "signup", "pending").otherwise("completed")
    key = F.when(stage.isin("ingest", "cells"), F.lit("")).otherwise(F.concat(F.lit("k"), (F.floor(eid / 5) % 3).cast("string")))
    return [
        F.col("user_id").alias("slide_id"),
        stage.alias("stage"),
        key.alias("task_key"),
        status.alias("status"),
        F.col("ts"),
        eid,
        F.when(kind == "error", F.concat(F.lit("failed with "), F.col("props"))).alias("error"),
        F.concat(stage, F.lit("/"), key, F.lit("/"), (eid % 4).cast("string")).alias("output"),
    ]


def cell_features(spark: SparkSession, sf: str) -> DataFrame:
    """Classifier and neighbour input: one row per embedding."""
    e = table(spark, sf, "embeddings")
    return e.select(
        (F.col("vec_id") + 1).alias("cell_id"),
        F.transform("embedding", lambda v: v.cast("double")).alias("features"),
        F.concat(F.lit("class_"), F.col("label").cast("string")).alias("label"),
        ((F.col("vec_id") * 37) % 1000).cast("double").alias("x"),
        ((F.col("vec_id") * 91) % 1000).cast("double").alias("y"),
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Truth, predicted class and a fold per lineitem row: ten classes, one dominant."""
    li = table(spark, sf, "lineitem")
    truth = F.when(F.col("l_discount") < 0.04, F.lit(0)).otherwise(F.col("l_linenumber"))
    wrong = F.col("l_tax") > 0.06
    return li.select(
        (F.col("l_suppkey") % 4 + 1).cast("int").alias("fold"),
        F.concat(F.lit("class_"), truth.cast("string")).alias("truth"),
        F.when(wrong, F.concat(F.lit("class_"), (F.col("l_partkey") % 10).cast("string")))
        .otherwise(F.concat(F.lit("class_"), truth.cast("string")))
        .alias("pred"),
        (F.col("l_extendedprice") / 110000).alias("score"),
    )


VIEW_SQL = {
    "slides": f"""
        SELECT CAST(s_suppkey AS INT) AS slide_id, s_name AS name, {FRAME} AS height, {FRAME} AS width,
               0.25::DOUBLE + (s_nationkey % 4) * 0.125::DOUBLE AS mpp,
               CASE s_nationkey % 3 WHEN 0 THEN 'uint8' WHEN 1 THEN 'uint16' ELSE 'float32' END AS dtype,
               '/slides/' || s_name || '.ome.tiff' AS path
        FROM supplier""",
    "pixels": f"""
        SELECT CAST(l_suppkey AS INT) AS slide_id, l_linenumber - 1 AS c, CAST(l_orderkey % {FRAME} AS INT) AS y,
               CAST(l_partkey % {FRAME} AS INT) AS x, MAX(CAST(l_quantity * 1000 AS INT)) AS v
        FROM lineitem GROUP BY 1, 2, 3, 4""",
    "tissue_px": f"""
        SELECT DISTINCT CAST(l_suppkey AS INT) AS slide_id, CAST(l_orderkey % {FRAME} AS INT) AS y,
               CAST(l_partkey % {FRAME} AS INT) AS x FROM lineitem WHERE l_quantity > 10""",
    "cell_px": f"""
        SELECT DISTINCT slide_id, y, x,
               CAST(1 + FLOOR(y / {CELL_PITCH}) * {FRAME // CELL_PITCH} + FLOOR(x / {CELL_PITCH}) AS INT) AS cell_id
        FROM pixels""",
    "channels": """
        SELECT CAST(FLOOR(p_partkey / 20) AS INT) AS slide_id, CAST(p_partkey % 20 AS INT) AS idx,
               CASE WHEN p_size = 1 THEN 'DAPI' WHEN p_size = 2 THEN 'HOECHST' || CAST(p_partkey % 3 AS VARCHAR)
                    WHEN p_size = 3 THEN 'Blank' WHEN p_size = 4 THEN 'emptyA488-' || CAST(p_partkey % 2 AS VARCHAR)
                    WHEN p_size = 5 THEN p_name || ' x' WHEN p_partkey % 4 = 0 THEN UPPER(p_name)
                    WHEN p_partkey % 4 = 1 THEN REPLACE(p_name, ' ', '-')
                    WHEN p_partkey % 4 = 2 THEN '(' || p_name || ')' ELSE p_name END AS raw,
               p_type AS hint
        FROM part""",
    "registry": """
        SELECT p_name AS marker_name, MIN(p_partkey) AS pos, MIN(p_type) AS family FROM part GROUP BY p_name""",
    "edited_map": """
        SELECT raw AS original_name,
               CASE pos % 7 WHEN 0 THEN '' WHEN 1 THEN 'Novel' WHEN 2 THEN 'No such marker' WHEN 3 THEN ' small ring '
                    ELSE REPLACE(LOWER(raw), '-', ' ') END AS mapped_canonical_name,
               CASE pos % 5 WHEN 0 THEN 'review' WHEN 1 THEN 'NOVEL' ELSE 'RESOLVED' END AS status,
               CASE pos % 6 WHEN 0 THEN 'No' WHEN 1 THEN '' ELSE 'yes' END AS keep_for_analysis
        FROM (SELECT raw, MIN(slide_id * 20 + idx) AS pos FROM channels GROUP BY raw)""",
    "panel": """
        SELECT slide_id, idx, raw, hint, TRANSLATE(LOWER(raw), '- :()', '_____') AS marker,
               CASE WHEN hint = 'PROMO' THEN 'REVIEW' ELSE 'RESOLVED' END AS match,
               CASE WHEN hint = 'SMALL' THEN NULL ELSE hint <> 'LARGE' END AS keep
        FROM channels""",
    "vocabulary": """
        SELECT REPLACE(p_name, ' ', '_') AS name, MIN(p_partkey) AS pos,
               CAST(2 * MIN(p_partkey) + 400 AS INT) AS marker_id,
               ROUND(AVG(p_retailprice) / 10000, 4) AS mean, ROUND(MAX(p_retailprice) / 20000, 4) AS std
        FROM part WHERE p_name NOT LIKE 'old %' GROUP BY 1
        UNION ALL SELECT 'dapi', -1, 4, 0.08::DOUBLE, 0.15::DOUBLE""",
    "aliases": """
        SELECT REPLACE(p_name, ' ', '_') AS alias, REPLACE(REPLACE(p_name, ' ', '_'), 'old_', 'new_') AS name
        FROM part WHERE p_name LIKE 'old %' AND p_name NOT LIKE '% bolt'
        UNION SELECT 'hoechst' || CAST(p_partkey % 3 AS VARCHAR), 'dapi' FROM part WHERE p_size = 2""",
    "task_events": """
        SELECT slide_id, stage, task_key, status, ts, event_id, error,
               stage || '/' || task_key || '/' || CAST(event_id % 4 AS VARCHAR) AS output
        FROM (SELECT *, CASE WHEN stage IN ('ingest', 'cells') THEN ''
                             ELSE 'k' || CAST(CAST(FLOOR(event_id / 5) AS BIGINT) % 3 AS VARCHAR) END AS task_key
              FROM (SELECT user_id AS slide_id, ts, event_id,
                           CASE event_id % 5 WHEN 0 THEN 'ingest' WHEN 1 THEN 'tissue' WHEN 2 THEN 'cells'
                                             WHEN 3 THEN 'patch' ELSE 'extract' END AS stage,
                           CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'running'
                                           WHEN 'signup' THEN 'pending' ELSE 'completed' END AS status,
                           CASE WHEN event_type = 'error' THEN 'failed with ' || props END AS error
                    FROM events))""",
    "cell_features": """
        SELECT vec_id + 1 AS cell_id, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS features,
               'class_' || CAST(label AS VARCHAR) AS label, CAST((vec_id * 37) % 1000 AS DOUBLE) AS x,
               CAST((vec_id * 91) % 1000 AS DOUBLE) AS y
        FROM embeddings""",
    "predictions": """
        SELECT CAST(l_suppkey % 4 + 1 AS INT) AS fold, 'class_' || CAST(t AS VARCHAR) AS truth,
               'class_' || CAST(CASE WHEN l_tax > 0.06::DOUBLE THEN l_partkey % 10 ELSE t END AS VARCHAR) AS pred,
               l_extendedprice / 110000 AS score
        FROM (SELECT *, CASE WHEN l_discount < 0.04::DOUBLE THEN 0 ELSE l_linenumber END AS t FROM lineitem)""",
}
