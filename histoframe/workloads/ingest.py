"""Source, metadata and ingest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from histoframe.functions import names as N
from histoframe.functions import numeric as X
from histoframe.operators import ingest as G
from histoframe.session import scratch_path
from histoframe.sources import readers, sinks
from histoframe.workloads import inputs as I
from histoframe.workloads import workload


@workload(
    "src_inputs",
    """SELECT unnest(['benchmark', 'conversations', 'customer', 'documents', 'embeddings', 'events', 'labels', 'lineitem', 'nation', 'orders', 'pages',
                      'part', 'region', 'supplier']) AS stem""",
)
def src_inputs(spark, sf):
    """Listing of the data folder itself; a table that is a folder of files counts once."""
    files = readers.list_inputs(spark, sf, "*.parquet")
    return files.select(F.regexp_extract("path", r"([^/]+)\.parquet(/[^/]*)?$", 1).alias("stem")).distinct()


@workload("image_select", "SELECT s_suppkey, s_name AS name FROM supplier WHERE s_name IN ('Supplier#000000001', 'Supplier#000000003') AND s_name <> 'Supplier#000000003'")
def image_select(spark, sf):
    inputs = I.table(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("name"))
    return G.filter_inputs(inputs, ["Supplier#000000001", "Supplier#000000003"], ["Supplier#000000003"])


@workload("image_select_unmatched", "SELECT DISTINCT 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS name FROM customer WHERE name NOT IN (SELECT s_name FROM supplier)")
def image_select_unmatched(spark, sf):
    wanted = I.table(spark, sf, "customer").select(F.concat(F.lit("Supplier#"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("name"))
    return G.unmatched_names(wanted, I.table(spark, sf, "supplier").select(F.col("s_name").alias("name")))


UNIT = "CASE p_size % 4 WHEN 0 THEN 'µm' WHEN 1 THEN 'nm' WHEN 2 THEN 'parsec' END"


@workload(
    "src_ome_meta",
    f"""SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN '' ELSE p_name || '|' || p_brand END AS names,
            ROUND(COALESCE(CASE WHEN p_size % 5 = 0 OR p_partkey % 7 = 0 THEN NULL WHEN p_size % 4 = 1 THEN p_retailprice / 1000
                 WHEN p_size % 4 = 2 THEN NULL ELSE p_retailprice END, -1), 6) AS mpp FROM part""",
)
def src_ome_meta(spark, sf):
    """OME-XML made from parts: units vary, some sizes are no number, some XML is cut."""
    p = I.table(spark, sf, "part")
    unit = F.when(F.col("p_size") % 4 == 0, "µm").when(F.col("p_size") % 4 == 1, "nm").when(F.col("p_size") % 4 == 2, "parsec")
    size = F.when(F.col("p_partkey") % 7 == 0, F.lit("wide")).otherwise(F.col("p_retailprice").cast("string"))
    xml = F.concat(
        F.lit('<OME xmlns="http://www.openmicroscopy.org/Schemas/OME/2016-06"><Image><Pixels PhysicalSizeX="'), size, F.lit('"'),
        F.when(unit.isNotNull(), F.concat(F.lit(' PhysicalSizeXUnit="'), unit, F.lit('"'))).otherwise(F.lit("")),
        F.lit('><Channel Name="'), "p_name", F.lit('"/><Channel Name="'), "p_brand", F.lit('"/></Pixels></Image></OME>'),
    )
    docs = p.select("p_partkey", F.when(F.col("p_size") % 5 == 0, F.left(xml, F.length(xml) - 20)).otherwise(xml).alias("xml"))
    meta = readers.parse_ome(docs)
    return meta.select(
        "p_partkey", F.coalesce(F.array_join("channel_names", "|"), F.lit("")).alias("names"), F.round(F.coalesce("mpp", X.d(-1)), 6).alias("mpp")
    )


@workload(
    "src_mpp_csv",
    "SELECT CAST(l_suppkey AS VARCHAR) || '.tif' AS image, MAX(l_orderkey * 10 + l_linenumber) / 100000 AS mpp FROM lineitem GROUP BY 1",
)
def src_mpp_csv(spark, sf):
    """Repeated images in sorted files, as many as the rows need; the last row counts."""
    li = I.table(spark, sf, "lineitem")
    at = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    path = scratch_path(spark, "mpp")
    rows = li.select(F.concat(F.col("l_suppkey").cast("string"), F.lit(".tif")).alias("image"), (at / 100000).alias("mpp"), at.alias("at"))
    rows.repartitionByRange("at").sortWithinPartitions("at").drop("at").write.option("header", True).csv(path)
    return readers.read_mpp_csv(spark, path)


@workload(
    "src_channel_names",
    """SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INT) AS idx, s AS raw FROM (
            SELECT doc_id, i, trim(regexp_replace(l, '^\\s+|\\s+$', '', 'g')) AS s
            FROM (SELECT doc_id, unnest(lines) AS l, unnest(range(len(lines))) AS i FROM (
                SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS lines FROM documents))) WHERE s <> ''""",
)
def src_channel_names(spark, sf):
    """Every document read as a channel list, one file each would be the same."""
    docs = I.table(spark, sf, "documents")
    lines = F.filter(F.transform(F.split("text", "\r\n|\r|\n"), N.strip), lambda s: s != "")
    return docs.select("doc_id", F.posexplode(lines).alias("idx", "raw"))


SQUARES = """sq AS (SELECT CAST(l_suppkey AS INT) AS slide_id, l_orderkey AS o, l_linenumber AS n, l_partkey % 30 AS x, l_orderkey % 30 AS y, 4 + l_linenumber AS s FROM lineitem)"""


def _geojson(spark, sf):
    """One feature collection per order: squares with a hole, multi-polygons, a point.

    Numbers are shuffled, and written as text where all of an order are.
    """
    lines = I.table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("int").alias("slide_id"), F.col("l_orderkey").alias("o"), "l_linenumber", "l_partkey")
    orders = lines.repartition("slide_id", "o").groupBy("slide_id", "o").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("fs"))

    def ring(x0, y0, side):
        return F.array(*[F.array(x0 + dx * side, y0 + dy * side) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])

    def feature(line):
        n, x, y = line["l_linenumber"], (line["l_partkey"] % 30).cast("double"), (F.col("o") % 30).cast("double")
        s = (n + 4).cast("double")
        poly = F.array(ring(x, y, s), ring(x + 1, y + 1, s - 3))
        multi = F.to_json(F.struct(F.struct(F.lit("MultiPolygon").alias("type"), F.array(poly, F.array(ring(x, y + 10, s))).alias("coordinates")).alias("geometry")))
        single = F.to_json(F.struct(F.struct(F.lit("Polygon").alias("type"), poly.alias("coordinates")).alias("geometry")))
        point = F.to_json(F.struct(F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates")).alias("geometry")))
        return F.when(n % 3 == 0, multi).when(n % 3 == 1, single).otherwise(point)

    features = F.array_join(F.transform("fs", feature), ",")
    return orders.select("slide_id", "o", F.concat(F.lit('{"type":"FeatureCollection","features":['), features, F.lit("]}")).alias("json"))


@workload(
    "src_geojson",
    f"""WITH {SQUARES}, v AS (SELECT * FROM (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1), (4, 0, 0)) t(k, dx, dy)),
        r AS (SELECT slide_id, o, n, x, y, s, 0 AS part, 0 AS ring FROM sq WHERE n % 3 <> 2
              UNION ALL SELECT slide_id, o, n, x + 1, y + 1, s - 3, 0, 1 FROM sq WHERE n % 3 <> 2
              UNION ALL SELECT slide_id, o, n, x, y + 10, s, 1, 0 FROM sq WHERE n % 3 = 0)
        SELECT slide_id, part, ring, k AS vertex, CAST(x + dx * s AS DOUBLE) AS x, CAST(y + dy * s AS DOUBLE) AS y, COUNT(*) AS n
        FROM r CROSS JOIN v GROUP BY 1, 2, 3, 4, 5, 6""",
)
def src_geojson(spark, sf):
    """Whole rings are shuffled, and vertices counted where all of a place are.

    A ring grows to its vertices after the shuffle, so there are more
    partitions than usual, and a number of them that stays as it is.
    """
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rings = readers.geojson_rings(_geojson(spark, sf), "json", ["slide_id"]).repartition(n, "slide_id", "part", "ring")
    return readers.ring_vertices(rings).groupBy("slide_id", "part", "ring", "vertex", "x", "y").agg(F.count(F.lit(1)).alias("n"))


@workload(
    "poly_rasterize",
    f"""WITH {SQUARES}, g AS (SELECT CAST(i AS INT) AS i FROM range(48) t(i)),
        f AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY slide_id, o ORDER BY n, p) AS feature FROM (SELECT sq.*, x AS p FROM sq)),
        ring AS (SELECT slide_id, o, feature * 4 AS k, TRUE AS fill, x, y, s FROM f WHERE n % 3 <> 2
                 UNION ALL SELECT slide_id, o, feature * 4 + 1, FALSE, x + 1, y + 1, s - 3 FROM f WHERE n % 3 <> 2
                 UNION ALL SELECT slide_id, o, feature * 4 + 2, TRUE, x, y + 10, s FROM f WHERE n % 3 = 0),
        drawn AS (SELECT slide_id, o, a.i AS y, b.i AS x, arg_max(fill, k) AS fill
                  FROM ring q JOIN g a ON a.i >= q.y AND a.i < q.y + s JOIN g b ON b.i >= q.x AND b.i < q.x + s GROUP BY 1, 2, 3, 4)
        SELECT DISTINCT slide_id, y, x FROM drawn WHERE fill""",
)
def poly_rasterize(spark, sf):
    drawings = readers.geojson_drawings(_geojson(spark, sf), "json", ["slide_id", "o"])
    return G.rasterize_drawings(drawings, I.slides(spark, sf), ["slide_id", "o"], union=["slide_id"])


@workload(
    "sink_geojson",
    """SELECT CAST(l_suppkey AS INT) AS slide_id, l_orderkey AS tissue_id,
            '{"type":"Feature","properties":{"tissue_id":' || l_orderkey || ',"classification":{"name":"Tissue"}},"geometry":{"type":"Polygon","coordinates":['
            || string_agg(ring, ',' ORDER BY k) || ']}}' AS feature
       FROM (SELECT l_suppkey, l_orderkey, l_returnflag AS k, '[' || string_agg('[' || l_partkey || ',' || l_linenumber || ']', ',' ORDER BY l_partkey, l_linenumber) || ']' AS ring
             FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1, 2""",
)
def sink_geojson(spark, sf):
    rings = I.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("slide_id"), F.col("l_orderkey").alias("tissue_id"), F.col("l_returnflag").alias("ring"),
        F.struct("l_partkey", "l_linenumber").alias("vertex"), F.col("l_partkey").alias("x"), F.col("l_linenumber").cast("bigint").alias("y"),
    )
    path = scratch_path(spark, "geojson")
    sinks.write_geojson(sinks.tissue_features(rings), path)
    tid = F.get_json_object("feature", "$.properties.tissue_id").cast("bigint")
    return sinks.read_tissue(spark, path).select("slide_id", tid.alias("tissue_id"), "feature")


@workload(
    "src_additional",
    """SELECT p_name AS marker_name, p_type AS compartment, p_brand AS family, '' AS family_desc, CASE WHEN p_size % 6 = 0 THEN '' ELSE p_name || ' full' END AS marker_full_name,
            '' AS compartment_desc, COALESCE(CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE p_retailprice END, -1) AS mean, -1::DOUBLE AS std FROM part""",
)
def src_additional(spark, sf):
    """A novel-marker file without std and compartment_desc columns."""
    p = I.table(spark, sf, "part")
    path = scratch_path(spark, "additional")
    mean = F.when(F.col("p_size") % 3 == 0, F.lit("")).when(F.col("p_size") % 3 == 1, F.lit("nan")).otherwise(F.col("p_retailprice").cast("string"))
    p.select(
        F.col("p_name").alias("marker_name"), F.col("p_type").alias("compartment"), F.col("p_brand").alias("family"), F.lit("").alias("family_desc"),
        F.when(F.col("p_size") % 6 == 0, "").otherwise(F.concat("p_name", F.lit(" full"))).alias("marker_full_name"), mean.alias("mean"),
    ).write.option("header", True).csv(path)
    return readers.read_additional_markers(spark, path).fillna(-1.0, ["mean", "std"])


@workload(
    "mpp_resolve",
    """WITH i AS (SELECT s_name AS image, s_nationkey, CASE WHEN s_nationkey % 2 = 0 THEN 0.02::DOUBLE * s_nationkey END AS source_mpp FROM supplier),
        o AS (SELECT s_name AS image, 0.3::DOUBLE AS mpp FROM supplier WHERE s_nationkey % 5 = 0)
       SELECT image, ROUND(COALESCE(source_mpp, -1), 6) AS source_mpp, ROUND(m, 6) AS mpp, origin, CASE WHEN m BETWEEN 0.1::DOUBLE AND 1 THEN '' ELSE 'unusual' END AS problem
       FROM (SELECT i.image, source_mpp, COALESCE(o.mpp, source_mpp, 1.5::DOUBLE) AS m,
                    CASE WHEN o.mpp IS NOT NULL THEN 'override' WHEN source_mpp IS NOT NULL THEN 'source' ELSE 'global' END AS origin FROM i LEFT JOIN o USING (image))""",
)
def mpp_resolve(spark, sf):
    s = I.table(spark, sf, "supplier")
    images = s.select(F.col("s_name").alias("image"), F.when(F.col("s_nationkey") % 2 == 0, X.d(0.02) * F.col("s_nationkey")).alias("source_mpp"))
    overrides = s.filter("s_nationkey % 5 = 0").select(F.col("s_name").alias("image"), X.d(0.3).alias("mpp"))
    out = G.resolve_mpp(images, overrides, 1.5)
    return out.withColumn("source_mpp", F.round(F.coalesce("source_mpp", X.d(-1)), 6)).withColumn("mpp", F.round("mpp", 6))


FILES = """files AS (SELECT l_orderkey AS folder, l_partkey * 10 + l_linenumber AS file, CASE WHEN l_orderkey % 3 = 0 THEN NULL WHEN l_orderkey % 3 = 1 AND l_returnflag = 'A' THEN NULL
    ELSE 0.5::DOUBLE + CASE WHEN l_orderkey % 5 = 0 THEN l_linenumber * 0.001::DOUBLE ELSE 0 END END AS mpp, 100 + CASE WHEN l_orderkey % 4 = 0 THEN l_linenumber ELSE 0 END AS height, 200 AS width FROM lineitem)"""


def _files(spark, sf):
    li = I.table(spark, sf, "lineitem")
    o, n = F.col("l_orderkey"), F.col("l_linenumber")
    return li.select(
        o.alias("folder"), (F.col("l_partkey") * 10 + n).alias("file"),
        F.when((o % 3 == 0) | ((o % 3 == 1) & (F.col("l_returnflag") == "A")), F.lit(None).cast("double"))
        .otherwise(X.d(0.5) + F.when(o % 5 == 0, n * X.d(0.001)).otherwise(X.d(0))).alias("mpp"),
        (100 + F.when(o % 4 == 0, n).otherwise(0)).alias("height"), F.lit(200).alias("width"),
    )


@workload(
    "mpp_agreement",
    f"""WITH {FILES}, f AS (SELECT folder, COUNT(*) AS n, COUNT(mpp) AS t, arg_min(mpp, file) FILTER (mpp IS NOT NULL) AS m, MIN(mpp) AS lo, MAX(mpp) AS hi FROM files GROUP BY 1),
        s AS (SELECT *, CASE WHEN t = 0 THEN 'none' WHEN t < n THEN 'mixed' WHEN GREATEST(hi - m, m - lo) > 1e-6::DOUBLE THEN 'disagree' ELSE 'agreed' END AS state FROM f)
        SELECT folder, state, ROUND(CASE WHEN state = 'agreed' THEN m ELSE -1 END, 6) AS mpp FROM s""",
)
def mpp_agreement(spark, sf):
    return G.mpp_agreement(_files(spark, sf)).withColumn("mpp", F.round(F.coalesce("mpp", X.d(-1)), 6))


@workload("shape_agreement", f"WITH {FILES} SELECT folder, COUNT(DISTINCT height * 1000 + width) AS n_shapes, COUNT(DISTINCT height * 1000 + width) = 1 AS uniform FROM files GROUP BY 1")
def shape_agreement(spark, sf):
    return G.shape_agreement(_files(spark, sf))


@workload(
    "tiff_resolution",
    """SELECT l_orderkey, l_linenumber, l_partkey, ROUND(COALESCE(CASE l_linenumber % 4 WHEN 2 THEN 25400 WHEN 3 THEN 10000 END / NULLIF(CAST(l_partkey AS DOUBLE) / NULLIF(CAST(l_suppkey AS DOUBLE), 0), 0), -1), 6) AS mpp FROM lineitem""",
)
def tiff_resolution(spark, sf):
    mpp = X.tiff_mpp(F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber") % 4)
    return I.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(F.coalesce(mpp, X.d(-1)), 6).alias("mpp"))


EXT = "CASE p_size % 5 WHEN 0 THEN '.ome.tiff' WHEN 1 THEN '.ome.tif' WHEN 2 THEN '.tiff' WHEN 3 THEN '.tif' ELSE '.png' END"


def _ext():
    s = F.col("p_size") % 5
    return F.when(s == 0, ".ome.tiff").when(s == 1, ".ome.tif").when(s == 2, ".tiff").when(s == 3, ".tif").otherwise(".png")


@workload("output_stem", f"SELECT p_partkey, p_name || CASE WHEN p_size % 5 = 4 THEN '.png' ELSE '' END AS stem FROM part")
def output_stem(spark, sf):
    return I.table(spark, sf, "part").select("p_partkey", N.output_stem(F.concat(F.col("p_name"), _ext())).alias("stem"))


@workload("path_hash", f"SELECT p_partkey, substr(sha1('/data/' || p_name || {EXT}), 1, 12) AS slide_hash FROM part")
def path_hash(spark, sf):
    return I.table(spark, sf, "part").select("p_partkey", N.path_hash(F.concat(F.lit("/data/"), "p_name", _ext())).alias("slide_hash"))


@workload("slugify", "SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM documents")
def slugify(spark, sf):
    return I.table(spark, sf, "documents").select("doc_id", N.slugify(F.col("text")).alias("slug"))


@workload(
    "variant_name",
    "SELECT p_partkey, CASE WHEN p_size % 6 = 0 THEN 'markers_all' ELSE 'markers_' || trim(regexp_replace(lower(p_name || '.' || p_brand), '[^a-z0-9]+', '_', 'g'), '_') END AS variant FROM part",
)
def variant_name(spark, sf):
    name = F.when(F.col("p_size") % 6 != 0, F.concat("p_name", F.lit("."), "p_brand"))
    return I.table(spark, sf, "part").select("p_partkey", N.variant_name(name).alias("variant"))


@workload(
    "ome_pixel_type",
    """SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'uint8' WHEN 1 THEN 'float' WHEN 2 THEN 'double' WHEN 3 THEN 'int32' ELSE 'uint16' END AS ome_type,
            CASE p_size % 5 WHEN 0 THEN 8 WHEN 1 THEN 32 WHEN 2 THEN 64 WHEN 3 THEN 32 ELSE 16 END AS bits FROM part""",
)
def ome_pixel_type(spark, sf):
    s = F.col("p_size") % 5
    dtype = F.when(s == 0, "uint8").when(s == 1, "<f4").when(s == 2, "float64").when(s == 3, "int32").otherwise("complex64")
    return I.table(spark, sf, "part").select("p_partkey", X.ome_pixel_type(dtype).alias("t")).select("p_partkey", "t.ome_type", "t.bits")


@workload(
    "channel_name_pick",
    """SELECT p_partkey AS image, CAST(k AS INT) AS idx, CAST(FLOOR(k / 2) AS INT) AS cycle,
            CASE WHEN p_size % 3 = 0 THEN p_name || k WHEN p_size % 3 = 1 THEN p_brand || k ELSE '' END AS raw FROM part, range(4) t(k)""",
)
def channel_name_pick(spark, sf):
    """Four slots a slide; the OME list fits a third, the labels another third."""
    p = I.table(spark, sf, "part")

    def named(col, n):
        return F.array(*[F.concat(col, F.lit(str(k))) for k in range(n)])

    s = F.col("p_size") % 3
    images = p.select(
        F.col("p_partkey").alias("image"), F.lit(4).alias("n_slots"), F.lit(2).alias("n_per_cycle"),
        F.when(s == 0, named(F.col("p_name"), 4)).otherwise(named(F.col("p_name"), 3)).alias("ome_names"),
        F.when(s == 1, named(F.col("p_brand"), 4)).alias("labels"),
    )
    return G.pick_channel_names(images).fillna("", ["raw"])


@workload(
    "artifact_match",
    """WITH a AS (SELECT c_name AS stem, c_name || '.tif' AS file FROM customer WHERE c_nationkey % 2 = 0 UNION ALL SELECT c_name, c_name || '.tiff' FROM customer WHERE c_nationkey % 3 = 0)
       SELECT c_custkey AS slide_id, c_name AS stem, CASE WHEN n IS NULL THEN 'skip' WHEN n > 1 THEN 'ambiguous' ELSE 'found' END AS state, CASE WHEN n = 1 THEN f ELSE '' END AS file
       FROM customer LEFT JOIN (SELECT stem, COUNT(*) AS n, MIN(file) AS f FROM a GROUP BY 1) b ON b.stem = c_name""",
)
def artifact_match(spark, sf):
    c = I.table(spark, sf, "customer")
    one = c.filter("c_nationkey % 2 = 0").select(F.col("c_name").alias("stem"), F.concat("c_name", F.lit(".tif")).alias("file"))
    two = c.filter("c_nationkey % 3 = 0").select(F.col("c_name").alias("stem"), F.concat("c_name", F.lit(".tiff")).alias("file"))
    slides = c.select(F.col("c_custkey").alias("slide_id"), F.col("c_name").alias("stem"))
    return G.match_artifacts(slides, one.union(two)).fillna("", ["file"])
