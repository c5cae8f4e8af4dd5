"""Neighbour-graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from histoframe.operators import graph as G
from histoframe.session import materialize
from histoframe.workloads import inputs as I
from histoframe.workloads import workload

NN = """nn AS (SELECT a.cell_id, b.cell_id AS neighbour, list_distance(a.features, b.features) AS distance,
        row_number() OVER (PARTITION BY a.cell_id ORDER BY list_distance(a.features, b.features), b.cell_id) AS rank
    FROM cell_features a JOIN cell_features b ON a.cell_id <> b.cell_id)"""
EDGES = f"{NN}, edges AS (SELECT cell_id AS src, neighbour AS dst FROM nn WHERE rank <= 15 UNION SELECT neighbour, cell_id FROM nn WHERE rank <= 15)"


def _edges(spark, sf):
    return G.symmetric_edges(G.knn(I.cell_features(spark, sf)))


@workload("knn_topk", f"WITH {NN} SELECT cell_id, neighbour, ROUND(distance, 6) AS distance, CAST(rank AS INT) AS rank FROM nn WHERE rank <= 15")
def knn_topk(spark, sf):
    return G.knn(I.cell_features(spark, sf)).withColumn("distance", F.round("distance", 6))


@workload("knn_graph", f"WITH {EDGES} SELECT * FROM edges")
def knn_graph(spark, sf):
    return _edges(spark, sf)


@workload(
    "modularity",
    f"""WITH {EDGES}, e AS (SELECT a.label AS a, b.label AS b FROM edges JOIN cell_features a ON a.cell_id = src JOIN cell_features b ON b.cell_id = dst),
        p AS (SELECT a, COUNT(*) AS tot, COUNT(*) FILTER (a = b) AS inside FROM e GROUP BY 1)
        SELECT ROUND(SUM(inside) / SUM(tot) - 0.5::DOUBLE * SUM(tot * tot) / (SUM(tot) * SUM(tot)), 6) AS modularity FROM p""",
)
def modularity(spark, sf):
    labels = I.cell_features(spark, sf).select(F.col("cell_id").alias("node"), "label")
    return G.modularity(_edges(spark, sf), labels).withColumn("modularity", F.round("modularity", 6))


@workload("communities")
def communities(spark, sf):
    return G.communities(_edges(spark, sf))


@workload(
    "communities_at_rest",
    f"""WITH {EDGES} SELECT (SELECT COUNT(DISTINCT src) FROM edges) AS nodes, (SELECT COUNT(DISTINCT src) FROM edges) AS labelled,
        0::BIGINT AS moves, 0::BIGINT AS merges""",
)
def communities_at_rest(spark, sf):
    """Every node has one label, and no move of a node or of a whole community raises modularity."""
    edges = materialize(_edges(spark, sf), "edges")
    return G.open_wishes(edges, G.communities(edges))
