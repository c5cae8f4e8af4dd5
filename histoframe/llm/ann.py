"""Approximate nearest neighbours by a permutation index.

Every vector is represented by the order of its nearest pivots. The index is
cut into blocks of a bounded number of vectors; each holds an inverted file
that gives, for a pivot, the place it has in every vector's order. A query
adds up the places of its own pivots in the files of a block, which ranks the
block by the footrule distance of the orders, and the best share of the block
is ranked again by cosine on the original vectors. The best of all blocks
are the answer.

Queries are a stated set and meet every block of the index. They travel as
rows of one vector to the bundles of blocks, each once, behind the bundle's
own vectors: a task holds the blocks of a bundle and one batch of rows. The
pivots are the only thing collected, and their number is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoframe.session import materialize

#: Pivots of the index, and how many of the nearest stand in a vector's order.
PIVOTS, PLACES = 256, 128
#: Share of the index that a query ranks by cosine, and the least number of vectors it is raised to.
SHARE, LEAST = 0.05, 1000
#: Vectors in a block of the index, and queries that meet it at once.
BLOCK, QUERY_BLOCK = 4096, 512
#: Bundles that blocks are dealt to at least, where there are as many, and the most blocks of a bundle, which a task holds.
BUNDLES, MOST_BLOCKS = 64, 16


def usable(vector: Column) -> Column:
    """Vectors that have a direction: no null, no non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cosines(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, in double precision."""
    return (queries @ vectors.T) / (np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(vectors, axis=1))


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, places: int) -> np.ndarray:
    """Each vector's nearest pivots in order; ties go to the first pivot."""
    return np.argsort(-(_unit(vectors) @ pivots.T), axis=1, kind="stable")[:, :places]


def inverted_file(orders: np.ndarray, pivots: int) -> np.ndarray:
    """For each pivot (row) the place it has in each vector's order, or the number of places where it has none."""
    n, places = orders.shape
    files = np.full((pivots, n), places, np.uint8 if places < 256 else np.uint16)
    np.put_along_axis(files.T, orders, np.arange(places, dtype=files.dtype)[None], axis=1)
    return files


def footrule_ranks(order: np.ndarray, files: np.ndarray) -> np.ndarray:
    """Agreement of one order with every vector of a block; most where the footrule distance is least.

    A pivot at places i and j of two orders adds ``places - max(i, j)``: half
    of what sharing it takes off the distance of two orders without a common
    pivot.
    """
    own = np.arange(len(order), dtype=files.dtype)[:, None]
    return -np.maximum(files[order], own).sum(axis=0, dtype=np.int64)


def nearest(
    embeddings: DataFrame, queries: Column, k: int = 5, *, id_col: str = "vec_id", vector_col: str = "embedding",
    pivots: int = PIVOTS, places: int = PLACES, share: float = SHARE, least: int = LEAST,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row where ``queries`` holds.

    Candidates are all rows but the query's own; ties go to the smaller id; a
    table of up to ``k`` candidates gives them all. Vectors that are null,
    zero, or hold null or non-finite components take no part, nor do rows with
    a null id or a length other than the most common one. Of rows that repeat
    an id the smallest vector counts. Empty tables give an empty result.
    """
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), queries.alias("asks"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    rows = materialize(rows.groupBy("vec_id").agg(F.min("vector").alias("vector"), F.max(F.coalesce("asks", F.lit(False))).alias("asks")), "vectors")
    lengths = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    shape = lengths.orderBy(F.desc("n"), "width").first()
    width, total = (shape["width"], shape["n"]) if shape else (1, 0)
    rows = rows.filter(F.size("vector") == width)

    drawn = rows.groupBy(F.xxhash64("vector").alias("h")).agg(F.first("vector").alias("vector")).orderBy("h").limit(pivots).select("vector").toArrow()
    points = _unit(_matrix(drawn.column("vector").combine_chunks(), width)) if drawn.num_rows else np.zeros((1, width))
    kept = min(1.0, max(share, least / max(1, total)))
    held_places, query_block = min(places, len(points)), QUERY_BLOCK

    blocks = max(1, -(-total // BLOCK))
    # A query travels once to a bundle of blocks; with few blocks each is a bundle, so that tasks are many.
    bundled = min(MOST_BLOCKS, max(1, blocks // BUNDLES))

    def best_of(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
        return np.lexsort((ids, -scores))[:k]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, held, index = None, [], []

        def indexed(held: list) -> None:
            if held:
                ids, vectors = (np.concatenate(c) for c in zip(*held, strict=True))
                index.append((ids, vectors, inverted_file(nearest_pivots(vectors, points, held_places), len(points))))
                held.clear()

        def answers(asked: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
            found = []
            for query, vector, order in zip(asked, vectors, nearest_pivots(vectors, points, held_places), strict=True):
                near = [in_block(query, vector, order, *block) for block in index]
                ids, scores = (np.concatenate(c) for c in zip(*near, strict=True))
                best = best_of(ids, scores)
                found.append((np.full(len(best), query), ids[best], scores[best]))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=["query_id", "vec_id", "score"])

        def in_block(query: int, vector: np.ndarray, order: np.ndarray, ids: np.ndarray, vectors: np.ndarray, files: np.ndarray) -> tuple:
            take = min(len(ids), int(np.ceil(kept * len(ids))) + k)
            ranks = footrule_ranks(order, files)
            near = np.flatnonzero(ranks >= np.partition(ranks, len(ranks) - take)[len(ranks) - take])
            near = near[ids[near] != query]
            score = cosines(vector[None], vectors[near])[0]
            best = best_of(ids[near], score)
            return ids[near][best], score[best]

        for batch in batches:
            if not batch.num_rows:
                continue
            bundles, block, ids = (batch.column(c).to_numpy() for c in ("bundle", "block", "vec_id"))
            vectors = _matrix(batch.column("vector"), width)
            edges = np.flatnonzero((np.diff(bundles) != 0) | (np.diff(block) != 0)) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)], strict=True):
                if (bundles[s], block[s]) != bundle:
                    indexed(held)
                    if bundle is None or bundles[s] != bundle[0]:
                        index.clear()
                    bundle = bundles[s], block[s]
                if block[s] < blocks:
                    held.append((ids[s:e], vectors[s:e]))
                else:
                    for at in range(s, e if index else s, query_block):
                        yield answers(ids[at : min(at + query_block, e)], vectors[at : min(at + query_block, e)])

    # Rows of one vector: a block's own come before the queries, so a task holds a bundle's blocks and one batch, however many queries there are.
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    own = dealt.select(F.floor(F.col("block") / bundled).cast("int").alias("bundle"), "block", "vec_id", "vector")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) // bundled)))
    asks = rows.filter("asks").select(everywhere.alias("bundle"), F.lit(blocks).alias("block"), "vec_id", "vector")
    met = own.unionByName(asks).repartition("bundle").sortWithinPartitions("bundle", "block", "vec_id").mapInArrow(search, "query_id long, vec_id long, score double")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
