"""Nearest neighbours, neighbour graphs and communities."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histoframe.functions import numeric as X
from histoframe.session import counted, cut_lineage, drop_table, materialize

# Neighbours per row and resolution of the clustering.
N_NEIGHBOURS = 15
RESOLUTION = 0.5

#: Rows of a block, the most blocks, and the most bytes of pivots that every task gets.
BLOCK, MAX_BLOCKS, PIVOT_BYTES = 4096, 100_000, 64 << 20

#: Bytes of vectors on either side of a meeting of the second pass.
TILE_BYTES = 8 << 20

#: Distance from the mean of a pool up to which single precision holds the square, with room.
FAR = 1e15

#: Gain a move needs, as a share of the node's weight (of 1 at least); steps in which gains are told apart.
LEAST_GAIN, STEPS_PER_DOUBLING = 1e-9, 4

#: Share of moving nodes below which the first pass goes on to the next level.
QUIET = 0.1


def _matrix(column):  # noqa: ANN001, ANN202 - Arrow list array to numpy rows
    import numpy as np

    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(len(column), -1)


def _euclid(a, b):  # noqa: ANN001, ANN202 - numpy rows
    """Distances of all rows of both sides, and how far off rounding may have put each."""
    import numpy as np

    left, right = (a * a).sum(1), (b * b).sum(1)
    sq = left[:, None] + right[None, :] - 2.0 * a @ b.T
    slack = 1e-7 * (np.sqrt(left)[:, None] + np.sqrt(right).max(initial=0.0)) + 1e-300
    return np.sqrt(np.maximum(sq, 0.0)), slack


def _nearest(ids, vectors, pool_ids, pool, k: int, bound=None):  # noqa: ANN001, ANN202 - numpy rows
    """(row, neighbour, distance) of each row's ``k`` nearest others in a pool, ties to the smaller id.

    Others have another id; none of them is farther than the row's ``bound``,
    where there is one. A matrix product picks the candidates with room for
    its rounding; their distances are worked out term by term.
    """
    import numpy as np

    found = [], [], []
    for at in range(0, len(ids), 64):
        part = vectors[at : at + 64]
        rough, slack = _euclid(part, pool)
        rough[pool_ids[None, :] == ids[at : at + 64, None]] = np.inf
        limit = np.full((len(part), 1), np.inf)
        if pool.shape[0] > k:
            limit = np.partition(rough, k - 1, axis=1)[:, k - 1 : k] + 2 * slack
        if bound is not None:
            limit = np.minimum(limit, bound[at : at + 64, None] + 2 * slack)
        row, col = np.nonzero((rough <= limit) & np.isfinite(rough))
        exact = np.sqrt(((part[row] - pool[col]) ** 2).sum(1))
        order = np.lexsort((pool_ids[col], exact, row))
        row, col, exact = row[order], col[order], exact[order]
        first = np.searchsorted(row, row)
        taken = np.arange(len(row)) - first < k
        found[0].append(row[taken] + at)
        found[1].append(pool_ids[col[taken]])
        found[2].append(exact[taken])
    return tuple(np.concatenate(x) if x else np.empty(0) for x in found)


class Pool:
    """Rows that others look for their nearest in, in single precision around their mean.

    A product of matrices of half the size says which rows can be within a
    bound, with room for its rounding; distances of the few that can are worked
    out term by term, as in ``_nearest``.
    """

    def __init__(self, ids, vectors) -> None:  # noqa: ANN001 - numpy rows
        import numpy as np

        self.ids, self.vectors = ids, vectors
        self.centre = vectors.mean(0)
        near = vectors - self.centre
        half = (near * near).sum(1) / 2
        self.far = float(np.sqrt(2 * half.max(initial=0.0)))
        self.plain = not self.far < FAR
        self.around = None if self.plain else np.concatenate([-near, half[:, None]], 1).astype("float32")
        # What centring in double precision may have moved a component by.
        self.moved = 0.0 if self.plain else 4e-16 * float(np.abs(vectors).max(initial=0.0) + np.abs(self.centre).max(initial=0.0))
        self.by_id = np.argsort(ids, kind="stable")
        self.sorted_ids = ids[self.by_id]

    def nearest(self, ids, vectors, k: int, bound, taken=None, out=slice(0, 0)):  # noqa: ANN001, ANN201 - numpy rows
        """As ``_nearest`` among the rows ``taken`` (or all), but those of the slice ``out``."""
        import numpy as np

        near = vectors - self.centre
        left, width = (near * near).sum(1), vectors.shape[1]
        size = np.sqrt(left)
        if self.plain or not (size < FAR).all() or not np.isfinite(bound).all():
            kept = np.setdiff1d(np.arange(len(self.ids)) if taken is None else taken, np.arange(out.start, out.stop))
            return _nearest(ids, vectors, self.ids[kept], self.vectors[kept], k, bound)
        room = ((width + 8) * 1.2e-7 * (size + self.far) + 2 * width**0.5 * self.moved) * (size + self.far) + 1e-30
        asked = np.concatenate([near, np.ones((len(near), 1))], 1).astype("float32")
        rough = asked @ (self.around if taken is None else self.around[taken]).T
        rough[:, out if taken is None else (taken >= out.start) & (taken < out.stop)] = np.inf
        first, last = (np.searchsorted(self.sorted_ids, ids, side) for side in ("left", "right"))
        for row in np.flatnonzero(last > first):
            same = self.by_id[first[row] : last[row]]
            rough[row, same if taken is None else np.isin(taken, same)] = np.inf
        limit = ((bound * bound - left) / 2 + room).astype("float32")
        limit = np.nextafter(limit, np.float32(np.inf))
        some = max(8 * k, rough.shape[1] // 64)
        if rough.shape[1] >= some:
            # The k-th least of the minima of so many sets of columns is no less than the k-th least of all.
            least = rough[:, : rough.shape[1] // some * some].reshape(len(rough), -1, some).min(axis=1)
            kth = np.partition(least, k - 1, axis=1)[:, k - 1]
            limit = np.minimum(limit, np.nextafter((kth + 2 * room).astype("float32"), np.float32(np.inf)))
        row, col = np.divmod(np.flatnonzero(rough <= np.minimum(limit, np.finfo("float32").max)[:, None]), rough.shape[1])
        col = col if taken is None else taken[col]
        exact = np.empty(len(row))
        for at in range(0, len(row), 1 << 16):
            some = slice(at, at + (1 << 16))
            exact[some] = np.sqrt(((vectors[row[some]] - self.vectors[col[some]]) ** 2).sum(1))
        order = np.lexsort((self.ids[col], exact, row))
        row, col, exact = row[order], col[order], exact[order]
        best = np.arange(len(row)) - np.searchsorted(row, row) < k
        return row[best], self.ids[col[best]], exact[best]


def _within(to_pivot, slack, bound, low, high):  # noqa: ANN001, ANN202 - numpy rows
    """Which blocks can hold a row within each row's bound, by the distances from their pivots."""
    import numpy as np

    nearest = np.maximum(np.maximum(to_pivot - high, low - to_pivot), 0.0)
    return nearest <= bound[:, None] + 2 * slack


class KnnPlan:
    """The two passes of an exact kNN join, each a table in the shared folder.

    Rows belong to the nearest of about ``sqrt(rows)`` pivots, and a pivot's
    rows are cut into blocks. A block knows its pivot and the range of its
    rows' distances from it. In the first pass a row meets its own block only,
    which gives an upper bound on its k-th distance; ``sent`` names the other
    blocks that can still hold a nearer one by the triangle inequality, and in
    the second pass the row meets just those. Blocks near each other travel as
    one bundle of ``TILE_BYTES`` of vectors: a row goes to a bundle once,
    however many of its blocks it meets, so where nearly all rows meet nearly
    all blocks, rows are copied once per bundle and not once per block.

    Pivots and the blocks' ranges are the only data sent to all tasks:
    ``PIVOT_BYTES`` bounds the first by their number, and blocks grow with the
    table where they would be more than ``MAX_BLOCKS``.
    """

    def __init__(self, df: DataFrame, k: int, id_col: str, features: str, pivots: int | None, block: int) -> None:
        self.k, self.spark = k, df.sparkSession
        rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(features).cast("array<double>").alias("f"))
        self.rows = rows.filter(F.col("f").isNotNull())
        sizes = self.rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("f")).alias("width")).first()
        self.n = sizes["n"]
        if not self.n:
            return
        most = max(1, PIVOT_BYTES // (8 * max(1, sizes["width"])))
        self.n_pivots = min(most, pivots or math.isqrt(self.n - 1) + 1)
        self.block = max(block, self.n // MAX_BLOCKS)
        self.tile = max(1, TILE_BYTES // (8 * max(1, sizes["width"])))
        self.pivots = self._pivots()
        self.placed = self._placed()
        self.blocks = self.placed.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("low"), F.max("d").alias("high"))
        self.balls = self._balls()
        self.own = self._own()
        self.sent = self._sent()

    def _pivots(self):  # noqa: ANN202
        """Broadcast pivot rows: those with the least hashes."""
        order = F.md5(F.col("id").cast("string"))
        chosen = self.rows.select(order.alias("h"), "id", "f").orderBy("h", "id").limit(self.n_pivots).select("f").toArrow()["f"]
        return self.spark.sparkContext.broadcast(_matrix(chosen.combine_chunks()))

    def _placed(self) -> DataFrame:
        """(id, f, block, d): block and distance from its pivot."""
        pivots = self.pivots

        def place(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                vectors = _matrix(batch.column(1))
                cell = _euclid(vectors, pivots.value)[0].argmin(1)
                d = np.sqrt(((vectors - pivots.value[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(d)], names=["id", "f", "cell", "d"])

        celled = materialize(self.rows.mapInArrow(place, "id bigint, f array<double>, cell bigint, d double"), "cells")
        sizes = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n_cell"))
        cuts = F.ceil(F.col("n_cell") / self.block)
        part = F.pmod(F.xxhash64("id"), cuts)
        placed = materialize(celled.join(sizes, "cell").select("id", "f", (F.shiftleft("cell", 24) + part).alias("block"), "d"), "blocks")
        drop_table(celled)
        return placed

    def _balls(self):  # noqa: ANN202
        """Broadcast (block, n, low, high, bundle) of the blocks, ordered by block; near pivots share a bundle."""
        import numpy as np

        known = self.blocks.orderBy("block").toPandas()
        ball = {c: known[c].to_numpy() for c in known}
        pivots = self.pivots.value
        cells, cell = np.unique(ball["block"] >> 24, return_inverse=True)
        around = _euclid(pivots[cells], pivots[: min(256, -(-self.n // self.tile))])[0].argmin(1)
        order = np.lexsort((ball["block"], around[cell]))
        ball["bundle"] = np.empty(len(order), dtype="int32")
        ball["bundle"][order] = np.unique((np.cumsum(ball["n"][order]) - 1) // self.tile, return_inverse=True)[1]
        return self.spark.sparkContext.broadcast(ball)

    def _own(self) -> DataFrame:
        """(id, f, block, neighbours, distances): first pass, nearest first."""
        k = self.k

        def inside(group):  # noqa: ANN001, ANN202 - Arrow table
            import numpy as np
            import pyarrow as pa

            group = group.combine_chunks()
            ids, vectors = group["id"].to_numpy(), _matrix(group["f"].combine_chunks())
            row, neighbour, distance = _nearest(ids, vectors, ids, vectors, k)
            bounds = pa.array(np.searchsorted(row, np.arange(len(ids) + 1)).astype("int32"))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (neighbour.astype("int64"), distance.astype("float64"))]
            return pa.table([group["id"], group["f"], group["block"], *lists], names=["id", "f", "block", "neighbours", "distances"])

        schema = "id bigint, f array<double>, block bigint, neighbours array<bigint>, distances array<double>"
        return materialize(self.placed.select("id", "f", "block").groupBy("block").applyInArrow(inside, schema), "first-pass")

    def _sent(self) -> DataFrame:
        """(id, f, block, bound, bundles, met): the bundles in which a row has to meet further blocks, and their number."""
        k, pivots, balls = self.k, self.pivots, self.balls

        def reach(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            ball = balls.value
            cell = ball["block"] >> 24
            by_bundle = np.argsort(ball["bundle"], kind="stable")
            starts = np.flatnonzero(np.append(True, np.diff(ball["bundle"][by_bundle]) > 0))
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    part = batch.slice(at, 512)
                    vectors, block = _matrix(part.column(1)), part.column(2).to_numpy()
                    rough, slack = _euclid(vectors, pivots.value)
                    to_pivot = rough[:, cell]
                    best = np.array([d[k - 1] if len(d) >= k else np.inf for d in part.column(3).to_pylist()])
                    few = np.flatnonzero(~np.isfinite(best))
                    if len(few):
                        # Too few rows in the own block: those of the nearest blocks that make up k are within their farthest.
                        farthest = to_pivot[few] + ball["high"]
                        order = np.argsort(farthest, axis=1)
                        enough = np.cumsum(ball["n"][order], axis=1) >= k + 1
                        at_last = np.where(enough.any(1), enough.argmax(1), 0)
                        bound = np.take_along_axis(farthest, order[np.arange(len(few)), at_last][:, None], 1)[:, 0] + 2 * slack[few, 0]
                        best[few] = np.where(enough.any(1), bound, np.inf)
                    meets = _within(to_pivot, slack, best, ball["low"], ball["high"]) & (ball["block"][None, :] != block[:, None])
                    row, target = np.nonzero(np.logical_or.reduceat(meets[:, by_bundle], starts, axis=1))
                    ends = pa.array(np.searchsorted(row, np.arange(len(block) + 1)).astype("int32"))
                    bundles = pa.ListArray.from_arrays(ends, pa.array(ball["bundle"][by_bundle][starts][target].astype("int32")))
                    arrays = [*part.select([0, 1, 2]).columns, pa.array(best), bundles, pa.array(meets.sum(1).astype("int64"))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["id", "f", "block", "bound", "bundles", "met"])

        schema = "id bigint, f array<double>, block bigint, bound double, bundles array<int>, met bigint"
        return materialize(self.own.select("id", "f", "block", "distances").mapInArrow(reach, schema), "sent")

    def _others(self) -> DataFrame:
        """(id, neighbour, distance): second pass. Guests of a bundle come in parts, each with a copy of the bundle."""
        k, pivots, balls = self.k, self.pivots, self.balls
        guests = self.sent.select(F.explode("bundles").alias("bundle")).groupBy("bundle").agg(F.ceil(F.count(F.lit(1)) / self.tile).cast("int").alias("parts"))
        parts = [0] * (int(balls.value["bundle"].max()) + 1)
        for r in guests.collect():
            parts[r.bundle] = r.parts
        n_parts = F.get(F.lit(parts), F.col("bundle"))

        def bundled(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                at = np.searchsorted(balls.value["block"], batch.column(2).to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(balls.value["bundle"][at])], names=["id", "f", "block", "bundle"])

        queries = self.sent.select("id", "f", "block", "bound", F.explode("bundles").alias("bundle")).withColumn("part", F.pmod(F.xxhash64("id"), n_parts).cast("int"))
        hosts = self.placed.select("id", "f", "block").mapInArrow(bundled, "id bigint, f array<double>, block bigint, bundle int")
        hosts = hosts.filter(n_parts > 0).select("*", F.explode(F.sequence(F.lit(0), n_parts - 1)).alias("part"))

        def meet(queries, hosts):  # noqa: ANN001, ANN202 - Arrow tables
            import numpy as np
            import pyarrow as pa

            queries, hosts, ball = queries.sort_by("block").combine_chunks(), hosts.sort_by("block").combine_chunks(), balls.value
            found = [np.empty(0, "int64")], [np.empty(0, "int64")], [np.empty(0)]
            if queries.num_rows and hosts.num_rows:
                ids, vectors, own, bound = queries["id"].to_numpy(), _matrix(queries["f"].combine_chunks()), queries["block"].to_numpy(), queries["bound"].to_numpy()
                pool_ids, pool, block = hosts["id"].to_numpy(), _matrix(hosts["f"].combine_chunks()), hosts["block"].to_numpy()
                here, place = np.unique(block, return_inverse=True)
                at = np.searchsorted(ball["block"], here)
                low, high, centres = ball["low"][at], ball["high"][at], pivots.value[here >> 24]
                hosted = Pool(pool_ids, pool)
                sides = np.searchsorted(block, here), np.searchsorted(block, here, "right")
                # Rows of one block, so that the blocks they meet are much the same and their own is left out for all.
                ends = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]])
                for start in np.concatenate([np.arange(a, b, 256) for a, b in zip(ends[:-1], ends[1:])]):
                    rows = slice(start, min(start + 256, ends[np.searchsorted(ends, start, "right")]))
                    to_pivot, slack = _euclid(vectors[rows], centres)
                    met = _within(to_pivot, slack, bound[rows], low, high).any(0) & (here != own[start])
                    taken = np.flatnonzero(met[place])
                    if len(taken):
                        # Where most are met the rest are compared as well, which saves a copy of them.
                        mine = np.flatnonzero(here == own[start])
                        out = slice(int(sides[0][mine[0]]), int(sides[1][mine[0]])) if len(mine) else slice(0, 0)
                        row, neighbour, distance = hosted.nearest(ids[rows], vectors[rows], k, bound[rows], None if 2 * len(taken) > len(pool) else taken, out)
                        found[0].append(ids[rows][row])
                        found[1].append(neighbour.astype("int64"))
                        found[2].append(distance)
            return pa.table([pa.array(np.concatenate(x)) for x in found], names=["id", "neighbour", "distance"])

        key = ["bundle", "part"]
        return queries.groupBy(*key).cogroup(hosts.groupBy(*key)).applyInArrow(meet, "id bigint, neighbour bigint, distance double")

    def neighbours(self) -> DataFrame:
        """(id, neighbour, distance, rank) of all rows."""
        own = self.own.select("id", F.explode(F.arrays_zip("neighbours", "distances")).alias("e")).select("id", "e.neighbours", "e.distances").toDF("id", "neighbour", "distance")
        best = Window.partitionBy("id").orderBy("distance", "neighbour")
        return own.unionByName(self._others()).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= self.k)

    def traffic(self) -> DataFrame:
        """(rows, pivots, blocks, sent, share): (row, block) meetings of the second pass, of all that are possible."""
        blocks = self.blocks.agg(F.count(F.lit(1)).alias("blocks"))
        both = blocks.join(self.sent.agg(F.sum("met").alias("sent")))
        every = F.col("rows") * F.col("blocks")
        return both.select(F.lit(self.n).alias("rows"), F.lit(self.n_pivots).alias("pivots"), "blocks", "sent").withColumn("share", F.col("sent") / every)


def knn(df: DataFrame, k: int = N_NEIGHBOURS, id_col: str = "cell_id", features: str = "features", pivots: int | None = None, block: int = BLOCK) -> DataFrame:
    """Exact ``k`` nearest other rows of every row, Euclidean, ties to the smaller id.

    Two passes over blocks of rows (``KnnPlan``). Rows without features take
    no part, as queries nor as neighbours; ids are expected to be distinct. A
    hot place is many blocks and many parts of guests, so no task holds more
    than about two blocks or two tiles, and a task returns at most k rows per
    query row.
    """
    plan = KnnPlan(df, k, id_col, features, pivots, block)
    if not plan.n:
        return df.sparkSession.createDataFrame([], f"{id_col} bigint, neighbour bigint, distance double, rank int")
    return plan.neighbours().withColumnRenamed("id", id_col)


def symmetric_edges(neighbours: DataFrame, id_col: str = "cell_id") -> DataFrame:
    """Undirected neighbour graph, both directions listed once."""
    there = neighbours.select(F.col(id_col).alias("src"), F.col("neighbour").alias("dst"))
    return there.unionByName(there.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = RESOLUTION) -> DataFrame:
    """Quality of a labelling. Edges list both directions, weight ``w`` or 1."""
    w = edges if "w" in edges.columns else edges.withColumn("w", X.d(1))
    lab = labels.select("node", "label")
    both = w.join(lab.withColumnRenamed("node", "src").withColumnRenamed("label", "_a"), "src").join(
        lab.withColumnRenamed("node", "dst").withColumnRenamed("label", "_b"), "dst"
    )
    per = both.groupBy(F.col("_a").alias("label")).agg(
        F.sum("w").alias("tot"), F.sum(F.when(F.col("_a") == F.col("_b"), F.col("w")).otherwise(X.d(0))).alias("inside")
    )
    sums = per.agg(F.sum("tot").alias("m2"), F.sum("inside").alias("i"), F.sum(F.col("tot") * F.col("tot")).alias("t2"))
    return sums.select((F.col("i") / F.col("m2") - X.d(resolution) * F.col("t2") / (F.col("m2") * F.col("m2"))).alias("modularity"))


def _wishes(edges: DataFrame, state: DataFrame, m2: float, resolution: float) -> DataFrame:
    """(node, old, new, k, delta) of the nodes that another label would serve better."""
    totals = state.groupBy("label").agg(F.sum("k").alias("tot"))
    links = edges.filter("src <> dst").join(state.select(F.col("node").alias("dst"), "label"), "dst").select(F.col("src").alias("node"), "label", F.col("w").alias("links"))
    own = state.select("node", "label", X.d(0).alias("links"))
    # One sum over both, so that links are shuffled by node and label once.
    options = links.unionByName(own).groupBy("node", "label").agg(F.sum("links").alias("links"))
    mine = state.select("node", F.col("label").alias("old"), "k")
    stays = F.col("label") == F.col("old")
    rest = F.col("tot") - F.when(stays, F.col("k")).otherwise(X.d(0))
    gain = F.col("links") - X.d(resolution) * F.col("k") * rest / X.d(m2)
    scored = options.join(totals, "label").join(mine, "node").withColumn("gain", gain)
    best = scored.groupBy("node", "old", "k").agg(
        F.max(F.when(~stays, F.struct("gain", (-F.col("label")).alias("neg")))).alias("b"), F.max(F.when(stays, F.col("gain"))).alias("stay")
    )
    wishes = best.select("node", "old", (-F.col("b.neg")).alias("new"), "k", (F.col("b.gain") - F.col("stay")).alias("delta"))
    return wishes.filter(F.col("delta") > X.d(LEAST_GAIN) * F.greatest(F.col("k"), X.d(1)))


def _granted(wishes: DataFrame, m2: float, resolution: float) -> DataFrame:
    """(node, new) of the wishes that raise modularity when they all come true at once.

    A label takes or gives, as its greatest wish (gain, hash, id) does, so two
    granted moves only ever share a label they both enter or both leave. That
    costs at most ``resolution * k * k' / m2`` for each such two, so a wish is
    granted where its gain exceeds this sum over the wishes that come before
    it: all in its own step of gains and the greater steps. The greatest of
    both its labels needs no comparison; so the greatest of all always goes.
    """
    key = F.struct("delta", F.xxhash64("node").alias("h"), (-F.col("node")).alias("neg"))
    ends = F.explode(F.array(F.struct(F.col("old").alias("label"), F.lit(False).alias("takes")), F.struct(F.col("new").alias("label"), F.lit(True).alias("takes"))))
    by_label = wishes.select(ends.alias("e"), key.alias("key")).groupBy("e.label").agg(F.max(F.struct("key", "e.takes")).alias("top"))
    by_label = by_label.select("label", (-F.col("top.key.neg")).alias("first"), F.col("top.takes").alias("takes"))

    def seen(end: str) -> DataFrame:
        return by_label.select(F.col("label").alias(end), F.col("first").alias(f"{end}_first"), F.col("takes").alias(f"{end}_takes"))

    agreed = wishes.join(seen("new"), "new").join(seen("old"), "old").filter("new_takes AND NOT old_takes")
    agreed = agreed.withColumn("step", F.floor(F.log2("delta") * STEPS_PER_DOUBLING).cast("int"))
    each = agreed.select(F.explode(F.array("old", "new")).alias("label"), "step", "k").groupBy("label", "step").agg(F.sum("k").alias("k_step"))
    greater = Window.partitionBy("label").orderBy(F.desc("step"))
    ahead = each.withColumn("ahead", F.sum("k_step").over(greater.rowsBetween(Window.unboundedPreceding, 0)))

    def before(end: str) -> DataFrame:
        return ahead.select(F.col("label").alias(end), "step", F.col("ahead").alias(f"{end}_ahead"))

    weighed = agreed.join(before("new"), ["new", "step"]).join(before("old"), ["old", "step"])
    shared = F.col("new_ahead") + F.col("old_ahead") - F.col("k") * 2
    sure = (F.col("new_first") == F.col("node")) & (F.col("old_first") == F.col("node"))
    worth = F.col("delta") - X.d(resolution) * F.col("k") * shared / X.d(m2) > X.d(LEAST_GAIN) * F.greatest(F.col("k"), X.d(1))
    return weighed.filter(sure | worth).select("node", "new")


def _settle(graph: DataFrame, labels: DataFrame, m2: float, resolution: float, quiet: float) -> tuple[DataFrame, int, bool]:
    """Moves in rounds until nobody wishes to move, or until fewer than the ``quiet`` share of nodes do.

    Gives (node, label), the number of moves and whether no wish is left. Each
    round writes its wishes and its labels; those of the round before last
    are deleted.
    """
    degree = graph.groupBy(F.col("src").alias("node")).agg(F.sum("w").alias("k"))
    state, nodes = counted(labels.join(degree, "node").select("node", "label", "k"), "labels")
    moves, old = 0, []
    while True:
        wishes, n_wishes = counted(_wishes(graph, state, m2, resolution), "wishes")
        old.append(wishes)
        if not n_wishes:
            break
        moved = F.coalesce(F.col("new"), F.col("label"))
        turned = state.join(_granted(wishes, m2, resolution), "node", "left").select("node", moved.alias("label"), "k", F.col("new").isNotNull().alias("_moved"))
        turned, n_moved = counted(turned, "labels", F.col("_moved"))
        old.append(state)
        state, moves = turned.drop("_moved"), moves + n_moved
        while len(old) > 2:
            drop_table(old.pop(0))
        if n_moved < quiet * nodes:
            break
    return state.select("node", "label"), moves, not n_wishes


def _contracted(graph: DataFrame, labels: DataFrame) -> DataFrame:
    """Every label one node, weights summed."""
    ends = labels.select("node", "label")
    return cut_lineage(
        graph.join(ends.select(F.col("node").alias("src"), F.col("label").alias("_a")), "src")
        .join(ends.select(F.col("node").alias("dst"), F.col("label").alias("_b")), "dst")
        .groupBy(F.col("_a").alias("src"), F.col("_b").alias("dst"))
        .agg(F.sum("w").alias("w"))
    )


def communities(edges: DataFrame, resolution: float = RESOLUTION) -> DataFrame:
    """(node, label): modularity communities of an undirected graph.

    Louvain-style: nodes move by gain, then every community becomes one node
    and moves on. Moves of a round are chosen so that together they raise
    modularity, so every round makes progress and the search ends. The first
    pass goes on to the next level once few nodes move; it is followed by
    passes over the nodes themselves until no node gains by another label and
    no community by joining another.
    """
    w = edges if "w" in edges.columns else edges.withColumn("w", X.d(1))
    graph = materialize(w.select(F.col("src").cast("bigint"), F.col("dst").cast("bigint"), F.col("w").cast("double")), "graph")
    m2 = graph.agg(F.sum("w")).first()[0] or 1.0
    labels = graph.select(F.col("src").alias("node"), F.col("src").alias("label")).distinct()
    quiet = QUIET
    while True:
        labels, _, at_rest = _settle(graph, labels, m2, resolution, quiet)
        small, merged = _contracted(graph, labels), False
        while True:
            itself = small.select(F.col("src").alias("node"), F.col("src").alias("label")).distinct()
            joined, moves, _ = _settle(small, itself, m2, resolution, quiet)
            if not moves:
                break
            merged = True
            to = joined.select(F.col("node").alias("label"), F.col("label").alias("_to"))
            labels = cut_lineage(labels.join(to, "label").select("node", F.col("_to").alias("label")))
            small = _contracted(small, joined)
        if at_rest and not merged:
            return labels
        quiet = 0.0


def open_wishes(edges: DataFrame, labels: DataFrame, resolution: float = RESOLUTION) -> DataFrame:
    """How far a labelling is from rest: (nodes, labelled, moves, merges).

    Nodes of the graph, (node, label) rows for them, nodes that would gain by
    another label, and communities that would gain by joining another.
    """
    w = edges if "w" in edges.columns else edges.withColumn("w", X.d(1))
    graph = w.select(F.col("src").cast("bigint"), F.col("dst").cast("bigint"), F.col("w").cast("double"))
    m2 = graph.agg(F.sum("w")).first()[0] or 1.0

    def wishes(graph: DataFrame, labels: DataFrame) -> DataFrame:
        degree = graph.groupBy(F.col("src").alias("node")).agg(F.sum("w").alias("k"))
        return _wishes(graph, labels.join(degree, "node"), m2, resolution)

    small = _contracted(graph, labels)
    itself = small.select(F.col("src").alias("node"), F.col("src").alias("label")).distinct()
    nodes = graph.select(F.col("src").alias("node")).distinct()
    found = {"nodes": nodes, "labelled": labels.join(nodes, "node"), "moves": wishes(graph, labels), "merges": wishes(small, itself)}
    rows = reduce(DataFrame.unionByName, [rows.select(F.lit(name).alias("fact")) for name, rows in found.items()])
    return rows.agg(*[F.count_if(F.col("fact") == name).alias(name) for name in found])
