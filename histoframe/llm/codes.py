"""Vector codes: each part of a vector is replaced by its nearest codebook entry.

Components are whole numbers, so sums, distances and codebooks are exact and
do not depend on how rows are dealt to tasks. The nearest entry is found by
Orchard's search: every entry has a list of the others by distance from it. A
search walks the list of its best entry so far, jumps to the list of a better
one as soon as it meets it, marks what it has met, and stops where an entry is
farther from the best one than twice the vector's own distance: by the
triangle inequality nothing behind it can be nearer.

A round reads the vectors once; a task returns one row of sums for each entry
it used. Only codebooks (parts x entries rows) are brought to the driver and
sent out again.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoframe.session import materialize

#: Whole steps to one, parts of a vector, entries of a codebook, rounds.
STEPS, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4

#: Largest component, so that squared distances of 64 components stay inside 64 bits.
LARGEST = float((1 << 26) // STEPS)

#: Vectors searched for at once.
_AT_ONCE = 4096


def usable(vector: Column) -> Column:
    """Vectors without null and non-finite components."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


class Orchard:
    """Nearest entry of one codebook, ties to the lower index."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        between = np.empty((len(entries), len(entries)), np.int64)
        for i, entry in enumerate(entries):
            between[i] = ((entries - entry) ** 2).sum(axis=1)
        #: For each entry the others by distance, and four times the squared distances.
        self.near = np.argsort(between, axis=1, kind="stable")
        self.bound = np.take_along_axis(between, self.near, axis=1)
        self.visits = 0

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each vector's nearest entry."""
        n, k = len(vectors), len(self.entries)
        best = np.zeros(n, np.int64)
        least = ((vectors - self.entries[0]) ** 2).sum(axis=1)
        met = np.zeros((n, k), bool)
        met[:, 0] = True
        place = np.zeros(n, np.int64)
        going = np.arange(n)
        while len(going):
            at, here = place[going], best[going]
            # Within twice the distance, that is four times its square; equal ones may win by their index.
            open_ = at < k
            open_[open_] = self.bound[here[open_], at[open_]] <= 4 * least[going[open_]]
            going, at, here = going[open_], at[open_], here[open_]
            candidate = self.near[here, at]
            place[going] = at + 1
            fresh = ~met[going, candidate]
            row, candidate = going[fresh], candidate[fresh]
            met[row, candidate] = True
            self.visits += len(row)
            distance = ((vectors[row] - self.entries[candidate]) ** 2).sum(axis=1)
            better = (distance < least[row]) | ((distance == least[row]) & (candidate < best[row]))
            row, candidate = row[better], candidate[better]
            best[row], least[row], place[row] = candidate, distance[better], 0
        return best, least


def _whole(column: pa.Array, width: int) -> np.ndarray:
    """Components as whole numbers, a row per vector."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * STEPS).astype(np.int64).reshape(-1, width)


def _searched(column: pa.Array, books: list[Orchard], width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, part, vectors' parts, indexes, distances) of a batch, some rows at once."""
    for at in range(0, len(column), _AT_ONCE):
        vectors = _whole(column.slice(at, _AT_ONCE), width)
        for part, own in enumerate(np.split(vectors, len(books), axis=1)):
            yield at, part, own, *books[part].search(own)


def _sums(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, many, s0, s1, ...) in parts to be summed: one row a task and entry in use."""
    parts, _, span = books.shape
    names = ["part", "entry", "many", *[f"s{i}" for i in range(span)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchards = [Orchard(b) for b in books]
        sums, many = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for _, part, own, index, _ in _searched(batch.column(0), orchards, parts * span):
                np.add.at(sums[part], index, own)
                many[part] += np.bincount(index, minlength=books.shape[1])
        part, entry = np.nonzero(many)
        columns = [part.astype(np.int32), entry.astype(np.int32), many[part, entry], *sums[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    return vectors.select("vector").mapInArrow(run, "part int, entry int, " + ", ".join(f"{n} long" for n in names[2:]))


def _first(vectors: DataFrame, many: int) -> DataFrame:
    """The first rows by (vec_id, vector): of each task, of each group of tasks, then of all."""
    order = [F.asc_nulls_last("vec_id"), F.asc("vector")]
    groups = math.isqrt(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    dealt = vectors.withColumn("_group", F.spark_partition_id() % groups)
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("_group").orderBy(*order)))
    return ranked.filter(F.col("_rank") <= many).orderBy(*order).limit(many).select(*vectors.columns)


def codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (part, entry, component) of (vec_id, vector) after the rounds, or None without vectors."""
    first = _first(vectors, entries).select("vector").toArrow()["vector"].combine_chunks()
    if len(first) == 0:
        return None
    width = len(first[0])
    books = np.stack(np.split(_whole(first, width), parts, axis=1))
    for _ in range(rounds):
        found = _sums(vectors, books).groupBy("part", "entry")
        found = found.agg(F.sum("many").alias("many"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(books.shape[2])]).toArrow()
        part, entry, many, *sums = (c.to_numpy() for c in found.columns)
        books[part, entry] = np.stack(sums, axis=1) // many[:, None]
    return books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def _kept(embeddings: DataFrame, parts: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, vector, label) of usable vectors of the table's width."""
    named = embeddings.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label")
    )
    named = named.filter(usable(F.col("vector")))
    first = F.struct(F.col("vec_id").isNull(), F.col("vec_id"), F.col("vector"))
    width = named.agg(F.min_by(F.size("vector"), first)).first()[0] or 0
    if width % parts:
        raise ValueError(f"vectors of {width} components can't be cut into {parts} equal parts")
    beyond = F.exists("vector", lambda x: F.abs(x) > LARGEST)
    checked = F.when(beyond, F.raise_error(F.lit(f"a component is beyond {LARGEST}"))).otherwise(F.col("vector"))
    return named.filter(F.size("vector") == width).withColumn("vector", checked)


def vector_codes(
    embeddings: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(vec_id, label, codes, errors, code, error, label_error, codebooks_sha256) of every usable vector.

    ``codes`` and ``errors`` have an index and a squared distance for each
    part. Vectors that are null, or hold null or non-finite components, are
    left out, and so are those of another length than the first; a component
    beyond ``LARGEST`` is an error, as its squares would not fit. Repeated
    rows count each; null ids come last in the order by id; equal distances
    go to the lower index; null labels are one label; with fewer rows than
    entries the codebooks are that small; an empty table gives an empty
    result. Further columns are never read.
    """
    kept = _kept(embeddings, parts, id_col, vector_col, label_col)
    books = codebooks(kept, parts, entries, rounds)
    label = dict((f.name, f.dataType) for f in kept.schema)["label"].simpleString()
    schema = f"vec_id long, label {label}, codes array<int>, errors array<long>"
    if books is None:
        coded = kept.sparkSession.createDataFrame([], schema)
        digest = books_digest(np.empty(0, np.int64))
    else:
        digest = books_digest(books)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            orchards = [Orchard(b) for b in books]
            for batch in batches:
                codes, errors = np.empty((batch.num_rows, parts), np.int32), np.empty((batch.num_rows, parts), np.int64)
                for at, part, _, index, distance in _searched(batch.column(1), orchards, books.shape[2] * parts):
                    codes[at : at + len(index), part], errors[at : at + len(index), part] = index, distance
                bounds = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * parts)
                lists = [pa.ListArray.from_arrays(bounds, pa.array(x.reshape(-1))) for x in (codes, errors)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *lists], names=["vec_id", "label", "codes", "errors"])

        coded = materialize(kept.select("vec_id", "vector", "label").mapInArrow(run, schema), "codes")
    coded = coded.withColumn("error", F.aggregate("errors", F.lit(0).cast("long"), lambda a, x: a + x))
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    found = coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")
    code = F.lower(F.array_join(F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    return found.withColumn("code", code).withColumn("codebooks_sha256", F.lit(digest))
