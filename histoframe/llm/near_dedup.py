"""Near-duplicate classes from bottom-k sketches of one hash function.

A document's sketch is the ``k`` smallest 64-bit fingerprints of its shingle
set. Inverted lists of the retained values give the pairs that overlap, the
bottom-k sketch of a pair's union estimates its Jaccard similarity, and pairs
that may reach the threshold are confirmed on the full sets.

Exact copies (equal sets) become one class before anything is paired. Lists
of more than ``long_list`` classes are never paired out:

* a class with at least half a sketch of values from shorter lists is found
  through those (a pair at the threshold shares each retained value with the
  probability of the similarity, so missing them all has odds below 1e-6);
* other classes ("heavy": their text is mostly shared passages) get exact
  lists over their full sets: values are ordered short lists first, and each
  class posts only the prefix that any partner at the threshold must share.
  Short lists are paired out. In long ones every class meets the head of its
  own and its neighbouring size bands, and afterwards only those that are
  not in the list's largest component meet the rest of the list.

No link between different components is lost to a cap; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histoframe.llm.batches import steps
from histoframe.llm.shingles import WIDTH, shingle_sets
from histoframe.operators.runs import connected_roots
from histoframe.session import cut_lineage, materialize

#: Fingerprints a sketch retains.
SKETCH = 48
#: Classes up to which a list is paired out.
LONG_LIST = 64
#: Standard errors below the threshold at which an estimate still counts as possible.
SLACK = 5.0


def shingle_tables(docs: DataFrame, width: int, keep: int | None) -> DataFrame:
    """(doc_id, n, sig, vals) of (doc_id, text): set size, signature of the set, its ``keep`` smallest values (all, if None)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            sets = shingle_sets(batch.column(1), width)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([s[:keep] for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "sig", "vals"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, sig binary, vals array<long>")


def _sizes_fit(percent: int, a: str = "na", b: str = "nb"):
    """Sizes at which the threshold can be reached at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _long_overlap_fits(percent: int, n: str, n_long: str, m: str, m_long: str):
    """Sizes at which two classes that share no value of a short list can reach the threshold.

    All they can share are values of long lists, so the intersection is at
    most the smaller number of those. (Pairs that share a value of a short
    list are found there.)
    """
    return (100 + percent) * F.least(n_long, m_long) >= percent * (F.col(n) + F.col(m))


def _short_list_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs a < b out of lists of (v, rep, n), one row per shared value."""
    left = postings.select("v", F.col("rep").alias("a"), F.col("n").alias("na"))
    right = postings.select("v", F.col("rep").alias("b"), F.col("n").alias("nb"))
    return left.join(right, "v").filter((F.col("a") < F.col("b")) & _sizes_fit(percent)).drop("v")


def sketch_pairs(reps: DataFrame, percent: int, k: int, long_list: int, floor: float) -> tuple[DataFrame, DataFrame]:
    """Pairs by overlap of retained values, and the heavy classes.

    A pair that can pass the estimate shares a least number of values beside
    those of long lists. Values stand in one order, rarest first, so it also
    shares one of each class's first values, up to that number from the end;
    only those are paired, and a class with fewer shared values has no pairs.
    """
    postings = reps.select("rep", "n", F.explode("vals").alias("v"))
    counts = postings.groupBy("v").agg(F.count("*").alias("c")).filter("c > 1")
    shared = materialize(postings.join(counts, "v"), "lists")
    hot = shared.filter(F.col("c") > long_list).groupBy("rep").agg(F.count("*").alias("hot"))
    heavy = reps.join(hot, "rep").filter(F.size("vals") - F.col("hot") < k // 2).select("rep")
    short = shared.filter(F.col("c") <= long_list).join(hot, "rep", "left").na.fill(0, ["hot"])
    own = Window.partitionBy("rep")
    needed = F.ceil(floor * F.least(F.lit(k), F.col("n"))) - F.col("hot")
    ranked = short.withColumn("held", F.count("*").over(own)).withColumn("at", F.row_number().over(own.orderBy("c", "v")))
    prefix = materialize(ranked.filter(F.col("at") <= F.col("held") - needed + 1).select("v", "rep", "n"), "short")
    return _short_list_pairs(prefix, percent).select("a", "b").distinct(), heavy


def estimate_filter(pairs: DataFrame, reps: DataFrame, k: int, floor: float) -> DataFrame:
    """Pairs whose union sketch leaves the threshold possible.

    Of the k smallest values of both sketches together, the share that both
    sketches hold estimates the Jaccard similarity (exactly it, if the union
    has no more than k values).
    """
    sketch = reps.select("rep", "vals")
    both = pairs.join(sketch.select(F.col("rep").alias("a"), F.col("vals").alias("va")), "a").join(
        sketch.select(F.col("rep").alias("b"), F.col("vals").alias("vb")), "b"
    )
    union = F.slice(F.array_sort(F.array_union("va", "vb")), 1, k)
    common = F.size(F.array_intersect(F.array_intersect("va", "vb"), F.col("u")))
    return both.withColumn("u", union).filter(common >= floor * F.size("u")).select("a", "b")


def confirm(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs that reach the threshold on their full sets."""
    sets = full.select("rep", "vals")
    both = pairs.join(sets.select(F.col("rep").alias("a"), F.col("vals").alias("va")), "a").join(
        sets.select(F.col("rep").alias("b"), F.col("vals").alias("vb")), "b"
    )
    both = both.select("a", "b", F.size("va").alias("na"), F.size("vb").alias("nb"), F.size(F.array_intersect("va", "vb")).alias("inter"))
    return both.filter(100 * F.col("inter") >= percent * (F.col("na") + F.col("nb") - F.col("inter"))).select("a", "b")


def heavy_lists(full: DataFrame, heavy: DataFrame, percent: int, long_list: int) -> DataFrame:
    """(v, rep, n, band, rank, long) prefix postings of the heavy classes' full sets.

    Values stand in one order for all classes: short lists first, then by
    value. Partners at the threshold share a value of both prefixes.
    """
    postings = full.join(heavy, "rep", "left_semi").select("rep", "n", F.explode("vals").alias("v"))
    counts = postings.groupBy("v").agg(F.count("*").alias("c"))
    by_class = Window.partitionBy("rep")
    ordered = postings.join(counts, "v").withColumn("long", F.col("c") > long_list)
    prefix = (
        ordered.withColumn("at", F.row_number().over(by_class.orderBy("long", "v")))
        .withColumn("n_long", F.sum(F.col("long").cast("long")).over(by_class))
        .filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
        .filter("c > 1")
    )
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)))
    return materialize(prefix.select("v", "rep", "n", band.alias("band"), "n_long", "long"), "prefix")


def head_pairs(long_lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of every class in a long list with the heads of its size band and of both next to it."""
    heads = long_lists.groupBy("v", "band").agg(F.max_by(F.struct(F.col("rep").alias("h"), F.col("n").alias("nh"), F.col("n_long").alias("lh")), F.struct("n_long", -F.col("rep"))).alias("head"))
    near = heads.select("v", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), "head.h", "head.nh", "head.lh")
    fits = _sizes_fit(percent, "n", "nh") & _long_overlap_fits(percent, "n", "n_long", "nh", "lh")
    met = long_lists.join(near, ["v", "band"]).filter((F.col("rep") != F.col("h")) & fits)
    return met.select(F.least("rep", "h").alias("a"), F.greatest("rep", "h").alias("b")).distinct()


def rest_pairs(long_lists: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs across components of a long list, with at least one outside the list's largest component."""
    placed = long_lists.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    sizes = placed.groupBy("v", "root").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("v").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    placed = placed.join(largest, "v")
    outside = placed.filter("root <> main").select("v", F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("n_long").alias("lx"), F.col("root").alias("rx"))
    fits = _sizes_fit(percent, "n", "nx") & _long_overlap_fits(percent, "n", "n_long", "nx", "lx")
    met = outside.join(placed, "v").filter((F.col("root") != F.col("rx")) & fits)
    return met.select(F.least("rep", "x").alias("a"), F.greatest("rep", "x").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = 75,
    k: int = SKETCH, long_list: int = LONG_LIST, slack: float = SLACK,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id, component_id, kept.

    ``class_id`` is the smallest id with an equal shingle set,
    ``component_id`` the smallest id reachable over links (sets with
    ``100 * |both| >= percent * |either|``). Documents with a null, empty or
    blank text have an empty set and are their own component. Rows with a
    null id are left out; rows that repeat an id give a row each, in one
    component if their texts are equal. An empty table gives an empty result.
    """
    floor = percent / 100 - slack * (percent / 100 * (1 - percent / 100) / k) ** 0.5
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id IS NOT NULL")
    sets = materialize(shingle_tables(texts, width, k), "sketches")
    classes = sets.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("vals").alias("vals"))
    reps = materialize(classes, "classes")

    pairs, heavy = sketch_pairs(reps, percent, k, long_list, floor)
    heavy = materialize(heavy, "heavy")
    likely = materialize(estimate_filter(pairs, reps, k, floor), "likely")
    needed = likely.select(F.col("a").alias("rep")).unionByName(likely.select(F.col("b").alias("rep"))).unionByName(heavy).distinct()
    # The ids grow with the table, so they are merged and not broadcast, at every size.
    needed = needed.hint("merge")
    again = texts.join(needed.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    full = shingle_tables(again, width, None).withColumnRenamed("doc_id", "rep")
    full = materialize(full.join(reps.select("rep", "sig"), ["rep", "sig"], "left_semi").dropDuplicates(["rep"]), "full")

    lists = heavy_lists(full, heavy, percent, long_list)
    long_lists = lists.filter("long")
    short = _short_list_pairs(lists.filter("NOT long"), percent).select("a", "b").distinct()
    extra = estimate_filter(short.unionByName(head_pairs(long_lists, percent)).distinct(), reps, k, floor)
    links = materialize(confirm(likely.unionByName(extra).distinct(), full, percent), "links")
    nodes = reps.select(F.col("rep").alias("node"))
    if not long_lists.isEmpty():
        first = connected_roots(nodes, links.select(F.col("a").alias("src"), F.col("b").alias("dst")))
        rest = cut_lineage(confirm(estimate_filter(rest_pairs(long_lists, first, percent), reps, k, floor), full, percent))
        links = links.unionByName(rest)
    roots = connected_roots(nodes, links.select(F.col("a").alias("src"), F.col("b").alias("dst")))

    members = reps.join(roots, reps.rep == roots.node).select("sig", F.col("rep").alias("class_id"), F.col("root").alias("component_id"))
    out = sets.select("doc_id", "n", F.when(F.col("n") > 0, F.col("sig")).alias("sig")).join(members, "sig", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"),
        component.alias("component_id"), (F.col("doc_id") == component).alias("kept"),
    )


def without_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Of rows that repeat an id one stays; rows without an id stay.
    """
    found = materialize(near_duplicates(docs, **options).select("doc_id", "kept"), "copies")
    id_col = options.get("id_col", "doc_id")
    copies = found.filter("NOT kept").select(F.col("doc_id").alias("_copy")).distinct().hint("merge")
    left = docs.join(copies, F.col(id_col) == F.col("_copy"), "left_anti")
    repeated = materialize(found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("_copy")), "repeated")
    if repeated.isEmpty():
        return left
    one = left.join(repeated, F.col(id_col) == F.col("_copy"), "left_semi").dropDuplicates([id_col])
    return left.join(repeated, F.col(id_col) == F.col("_copy"), "left_anti").unionByName(one)
