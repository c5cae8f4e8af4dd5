"""How the words of each source of a language differ from the language and from its other sources.

Term counts are summed inside tasks before they are shuffled. The smoothed
probability of a term in a group depends on its count only, and its
difference from the language's on the pair of both counts. So the terms of a
group fall into cells of equal (group count, language count); the difference
is found once a cell, cells of equal differences are put together, and a cell
comes in once the number of terms in greater ones leaves room; only the terms
of those cells are read again and put in UTF-8 order.

The distance of two sources starts from the terms' cells as if the other
source had none of them, and is set right for the terms that both have. A
term meets the sources that use it once each, and nothing larger than the
pairs of sources is ever shuffled for it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoframe.llm.batches import steps
from histoframe.session import materialize

#: Documents of a language that must have a term, added counts, scale of probabilities, ranks of terms.
LEAST_DOCS, ADDED, SCALE, TOP = 30, 5, 1_000_000_000, 50

#: ASCII letters and everything beyond ASCII, on UTF-8 bytes.
_TERM = re.compile(rb"[A-Za-z\x80-\xFF]+")

#: Distinct (language, source, term) counts a task holds before it passes them on.
_HELD = 500_000


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs): occurrences and documents of each term, in parts to be summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in steps(batches, "text"):
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, n_docs = counts.setdefault((lang, source), (Counter(), Counter()))
                terms = _TERM.findall(text.lower())
                held -= len(n)
                n.update(terms)
                held += len(n)
                n_docs.update(set(terms))
            if held > _HELD:
                yield from _tables(counts)
                counts, held = {}, 0
        yield from _tables(counts)

    texts = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "lang string, source string, term string, n long, n_docs long")


def _tables(counts: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, n_docs) in counts.items():
        terms = list(n)
        columns = [
            pa.array([lang] * len(terms), pa.string()),
            pa.array([source] * len(terms), pa.string()),
            pa.array(terms, pa.binary()).cast(pa.string()),
            pa.array(list(n.values()), pa.int64()),
            pa.array([n_docs[t] for t in terms], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "n_docs"])


def probability(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + ADDED) / (total + ADDED * terms))``, exact beyond 64 bits."""
    above = (count + ADDED).cast("decimal(27,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", above, (total + ADDED * terms).cast("decimal(27,0)")).cast("long")


def source_divergence(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) for every occurring (lang, source).

    Part ``pair`` ranks the other sources of the language by the summed
    difference of probabilities, part ``term`` the group's terms by how far
    their probability exceeds the language's. Null text, language and source
    are empty strings; an empty text has no terms but its group counts; a
    text of any length is read whole; repeated rows count as often as they
    stand there; ties go by UTF-8 order; an empty table gives an empty
    result; columns beyond text, lang and source are never read.
    """
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    # One shuffle, by language and term, serves the sums of groups and of languages.
    counted = term_counts(named).repartition("lang", "term").groupBy("lang", "source", "term")
    counted = counted.agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    everywhere = Window.partitionBy("lang", "term")
    kept = counted.withColumn("docs_lang", F.sum("n_docs").over(everywhere)).withColumn("n_lang", F.sum("n").over(everywhere))
    kept = materialize(kept.filter(F.col("docs_lang") >= LEAST_DOCS).drop("n_docs", "docs_lang"), "kept-terms")

    langs = kept.groupBy("lang", "term").agg(F.first("n_lang").alias("n_lang"))
    langs = langs.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n_lang").alias("total_lang"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("used"))
    groups = named.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = materialize(groups.fillna(0, ["terms", "total_lang", "total", "used"]), "term-groups")
    return _pairs(kept, groups).unionByName(_terms(kept, groups))


def _terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Terms of each group by falling excess over the language, to rank ``TOP``."""
    p, q = probability(F.col("n"), F.col("total"), F.col("terms")), probability(F.col("n_lang"), F.col("total_lang"), F.col("terms"))
    key = ["lang", "source"]
    cells = kept.groupBy(*key, "n", "n_lang").agg(F.count("*").alias("many")).join(groups, key)
    cells = cells.select(*key, "n", "n_lang", "many", (p - q).alias("value")).filter("value > 0")
    by_value = cells.groupBy(*key, "value").agg(F.sum("many").alias("many"))
    falling = Window.partitionBy(*key).orderBy(F.desc("value"))
    # Every value has a term at least, so the first TOP values are enough.
    first = by_value.withColumn("place", F.row_number().over(falling)).filter(F.col("place") <= TOP)
    above = F.sum("many").over(falling.rowsBetween(Window.unboundedPreceding, -1))
    first = first.withColumn("above", F.coalesce(above, F.lit(0))).filter(F.col("above") < TOP)
    taken = cells.join(first.select(*key, "value", "above"), [*key, "value"])
    listed = kept.join(taken.select(*key, "n", "n_lang", "value", "above"), [*key, "n", "n_lang"])
    # Terms of one value only are put in order, and no more of them than there is room for.
    ordered = Window.partitionBy(*key).orderBy(F.desc("value"), "term")
    ranked = listed.withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= TOP)
    return ranked.select(*key, F.lit("term").alias("part"), F.col("term").alias("item"), "value", F.col("rank").cast("int").alias("rank"))


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """The other sources of each group's language by falling distance."""
    with_none = probability(F.lit(0), F.col("total"), F.col("terms"))
    groups = groups.select("lang", "source", "terms", "used", "total", F.when(F.col("terms") > 0, with_none).otherwise(F.lit(0)).alias("none"))
    side_a = groups.select("lang", F.col("source").alias("a"), "terms", F.col("used").alias("used_a"), F.col("none").alias("none_a"))
    side_b = groups.select("lang", F.col("source").alias("b"), F.col("used").alias("used_b"), F.col("none").alias("none_b"))
    pairs = side_a.join(side_b, "lang").filter("a <> b")

    # Cells of a source: equal counts have equal probabilities.
    cells = kept.groupBy("lang", "source", "n").agg(F.count("*").alias("many"))
    cells = cells.join(groups, ["lang", "source"]).select("lang", "source", "many", probability(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    nones = groups.select("lang", F.col("source").alias("other"), F.col("none").alias("none_other"))
    alone = cells.join(nones, "lang").filter("source <> other")
    alone = alone.groupBy("lang", "source", "other").agg(F.sum(F.col("many") * F.abs(F.col("p") - F.col("none_other"))).alias("alone"))

    terms = kept.join(groups, ["lang", "source"]).select("lang", "term", "source", "none", probability(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    left = terms.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("p_a"), F.col("none").alias("z_a"))
    right = terms.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("p_b"), F.col("none").alias("z_b"))
    both = left.join(right, ["lang", "term"]).filter("a < b")
    fix = F.abs(F.col("p_a") - F.col("p_b")) - F.abs(F.col("p_a") - F.col("z_b")) - F.abs(F.col("p_b") - F.col("z_a")) + F.abs(F.col("z_a") - F.col("z_b"))
    both = both.groupBy("lang", "a", "b").agg(F.sum(fix).alias("both"))

    one_way = alone.select("lang", F.col("source").alias("a"), F.col("other").alias("b"), F.col("alone").alias("alone_a"))
    other_way = alone.select("lang", F.col("other").alias("a"), F.col("source").alias("b"), F.col("alone").alias("alone_b"))
    both = both.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("ab"), "both")
    both = both.select("lang", "ab.a", "ab.b", "both")
    key = ["lang", "a", "b"]
    found = pairs.join(one_way, key, "left").join(other_way, key, "left").join(both, key, "left").fillna(0, ["alone_a", "alone_b", "both"])
    neither = (F.col("terms") - F.col("used_a") - F.col("used_b")) * F.abs(F.col("none_a") - F.col("none_b"))
    value = (F.col("alone_a") + F.col("alone_b") + F.col("both") + neither).cast("long")
    found = found.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), value.alias("value"))
    ordered = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(ordered).cast("int"))
