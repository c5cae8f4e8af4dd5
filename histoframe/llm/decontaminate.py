"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so the Jaccard similarity of the two
is tiny even where the item is contained whole. Items are therefore
partitioned by the size of their shingle set (powers of two), and for every
partition documents are covered by overlapping windows of that size: blocks
of half a partition's bound, three to a window, so that a passage of an
item's length lies whole in some window. There the similarity is at least
0.23 whenever the item is contained to 0.75, and the chance that none of
``HASHES`` MinHash values agrees is below 1e-5.

Equal values give candidates, a Bloom filter of fixed size keeps windows that
agree with no item from being shuffled, and the containment of the item's
shingles in the whole document is verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoframe.llm.batches import steps
from histoframe.llm.shingles import PUNCTUATION, WIDTH, distinct, mix, shingle_rows, shingle_sets
from histoframe.session import materialize

#: MinHash values of an item and of a window.
HASHES = 48
#: Bits a key gets in the Bloom filter, probes of a key, and the most 64-bit words (32 MB), so that it never outgrows a broadcast.
BLOOM_BITS, PROBES, MAX_WORDS = 32, 4, 1 << 22

_SEEDS = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64)).astype(np.uint32)
_XOR, _FACTOR = _SEEDS[:HASHES], _SEEDS[HASHES:] | np.uint32(1)


def _permuted(fingerprints: np.ndarray, j: int) -> np.ndarray:
    """The j-th permutation of 32-bit fingerprints."""
    with np.errstate(over="ignore"):
        h = (fingerprints ^ _XOR[j]) * _FACTOR[j]
        return h ^ (h >> np.uint32(16))


def _keys(level: int, j: int, lows: np.ndarray) -> np.ndarray:
    """One 64-bit key per partition, permutation and value."""
    return (lows.astype(np.uint64) | np.uint64(level << 48 | j << 40)).view(np.int64)


def _bloom_bits(keys: np.ndarray, probe: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and bit of each key's probe."""
    h = mix(keys.view(np.uint64) ^ np.uint64(probe << 56))
    return (h & np.uint64(words - 1)).astype(np.int64), np.uint64(1) << (h >> np.uint64(58))


def _passing(keys: np.ndarray, bloom: np.ndarray) -> np.ndarray:
    """Positions of the keys that the filter may hold."""
    at = np.arange(len(keys))
    for probe in range(PROBES):
        words, bits = _bloom_bits(keys[at], probe, len(bloom))
        at = at[bloom[words] & bits != 0]
    return at


def level_of(size: int) -> int:
    """Partition of a set size: the smallest power of two that is not less."""
    return (size - 1).bit_length()


def item_table(items: DataFrame, width: int) -> DataFrame:
    """(item_id, n, level, keys, vals) of (item_id, text), for items that have a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            sets = shingle_sets(batch.column(1), width, PUNCTUATION)
            held = [i for i, s in enumerate(sets) if len(s)]
            levels = [level_of(len(sets[i])) for i in held]
            lows = [(sets[i].view(np.uint64) >> np.uint64(32)).astype(np.uint32) for i in held]
            keys = [np.concatenate([_keys(c, j, _permuted(x, j).min(keepdims=True)) for j in range(HASHES)]) for c, x in zip(levels, lows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(held, pa.int64())),
                    pa.array([len(sets[i]) for i in held], pa.int64()),
                    pa.array(levels, pa.int32()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array([sets[i] for i in held], pa.list_(pa.int64())),
                ],
                names=["item_id", "n", "level", "keys", "vals"],
            )

    return items.mapInArrow(run, "item_id long, n long, level int, keys array<long>, vals array<long>")


def bloom_filter(items: DataFrame) -> np.ndarray:
    """Bit set of all items' keys, put together word by word in Spark (at most ``MAX_WORDS`` rows come back)."""
    n = items.count() * HASHES
    words = min(MAX_WORDS, 1 << max(8, (n * BLOOM_BITS // 64).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for probe in range(PROBES):
                at, bits = _bloom_bits(batch.column(0).to_numpy(), probe, words)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits.view(np.int64))], names=["word", "bits"])

    bits = items.select(F.explode("keys").alias("key")).mapInArrow(run, "word long, bits long")
    found = bits.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(words, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def window_keys(rows: list[np.ndarray], levels: list[int], bloom: np.ndarray) -> list[np.ndarray]:
    """Each document's distinct MinHash keys, over all windows, that pass the filter."""
    lengths = np.array([len(r) for r in rows], np.int64)
    if not levels or lengths.sum() == 0:
        return [np.empty(0, np.int64) for _ in rows]
    low = (np.concatenate(rows).view(np.uint64) >> np.uint64(32)).astype(np.uint32)
    first = np.cumsum(lengths) - lengths
    grids = []
    for level in levels:
        block = max(1, 1 << level >> 1)
        blocks = -(-lengths // block)
        owner = np.repeat(np.arange(len(rows)), blocks)
        place = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        grids.append((level, owner, np.repeat(first, blocks) + place * block))
    hits, owners = [], []
    for j in range(HASHES):
        h = _permuted(low, j)
        for level, owner, starts in grids:
            block_lows = np.minimum.reduceat(h, starts)
            lows = block_lows.copy()
            for ahead in (1, 2) if level else ():
                same = owner[ahead:] == owner[:-ahead]
                np.minimum(lows[:-ahead], block_lows[ahead:], out=lows[:-ahead], where=same)
            keys = _keys(level, j, lows)
            hit = _passing(keys, bloom)
            hits.append(keys[hit])
            owners.append(owner[hit])
    hits, owners = np.concatenate(hits), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    ends = np.searchsorted(owners[order], np.arange(len(rows) + 1))
    return [distinct(hits[order[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def suspects(docs: DataFrame, levels: list[int], bloom: np.ndarray, width: int) -> DataFrame:
    """(doc_id, sig, keys, vals) of documents with a window that agrees with the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            rows = shingle_rows(batch.column(1), width, PUNCTUATION)
            keys = window_keys(rows, levels, shared.value)
            held = [i for i, k in enumerate(keys) if len(k)]
            sets = [distinct(rows[i]) for i in held]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(held, pa.int64())),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([keys[i] for i in held], pa.list_(pa.int64())),
                    pa.array(sets, pa.list_(pa.int64())),
                ],
                names=["doc_id", "sig", "keys", "vals"],
            )

    return docs.mapInArrow(run, "doc_id long, sig binary, keys array<long>, vals array<long>")


def contained_items(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", width: int = WIDTH, percent: int = 75
) -> DataFrame:
    """(doc_id, item_id, n_item, n_common, containment): items a document contains to ``percent`` or more.

    Words are runs of letters and digits, A-Z in lower case; an item with
    fewer than ``width`` words is found only where it is a whole document.
    Null, empty and blank texts contain and match nothing; rows with a null id
    are left out. Rows that repeat an id give one row a pair, that of the
    largest containment (then the larger item). Empty tables give an empty
    result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id IS NOT NULL")
    wanted = items.select(F.col(item_col).cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id IS NOT NULL")
    known = materialize(item_table(wanted, width), "items")
    levels = sorted(r["level"] for r in known.select("level").distinct().collect())
    found = materialize(suspects(texts, levels, bloom_filter(known), width), "suspects")

    item_keys = known.select("item_id", F.xxhash64("vals").alias("item_sig"), F.explode("keys").alias("key"))
    pairs = found.select("doc_id", "sig", F.explode("keys").alias("key")).join(item_keys, "key").select("doc_id", "sig", "item_id", "item_sig").distinct()
    item_sets = known.select("item_id", F.xxhash64("vals").alias("item_sig"), F.col("n").alias("n_item"), F.col("vals").alias("item_vals")).dropDuplicates(["item_id", "item_sig"])
    doc_sets = found.select("doc_id", "sig", "vals").dropDuplicates(["doc_id", "sig"])
    met = pairs.join(doc_sets, ["doc_id", "sig"]).join(item_sets, ["item_id", "item_sig"])
    met = met.select("doc_id", "item_id", "n_item", F.size(F.array_intersect("item_vals", "vals")).cast("long").alias("n_common"))
    met = met.filter(100 * F.col("n_common") >= percent * F.col("n_item")).withColumn("containment", F.col("n_common") / F.col("n_item"))
    best = met.groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_item", "n_common")).alias("m"))
    return best.select("doc_id", "item_id", "m.n_item", "m.n_common", "m.containment")


def without_benchmark(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without those that contain an item; rows without an id stay."""
    found = materialize(contained_items(docs, items, **options).select(F.col("doc_id").alias("_leak")).distinct(), "leaks")
    found = found.hint("merge")  # grows with the table, so it is merged and not broadcast, at every size
    return docs.join(found, F.col(options.get("id_col", "doc_id")) == F.col("_leak"), "left_anti")
