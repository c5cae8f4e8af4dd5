"""Exact quantiles of real numbers by refinement, with bounded state.

A histogram of distinct values is as long as the data once values are real
numbers. Instead the 64 bits of a number, put so that they sort like the
numbers, are read 16 at a time: counts per leading bits say which of them hold
a wanted rank, and only numbers that begin with those go on to the next 16. A
task holds at most 65,536 counts for each leading part, and after the first
reading the table has shrunk to the neighbourhood of the ranks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoframe.session import materialize

#: Bits read at a time.
DIGIT = 16

_SIGN = 0x7FFF_FFFF_FFFF_FFFF


def _sortable(rows: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """(keys, weight, bits): the numbers as whole ones of the same order; -0.0 counts as 0.0, NaN as the greatest."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keys, weight).schema)

    def bits(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            raw = (batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False) + 0.0).view(np.int64)
            ordered = raw ^ ((raw >> 63) & _SIGN)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ordered)], names=[*batch.schema.names[:-1], "bits"])

    named = rows.filter(F.col(value).isNotNull()).select(*keys, weight, F.col(value).cast("double").alias("_value"))
    return named.mapInArrow(bits, f"{schema}, bits bigint")


def _numbers(rows: DataFrame) -> DataFrame:
    """``bits`` back to the double ``value``."""
    kept = [c for c in rows.columns if c != "bits"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*kept).schema)

    def back(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            ordered = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            raw = ordered ^ ((ordered >> 63) & _SIGN)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(raw.view(np.float64))], names=[*kept, "value"])

    return rows.select(*kept, "bits").mapInArrow(back, f"{schema}, value double")


def _prefix(digits: int) -> Column:
    return F.shiftright("bits", 64 - DIGIT * digits)


def _located(counts: DataFrame, wanted: DataFrame, keys: list[str], part: str) -> DataFrame:
    """``wanted`` ranks with the prefix that holds each, ``before`` counting all smaller numbers of the keys."""
    upto = Window.partitionBy(*keys, *([part] if part in counts.columns else [])).orderBy("prefix")
    placed = counts.withColumn("_upto", F.sum("n").over(upto))
    held = wanted.join(placed, [*keys, *([part] if part in counts.columns else [])])
    inside = F.col("rank") - F.col("before")
    held = held.filter((inside >= F.col("_upto") - F.col("n")) & (inside < F.col("_upto")))
    return held.select(*keys, "which", "rank", (F.col("before") + F.col("_upto") - F.col("n")).alias("before"), F.col("prefix").alias("part"))


def refined_quantiles(rows: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], weight: str) -> DataFrame:
    """(keys, quantiles): linear interpolation between exact order statistics, for each share.

    ``weight`` is how often a row counts; rows with a null value or no weight
    don't. Keys without rows give no row.
    """
    keys = list(keys)
    numbers = _sortable(rows.filter(F.col(weight) > 0), keys, value, weight)
    counts = materialize(numbers.groupBy(*keys, _prefix(1).alias("prefix")).agg(F.sum(weight).alias("n")), "leading-bits")
    total = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    at = [(F.col("_total") - 1) * F.lit(share).cast("double") for share in shares]
    both = [F.struct(F.lit(2 * i + up).alias("which"), (F.ceil(h) if up else F.floor(h)).alias("rank")) for i, h in enumerate(at) for up in (0, 1)]
    wanted = total.select(*keys, F.inline(F.array(*both))).withColumn("before", F.lit(0).cast("bigint"))
    found = materialize(_located(counts, wanted, keys, "part"), "ranks")
    for digits in range(2, 64 // DIGIT + 1):
        near = found.select(*keys, "part").distinct()
        numbers = numbers.withColumn("part", _prefix(digits - 1)).join(near, [*keys, "part"]).select(*keys, weight, "bits")
        if digits == 2:
            numbers = materialize(numbers, "near-ranks")
        counts = numbers.groupBy(*keys, _prefix(digits - 1).alias("part"), _prefix(digits).alias("prefix")).agg(F.sum(weight).alias("n"))
        found = materialize(_located(counts, found, keys, "part"), "ranks")
    values = _numbers(found.select(*keys, "which", F.col("part").alias("bits")))
    by_key = values.groupBy(*keys).agg(*[F.max(F.when(F.col("which") == w, F.col("value"))).alias(f"_v{w}") for w in range(2 * len(shares))])
    out = []
    for i, h in enumerate(at):
        low, high = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        out.append(low + (high - low) * (h - F.floor(h)))
    return by_key.join(total, keys).select(*keys, F.array(*out).alias("quantiles"))
