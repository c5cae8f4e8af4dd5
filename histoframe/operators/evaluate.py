"""Splits, weights, scores and summaries for cell-type classifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from histoframe.functions import numeric as X
from histoframe.operators.ranking import hash_order, hash_rank, id_rank, running_totals

METRICS = ("macro_f1", "balanced_accuracy")


# ------------------------------------------------------------ preparation


def merge_classes(cells: DataFrame, drop: Sequence[str], merge: dict[str, str], label: str = "label") -> DataFrame:
    """Unlabelled and dropped classes go; some labels count as another."""
    merged = F.col(label)
    for old, new in merge.items():
        merged = F.when(F.col(label) == old, F.lit(new)).otherwise(merged)
    return cells.filter(F.col(label).isNotNull() & ~F.col(label).isin(*drop)).withColumn(label, merged)


def class_codes(df: DataFrame, label: str = "label") -> DataFrame:
    """0-based code in the sorted list of all labels, a scalar of bounded size."""
    classes = df.select(F.array_sort(F.collect_set(label))).scalar()
    return df.withColumn("code", (F.array_position(classes, F.col(label)) - 1).cast("int"))


def quadrants(cells: DataFrame, height: Column, width: Column, band: int) -> DataFrame:
    """Quadrant 1..4 of each cell; cells in the guard band are dropped."""
    mid_x, mid_y = F.floor(width / 2), F.floor(height / 2)
    left, right = F.col("x") <= mid_x - band, F.col("x") >= mid_x + band
    top, bottom = F.col("y") <= mid_y - band, F.col("y") >= mid_y + band
    quadrant = F.when(left & top, 1).when(right & top, 2).when(left & bottom, 3).when(right & bottom, 4)
    return cells.withColumn("quadrant", quadrant).filter(F.col("quadrant").isNotNull())


def split_folds(cells: DataFrame, id_col: str, valid_frac: float = 0.2, seed: int = 42, folds: Sequence[int] = (1, 2, 3, 4)) -> DataFrame:
    """Every cell once per fold as test, valid or train.

    The held-out quadrant is test; an exact share of the rest, in seeded
    hash order, is validation.
    """
    rows = cells.select(id_col, "quadrant", F.explode(F.array(*[F.lit(f) for f in folds])).alias("fold"))
    held = rows.filter("quadrant = fold").select(id_col, "fold", F.lit("test").alias("split"))
    pool = rows.filter("quadrant <> fold")
    sizes = pool.groupBy("fold").agg(F.bround(F.count(F.lit(1)) * X.d(valid_frac)).alias("_n_valid"))
    ranked = hash_rank(pool, ["fold"], id_col, seed).join(sizes, "fold")
    split = F.when(F.col("rank") <= F.col("_n_valid"), F.lit("valid")).otherwise(F.lit("train"))
    return held.unionByName(ranked.select(id_col, "fold", split.alias("split")))


def split_join(splits: DataFrame, patches: DataFrame, id_col: str, seen: Observation | None = None) -> DataFrame:
    """Rows of the folds with ``position``, the place of their patch in the patch set (from 0, by id).

    A row whose id is absent from the patch set, or stands in it more than
    once, fails the job that reads the positions, so no action of its own is
    needed to check. ``seen`` observes ``rows``, ``missing`` and ``repeated``
    of that job.
    """
    known = patches.groupBy(id_col).agg(F.count(F.lit(1)).alias("_times"))
    placed = id_rank(known, [], id_col).withColumn("position", F.col("rank") - 1).drop("rank")
    joined = splits.join(placed, id_col, "left")
    missing, repeated = F.col("position").isNull(), F.col("_times") > 1
    if seen is not None:
        joined = joined.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("missing"), F.count_if(repeated).alias("repeated"))
    which = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    absent = F.raise_error(F.concat(F.lit(f"{id_col} "), which, F.lit(" of a fold is absent from the patch set")))
    twice = F.raise_error(F.concat(F.lit(f"{id_col} "), which, F.lit(" stands more than once in the patch set")))
    return joined.withColumn("position", F.when(missing, absent).when(repeated, twice).otherwise(F.col("position"))).drop("_times")


def cap_per_class(df: DataFrame, group: Sequence[str], id_col: str, limit: int | None, seed: int = 42) -> DataFrame:
    """At most ``limit`` rows per class in seeded hash order; small classes whole."""
    if limit is None:
        return df
    return hash_rank(df, list(group), id_col, seed).filter(F.col("rank") <= limit).drop("rank")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight n / (k * n_c) and sampler weight 1 / n_c per class.

    The window runs over one row per class.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(1))
    balanced = F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))
    return counts.select(label, "n", balanced.alias("balanced"), (X.d(1) / F.col("n")).alias("sampler"))


def weighted_sample(df: DataFrame, n: int, id_col: str, label: str = "label", seed: int = 42) -> DataFrame:
    """``n`` draws with replacement, every class equally likely.

    With weights 1 / n_c a draw is a uniform class and then a uniform row of
    it. Draws are spread over tasks and meet the rows on (class, position),
    keys of bounded multiplicity.
    """
    spark = df.sparkSession
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    coded = class_codes(sizes, label)
    n_classes = sizes.select(F.count(F.lit(1))).scalar()
    number = lambda s: F.conv(F.substring(F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit(str(s)))), 1, 15), 16, 10).cast("bigint")
    draws = spark.range(n).select(
        F.col("id").alias("draw"), F.pmod(number(seed), n_classes).cast("int").alias("code"), number(seed + 1).alias("_u")
    )
    picks = draws.join(coded, "code").withColumn("rank", F.pmod(F.col("_u"), F.col("_size")) + 1)
    return picks.select("draw", label, "rank").join(id_rank(df, [label], id_col), [label, "rank"]).drop("rank")


def feature_moments(df: DataFrame, features: str = "features") -> DataFrame:
    """Mean and population deviation per dimension, as one row of arrays."""
    per_dim = (
        df.select(F.posexplode(features).alias("dim", "v"))
        .groupBy("dim")
        .agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("dim", "mean", F.when(F.col("std") > 0, F.col("std")).otherwise(X.d(1)).alias("std"))))
    return per_dim.agg(ordered.alias("m")).select(
        F.struct(F.transform("m", lambda s: s["mean"]).alias("mean"), F.transform("m", lambda s: s["std"]).alias("std")).alias("moments")
    )


def standardize(df: DataFrame, train: DataFrame, features: str = "features") -> DataFrame:
    """Features centred and scaled with the moments of ``train``; flat dimensions keep scale 1."""
    m = F.col("_moments")
    centred = F.zip_with(features, m["mean"], lambda v, mu: v - mu)
    scaled = F.zip_with(centred, m["std"], lambda v, s: v / s)
    return df.withColumn("_moments", feature_moments(train, features).scalar()).withColumn(features, scaled).drop("_moments")


# ----------------------------------------------------------------- scoring


def _label_rows(df: DataFrame, labels: Sequence[str], name: str) -> DataFrame:
    return df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(v) for v in labels])).alias(name))


def pair_counts(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per (truth, pred): at most classes squared, all scores follow from it."""
    return df.groupBy(*keys, "truth", "pred").agg(F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Row-normalised confusion over a fixed label list; empty rows read 0."""
    rows = pair_counts(df).groupBy("truth").agg(
        F.map_from_entries(F.collect_list(F.struct("pred", "n"))).alias("_n"), F.sum("n").alias("_total")
    )
    preds = F.array(*[F.lit(v) for v in labels])
    grid = _label_rows(df, labels, "truth").join(rows, "truth", "left").select("truth", F.explode(preds).alias("pred"), "_n", "_total")
    n = F.coalesce(F.try_element_at("_n", F.col("pred")), F.lit(0).cast("bigint"))
    return grid.select("truth", "pred", n.alias("n"), F.coalesce(n / F.col("_total"), X.d(0)).alias("share"))


def class_scores(df: DataFrame, labels: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Support, precision, recall and F1 of each class; empty denominators give 0."""
    pairs = pair_counts(df, keys)
    sides = pairs.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("truth").alias("label"), F.col("n").alias("is_true"), F.lit(0).cast("bigint").alias("is_pred"),
                         F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("pred").alias("label"), F.lit(0).cast("bigint").alias("is_true"), F.col("n").alias("is_pred"), F.lit(0).cast("bigint").alias("hit")),
            )
        ),
    )
    sums = sides.groupBy(*keys, "label").agg(F.sum("is_true").alias("support"), F.sum("is_pred").alias("_pred"), F.sum("hit").alias("_hit"))
    if keys:
        every = df.select(*keys).distinct().select(*keys, F.explode(F.array(*[F.lit(v) for v in labels])).alias("label"))
    else:
        every = _label_rows(df, labels, "label")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(X.d(0))
    hit, sup, pred = zero(F.col("_hit")), zero(F.col("support")), zero(F.col("_pred"))
    return every.join(sums, [*keys, "label"], "left").select(
        *keys,
        "label",
        sup.alias("support"),
        ratio(hit, pred).alias("precision"),
        ratio(hit, sup).alias("recall"),
        ratio(2 * hit, sup + pred).alias("f1"),
    )


def macro_metrics(df: DataFrame, labels: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Macro F1 over all labels, balanced accuracy over classes with truth."""
    scores = class_scores(df, labels, keys)
    aggs = [F.avg("f1").alias("macro_f1"), F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy")]
    return scores.groupBy(*keys).agg(*aggs) if keys else scores.agg(*aggs)


def by_frequency(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.desc("support"), "label")


def error_rate(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    wrong = F.avg((F.col("pred") != F.col("truth")).cast("double")).alias("error_rate")
    return df.groupBy(*keys).agg(wrong) if keys else df.agg(wrong)


def class_score_rows(df: DataFrame, labels: Sequence[str], probs: str = "probs", keys: Sequence[str] = ()) -> DataFrame:
    """One row per (row, class): its score and whether it is the truth."""
    lab = F.array(*[F.lit(v) for v in labels])
    return df.select(*keys, "truth", F.inline(F.arrays_zip(lab.alias("label"), F.col(probs).alias("score")))).select(
        *keys, "label", "score", (F.col("truth") == F.col("label")).cast("int").alias("hit")
    )


def _by_threshold(scored: DataFrame, group: list[str], descending: bool) -> DataFrame:
    points = scored.groupBy(*group, "score").agg(
        F.sum("hit").cast("double").alias("pos"), F.sum(1 - F.col("hit")).cast("double").alias("neg")
    )
    return running_totals(points, group, "score", ["pos", "neg"], descending)


def roc_auc(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One-vs-rest area per class by mid-ranks: ties count half; null without a row of either kind."""
    group = [*keys, "label"]
    below = F.col("cum_neg") - F.col("neg") * X.d(0.5)
    return (
        _by_threshold(scored, group, False)
        .groupBy(*group)
        .agg(F.sum(F.col("pos") * below).alias("_u"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
        .select(*group, (F.col("_u") / F.nullif(F.col("_p") * F.col("_n"), X.d(0))).alias("auc"))
    )


def average_precision(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sum of recall steps times precision over distinct thresholds, per class; null without a true row."""
    group = [*keys, "label"]
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return (
        _by_threshold(scored, group, True)
        .groupBy(*group)
        .agg((F.sum(F.col("pos") * precision) / F.nullif(F.sum("pos"), X.d(0))).alias("ap"))
    )


def macro(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(f"macro_{value}"))


# ---------------------------------------------------------------- summaries


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def crosstab_share(df: DataFrame, row: str, column: str) -> DataFrame:
    """Share of each row value inside each column value."""
    counts = value_counts(df, row, column)
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(column)))


def fold_summary(results: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Per-fold rows plus mean and population deviation, four decimals."""
    rows = results.select(F.col("fold").cast("string").alias("fold"), *metrics)
    mean = results.agg(*[F.avg(m).alias(m) for m in metrics]).select(F.lit("Mean").alias("fold"), *metrics)
    std = results.agg(*[F.stddev_pop(m).alias(m) for m in metrics]).select(F.lit("Std Dev").alias("fold"), *metrics)
    return rows.unionByName(mean).unionByName(std).select("fold", *[F.round(m, 4).alias(m) for m in metrics])


def encoder_delta(results: DataFrame, first: str, second: str, metrics: Sequence[str]) -> DataFrame:
    """Mean of each metric for two encoders side by side and the difference."""
    long = results.select("encoder", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])))
    wide = long.groupBy("metric").pivot("encoder", [first, second]).agg(F.avg("value"))
    return wide.select("metric", first, second, (F.col(first) - F.col(second)).alias("delta"))


def widen_probs(df: DataFrame, labels: Sequence[str], classes: str = "classes", probs: str = "probs") -> DataFrame:
    """Probabilities in the global class order; a class the model lacks reads 0."""
    by_class = F.map_from_arrays(classes, probs)
    wide = F.transform(F.array(*[F.lit(v) for v in labels]), lambda c: F.coalesce(F.try_element_at(by_class, c), X.d(0)))
    return df.withColumn(probs, wide).drop(classes)


def argmax_label(df: DataFrame, labels: Sequence[str], probs: str = "probs") -> DataFrame:
    """Class with the highest probability, the first on ties."""
    at = F.array_position(probs, F.array_max(probs)).cast("int")
    return df.withColumn("pred", F.element_at(F.array(*[F.lit(v) for v in labels]), at))


def seeded_key(id_col: str, seed: int) -> Column:
    return hash_order(F.col(id_col), seed)
