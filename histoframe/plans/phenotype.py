"""Cell phenotyping: linear probe, regularisation search, spatial folds."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoframe.operators import evaluate as E
from histoframe.plans.softmax import SoftmaxModel, class_probabilities, fit_path
from histoframe.session import cut_lineage

# The search range of C, its trials and the training budget.
C_RANGE = (1e-4, 1e2)
N_TRIALS = 15
MAX_CELLS_PER_CLASS = 2000
MAX_ITER = 1000


@dataclass(frozen=True)
class Probe:
    model: LogisticRegressionModel | SoftmaxModel
    c: float
    labels: tuple[str, ...]


def log_grid(c_range: tuple[float, float] = C_RANGE, n: int = N_TRIALS) -> list[float]:
    low, high = c_range
    return [low * (high / low) ** (i / max(1, n - 1)) for i in range(n)]


def fit_probe(train: DataFrame, labels: Sequence[str], c: float, max_iter: int = MAX_ITER) -> Probe:
    """Multinomial logistic regression with balanced class weights.

    Balanced weights sum to the number of rows, so strength C is a penalty
    of 1 / (C * rows). ``train`` has standardized ``features`` and ``label``.
    """
    rows = train.count()
    weights = E.class_weights(train).select("label", "balanced")
    codes = F.array(*[F.lit(v) for v in labels])
    data = train.join(weights, "label").select(
        array_to_vector("features").alias("vec"),
        (F.array_position(codes, F.col("label")) - 1).cast("double").alias("code"),
        "balanced",
    )
    lr = LogisticRegression(
        featuresCol="vec", labelCol="code", weightCol="balanced", family="multinomial", regParam=1.0 / (c * max(rows, 1)),
        elasticNetParam=0.0, standardization=False, maxIter=max_iter,
    )
    return Probe(lr.fit(data), c, tuple(labels))


def predict(probe: Probe, df: DataFrame) -> DataFrame:
    """Rows with ``probs`` in the global class order and ``pred``.

    A class code above the last one seen in training is missing from the
    model's output and reads 0.
    """
    if isinstance(probe.model, SoftmaxModel):
        scored = class_probabilities(df.withColumn("fold", F.lit(0)), {0: [probe.model]}, lambda p: p[:, 0], "double")
        return E.argmax_label(scored.withColumnRenamed("scores", "probs"), probe.labels).select(*df.columns, "probs", "pred")
    scored = probe.model.transform(df.withColumn("vec", array_to_vector("features")))
    probs = scored.withColumn("probs", vector_to_array("probability"))
    seen = F.array(*[F.lit(v) for v in probe.labels[: probe.model.numClasses]])
    wide = E.widen_probs(probs.withColumn("classes", seen), probe.labels)
    kept = [c for c in df.columns]
    return E.argmax_label(wide, probe.labels).select(*kept, "probs", "pred")


def macro_f1(pairs: Sequence[tuple[str, str, int]], labels: Sequence[str]) -> float:
    """Macro F1 of (truth, pred, n) counts; a label without rows counts 0."""
    total = 0.0
    for label in labels:
        hit = sum(n for truth, pred, n in pairs if truth == label == pred)
        seen = sum(n for truth, _, n in pairs if truth == label) + sum(n for _, pred, n in pairs if pred == label)
        total += 2 * hit / seen if seen else 0.0
    return total / len(labels)


def tune_probes(
    train: DataFrame, valid: DataFrame, labels: Sequence[str], folds: Sequence[int], n_trials: int = N_TRIALS, max_iter: int = MAX_ITER
) -> tuple[dict[int, Probe], DataFrame]:
    """For each fold the probe with the C of the best validation macro F1, and every trial.

    ``train`` and ``valid`` have fold, label and standardized features. The
    model is ``fit_probe``'s, the grid is even on the log scale of the search
    range. All trials of all folds are fitted in the same passes and scored in
    one more; rows and class weights are counted once. The trials have fold,
    c, valid_f1, and how the fit ended: steps, slope, state.
    """
    spark = train.sparkSession
    train, valid = (part.filter(F.col("fold").isin(*folds)) for part in (train, valid))
    counts = train.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()
    rows, classes = Counter(), Counter()
    for r in counts:
        rows[r.fold] += r.n
        classes[r.fold] += 1
    place = {label: i for i, label in enumerate(labels)}
    balanced = [(r.fold, r.label, place[r.label], rows[r.fold] / (classes[r.fold] * r.n)) for r in counts]
    weights = spark.createDataFrame(balanced, "fold int, label string, code int, weight double")
    data = cut_lineage(train.join(weights, ["fold", "label"]).select(F.col("features").cast("array<double>"), "code", "weight", "fold"))
    width = data.select(F.max(F.size("features"))).first()[0]
    grid = log_grid(n=n_trials)
    trials = [(fold, c) for fold in folds for c in grid]
    models, report = fit_path(data, len(labels), width, trials, max_steps=max_iter)
    of_fold = {fold: [m for m, (f, _) in zip(models, trials, strict=True) if f == fold] for fold in folds}
    scored = class_probabilities(valid.select("fold", "label", "features"), of_fold, lambda p: p.argmax(axis=2).astype("int32"), "int")
    each = scored.select("fold", "label", F.posexplode("scores").alias("trial", "pred")).groupBy("fold", "trial", "label", "pred").agg(F.count(F.lit(1)).alias("n")).collect()
    pairs = defaultdict(list)
    for r in each:
        pairs[r.fold, r.trial].append((r.label, labels[r.pred], r.n))
    tried = []
    for i, ((fold, c), how) in enumerate(zip(trials, report, strict=True)):
        tried.append((fold, float(c), macro_f1(pairs[fold, i % len(grid)], labels), how["steps"], how["slope"], how["state"]))
    best = {fold: max((i for i, t in enumerate(tried) if t[0] == fold), key=lambda i: (tried[i][2], -tried[i][1])) for fold in folds}
    probes = {fold: Probe(models[i], tried[i][1], tuple(labels)) for fold, i in best.items()}
    return probes, spark.createDataFrame(tried, "fold int, c double, valid_f1 double, steps int, slope double, state string")


def cross_validate(
    cells: DataFrame,
    labels: Sequence[str],
    id_col: str = "cell_id",
    n_trials: int = N_TRIALS,
    max_per_class: int | None = MAX_CELLS_PER_CLASS,
    max_iter: int = MAX_ITER,
    seed: int = 42,
    folds: Sequence[int] = (1, 2, 3, 4),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(out-of-fold predictions, per-fold metrics, all trials).

    ``cells`` has the id, features, label and quadrant; every cell is tested
    exactly once. The metrics of a fold are macro F1, balanced accuracy, mean
    average precision and mean one-vs-rest area. Fold tables are written, each
    is read by many fits.
    """
    base = cut_lineage(cells)
    splits = cut_lineage(E.split_folds(base, id_col, seed=seed, folds=folds))

    def prepared(fold: int) -> DataFrame:
        part = base.join(splits.filter(F.col("fold") == fold).select(id_col, "split"), id_col)
        train = E.cap_per_class(part.filter("split = 'train'"), ["label"], id_col, max_per_class, seed)
        return cut_lineage(E.standardize(part.filter("split <> 'train'").unionByName(train), train)).withColumn("fold", F.lit(fold))

    with ThreadPoolExecutor(2) as pool:
        scaled = reduce(DataFrame.unionByName, pool.map(prepared, folds))
    probes, every = tune_probes(scaled.filter("split = 'train'"), scaled.filter("split = 'valid'"), labels, folds, n_trials, max_iter)
    tested = scaled.filter("split = 'test'").select(id_col, "fold", F.col("label").alias("truth"), "features")
    best = {fold: [p.model] for fold, p in probes.items()}
    out = E.argmax_label(class_probabilities(tested, best, lambda p: p[:, 0], "double").withColumnRenamed("scores", "probs"), labels)
    out = out.select(id_col, "fold", "truth", "pred", "probs")
    chosen = [(fold, p.c) for fold, p in probes.items()]
    out = cut_lineage(out)
    c = base.sparkSession.createDataFrame(chosen, "fold int, c double")
    scored = E.class_score_rows(out, labels, keys=["fold"])
    ranked = [E.macro(E.average_precision(scored, ["fold"]), "ap", ["fold"]), E.macro(E.roc_auc(scored, ["fold"]), "auc", ["fold"])]
    metrics = E.macro_metrics(out, labels, ["fold"]).join(ranked[0], "fold").join(ranked[1], "fold").join(c, "fold")
    return out, metrics, every
