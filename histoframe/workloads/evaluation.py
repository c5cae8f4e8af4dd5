"""Classifier evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from histoframe.functions import numeric as X
from histoframe.operators import cells as C
from histoframe.operators import evaluate as E
from histoframe.plans import phenotype
from histoframe.session import scratch_path
from histoframe.sources import readers, sinks
from histoframe.workloads import inputs as I
from histoframe.workloads import workload
from histoframe.workloads.pixels import r6

LABELS = [f"class_{i}" for i in range(10)]
DIMS = 64  # of the feature vectors
LABEL_LIST = "labels_ AS (SELECT 'class_' || i AS label FROM range(10) t(i))"


@workload(
    "class_filter_merge",
    "SELECT cell_id, CASE WHEN label = 'class_8' THEN 'class_7' ELSE label END AS label FROM cell_features WHERE label <> 'class_9'",
)
def class_filter_merge(spark, sf):
    return E.merge_classes(I.cell_features(spark, sf), ["class_9"], {"class_8": "class_7"}).select("cell_id", "label")


QUAD = """quad AS (SELECT * FROM (SELECT cell_id, label, features, x, y, CASE WHEN x <= 450 AND y <= 450 THEN 1 WHEN x >= 550 AND y <= 450 THEN 2
        WHEN x <= 450 AND y >= 550 THEN 3 WHEN x >= 550 AND y >= 550 THEN 4 END AS quadrant FROM cell_features) WHERE quadrant IS NOT NULL)"""


def _quad(spark, sf):
    return E.quadrants(I.cell_features(spark, sf), F.lit(1000), F.lit(1000), 50)


@workload("quadrant_fold", f"WITH {QUAD} SELECT cell_id, quadrant FROM quad")
def quadrant_fold(spark, sf):
    return _quad(spark, sf).select("cell_id", "quadrant")


SPLITS = f"""{QUAD}, rows_ AS (SELECT cell_id, quadrant, CAST(f AS INT) AS fold FROM quad, range(1, 5) t(f)),
    pool AS (SELECT cell_id, fold, row_number() OVER (PARTITION BY fold ORDER BY md5(cell_id || '|42'), cell_id) AS rank, COUNT(*) OVER (PARTITION BY fold) AS n
             FROM rows_ WHERE quadrant <> fold),
    splits AS (SELECT cell_id, fold, 'test' AS split FROM rows_ WHERE quadrant = fold
               UNION ALL SELECT cell_id, fold, CASE WHEN rank <= round_even(n * 0.2::DOUBLE, 0) THEN 'valid' ELSE 'train' END FROM pool)"""


@workload("split_fold", f"WITH {SPLITS} SELECT * FROM splits")
def split_fold(spark, sf):
    return E.split_folds(_quad(spark, sf), "cell_id")


@workload("sink_splits", f"WITH {SPLITS} SELECT cell_id, label, fold, split FROM splits JOIN quad USING (cell_id)")
def sink_splits(spark, sf):
    cells = _quad(spark, sf)
    path = scratch_path(spark, "splits")
    sinks.write_splits(E.split_folds(cells, "cell_id").join(cells.select("cell_id", "label"), "cell_id"), path)
    return spark.read.parquet(path).select("cell_id", "label", "fold", "split")


@workload(
    "split_join",
    f"""WITH {SPLITS}, pos AS (SELECT cell_id, row_number() OVER (ORDER BY cell_id) - 1 AS position FROM quad)
        SELECT cell_id, label, fold, split, position FROM splits JOIN quad USING (cell_id) JOIN pos USING (cell_id)""",
)
def split_join(spark, sf):
    """Folds written and read back, each row with the position of its patch."""
    cells = _quad(spark, sf)
    path = scratch_path(spark, "splits")
    sinks.write_splits(E.split_folds(cells, "cell_id").join(cells.select("cell_id", "label"), "cell_id"), path)
    return E.split_join(readers.read_splits(spark, path), cells, "cell_id").select("cell_id", "label", "fold", "split", "position")


@workload(
    "cap_per_class",
    """SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || '|42'), doc_id) AS rank FROM documents) WHERE rank <= 150""",
)
def cap_per_class(spark, sf):
    return E.cap_per_class(I.table(spark, sf, "documents").select("doc_id", "lang"), ["lang"], "doc_id", 150)


@workload(
    "class_weights",
    "SELECT truth AS label, n, ROUND(SUM(n) OVER () / (COUNT(*) OVER () * n), 6) AS balanced, ROUND(1 / n, 9) AS sampler FROM (SELECT truth, COUNT(*) AS n FROM predictions GROUP BY 1)",
)
def class_weights(spark, sf):
    w = E.class_weights(I.predictions(spark, sf).withColumnRenamed("truth", "label"))
    return w.select("label", "n", r6("balanced"), F.round("sampler", 9).alias("sampler"))


@workload(
    "weighted_sample",
    """WITH k AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS code, COUNT(*) AS size FROM cell_features GROUP BY label),
        r AS (SELECT cell_id, label, row_number() OVER (PARTITION BY label ORDER BY cell_id) AS rank FROM cell_features),
        d AS (SELECT range AS draw, CAST('0x' || substr(md5(range || '|42'), 1, 15) AS BIGINT) % (SELECT COUNT(*) FROM k) AS code,
                     CAST('0x' || substr(md5(range || '|43'), 1, 15) AS BIGINT) AS u FROM range(5000))
        SELECT draw, label, cell_id FROM d JOIN k USING (code) JOIN r USING (label) WHERE rank = u % size + 1""",
)
def weighted_sample(spark, sf):
    return E.weighted_sample(I.cell_features(spark, sf).select("cell_id", "label"), 5000, "cell_id")


@workload(
    "class_codes",
    "SELECT cell_id, label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INT) AS code FROM cell_features",
)
def class_codes(spark, sf):
    return E.class_codes(I.cell_features(spark, sf)).select("cell_id", "label", "code")


@workload(
    "standardize",
    f"""WITH {SPLITS}, dims AS (SELECT cell_id, unnest(features) AS v, unnest(range(len(features))) AS dim FROM cell_features),
        m AS (SELECT dim, AVG(v) AS mu, STDDEV_POP(v) AS sd FROM dims JOIN splits USING (cell_id) WHERE fold = 1 AND split = 'train' GROUP BY 1)
        SELECT cell_id, CAST(dim AS INT) AS dim, ROUND((v - mu) / CASE WHEN sd > 0 THEN sd ELSE 1 END, 6) AS z FROM dims JOIN m USING (dim)""",
)
def standardize(spark, sf):
    cells = I.cell_features(spark, sf)
    train = E.split_folds(_quad(spark, sf), "cell_id", folds=(1,)).filter("split = 'train'").select("cell_id")
    scaled = E.standardize(cells.select("cell_id", "features"), cells.join(train, "cell_id", "left_semi"))
    return scaled.select("cell_id", F.posexplode("features").alias("dim", "z")).withColumn("z", F.round("z", 6))


@workload("value_counts", "SELECT truth, pred, COUNT(*) AS n FROM predictions GROUP BY 1, 2")
def value_counts(spark, sf):
    return E.value_counts(I.predictions(spark, sf), "truth", "pred")


@workload(
    "crosstab_norm",
    "SELECT truth, fold, n, ROUND(n / SUM(n) OVER (PARTITION BY fold), 6) AS share FROM (SELECT truth, fold, COUNT(*) AS n FROM predictions GROUP BY 1, 2)",
)
def crosstab_norm(spark, sf):
    return E.crosstab_share(I.predictions(spark, sf), "truth", "fold").withColumn("share", F.round("share", 6))


@workload(
    "confusion",
    f"""WITH {LABEL_LIST}, n AS (SELECT truth, pred, COUNT(*) AS n FROM predictions GROUP BY 1, 2), t AS (SELECT truth, COUNT(*) AS total FROM predictions GROUP BY 1)
        SELECT a.label AS truth, b.label AS pred, COALESCE(n, 0) AS n, ROUND(COALESCE(n / total, 0), 6) AS share
        FROM labels_ a CROSS JOIN labels_ b LEFT JOIN n ON n.truth = a.label AND n.pred = b.label LEFT JOIN t ON t.truth = a.label""",
)
def confusion(spark, sf):
    return E.confusion(I.predictions(spark, sf), LABELS).withColumn("share", F.round("share", 6))


SCORES = f"""{LABEL_LIST}, per_class AS (
    SELECT fold, label, COUNT(*) FILTER (truth = label) AS support, COUNT(*) FILTER (truth = label AND pred = label) AS hit, COUNT(*) FILTER (pred = label) AS npred
    FROM predictions CROSS JOIN labels_ GROUP BY 1, 2),
    scores AS (SELECT fold, label, support, CASE WHEN npred > 0 THEN hit / npred ELSE 0 END AS precision, CASE WHEN support > 0 THEN hit / support ELSE 0 END AS recall,
                      CASE WHEN support + npred > 0 THEN 2 * hit / (support + npred) ELSE 0 END AS f1 FROM per_class),
    metrics AS (SELECT fold, AVG(f1) AS macro_f1, AVG(recall) FILTER (support > 0) AS balanced_accuracy FROM scores GROUP BY 1)"""


@workload(
    "per_class_sorted",
    f"WITH {SCORES} SELECT fold, label, support, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1 FROM scores ORDER BY support DESC",
)
def per_class_sorted(spark, sf):
    scores = E.by_frequency(E.class_scores(I.predictions(spark, sf), LABELS, ["fold"]))
    return scores.select("fold", "label", "support", r6("precision"), r6("recall"), r6("f1"))


@workload("macro_metrics", f"WITH {SCORES} SELECT fold, ROUND(macro_f1, 6) AS macro_f1, ROUND(balanced_accuracy, 6) AS balanced_accuracy FROM metrics")
def macro_metrics(spark, sf):
    return E.macro_metrics(I.predictions(spark, sf), LABELS, ["fold"]).select("fold", r6("macro_f1"), r6("balanced_accuracy"))


@workload(
    "fold_summary",
    f"""WITH {SCORES} SELECT CAST(fold AS VARCHAR) AS fold, ROUND(macro_f1, 4) AS macro_f1, ROUND(balanced_accuracy, 4) AS balanced_accuracy FROM metrics
        UNION ALL SELECT 'Mean', ROUND(AVG(macro_f1), 4), ROUND(AVG(balanced_accuracy), 4) FROM metrics
        UNION ALL SELECT 'Std Dev', ROUND(STDDEV_POP(macro_f1), 4), ROUND(STDDEV_POP(balanced_accuracy), 4) FROM metrics""",
)
def fold_summary(spark, sf):
    return E.fold_summary(E.macro_metrics(I.predictions(spark, sf), LABELS, ["fold"]), E.METRICS)


@workload("error_rate", "SELECT fold, ROUND(AVG(CASE WHEN pred <> truth THEN 1.0::DOUBLE ELSE 0 END), 6) AS error_rate FROM predictions GROUP BY 1")
def error_rate(spark, sf):
    return E.error_rate(I.predictions(spark, sf), ["fold"]).withColumn("error_rate", F.round("error_rate", 6))


@workload(
    "encoder_delta",
    """WITH r AS (SELECT CASE WHEN l_returnflag = 'A' THEN 'mean_marker' ELSE 'other' END AS encoder, l_discount AS m1, l_tax AS m2 FROM lineitem)
       SELECT metric, ROUND(a, 6) AS mean_marker, ROUND(b, 6) AS other, ROUND(a - b, 6) AS delta FROM (
            SELECT 'discount' AS metric, AVG(m1) FILTER (encoder = 'mean_marker') AS a, AVG(m1) FILTER (encoder = 'other') AS b FROM r
            UNION ALL SELECT 'tax', AVG(m2) FILTER (encoder = 'mean_marker'), AVG(m2) FILTER (encoder = 'other') FROM r)""",
)
def encoder_delta(spark, sf):
    li = I.table(spark, sf, "lineitem")
    r = li.select(F.when(F.col("l_returnflag") == "A", "mean_marker").otherwise("other").alias("encoder"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))
    return E.encoder_delta(r, "mean_marker", "other", ["discount", "tax"]).select("metric", r6("mean_marker"), r6("other"), r6("delta"))


N_SCORED = 8
SCORED = f"""scored AS (SELECT truth, 'class_' || k AS label, ((p * (k + 3) + o) % 997) / 997 + CASE WHEN truth = 'class_' || k THEN 0.25::DOUBLE ELSE 0 END AS score
    FROM (SELECT l_partkey AS p, l_orderkey AS o, 'class_' || CASE WHEN l_discount < 0.04::DOUBLE THEN 0 ELSE l_linenumber END AS truth FROM lineitem), range({N_SCORED}) t(k))"""


def _scored(spark, sf):
    li = I.table(spark, sf, "lineitem")
    truth = F.concat(F.lit("class_"), F.when(F.col("l_discount") < 0.04, 0).otherwise(F.col("l_linenumber")).cast("string"))
    probs = [
        ((F.col("l_partkey") * (k + 3) + F.col("l_orderkey")) % 997) / 997 + F.when(F.col("truth") == f"class_{k}", X.d(0.25)).otherwise(X.d(0))
        for k in range(N_SCORED)
    ]
    rows = li.withColumn("truth", truth).select("truth", F.array(*probs).alias("probs"))
    return E.class_score_rows(rows, LABELS[:N_SCORED])


@workload(
    "roc_auc_ovr",
    f"""WITH {SCORED}, r AS (SELECT label, truth = label AS hit, rank() OVER (PARTITION BY label ORDER BY score) + (COUNT(*) OVER (PARTITION BY label, score) - 1) / 2 AS mid FROM scored)
        SELECT label, ROUND((SUM(mid) FILTER (hit) - COUNT(*) FILTER (hit) * (COUNT(*) FILTER (hit) + 1) / 2) / (COUNT(*) FILTER (hit) * COUNT(*) FILTER (NOT hit)), 6) AS auc
        FROM r GROUP BY 1""",
)
def roc_auc_ovr(spark, sf):
    return E.roc_auc(_scored(spark, sf)).withColumn("auc", F.round("auc", 6))


@workload(
    "roc_auc_macro",
    f"""WITH {SCORED}, r AS (SELECT label, truth = label AS hit, rank() OVER (PARTITION BY label ORDER BY score) + (COUNT(*) OVER (PARTITION BY label, score) - 1) / 2 AS mid FROM scored),
        a AS (SELECT label, (SUM(mid) FILTER (hit) - COUNT(*) FILTER (hit) * (COUNT(*) FILTER (hit) + 1) / 2) / (COUNT(*) FILTER (hit) * COUNT(*) FILTER (NOT hit)) AS auc FROM r GROUP BY 1)
        SELECT ROUND(AVG(auc), 6) AS macro_auc FROM a""",
)
def roc_auc_macro(spark, sf):
    return E.macro(E.roc_auc(_scored(spark, sf)), "auc").select(r6("macro_auc"))


AP = f"""{SCORED}, pts AS (SELECT label, score, COUNT(*) FILTER (truth = label) AS pos, COUNT(*) AS n FROM scored GROUP BY 1, 2),
    cum AS (SELECT label, pos, SUM(pos) OVER w AS cp, SUM(n) OVER w AS cn FROM pts WINDOW w AS (PARTITION BY label ORDER BY score DESC)),
    ap AS (SELECT label, SUM(pos * cp / cn) / SUM(pos) AS ap FROM cum GROUP BY 1)"""


@workload("avg_precision", f"WITH {AP} SELECT label, ROUND(ap, 6) AS ap FROM ap")
def avg_precision(spark, sf):
    return E.average_precision(_scored(spark, sf)).withColumn("ap", F.round("ap", 6))


@workload("avg_precision_macro", f"WITH {AP} SELECT ROUND(AVG(ap), 6) AS macro_ap FROM ap")
def avg_precision_macro(spark, sf):
    return E.macro(E.average_precision(_scored(spark, sf)), "ap").select(r6("macro_ap"))


@workload(
    "widen_probs",
    f"SELECT cell_id, CAST(k AS INT) AS k, ROUND(CASE WHEN k % 2 = 0 THEN features[k // 2 + 1] ELSE 0 END, 6) AS p FROM cell_features, range({2 * DIMS}) t(k)",
)
def widen_probs(spark, sf):
    f = I.cell_features(spark, sf)
    few = f.select("cell_id", F.array(*[F.lit(f"class_{2 * k}") for k in range(DIMS)]).alias("classes"), F.col("features").alias("probs"))
    return E.widen_probs(few, [f"class_{k}" for k in range(2 * DIMS)]).select("cell_id", F.posexplode("probs").alias("k", "p")).withColumn("p", F.round("p", 6))


def _argmax(spark, sf):
    return E.argmax_label(I.cell_features(spark, sf).select("cell_id", F.col("features").alias("probs")), [f"class_{k}" for k in range(DIMS)])


@workload("argmax_pred", "SELECT cell_id, 'class_' || (list_position(features, list_max(features)) - 1) AS pred FROM cell_features")
def argmax_pred(spark, sf):
    return _argmax(spark, sf).select("cell_id", "pred")


@workload(
    "sink_predictions",
    """SELECT 0 AS slide_id, cell_id, 'probe' AS label_set, 'class_' || (list_position(features, list_max(features)) - 1) AS label FROM cell_features
       UNION ALL SELECT 0, cell_id, 'maps', label FROM cell_features""",
)
def sink_predictions(spark, sf):
    truth = I.cell_features(spark, sf).select(F.lit(0).alias("slide_id"), "cell_id", F.lit("maps").alias("label_set"), "label")
    preds = _argmax(spark, sf).select(F.lit(0).alias("slide_id"), "cell_id", F.col("pred").alias("label"))
    path = scratch_path(spark, "labels")
    for label_set, rows in (("maps", truth), ("probe", preds.withColumn("label", F.lit("old"))), ("probe", preds)):
        sinks.write_label_set(rows, path, label_set)
    return spark.read.parquet(path).select("slide_id", "cell_id", "label_set", "label")


@workload("linear_probe")
def linear_probe(spark, sf):
    """One probe at C = 1 on the training cells of fold 1, applied to its test cells."""
    cells = _quad(spark, sf)
    splits = E.split_folds(cells, "cell_id", folds=(1,)).select("cell_id", "split")
    part = cells.join(splits, "cell_id").select("cell_id", "label", "features", "split")
    scaled = E.standardize(part, part.filter("split = 'train'"))
    probe = phenotype.fit_probe(scaled.filter("split = 'train'"), LABELS, 1.0)
    return phenotype.predict(probe, scaled.filter("split = 'test'")).select("cell_id", "label", "pred")


@workload("tune_c")
def tune_c(spark, sf):
    cells = _quad(spark, sf).select("cell_id", "label", "features", "quadrant")
    return phenotype.cross_validate(cells, LABELS)[2]


@workload("cross_validate_metrics")
def cross_validate_metrics(spark, sf):
    """Macro F1, balanced accuracy, mean average precision and mean area of every fold."""
    cells = _quad(spark, sf).select("cell_id", "label", "features", "quadrant")
    return phenotype.cross_validate(cells, LABELS, n_trials=2)[1]


@workload("cross_validate")
def cross_validate(spark, sf):
    """Out-of-fold predictions over all four folds, with the full search."""
    cells = _quad(spark, sf).select("cell_id", "label", "features", "quadrant")
    return phenotype.cross_validate(cells, LABELS)[0].select("cell_id", "fold", "truth", "pred")
