"""The shared search over penalties and folds against single fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from histoframe.plans import phenotype as P
from histoframe.plans import softmax as S

LABELS = ["a", "b", "c", "d"]


def rows(seed, n, fold, labels):
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        label = labels[int(r.integers(0, len(labels)))]
        centre = np.eye(5)[LABELS.index(label)] * 1.5
        out.append((fold, label, (centre + r.normal(size=5)).tolist()))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    schema = "fold int, label string, features array<double>"
    train = spark.createDataFrame(rows(1, 90, 1, LABELS) + rows(2, 70, 2, ["a", "b", "d"]), schema)
    valid = spark.createDataFrame(rows(3, 60, 1, LABELS) + rows(4, 60, 2, LABELS), schema)
    return train, valid


def loss(probe, part):
    """Weighted mean loss plus penalty of a probe on (label, features) rows."""
    w = probe.model.weights if isinstance(probe.model, S.SoftmaxModel) else None
    if w is None:
        w = np.vstack([probe.model.coefficientMatrix.toArray().T, probe.model.interceptVector.toArray()])
        seen = np.arange(w.shape[1])
    else:
        seen = np.flatnonzero(probe.model.seen)
        w = w[:, seen]
    names = [probe.labels[i] for i in seen] if len(seen) < len(probe.labels) else list(probe.labels)
    x = np.hstack([np.array([f for _, f in part]), np.ones((len(part), 1))])
    code = np.array([names.index(label) for label, _ in part])
    count = np.bincount(code, minlength=len(names))
    weight = len(part) / (len(names) * count[code])
    logs = S._log_softmax(x @ w)
    return -(weight * logs[np.arange(len(part)), code]).mean() + (w[:-1] ** 2).sum() / (2 * probe.c * len(part))


def test_as_good_as_single_fits_in_far_fewer_jobs(spark, tables, monkeypatch):
    train, valid = tables
    passes = []
    shared = S._pass
    monkeypatch.setattr(S, "_pass", lambda data, points, *rest: passes.append(len(points)) or shared(data, points, *rest))
    probes, tried = P.tune_probes(train, valid, LABELS, [1, 2], n_trials=4)
    report = {(r.fold, round(r.c, 6)): r for r in tried.collect()}
    assert len(report) == 8 and all(r.state == "converged" and r.slope <= 1e-4 for r in report.values())
    # A pass serves all trials that still go on, so passes follow the slowest one.
    assert passes[0] == 8 and len(passes) <= max(r.steps for r in report.values()) + 12
    part = [(r.label, r.features) for r in train.filter("fold = 1").collect()]
    single = {c: P.fit_probe(train.filter("fold = 1").drop("fold"), LABELS, c) for c in (P.log_grid(n=4)[1], probes[1].c)}
    own, _ = P.tune_probes(train.filter("fold = 1"), valid.filter("fold = 1"), LABELS, [1], n_trials=4)
    assert own[1].c == probes[1].c
    assert abs(loss(probes[1], part) - loss(single[probes[1].c], part)) < 1e-4
    # The chosen C scores as its single fit does.
    test = valid.filter("fold = 1").drop("fold")
    ours = {tuple(r.features): (r.pred, r.probs) for r in P.predict(probes[1], test).collect()}
    theirs = {tuple(r.features): (r.pred, r.probs) for r in P.predict(single[probes[1].c], test).collect()}
    assert np.mean([ours[k][0] == theirs[k][0] for k in ours]) > 0.95
    assert max(np.abs(np.array(ours[k][1]) - np.array(theirs[k][1])).max() for k in ours) < 0.02


def test_labels_without_training_rows_read_zero(spark, tables):
    train, valid = tables
    probes, _ = P.tune_probes(train, valid, LABELS, [2], n_trials=2)
    out = P.predict(probes[2], valid.filter("fold = 2").drop("fold")).collect()
    assert all(r.probs[2] == 0.0 and abs(sum(r.probs) - 1) < 1e-9 and r.pred != "c" for r in out)
    with pytest.raises(ValueError, match="no training rows"):
        P.tune_probes(train, valid, LABELS, [2, 7], n_trials=2)


def test_a_stopped_search_says_so(spark, tables):
    train, valid = tables
    _, tried = P.tune_probes(train, valid, LABELS, [1], n_trials=2, max_iter=1)
    assert {r.state for r in tried.collect()} <= {"stopped", "converged"} and tried.filter(F.col("state") == "stopped").count() >= 1
