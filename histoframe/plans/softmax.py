"""Multinomial logistic regression for many penalties and folds at once.

All trials share every pass over the data: a pass multiplies a block of rows
with the weights of all trials of its fold side by side and adds up their
losses and gradients, so a search over penalties and folds costs as many jobs
as its slowest trial has steps, not the sum over the trials. Gradients are summed inside tasks, in
chunks across tasks, and only the sums reach the driver, which keeps a short
history for each trial (L-BFGS with backtracking).
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Steps remembered by a trial, numbers in a chunk of a gradient, halvings of a step.
HISTORY, CHUNK, HALVINGS = 10, 4096, 40


@dataclass(frozen=True)
class SoftmaxModel:
    """``weights`` (components + 1, labels), the intercept last; ``seen`` says which labels training had."""

    weights: np.ndarray
    seen: tuple[bool, ...]


@dataclass
class _Trial:
    """One penalty's search: point, value, slope and the steps so far."""

    fold: int
    penalty: float
    x: np.ndarray
    f: float = np.inf
    g: np.ndarray | None = None
    p: np.ndarray | None = None
    step: float = 1.0
    halved: int = 0
    steps: int = 0
    state: str = "going"
    past: deque = field(default_factory=lambda: deque(maxlen=HISTORY))

    def candidate(self) -> np.ndarray:
        return self.x if self.p is None else self.x + self.step * self.p

    def take(self, f: float, g: np.ndarray, tol: float, max_steps: int) -> None:
        """Value and slope at the candidate: move there, or try half the way."""
        if self.p is not None and not f <= self.f + 1e-4 * self.step * float((self.g * self.p).sum()):
            self.step, self.halved = self.step / 2, self.halved + 1
            if self.halved > HALVINGS:
                self.state = "stuck" if np.abs(self.g).max() > 10 * tol else "converged"
            return
        if self.p is not None:
            s, y = self.step * self.p, g - self.g
            if float((s * y).sum()) > 1e-14:
                self.past.append((s, y))
            self.steps += 1
        self.x, self.f, self.g, self.step, self.halved = self.candidate(), f, g, 1.0, 0
        if np.abs(g).max() <= tol:
            self.state = "converged"
        elif self.steps >= max_steps:
            self.state = "stopped"
        else:
            self.p = self._direction()

    def _direction(self) -> np.ndarray:
        q, used = self.g.copy(), []
        for s, y in reversed(self.past):
            a = float((s * q).sum()) / float((s * y).sum())
            used.append(a)
            q -= a * y
        if self.past:
            s, y = self.past[-1]
            q *= float((s * y).sum()) / float((y * y).sum())
        else:
            q /= max(1.0, float(np.abs(q).max()))
        for (s, y), a in zip(self.past, reversed(used), strict=True):
            q += s * (a - float((y * q).sum()) / float((s * y).sum()))
        return -q


def _rows(column) -> np.ndarray:  # noqa: ANN001 - Arrow list array
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    x = flat.reshape(len(column), -1)
    return np.hstack([x, np.ones((len(x), 1))])


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=-1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=-1, keepdims=True))


def _pass(data: DataFrame, points: list[np.ndarray], folds: list[int], seen: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Summed weighted losses (trials) and gradients (trials, components + 1, labels) at the trials' points."""
    at, of = np.stack(points), np.array(folds)
    n, width, labels = at.shape

    def add_up(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, slope = np.zeros(n), np.zeros(at.shape)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                rows, code, weight, fold = _rows(part.column(0)), *(part.column(i).to_numpy() for i in (1, 2, 3))
                for f in np.unique(fold):
                    mine, own = fold == f, np.flatnonzero(of == f)
                    if not len(own):
                        continue
                    x, c, w, each = rows[mine], code[mine], weight[mine], np.arange(mine.sum())
                    z = (x @ at[own].transpose(1, 0, 2).reshape(width, -1)).reshape(len(x), len(own), labels)
                    z[:, :, ~seen[int(f)]] = -np.inf
                    logs = _log_softmax(z)
                    total[own] -= w @ logs[each, :, c]
                    off = np.exp(logs)
                    off[each, :, c] -= 1
                    slope[own] += (x.T @ (off * w[:, None, None]).reshape(len(x), -1)).reshape(width, len(own), labels).transpose(1, 0, 2)
        flat = np.concatenate([total, slope.reshape(-1)])
        chunks = [flat[i : i + CHUNK] for i in range(0, len(flat), CHUNK)]
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(range(len(chunks)), pa.int32()), "sums": pa.array(chunks, pa.list_(pa.float64()))})

    def merge(table):  # noqa: ANN001, ANN202 - Arrow table of one chunk
        import pyarrow as pa

        sums = np.sum(np.stack(table["sums"].combine_chunks().to_numpy(zero_copy_only=False)), axis=0)
        return pa.table({"chunk": table["chunk"].slice(0, 1), "sums": pa.array([sums], pa.list_(pa.float64()))})

    schema = "chunk int, sums array<double>"
    merged = data.select("features", "code", "weight", "fold").mapInArrow(add_up, schema).groupBy("chunk").applyInArrow(merge, schema).collect()
    flat = np.concatenate([np.array(r.sums) for r in sorted(merged, key=lambda r: r.chunk)]) if merged else np.zeros(n + at.size)
    return flat[:n], flat[n:].reshape(at.shape)


def fit_path(
    data: DataFrame, n_labels: int, width: int, trials: Sequence[tuple[int, float]], tol: float = 1e-4, max_steps: int = 1000
) -> tuple[list[SoftmaxModel], list[dict]]:
    """A model for every trial (fold, C), and how each search ended.

    ``data`` has features, code (0-based), weight and fold; it is read once a
    step, so it should be a written table. Minimised is the weighted mean loss
    of the fold's rows plus the squared weights over twice C times their
    number, intercepts left out. A search ends ``converged`` when no slope is
    above ``tol``, else ``stopped`` or ``stuck``; the report says which, after
    how many steps, with what slope.
    """
    known = data.groupBy("fold", "code").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect()
    seen, rows, weight = {}, {}, {}
    for r in known:
        seen.setdefault(r.fold, np.zeros(n_labels, bool))[r.code] = True
        rows[r.fold], weight[r.fold] = rows.get(r.fold, 0) + r.n, weight.get(r.fold, 0.0) + r.w
    if missing := sorted({fold for fold, _ in trials} - set(seen)):
        raise ValueError(f"no training rows in folds {missing}")
    searches = [_Trial(fold, 1.0 / (c * rows[fold]), np.zeros((width + 1, n_labels))) for fold, c in trials]
    shrunk = np.ones((width + 1, 1))
    shrunk[-1] = 0
    while going := [t for t in searches if t.state == "going"]:
        points = [t.candidate() for t in going]
        losses, slopes = _pass(data, points, [t.fold for t in going], seen)
        for t, x, loss, slope in zip(going, points, losses, slopes, strict=True):
            kept = x * shrunk
            t.take(loss / weight[t.fold] + t.penalty / 2 * float((kept * kept).sum()), slope / weight[t.fold] + t.penalty * kept, tol, max_steps)
    report = [{"loss": float(t.f), "steps": t.steps, "slope": float(np.abs(t.g).max()), "state": t.state} for t in searches]
    return [SoftmaxModel(t.x, tuple(seen[t.fold].tolist())) for t in searches], report


def class_probabilities(df: DataFrame, models: dict[int, Sequence[SoftmaxModel]], to: Callable[[np.ndarray], np.ndarray], kind: str) -> DataFrame:
    """``df`` with ``scores``: for each row what ``to`` makes of (rows, models of its fold, labels) probabilities, 0 for labels not seen in training."""

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = _rows(batch.column(batch.schema.get_field_index("features")))
            fold = batch.column(batch.schema.get_field_index("fold")).to_numpy()
            out = [None] * len(x)
            for f in np.unique(fold):
                mine = np.flatnonzero(fold == f)
                z = np.stack([x[mine] @ m.weights + np.where(m.seen, 0.0, -np.inf) for m in models[int(f)]], axis=1)
                for i, scores in zip(mine, to(np.exp(_log_softmax(z)))):
                    out[i] = scores
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "scores"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(score, f"{schema}, scores array<{kind}>")
