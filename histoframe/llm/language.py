"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams (one to three characters of the
lower-cased text, runs of anything but letters taken as one space), weighted
by TF-IDF and scaled to length one. Document frequencies and language counts
come from every training document; the weights are fitted by
follow-the-regularised-leader with an elastic net on a bounded sample of
labelled rows, and a temperature fitted on sampled rows left out of that
calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histoframe.llm.batches import steps

#: Buckets of hashed n-grams.
BUCKETS = 1 << 16
#: Labelled rows a language gives to the fit, about (all, if it has fewer).
FIT_ROWS = 1200
#: Of those, one in so many calibrates the temperature instead.
CALIBRATION = 5
#: What a text without letters, or a model without languages, is called.
UNKNOWN = "und"

#: Step size, smoothing, L1 and L2 penalties and passes of the fit.
ALPHA, BETA, L1, L2, PASSES = 2.0, 1.0, 0.02, 0.001, 3

_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
_STEPS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def ngram_counts(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's character n-grams and how often each occurs."""
    plain = " " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " "
    code = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32)
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    with np.errstate(over="ignore"):
        one = (code + np.uint32(1)) * _STEPS[0]
        two = (one[:-1] ^ (code[1:] * _STEPS[1])) * _STEPS[2]
        three = (two[:-1] ^ (code[2:] * _STEPS[0])) * _STEPS[1]
        hashed = np.concatenate([(h ^ (h >> np.uint32(15))) * _STEPS[2] >> shift for h in (one, two, three)])
    if len(hashed) < buckets // 16:
        found, counts = np.unique(hashed, return_counts=True)
        return found.astype(np.int64), counts
    counts = np.bincount(hashed, minlength=buckets)
    found = np.flatnonzero(counts)
    return found, counts[found]


def tf_idf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, counts = ngram_counts(text, len(idf))
    values = (1 + np.log(counts)) * idf[found]
    norm = np.sqrt(values @ values)
    return found, values / norm if norm > 0 else values


@dataclass(frozen=True)
class LanguageModel:
    """Languages, inverse document frequencies, weights (bucket x language) and temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """Most probable language and its calibrated probability; ties go to the first by name."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        found, values = tf_idf(text, self.idf)
        p = _softmax(values @ self.weights[found] / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(bucket, df) over every text of ``docs``; each task adds up its own share first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in steps(batches, "text"):
            for text in batch.column(0).to_pylist():
                if has_letter(text):
                    total[ngram_counts(text)[0]] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], names=["bucket", "df"])

    return docs.select("text").mapInArrow(run, "bucket long, df long").groupBy("bucket").agg(F.sum("df").alias("df"))


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, buckets: int) -> np.ndarray:
    """Weights of a multinomial logistic regression, FTRL-proximal with L1 and L2."""
    z, n = np.zeros((buckets, classes)), np.zeros((buckets, classes))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        kept = np.abs(z[at]) > L1
        return np.where(kept, (np.sign(z[at]) * L1 - z[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    order = np.random.default_rng(7)
    for _ in range(PASSES):
        for i in order.permutation(len(rows)):
            found, values, label = rows[i]
            w = weights(found)
            error = _softmax(values @ w)
            error[label] -= 1
            g = values[:, None] * error
            g2 = n[found] + g * g
            z[found] += g - (np.sqrt(g2) - np.sqrt(n[found])) / ALPHA * w
            n[found] = g2
    return weights(slice(None))


def best_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least log loss, by golden-section search on its logarithm."""
    if len(labels) == 0:
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(scores / np.exp(t))
        return float(-np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean())

    low, high, ratio = -4.0, 2.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> LanguageModel:
    """Model from (doc_id, text, lang) rows; rows without a language are not used.

    Counts and document frequencies cover all rows. The fit gets a row when a
    hash of its id falls under the language's rate, so about ``fit_rows`` of
    each language and the same ones however the table is partitioned.
    """
    known = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    per_language = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(per_language)
    idf = np.zeros(BUCKETS)
    if not languages:
        return LanguageModel([], idf, np.zeros((BUCKETS, 0)), 1.0)
    total = sum(per_language.values())
    df = document_frequencies(known).toArrow()
    idf[df.column("bucket").to_numpy()] = np.log((1 + total) / (1 + df.column("df").to_numpy())) + 1

    rate: Column = F.lit(0.0)
    for name, n in per_language.items():
        rate = F.when(F.col("lang") == name, F.lit(min(1.0, fit_rows / n))).otherwise(rate)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    sample = known.withColumn("draw", draw).filter(F.col("draw") < rate * 1_000_003).select("draw", "text", "lang")
    code = {name: i for i, name in enumerate(languages)}

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], []
        for batch in batches:
            for draw, text, lang in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if has_letter(text):
                    (held if draw % CALIBRATION == 0 else rows).append((draw, text, code[lang]))
        rows, held = ([(*tf_idf(t, idf), y) for _, t, y in sorted(x)] for x in (rows, held))
        w = follow_the_leader(rows, len(languages), BUCKETS)
        scores = np.array([v @ w[f] for f, v, _ in held]).reshape(len(held), len(languages))
        heat = best_temperature(scores, np.array([y for *_, y in held], np.int64))
        at, lang = np.nonzero(w)
        at, lang, value = np.append(at, -1), np.append(lang, -1), np.append(w[at, lang], heat)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(lang, pa.int64()), pa.array(value, pa.float64())], names=["bucket", "language", "w"])

    fitted = sample.repartition(1).mapInArrow(fit, "bucket long, language long, w double").toArrow()
    at, lang, value = (fitted.column(c).to_numpy() for c in ("bucket", "language", "w"))
    weights = np.zeros((BUCKETS, len(languages)))
    weights[at[at >= 0], lang[at >= 0]] = value[at >= 0]
    return LanguageModel(languages, idf, weights, float(value[at < 0][0]) if (at < 0).any() else 1.0)


def identify(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text, from the text alone.

    A text that is null or has no letter is ``und`` with score 0. Repeated
    rows and null ids give a row each; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in steps(batches, "text"):
            found = [model.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: CRC-32 of the id as text leaves 1 when divided by 3 (never for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))


def with_known_language(docs: DataFrame, model: LanguageModel, *, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Rows of ``docs``, unchanged, whose text has a language with a probability of ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in steps(batches, text_col):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            found = [model.predict(t) for t in texts]
            yield batch.filter(pa.array([name != UNKNOWN and score >= least for name, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
