import zlib

import numpy as np
from helpers import ODD, SF, documents

from histoframe.llm.language import best_temperature, follow_the_leader, held_out, identify, ngram_counts, train, training_rows, with_known_language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = identify(docs, train(training_rows(docs))).withColumn("held", held_out()).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r.held]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_odd_rows_and_models(spark):
    model = train(training_rows(documents(spark, [(i, "plain words in a line") for i in range(9)])))
    assert model.languages == ["en"]
    out = {(r.doc_id, r.lang_pred, r.score) for r in identify(documents(spark, [*ODD, (8, "1 2 3 ---")]), model).collect()}
    assert {(i, "und", 0.0) for i in (1, 2, 3, 8)} | {(None, "en", 1.0), (4, "en", 1.0), (6, "en", 1.0)} <= out
    kept = with_known_language(documents(spark, ODD), model)
    assert kept.columns == documents(spark, []).columns and kept.count() == len(ODD) - 3
    none = train(training_rows(documents(spark, [])))
    assert none.languages == [] and identify(documents(spark, ODD[3:4]), none).first().lang_pred == "und"
    assert identify(documents(spark, []), none).count() == 0


def test_fit_separates_and_calibrates():
    rows = [(*map(np.array, ([i % 2, 2 + i % 3], [0.8, 0.6])), i % 2) for i in range(60)]
    w = follow_the_leader(rows, 2, 8)
    assert all(np.argmax(v @ w[f]) == y for f, v, y in rows)
    assert best_temperature(np.array([[4.0, 0.0]] * 3 + [[0.0, 4.0]]), np.array([0, 0, 0, 0])) > 1
    assert ngram_counts("ab")[1].sum() == 4 + 3 + 2
