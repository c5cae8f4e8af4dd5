import hashlib

import corpus_pipeline
import public_tokenizers
from helpers import SF, documents
from test_decontaminate import grams
from test_near_dedup import plain as near
from tokenizers import Tokenizer

from histoframe.session import materialize


def test_stages_match_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        outs.append(docs)
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "minhash_near_dedup"
    assert {r.doc_id for r in outs[0].collect()} == {i for i, t in rows.items() if t and any(c.isalpha() for c in t)}
    known = {i: rows[i] for i in (r.doc_id for r in outs[0].collect())}
    kept = {i: t for i, t in known.items() if near(list(known.items()))[i][1] == i} if len(known) < 60 else None
    classes = near(list(known.items())) if kept is None else None
    kept = kept if kept is not None else {i: t for i, t in known.items() if classes[i][1] == i}
    assert {r.doc_id for r in outs[1].collect()} == set(kept)
    items = [grams(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i, t in kept.items() if not any(q and 100 * len(q & grams(t)) >= 75 * len(q) for q in items)}
    assert {r.doc_id for r in outs[2].collect()} == clean
    assert all(o.columns == ["doc_id", "text", "lang", "source", "n_chars"] for o in outs[:4])
    private = {r.doc_id: r.text for r in outs[3].collect()}
    assert private.keys() == clean and all(r.n_chars == len(r.text) for r in outs[3].collect())
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in outs[4].collect():
        ids = lib.encode(private[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_odd_documents_pass(spark, tmp_path):
    from helpers import ODD

    documents(spark, [*ODD, (70, "hello there my good friends of old")]).drop("vals", "rep").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "x y z")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} >= {70, 4, None}


def test_no_documents(spark, tmp_path):
    documents(spark, []).drop("vals", "rep").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
