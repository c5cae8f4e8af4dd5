import numpy as np
from helpers import SF
from pyspark.sql import functions as F

from histoframe.llm.ann import footrule_ranks, inverted_file, nearest


def plain(rows, k=5):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in ok:
        if q % 50 == 0:
            s = sorted((-(ok[q] @ v) / np.linalg.norm(ok[q]) / np.linalg.norm(v), i) for i, v in ok.items() if i != q)
            out[q] = [i for _, i in s[:k]]
    return out


def test_ranks_follow_the_footrule_distance():
    r = np.random.default_rng(1)
    orders = np.array([r.permutation(12)[:6] for _ in range(40)])
    files = inverted_file(orders, 12)
    query = r.permutation(12)[:6]
    full = np.full(12, 6)
    full[query] = np.arange(6)
    distance = np.abs(files.T.astype(int) - full).sum(axis=1)
    ranks = footrule_ranks(query, files)
    assert np.array_equal(np.argsort(distance, kind="stable"), np.argsort(-ranks, kind="stable"))


def test_recall_on_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    truth = plain([(r.vec_id, r.embedding) for r in df.collect()])
    found = {}
    for r in nearest(df, F.col("vec_id") % 50 == 0, share=0.2, least=1).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert found.keys() == truth.keys()
    assert sum(len(found[q] & set(truth[q])) for q in truth) >= 0.9 * sum(map(len, truth.values()))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0]), (2, [2.0, 2.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, []), (None, [1.0, 2.0]), (50, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, b string")
    out = sorted((r.query_id, r.rank, r.vec_id) for r in nearest(df, F.col("vec_id") % 50 == 0).collect())
    assert out == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (50, 1, 1), (50, 2, 2), (50, 3, 0)]
    assert nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_queries_meet_blocks_as_rows_of_one_vector(spark, monkeypatch):
    """No row holds more than one vector, so batches do not grow with the table; whole blocks are met over any bundles."""
    import histoframe.llm.ann as ann

    r = np.random.default_rng(3)
    x = np.round(r.normal(size=(700, 6)), 1).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    truth = {q: [i for _, i in sorted((-round(float(np.dot(x[q].astype(float), v.astype(float)) / np.linalg.norm(x[q].astype(float)) / np.linalg.norm(v.astype(float))), 12), i) for i, v in enumerate(x) if i != q and v.any())[:5]] for q in range(0, 700, 50)}
    for block, bundles, queries in ((4096, 64, 512), (30, 4, 3), (30, 100, 512)):
        monkeypatch.setattr(ann, "BLOCK", block)
        monkeypatch.setattr(ann, "BUNDLES", bundles)
        monkeypatch.setattr(ann, "QUERY_BLOCK", queries)
        found = nearest(df, F.col("vec_id") % 50 == 0, share=1.0)
        got = {}
        for row in found.collect():
            got.setdefault(row.query_id, {})[row["rank"]] = row
        assert got.keys() == truth.keys() and all(sorted(g) == [1, 2, 3, 4, 5] for g in got.values())
        for q, g in got.items():
            want = [float(np.dot(x[q].astype(float), x[i].astype(float)) / np.linalg.norm(x[q].astype(float)) / np.linalg.norm(x[i].astype(float))) for i in truth[q]]
            assert np.allclose([g[n].score for n in range(1, 6)], want) and len({g[n].vec_id for n in g}) == 5
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "FlatMapGroupsInArrow" not in plan
