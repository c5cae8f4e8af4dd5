import hashlib
import math
import random

import numpy as np
import pytest
from helpers import SF

from histoframe.llm.codes import Orchard, vector_codes
from histoframe.llm.workloads import REGISTERED

FIELDS = "vec_id long, embedding array<double>, label int, vector string"


def plain(rows, parts=4, entries=256, rounds=4):
    """The contract on Python integers: every distance to every entry."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(1024 * x) for x in r[1]] for r in kept]
    span = len(whole[0]) // parts
    cut = [[v[k * span : (k + 1) * span] for k in range(parts)] for v in whole]
    books = [[v[k] for v in cut[:entries]] for k in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v[k], e)), i) for i, e in enumerate(books[k])) for k in range(parts)] for v in cut]

    for _ in range(rounds):
        found = assign()
        for k in range(parts):
            for i in range(len(books[k])):
                mine = [v[k] for v, f in zip(cut, found) if f[k][1] == i]
                if mine:
                    books[k][i] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return sorted(((r[0] is None, r[0] or 0), "".join(f"{i:02x}" for _, i in f), e, by_label[r[2]], digest) for r, f, e in zip(kept, found, errors))


def found(df):
    return sorted(((r.vec_id is None, r.vec_id or 0), r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def test_search_is_exact_with_ties():
    r = np.random.default_rng(3)
    for scale in (2, 5, 400):
        entries, vectors = r.integers(-scale, scale, (60, 5)), r.integers(-scale, scale, (500, 5))
        entries[7] = entries[3]
        distance = ((vectors[:, None] - entries[None]) ** 2).sum(axis=2)
        index, least = Orchard(entries).search(vectors)
        assert (index == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()


def test_search_passes_entries_over():
    """Entries far apart: a search meets its own neighbourhood only."""
    r = np.random.default_rng(4)
    entries = r.integers(0, 1000, (200, 2)) * 1000
    orchard = Orchard(entries)
    orchard.search(entries[r.integers(0, 200, 400)] + r.integers(-9, 9, (400, 2)))
    assert orchard.visits < 400 * 120


def test_same_as_plain_integers(spark):
    r = random.Random(13)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(8)], r.choice([None, 1, 2]), "x") for i in range(700)]
    rows += [(5000, rows[3][1], 1, "x"), (3, rows[3][1], 1, "x"), (None, rows[9][1], 2, "x"), (None, [9.0] * 8, None, "x")]
    odd = [(9001, None, 1, "x"), (9002, [None] * 8, 1, "x"), (9003, [float("nan")] + [0.0] * 7, 1, "x"), (9004, [float("-inf")] + [0.0] * 7, 1, "x")]
    df = spark.createDataFrame(rows + odd, FIELDS).repartition(5)
    assert found(vector_codes(df)) == plain(rows)


def test_few_rows_and_empty_tables(spark):
    rows = [(2, [0.5, -0.25, 0.0, 1.0], None, "x"), (1, [0.5, 0.25, 0.0, -1.0], None, "x"), (1, [0.5, 0.25, 0.0, -1.0], 7, "x")]
    assert found(vector_codes(spark.createDataFrame(rows, FIELDS))) == plain(rows)
    assert vector_codes(spark.createDataFrame([], FIELDS)).count() == 0
    assert vector_codes(spark.createDataFrame([(1, None, 1, "x")], FIELDS)).count() == 0


def test_other_lengths_are_left_out_and_huge_components_refused(spark):
    rows = [(1, [0.5] * 4, 1, "x"), (2, [0.5] * 8, 1, "x"), (3, [], 1, "x")]
    assert [r.vec_id for r in vector_codes(spark.createDataFrame(rows, FIELDS)).collect()] == [1]
    with pytest.raises(ValueError):
        vector_codes(spark.createDataFrame([(1, [0.5] * 6, 1, "x")], FIELDS))
    with pytest.raises(Exception, match="beyond"):
        vector_codes(spark.createDataFrame([(1, [1e200] * 4, 1, "x")], FIELDS)).collect()


def test_whole_table_against_plain_distances(spark):
    from histoframe.llm.workloads import table

    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, SF, "embeddings").collect()]
    assert found(REGISTERED["op13_orchard_codes"].build(spark, SF)) == plain(rows[:]) and len(rows) > 100
