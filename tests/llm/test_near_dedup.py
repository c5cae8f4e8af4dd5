import random

import numpy as np
import pyarrow as pa
from helpers import ODD, documents, roots, word_set

from histoframe.llm import near_dedup
from histoframe.llm.near_dedup import near_duplicates, without_copies
from histoframe.llm.shingles import shingle_sets


def plain(rows):
    sets = {i: word_set(t) for i, t in rows if i is not None}
    ids = sorted(sets)
    pairs = []
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                pairs.append((a, b))
    return {i: (len(sets[i]), r) for i, r in roots(pairs, ids).items()}


def copies(seed, groups, members, words=60, edits=3):
    r = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{r.randrange(4000)}" for _ in range(words)]
        for _ in range(members):
            own = list(base)
            for _ in range(r.randrange(edits + 1)):
                own[r.randrange(words)] = f"x{r.randrange(10**6)}"
            rows.append((len(rows) + 10, " ".join(own)))
    return rows


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_sets_match_tuples():
    texts = ["A b\tc d  e f", "a B c d e F", "a b", "a\x0bb", "a\x1cb", None, "", "É é " * 9]
    sets = shingle_sets(pa.array(texts))
    assert [len(s) for s in sets] == [len(word_set(t)) for t in texts]
    assert np.array_equal(sets[0], sets[1])


def test_components_match_all_pairs(spark):
    rows = copies(1, 12, 6) + copies(2, 3, 25, words=12, edits=1)
    rows = [(i + 10, t) for i, (_, t) in enumerate(rows)]
    assert got(near_duplicates(documents(spark, rows))) == plain(rows)


def test_long_lists_lose_no_link(spark):
    """Lists over the limit: a large group of near copies, and documents that are mostly one shared passage."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = copies(3, 1, 90, words=50, edits=4) + [(0, f"{passage} " + " ".join(f"u{i}_{j}" for j in range(i % 30))) for i in range(90)]
    rows = [(i + 10, t) for i, (_, t) in enumerate(rows)]
    assert got(near_duplicates(documents(spark, rows), long_list=8)) == plain(rows)


def test_odd_rows(spark):
    df = near_duplicates(documents(spark, ODD))
    assert df.count() == len(ODD) - 1
    found = got(df)
    assert found[1] == (0, 1) and found[2] == (0, 2) and found[3] == (0, 3) and found[4] == (1, 4) and found[6] == (1, 6)
    left = without_copies(documents(spark, [*ODD, (9, "one two three")]))
    assert left.columns == documents(spark, []).columns
    assert sorted((r.doc_id or -1) for r in left.collect()) == [-1, 1, 2, 3, 4, 5, 6]
    assert near_duplicates(documents(spark, [])).count() == 0


def test_constants():
    assert near_dedup.LONG_LIST >= 2 and near_dedup.SKETCH >= 32
