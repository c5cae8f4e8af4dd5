import random
import re

from helpers import ODD, SF, documents

from histoframe.llm.decontaminate import contained_items, without_benchmark


def grams(text, width=5):
    w = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def plain(docs, items):
    out = set()
    for d, t in docs:
        own = grams(t)
        for i, x in items:
            q = grams(x)
            if d is not None and q and 100 * len(q & own) >= 75 * len(q):
                out.add((d, i, len(q), len(q & own)))
    return out


def found(df):
    return {(r.doc_id, r.item_id, r.n_item, r.n_common) for r in df.collect()}


def test_table_matches_all_pairs(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(contained_items(docs, items)) == expected


def test_items_of_every_size(spark):
    r = random.Random(9)
    word = lambda: f"w{r.randrange(10**6)}"
    items = [(n, " ".join(word() for _ in range(n + 4))) for n in (1, 2, 3, 4, 5, 8, 9, 17, 33, 60, 120, 300)]
    docs = []
    for n, text in items:
        for k in range(4):
            w = text.split()
            if k > 1 and n > 30:
                w[n // 2] = word()
            docs.append((len(docs), " ".join([*(word() for _ in range(r.randrange(900))), *w, *(word() for _ in range(r.randrange(900)))])))
    docs += [(1000 + i, " ".join(word() for _ in range(500))) for i in range(10)]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert found(contained_items(documents(spark, docs), table)) == plain(docs, items)


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one TWO three!"), (None, "no id at all here now"), (3, "one two three")], "item_id long, text string")
    assert found(contained_items(documents(spark, ODD), items)) == {(4, 3, 1, 1)}
    left = without_benchmark(documents(spark, ODD), items)
    assert left.columns == documents(spark, []).columns and left.count() == len(ODD) - 2
    assert contained_items(documents(spark, []), items).count() == 0
    assert contained_items(documents(spark, ODD), items.limit(0)).count() == 0
