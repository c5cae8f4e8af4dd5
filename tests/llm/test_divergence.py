import random
import re
from collections import Counter, defaultdict

from helpers import ODD, documents

from histoframe.llm import divergence
from histoframe.llm.divergence import source_divergence, term_counts


def plain(rows):
    """The whole contract on Python integers."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups.add((lang, source))
        n[lang, source].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: [t for t, d in docs[lang].items() if d >= 30] for lang, _ in groups}
    p = {}
    for lang, source in groups:
        total = sum(n[lang, source][t] for t in kept[lang]) + 5 * len(kept[lang])
        p[lang, source] = {t: 1 + 10**9 * (n[lang, source][t] + 5) // total for t in kept[lang]}
    out = []
    for lang, source in groups:
        all_n = Counter()
        for other in [s for x, s in groups if x == lang]:
            all_n.update({t: n[lang, other][t] for t in kept[lang]})
        total = sum(all_n[t] for t in kept[lang]) + 5 * len(kept[lang])
        q = {t: 1 + 10**9 * (all_n[t] + 5) // total for t in kept[lang]}
        own = p[lang, source]
        pairs = [(-sum(abs(own[t] - p[lang, s][t]) for t in kept[lang]), s.encode()) for x, s in groups if x == lang and s != source]
        terms = [(q[t] - own[t], t.encode()) for t in kept[lang] if n[lang, source][t] and own[t] > q[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:50])):
            out += [(lang, source, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(items, 1)]
    return sorted(out)


def found(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


def rows_of(seed, words=90, n=600):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcDEé_ß𝄞", k=r.randrange(1, 4))) for _ in range(words)]
    rows = []
    for _ in range(n):
        lang, source = r.choice(["en", "de", None, ""]), r.choice(["s", "t", "u", None, "ü"])
        start = 0 if source == "s" else 30
        rows.append((lang, source, " ".join(r.choices(vocabulary[start:], k=r.randrange(0, 40)))))
    return [*rows, ("xx", "only", "rare words"), ("yy", "a", None), ("yy", "b", ""), ("en", "none", "1 2 3")]


def as_docs(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "lang string, source string, text string, term long").repartition(3)


def test_same_as_plain_integers(spark):
    for seed in (1, 2):
        rows = rows_of(seed)
        got = found(source_divergence(as_docs(spark, rows)))
        assert got == plain(rows)
    parts = {(g[2], g[0]) for g in got}
    assert ("pair", "yy") in parts and ("term", "en") in parts and not any(g[0] == "xx" for g in got)


def test_many_terms_of_one_value(spark):
    """More equal terms than ranks: the first in UTF-8 order are listed."""
    rows = [("en", "a", " ".join(f"{c}{d}" for c in "abcdefghij" for d in "klmnopqrst"))] * 30 + [("en", "b", "é z")] * 40
    got = found(source_divergence(as_docs(spark, rows)))
    assert got == plain(rows) and sum(g[:3] == ("en", "a", "term") for g in got) == 50


def test_counts_beyond_64_bits(spark):
    big = spark.createDataFrame([(10**14, 3 * 10**14, 7)], "n long, total long, v long")
    (p,) = big.select(divergence.probability(big.n, big.total, big.v)).first()
    assert p == 1 + 10**9 * (10**14 + 5) // (3 * 10**14 + 35)


def test_counts_are_passed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_HELD", 3)
    summed = Counter()
    for r in term_counts(as_docs(spark, [("en", "a", "x y z w X")] * 9).select("lang", "source", "text")).collect():
        summed[r.term] += r.n
    assert summed == {"x": 18, "y": 9, "z": 9, "w": 9}


def test_odd_rows(spark):
    rows = [("en", "s", t) for _, t in ODD]
    assert found(source_divergence(documents(spark, ODD * 31))) == plain(rows * 31)
    assert source_divergence(documents(spark, [])).count() == 0
