"""Small tables and plain versions that the tests compare with."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"

#: Rows that every operator over documents has to bear.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one two three"), (4, "one two three"), (None, "no id at all here now"), (5, "é" * 40 + " \u0001 x\u0002b \U0001f600"), (6, "word " * 60_000),
]


def documents(spark, rows):
    """Documents with a further column that clashes with names the operators use."""
    return spark.createDataFrame([(i, t, "en", "s", 0, "v", "a") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, vals string, rep string")


def word_set(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
