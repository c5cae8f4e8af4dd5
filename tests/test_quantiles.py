"""Quantiles and thresholds of real-valued pixels against whole sorted columns."""

import math
import random

import numpy as np

from histoframe.operators import pixels as P
from histoframe.operators.quantiles import refined_quantiles

SHARES = (0.0, 0.01, 0.5, 0.99, 1.0)


def test_as_on_sorted_numbers(spark):
    r = random.Random(6)
    groups = {
        1: [r.gauss(0, 1e-3) for _ in range(800)],
        2: [r.choice([0.0, -0.0, 1.5, -1.5, 1e300, -1e300, 5e-324]) for _ in range(300)],
        3: [7.25],
        4: [float("-inf"), 1.0, 2.0],
        5: [math.ldexp(r.random() - 0.5, r.randrange(-300, 300)) for _ in range(500)],
    }
    rows = [(g, v, 1 + (i % 3 == 0)) for g, values in groups.items() for i, v in enumerate(values)]
    df = spark.createDataFrame([*rows, (1, None, 5), (1, 9e9, 0), (6, None, 1)], "g int, v double, n long").repartition(3)
    got = {row.g: row.quantiles for row in refined_quantiles(df, ["g"], "v", SHARES, "n").collect()}
    assert set(got) == set(groups)
    for g in groups:
        column = np.sort(np.repeat([v for k, v, _ in rows if k == g], [n for k, _, n in rows if k == g]))
        for share, q in zip(SHARES, got[g]):
            at = (len(column) - 1) * share
            low, high = column[math.floor(at)], column[math.ceil(at)]
            assert q == low + (high - low) * (at - math.floor(at)) or (math.isnan(q) and math.isinf(low))
    nan = spark.createDataFrame([(1, float("nan"), 1), (1, 2.0, 1)], "g int, v double, n long")
    (row,) = refined_quantiles(nan, ["g"], "v", (0.0, 1.0), "n").collect()
    assert row.quantiles[0] == 2.0 and math.isnan(row.quantiles[1])
    assert refined_quantiles(df.limit(0), ["g"], "v", SHARES, "n").count() == 0


def test_real_pixels_with_absent_ones(spark):
    r = random.Random(7)
    pixels = [(1, c, y, x, r.uniform(-2, 5)) for c in (0, 1) for y in range(9) for x in range(9) if r.random() < 0.7]
    df = spark.createDataFrame(pixels, "slide_id int, c int, y int, x int, v double")
    slides = spark.createDataFrame([(1, 9, 9)], "slide_id int, height int, width int")
    panel = spark.createDataFrame([(1, 0), (1, 1), (1, 2)], "slide_id int, c int")
    found = {row.c: (row.lo, row.hi) for row in P.channel_percentiles(df, slides, channels=panel).collect()}
    for c in (0, 1):
        dense = [v for _, k, _, _, v in pixels if k == c]
        dense += [0.0] * (81 - len(dense))
        assert np.allclose(found[c], np.quantile(dense, [0.01, 0.99]), rtol=0, atol=1e-12)
    assert found[2] == (0.0, 0.0)
    # The threshold of counted values and that of pixels agree.
    hist = P.channel_histogram(df, slides, channels=panel)
    of_values = {row.c: row.threshold for row in P.otsu_threshold(hist, ["slide_id", "c"]).collect()}
    assert {row.c: row.threshold for row in P.otsu_of_pixels(df, slides, channels=panel).collect()} == of_values and set(of_values) == {0, 1}
