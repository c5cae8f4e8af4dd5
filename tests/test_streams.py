"""Streams over several files: released state, late rows, blank patches."""

import datetime as dt
import os
from collections import Counter

from histoframe.streaming import extract as SE
from histoframe.streaming import status as SS

SCHEMA = "stage string, status string, ts timestamp"


def at(hour, minute=0):
    return dt.datetime(2024, 5, 1, hour, minute)


def arriving(spark, folder, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/b{i}")
        # One file per batch, in this order by its time.
        for f in (folder / f"b{i}").glob("*.parquet"):
            f.rename(folder / f"{i}.parquet")
            os.utime(folder / f"{i}.parquet", (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return SS.event_stream(spark, str(folder), spark.createDataFrame([], SCHEMA).schema, "[0-9].parquet", files_per_batch=1)


def counted(df):
    return {(r.hour.hour, r.stage, r.status): r.n for r in df.collect()}


def test_late_rows_are_counted_apart_and_nothing_is_lost(spark, tmp_path):
    batches = [
        [("tissue", "completed", at(1, 5)), ("tissue", "completed", at(1, 50)), ("cells", "running", at(2, 1))],
        [("tissue", "completed", at(6)), ("tissue", "completed", at(1, 10)), ("tissue", None, at(2))],
        [("tissue", "completed", at(1, 20)), ("tissue", "completed", at(6, 30)), ("cells", "running", at(5, 59)), ("cells", "running", at(2, 59))],
        [("tissue", "completed", at(3)), ("tissue", "completed", at(9)), ("tissue", "completed", at(6, 40))],
    ]
    counts, late = SS.hourly_with_late(arriving(spark, tmp_path, batches), "1 HOUR")
    # The clock stood at 2:01 in the second batch (mark 1:01), at 6:00 in the third (5:00) and at 6:30 in the last (5:30).
    assert {(r.hour.hour, r.stage, r.n, r.batch) for r in late.collect()} == {(1, "tissue", 1, 2), (2, "cells", 1, 2), (3, "tissue", 1, 3)}
    assert counted(counts) == {(1, "tissue", "completed"): 3, (2, "cells", "running"): 1, (2, "tissue", None): 1, (5, "cells", "running"): 1, (6, "tissue", "completed"): 3, (9, "tissue", "completed"): 1}
    together = Counter(counted(counts))
    for r in late.collect():
        together[r.hour.hour, r.stage, r.status] += r.n
    assert together == Counter((ts.hour, stage, status) for rows in batches for stage, status, ts in rows)


def test_blank_patches_and_channels_are_extracted(spark, tmp_path):
    for i in (1, 2):
        spark.createDataFrame([(i,)], "slide_id int").coalesce(1).write.parquet(str(tmp_path / f"a/{i}"))
    pixels = spark.createDataFrame([(1, 0, 0, 0, 255), (2, 0, 3, 3, 51)], "slide_id int, c int, y int, x int, v int")
    slides = spark.createDataFrame([(1, 4, 4, "uint8"), (2, 4, 4, "uint8")], "slide_id int, height int, width int, dtype string")
    panel = spark.createDataFrame([(s, c) for s in (1, 2) for c in (0, 1)], "slide_id int, idx int")
    arrivals = spark.readStream.schema("slide_id int").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "a"))
    out = SE.extract_once(arrivals, lambda new: pixels.join(new, "slide_id", "left_semi"), slides, panel, 2, 2)
    rows = {(r.slide_id, r.patch_id, r.c): round(r.value, 4) for r in out.collect()}
    assert len(rows) == 2 * 4 * 2 and {k: v for k, v in rows.items() if v} == {(1, 0, 0): 1.0, (2, 3, 0): 0.2}


def test_files_follow_batches_and_the_last_one_of_a_slide_counts(spark, tmp_path):
    """Slides used to have a folder each."""
    slides = spark.createDataFrame([(i, 2, 2, "uint8") for i in range(6)], "slide_id int, height int, width int, dtype string")
    panel = spark.createDataFrame([(i, 0) for i in range(6)], "slide_id int, idx int")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for batch, (ids, v) in enumerate((([0, 1, 2, 3, 4, 5], 51), ([5], 255))):
        spark.createDataFrame([(i,) for i in ids], "slide_id int").coalesce(1).write.parquet(str(tmp_path / f"a/{batch}"))
        pixels = spark.createDataFrame([(i, 0, 0, 0, v) for i in range(6)], "slide_id int, c int, y int, x int, v int")
        arrivals = spark.readStream.schema("slide_id int").option("recursiveFileLookup", "true").parquet(str(tmp_path / "a"))
        SE.incremental_extract(arrivals, lambda new, p=pixels: p.join(new, "slide_id", "left_semi"), slides, panel, 2, 2, out, checkpoint)
    rows = {r.slide_id: round(r.value, 4) for r in SE.read_extracted(spark, out).collect()}
    assert rows == {**{i: 0.2 for i in range(5)}, 5: 1.0}
    assert {f for f in os.listdir(out)} == {"batch=0", "batch=1"}
