"""Compare registered queries with their SQL checks on one scale factor.

    python tools/check.py [--sf DIR] [--module markers] [name ...]
"""

from __future__ import annotations

import argparse
import importlib
import os
import sys
import time
import traceback

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from histoframe import workloads as W  # noqa: E402
from histoframe.session import get_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def kind(series: pd.Series) -> str:
    k = series.dtype.kind
    return {"u": "i", "M": "t"}.get(k, k)


def normal(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)

    def cell(v):  # noqa: ANN001, ANN202
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return "null"
        if isinstance(v, float):
            return repr(v + 0.0)
        return repr(v.item()) if hasattr(v, "item") and getattr(v, "shape", ()) == () else repr(v)

    return sorted(tuple(cell(v) for v in row) for row in df[cols].itertuples(index=False, name=None))


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    kinds = [(c, kind(got[c]), kind(want[c])) for c in got.columns if kind(got[c]) != kind(want[c])]
    a, b = normal(got), normal(want)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"values differ in {len(bad)} rows, columns {sorted(got.columns)}: {bad[:3]} kinds {kinds}"
    return f"ok but kinds differ: {kinds}" if kinds else "ok"


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--module")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    if args.module:
        for m in args.module.split(","):  # noqa: E501
            importlib.import_module(f"histoframe.workloads.{m}")
        todo = {n: w for n, w in W._REGISTERED.items() if w.build.__module__.split(".")[-1] in args.module.split(",")}
    else:
        todo = W.registered()
    if args.names:
        todo = {n: todo[n] for n in args.names}
    spark = get_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.log.level": "ERROR"}
    )
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    failed = 0
    for name, w in todo.items():
        t0 = time.time()
        try:
            got = w.build(spark, args.sf).toPandas()
            t1 = time.time()
            if w.sql:
                verdict = compare(got, con.execute(W.with_views(w.sql)).df())
                if not len(got):
                    verdict += " EMPTY"
            else:
                verdict = f"rows only: {len(got)}"
            if verdict != "ok" and not verdict.startswith("rows only"):
                failed += 1
            print(f"{name:24s} {t1 - t0:6.2f}s {time.time() - t1:6.2f}s {len(got):8d}  {verdict}", flush=True)
        except Exception as exc:  # noqa: BLE001
            failed += 1
            text = str(exc).split("JVM stacktrace")[0]
            tb = traceback.extract_tb(exc.__traceback__)
            where = [f"{os.path.basename(f.filename)}:{f.lineno}" for f in tb if "histoframe" in f.filename]
            print(f"{name:24s} FAILED {type(exc).__name__} {where} {text[:1200]}", flush=True)
    print(f"{len(todo)} queries, {failed} not ok")
    spark.stop()


if __name__ == "__main__":
    main()
