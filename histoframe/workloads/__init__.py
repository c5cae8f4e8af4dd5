"""Registered queries: each operator over the given tables, with its SQL check."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Workload:
    name: str
    build: Build
    sql: str | None


_REGISTERED: dict[str, Workload] = {}


def workload(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under its operator's name."""

    def add(build: Build) -> Build:
        if name in _REGISTERED:
            raise ValueError(f"query {name!r} registered twice")
        _REGISTERED[name] = Workload(name, build, sql)
        return build

    return add


def registered() -> dict[str, Workload]:
    from histoframe.workloads import (  # noqa: F401
        cells,
        evaluation,
        features,
        graph,
        ingest,
        markers,
        patches,
        pixels,
        raster,
        status,
        streams,
    )

    return dict(_REGISTERED)


def with_views(sql: str) -> str:
    """Prefix a check with the input views it uses, as common table expressions."""
    from histoframe.workloads.inputs import VIEW_SQL

    body = sql.strip()
    recursive = bool(re.match(r"(?i)with\s+recursive\b", body))
    needed: list[str] = []

    def visit(text: str) -> None:
        for view, view_sql in VIEW_SQL.items():
            if view not in needed and re.search(rf"(?i)\b(from|join)\s+{view}\b", text):
                visit(view_sql)
                if view not in needed:
                    needed.append(view)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v].strip()})" for v in needed)
    rest = re.sub(r"(?i)^with(\s+recursive)?\s+", "", body) if re.match(r"(?i)with\b", body) else None
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ctes + (",\n" + rest if rest is not None else "\n" + body)
