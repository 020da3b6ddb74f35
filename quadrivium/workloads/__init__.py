"""Jobs bound to the driver tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quadrivium.workloads import catalog, drift, evaluation, feedback, files, retrieval, sessions, synthesis, texts

MODULES = [texts, catalog, feedback, retrieval, sessions, drift, synthesis, evaluation, files]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for module in MODULES:
        out.update(module.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for module in MODULES:
        out.update(module.SQL)
    return out
