"""All registered queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alerts, catalog, metrics, requests, stored, streams, topics

ALL = {
    **requests.QUERIES,
    **catalog.QUERIES,
    **stored.QUERIES,
    **topics.QUERIES,
    **metrics.QUERIES,
    **alerts.QUERIES,
    **streams.QUERIES,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for name, (run, _) in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ALL.items() if sql}
