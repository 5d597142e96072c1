"""All named queries, gathered from the topic modules."""

from __future__ import annotations

import importlib

TOPICS = ["orders", "signin", "events", "outliers", "models", "texts", "streams"]


def _load() -> None:
    for topic in TOPICS:
        importlib.import_module(f"tarn.catalog.{topic}")


def queries():
    from tarn.catalog.registry import QUERIES

    _load()
    return dict(QUERIES)


def oracle_sql():
    from tarn.catalog.registry import SQL

    _load()
    return dict(SQL)
