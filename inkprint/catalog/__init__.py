"""Every operator as a query over the driver tables, with its SQL where SQL can say it."""

from __future__ import annotations

import importlib

_PARTS = ["sources", "parsing", "cleaning", "joining", "aggregates", "sampling", "text", "embeddings", "meta",
          "evaluation", "models", "scoring", "flagship"]


def _load():
    from inkprint.catalog import base
    for part in _PARTS:
        importlib.import_module(f"inkprint.catalog.{part}")
    return base


def queries() -> dict:
    return dict(_load().QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_load().SQL)
