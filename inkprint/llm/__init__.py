"""Operators of a training-data pipeline, each with its query over the driver tables."""

from __future__ import annotations

import importlib

_PARTS = ["alignment", "decontaminate", "embeddings", "language", "licenses", "linededup", "lm", "mixing", "neardup", "passages",
          "phrases", "toxicity", "warc"]


def _load():
    from inkprint.llm import common
    for part in _PARTS:
        importlib.import_module(f"inkprint.llm.{part}")
    return common


def queries() -> dict:
    return dict(_load().QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_load().SQL)
