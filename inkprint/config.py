"""Switches, names and policies that steer the jobs."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from inkprint.constants import FEATURE_SWITCHES, PLACEHOLDER, POS_TAGS
from inkprint.session import path_exists


@dataclass(frozen=True)
class FeatureConfig:
    """Which features are computed and which reach training."""

    switches: dict[str, bool] = field(default_factory=lambda: dict(FEATURE_SWITCHES))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureConfig:
        if not path or not path_exists(spark, path):
            raise ValueError(f"invalid configuration file: {path}")
        text = spark.read.text(path, wholetext=True).first()[0]
        return cls({name: bool(on) for name, on in json.loads(text).items()})

    @classmethod
    def only(cls, *names: str) -> FeatureConfig:
        return cls({name: name in names for name in FEATURE_SWITCHES})

    @classmethod
    def all_features(cls) -> FeatureConfig:
        return cls({name: True for name in FEATURE_SWITCHES})

    def enabled(self) -> list[str]:
        return [name for name, on in self.switches.items() if on]

    def is_on(self, name: str) -> bool:
        return self.switches.get(name, False)

    def disabled_columns(self) -> list[str]:
        """Columns training must not see, with the tag shares spelt out."""
        off = [name for name, on in self.switches.items() if not on]
        if "message_composition" in off:
            off.remove("message_composition")
            off.extend(POS_TAGS)
        return off


def with_affixes(name: str, prefix: str = "", suffix: str = "") -> str:
    """Add prefix and suffix, each at most once."""
    if not name.startswith(prefix):
        name = prefix + name
    return name if name.endswith(suffix) else name + suffix


def dataset_name(name: str | None) -> str:
    return with_affixes(name, suffix=".parquet") if name else f"dataset_{int(time.time())}.parquet"


def model_name(kind: str, name: str | None) -> str:
    """``model_``/``embed_``/``meta_`` prefix, with the current second as default name."""
    prefix = f"{kind}_"
    return with_affixes(name, prefix) if name else f"{prefix}{int(time.time())}"


def require(value, name: str):
    if value is None:
        raise ValueError(f"{name} cannot be None")
    return value


def config_or_default(spark: SparkSession, folder: str, name: str | None, default: str = "config.json") -> str:
    """The named configuration where its file exists, else the default one."""
    if name:
        candidate = with_affixes(name, suffix=".json")
        if path_exists(spark, f"{folder.rstrip('/')}/{candidate}"):
            return candidate
    return default


def placeholder_policy(has_aliases: bool, action: str = "keep", new_name: str | None = None,
                       compat: bool = False) -> tuple[str, bool]:
    """(placeholder name, remove its messages) for ``keep``, ``delete`` or ``rename``.

    Renaming keeps the messages; with ``compat`` it removes them as well.
    """
    if action not in ("keep", "delete", "rename"):
        raise ValueError(f"unknown placeholder action: {action}")
    if not has_aliases or action == "keep":
        return PLACEHOLDER, False
    if action == "delete":
        return PLACEHOLDER, True
    return require(new_name, "new_name"), compat
