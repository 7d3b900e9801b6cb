"""Raw exports to the feature table and the embedding table."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from inkprint.config import FeatureConfig, dataset_name
from inkprint.constants import PLACEHOLDER
from inkprint.operators.clean import Clean, clean_messages
from inkprint.operators.embed import check_strategy, embed_hashed
from inkprint.operators.features import build_features
from inkprint.operators.parse import extract_folder
from inkprint.session import materialize, path_exists
from inkprint.sources.chats import load_aliases
from inkprint.sources.datasets import dataset_path, read_dataset, write_dataset, write_users


class Dataset(NamedTuple):
    features: DataFrame | None
    embeddings: DataFrame | None


def prepare(spark: SparkSession, chats: str, aliases: str | None = None, placeholder: str | None = PLACEHOLDER,
            remove_placeholder: bool = False, patterns: Iterable[str] | None = None, scope: str = "corpus") -> Clean:
    """Exports of a folder to the clean, balanced table. Without aliases no placeholder is removed."""
    names = load_aliases(spark, aliases)
    if names is None:
        placeholder, remove_placeholder = PLACEHOLDER, False
    msgs = materialize(extract_folder(spark, chats, names, placeholder or PLACEHOLDER), "messages")
    return clean_messages(msgs, patterns, placeholder or PLACEHOLDER, remove_placeholder, scope)


def build_dataset(spark: SparkSession, folder: str, name: str | None = None, chats: str | None = None,
                  messages: DataFrame | None = None, config: FeatureConfig | None = None,
                  aliases: str | None = None, placeholder: str = PLACEHOLDER, remove_placeholder: bool = False,
                  refactor: bool = False, features: bool = True, embeddings: bool = True,
                  strategy: str = "mixed", embedder=None, **feature_inputs) -> Dataset:
    """Read each wanted table if it exists and ``refactor`` is off, else build and write it.

    The clean table is made once, from ``chats`` (a folder) or ``messages`` (a clean table),
    and shared by both products.
    """
    if not features and not embeddings:
        raise ValueError("features and embeddings cannot both be off")
    if not isinstance(refactor, bool):
        raise TypeError("refactor must be a bool")
    check_strategy(strategy)
    name = dataset_name(name)
    wanted = {"features": features, "embeddings": embeddings}
    paths = {kind: dataset_path(folder, name, kind) for kind in wanted}
    missing = [kind for kind, on in wanted.items() if on and (refactor or not path_exists(spark, paths[kind]))]
    if missing:
        if messages is None:
            clean = prepare(spark, chats, aliases, placeholder, remove_placeholder)
            write_users(clean.users, folder, f"users_{name}".removesuffix(".parquet"))
            messages = clean.messages
        base = materialize(messages, "clean")
        if "features" in missing:
            write_dataset(build_features(base, config, **feature_inputs), folder, name, "features")
        if "embeddings" in missing:
            table = embedder(base) if embedder else embed_hashed(base, strategy)
            write_dataset(table, folder, name, "embeddings")
    return Dataset(*[read_dataset(spark, paths[kind]) if on else None for kind, on in wanted.items()])
