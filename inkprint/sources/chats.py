"""Reading exported chats and alias files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkprint.session import path_exists


def _check(spark: SparkSession, path: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(path)


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    """Every file of a folder (not of its subfolders) as one row: chat_id (path), value."""
    _check(spark, path)
    found = (
        spark.read.text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("chat_id"),
                F.regexp_replace("value", "\r\n?", "\n").alias("value"))
    )
    if found.isEmpty():
        raise ValueError(f"no files in {path}")
    return found


def read_chat_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its place: chat_id, block (offset of the input split), slot (order in it)."""
    _check(spark, path)
    found = (
        spark.read.text(path, lineSep="\n")
        .select(F.col("_metadata.file_path").alias("chat_id"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("slot"),
                F.regexp_replace(F.regexp_replace("value", r"\r\z", ""), "\r", "\n").alias("value"))
    )
    if found.isEmpty():
        raise ValueError(f"no files in {path}")
    return found


def load_aliases(spark: SparkSession, path: str | None) -> DataFrame | None:
    """JSON ``{canonical: [alias, ...]}`` to alias, canonical; the last mention of an alias wins.

    No path, or one that cannot be read, means no aliases.
    """
    if path is None or not path_exists(spark, path):
        return None
    text = spark.read.text(path, wholetext=True)
    # pairs by position: a JSON map keeps its order, and entries are taken in that order
    entries = text.select(F.posexplode(F.map_entries(F.from_json("value", "map<string,array<string>>")))
                          .alias("_entry", "_pair"))
    names = entries.select("_entry", F.col("_pair.key").alias("canonical"),
                           F.posexplode("_pair.value").alias("_place", "alias"))
    return names.groupBy("alias").agg(
        F.max_by("canonical", F.struct("_entry", "_place")).alias("canonical"))
