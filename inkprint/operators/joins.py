"""Lookups and key joins. No side is broadcast unless its size has been checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkprint.session import BROADCAST_BYTES, store

SALTS = 32
_NARROW = ("tinyint", "smallint", "int", "bigint", "date", "timestamp", "double", "float", "boolean")


def lookup(big: DataFrame, small: DataFrame, key: str, how: str = "left", size: int = BROADCAST_BYTES,
           salts: int = SALTS, known_bytes: int | None = None) -> DataFrame:
    """Join a table whose keys may be skewed to a dimension with unique keys.

    The dimension is written once and its stored size checked. Within the bound it is
    broadcast; a larger one is copied ``salts`` times, so that a hot key of ``big`` is
    spread over that many tasks. ``known_bytes`` is the size of a table ``small`` was just
    derived from row by row, and spares the writing.
    """
    if known_bytes is None:
        small, known_bytes = store(small, "dim")
    if known_bytes <= size:
        return big.join(F.broadcast(small), key, how)
    # the salt is a function of the row, so a task that is run again deals its rows the same way
    narrow = [c for c, t in big.dtypes if t in _NARROW and c != key]
    spread = F.xxhash64(*[F.col(c) for c in narrow or [c for c, t in big.dtypes if not t.startswith("map")]])
    salted_big = big.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_big.join(salted_small, [key, "_salt"], how).drop("_salt")


def lookup_or(big: DataFrame, small: DataFrame, key: str, value: str, default: Column | str, out: str) -> DataFrame:
    """Left lookup of ``value`` with a default for keys the dimension does not hold."""
    default = F.lit(default) if isinstance(default, str) else default
    dim = small.select(F.col(key), F.col(value).alias("_found"))
    return lookup(big, dim, key).withColumn(out, F.coalesce("_found", default)).drop("_found")


def keep_ids(df: DataFrame, ids: DataFrame, key: str = "message_id") -> DataFrame:
    """Rows whose key is in ``ids``."""
    return df.join(ids.select(key), key, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, key: str = "message_id") -> DataFrame:
    """Rows whose key is not in ``ids``."""
    return df.join(ids.select(key), key, "left_anti")


def align(left: DataFrame, right: DataFrame, key: str = "message_id") -> DataFrame:
    """Put two row-aligned tables side by side; columns they share come from the left one."""
    shared = [c for c in right.columns if c in left.columns and c != key]
    return left.join(right.drop(*shared), key)


def decode_users(df: DataFrame, users: DataFrame) -> DataFrame:
    """Add the author name of each class index."""
    return lookup(df, users.select("user", "author"), "user")
