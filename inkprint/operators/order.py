"""Global order without a single-task window.

Two devices. Where rows carry an integer position, windows run per (key, block of
positions) and a small block table carries values across blocks. Where they do not,
rows are range-partitioned and sorted once, written out, and per-partition totals are
added as offsets. In both, a key that holds most of the rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkprint.session import BROADCAST_BYTES, materialize, store

BLOCK = 1 << 16
_PART_BITS = 33  # monotonically_increasing_id keeps the partition number above these bits


def sorted_parts(df: DataFrame, order: Sequence[str | Column], name: str = "order") -> DataFrame:
    """Range-partition, sort and write ``df``; adds ``_part`` (partition) and ``_row`` (row in it)."""
    stamped = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    table = materialize(stamped, name)
    return (
        table.withColumn("_part", F.shiftright("_slot", _PART_BITS).cast("int"))
        .withColumn("_row", F.col("_slot").bitwiseAND(F.lit((1 << _PART_BITS) - 1)))
        .drop("_slot")
    )


def dense_index(df: DataFrame, order: Sequence[str | Column], out: str) -> DataFrame:
    """Add ``out`` = 0..n-1 in the given (total) order."""
    parts = sorted_parts(df, order, "dense")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the sort, so this window is bounded by the partition count
    offsets = (
        parts.groupBy("_part").agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        parts.join(F.broadcast(offsets), "_part")
        .withColumn(out, (F.col("_before") + F.col("_row")).cast("long"))
        .drop("_part", "_row", "_before")
    )


def dimension_index(df: DataFrame, order: str, out: str) -> tuple[DataFrame, int]:
    """``dense_index`` of a dimension, and its size in bytes.

    The dimension is written first. If it is small enough to be broadcast, one window over
    it is as bounded as that; otherwise it is sorted in parts.
    """
    table, size = store(df, "dimension")
    if size > BROADCAST_BYTES:
        return dense_index(table, [order], out), size
    return table.withColumn(out, (F.row_number().over(Window.orderBy(order)) - 1).cast("long")), size


def dimension_lag(df: DataFrame, order: str, value: str, out: str) -> tuple[DataFrame, int]:
    """``sorted_lag`` of a dimension, and its size in bytes; one window where it is small."""
    table, size = store(df, "dimension")
    if size > BROADCAST_BYTES:
        return sorted_lag(table, [order], value, out), size
    return table.withColumn(out, F.lag(value).over(Window.orderBy(order))), size


def sorted_lag(df: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add ``out`` = ``value`` of the previous row of the whole table, null for the first."""
    parts = sorted_parts(df, order, "lag")
    local = Window.partitionBy("_part").orderBy("_row")
    ends = parts.groupBy("_part").agg(F.max_by(value, "_row").alias("_end"))
    edges = ends.select("_part", F.lag("_end").over(Window.orderBy("_part")).alias("_carry"))
    return (
        parts.withColumn("_prev", F.lag(value).over(local))
        .join(F.broadcast(edges), "_part")
        .withColumn(out, F.when(F.col("_row") == 0, F.col("_carry")).otherwise(F.col("_prev")))
        .drop("_part", "_row", "_prev", "_carry")
    )


def sorted_running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                        sums: dict[str, str]) -> DataFrame:
    """Add running sums (``{new column: summed column}``) per key in the given order."""
    keys = list(keys)
    parts = sorted_parts(df, [*keys, *order], "sums")
    local = Window.partitionBy("_part", *keys).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_part", *keys).agg(*[F.sum(c).alias(f"_t_{new}") for new, c in sums.items()])
    offsets = totals.select(
        "_part", *keys,
        *[F.coalesce(F.sum(f"_t_{new}").over(earlier), F.lit(0)).alias(f"_o_{new}") for new in sums],
    )
    out = parts.select("*", *[F.sum(c).over(local).alias(f"_l_{new}") for new, c in sums.items()])
    out = out.join(offsets, ["_part", *keys])
    for new in sums:
        out = out.withColumn(new, F.col(f"_l_{new}") + F.col(f"_o_{new}"))
    return out.drop("_part", "_row", *[f"_l_{new}" for new in sums], *[f"_o_{new}" for new in sums])


def _block(pos: str, block: int) -> Column:
    return F.floor(F.col(pos) / F.lit(block)).cast("long")


def blocked_lag(df: DataFrame, keys: Sequence[str], pos: str, value: str, out: str,
                block: int = BLOCK) -> DataFrame:
    """Add ``out`` = ``value`` of the previous position of the same key."""
    keys = list(keys)
    cut = df.withColumn("_block", _block(pos, block))
    local = Window.partitionBy(*keys, "_block").orderBy(pos)
    carried = (
        cut.groupBy(*keys, "_block").agg(F.max_by(value, pos).alias("_end"))
        .select(*keys, "_block",
                F.lag("_end").over(Window.partitionBy(*keys).orderBy("_block")).alias("_carry"))
    )
    return (
        cut.withColumn("_prev", F.lag(value).over(local)).withColumn("_place", F.row_number().over(local))
        .join(carried, [*keys, "_block"])
        .withColumn(out, F.when(F.col("_place") == 1, F.col("_carry")).otherwise(F.col("_prev")))
        .drop("_block", "_prev", "_place", "_carry")
    )


def blocked_running_sums(df: DataFrame, keys: Sequence[str], pos: str, sums: dict[str, str],
                         block: int = BLOCK) -> DataFrame:
    """Add running sums per key in the order of an integer position."""
    keys = list(keys)
    cut = df.withColumn("_block", _block(pos, block))
    local = Window.partitionBy(*keys, "_block").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "_block").agg(*[F.sum(c).alias(f"_t_{new}") for new, c in sums.items()])
        .select(*keys, "_block",
                *[F.coalesce(F.sum(f"_t_{new}").over(earlier), F.lit(0)).alias(f"_o_{new}") for new in sums])
    )
    out = cut.select("*", *[F.sum(c).over(local).alias(f"_l_{new}") for new, c in sums.items()])
    out = out.join(offsets, [*keys, "_block"])
    for new in sums:
        out = out.withColumn(new, F.col(f"_l_{new}") + F.col(f"_o_{new}"))
    return out.drop("_block", *[f"_l_{new}" for new in sums], *[f"_o_{new}" for new in sums])
