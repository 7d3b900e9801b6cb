"""Exact k-nearest-neighbour join in bounded blocks.

Base rows are dealt to the cells of a few pivots. Distances to the pivots bound, for each
query, how far its k-th neighbour can be, and by the triangle inequality which cells may
hold a nearer row; only those are visited. In few dimensions that spares most comparisons. In many, such as
64, the bounds rule out next to nothing: the join then compares every query with every base row, which is what
an exact answer costs. A cell is cut into blocks of bounded size on
both sides. A block pair is compared in one task and yields k rows per query, never the
pairs, and a last top-k merges the blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkprint.operators.sampling import hash_key
from inkprint.session import materialize

PIVOTS = 32
BLOCK_ROWS = 4_000
PAIRS_AT_ONCE = 200_000
_SLACK = 1e-6  # bounds are widened by this share so that rounding never drops a neighbour


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 0))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    return np.sqrt(np.maximum(squares, 0.0))


def _nearest(queries: np.ndarray, query_ids: np.ndarray, base: np.ndarray, base_ids: np.ndarray, k: int):
    """Per query the k base rows with smallest (squared distance, id), distances exact.

    Queries go in slices: where most of a block are copies of one vector all of them tie
    for the k-th place, and a slice bounds the memory those ties take.
    """
    step = max(1, PAIRS_AT_ONCE // max(1, len(base)))
    parts = [_nearest_slice(queries[i:i + step], query_ids[i:i + step], base, base_ids, k)
             for i in range(0, len(queries), step)]
    return tuple(np.concatenate(column) for column in zip(*parts))


def _nearest_slice(queries: np.ndarray, query_ids: np.ndarray, base: np.ndarray, base_ids: np.ndarray, k: int):
    squares = (queries * queries).sum(1)[:, None] + (base * base).sum(1)[None, :] - 2.0 * queries @ base.T
    k = min(k, len(base))
    kth = np.partition(squares, k - 1, axis=1)[:, k - 1]
    scale = (queries * queries).sum(1) + (base * base).sum(1).max()
    near_query, near_base = np.nonzero(squares <= (kth + 1e-9 * scale + 1e-12)[:, None])
    gaps = queries[near_query] - base[near_base]
    exact = (gaps * gaps).sum(1)
    order = np.lexsort((base_ids[near_base], np.round(exact, 12), near_query))
    near_query, near_base, exact = near_query[order], near_base[order], exact[order]
    starts = np.searchsorted(near_query, np.arange(len(queries)))
    place = np.arange(len(near_query)) - starts[near_query]
    keep = place < k
    return query_ids[near_query[keep]], base_ids[near_base[keep]], exact[keep]


def knn_join(queries: DataFrame, base: DataFrame, k: int = 5, key: str = "id", vector: str = "vector",
             pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS, exclude_self: bool = False) -> DataFrame:
    """query_id, rank (1..k), neighbor_id, distance2; ties go to the smaller id."""
    take = k + 1 if exclude_self else k
    base = base.select(F.col(key).alias("id"), F.col(vector).alias("v"))
    queries = queries.select(F.col(key).alias("id"), F.col(vector).alias("v"))
    chosen = base.orderBy(hash_key("id"), "id").limit(pivots).collect()  # a fixed number of rows
    if not chosen:
        raise ValueError("the base table is empty")
    centers = _matrix([row["v"] for row in chosen])

    def to_cells(batches):
        for batch in batches:
            if len(batch):
                far = _distances(_matrix(batch["v"]), centers)
                batch["cell"] = far.argmin(1).astype("int32")
                batch["far"] = far.min(1)
                yield batch

    celled = materialize(base.mapInPandas(to_cells, "id long, v array<double>, cell int, far double"), "cells")
    # per pivot: how many rows, how wide, and the distances of its `take` nearest rows
    in_cell = Window.partitionBy("cell", "_part").orderBy("far")
    nearest = (
        celled.select("cell", "far").withColumn("_part", F.spark_partition_id())
        .withColumn("_p", F.row_number().over(in_cell)).filter(F.col("_p") <= take)
        .groupBy("cell").agg(F.slice(F.sort_array(F.collect_list("far")), 1, take).alias("inner"))
    )
    sizes = celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius"))
    cells = sizes.join(nearest, "cell").collect()  # at most `pivots` rows of `take` numbers
    radius = np.full(len(centers), -np.inf)
    rows = np.zeros(len(centers), dtype=np.int64)
    inner: list[np.ndarray] = [np.zeros(0)] * len(centers)
    for c in cells:
        radius[c["cell"]], rows[c["cell"]] = c["radius"], c["n"]
        inner[c["cell"]] = np.asarray(c["inner"])
    blocks = np.maximum(1, -(-rows // block_rows))
    between = _distances(centers, centers)
    members = np.concatenate([np.full(len(d), i) for i, d in enumerate(inner)]).astype(int)
    reach = np.concatenate(inner)

    def to_visits(batches):
        for batch in batches:
            if not len(batch):
                continue
            far = _distances(_matrix(batch["v"]), centers)
            # k-th smallest upper bound on the distance to any `take` base rows
            upper = far[:, members] + reach[None, :]
            bound = np.sort(upper, axis=1)[:, min(take, upper.shape[1]) - 1] if upper.shape[1] >= take \
                else np.full(len(batch), np.inf)
            bound = bound * (1 + _SLACK) + _SLACK
            home = far.argmin(1)
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (far ** 2 - far[np.arange(len(far)), home][:, None] ** 2) / (2 * between[home])
            plane = np.where(np.isfinite(plane), plane, 0.0)
            low = np.maximum(far - radius[None, :], plane)
            visit = (low <= bound[:, None]) & (rows[None, :] > 0)
            batch["cells"] = [np.nonzero(v)[0].astype("int32") for v in visit]
            yield batch

    visits = (
        queries.mapInPandas(to_visits, "id long, v array<double>, cells array<int>")
        .select("id", "v", F.explode("cells").alias("cell"))
    )
    n_blocks = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("cell") + 1)
    base_blocks = celled.select("id", "v", "cell").withColumn(
        "block", F.pmod(F.xxhash64("id"), n_blocks).cast("int"))
    query_rows = visits.withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    # queries of a busy cell are dealt to lanes, and each lane gets its copy of the block
    busy = materialize(visits.groupBy("cell").agg(F.count("*").alias("q")), "visits")
    lanes = busy.select("cell", F.greatest(F.ceil(F.col("q") / F.lit(block_rows)), F.lit(1)).cast("int").alias("lanes"))
    lane_of = {r["cell"]: r["lanes"] for r in lanes.collect()}  # at most `pivots` rows
    n_lanes = F.element_at(F.array(*[F.lit(int(lane_of.get(i, 1))) for i in range(len(centers))]), F.col("cell") + 1)
    query_rows = query_rows.withColumn("lane", F.pmod(F.xxhash64("id"), n_lanes).cast("int"))
    base_rows = base_blocks.withColumn("lane", F.explode(F.sequence(F.lit(0), n_lanes - 1)))

    def compare(query_part: pd.DataFrame, base_part: pd.DataFrame) -> pd.DataFrame:
        if not len(query_part) or not len(base_part):
            return pd.DataFrame({"query_id": [], "neighbor_id": [], "distance2": []}).astype(
                {"query_id": "int64", "neighbor_id": "int64", "distance2": "float64"})
        found = _nearest(_matrix(query_part["v"]), query_part["id"].to_numpy(),
                         _matrix(base_part["v"]), base_part["id"].to_numpy(), take)
        return pd.DataFrame(dict(zip(("query_id", "neighbor_id", "distance2"), found)))

    place = ["cell", "block", "lane"]
    found = query_rows.groupBy(*place).cogroup(base_rows.groupBy(*place)).applyInPandas(
        compare, "query_id long, neighbor_id long, distance2 double")
    if exclude_self:
        found = found.filter("query_id != neighbor_id")
    best = Window.partitionBy("query_id").orderBy(F.round("distance2", 12), "neighbor_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("long").alias("rank"), "neighbor_id", "distance2")
    )


def knn_votes(neighbors: DataFrame, labels: DataFrame, k: int = 5, key: str = "id", label: str = "label") -> DataFrame:
    """query_id, label, probability = share of the k votes."""
    named = labels.select(F.col(key).alias("neighbor_id"), F.col(label).alias("label"))
    return (
        neighbors.join(named, "neighbor_id")
        .groupBy("query_id", "label").agg((F.count("*") / F.lit(float(k))).alias("probability"))
    )


def knn_predict(votes: DataFrame) -> DataFrame:
    """query_id, prediction: most votes, the smallest label on ties."""
    return votes.groupBy("query_id").agg(
        F.max_by("label", F.struct("probability", -F.col("label"))).alias("prediction"))


def top_k(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """First k rows per key, with their ``rank``.

    A first pass keeps k rows per key and partition, so that a hot key reaches its final
    task as a few rows only.
    """
    local = Window.partitionBy(*keys, "_part").orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(64)))
        .withColumn("_p", F.row_number().over(local)).filter(F.col("_p") <= k)
        .withColumn("rank", F.row_number().over(final).cast("long")).filter(F.col("rank") <= k)
        .drop("_part", "_p")
    )
