"""Near-duplicate embeddings: int8 tile products with rigorous bounds, full precision only where they leave a doubt.

A unit vector u is stored as scale * q + r with q in int8. For two vectors the cosine differs from
scale_u * scale_v * (q_u . q_v) by at most |scale_u q_u| |r_v| + |r_u| |scale_v q_v| + |r_u| |r_v|; the lengths are
measured for each vector. A pair whose product plus this bound stays below the threshold is no link, all
others are computed in double precision. The int8 products run as float32 matrix products, which are
exact here (127 * 127 * 1024 < 2^24; longer vectors are summed in slices).

Scale: equal vectors of a label are one node with a count. The nodes of a label are dealt into blocks of about
``block`` rows; every pair of blocks is a tile, compared in one task. A tile returns one row for each of its linked
nodes (its links, and the smallest node it reaches inside the tile), never pairs, so that a large group
costs no more rows than it has members. Components are joined up by Spark. The comparisons of a label are
quadratic in its different vectors, as an exact answer without an index needs.

Defined cases: null labels, null or zero vectors and vectors with null or non-finite components link
with nothing and are their own component; vectors of different lengths never link; rows that share
an id are one vertex, whose links are summed; a null id links with nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkprint.llm.common import groups, query, table
from inkprint.llm.graph import components
from inkprint.session import materialize

BLOCK = 2048
_SLICE = 1024  # dimensions whose int8 products a float32 holds exactly
_STRIP = 256


class Quantised:
    """Unit vectors in double precision and as int8, with what bounds the error of the latter."""

    def __init__(self, vectors: np.ndarray):
        wide = vectors.astype(np.float64)
        wide = wide / np.abs(wide).max(1, keepdims=True)
        self.unit = wide / np.sqrt((wide * wide).sum(1, keepdims=True))
        self.scale = np.abs(self.unit).max(1) / 127
        self.q = np.rint(self.unit / self.scale[:, None]).astype(np.int8)
        back = self.q * self.scale[:, None]
        self.error = np.sqrt(((self.unit - back) ** 2).sum(1)) * (1 + 1e-9) + 1e-12
        self.length = np.sqrt((back * back).sum(1)) * (1 + 1e-9)
        self.f = self.q.astype(np.float32)

    def products(self, rows: slice, other: "Quantised") -> np.ndarray:
        if self.f.shape[1] <= _SLICE:
            return (self.f[rows] @ other.f.T).astype(np.float64)
        return sum((self.f[rows, k:k + _SLICE] @ other.f[:, k:k + _SLICE].T).astype(np.float64)
                   for k in range(0, self.f.shape[1], _SLICE))


def linked(a: Quantised, b: Quantised, threshold: float, same: bool):
    """Arrays (i, j) of the links between rows of a and rows of b, strip by strip; with ``same`` only i < j."""
    for start in range(0, len(a.q), _STRIP):
        rows = slice(start, min(start + _STRIP, len(a.q)))
        most = a.products(rows, b) * a.scale[rows, None] * b.scale[None, :]
        most += a.length[rows, None] * b.error[None, :] + a.error[rows, None] * (b.length + b.error)[None, :]
        i, j = np.nonzero(most >= threshold - 1e-9)
        i += start
        if same:
            i, j = i[i < j], j[i < j]
        keep = [np.einsum("ij,ij->i", a.unit[i[k:k + 65536]], b.unit[j[k:k + 65536]]) >= threshold
                for k in range(0, len(i), 65536)]
        if keep:
            keep = np.concatenate(keep)
            yield i[keep], j[keep]


def _union(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Merge the classes of x and y; a class is named by its smallest member."""
    while len(x):
        a, b = label[x], label[y]
        open_ = a != b
        if not open_.any():
            return
        x, y, a, b = x[open_], y[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _tiles(threshold: float):
    def run(batches):
        for key, tile in groups(batches, 4):
            i, j = key[2], key[3]
            order = np.argsort(tile.column(5).to_numpy(), kind="stable")
            node, block = tile.column(5).to_numpy()[order], tile.column(4).to_numpy()[order]
            weight = tile.column(6).to_numpy()[order]
            vectors = tile.column(7).combine_chunks().flatten().to_numpy().reshape(len(node), -1)[order]
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            label, links = np.arange(len(node)), np.zeros(len(node), dtype=np.int64)
            a = Quantised(vectors[left])
            b = a if i == j else Quantised(vectors[right])
            if not len(left) or not len(right):
                continue
            for x, y in linked(a, b, threshold, i == j):
                x, y = left[x], right[y]
                links += np.bincount(x, weights=weight[y], minlength=len(node)).astype(np.int64)
                links += np.bincount(y, weights=weight[x], minlength=len(node)).astype(np.int64)
                _union(label, x, y)
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[label[some]]), pa.array(links[some])],
                                             ["node", "root", "links"])
    return run


def similar_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = 0.93, block: int = BLOCK) -> DataFrame:
    """(key, n_links, component_id, kept) for every row."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("vector", lambda x: x != 0)
    good = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    nodes = materialize(good.groupBy("label", "vector").agg(F.min("id").alias("node"), F.count("*").alias("n"))
                        .withColumn("dim", F.size("vector")), "vectors")
    sizes = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    blocked = nodes.join(sizes, ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    tiles = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("label").alias("label_key"), "dim", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "node", "n", "vector", "label")
    keys = ["label_key", "dim", "i", "j"]
    found = materialize(tiles.repartition(*keys, "label").sortWithinPartitions(*keys, "label").drop("label")
                        .mapInArrow(_tiles(threshold), "node long, root long, links long"), "tiles")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classed = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_node = nodes.select("label", "vector", "node", "n").join(links, "node", "left") \
        .join(classed.withColumnRenamed("id", "node"), "node", "left") \
        .select("label", "vector", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("component", "node").alias("component"))
    joined = good.join(per_node, ["label", "vector"]).groupBy("id").agg(F.sum("n_links").alias("n_links"),
                                                                       F.min("component").alias("component"))
    out = rows.select("id").join(joined, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
good AS (SELECT vec_id, label, e FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
         AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
SELECT vec_id, (SELECT count(*) FROM link WHERE link.x = vec_id)::BIGINT AS n_links,
       (SELECT min(y) FROM reach WHERE reach.x = vec_id) AS component_id,
       vec_id = (SELECT min(y) FROM reach WHERE reach.x = vec_id) AS kept FROM embeddings"""


@query("op4_embedding_neardup", _SQL)
def op4(spark, d):
    return similar_vectors(table(spark, d, "embeddings"))
