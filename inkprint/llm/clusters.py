"""Classes of similar shingle sets from banded signatures: candidates, exact checks, components."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkprint.llm.common import groups
from inkprint.llm.graph import components
from inkprint.llm.shingles import similar_pairs
from inkprint.session import materialize

TILE = 1024


_PLACE = ["key", "i", "j", "block", "node", "label", "band", "low", "high"]


def tune(threshold: float, recall: float, chance: float = 0.3, most: float = 0.35, limit: int = 128) -> tuple[int, int]:
    """The fewest bands, and their rows, that find a pair at the threshold with probability ``recall``, and a pair
    of similarity ``chance`` with a probability of at most ``most``."""
    for bands in range(1, limit):
        for rows in range(16, 0, -1):
            if 1 - (1 - threshold ** rows) ** bands >= recall and 1 - (1 - chance ** rows) ** bands <= most:
                return bands, rows
    raise ValueError("no number of bands below the limit suffices")


def _possible(tile: pa.Table, i: int, j: int, least: int):
    """For each node of a tile the places of the nodes of another label that it has to be compared with here: at least
    ``least`` equal signature bytes, and this band the first that the two share. Labels may be merged meanwhile."""
    block, band = tile.column("block").to_numpy(), tile.column("band")[0].as_py()
    node, label = tile.column("node").to_numpy(), tile.column("label").to_numpy().copy()
    low, high = tile.column("low").to_numpy(), tile.column("high").to_numpy()
    small = np.frombuffer(b"".join(tile.column("signature").to_pylist()), np.uint8).reshape(len(node), -1)
    keys = tile.column("keys").combine_chunks().flatten().to_numpy().reshape(len(node), -1)[:, :band]
    for k in range(len(node)):
        if i != j and block[k] != i:
            continue
        other = np.flatnonzero((label != label[k]) & ((node > node[k]) if i == j else (block == j)))
        other = other[(low[other] != high[k]) | (high[other] != low[k])]
        if len(other):
            other = other[(small[other] == small[k]).sum(1) >= least]
        if len(other):
            other = other[~(keys[other] == keys[k]).any(1)]
        if len(other):
            yield k, other, label


def _doubtful(least: int):
    """The rows of the tiles that have something to be compared with."""
    def run(batches):
        for (_, i, j), tile in groups(batches, 3):
            seen = np.zeros(tile.num_rows, dtype=bool)
            for k, other, _ in _possible(tile, i, j, least):
                seen[k] = True
                seen[other] = True
            if seen.any():
                yield from tile.select(_PLACE) \
                    .filter(pa.array(seen)).combine_chunks().to_batches()
    return run


def _linked(least: int, threshold: float):
    """Links between labels of a tile, by the exact similarity; one link is enough to join two labels."""
    def run(batches):
        for (_, i, j), tile in groups(batches, 3):
            node = tile.column("node").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in tile.column("elements").to_pylist()]
            a, b = [], []
            for k, other, label in _possible(tile, i, j, least):
                for x in other:
                    if label[x] == label[k]:
                        continue
                    common = len(sets[k]) + len(sets[x]) - len(np.union1d(sets[k], sets[x]))
                    if common >= threshold * (len(sets[k]) + len(sets[x]) - common) - 1e-9:
                        a.append(node[k])
                        b.append(node[x])
                        label[label == label[x]] = label[k]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def cluster(nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], threshold: float, coordinates: int) -> DataFrame:
    """(id, component) of the linked nodes, for a table (node, n, keys, signature, low, high): the set's size, its band
    keys, one byte of each of its ``coordinates``, and the smallest and largest id of the documents that hold it. Two
    nodes that one and the same document alone holds are not compared. ``sets_of`` gets a table of
    wanted nodes (id) and returns their sets (node, elements).

    Of a key with n nodes, n - 1 pairs are checked first: those with its smallest node. Where it still holds
    several components, nodes of different ones are compared inside tasks, in tiles of about ``TILE`` nodes: first by
    their signature bytes, and those whose estimate is not clearly below the threshold by their sets. Only links that join
    components leave a tile, never candidates.
    """
    keyed = nodes.select("node", "n", "low", "high", F.posexplode("keys").alias("band", "key"))
    common = keyed.groupBy("key").agg(F.min(F.struct("node", "n", "low", "high")).alias("first"), F.count("*").alias("size"),
                                      F.min("low").alias("least"), F.max("high").alias("most")) \
        .where("size > 1 AND least < most").select("key", "first")
    hits = materialize(keyed.join(common, "key").select("key", "band", "node", "n", "low", "high", "first"), "hits")
    alike = F.least("n", "first.n") >= F.greatest("n", "first.n") * threshold - 1e-9
    apart = (F.col("low") != F.col("first.high")) | (F.col("high") != F.col("first.low"))
    pairs = hits.where((F.col("node") != F.col("first.node")) & alike & apart) \
        .select(F.col("first.node").alias("a"), F.col("node").alias("b")).distinct()
    sets = materialize(sets_of(hits.select(F.col("node").alias("id")).distinct()), "sets")
    links = materialize(similar_pairs(pairs, sets, threshold), "links")
    first = components(links)

    label = hits.select("key", "band", "node", "low", "high").join(first.withColumnRenamed("id", "node"), "node", "left") \
        .select("key", "band", "node", "low", "high", F.coalesce("component", "node").alias("label"))
    label = materialize(label, "labels")
    mixed = label.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("size")) \
        .where("x <> y").select("key", F.ceil(F.col("size") / TILE).cast("int").alias("blocks"))
    # a key's nodes in blocks; every pair of blocks is a tile, and a block goes to each of its tiles
    blocked = label.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiles = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").cast("int").alias("i"), F.greatest("block", "other").cast("int").alias("j"),
        "block", "node", "label", "band", "low", "high")
    sure = threshold - 4.5 * (threshold * (1 - threshold) / coordinates) ** 0.5  # a weaker estimate is no link
    least = int(np.floor(sure * coordinates))

    def by_tile(rows):
        return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    sketched = tiles.join(nodes.select("node", "signature", "keys"), "node").select(*_PLACE, "signature", "keys")
    doubtful = materialize(by_tile(sketched).mapInArrow(
        _doubtful(least), "key long, i int, j int, block int, node long, label long, band int, low long, high long"), "doubtful")
    whole = doubtful.join(nodes.select("node", "signature", "keys"), "node").join(sets, "node") \
        .select(*_PLACE, "signature", "keys", "elements")
    more = by_tile(whole).mapInArrow(_linked(least, threshold), "a long, b long")
    return components(links.union(more))
