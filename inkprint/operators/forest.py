"""Forests as tables: trees grow in tasks and stay in the shared folder, so neither fitting nor predicting brings them to the driver.

* One block of rows: the trees are dealt over the tasks, each grown on the whole block.
* Several blocks: passes over all blocks grow the top of each tree, down to nodes that fit a block (``doors``). The rows behind a door then
  meet in one task, which grows the rest there. The driver holds the tops only.

A model is a table with a row for each part of a tree: part 0 is its top, or the whole tree, the others are what lies behind its doors.
Predicting deals the trees over the tasks. A task holds a group of rows (``GROUP_CELLS`` numbers) and reads its parts one by one. Shares of the
classes are rounded to multiples of 2^-40, so their sums do not depend on an order.

What differs between kinds of trees is an object with ``number_of_trees``, ``n_classes``, ``cell`` (type of the values in a block), ``width``,
``weights(draw, tree)``, ``grow(x, label, weight, tree, heap, depth)``, ``tops(blocks, limit)`` and ``values(nodes)``.
"""

from __future__ import annotations

import json
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkprint.session import materialize

BLOCK_CELLS = 1 << 22
GROUP_CELLS = 1 << 24
SHIP_BYTES = 64 << 20  # of rows that a task grows trees on
LEAF, DOOR = -1, -2
PARTS = "tree int, part int, nodes binary, fall string"
_BLOCK = "x binary, label binary, draw binary"
_UNIT = float(1 << 40)


@dataclass
class Door:
    """A node whose rows fit a block: its number in the top, its number as in a heap, its depth and its rows."""

    node: int
    heap: int
    depth: int
    rows: int


def packed(feature, cut, left, counts) -> dict:
    """Nodes as arrays of 16 bytes each. Of a leaf, ``left`` is its class and ``cut`` its rows, or if it has rows of several classes (or
    none), -1 - its place in ``mixed``. Of a door, ``left`` is its part."""
    nodes = {"feature": np.array(feature, dtype=np.int32), "cut": np.array(cut, dtype=np.float64), "left": np.array(left, dtype=np.int32)}
    counts = np.asarray(counts)
    n, leaf = counts.sum(1), nodes["feature"] == LEAF
    pure = leaf & (n > 0) & (counts.max(1) == n)
    mixed = leaf & ~pure
    nodes["left"][pure], nodes["cut"][pure] = counts[pure].argmax(1), n[pure]
    nodes["left"][mixed] = -1 - np.arange(mixed.sum())
    return nodes | {"mixed": counts[mixed].astype(np.int32)}


def leaf_counts(nodes: dict, n_classes: int) -> np.ndarray:
    """counts[node, class], 0 where a node is no leaf."""
    out = np.zeros((len(nodes["feature"]), n_classes), dtype=np.int64)
    leaf, left = nodes["feature"] == LEAF, nodes["left"]
    pure, mixed = np.flatnonzero(leaf & (left >= 0)), np.flatnonzero(leaf & (left < 0))
    out[pure, left[pure]] = nodes["cut"][pure]
    out[mixed] = nodes["mixed"][-1 - left[mixed]]
    return out


def walk(nodes: dict, x: np.ndarray) -> np.ndarray:
    """The leaf or door of each row."""
    feature, cut, left = nodes["feature"], nodes["cut"], nodes["left"]
    at = np.zeros(len(x), dtype=np.int64)
    rows = np.arange(len(x) if feature[0] >= 0 else 0)
    while len(rows):
        here = at[rows]
        here = left[here] + (x[rows, feature[here]] > cut[here])
        at[rows] = here
        rows = rows[feature[here] >= 0]
    return at


def _shares(nodes: dict, at: np.ndarray, n_classes: int) -> np.ndarray:
    out, ref = np.zeros((len(at), n_classes)), nodes["left"][at]
    pure = np.flatnonzero(ref >= 0)
    out[pure, ref[pure]] = 1.0
    mixed = np.flatnonzero(ref < 0)
    counts = nodes["mixed"][-1 - ref[mixed]].astype(np.float64)
    n = counts.sum(1, keepdims=True)
    out[mixed] = np.round(np.where(n > 0, counts / np.maximum(n, 1), 1 / n_classes) * _UNIT) / _UNIT
    return out


def matrix(column, n: int, width: int) -> np.ndarray:
    """An Arrow column of lists of ``width`` numbers as rows of numbers; null is NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, width)


def to_blocks(rows: DataFrame, width: int, encode, block_cells: int = BLOCK_CELLS) -> tuple[DataFrame, int, int]:
    """(blocks, their number, rows of a block) of rows with ``x``, ``label`` and ``draw``, written once; ``encode`` makes the values of a block."""
    per_block = max(1, block_cells // max(1, width))
    n = rows.count()
    wanted = max(1, -(-n // per_block))
    if wanted > 1:  # passes are jobs anyway: every core gets a block
        wanted = min(n, max(wanted, rows.sparkSession.sparkContext.defaultParallelism))

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 2 * per_block:
                yield pack(held)
                held, size = [], 0
        if size:
            yield pack(held)

    def pack(batches):
        table = pa.Table.from_batches(batches)
        if table.column("label").null_count:
            raise ValueError("labels must not be null")
        made = [encode(matrix(table.column("x"), table.num_rows, width)), table.column("label").to_numpy().astype(np.int32),
                table.column("draw").to_numpy().astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array([m.tobytes()], pa.binary()) for m in made], ["x", "label", "draw"])

    dealt = rows.repartition(wanted) if wanted > 1 else rows.coalesce(1)
    blocks = materialize(dealt.mapInArrow(run, _BLOCK), "rows")
    return blocks, blocks.count(), per_block


def read_block(row: dict, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    label = np.frombuffer(row["label"], np.int32).astype(np.int64)
    return np.frombuffer(row["x"], kind.cell).reshape(len(label), kind.width), label, np.frombuffer(row["draw"], np.int64).view(np.uint64)


def _part(number: int, part: int, nodes: dict, fall: dict):
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([part], pa.int32()), pa.array([pickle.dumps(nodes)], pa.binary()),
                                       pa.array([json.dumps({str(k): v for k, v in fall.items()})])], ["tree", "part", "nodes", "fall"])


def grow_forest(blocks: DataFrame, n_blocks: int, kind, limit: int) -> DataFrame:
    """The table of parts. ``limit``: rows that one task may hold."""
    if n_blocks > 1:
        return materialize(_by_parts(blocks, kind, kind.tops(blocks, limit)), "forest")
    if not n_blocks:
        return blocks.sparkSession.createDataFrame([], PARTS)
    tasks = min(kind.number_of_trees, max(1, blocks.sparkSession.sparkContext.defaultParallelism))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                x, label, draw = read_block(row, kind)
                for number in range(row["task"], kind.number_of_trees, tasks):
                    yield _part(number, 0, *kind.grow(x, label, kind.weights(draw, number), number, 0, 0))

    copies = blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))  # of the one block
    return materialize(copies.repartitionByRange(tasks, "task").mapInArrow(run, PARTS), "forest")


def _by_parts(blocks: DataFrame, kind, tops: list[tuple[dict, dict, list[Door]]]) -> DataFrame:
    """``tops``: nodes (with cuts as the blocks have them), falls and doors of each tree."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast([(nodes, doors) for nodes, _, doors in tops])

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                x, label, draw = read_block(row, kind)
                for number, (nodes, doors) in enumerate(shared.value):
                    weight, at = kind.weights(draw, number), walk(nodes, x)
                    part = np.where(nodes["feature"][at] == DOOR, nodes["left"][at], 0)
                    rows = np.flatnonzero((part > 0) & (weight > 0))
                    rows = rows[np.argsort(part[rows], kind="stable")]
                    first = np.flatnonzero(np.diff(part[rows], prepend=0))
                    for mine in np.split(rows, first[1:]) if len(rows) else []:
                        yield pa.RecordBatch.from_arrays([
                            pa.array([number], pa.int32()), pa.array([part[mine[0]]], pa.int32()), pa.array([x[mine].tobytes()], pa.binary()),
                            pa.array([label[mine].astype(np.int32).tobytes()], pa.binary()), pa.array([weight[mine].astype(np.uint8).tobytes()], pa.binary())],
                            ["tree", "part", "x", "label", "weight"])

    def grow(batches):
        key, held = None, []
        for batch in batches:
            tree, part = (batch.column(k).to_pylist() for k in range(2))
            for k in range(batch.num_rows):
                if (tree[k], part[k]) != key and held:
                    yield grown(key, held)
                    held = []
                key = tree[k], part[k]
                held.append([batch.column(c)[k].as_buffer() for c in range(2, 5)])
        if held:
            yield grown(key, held)

    def grown(key, held):
        x, label, weight = (np.concatenate([np.frombuffer(h[c], t) for h in held]) for c, t in enumerate((kind.cell, np.int32, np.uint8)))
        number, part = key
        door = shared.value[number][1][part - 1]
        return _part(number, part, *kind.grow(x.reshape(len(label), kind.width), label.astype(np.int64), weight.astype(np.int64), number, door.heap, door.depth))

    doors = [d for _, _, of_tree in tops for d in of_tree]
    size = sum(d.rows for d in doors) * (kind.width * np.dtype(kind.cell).itemsize + 5)
    tasks = max(1, min(len(doors), max(spark.sparkContext.defaultParallelism, size // SHIP_BYTES)))
    sent = blocks.mapInArrow(send, "tree int, part int, x binary, label binary, weight binary")
    rest = sent.repartition(tasks, "tree", "part").sortWithinPartitions("tree", "part").mapInArrow(grow, PARTS)
    made = [r for k, (nodes, fall, _) in enumerate(tops) for r in _part(k, 0, kind.values(nodes), fall).to_pylist()]
    return rest.unionByName(spark.createDataFrame([(r["tree"], r["part"], bytearray(r["nodes"]), r["fall"]) for r in made], PARTS))


def forest_probability(parts: DataFrame, n_trees: int, rows: DataFrame, n_classes: int, nan: float | None = None,
                       group_cells: int = GROUP_CELLS) -> DataFrame:
    """id, probability of rows with ``id`` and ``x``. Values that are NaN or null count as ``nan``, or are left of all cuts."""
    spark = rows.sparkSession
    if not n_trees:
        return rows.select("id", F.array(*[F.lit(1 / n_classes)] * n_classes).alias("probability"))
    first = rows.select(F.size("x")).first()
    n, cores = rows.count(), max(1, spark.sparkContext.defaultParallelism)
    width = first[0] if first else 0
    groups = max(1, -(-n * width // group_cells))
    tasks = min(n_trees, cores)

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                ids, x, g = batch.column(0).to_numpy(), matrix(batch.column(1), batch.num_rows, width), batch.column(2)[0].as_py()
                if nan is not None:
                    x[np.isnan(x)] = nan
                yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                                                  pa.array([x.tobytes()], pa.binary())], ["g", "one", "two"])

    dealt = rows.select("id", "x").repartition(groups * max(1, cores // groups)).withColumn("g", F.spark_partition_id() % groups)
    blocks = dealt.mapInArrow(pack, "g int, one binary, two binary").select(
        F.explode(F.sequence(F.col("g") * tasks, F.col("g") * tasks + tasks - 1)).alias("task"), F.lit(-1).alias("tree"), F.lit(0).alias("part"), "one", "two")
    mine = F.col("tree") % tasks
    trees = parts.select(F.explode(F.sequence(mine, mine + (groups - 1) * tasks, F.lit(tasks))).alias("task"), "tree", "part",
                         F.col("nodes").alias("one"), F.lit(None).cast("binary").alias("two"))

    def run(batches):
        key, held = None, None
        for batch in batches:
            task, tree, part = (batch.column(k).to_pylist() for k in range(3))
            for k in range(batch.num_rows):
                if task[k] != key:
                    if held:
                        yield summed(held)
                    key, held = task[k], {"ids": [], "x": []}
                if tree[k] < 0:
                    ids = np.frombuffer(batch.column(3)[k].as_buffer(), np.int64)
                    held["ids"].append(ids)
                    held["x"].append(np.frombuffer(batch.column(4)[k].as_buffer(), np.float64).reshape(len(ids), -1))
                else:
                    add(held, part[k], pickle.loads(batch.column(3)[k].as_buffer()))
        if held:
            yield summed(held)

    def add(held, part, nodes):
        if not held["ids"]:
            return
        if isinstance(held["x"], list):  # all rows of the group are here
            held["x"] = np.concatenate(held["x"])
            held["sums"] = np.zeros((len(held["x"]), n_classes))
        x = held["x"]
        if part:
            rows = np.flatnonzero(held["door"] == part)
            held["sums"][rows] += _shares(nodes, walk(nodes, x[rows]), n_classes)
        else:
            at = walk(nodes, x)
            held["door"] = np.where(nodes["feature"][at] == DOOR, nodes["left"][at], 0)
            rows = np.flatnonzero(held["door"] == 0)
            held["sums"][rows] += _shares(nodes, at[rows], n_classes)

    def summed(held):
        ids = np.concatenate(held["ids"] or [np.zeros(0, np.int64)])
        sums = held.get("sums", np.zeros((len(ids), n_classes)))
        made = pa.ListArray.from_arrays(np.arange(0, sums.size + 1, n_classes, dtype=np.int32), pa.array(sums.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), made], ["id", "sums"])

    sums = blocks.unionByName(trees).repartitionByRange(groups * tasks, "task").sortWithinPartitions("task", "tree", "part") \
        .mapInArrow(run, "id long, sums array<double>")
    return sums.groupBy("id").agg(F.array(*[F.sum(F.get("sums", F.lit(c))) / n_trees for c in range(n_classes)]).alias("probability"))


def importances(parts: DataFrame, each: bool) -> list[tuple[int, float]]:
    """(input, share of the falls of the impurity), of the inputs that split any node; ``each``: every tree has the same weight."""
    falls = parts.select("tree", F.explode(F.from_json("fall", "map<string,double>")).alias("input", "fall")) \
        .groupBy("tree", F.col("input").cast("int").alias("input")).agg(F.sum("fall").alias("fall"))
    if each:
        whole = falls.groupBy("tree").agg(F.sum("fall").alias("whole"))
        falls = falls.join(whole, "tree").withColumn("fall", F.col("fall") / F.col("whole"))
    found = sorted((r["input"], r["fall"]) for r in falls.groupBy("input").agg(F.sum("fall").alias("fall")).collect())
    total = sum(v for _, v in found)
    return [(k, v / total) for k, v in found if total]
