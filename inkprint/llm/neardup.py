"""Near-duplicate documents: DartMinHash signatures of word shingles, a banded join, exact checks, components.

1. One scan sketches every text: the fingerprint of its shingle set, band keys and one byte of each
   coordinate. Texts with equal sets are one node from here on.
2. Nodes that share a band key are candidates. Each is checked against the smallest node of the key (so a key with
   n nodes gives n - 1 pairs), by the exact Jaccard similarity of the shingle sets.
3. Where a key still holds nodes of several components, nodes of different ones are compared inside a task, in tiles
   of bounded size, by their signature bytes and, where the estimate is not clearly below the threshold,
   exactly. Only links leave the task.
4. Components of all links are the classes.

A pair of similarity s shares a key with probability 1 - (1 - s^rows)^bands: 0.999995 at 0.8 with the
defaults, higher above. No key, however common, is gathered in one task.

Defined cases: null and empty texts and texts without words link with nothing; shorter texts than a
shingle are one shingle; rows with a null id get a null class and link with nothing; rows that share an
id are one document, which links if any of its texts does; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkprint.llm.clusters import cluster
from inkprint.llm.common import query, table, texts_of
from inkprint.llm.shingles import GROUP_BYTES, Darts, band_keys, fingerprint, shingle_sets
from inkprint.session import materialize


def _parts(ids, texts):
    """Consecutive rows, of bounded text size."""
    start, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t or b"")
        if held >= GROUP_BYTES or k == len(texts) - 1:
            yield ids.slice(start, k + 1 - start), texts[start:k + 1]
            start, held = k + 1, 0


def _sketch(bands: int, rows: int, width: int, weigh: bool):
    darts = Darts(bands * rows)

    def run(batches):
        for batch in batches:
            for ids, texts in _parts(batch.column(0), texts_of(batch.column(1))):
                found = shingle_sets(texts, width)
                full = [k for k, (s, _) in enumerate(found) if len(s)]
                sets, counts = [found[k][0] for k in full], [found[k][1] for k in full]
                signatures = darts.signatures(sets, counts if weigh else None)
                keys = band_keys(signatures, bands, rows)
                small = (signatures * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(full, pa.int64())),
                    pa.array([fingerprint(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1) * bands, pa.int32()), pa.array(keys.reshape(-1))),
                    pa.array([x.tobytes() for x in small], pa.binary())], ["id", "print", "n", "keys", "signature"])
    return run


def _sets(width: int):
    def run(batches):
        for batch in batches:
            for ids, texts in _parts(batch.column(0), texts_of(batch.column(1))):
                sets = [s.tobytes() for s, _ in shingle_sets(texts, width)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.binary())], ["node", "elements"])
    return run


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, width: int = 5,
                    bands: int = 40, rows: int = 6, weigh: bool = False) -> DataFrame:
    """(key, class_id, kept) for every distinct id: the smallest id of its class, and whether it is that one.

    Signatures are of the shingle set or, with ``weigh``, of the multiset; the check is of the set.
    """
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    texts = source.where(F.col("id").isNotNull() & F.col("text").isNotNull())
    sketch = materialize(texts.mapInArrow(_sketch(bands, rows, width, weigh),
                                          "id long, print binary, n long, keys array<long>, signature binary"), "sketch")
    classes = materialize(sketch.groupBy("print").agg(F.min("id").alias("node")), "classes")
    nodes = sketch.join(classes.select("print", F.col("node").alias("id")), ["print", "id"], "left_semi") \
        .dropDuplicates(["print", "id"]).select(F.col("id").alias("node"), "n", "keys", "signature", F.col("id").alias("low"), F.col("id").alias("high"))
    nodes = materialize(nodes, "nodes")

    def sets_of(wanted):
        return texts.join(wanted, "id", "left_semi").mapInArrow(_sets(width), "node long, elements binary")

    classed = cluster(nodes, sets_of, threshold, bands * rows)
    member = sketch.select("id", "print").distinct().join(classes, "print")
    member = member.join(classed.withColumnRenamed("id", "node"), "node", "left") \
        .groupBy("id").agg(F.min(F.coalesce("component", "node")).alias("class_id"))
    out = source.select("id").distinct().join(member, "id", "left")
    class_id = F.coalesce("class_id", "id")
    return out.select(F.col("id").alias(key), class_id.alias("class_id"), F.col("id").eqNullSafe(class_id).alias("kept"))


@query("op7_minhash_neardup")
def op7(spark, d):
    return near_duplicates(table(spark, d, "documents"))
