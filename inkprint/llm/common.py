"""What the operators of this folder share: registration, the driver tables, and Arrow plumbing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def table(spark, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def held_out(doc_id: str, modulus: int):
    """Whether crc32 of the id as text leaves the remainder 2; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == 2, F.lit(False))


def texts_of(column: pa.Array) -> list[bytes | None]:
    """The texts of a batch as UTF-8."""
    return column.cast(pa.binary()).to_pylist()


def with_struct(df: DataFrame, column: str, into: str, fields: T.StructType, start, rows: int = 1 << 20) -> DataFrame:
    """``df`` and one struct column computed from ``column``, for at most ``rows`` rows of a batch at once.

    ``start()`` runs once in each task and returns a function from the list of UTF-8 texts of
    a batch (None where null) to one Arrow array per field. An input column that is called
    ``into`` gives way to the result; all others pass unchanged.
    """
    kept = [f for f in df.schema.fields if f.name != into]
    schema = T.StructType([*kept, T.StructField(into, fields)])
    source = df.select(*[df[f.name].alias(f.name) for f in kept])
    at_text = next((k for k, f in enumerate(kept) if f.name == column and f.dataType == T.StringType()), len(kept))
    if at_text == len(kept):
        source = df.select(*source.columns, df[column].cast("string").alias("__text"))
    names, field_names = [f.name for f in schema.fields], fields.names

    def run(batches):
        compute = start()
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), rows):
                arrays = batch.slice(at, rows).columns
                made = compute(texts_of(arrays[at_text]))
                yield pa.RecordBatch.from_arrays([*arrays[:len(kept)], pa.StructArray.from_arrays(made, field_names)], names)
            pa.default_memory_pool().release_unused()

    return source.mapInArrow(run, schema)


def lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    """An Arrow list array; row i holds values[offsets[i]:offsets[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def groups(batches, keys: int):
    """(key, table) for each run of equal values in the first ``keys`` columns of sorted batches."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        ends = [*(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        start = 0
        for end in ends:
            key = tuple(c[start] for c in columns)
            if held and key != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(start, end - start))
            start = end
    if held:
        yield current, pa.Table.from_batches(held)
