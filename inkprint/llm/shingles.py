"""Sets of hashed word shingles, DartMinHash signatures, and the exact check of pairs."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkprint.llm.common import mix64
from inkprint.llm.decontaminate import words_of

GROUP_BYTES = 2 << 20
ELEMENTS = 1 << 18  # elements whose darts are thrown at once
_POISSON = np.cumsum(np.exp(-1) / np.concatenate([[1.0], np.cumprod(np.arange(1, 24, dtype=float))]))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: list[bytes | None], width: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its sorted distinct shingle hashes and how often each occurs. A text of fewer words than
    ``width`` is one shingle; one without words has none."""
    words = [words_of(t) for t in texts]
    code: dict[bytes, int] = {}
    flat = np.fromiter((code.setdefault(w, len(code)) for ws in words for w in ws), np.int64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in code), np.uint64, len(code))[flat]
    out, at = [], 0
    for ws in words:
        h = hashes[at:at + len(ws)]
        at += len(ws)
        n = min(width, len(h))
        rolled = np.full(max(0, len(h) - n + 1) if n else 0, n, dtype=np.uint64)
        for k in range(n):
            rolled = rolled * _STEP + h[k:len(h) - n + 1 + k]
        out.append(np.unique(mix64(rolled), return_counts=True))
    return out


def fingerprint(elements: np.ndarray) -> bytes | None:
    """Equal for equal sets; None for the empty one."""
    return hashlib.md5(elements.tobytes()).digest() if len(elements) else None


class Darts:
    """DartMinHash: darts are thrown, as functions of the element alone, into the plane weight x rank; an
    element keeps those below its weight. Cells of area one hold a Poisson(1) number of darts; a dart names a
    coordinate of the signature, and each coordinate keeps its lowest dart. Two sets agree in a
    coordinate with the probability of their weighted Jaccard similarity. Ranks up to a bound that
    leaves few coordinates empty are thrown first; texts with empty coordinates throw again, higher up.
    """

    def __init__(self, size: int):
        self.size = size
        self.total = size * np.log(size) + 2 * size

    def signatures(self, sets: list[np.ndarray], weights: list[np.ndarray] | None = None) -> np.ndarray:
        """One row of 64-bit coordinates for each non-empty set."""
        out = np.full((len(sets), self.size), _NONE)
        mass = np.array([len(s) if weights is None else weights[k].sum() for k, s in enumerate(sets)], dtype=float)
        low, high = np.zeros(len(sets), dtype=np.int64), np.ceil(self.total / np.maximum(mass, 1e-9)).astype(np.int64)
        todo = np.flatnonzero(mass > 0)
        while len(todo):
            self._throw(out, sets, weights, todo, low, high)
            todo = todo[(out[todo] == _NONE).any(1)]
            low[todo], high[todo] = high[todo], high[todo] * 2
        return out

    def _throw(self, out, sets, weights, todo, low, high):
        elements = np.concatenate([sets[k] for k in todo])
        heavy = np.ones(len(elements)) if weights is None else np.concatenate([weights[k] for k in todo]).astype(float)
        owner = np.repeat(todo, [len(sets[k]) for k in todo])
        wide = np.ceil(heavy).astype(np.int64)
        cells = wide * (high - low)[owner]
        done = np.cumsum(cells)
        edges = np.searchsorted(done, np.arange(0, int(done[-1]) + ELEMENTS, ELEMENTS), side="left")
        flat = out.reshape(-1)
        for a, b in zip(edges[:-1], np.maximum(edges[1:], edges[:-1])):
            b = len(elements) if b >= len(elements) - 1 else b
            if a >= b:
                continue
            rep = np.repeat(np.arange(a, b), cells[a:b])
            nth = np.arange(len(rep)) - np.repeat(np.cumsum(cells[a:b]) - cells[a:b], cells[a:b])
            column, row = nth % wide[rep], low[owner[rep]] + nth // wide[rep]
            seed = mix64(elements[rep] + column.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                         + row.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
            darts = np.searchsorted(_POISSON, (seed >> np.uint64(11)) * 2.0 ** -53, side="right")
            of = np.repeat(np.arange(len(rep)), darts)
            which = np.arange(len(of)) - np.repeat(np.cumsum(darts) - darts, darts)
            h = mix64(seed[of] + (which + 1).astype(np.uint64) * _STEP)
            rank = (row[of] + ((h >> np.uint64(16)) & np.uint64(0xFFFFFF)) * 2.0 ** -24).astype(np.float32)
            place = ((h >> np.uint64(40)) * np.uint64(self.size) >> np.uint64(24)).astype(np.int64)
            value = rank.view(np.uint32).astype(np.uint64) << np.uint64(32) | (mix64(h) & np.uint64(0xFFFFFFFF))
            key = owner[rep[of]] * self.size + place
            if weights is not None:
                inside = column[of] + (mix64(h + _STEP) >> np.uint64(11)) * 2.0 ** -53 < heavy[rep[of]]
                key, value = key[inside], value[inside]
            np.minimum.at(flat, key, value)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates."""
    blocks = signatures[:, :bands * rows].reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), blocks.shape[:2]).copy()
    for k in range(rows):
        key = mix64(key * _STEP + blocks[:, :, k])
    return key.view(np.int64)


def similar_pairs(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs (a, b), those whose sets (node, elements) have a Jaccard similarity of at least ``threshold``."""
    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(common >= threshold * (len(x) + len(y) - common) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(check, f"a {kind}, b {kind}")
