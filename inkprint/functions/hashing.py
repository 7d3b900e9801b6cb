"""MurmurHash3 (32 bit, seed 0) of the UTF-8 bytes of a string column, on Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_M = np.uint64(0xFFFFFFFF)
SLICE_BYTES = 1 << 20  # of the texts hashed side by side, with their padding


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return ((x << np.uint64(r)) | (x >> np.uint64(32 - r))) & _M


def _mixed(k: np.ndarray) -> np.ndarray:
    return (_rotl((k * np.uint64(0xCC9E2D51)) & _M, 15) * np.uint64(0x1B873593)) & _M


def _hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The hashes of the texts at ``starts`` in ``data``: all advance one four-byte word at a time."""
    blocks = -(-int(sizes.max()) // 4) if len(sizes) else 0
    if not blocks:
        words = np.zeros((len(sizes), 0), dtype="<u4")
    else:
        places = np.arange(4 * blocks)
        inside = places < sizes[:, None]
        padded = np.where(inside, data[np.where(inside, starts[:, None] + places, 0)], 0).astype(np.uint8)
        words = padded.view("<u4")
    h = np.zeros(len(sizes), dtype=np.uint64)
    for i in range(blocks):
        k = _mixed(words[:, i].astype(np.uint64))
        full = sizes >= 4 * (i + 1)
        body = (_rotl(h ^ k, 13) * np.uint64(5) + np.uint64(0xE6546B64)) & _M
        tail = ~full & (sizes > 4 * i)
        h = np.where(full, body, np.where(tail, h ^ k, h))
    h ^= sizes.astype(np.uint64)
    h ^= h >> np.uint64(16)
    h = (h * np.uint64(0x85EBCA6B)) & _M
    h ^= h >> np.uint64(13)
    h = (h * np.uint64(0xC2B2AE35)) & _M
    h ^= h >> np.uint64(16)
    return h.astype(np.uint32).view(np.int32)


def murmur3_array(texts: pa.Array) -> np.ndarray:
    """Signed hash of every text; texts of one length class are hashed in slices, so a long one pads no others."""
    offsets, data = _bytes_of(texts)
    sizes = np.diff(offsets)
    out = np.empty(len(sizes), dtype=np.int32)
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        # the texts are in order of size: as many as fit with the size of the last one
        end = min(len(order), at + max(1, SLICE_BYTES // (int(sizes[order[at]]) + 4)))
        while end - at > 1 and (end - at) * int(sizes[order[end - 1]]) > 2 * SLICE_BYTES:
            end = at + (end - at) // 2
        mine = order[at:end]
        out[mine] = _hashes(data, offsets[mine], sizes[mine])
        at = end
    return out


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an array of texts, as they lie in its buffers."""
    plain = texts.cast(pa.large_binary())
    _, at, data = plain.buffers()
    offsets = np.frombuffer(at, np.int64)[plain.offset:plain.offset + len(plain) + 1] if at and len(plain) else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data and data.size else np.zeros(1, np.uint8)


def murmur3(texts: pd.Series) -> pd.Series:
    """Signed hash of every text."""
    return pd.Series(murmur3_array(pa.array(texts.tolist(), pa.string())), index=texts.index)


def murmur3_lists(lists: pa.Array) -> pa.Array:
    """The hashes of every list of texts, from its buffers: no text becomes a Python object."""
    hashed = pa.array(murmur3_array(lists.flatten()), pa.int32())
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, hashed, mask=lists.is_null() if lists.null_count else None)


def murmur3_words(words: Column) -> Column:
    # made per call: an arrow_udf needs no session, but its return type check does
    def hashed(lists: pa.Array) -> pa.Array:
        return murmur3_lists(lists)
    return F.arrow_udf(hashed, "array<int>")(words)
