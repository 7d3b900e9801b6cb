"""Text to vector."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkprint.constants import EMBED_BATCH, EMBEDDING_STRATEGIES, TOKEN_PATTERN
from inkprint.functions.tokens import token_texts

DIMS = 32
TOKENS_AT_ONCE = 1 << 20


def check_strategy(strategy: str) -> None:
    if strategy not in EMBEDDING_STRATEGIES:
        raise ValueError(f"embedding strategy must be one of {EMBEDDING_STRATEGIES}, got {strategy!r}")


def _token_bytes(token: Column, dims: int, hasher: str = "xxhash64") -> list[Column]:
    """``dims`` numbers 0..255 from salted hashes of the token (``md5`` can be repeated in SQL)."""
    lower = F.lower(token)
    out: list[Column] = []
    if hasher == "xxhash64":
        for part in range(-(-dims // 8)):
            code = F.xxhash64(lower, F.lit(part))
            out.extend(F.shiftright(code, shift).bitwiseAND(F.lit(255)) for shift in range(56, -1, -8))
    elif hasher == "md5":
        for part in range(-(-dims // 16)):
            digest = F.md5(F.concat(lower, F.lit(f":{part}")))
            for word in range(4):
                bits = F.conv(F.substring(digest, 8 * word + 1, 8), 16, 10).cast("long")
                out.extend(F.shiftright(bits, shift).bitwiseAND(F.lit(255)) for shift in (24, 16, 8, 0))
    else:
        raise ValueError(f"unknown hasher: {hasher}")
    return out[:dims]


def _unit(total: Column) -> Column:
    return total / 127.5 - 1.0


def _slice_sums(tokens: pa.Array, offsets: np.ndarray, dims: int) -> np.ndarray:
    """[row, number]: sums over the tokens of each row. A word that is met again is not hashed again."""
    coded = tokens.dictionary_encode()
    words = [w + b":" for w in coded.dictionary.cast(pa.binary()).to_pylist()]
    digests = b"".join(b"".join(md5(w + b"%d" % part).digest() for part in range(-(-dims // 16)))[:dims] for w in words)
    out = np.zeros((len(offsets) - 1, dims), dtype=np.int64)
    filled = np.flatnonzero(np.diff(offsets))
    if len(filled):
        met = np.frombuffer(digests, np.uint8).reshape(len(words), dims)[coded.indices.to_numpy()]
        out[filled] = np.add.reduceat(met, offsets[filled] - offsets[0], axis=0, dtype=np.int64)
    return out


def _md5_sums(dims: int):
    """Rows of (key, words) to (key, number of words, sums of their md5 bytes)."""
    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            offsets, at = lists.offsets.to_numpy().astype(np.int64), 0
            while at < len(lists):
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + TOKENS_AT_ONCE, side="right")) - 1)
                own = offsets[at:end + 1]
                sums = _slice_sums(lists.values.slice(own[0], own[-1] - own[0]), own, dims)
                listed = pa.ListArray.from_arrays(pa.array(np.arange(end - at + 1) * dims, pa.int32()), pa.array(sums.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array(np.diff(own)), listed], ["key", "one", "sums"])
                at = end
    return run


def mean_vectors(df: DataFrame, text: str = "message", key: str = "message_id", dims: int = DIMS,
                 hasher: str = "xxhash64") -> DataFrame:
    """key, mean: mean of the token vectors, zeros for a text without tokens.

    Tokens are summed as whole numbers where they are read, so a message crosses the
    network as one row and its mean does not depend on the order of the sums. Words for ``md5`` are
    hashed from Arrow batches, each once a slice; the other hash stays in the JVM.
    """
    if hasher == "md5":
        words = df.select(F.col(key).alias("key"), F.transform(token_texts(text), lambda t: F.lower(t)).alias("words"))
        out = T.StructType([words.schema["key"], T.StructField("one", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType()))])
        parts = words.mapInArrow(_md5_sums(dims), out).select(F.col("key").alias(key), F.col("one").alias("_one"), *[
            F.get("sums", F.lit(i)).alias(f"_b{i}") for i in range(dims)])
        return _means(parts, key, dims)
    tokens = df.select(key, F.explode_outer(token_texts(text)).alias("_token"))
    parts = tokens.select(key, F.col("_token").isNotNull().cast("long").alias("_one"),
                          *[b.alias(f"_b{i}") for i, b in enumerate(_token_bytes(F.col("_token"), dims, hasher))])
    return _means(parts, key, dims)


def _means(parts: DataFrame, key: str, dims: int) -> DataFrame:
    sums = parts.groupBy(key).agg(F.sum("_one").alias("_n"), *[F.sum(f"_b{i}").alias(f"_b{i}") for i in range(dims)])
    values = F.array(*[_unit(F.col(f"_b{i}") / F.col("_n")) for i in range(dims)])
    zeros = F.array(*[F.lit(0.0)] * dims)
    return sums.select(key, F.when(F.col("_n") > 0, values).otherwise(zeros).alias("mean"))


def first_vectors(df: DataFrame, text: str = "message", dims: int = DIMS, out: str = "first",
                  hasher: str = "xxhash64") -> DataFrame:
    """Add the vector of the first token, zeros without one."""
    marked = df.withColumn("_token", F.regexp_extract(text, f"({TOKEN_PATTERN})", 1))
    names = [f"_b{i}" for i in range(dims)]
    wide = marked.select("*", *[b.alias(n) for b, n in zip(_token_bytes(F.col("_token"), dims, hasher), names)])
    values = F.array(*[_unit(F.col(n).cast("double")) for n in names])
    zeros = F.array(*[F.lit(0.0)] * dims)
    return wide.select(*df.columns, F.when(F.col("_token") == "", zeros).otherwise(values).alias(out))


def embed_hashed(df: DataFrame, strategy: str = "mixed", text: str = "message", key: str = "message_id",
                 dims: int = DIMS, hasher: str = "xxhash64") -> DataFrame:
    """Add ``embedding`` from hashed token vectors: first token, mean of tokens, or both joined."""
    check_strategy(strategy)
    kept = [c for c in df.columns if c not in (text, "responsiveness")]
    if strategy == "cls":
        return first_vectors(df, text, dims, "embedding", hasher).select(*kept, "embedding")
    means = mean_vectors(df, text, key, dims, hasher)
    if strategy == "mean":
        return df.select(*kept).join(means.withColumnRenamed("mean", "embedding"), key)
    firsts = first_vectors(df, text, dims, "_first", hasher).select(*kept, "_first")
    return firsts.join(means, key).withColumn("embedding", F.concat("_first", "mean")).select(*kept, "embedding")


def trigram_encoder(dims: int = 64) -> Callable:
    """Maker of a batch encoder: hashed character trigrams of the whole text, scaled to length 1."""
    def make():
        import zlib

        def predict(texts: np.ndarray) -> np.ndarray:
            out = np.zeros((len(texts), dims), dtype=np.float32)
            for row, text in enumerate(texts):
                raw = str(text).lower().encode("utf-8")
                codes = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
                if len(codes) < 3:
                    codes = np.array([zlib.crc32(raw)], dtype=np.uint32)
                else:
                    codes = (codes[:-2] * 65599 + codes[1:-1] * 257 + codes[2:]) * np.uint32(2654435761)
                signs = np.where(codes >> np.uint32(31), 1.0, -1.0)
                out[row] = np.bincount((codes >> np.uint32(8)) % dims, signs, dims)
            norms = np.linalg.norm(out, axis=1, keepdims=True)
            return out / np.where(norms == 0, 1, norms)

        return predict
    return make


def embed(df: DataFrame, make_encoder: Callable | None = None, text: str = "message",
          batch_size: int = EMBED_BATCH, dims: int = 64) -> DataFrame:
    """Add ``embedding`` by a batch encoder, loaded once per Python worker.

    ``make_encoder()`` returns a function from an array of texts to a matrix. A pretrained
    model is plugged in here; the default needs none.
    """
    encode = predict_batch_udf(make_encoder or trigram_encoder(dims), return_type=T.ArrayType(T.FloatType()),
                               batch_size=batch_size)
    kept = [c for c in df.columns if c not in (text, "responsiveness")]
    return df.select(*kept, encode(F.col(text)).alias("embedding"))


def vector_to_columns(df: DataFrame, dims: int, strategy: str = "mixed", vector: str = "embedding") -> DataFrame:
    """One column ``<strategy>_embed_<i>`` per dimension instead of the array."""
    check_strategy(strategy)
    kept = [c for c in df.columns if c not in (vector, "message", "responsiveness")]
    return df.select(*kept, *[F.get(F.col(vector), F.lit(i)).alias(f"{strategy}_embed_{i}") for i in range(dims)])


def assemble_wide(df: DataFrame, prefix: str | None = None, label: str = "user", out: str = "embedding") -> DataFrame:
    """Columns with the prefix (or all but label and key) back into one array."""
    names = [c for c in df.columns if (c.startswith(prefix) if prefix else c not in (label, "message_id"))]
    if not names:
        raise ValueError(f"no column starts with {prefix!r}")
    kept = [c for c in df.columns if c not in names]
    return df.select(*kept, F.array(*[F.col(c) for c in names]).alias(out))
