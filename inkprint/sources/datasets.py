"""Dataset tables, author maps and the model registry."""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkprint.config import with_affixes
from inkprint.session import materialize, path_exists

KINDS = ("features", "embeddings")


def dataset_path(folder: str, name: str, kind: str) -> str:
    """``<folder>/<kind>_<name>.parquet``, prefix and extension added once."""
    if kind not in KINDS:
        raise ValueError(f"unknown dataset kind: {kind}")
    return os.path.join(folder, with_affixes(name, f"{kind}_", ".parquet"))


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    path = with_affixes(path, suffix=".parquet")
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def write_dataset(df: DataFrame, folder: str, name: str, kind: str = "features") -> str:
    path = dataset_path(folder, name, kind)
    df.write.mode("overwrite").parquet(path)
    return path


def write_users(users: DataFrame, folder: str, name: str) -> str:
    """Class index to author, as JSON lines."""
    path = os.path.join(folder, with_affixes(name, suffix=".json"))
    users.select(F.col("user").cast("int").alias("user"), "author").write.mode("overwrite").json(path)
    return path


def read_users(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.schema("user int, author string").json(path)


REGISTRY = T.StructType([T.StructField("model", T.StringType()), T.StructField("user", T.IntegerType()),
                         T.StructField("author", T.StringType())])


def clean_model_name(name: str | Column) -> Column:
    """A model's registry key: its file name without prefix and extension."""
    return F.regexp_replace(name if not isinstance(name, str) else F.col(name), r"model_|\.joblib", "")


def register_users(registry: DataFrame | None, users: DataFrame, model: str) -> DataFrame:
    """The registry (model, user, author) with this model's rows replaced by ``users``."""
    fresh = users.select(F.lit(model).alias("model"), F.col("user").cast("int").alias("user"), "author")
    return fresh if registry is None else registry.filter(F.col("model") != model).unionByName(fresh)


COMPACT_EVERY = 10
_ATTEMPTS = 1000


def update_registry(spark: SparkSession, path: str, users: DataFrame, model: str) -> DataFrame:
    """Upsert into the registry at ``path``; a missing registry is an empty one.

    The rows go to a table of their own; then a numbered entry of the log names it. An entry is put there only if its number is
    free, so of two writers that take the same number one finds it taken and tries the next: no upsert is lost, and of one
    model's the later entry counts. What a writer leaves behind that fails before its entry is never read. Every ``COMPACT_EVERY``
    entries, the state so far becomes one table, named by a snapshot beside the entry.
    """
    table = f"{path}/data/{uuid.uuid4().hex}"
    register_users(None, users, model).write.parquet(table)
    for _ in range(_ATTEMPTS):
        version = max(_entries(spark, path), default=0) + 1
        if _put_if_absent(spark, f"{path}/log/{version:010d}.json", json.dumps({"model": model, "table": table})):
            break
    else:
        raise RuntimeError(f"no free entry in the log of {path}")
    if version % COMPACT_EVERY == 0:
        compact_registry(spark, path, version)
    return read_registry(spark, path)


def compact_registry(spark: SparkSession, path: str, version: int) -> None:
    """Write the state after entry ``version`` as one table. A second writer of the same snapshot changes nothing."""
    table = f"{path}/data/{uuid.uuid4().hex}"
    read_registry(spark, path, version).write.parquet(table)
    _put_if_absent(spark, f"{path}/log/{version:010d}.snapshot", json.dumps({"table": table}))


def read_registry(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(model, user, author) after entry ``version`` (the last one): the newest snapshot, and the later entries."""
    entries = {v: e for v, e in _entries(spark, path).items() if version is None or v <= version}
    snapshots = {v: e for v, e in _entries(spark, path, "snapshot").items() if v <= max(entries, default=0)}
    since = max(snapshots, default=0)
    latest: dict[str, str] = {}
    for v in sorted(v for v in entries if v > since):
        entry = _read_entry(spark, entries[v])
        latest[entry["model"]] = entry["table"]
    state = spark.createDataFrame([], REGISTRY)
    if since:
        base = spark.read.schema(REGISTRY).parquet(_read_entry(spark, snapshots[since])["table"])
        state = base.filter(~F.col("model").isin(*latest)) if latest else base
    return state.unionByName(spark.read.schema(REGISTRY).parquet(*latest.values())) if latest else state


def _entries(spark: SparkSession, path: str, kind: str = "json") -> dict[int, str]:
    """Number -> file of the log's entries."""
    if not path_exists(spark, f"{path}/log"):
        return {}
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/log")
    names = [s.getPath().getName() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    return {int(n.split(".")[0]): f"{path}/log/{n}" for n in names if n.split(".")[0].isdigit() and n.endswith(f".{kind}")}


def _read_entry(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def _put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """A new file with this text, complete or not there; false if the name is taken."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, draft = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.{uuid.uuid4().hex}.draft"))
    system = target.getFileSystem(conf)
    stream = system.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
        never_over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(system.makeQualified(draft), system.makeQualified(target), never_over)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        system.delete(draft, False)
        return False


def cached(spark: SparkSession, path: str, build, refactor: bool = False) -> DataFrame:
    """Read the table if it is there and ``refactor`` is off, else build and write it."""
    if not isinstance(refactor, bool):
        raise TypeError("refactor must be a bool")
    if refactor or not path_exists(spark, path):
        fresh = build()
        if path_exists(spark, path):
            fresh = materialize(fresh, "rebuild")
        fresh.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
