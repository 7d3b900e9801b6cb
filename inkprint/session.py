"""Session settings, and the shared folder in which intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BROADCAST_BYTES = 16 << 20  # of a table as stored, compressed


def build_session(app: str = "inkprint", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, adaptive execution)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is ``spark.checkpoint.dir`` where the cluster names one. Only a local master
    may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="inkprint-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/inkprint-{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str = "stage") -> tuple[DataFrame, int]:
    """Write ``df`` as a table in the shared folder; returns the table and its size in bytes."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(jvm_path).getLength()
    return spark.read.schema(df.schema).parquet(path), int(size)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage so that a lost executor never makes an ordering or a sampled
    partitioning be computed a second time, with a second outcome.
    """
    return store(df, name)[0]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whichever file system it names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of our own, if it exists."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Deal a scan of fewer partitions than cores over all of them; a wide scan stays as it is.

    For plain scans: a small table in one row group would keep one core busy with all the
    text work, while a large one already has a partition per input split.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)
