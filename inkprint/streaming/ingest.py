"""New export files to message rows, as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkprint.constants import PLACEHOLDER
from inkprint.operators.parse import messages_of, resolve_aliases, split_lines


def ingest_stream(spark: SparkSession, folder: str, out: str, checkpoint: str, aliases: DataFrame | None = None,
                  placeholder: str = PLACEHOLDER, files_per_batch: int | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Parse every new file of ``folder`` and append its messages to the table at ``out``.

    Files are read by lines, so one of any size is split over tasks; a file always falls
    into one micro-batch. Files that are no export are left out rather than stopping the
    stream. ``trigger`` is that of the writer; without it the query takes what is there and stops.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(folder, lineSep="\n").select(
        F.col("_metadata.file_path").alias("chat_id"), F.col("_metadata.file_block_start").alias("block"),
        F.regexp_replace(F.regexp_replace("value", r"\r\z", ""), "\r", "\n").alias("value"))

    def run(batch: DataFrame, epoch: int) -> None:
        placed = batch.withColumn("slot", F.monotonically_increasing_id())
        msgs = messages_of(split_lines(placed, strict=False), strict=False)
        # a batch that is run again replaces its own folder
        resolve_aliases(msgs, aliases, placeholder).write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    return lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"availableNow": True})).start()
