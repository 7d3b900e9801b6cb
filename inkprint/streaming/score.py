"""Scoring of a message stream with running averages per conversation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from inkprint.operators.order import blocked_running_sums
from inkprint.session import delete_path, path_exists, scratch_path


def stream_totals(stream: DataFrame, keys: tuple[str, ...] = ("chat_id",), p: str = "p",
                  ts: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Running mean per conversation and class of a stream of (keys, user, p).

    The state per conversation and class is one sum and one count. With ``ts`` a watermark
    is set on the stream.
    """
    if ts:
        stream = stream.withWatermark(ts, delay)
    return stream.groupBy(*keys, "user").agg(F.avg(p).alias("average"), F.count("*").alias("n"))


def _state_schema(df: DataFrame, keys: list[str]) -> str:
    types = dict(df.dtypes)
    return ", ".join([f"{k} {types[k]}" for k in keys] + ["_s double", "_c long"])


def running_batches(out: str, state: str, keys: tuple[str, ...] = ("chat_id",), pos: str = "pos",
                    p: str = "p") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that writes each message's running average, in order.

    The batch's own running sums are taken in blocks, so a conversation that fills the
    batch is still spread over tasks, and the totals of earlier batches are added from the
    state table. Output and state of a batch go to folders named by the batch number: a
    batch that is run again after a failure overwrites its own and nothing else. A batch
    without the finished state of the batch before it is an error, not a start from zero.
    Only the states of the last two batches are kept.
    """
    by = [*keys, "user"]

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        schema = _state_schema(batch, by)
        earlier = f"{state}/{epoch - 1:010d}"
        if epoch > 0 and not path_exists(spark, f"{earlier}/_SUCCESS"):
            raise FileNotFoundError(f"the state of batch {epoch - 1} is missing or unfinished: {earlier}")
        before = spark.read.schema(schema).parquet(earlier) if epoch > 0 else spark.createDataFrame([], schema)
        sums = blocked_running_sums(batch.withColumn("_one", F.lit(1)), by, pos, {"_sum": p, "_count": "_one"})
        both = sums.join(before, by, "left").na.fill(0, ["_s", "_c"])
        rows = both.withColumn("average", (F.col("_sum") + F.col("_s")) / (F.col("_count") + F.col("_c")))
        rows.select(*batch.columns, "average").write.mode("overwrite").parquet(f"{out}/batch={epoch}")
        totals = batch.groupBy(*by).agg(F.sum(p).alias("_s"), F.count("*").alias("_c"))
        merged = before.unionByName(totals).groupBy(*by).agg(F.sum("_s").alias("_s"), F.sum("_c").alias("_c"))
        merged.write.mode("overwrite").parquet(f"{state}/{epoch:010d}")
        delete_path(spark, f"{state}/{epoch - 2:010d}")

    return run


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, state: str, checkpoint: str,
                 keys: tuple[str, ...] = ("chat_id",), pos: str = "pos", trigger: dict | None = None) -> StreamingQuery:
    """Score every micro-batch and write each message with its running average.

    ``score`` turns message rows into (keys, pos, user, p) rows. ``trigger`` is that of the
    writer, such as {"processingTime": "1 minute"}; without it the query takes what is there and stops.
    """
    write = running_batches(out, state, keys, pos)

    def run(batch: DataFrame, epoch: int) -> None:
        # the running sums read the scored rows more than once; the models run once
        spark, path = batch.sparkSession, scratch_path(batch.sparkSession, "batch")
        scored = score(batch)
        scored.write.parquet(path)
        write(spark.read.schema(scored.schema).parquet(path), epoch)
        delete_path(spark, path)

    return (
        stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def running_stream(stream: DataFrame, keys: tuple[str, ...] = ("chat_id",), pos: str = "pos", p: str = "p", ts: str | None = None,
                   delay: str = "1 hour") -> DataFrame:
    """The stream with ``average``, the running mean of its conversation and class, from sums and counts in the state store.

    The state of a conversation is one sum and one count for each of its classes, and one call of Python handles all of them; a
    micro-batch writes the conversations it touches and no others. Without ``ts`` the
    rows of a batch count in the order of ``pos``, after those of earlier batches. With ``ts`` rows wait in the state until the
    watermark has passed them (a timer wakes a conversation that gets no more rows), so rows that are late by less than ``delay`` take
    their place in the order of ``ts`` and ``pos``; later ones are dropped. A row with a null ``p`` adds nothing and shows the mean so far.

    The rows of one conversation in one batch meet in one task; the trigger bounds them. For a chat that fills the batches,
    ``running_batches`` spreads it over tasks.
    """
    if ts:
        stream = stream.withWatermark(ts, delay)
    out = T.StructType([*stream.schema.fields, T.StructField("average", T.DoubleType())])
    names, zone = stream.columns, stream.sparkSession.conf.get("spark.sql.session.timeZone")  # rows show local times of that zone

    def packed(rows: pd.DataFrame) -> bytes:
        table, sink = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        return sink.getvalue().to_pybytes()

    label = "user" if dict(stream.dtypes)["user"] == "string" else "_class"  # the state names classes by text
    labelled = stream if label == "user" else stream.withColumn(label, F.col("user").cast("string"))

    def update(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        classes, totals, counts, waiting = state.get if state.exists else ((), (), (), None)
        known = dict(zip(classes, zip(totals, counts)))
        held = [] if waiting is None else [pa.ipc.open_stream(bytes(waiting)).read_pandas()]
        rows = [b for b in ([] if state.hasTimedOut else batches) if len(b)]
        every = pd.concat([*held, *rows], ignore_index=True) if held or rows else None
        rest = None
        if every is not None and ts:
            now = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms", tz="UTC").tz_convert(zone).tz_localize(None)
            passed = every[ts].isna() | (every[ts] <= now)
            rest, every = every[~passed], every[passed]
        if every is not None and len(every):
            if ts or not every[pos].is_monotonic_increasing:
                every = every.sort_values([ts, pos] if ts else [pos], kind="stable")
            values = every[p].astype("float64").to_numpy()
            there, values, average = ~np.isnan(values), np.nan_to_num(values), np.full(len(values), np.nan)
            codes, found = pd.factorize(every[label], use_na_sentinel=False)
            by_class = np.argsort(codes, kind="stable")
            ends = np.cumsum(np.bincount(codes, minlength=len(found)))
            for name, at in zip(found, np.split(by_class, ends[:-1])):
                name = name if isinstance(name, str) else None
                total, count = known.get(name, (0.0, 0))
                sums, counts = total + np.cumsum(values[at]), count + np.cumsum(there[at])
                known[name] = float(sums[-1]), int(counts[-1])
                average[at] = np.where(counts > 0, sums / np.maximum(counts, 1), np.nan)
            yield every[names].assign(average=average)
        state.update((list(known), [t for t, _ in known.values()], [n for _, n in known.values()],
                      packed(rest) if rest is not None and len(rest) else None))
        if rest is not None and len(rest):
            first = rest[ts].min().tz_localize(zone, ambiguous=True, nonexistent="shift_forward")
            state.setTimeoutTimestamp(max(int(first.value // 1_000_000), state.getCurrentWatermarkMs() + 1))

    return labelled.groupBy(*keys).applyInPandasWithState(
        update, out, "classes array<string>, totals array<double>, counts array<long>, waiting binary", "append", "EventTimeTimeout" if ts else "NoTimeout")
