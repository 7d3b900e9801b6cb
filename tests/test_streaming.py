from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from inkprint.operators.parse import extract_folder
from inkprint.plans.scoring import running_average
from inkprint.streaming.ingest import ingest_stream
from inkprint.streaming.score import running_batches, running_stream, score_stream


def rows(spark, n, start=0):
    """Conversation 0 holds most of the rows."""
    return spark.range(start, n).select(
        F.when(F.col("id") % 5 < 4, 0).otherwise(F.col("id") % 3).alias("chat_id"), F.col("id").alias("pos"),
        (F.col("id") % 2).cast("int").alias("user"), (F.col("id") % 10).cast("double").alias("p"))


def key(df):
    return sorted(tuple(r) for r in df.select("chat_id", "pos", "user", "average").collect())


def test_stream_equals_batch(spark, tmp_path):
    home = str(tmp_path)
    for start, end in ((0, 100), (100, 250), (250, 300)):
        rows(spark, end, start).write.mode("append").parquet(f"{home}/in")
        stream = spark.readStream.schema(rows(spark, 1).schema).parquet(f"{home}/in")
        score_stream(stream, lambda b: b, f"{home}/out", f"{home}/state", f"{home}/cp").awaitTermination()
    assert key(spark.read.parquet(f"{home}/out")) == key(running_average(rows(spark, 300)))


def test_repeated_batch_changes_nothing(spark, tmp_path):
    write = running_batches(f"{tmp_path}/out", f"{tmp_path}/state")
    for epoch, (start, end) in enumerate([(0, 60), (60, 120)]):
        for _ in range(2):  # the second call is what a restart after a failure does
            write(rows(spark, end, start), epoch)
    assert key(spark.read.parquet(f"{tmp_path}/out")) == key(running_average(rows(spark, 120)))


def test_ingest_new_files(spark, tmp_path):
    folder, out, cp = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/cp"
    folder.mkdir()
    for i in range(2):
        (folder / f"{i}.txt").write_text(f"01/02/2024, 10:0{i} - Ann: hi {i}\nmore\n01/02/2024, 10:0{i} - Bob: yo\n")
        ingest_stream(spark, str(folder), out, cp).awaitTermination()
        assert spark.read.parquet(out).count() == 2 * (i + 1)
    (folder / "bad.txt").write_text("not an export\n")
    ingest_stream(spark, str(folder), out, cp).awaitTermination()
    got = spark.read.parquet(out).select("author", "body").collect()
    (folder / "bad.txt").unlink()
    assert sorted(map(tuple, got)) == sorted(
        map(tuple, extract_folder(spark, str(folder)).select("author", "body").collect()))


def test_lost_or_unfinished_state_is_an_error(spark, tmp_path):
    write = running_batches(f"{tmp_path}/out", f"{tmp_path}/state")
    for epoch in range(3):
        write(rows(spark, 20 * epoch + 20, 20 * epoch), epoch)
    assert sorted(p.name for p in (tmp_path / "state").iterdir()) == ["0000000001", "0000000002"]
    with pytest.raises(FileNotFoundError):
        write(rows(spark, 100, 80), 4)
    (tmp_path / "state/0000000002/_SUCCESS").unlink()
    with pytest.raises(FileNotFoundError):
        write(rows(spark, 80, 60), 3)


def deliver(spark, home, rows_, schema, **kwargs):
    """One more delivery, and a run of the query until all of it is taken."""
    rows_.write.mode("append").parquet(f"{home}/in")
    stream = spark.readStream.schema(schema).parquet(f"{home}/in")
    running_stream(stream, **kwargs).writeStream.outputMode("append").format("parquet").option("path", f"{home}/out") \
        .option("checkpointLocation", f"{home}/cp").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{home}/out")


def test_state_store_survives_a_restart(spark, tmp_path):
    schema = rows(spark, 1).schema
    deliver(spark, str(tmp_path), rows(spark, 130), schema)
    out = deliver(spark, str(tmp_path), rows(spark, 300, 130), schema)
    assert key(out) == key(running_average(rows(spark, 300)))


def test_late_rows_take_their_place(spark, tmp_path):
    """Rows at minute m; those of minutes 5 and 9 come one delivery late, that of minute 1 after the watermark has passed it."""
    def at(*minutes):
        return spark.createDataFrame([("c", 1, m, float(m), 1_700_000_000 + 60 * m) for m in minutes], "chat_id string, user int, pos int, p double, s long") \
            .withColumn("ts", F.timestamp_seconds("s")).drop("s")

    schema, home = at(1).schema, str(tmp_path)
    out = deliver(spark, home, at(0, 2, 6, 8), schema, ts="ts", delay="4 minutes")
    assert [r["pos"] for r in out.orderBy("pos").collect()] == [0, 2]  # the watermark is at minute 4
    out = deliver(spark, home, at(5, 9, 1, 16), schema, ts="ts", delay="4 minutes")
    out = deliver(spark, home, at(40), schema, ts="ts", delay="4 minutes")
    got = [(r["pos"], r["average"]) for r in out.orderBy("pos").collect()]
    seen = [0, 2, 5, 6, 8, 9, 16]
    assert got == [(m, sum(seen[:k + 1]) / (k + 1)) for k, m in enumerate(seen)]


def test_state_is_kept_by_conversation(spark, tmp_path):
    """One state, and so one call, holds all classes of a conversation, be they numbers, texts or null."""
    for kind, name in (("int", lambda k: None if k == 3 else k), ("string", lambda k: None if k == 3 else f"c{k}")):
        data = [(k % 4, name(k // 4 % 6), -k, float(k % 7)) for k in range(240)]
        frame = spark.createDataFrame(data, f"chat_id int, user {kind}, pos int, p double")
        home = f"{tmp_path}/{kind}"
        # positions fall, so the second delivery (of higher ones) follows all of the first
        deliver(spark, home, frame.where("pos < -100"), frame.schema)
        out = deliver(spark, home, frame.where("pos >= -100"), frame.schema)
        expected, sums = {}, {}
        for chat, user, pos, p in sorted(data, key=lambda r: r[2]):
            total, n = sums.get((chat, user), (0.0, 0))
            sums[chat, user] = total + p, n + 1
            expected[chat, pos] = user, (total + p) / (n + 1)
        assert {(r["chat_id"], r["pos"]): (r["user"], r["average"]) for r in out.collect()} == expected
        assert spark.read.format("statestore").load(f"{home}/cp").count() == 4  # not 24


def test_state_of_null_values(spark, tmp_path):
    data = spark.createDataFrame([(1, 0, 1, None), (1, 0, 2, 4.0), (None, None, 1, 2.0), (1, 0, 3, None)], "chat_id int, user int, pos int, p double")
    out = deliver(spark, str(tmp_path), data, data.schema)
    got = {(r["chat_id"], r["pos"]): r["average"] for r in out.collect()}
    assert got[1, 2] == 4 and got[1, 3] == 4 and got[None, 1] == 2 and (got[1, 1] is None or got[1, 1] != got[1, 1])


@pytest.mark.parametrize("files", [1, 3])
def test_a_table_as_a_stream_be_it_a_file_or_a_folder(spark, tmp_path, files):
    from inkprint.catalog.scoring import _stream
    home = str(tmp_path)
    rows(spark, 30).coalesce(files).write.parquet(f"{home}/made")
    rows(spark, 7).write.parquet(f"{home}/d/other.parquet")
    parts = sorted((tmp_path / "made").glob("part-*.parquet"))
    if files == 1:
        (tmp_path / "d" / "events.parquet").write_bytes(parts[0].read_bytes())
    else:
        rows(spark, 30).repartition(files).write.parquet(f"{home}/d/events.parquet")
    _stream(spark, f"{home}/d", "events").writeStream.format("parquet").option("path", f"{home}/out") \
        .option("checkpointLocation", f"{home}/cp").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(rows(spark, 1).schema).parquet(f"{home}/out")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows(spark, 30).collect()))
