import datetime as dt

from pyspark.sql import functions as F

from packetloom.streaming import packets as K

SCHEMA = "recording_id string, packet_index long, timestamp_s double"


def test_capture_counts_over_batches(spark, folder):
    """The cap holds over micro-batches, and a batch that runs again replaces itself."""
    source = folder / "in"
    for part in range(4):
        spark.createDataFrame([("r", part * 10 + i, float(part * 10 + i)) for i in range(10)], SCHEMA).coalesce(
            1).write.mode("append").parquet(str(source))
    iv = spark.createDataFrame([("r", 0, 0.0, 100.0, "a"), ("r", 1, 20.0, 30.0, "b")],
                               "recording_id string, interval_order long, start_seconds double, end_seconds double, label string")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
    query = K.stream_capture_intervals(stream, iv, 25, str(folder / "out"), str(folder / "check"), width=7.0)
    query.awaitTermination()
    rows = spark.read.parquet(str(folder / "out"))
    assert rows.count() == 25 and {r["label"] for r in rows.select("label").distinct().collect()} == {"a"}
    assert rows.select("packet_index").distinct().count() == 25
    assert rows.select("batch_id").distinct().count() >= 3


def test_capture_batch_runs_again_from_the_counts_before(spark, folder):
    out = folder / "out"
    schema = SCHEMA + ", interval_order long, label string"
    for n in range(4):
        rows = [("r", n * 10 + i, float(n * 10 + i), 0, "a" if i % 2 else None) for i in range(10)]
        K.capture_batch(spark.createDataFrame(rows, schema), n, 12, str(out))
    first = [sorted(map(tuple, spark.read.parquet(str(out / f"batch_id={n}")).collect()), key=str) for n in range(4)]
    assert [len(rows) for rows in first] == [10, 10, 4, 0]
    (out / "batch_id=0").rename(folder / "away")          # a batch needs no folder of earlier ones
    again = [("r", 20 + i, float(20 + i), 0, "a" if i % 2 else None) for i in range(10)]
    K.capture_batch(spark.createDataFrame(again, schema), 2, 12, str(out))
    assert sorted(map(tuple, spark.read.parquet(str(out / "batch_id=2")).collect()), key=str) == first[2]
    counts = spark.read.parquet(str(folder / "out_counts" / "batch_id=3")).collect()
    assert {r["label"]: r["taken"] for r in counts} == {"a": 12, None: 12}


def test_ingest_reads_new_files_only(spark, folder):
    source, out = folder / "in", folder / "out"
    source.mkdir()
    line = '{"t": %d, "csi": [[{"r": 1.0, "i": 2.0}]]}\n'

    def run():
        query = (K.stream_packets(spark, str(source)).writeStream.format("parquet").option("path", str(out))
                 .option("checkpointLocation", str(folder / "check")).trigger(availableNow=True).start())
        query.awaitTermination()
        return spark.read.parquet(str(out)).count()

    (source / "a.json").write_text(line % 1 + line % 2)
    assert run() == 2
    (source / "b.json").write_text(line % 3)
    assert run() == 3


def test_open_window_is_withheld(spark, folder):
    base = dt.datetime(2026, 1, 1)
    rows = [("r", base + dt.timedelta(seconds=10 * i), i % 2 == 0) for i in range(13)]
    spark.createDataFrame(rows, "recording_id string, event_time timestamp, valid boolean").write.parquet(str(folder / "in"))
    stream = spark.readStream.schema("recording_id string, event_time timestamp, valid boolean").parquet(str(folder / "in"))
    windows = K.stream_windows(stream, "1 minute", "0 seconds")
    query = (windows.writeStream.format("parquet").option("path", str(folder / "out"))
             .option("checkpointLocation", str(folder / "check")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = spark.read.parquet(str(folder / "out")).orderBy("window_start").collect()
    assert [(r["packets"], r["valid_fraction"]) for r in got] == [(6, 0.5), (6, 0.5)]


def test_dedupe(spark, folder):
    rows = [("r", 1, dt.datetime(2026, 1, 1)), ("r", 1, dt.datetime(2026, 1, 1)), ("r", 2, dt.datetime(2026, 1, 1))]
    schema = "recording_id string, slot int, event_time timestamp"
    spark.createDataFrame(rows, schema).write.parquet(str(folder / "in"))
    stream = K.stream_dedupe(spark.readStream.schema(schema).parquet(str(folder / "in")), ["recording_id", "slot"], "1 hour")
    query = (stream.writeStream.format("parquet").option("path", str(folder / "out"))
             .option("checkpointLocation", str(folder / "check")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.read.parquet(str(folder / "out")).agg(F.count("*")).first()[0] == 2
