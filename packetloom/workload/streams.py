"""Structured Streaming queries, run to completion over what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.session import scratch_path
from packetloom.streaming import packets as K
from packetloom.workload.labels import TIME_SQL, _time_intervals
from packetloom.workload.tables import complex_cells, q6, r6, table


def _event_stream(spark, sf, landing=None):
    reader = spark.readStream.schema(table(spark, sf, "events").schema)
    raw = reader.parquet(landing) if landing else reader.option("pathGlobFilter", "events.parquet").parquet(sf)
    return raw.withColumn("event_time", F.col("ts").cast("timestamp")).withColumn(
        "recording_id", F.col("user_id").cast("string")).withColumn("valid", F.col("value") > 20)


def _week_by_week(spark, sf, name):
    """Lets the events arrive in weeks: yields the stream over what is there after each, so that every
    run over one checkpoint is a micro-batch of its own.  The weeks of the calendar are few."""
    landing, events = scratch_path(spark, name), table(spark, sf, "events")
    week = F.date_trunc("week", F.col("ts").cast("timestamp"))
    for row in events.select(week.alias("week")).distinct().orderBy("week").collect():
        events.where(week == F.lit(row["week"])).write.mode("append").parquet(landing)
        yield _event_stream(spark, sf, landing)


def _drain(spark, stream, name, out=None):
    """Run a stream over all present input into files and read them."""
    out = out or scratch_path(spark, name)
    query = (stream.writeStream.format("parquet").option("path", f"{out}/data")
             .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def stream_windows(spark, sf):
    windows = K.stream_windows(_event_stream(spark, sf), "6 hours", "1 hour", keys=["event_type"])
    rows = _drain(spark, windows, "windows")
    return rows.select("event_type", F.unix_micros("window_start").alias("start_us"), "packets",
                       r6("valid_fraction").alias("valid_fraction"))


WINDOWS_SQL = f"""
WITH w AS (SELECT event_type, epoch_us(ts) // 21600000000 * 21600000000 AS start_us, count(*) AS packets,
                  {q6('avg(CASE WHEN value > 20 THEN 1 ELSE 0 END)')} AS valid_fraction FROM events GROUP BY 1, 2)
SELECT event_type, CAST(start_us AS BIGINT) AS start_us, packets, valid_fraction FROM w
WHERE start_us + 21600000000 <= (SELECT max(epoch_us(ts)) - 3600000000 FROM events)"""


def stream_dedupe(spark, sf):
    """Repeats of a slot lie within an hour, so two hours of state are enough; older state goes."""
    hour, out = F.date_trunc("hour", "event_time"), scratch_path(spark, "unique")
    for stream in _week_by_week(spark, sf, "landing"):
        slots = stream.withColumn("slot", F.unix_micros(hour)).select("recording_id", "slot", "event_time")
        unique = _drain(spark, K.stream_dedupe(slots, ["recording_id", "slot"], "2 hours"), "unique", out)
    return unique.select("recording_id", "slot")


def stream_packets(spark, sf):
    path = scratch_path(spark, "packets")
    cell = lambda s, l: F.struct(
        F.get("embedding", s * 4 + l).cast("double").alias("r"),
        F.get("embedding", s * 4 + l + 32).cast("double").alias("i"))
    csi = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda s: F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda l: cell(s, l)))
    table(spark, sf, "embeddings").select(F.col("vec_id").cast("double").alias("t"), csi.alias("csi")).write.json(path)
    rows = _drain(spark, K.stream_packets(spark, path, files_per_trigger=2), "ingest")
    return complex_cells(rows, F.col("timestamp_s").cast("long").alias("vec_id"), "links", "subcarriers", "packet_error")


def stream_capture(spark, sf):
    hours = (F.unix_micros("event_time") / F.lit(3.6e9)).alias("timestamp_s")
    out = scratch_path(spark, "capture")
    for events in _week_by_week(spark, sf, "landing"):
        stream = events.select("recording_id", F.col("event_id").alias("source_order"), hours)
        K.stream_capture_intervals(stream, _time_intervals(spark, sf), 40, f"{out}/data", f"{out}/checkpoint",
                                   row_id="source_order", width=24.0).awaitTermination()
    return spark.read.parquet(f"{out}/data").select("recording_id", "source_order", "label")


QUERIES = {"stream_windows": stream_windows, "stream_dedupe": stream_dedupe, "stream_packets": stream_packets,
           "stream_capture_intervals": stream_capture}
SQL = {
    "stream_windows": WINDOWS_SQL,
    "stream_dedupe": """SELECT DISTINCT CAST(user_id AS VARCHAR) AS recording_id,
        CAST(epoch_us(ts) // 3600000000 * 3600000000 AS BIGINT) AS slot FROM events""",
    "stream_packets": f"""SELECT vec_id, 4 AS links, 8 AS subcarriers, CAST(NULL AS VARCHAR) AS packet_error,
        CAST(i AS INT) AS pos, {q6('embedding[(i % 8) * 4 + i // 8 + 1]')} AS re,
        {q6('embedding[32 + (i % 8) * 4 + i // 8 + 1]')} AS im FROM embeddings, range(32) t(i)""",
    "stream_capture_intervals": f"""WITH {TIME_SQL} SELECT recording_id, source_order, label FROM tag
        QUALIFY row_number() OVER (PARTITION BY label ORDER BY timestamp_s, recording_id, source_order) <= 40""",
}
