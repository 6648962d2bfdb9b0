"""Structured Streaming forms of ingest, cleaning, windows and interval capture."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetloom.operators.ordered import explode_range
from packetloom.operators.sampling import head_per_group
from packetloom.sources.text import PACKET_SCHEMA, json_packets


def stream_packets(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Packet JSON Lines as they arrive; files seen once are not read again."""
    reader = spark.readStream.schema(PACKET_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    raw = reader.json(path).withColumn("recording_id", F.col("_metadata.file_path"))
    return json_packets(raw)


def stream_dedupe(stream: DataFrame, keys: Sequence[str], delay: str, event_time: str = "event_time"
                  ) -> DataFrame:
    """The first packet per key; its state is dropped once the watermark has passed."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_windows(stream: DataFrame, width: str, delay: str, keys: Sequence[str] = ("recording_id",),
                   event_time: str = "event_time") -> DataFrame:
    """Tumbling windows with packet counts and valid fraction.

    A window comes out when the watermark has passed it; later packets are dropped.
    """
    return (stream.withWatermark(event_time, delay)
            .groupBy(*keys, F.window(event_time, width).alias("_w"))
            .agg(F.count(F.lit(1)).alias("packets"),
                 F.avg(F.col("valid").cast("int")).alias("valid_fraction"))
            .select(*keys, F.col("_w.start").alias("window_start"),
                    F.col("_w.end").alias("window_end"), "packets", "valid_fraction"))


def tag_stream(stream: DataFrame, intervals: DataFrame, keys: Sequence[str], time: str,
               width: float) -> DataFrame:
    """Stream-static interval join on time buckets; ties go to the first interval declared.

    A row with several matches comes out once per match; ``stream_capture_intervals`` keeps the
    first of them inside each micro-batch.
    """
    pieces = explode_range(
        intervals.select(*[F.col(k).alias(f"_i_{k}") for k in keys], "interval_order",
                         "start_seconds", "end_seconds", "label"),
        F.floor(F.col("start_seconds") / width).cast("long"),
        F.floor(F.col("end_seconds") / width).cast("long"), "_i_bucket")
    rows = stream.withColumn("_bucket", F.floor(F.col(time) / F.lit(width)).cast("long"))
    cond = [F.col(k) == F.col(f"_i_{k}") for k in keys] + [
        F.col("_bucket") == F.col("_i_bucket"),
        F.col(time).between(F.col("start_seconds"), F.col("end_seconds"))]
    return rows.join(pieces, cond).drop("_bucket", "_i_bucket", "start_seconds", "end_seconds",
                                        *[f"_i_{k}" for k in keys])


def capture_batch(batch: DataFrame, batch_id: int, cap: int, out: str, keys: Sequence[str] = ("recording_id",),
                  time: str = "timestamp_s", row_id: str = "packet_index") -> None:
    """Write what micro-batch ``batch_id`` of tagged packets adds to ``out/batch_id=<n>``.

    ``<out>_counts/batch_id=<n>`` holds how many packets each label has after the batch: one row per
    label, made from the counts after the batch before and the batch's own rows, so the work does
    not grow with the number of batches.  A batch that runs again replaces its two folders and,
    as it starts from the same counts, writes the same rows.
    """
    spark, counts = batch.sparkSession, f"{out.rstrip('/')}_counts"
    first = batch.groupBy(*keys, row_id).agg(
        F.min_by(F.struct(*[c for c in batch.columns if c not in (*keys, row_id)]),
                 "interval_order").alias("_row")).select(*keys, row_id, "_row.*")
    ranked = head_per_group(first, ["label"], cap, [time, *keys, row_id])
    before = None
    if batch_id > 0:
        before = spark.read.schema("label string, taken long").parquet(f"{counts}/batch_id={batch_id - 1}")
        known = before.select(F.col("label").alias("_label"), F.col("taken").alias("_taken"))
        # at most cap rows per label are left here, so this rank is small
        w = Window.partitionBy("label").orderBy(time, *keys, row_id)
        ranked = (ranked.join(known, F.col("label").eqNullSafe(F.col("_label")), "left").withColumn("_rn", F.row_number().over(w))
                  .where(F.col("_rn") + F.coalesce("_taken", F.lit(0)) <= cap)
                  .drop("_rn", "_label", "_taken"))
    ranked.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    own = spark.read.schema("label string").parquet(f"{out}/batch_id={batch_id}").select("label", F.lit(1).cast("long").alias("taken"))
    both = own.unionByName(before) if before is not None else own
    both.groupBy("label").agg(F.sum("taken").alias("taken")).write.mode("overwrite").parquet(
        f"{counts}/batch_id={batch_id}")


def stream_capture_intervals(stream: DataFrame, intervals: DataFrame, cap: int, out: str,
                             checkpoint: str, keys: Sequence[str] = ("recording_id",),
                             time: str = "timestamp_s", row_id: str = "packet_index",
                             width: float = 60.0):
    """Start a query that keeps at most ``cap`` packets per label, one ``capture_batch`` each."""
    tagged = tag_stream(stream, intervals, keys, time, width)
    return (tagged.writeStream.foreachBatch(lambda batch, n: capture_batch(batch, n, cap, out, keys, time, row_id))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
