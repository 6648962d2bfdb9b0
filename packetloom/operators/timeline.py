"""Timelines: cleaning, source rates, synthesized and clock-text time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions.arrays import is_finite
from packetloom.operators.ordered import (
    SECONDS_PER_BUCKET, index_bucket, join_facts, time_bucket, with_change_count,
    with_neighbour)
from packetloom.operators.quantiles import exact_median
from packetloom.session import cut_lineage

RECORDING = ("recording_id",)
DAY_MS = 24 * 60 * 60 * 1000.0


def earliest_per_timestamp(df: DataFrame, keys: Sequence[str] = RECORDING,
                           time: str = "timestamp_s", source_order: str = "source_order") -> DataFrame:
    """Keep, of packets that share a timestamp, the one that came first in the source."""
    rest = [c for c in df.columns if c not in (*keys, time)]
    first = df.groupBy(*keys, time).agg(
        F.min_by(F.struct(*rest), source_order).alias("_first"))
    return first.select(*[F.col(f"_first.{c}").alias(c) if c in rest else F.col(c)
                          for c in df.columns])


def timeline_extent(df: DataFrame, keys: Sequence[str] = RECORDING,
                    time: str = "timestamp_s") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(time).alias("first_s"), F.max(time).alias("last_s"),
                                 F.count(F.lit(1)).alias("packets"))


def prepare_time(df: DataFrame, keys: Sequence[str] = RECORDING, time: str = "timestamp_s",
                 source_order: str = "source_order") -> DataFrame:
    """Finite, unique timestamps counted from the recording's first packet.

    Recordings left with fewer than two packets are not returned; ``short_recordings`` names them.
    """
    unique = earliest_per_timestamp(df.where(is_finite(F.col(time))), keys, time, source_order)
    # counted on the pruned input: only keys and time are read again
    extent = (df.where(is_finite(F.col(time))).select(*keys, time).distinct())
    extent = timeline_extent(extent, keys, time).where("packets >= 2").select(
        *keys, F.col("first_s").alias("_first_s"))
    joined = join_facts(unique, extent, list(keys), F.hash(time), how="inner")
    return joined.withColumn(time, F.col(time) - F.col("_first_s")).drop("_first_s")


def short_recordings(df: DataFrame, keys: Sequence[str] = RECORDING,
                     time: str = "timestamp_s") -> DataFrame:
    """Recordings without two unique finite timestamps, with the reason."""
    seen = df.select(*keys, F.when(is_finite(F.col(time)), F.col(time)).alias("_t")).distinct()
    return (seen.groupBy(*keys).agg(F.count("_t").alias("unique_timestamps"))
            .where("unique_timestamps < 2")
            .withColumn("error", F.lit("at least two unique timestamps are required")))


def packet_gaps(df: DataFrame, keys: Sequence[str] = RECORDING, time: str = "timestamp_s",
                order_by: Sequence[str] | None = None, bucket: Column | None = None) -> DataFrame:
    """Each packet's distance to the one before it (``gap_s``), NULL for the first."""
    thin = df.select(*dict.fromkeys([*keys, time, *(order_by or [])])).withColumn(
        "_bucket", bucket if bucket is not None else time_bucket(time))
    return (with_neighbour(thin, keys, list(order_by or [time]), "_bucket", [time], "_prev", step=-1)
            .withColumn("gap_s", F.col(time) - F.col(f"_prev.{time}")).drop("_prev", "_bucket"))


def source_rate(df: DataFrame, keys: Sequence[str] = RECORDING, time: str = "timestamp_s",
                order_by: Sequence[str] | None = None, bucket: Column | None = None,
                declared: DataFrame | None = None) -> DataFrame:
    """Packets per second from the median positive gap; a declared positive rate wins."""
    gaps = packet_gaps(df, keys, time, order_by, bucket)
    gaps = cut_lineage(gaps.where(is_finite(F.col("gap_s")) & (F.col("gap_s") > 0)).select(
        *keys, "gap_s"), "gaps")  # thin; the median reads it twice
    measured = exact_median(gaps, keys, F.col("gap_s"), "median_gap_s").withColumn(
        "measured_rate_hz", F.lit(1.0) / F.col("median_gap_s"))
    if declared is None:
        return measured.withColumn("source_rate_hz", F.col("measured_rate_hz"))
    stated = declared.select(*keys, F.col("sample_rate_hz").alias("_stated"))
    return (stated.join(measured, list(keys), "full_outer")
            .withColumn("source_rate_hz", F.coalesce(
                F.when(F.col("_stated") > 0, F.col("_stated")), "measured_rate_hz"))
            .drop("_stated"))


def span_rate(df: DataFrame, nominal_hz: float | None, keys: Sequence[str] = RECORDING,
              time: str = "timestamp_s", order_by: Sequence[str] = ("packet_index",),
              bucket: Column | None = None) -> DataFrame:
    """(n-1)/(last-first) where time never runs backwards and moves at all, else the nominal rate."""
    gaps = packet_gaps(df, keys, time, order_by,
                       bucket if bucket is not None else index_bucket(order_by[0]))
    facts = gaps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("packets"),
        (F.max(time) - F.min(time)).alias("span_s"),
        F.coalesce(F.bool_and(F.col("gap_s") >= 0), F.lit(True)).alias("in_order"))
    return facts.withColumn("rate_hz", F.when(
        F.col("in_order") & (F.col("span_s") > 0), (F.col("packets") - 1) / F.col("span_s")
    ).otherwise(F.lit(nominal_hz).cast("double")))


def rate_from_config(config_value: Column, path: Column, default_hz: float = 10.0) -> Column:
    """A configured rate, else ``FrameRate<n>`` in the path, else the default."""
    configured = config_value.try_cast("double")
    in_path = F.regexp_extract(path, r"(?i)framerate(\d+(?:\.\d+)?)", 1).try_cast("double")
    return F.coalesce(F.when(configured != 0, configured), F.when(in_path != 0, in_path),
                      F.lit(default_hz))


def fixed_clip_rate(packets: Column, clip_s: float) -> Column:
    """Effective rate of a clip of known length from which packets may be missing."""
    return packets.cast("double") / F.lit(clip_s)


def synth_time(df: DataFrame, rate: Column, index: str = "packet_index",
               out: str = "timestamp_s") -> DataFrame:
    return df.withColumn(out, F.col(index).cast("double") / rate)


def clock_ms(text: Column) -> Column:
    """``HH:MM:SS.mmm`` as milliseconds of the day."""
    part = F.split(text, ":")
    return (F.get(part, F.lit(0)).cast("int") * 3600 + F.get(part, F.lit(1)).cast("int") * 60
            + F.get(part, F.lit(2)).cast("double")) * 1000.0


def elapsed_ms(df: DataFrame, clock: str, keys: Sequence[str] = RECORDING,
               index: str = "packet_index", out: str = "elapsed_ms") -> DataFrame:
    """Clock text as milliseconds since the first packet; stepping backwards is a new day."""
    thin = df.select(*keys, index, clock_ms(F.col(clock)).alias("_ms"),
                     index_bucket(index).alias("_bucket"))
    rows = with_change_count(thin, keys, [index], "_bucket", ["_ms"],
                             lambda prev, own: own["_ms"] < prev["_ms"], "_days")
    rows = rows.withColumn("_abs", F.col("_ms") + F.col("_days") * F.lit(DAY_MS))
    # the first packet has seen no new day yet, so its clock is the start
    start = thin.groupBy(*keys).agg(F.min_by("_ms", index).alias("_start"))
    rows = join_facts(rows, start, list(keys), F.col(index)).select(
        *keys, index, (F.col("_abs") - F.col("_start")).alias(out))
    return df.join(rows, [*keys, index], "left") if set(df.columns) - {*keys, index} else rows


__all__ = [
    "DAY_MS", "RECORDING", "SECONDS_PER_BUCKET", "clock_ms", "earliest_per_timestamp",
    "elapsed_ms", "fixed_clip_rate", "packet_gaps", "prepare_time", "rate_from_config",
    "short_recordings", "source_rate", "span_rate", "synth_time", "timeline_extent",
]
