"""The given tables seen as packets and recordings, and rounding both engines share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.operators.ordered import time_bucket, with_position


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def r6(c) -> Column:
    """Six decimals by plain double arithmetic, the same in every engine."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c.cast("double") * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def q6(expr: str) -> str:
    """``r6`` in SQL."""
    return f"floor(CAST({expr} AS DOUBLE) * 1e6 + 0.5) / 1e6"


def cells(df: DataFrame, column: str, *keys: str, exact: bool = False) -> DataFrame:
    """One row per array element: keys, ``pos``, ``x``."""
    rows = df.select(*keys, F.posexplode(column).alias("pos", "x"))
    return rows.withColumn("x", F.col("x") if exact else r6("x"))


def complex_cells(df: DataFrame, *keys) -> DataFrame:
    """One row per complex cell: keys, ``pos``, ``re``, ``im``; a packet without cells gives one row of NULLs."""
    rows = df.select(*keys, F.posexplode_outer(F.arrays_zip("csi_real", "csi_imag")).alias("pos", "_c"))
    return rows.withColumn("re", r6("_c.csi_real")).withColumn("im", r6("_c.csi_imag")).drop("_c")


def event_packets(spark: SparkSession, sf: str) -> DataFrame:
    """Events as packets: one recording per user, hours as its time unit, two channels."""
    ev = table(spark, sf, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("recording_id"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(3.6e9)).alias("timestamp_s"),
        F.col("event_id").alias("source_order"),
        F.array(F.col("value").cast("float"),
                F.get_json_object("props", "$.k").cast("float")).alias("csi_real"),
        F.array(F.get_json_object("props", "$.k").cast("float"),
                F.col("value").cast("float")).alias("csi_imag"),
        F.col("event_type").alias("source_label"),
        (F.col("value") > 1.0).alias("valid"))


EVENTS_SQL = """
ev AS (
  SELECT CAST(user_id AS VARCHAR) AS recording_id, epoch_us(ts) / 3.6e9 AS timestamp_s,
         event_id AS source_order, CAST(CAST(value AS FLOAT) AS DOUBLE) AS v,
         CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS DOUBLE) AS k,
         event_type AS source_label, value > 1.0 AS valid
  FROM events)"""


def indexed_events(spark: SparkSession, sf: str) -> DataFrame:
    """Event packets with ``packet_index`` in time order, ranked in buckets of two days."""
    ev = event_packets(spark, sf).withColumn("_bucket", time_bucket(width=48.0))
    return with_position(ev, ["recording_id"], ["timestamp_s", "source_order"], "_bucket").drop("_bucket")


INDEXED_SQL = EVENTS_SQL + """,
ix AS (
  SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY timestamp_s, source_order) - 1
         AS packet_index
  FROM ev)"""


def embedding_packets(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors as packets: the first half real, the second half imaginary."""
    em = table(spark, sf, "embeddings")
    half = F.call_function("div", F.size("embedding"), F.lit(2)).cast("int")
    return em.select("vec_id", "label", F.slice("embedding", F.lit(1), half).alias("csi_real"),
                     F.slice("embedding", half + 1, half).alias("csi_imag"))


IQ_SQL = """
iq AS (
  SELECT vec_id, label, i AS pos, CAST(embedding[i + 1] AS DOUBLE) AS re,
         CAST(embedding[i + 33] AS DOUBLE) AS im
  FROM embeddings, range(32) AS t(i))"""
FULL_SQL = """
full_cells AS (
  SELECT vec_id, label, i AS pos, CAST(embedding[i + 1] AS DOUBLE) AS x
  FROM embeddings, range(64) AS t(i))"""
