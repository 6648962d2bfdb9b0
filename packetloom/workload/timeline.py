"""Queries over timelines and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.operators import resample as R
from packetloom.operators import timeline as TL
from packetloom.operators import windows as W
from packetloom.operators.ordered import index_bucket, time_bucket
from packetloom.session import cut_lineage
from packetloom.workload.tables import (
    EVENTS_SQL, INDEXED_SQL, event_packets, indexed_events, q6, r6, table)

HOURS = 48.0  # bucket width of the event timeline


def prepare_time(spark, sf):
    li = table(spark, sf, "lineitem")
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    packets = li.select(F.col("l_orderkey").alias("recording_id"),
                        F.col("l_linenumber").cast("double").alias("timestamp_s"),
                        F.struct(*order).alias("source_order"), *order)
    out = TL.prepare_time(packets)
    return out.select("recording_id", "timestamp_s", "l_partkey", "l_suppkey", "l_extendedprice")


PREPARE_SQL = """
WITH first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey,
             l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) AS rn
    FROM lineitem) WHERE rn = 1),
spans AS (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n,
         min(l_linenumber) OVER (PARTITION BY l_orderkey) AS t0
  FROM first)
SELECT l_orderkey AS recording_id, CAST(l_linenumber - t0 AS DOUBLE) AS timestamp_s, l_partkey,
       l_suppkey, l_extendedprice
FROM spans WHERE n >= 2"""


def short_recordings(spark, sf):
    li = table(spark, sf, "lineitem")
    packets = li.select(F.col("l_orderkey").alias("recording_id"),
                        F.col("l_linenumber").cast("double").alias("timestamp_s"))
    return TL.short_recordings(packets)


SHORT_SQL = """
SELECT l_orderkey AS recording_id, count(DISTINCT l_linenumber) AS unique_timestamps,
       'at least two unique timestamps are required' AS error
FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) < 2"""


def cleaned_events(spark, sf):
    return cut_lineage(TL.prepare_time(event_packets(spark, sf)), "cleaned")


CLEAN_SQL = EVENTS_SQL + """,
clean AS (
  SELECT recording_id, timestamp_s - min(timestamp_s) OVER (PARTITION BY recording_id) AS t, v, k
  FROM (SELECT *, row_number() OVER (PARTITION BY recording_id, timestamp_s ORDER BY source_order) AS rn
        FROM ev)
  WHERE rn = 1 QUALIFY count(*) OVER (PARTITION BY recording_id) >= 2),
nx AS (
  SELECT *, lead(t) OVER w AS t2, lead(v) OVER w AS v2, lead(k) OVER w AS k2
  FROM clean WINDOW w AS (PARTITION BY recording_id ORDER BY t)),
len AS (
  SELECT recording_id, CAST(greatest(1, round_even((max(t) + 1.0) * 1.0, 0)) AS BIGINT) AS n,
         median(t2 - t) AS gap
  FROM nx GROUP BY 1),
pts AS (SELECT recording_id, gap, unnest(generate_series(0, n - 1)) AS g FROM len),
grid AS (
  SELECT p.recording_id, p.gap, p.g, CAST(p.g AS DOUBLE) AS x, nx.t, nx.t2,
         CAST(CAST(CASE WHEN nx.t2 IS NULL THEN v ELSE (v2 - v) / (t2 - t) * (p.g - t) + v END
              AS FLOAT) AS DOUBLE) AS a,
         CAST(CAST(CASE WHEN nx.t2 IS NULL THEN k ELSE (k2 - k) / (t2 - t) * (p.g - t) + k END
              AS FLOAT) AS DOUBLE) AS b
  FROM (SELECT *, CAST(g AS DOUBLE) AS gx FROM pts) p
  ASOF JOIN nx ON p.recording_id = nx.recording_id AND p.gx >= nx.t)"""


def resample_time(spark, sf):
    grid = R.resample_time(cleaned_events(spark, sf), 1.0, bucket_s=HOURS)
    return grid.select("recording_id", "packet_index", "timestamp_s",
                       r6(F.get("csi_real", F.lit(0))).alias("a"),
                       r6(F.get("csi_real", F.lit(1))).alias("b"))


RESAMPLE_SQL = f"""WITH {CLEAN_SQL}
SELECT recording_id, g AS packet_index, x AS timestamp_s, {q6('a')} AS a, {q6('b')} AS b FROM grid"""


def mark_valid(spark, sf):
    grid = R.standard_grid(cleaned_events(spark, sf), 1.0, bucket_s=HOURS)
    return grid.select("recording_id", "packet_index", "valid",
                       r6(F.get("csi_real", F.lit(0))).alias("a"),
                       r6(F.get("amplitude", F.lit(1))).alias("amplitude"))


VALID_SQL = f"""WITH {CLEAN_SQL},
ok AS (
  SELECT *, (t2 IS NOT NULL OR x <= t)
         AND least(x - t, coalesce(t2 - x, x - t)) <= greatest(1.5, 1.5 * gap) AS valid FROM grid)
SELECT recording_id, g AS packet_index, valid,
       {q6('CASE WHEN valid THEN a ELSE 0 END')} AS a,
       {q6('CASE WHEN valid THEN CAST(sqrt(a * a + b * b) AS FLOAT) ELSE 0 END')} AS amplitude
FROM ok"""


def valid_fraction(spark, sf):
    grid = R.resample_time(cleaned_events(spark, sf), 1.0, duration_s=900.0, bucket_s=HOURS)
    gaps = R.median_gap(cleaned_events(spark, sf), bucket_s=HOURS)
    marked = R.mark_valid(grid, gaps, 1.0)
    return marked.groupBy("recording_id").agg(
        F.count(F.lit(1)).alias("packets"),
        r6(F.avg(F.col("valid").cast("int"))).alias("valid_fraction"))


FRACTION_SQL = f"""WITH {CLEAN_SQL.replace('round_even((max(t) + 1.0) * 1.0, 0)', 'round_even(900.0 * 1.0, 0)')}
SELECT recording_id, count(*) AS packets, {q6('''avg(CASE WHEN (t2 IS NOT NULL OR x <= t)
   AND least(x - t, coalesce(t2 - x, x - t)) <= greatest(1.5, 1.5 * gap) THEN 1 ELSE 0 END)''')}
   AS valid_fraction
FROM grid GROUP BY 1"""


def source_rate(spark, sf):
    declared = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("recording_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey").cast("double")
               ).alias("sample_rate_hz"))
    users = event_packets(spark, sf).select("recording_id").distinct()
    rate = TL.source_rate(event_packets(spark, sf), bucket=time_bucket(width=HOURS),
                          declared=declared.join(users, "recording_id", "left_semi"))
    return rate.select("recording_id", r6("median_gap_s").alias("median_gap_s"),
                       r6("source_rate_hz").alias("source_rate_hz"))


RATE_SQL = f"""WITH {EVENTS_SQL},
gaps AS (
  SELECT recording_id, timestamp_s - lag(timestamp_s) OVER (
           PARTITION BY recording_id ORDER BY timestamp_s) AS gap FROM ev),
med AS (SELECT recording_id, median(gap) AS gap FROM gaps WHERE gap > 0 GROUP BY 1),
stated AS (
  SELECT CAST(c_custkey AS VARCHAR) AS recording_id,
         CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey > 0 THEN CAST(c_nationkey AS DOUBLE) END AS hz
  FROM customer WHERE CAST(c_custkey AS VARCHAR) IN (SELECT recording_id FROM ev))
SELECT recording_id, {q6('gap')} AS median_gap_s, {q6('coalesce(hz, 1.0 / gap)')} AS source_rate_hz
FROM stated FULL OUTER JOIN med USING (recording_id)"""


def span_rate(spark, sf):
    rate = TL.span_rate(event_packets(spark, sf), 0.25, order_by=["source_order"],
                        bucket=index_bucket("source_order", 100_000))
    backwards = TL.span_rate(
        table(spark, sf, "orders").select(
            F.concat(F.lit("c"), "o_custkey").alias("recording_id"),
            (F.unix_micros(F.col("o_orderdate").cast("timestamp")) / F.lit(8.64e10)).alias("timestamp_s"),
            F.col("o_orderkey").alias("packet_index")), 1600.0)
    both = rate.unionByName(backwards)
    return both.select("recording_id", "packets", r6("span_s").alias("span_s"), "in_order",
                       r6("rate_hz").alias("rate_hz"))


SPAN_SQL = f"""WITH {EVENTS_SQL},
rows AS (
  SELECT recording_id, timestamp_s, source_order AS o, 0.25 AS nominal FROM ev
  UNION ALL
  SELECT 'c' || o_custkey, epoch_us(o_orderdate) / 8.64e10, o_orderkey, 1600.0 FROM orders),
gaps AS (
  SELECT *, timestamp_s - lag(timestamp_s) OVER (PARTITION BY recording_id ORDER BY o) AS gap FROM rows),
facts AS (
  SELECT recording_id, count(*) AS packets, max(timestamp_s) - min(timestamp_s) AS span_s,
         coalesce(bool_and(gap >= 0), true) AS in_order, max(nominal) AS nominal
  FROM gaps GROUP BY 1)
SELECT recording_id, packets, {q6('span_s')} AS span_s, in_order,
       {q6('CASE WHEN in_order AND span_s > 0 THEN (packets - 1) / span_s ELSE nominal END')} AS rate_hz
FROM facts"""


def rate_fallback(spark, sf):
    docs = table(spark, sf, "documents")
    config = F.when(F.col("lang") == "en", F.col("n_chars").cast("string")).when(
        F.col("lang") == "fr", F.lit("n/a"))
    path = F.when(F.col("source") == F.lit("src1"), F.col("source")).otherwise(
        F.concat("source", F.lit("/FrameRate"), F.col("n_chars").cast("string"), F.lit(".5/x")))
    rows = docs.select("doc_id", F.col("doc_id").alias("packet_index"),
                       TL.rate_from_config(config, path).alias("rate_hz"),
                       TL.fixed_clip_rate(F.col("n_chars"), 3.0).alias("clip_rate"))
    rows = TL.synth_time(rows, F.col("rate_hz"))
    return rows.select("doc_id", r6("rate_hz").alias("rate_hz"), r6("clip_rate").alias("clip_rate"),
                       r6("timestamp_s").alias("timestamp_s"))


FALLBACK_SQL = f"""
WITH c AS (
  SELECT doc_id, n_chars,
         CASE WHEN lang = 'en' THEN CAST(n_chars AS VARCHAR) WHEN lang = 'fr' THEN 'n/a' END AS config,
         CASE WHEN source = 'src1' THEN source ELSE source || '/FrameRate' || n_chars || '.5/x' END AS path
  FROM documents),
r AS (
  SELECT doc_id, n_chars, coalesce(nullif(TRY_CAST(config AS DOUBLE), 0),
         nullif(TRY_CAST(regexp_extract(path, '(?i)framerate([0-9]+(?:[.][0-9]+)?)', 1) AS DOUBLE), 0),
         10.0) AS rate_hz FROM c)
SELECT doc_id, {q6('rate_hz')} AS rate_hz, {q6('n_chars / 3.0::DOUBLE')} AS clip_rate,
       {q6('doc_id / rate_hz')} AS timestamp_s
FROM r"""


def elapsed_ms(spark, sf):
    packets = indexed_events(spark, sf).select(
        "recording_id", "packet_index", F.date_format(
            F.timestamp_micros(F.rint(F.col("timestamp_s") * F.lit(3.6e9)).cast("long")),
            "HH:mm:ss.SSS").alias("clock"))
    return TL.elapsed_ms(cut_lineage(packets, "clock"), "clock").select(
        "recording_id", "packet_index", "clock", r6("elapsed_ms").alias("elapsed_ms"))


ELAPSED_SQL = f"""WITH {INDEXED_SQL},
c AS (
  SELECT recording_id, packet_index, strftime(make_timestamp(
           CAST(round_even(timestamp_s * 3.6e9, 0) AS BIGINT)), '%H:%M:%S.%g') AS clock FROM ix),
m AS (
  SELECT *, (CAST(split_part(clock, ':', 1) AS INT) * 3600 + CAST(split_part(clock, ':', 2) AS INT) * 60
             + CAST(split_part(clock, ':', 3) AS DOUBLE)) * 1000.0::DOUBLE AS ms FROM c),
p AS (
  SELECT *, CASE WHEN ms < lag(ms) OVER (PARTITION BY recording_id ORDER BY packet_index)
            THEN 1 ELSE 0 END AS roll FROM m),
d AS (
  SELECT *, ms + 86400000.0::DOUBLE * sum(roll) OVER (PARTITION BY recording_id ORDER BY packet_index) AS a FROM p)
SELECT recording_id, packet_index, clock,
       {q6('a - first_value(a) OVER (PARTITION BY recording_id ORDER BY packet_index)')} AS elapsed_ms
FROM d"""


def _lengths(spark, sf, target=None):
    n = event_packets(spark, sf).groupBy("recording_id").agg(
        F.count(F.lit(1)).alias("source_length"))
    m = R.rate_converted_length(F.col("source_length"), F.lit(3.0), F.lit(2.0))
    return n.withColumn("target_length", F.lit(target).cast("long") if target else m)


LENGTHS_SQL = INDEXED_SQL + """,
len AS (
  SELECT recording_id, count(*) AS n,
         CAST(greatest(1, round_even(count(*) * 2.0::DOUBLE / 3.0, 0)) AS BIGINT) AS m
  FROM ev GROUP BY 1),
tgt AS (SELECT recording_id, n, m, unnest(generate_series(0, m - 1)) AS j FROM len)"""


def resample_linear(spark, sf):
    packets = cut_lineage(indexed_events(spark, sf), "indexed")
    out = R.resample_index(packets, _lengths(spark, sf), "linear", signals=["csi_real"],
                           others=["source_label", "valid"])
    return out.select("recording_id", "packet_index", r6(F.get("csi_real", F.lit(0))).alias("a"),
                      r6(F.get("csi_real", F.lit(1))).alias("b"), "source_label", "valid")


LINEAR_SQL = f"""WITH {LENGTHS_SQL},
pt AS (
  SELECT recording_id, n, m, j,
         CASE WHEN m > 1 AND n > 1 THEN (j * (n - 1)) // (m - 1) ELSE 0 END AS i,
         CASE WHEN m > 1 AND n > 1 THEN ((j * (n - 1)) % (m - 1)) / CAST(m - 1 AS DOUBLE) ELSE 0 END AS w,
         CASE WHEN m = 1 THEN 0 WHEN j = m - 1 THEN n - 1
              ELSE CAST(round_even(j * ((n - 1) / CAST(m - 1 AS DOUBLE)), 0) AS BIGINT) END AS near
  FROM tgt)
SELECT pt.recording_id, pt.j AS packet_index,
       {q6('CAST(CASE WHEN q.v IS NULL THEN p.v ELSE p.v + (q.v - p.v) * w END AS FLOAT)')} AS a,
       {q6('CAST(CASE WHEN q.k IS NULL THEN p.k ELSE p.k + (q.k - p.k) * w END AS FLOAT)')} AS b,
       r.source_label, r.valid
FROM pt JOIN ix p ON p.recording_id = pt.recording_id AND p.packet_index = pt.i
LEFT JOIN ix q ON q.recording_id = pt.recording_id AND q.packet_index = pt.i + 1
JOIN ix r ON r.recording_id = pt.recording_id AND r.packet_index = pt.near"""


def resample_nearest(spark, sf):
    packets = indexed_events(spark, sf)
    out = R.resample_index(packets, _lengths(spark, sf, 97), "nearest", signals=["csi_real"],
                           others=["source_label", "valid"])
    return out.select("recording_id", "packet_index", r6(F.get("csi_real", F.lit(0))).alias("a"),
                      "source_label", "valid")


NEAREST_SQL = f"""WITH {INDEXED_SQL},
len AS (SELECT recording_id, count(*) AS n, 97 AS m FROM ev GROUP BY 1),
tgt AS (SELECT *, unnest(generate_series(0, 96)) AS j FROM len),
pt AS (
  SELECT *, CASE WHEN j = m - 1 THEN n - 1
            ELSE CAST(round_even(j * ((n - 1) / CAST(m - 1 AS DOUBLE)), 0) AS BIGINT) END AS near FROM tgt)
SELECT pt.recording_id, CAST(j AS BIGINT) AS packet_index, {q6('v')} AS a, source_label, valid
FROM pt JOIN ix r ON r.recording_id = pt.recording_id AND r.packet_index = pt.near"""


def resample_none(spark, sf):
    packets = cut_lineage(indexed_events(spark, sf), "indexed")
    out = R.resample_index(packets, _lengths(spark, sf, 64), "none", signals=["csi_real"],
                           others=["valid"])
    return out.select("recording_id", "packet_index", r6(F.get("csi_real", F.lit(0))).alias("a"),
                      r6(F.get("csi_real", F.lit(1))).alias("b"), "valid")


NONE_SQL = f"""WITH {INDEXED_SQL},
tgt AS (SELECT DISTINCT recording_id, unnest(generate_series(0, 63)) AS j FROM ev)
SELECT tgt.recording_id, CAST(j AS BIGINT) AS packet_index, {q6('coalesce(v, 0)')} AS a, {q6('coalesce(k, 0)')} AS b,
       coalesce(valid, false) AS valid
FROM tgt LEFT JOIN ix ON ix.recording_id = tgt.recording_id AND ix.packet_index = tgt.j"""


def target_lengths(spark, sf):
    rec = event_packets(spark, sf).groupBy("recording_id").agg(
        F.count(F.lit(1)).alias("source_length"), F.max("source_order").alias("last"))
    rec = rec.withColumn("source_rate_hz", F.when(
        F.col("last") % 3 > 0, F.col("source_length") / F.lit(7.0)))
    ratio = W.target_lengths(rec, target_rate_hz=5.0)
    timed = W.target_lengths(rec, target_rate_hz=5.0, duration_s=2.5)
    return ratio.select("recording_id", "rate_length", F.col("window_length").alias("by_ratio")).join(
        timed.select("recording_id", F.col("window_length").alias("by_duration")), "recording_id")


TARGET_SQL = f"""WITH {EVENTS_SQL},
rec AS (
  SELECT recording_id, count(*) AS n,
         CASE WHEN max(source_order) % 3 > 0 THEN count(*) / 7.0::DOUBLE END AS hz FROM ev GROUP BY 1)
SELECT recording_id,
       CASE WHEN hz IS NULL OR abs(hz - 5.0) < 1e-9 THEN n
            ELSE CAST(greatest(1, round_even(n * 5.0::DOUBLE / hz, 0)) AS BIGINT) END AS rate_length,
       CASE WHEN hz IS NULL THEN n
            ELSE CAST(greatest(1, round_even(n * 5.0::DOUBLE / hz, 0)) AS BIGINT) END AS by_ratio,
       CAST(greatest(1, round_even(2.5::DOUBLE * 5.0, 0)) AS BIGINT) AS by_duration
FROM rec"""

QUERIES = {
    "prepare_time": prepare_time, "short_recordings": short_recordings,
    "resample_time": resample_time, "mark_valid": mark_valid, "valid_fraction": valid_fraction,
    "source_rate": source_rate, "span_rate": span_rate, "rate_fallback": rate_fallback,
    "elapsed_ms": elapsed_ms, "target_lengths": target_lengths,
    "resample_index_linear": resample_linear, "resample_index_nearest": resample_nearest,
    "resample_index_none": resample_none,
}
SQL = {
    "prepare_time": PREPARE_SQL, "short_recordings": SHORT_SQL, "resample_time": RESAMPLE_SQL,
    "mark_valid": VALID_SQL, "valid_fraction": FRACTION_SQL, "source_rate": RATE_SQL,
    "span_rate": SPAN_SQL, "rate_fallback": FALLBACK_SQL, "elapsed_ms": ELAPSED_SQL,
    "target_lengths": TARGET_SQL, "resample_index_linear": LINEAR_SQL,
    "resample_index_nearest": NEAREST_SQL, "resample_index_none": NONE_SQL,
}
