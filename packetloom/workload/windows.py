"""Queries over windows, channel fitting and view descriptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.functions import arrays as A
from packetloom.operators import resample as R
from packetloom.operators import sampling as SA
from packetloom.operators import windows as W
from packetloom.operators.ordered import index_bucket, with_position
from packetloom.session import cut_lineage
from packetloom.workload.tables import (
    FULL_SQL, INDEXED_SQL, cells, embedding_packets, event_packets, indexed_events, q6, r6, table)

USER = ["recording_id"]


def segment_windows(spark, sf):
    packets = indexed_events(spark, sf).select(
        "recording_id", "packet_index", "timestamp_s", "csi_real", "source_label", "valid")
    out = W.segment_windows(cut_lineage(packets, "indexed"), 32, USER)
    return out.select("recording_id", "window_index", F.col("offset").cast("long").alias("offset"),
                      "packet_index", r6(F.coalesce(F.nanvl("timestamp_s", F.lit(-1.0)), F.lit(-2.0))
                                         ).alias("t"),
                      r6(F.get("csi_real", F.lit(1))).alias("k"), "source_label", "valid")


SEGMENT_SQL = f"""WITH {INDEXED_SQL},
n AS (SELECT recording_id, count(*) AS n FROM ix GROUP BY 1),
pos AS (SELECT recording_id, unnest(generate_series(0, CAST(ceil(n / 32.0) AS BIGINT) * 32 - 1)) AS p FROM n)
SELECT pos.recording_id, CAST(p // 32 AS BIGINT) AS window_index, CAST(p % 32 AS BIGINT) AS offset,
       coalesce(packet_index, -1) AS packet_index, {q6('coalesce(timestamp_s, -1)')} AS t,
       {q6('coalesce(k, 0)')} AS k, coalesce(source_label, '') AS source_label,
       coalesce(valid, false) AS valid
FROM pos LEFT JOIN ix ON ix.recording_id = pos.recording_id AND ix.packet_index = pos.p"""


def window_table(spark, sf):
    packets = indexed_events(spark, sf)
    return W.window_table(packets, 32, USER)


WINDOW_SQL = f"""WITH {INDEXED_SQL}
SELECT recording_id, CAST(packet_index // 32 AS BIGINT) AS window_index,
       CAST(packet_index // 32 * 32 AS BIGINT) AS window_start_index, count(*) AS window_valid_length,
       CAST(packet_index // 32 * 32 + count(*) AS BIGINT) AS window_end_index
FROM ix GROUP BY recording_id, packet_index // 32"""


def window_tensors(spark, sf):
    packets = indexed_events(spark, sf).select("recording_id", "packet_index", "csi_real", "valid")
    windows = W.segment_windows(cut_lineage(packets, "indexed"), 32, USER)
    out = W.window_tensors(windows, "csi_real", USER)
    checked = F.aggregate(F.transform("csi_real", lambda x, i: F.get(x, F.lit(1)).cast("double") * (i + 1)),
                          F.lit(0.0), lambda a, x: a + x)
    return out.select("recording_id", "window_index", F.size("csi_real").cast("long").alias("length"),
                      r6(checked).alias("weighted"),
                      F.size(F.filter("valid_mask", lambda v: v)).cast("long").alias("n_valid"))


TENSOR_SQL = f"""WITH {INDEXED_SQL}
SELECT recording_id, CAST(packet_index // 32 AS BIGINT) AS window_index, CAST(32 AS BIGINT) AS length,
       {q6('sum(k * (packet_index % 32 + 1))')} AS weighted, count_if(valid) AS n_valid
FROM ix GROUP BY recording_id, packet_index // 32"""


def window_attributes(spark, sf):
    conv = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("recording_id"), F.col("turn").alias("packet_index"), "role")
    windows = W.window_table(conv, 3, USER)
    first = conv.groupBy("recording_id").agg(F.min_by("role", "packet_index").alias("opened_by"),
                                             F.count(F.lit(1)).alias("turns"))
    return W.repeat_for_windows(windows, first, USER)


ATTRIBUTE_SQL = """
WITH f AS (SELECT conv_id, arg_min(role, turn) AS opened_by, count(*) AS turns FROM conversations GROUP BY 1)
SELECT conv_id AS recording_id, CAST(turn // 3 AS BIGINT) AS window_index,
       CAST(turn // 3 * 3 AS BIGINT) AS window_start_index, count(*) AS window_valid_length,
       CAST(turn // 3 * 3 + count(*) AS BIGINT) AS window_end_index, opened_by, turns
FROM conversations JOIN f USING (conv_id) GROUP BY conv_id, turn // 3, opened_by, turns"""


def view_time(spark, sf):
    packets = indexed_events(spark, sf)
    facts = packets.groupBy("recording_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp_s").alias("first_s"),
        F.max("timestamp_s").alias("last_s"))
    facts = facts.withColumn("rate", F.when(F.col("n") % 2 == 0, F.col("n") / F.lit(720.0)))
    rows = packets.select("recording_id", "packet_index").join(facts, "recording_id")
    rows = W.view_time(rows, F.col("rate"), F.col("first_s"), F.col("last_s"), F.col("n"))
    return rows.select("recording_id", "packet_index", r6("timestamp_s").alias("timestamp_s"))


VIEW_TIME_SQL = f"""WITH {INDEXED_SQL},
f AS (SELECT recording_id, count(*) AS n, min(timestamp_s) AS a, max(timestamp_s) AS b FROM ix GROUP BY 1)
SELECT recording_id, packet_index, {q6('''CASE WHEN n % 2 = 0 THEN packet_index / (n / 720.0::DOUBLE)
       WHEN n = 1 THEN a WHEN packet_index = n - 1 THEN b
       ELSE packet_index * ((b - a) / (n - 1)) + a END''')} AS timestamp_s
FROM ix JOIN f USING (recording_id)"""


def recompute_phase(spark, sf):
    em = embedding_packets(spark, sf).withColumn("recording_id", F.col("label").cast("string"))
    em = with_position(em.withColumn("_b", index_bucket("vec_id")), USER, ["vec_id"], "_b").drop("_b")
    em = cut_lineage(em, "vectors")
    n = em.groupBy("recording_id").agg(F.count(F.lit(1)).alias("source_length"))
    n = n.withColumn("target_length", F.lit(40).cast("long"))
    grid = R.resample_index(em, n, "linear", ["csi_real", "csi_imag"])
    grid = R.recompute_phase(grid.withColumn("phase_rad", F.col("csi_real")))
    return grid.select("recording_id", "packet_index", F.posexplode("phase_rad").alias("pos", "x")
                       ).withColumn("x", r6(F.round(F.col("x").cast("double"), 4)))


PHASE_SQL = f"""WITH {FULL_SQL},
em AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS p FROM embeddings),
n AS (SELECT label, count(*) AS n, unnest(range(40)) AS j FROM em GROUP BY 1),
pt AS (SELECT *, (j * (n - 1)) // 39 AS i, ((j * (n - 1)) % 39) / 39.0::DOUBLE AS w FROM n),
c AS (SELECT em.label, em.p, pos, x FROM em JOIN full_cells USING (vec_id)),
v AS (
  SELECT pt.label, pt.j, a.pos, CAST(CAST(CASE WHEN b.x IS NULL THEN a.x ELSE a.x + (b.x - a.x) * w END
         AS FLOAT) AS DOUBLE) AS x
  FROM pt JOIN c a ON a.label = pt.label AND a.p = pt.i
  LEFT JOIN c b ON b.label = pt.label AND b.p = pt.i + 1 AND b.pos = a.pos)
SELECT CAST(r.label AS VARCHAR) AS recording_id, CAST(r.j AS BIGINT) AS packet_index, CAST(r.pos AS INT) AS pos,
       {q6('round(CAST(CAST(atan2(m.x, r.x) AS FLOAT) AS DOUBLE), 4)')} AS x
FROM v r JOIN v m ON m.label = r.label AND m.j = r.j AND m.pos = r.pos + 32 WHERE r.pos < 32"""


def fit_channels(spark, sf):
    em = table(spark, sf, "embeddings")
    wide, _ = W.fit_channels(em, (16, 2, 2), ["embedding"], 21, 1, 3)
    narrow, _ = W.fit_channels(em, (16, 2, 2), ["embedding"], 9, 3, 2)
    both = wide.withColumn("fit", F.lit("wide")).unionByName(narrow.withColumn("fit", F.lit("narrow")))
    return cells(both, "embedding", "vec_id", "fit")


FIT_SQL = f"""WITH {FULL_SQL},
p AS (SELECT vec_id, pos // 4 AS s, (pos // 2) % 2 AS tx, pos % 2 AS rx, x FROM full_cells),
t AS (
  SELECT 'wide' AS fit, s, tx, rx, s * 3 + tx * 3 + rx AS pos, s - 2 AS s0 FROM range(21) a(s), range(1) b(tx), range(3) c(rx)
  UNION ALL
  SELECT 'narrow', s, tx, rx, s * 6 + tx * 2 + rx, s + 3 FROM range(9) a(s), range(3) b(tx), range(2) c(rx))
SELECT e.vec_id, t.fit, CAST(t.pos AS INT) AS pos, {q6('coalesce(p.x, 0)')} AS x
FROM embeddings e CROSS JOIN t
LEFT JOIN p ON p.vec_id = e.vec_id AND p.s = t.s0 AND p.tx = t.tx AND p.rx = t.rx"""


def fit_links(spark, sf):
    em = table(spark, sf, "embeddings")
    one = W.fit_links(em, (4, 16), ["embedding"], 1).withColumn("links", F.lit(1))
    three = W.fit_links(em, (4, 16), ["embedding"], 3).withColumn("links", F.lit(3))
    five = W.fit_links(em, (4, 16), ["embedding"], 5).withColumn("links", F.lit(5))
    return cells(one.unionByName(three).unionByName(five), "embedding", "vec_id", "links")


LINKS_SQL = f"""WITH {FULL_SQL}
SELECT vec_id, 1 AS links, CAST(pos % 16 AS INT) AS pos, {q6('CAST(sum(x) / 4 AS FLOAT)')} AS x
FROM full_cells GROUP BY vec_id, pos % 16
UNION ALL SELECT vec_id, 3, CAST(pos AS INT), {q6('x')} FROM full_cells WHERE pos < 48
UNION ALL SELECT vec_id, 5, CAST(pos AS INT), {q6('x')} FROM full_cells
UNION ALL SELECT vec_id, 5, CAST(i AS INT), 0.0 FROM embeddings, range(64, 80) t(i)"""


def dimension_masks(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("n"))
    rows = W.dimension_masks(part, (F.col("n"), F.col("n"), F.col("n")), 24, 24, None)
    rows = rows.withColumn("coords", A.fit_coordinate(
        F.sequence(F.lit(0), F.col("n") - 1), 24, centred=True))
    rows = rows.withColumn("head", A.fit_coordinate(F.sequence(F.lit(0), F.col("n") - 1), 24))
    return rows.select("p_partkey", F.posexplode(F.arrays_zip(
        "subcarrier_mask", "tx_link_mask", "coords", "head")).alias("pos", "z")).select(
        "p_partkey", "pos", F.col("z.subcarrier_mask").alias("centred"),
        F.col("z.tx_link_mask").alias("headed"), F.col("z.coords").cast("long").alias("coordinate"),
        F.col("z.head").cast("long").alias("head_coordinate"))


MASK_SQL = """
WITH p AS (SELECT p_partkey, p_size AS n, CAST(i AS INT) AS pos FROM part, range(24) t(i)),
s AS (SELECT *, CASE WHEN n < 24 THEN (24 - n) // 2 ELSE 0 END AS before,
             CASE WHEN n > 24 THEN (n - 24) // 2 ELSE 0 END AS skip FROM p)
SELECT p_partkey, pos, pos >= before AND pos < before + least(n, 24) AS centred,
       pos < least(n, 24) AS headed,
       CASE WHEN pos - before + skip BETWEEN 0 AND n - 1 THEN CAST(pos - before + skip AS BIGINT) ELSE -1 END AS coordinate,
       CASE WHEN pos < n THEN CAST(pos AS BIGINT) ELSE -1 END AS head_coordinate
FROM s"""


def _tensors(spark, sf):
    """Every document described as a recorded tensor whose length is its text's."""
    docs = table(spark, sf, "documents")
    clip = F.col("lang") == "en"
    return docs.select(
        F.col("doc_id").alias("recording_id"), F.col("source").alias("dataset_id"),
        F.when(clip, F.array(F.lit("amplitude"), F.lit("phase_rad"))).otherwise(
            F.array(F.lit("bvp"), F.lit("mask"))).alias("arrays"),
        F.when(F.col("lang") == "fr", F.lit("mask")).otherwise(F.lit("none")).alias(
            "standard_representation"),
        F.when(clip, F.array(F.lit(2), F.col("n_chars").cast("int"), F.lit(3), F.lit(30))).otherwise(
            F.array(F.col("n_chars").cast("int"), F.lit(20), F.lit(20))).alias("shape"),
        F.when(F.col("lang") == "es", F.array(F.lit("velocity"), F.lit("time_bin"), F.lit("y")))
        .otherwise(F.array().cast("array<string>")).alias("axis_order"),
        F.when(F.col("n_chars") % 2 == 0, F.col("n_chars") / F.lit(10.0)).alias("source_rate_hz"))


TENSORS_SQL = """
doc AS (
  SELECT doc_id AS recording_id, source AS dataset_id, lang, CAST(n_chars AS BIGINT) AS n_chars,
         CASE WHEN n_chars % 2 = 0 THEN n_chars / 10.0::DOUBLE END AS hz FROM documents),
info AS (
  SELECT *, CASE WHEN lang = 'en' THEN 'amplitude' WHEN lang = 'fr' THEN 'mask' ELSE 'bvp' END AS "primary",
         CASE WHEN lang = 'en' THEN 1 WHEN lang = 'es' THEN 1 ELSE 0 END AS time_axis,
         CASE WHEN lang = 'es' THEN 20 ELSE n_chars END AS source_length FROM doc),
rated AS (
  SELECT *, CASE WHEN hz IS NULL OR abs(hz - 7.0) < 1e-9 THEN source_length
         ELSE CAST(greatest(1, round_even(source_length * 7.0::DOUBLE / hz, 0)) AS BIGINT) END AS rate_length
  FROM info)"""


def view_source_info(spark, sf):
    return W.view_source_info(_tensors(spark, sf), 7.0).select(
        "recording_id", "primary", "time_axis", "source_length", "rate_length")


def view_metadata(spark, sf):
    info = W.view_source_info(_tensors(spark, sf), 7.0).withColumn("axis_order", F.col("axes"))
    info = (info.withColumn("window_length", F.lit(21).cast("long"))
            .withColumn("tensor_exception", ~F.array_contains("axes", "subcarrier"))
            .withColumn("sample_count", F.when(F.size("shape") == 4, 2).otherwise(1))
            .withColumn("transformations", F.array(F.lit("read"))))
    meta = W.view_metadata(info, {"target_rate_hz": 7.0, "profile": "general-sensing"})
    return meta.select("recording_id", "semantic_bins", r6("sample_rate_hz").alias("sample_rate_hz"),
                       "target_rate_assumed", r6("duration_s").alias("duration_s"),
                       F.col("windows_per_sample").cast("long").alias("windows_per_sample"),
                       F.col("output_window_count").cast("long").alias("output_window_count"),
                       F.element_at("transformations", -1).alias("log"))


META_SQL = f"""WITH {TENSORS_SQL},
m AS (
  SELECT *, lang = 'es' AND hz IS NULL AS bins,
         CAST(greatest(1, ceil(rate_length / 21.0)) AS BIGINT) AS w FROM rated)
SELECT recording_id, bins AS semantic_bins, CASE WHEN NOT bins THEN 7.0::DOUBLE END AS sample_rate_hz,
       hz IS NULL AND NOT bins AS target_rate_assumed,
       CASE WHEN NOT bins THEN {q6('21.0 / 7.0')} END AS duration_s, w AS windows_per_sample,
       w * CASE WHEN lang = 'en' THEN 2 ELSE 1 END AS output_window_count,
       'window view: profile=general-sensing, window_length=21, interpolation=linear, layout=canonical, dropped_time_steps=0' AS log
FROM m"""


def flatten_layout(spark, sf):
    info = W.view_source_info(_tensors(spark, sf)).withColumn("axis_order", F.col("axes"))
    flat = W.flatten_layout(info, "flat")
    return flat.select("recording_id", F.array_join("axis_order", ",").alias("axes"),
                       F.array_join(F.transform("shape", lambda x: x.cast("string")), "x").alias("shape"))


FLAT_SQL = """
SELECT doc_id AS recording_id,
       CASE WHEN lang = 'en' THEN 'sample,time,feature' WHEN lang = 'es' THEN 'time_bin,feature'
            ELSE 'time,feature' END AS axes,
       CASE WHEN lang = 'en' THEN '2x' || n_chars || 'x90'
            WHEN lang = 'es' THEN '20x' || (n_chars * 20) ELSE n_chars || 'x400' END AS shape
FROM documents"""


def head_per_group(spark, sf):
    ev = event_packets(spark, sf)
    return SA.head_per_group(ev, ["source_label"], 200, ["timestamp_s", "source_order"]).select(
        "source_label", "source_order", "recording_id")


HEAD_SQL = """
SELECT event_type AS source_label, event_id AS source_order, CAST(user_id AS VARCHAR) AS recording_id
FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 200"""


def window_policy(spark, sf):
    rec = table(spark, sf, "documents").select("lang", F.col("n_chars").alias("rate_length"))
    by_task = W.window_policy(rec, 250, ["lang"])
    overall = W.window_policy(rec, None).withColumn("lang", F.lit("all"))
    return by_task.unionByName(overall)


POLICY_SQL = """
SELECT lang, min(n_chars) AS min_resampled_length, count(*) AS source_count,
       CAST(250 AS BIGINT) AS profile_max_length, least(min(n_chars), 250) AS selected_window_length
FROM documents GROUP BY lang
UNION ALL
SELECT 'all', min(n_chars), count(*), NULL, min(n_chars) FROM documents"""

QUERIES = {
    "segment_windows": segment_windows, "window_table": window_table,
    "window_tensors": window_tensors, "window_attributes": window_attributes,
    "view_time": view_time, "recompute_phase": recompute_phase, "fit_channels": fit_channels,
    "fit_links": fit_links, "dimension_masks": dimension_masks,
    "view_source_info": view_source_info, "view_metadata": view_metadata,
    "flatten_layout": flatten_layout, "head_per_group": head_per_group,
    "window_policy": window_policy,
}
SQL = {
    "segment_windows": SEGMENT_SQL, "window_table": WINDOW_SQL, "window_tensors": TENSOR_SQL,
    "window_attributes": ATTRIBUTE_SQL, "view_time": VIEW_TIME_SQL, "recompute_phase": PHASE_SQL,
    "fit_channels": FIT_SQL, "fit_links": LINKS_SQL, "dimension_masks": MASK_SQL,
    "view_source_info": f'WITH {TENSORS_SQL} SELECT recording_id, "primary", time_axis, source_length, rate_length FROM rated',
    "view_metadata": META_SQL, "flatten_layout": FLAT_SQL, "head_per_group": HEAD_SQL,
    "window_policy": POLICY_SQL,
}
