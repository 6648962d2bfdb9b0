"""Queries over whole views: window packets, the recordings that describe them, label segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.operators.catalog import SIDECAR_CONSTRAINTS, check_constraints
from packetloom.plans import jobs as E
from packetloom.plans.profiles import ViewOptions
from packetloom.plans.views import build_view
from packetloom.session import cut_lineage, scratch_path
from packetloom.workload.tables import INDEXED_SQL, indexed_events, q6, r6, table

ID = "recording_id"


def _inputs(spark, sf):
    """Event packets and sidecars of which a third states a rate; the others have timestamps only."""
    label = F.when(F.col("source_label") == "view", F.lit("")).when(F.endswith(F.col(ID), F.lit("0")), F.lit("any")).otherwise(F.col("source_label"))
    packets = cut_lineage(indexed_events(spark, sf).select(
        ID, "packet_index", "timestamp_s", "csi_real", label.alias("source_label"), "valid"), "indexed")
    n = packets.groupBy(ID).agg(F.count(F.lit(1)).alias("n"))
    recordings = n.select(ID, F.when(F.col("n") % 3 == 0, 2.0).alias("sample_rate_hz"), F.lit(2).alias("links"),
                          F.array(*map(F.lit, ("time", "link", "subcarrier"))).alias("axis_order"))
    return packets, recordings


RATED_SQL = INDEXED_SQL + """,
gap AS (SELECT *, timestamp_s - lag(timestamp_s) OVER (PARTITION BY recording_id ORDER BY packet_index) AS g FROM ix),
rec AS (
  SELECT recording_id, count(*) AS n, min(timestamp_s) AS a, max(timestamp_s) AS b,
         CASE WHEN count(*) % 3 = 0 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE / median(g) FILTER (g > 0) END AS hz
  FROM gap GROUP BY 1)"""


def view_packets(spark, sf):
    packets, recordings = _inputs(spark, sf)
    rows = build_view(packets.drop("source_label"), recordings, ViewOptions(target_length=16, links=1)).windows
    time = F.when(F.col("packet_index") >= 0, F.col("timestamp_s"))
    return rows.select(
        ID, "window_index", F.col("offset").cast("long").alias("offset"), "packet_index", "window_valid_length", "window_end_index",
        F.size("csi_real").cast("long").alias("channels"), r6(F.get("csi_real", F.lit(0))).alias("mean_of_links"), "valid",
        r6(time).alias("timestamp_s"))


PACKETS_SQL = f"""WITH {RATED_SQL},
pos AS (SELECT *, unnest(generate_series(0, CAST(ceil(n / 16.0) AS BIGINT) * 16 - 1)) AS p FROM rec)
SELECT pos.recording_id, CAST(p // 16 AS BIGINT) AS window_index, CAST(p % 16 AS BIGINT) AS offset, coalesce(packet_index, -1) AS packet_index,
       CAST(least(16, n - p // 16 * 16) AS BIGINT) AS window_valid_length, CAST(least(n, p // 16 * 16 + 16) AS BIGINT) AS window_end_index,
       CAST(1 AS BIGINT) AS channels, {q6('coalesce(CAST((v + k) / 2 AS FLOAT), 0)')} AS mean_of_links, coalesce(valid, false) AS valid,
       {q6('''CASE WHEN p >= n THEN NULL WHEN hz IS NOT NULL THEN p / hz WHEN n = 1 THEN a WHEN p = n - 1 THEN b
                   ELSE p * ((b - a) / (n - 1)) + a END''')} AS timestamp_s
FROM pos LEFT JOIN ix ON ix.recording_id = pos.recording_id AND packet_index = p"""


def view_recordings(spark, sf):
    packets, recordings = _inputs(spark, sf)
    meta = build_view(packets.drop("source_label"), recordings, ViewOptions(target_rate_hz=0.5, duration_s=64.0, subcarriers=3)).recordings

    def text(name):
        return F.concat_ws(",", F.col(name).cast("array<string>")).alias(name)

    return meta.select(
        ID, r6("source_sample_rate_hz").alias("source_sample_rate_hz"), r6("sample_rate_hz").alias("sample_rate_hz"), "target_rate_assumed",
        "source_length", "rate_length", "window_length", F.col("output_window_count").cast("long").alias("output_window_count"),
        r6("duration_s").alias("duration_s"), text("shape"), text("axis_order"), text("subcarrier_mask"), "standard_representation",
        F.col("view_options.subcarriers").cast("long").alias("asked_subcarriers"))


RECORDINGS_SQL = f"""WITH {RATED_SQL},
m AS (SELECT *, CAST(CASE WHEN hz IS NULL OR abs(hz - 0.5) < 1e-9 THEN n ELSE greatest(1, round_even(n * 0.5::DOUBLE / hz, 0)) END AS BIGINT) AS m FROM rec),
w AS (SELECT *, CAST(greatest(1, ceil(m / 32.0)) AS BIGINT) AS w FROM m)
SELECT recording_id, {q6('hz')} AS source_sample_rate_hz, 0.5::DOUBLE AS sample_rate_hz, hz IS NULL AS target_rate_assumed, n AS source_length,
       m AS rate_length, CAST(32 AS BIGINT) AS window_length, w AS output_window_count, 64.0::DOUBLE AS duration_s,
       CASE WHEN w > 1 THEN w || ',' ELSE '' END || '32,2,3' AS shape,
       CASE WHEN w > 1 THEN 'sample,' ELSE '' END || 'time,link,subcarrier' AS axis_order, 'false,true,false' AS subcarrier_mask,
       'csi_real' AS standard_representation, CAST(3 AS BIGINT) AS asked_subcarriers
FROM w"""


def view_segments(spark, sf):
    """Recordings of one window: their segments, or their one label as a row without seconds."""
    packets, recordings = _inputs(spark, sf)
    view = build_view(packets, recordings, ViewOptions(target_length=66))
    clips = view.recordings.where("not segmented").select(
        ID, F.try_element_at("labels", F.lit("activity")).alias("source_label"), *[F.lit(None).cast(t).alias(c) for c, t in (
            ("start_index", "long"), ("end_index", "long"), ("start_seconds", "double"), ("end_seconds", "double"))])
    parts = view.segments.select(*clips.columns[:4], r6("start_seconds").alias("start_seconds"), r6("end_seconds").alias("end_seconds"))
    return parts.unionByName(clips)


SEGMENTS_SQL = f"""WITH {RATED_SQL},
lab AS (
  SELECT recording_id, CASE WHEN recording_id LIKE '%0' THEN 'any' ELSE source_label END AS source_label,
         row_number() OVER (PARTITION BY recording_id ORDER BY packet_index) - 1 AS i
  FROM ix WHERE source_label <> 'view'),
facts AS (
  SELECT recording_id, n, coalesce(hz, 1.0) AS hz, count(DISTINCT source_label) AS kinds, min(source_label) AS label
  FROM rec LEFT JOIN lab USING (recording_id) GROUP BY ALL),
turn AS (SELECT *, lag(source_label) OVER (PARTITION BY recording_id ORDER BY i) IS DISTINCT FROM source_label AS new FROM lab),
runs AS (SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY recording_id ORDER BY i) AS run FROM turn),
seg AS (SELECT recording_id, run, min(source_label) AS source_label, min(i) AS s, max(i) + 1 AS e FROM runs GROUP BY 1, 2)
SELECT recording_id, source_label, s AS start_index, e AS end_index, {q6('s / hz')} AS start_seconds, {q6('e / hz')} AS end_seconds
FROM seg JOIN facts USING (recording_id) WHERE n <= 66 AND kinds > 1
UNION ALL
SELECT recording_id, CASE WHEN kinds = 1 THEN label END, NULL, NULL, NULL, NULL FROM facts WHERE NOT (n <= 66 AND kinds > 1)"""


def standardize_files(spark, sf):
    """Vectors as one wide CSV a label: sidecars with what breaks their constraints, and the label with a bad cell."""
    root = scratch_path(spark, "wide")
    cells = [F.when((F.col("label") == 3) & (F.col("vec_id") % 2 == 1) & (F.lit(i) == 5), "x").otherwise(F.get("embedding", F.lit(i)).cast("string"))
             .alias(f"amplitude_l{i // 4}_s{i % 4}") for i in range(8)]
    em = table(spark, sf, "embeddings").select(F.col("label").alias("set"), F.col("vec_id").cast("double").alias("timestamp_s"), *cells)
    em.repartition("set").write.partitionBy("set").csv(root, header=True)
    made = E.standardize_files(spark, root, "vectors", 2.0)
    cards = cut_lineage(made.recordings, "sidecars")
    broken = check_constraints(cards, ID, SIDECAR_CONSTRAINTS).groupBy(F.col("id").alias(ID)).agg(F.count(F.lit(1)).alias("breaches"))
    rows = cards.join(broken, ID, "left").select(
        ID, F.concat_ws(",", F.col("shape").cast("array<string>")).alias("shape"), F.concat_ws(",", "axis_order").alias("axis_order"),
        F.coalesce("breaches", F.lit(0).cast("long")).alias("breaches"), F.char_length("source_sha256").cast("long").alias("digits"),
        r6("duration_s").alias("duration_s"), "standard_representation")
    rows = rows.unionByName(made.failed.select(ID, "error"), allowMissingColumns=True)
    return rows.withColumn("label", F.regexp_extract(ID, "set=([0-9]+)", 1).cast("int")).drop(ID)


FILES_SQL = f"""WITH c AS (
  SELECT CAST(label AS INT) AS label, CAST(greatest(1, round_even((max(vec_id) - min(vec_id) + 0.5::DOUBLE) * 2.0::DOUBLE, 0)) AS BIGINT) AS n,
         label = 3 AND count(*) FILTER (vec_id % 2 = 1) > 0 AS bad
  FROM embeddings GROUP BY label)
SELECT label, CASE WHEN NOT bad THEN n || ',2,4' END AS shape, CASE WHEN NOT bad THEN 'time,link,subcarrier' END AS axis_order,
       CASE WHEN NOT bad THEN CAST(0 AS BIGINT) END AS breaches, CASE WHEN NOT bad THEN CAST(64 AS BIGINT) END AS digits,
       CASE WHEN NOT bad THEN {q6('n / 2.0')} END AS duration_s, CASE WHEN NOT bad THEN 'amplitude_as_real_component' END AS standard_representation,
       CASE WHEN bad THEN 'a cell is not a number' END AS error
FROM c"""


QUERIES = {"view_packets": view_packets, "view_recordings": view_recordings, "view_segments": view_segments, "standardize_files": standardize_files}
SQL = {"view_packets": PACKETS_SQL, "view_recordings": RECORDINGS_SQL, "view_segments": SEGMENTS_SQL, "standardize_files": FILES_SQL}
