"""Queries over profiles, adapters and the end-to-end jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.operators import signal as S
from packetloom.plans import adapters as AD
from packetloom.plans import jobs as E
from packetloom.plans import profiles as PR
from packetloom.plans import registry as RG
from packetloom.plans.prepare import prepare_dataset
from packetloom.plans.profiles import ViewOptions
from packetloom.session import cut_lineage, scratch_path
from packetloom.workload.subsets import _sizes
from packetloom.workload.tables import (
    EVENTS_SQL, FULL_SQL, cells, event_packets, indexed_events, q6, r6, table)
from packetloom.workload.timeline import CLEAN_SQL, HOURS, LENGTHS_SQL

ID = "recording_id"


def resolve_profiles(spark, sf):
    docs = table(spark, sf, "documents")
    name = F.when(F.col("lang") == "en", F.lit("native-10hz")).when(F.col("lang") == "fr", F.lit("")).when(
        F.col("lang") == "de", F.lit("semantic-bvp")).otherwise(F.lit("clip-9s"))
    rows = PR.resolve_profiles(docs.select("doc_id", name.alias("name")), "name")
    return rows.select("doc_id", "profile", "target_rate_hz", "duration_s", "target_length", "interpolation", "error")


PROFILE_SQL = """
SELECT doc_id, CASE lang WHEN 'en' THEN 'vital-sign' WHEN 'fr' THEN 'general-sensing' WHEN 'de' THEN 'semantic-bvp' END AS profile,
       CASE lang WHEN 'en' THEN 10.0::DOUBLE WHEN 'fr' THEN 100.0 END AS target_rate_hz,
       CASE lang WHEN 'en' THEN 30.0::DOUBLE WHEN 'fr' THEN 3.0 END AS duration_s,
       CASE lang WHEN 'de' THEN CAST(22 AS BIGINT) END AS target_length,
       CASE lang WHEN 'en' THEN 'linear' WHEN 'fr' THEN 'linear' WHEN 'de' THEN 'none' END AS interpolation,
       CASE WHEN lang = 'es' THEN 'unknown task profile clip-9s; choose one of: general-sensing, semantic-bvp, task-auto, vital-sign' END AS error
FROM documents"""


def task_view(spark, sf):
    docs = table(spark, sf, "documents")
    rows = docs.select("doc_id", F.when(F.col("lang") == "en", F.lit("FallDetection")).otherwise(F.col("lang")).alias("label"),
                       F.when(F.col("lang") == "fr", F.concat(F.lit("x\\BreathingDetection\\"), "source")).otherwise(
                           F.col("source")).alias("path"))
    plain = PR.task_view(rows, "label", "path").withColumn("asked", F.lit("nothing"))
    short = PR.task_view(rows, "label", "path", ViewOptions(duration_s=2.0)).withColumn("asked", F.lit("duration"))
    return plain.unionByName(short).select("doc_id", "asked", "task", "profile", "target_rate_hz", "duration_s", "profile_max_length")


TASK_SQL = """
SELECT doc_id, asked, CASE lang WHEN 'en' THEN 'FallDetection' WHEN 'fr' THEN 'BreathingDetection' ELSE 'Multitask' END AS task,
       CASE lang WHEN 'fr' THEN 'vital-sign' ELSE 'general-sensing' END AS profile,
       CASE lang WHEN 'fr' THEN 10.0::DOUBLE ELSE 100.0 END AS target_rate_hz,
       CASE WHEN asked = 'duration' THEN 2.0::DOUBLE WHEN lang = 'fr' THEN 30.0 ELSE 3.0 END AS duration_s,
       CAST(CASE WHEN lang = 'fr' THEN 10 ELSE 100 END * CASE WHEN asked = 'duration' THEN 2 WHEN lang = 'fr' THEN 30 ELSE 3 END AS BIGINT) AS profile_max_length
FROM documents, (VALUES ('nothing'), ('duration')) t(asked)"""


def split_registry(spark, sf):
    """Which split settings fit the metadata that the documents bring: joined by their group field."""
    have = table(spark, sf, "documents").groupBy(F.when(F.col("lang") == "en", "subject").when(
        F.col("lang") == "fr", "environment").otherwise("device").alias("group_by")).agg(F.count(F.lit(1)).alias("samples"))
    return RG.settings_table(spark).where(F.col("kind") == "group_holdout").join(F.broadcast(have), "group_by").groupBy(
        "group_by", "samples").agg(F.count(F.lit(1)).alias("settings"))


def standardize(spark, sf):
    out = E.standardize_packets(event_packets(spark, sf), 1.0, bucket_s=HOURS)
    return out.select(ID, "packet_index", "valid", r6("reference_power").alias("reference_power"),
                      r6(F.get("amplitude", F.lit(1))).alias("amplitude"),
                      r6(F.round(F.get("power_db_rel", F.lit(0)).cast("double"), 3)).alias("db"))


STANDARD_SQL = f"""WITH {CLEAN_SQL},
ok AS (
  SELECT *, (t2 IS NOT NULL OR x <= t)
         AND least(x - t, coalesce(t2 - x, x - t)) <= greatest(1.5, 1.5 * gap) AS valid FROM grid),
am AS (SELECT *, CASE WHEN valid THEN CAST(CAST(sqrt(a * a + b * b) AS FLOAT) AS DOUBLE) ELSE 0 END AS amp FROM ok),
ref AS (SELECT recording_id, greatest(median(amp * amp), 1.1754943508222875e-38) AS ref FROM am WHERE valid GROUP BY 1)
SELECT recording_id, g AS packet_index, valid, {q6('coalesce(ref, 1.0)')} AS reference_power, {q6('amp')} AS amplitude,
       {q6('''round(CAST(CAST(CASE WHEN valid THEN 10.0 * log10(greatest(amp * amp, 1.1754943508222875e-38) / ref) ELSE 0 END
            AS FLOAT) AS DOUBLE), 3)''')} AS db
FROM am LEFT JOIN ref USING (recording_id)"""


def create_view(spark, sf):
    packets = cut_lineage(indexed_events(spark, sf).select(
        ID, "packet_index", "csi_real", "csi_imag", "source_label", "valid"), "indexed")
    recordings = packets.select(ID).distinct().withColumn("sample_rate_hz", F.lit(3.0)).withColumn(
        "axis_order", F.array(*map(F.lit, ("time", "subcarrier", "tx_link", "rx_link"))))
    view, _ = E.create_view(packets, recordings, ViewOptions(target_rate_hz=2.0, duration_s=8.0, rx_links=3), (1, 1, 2))
    return view.select(ID, "window_index", "window_start_index", F.col("offset").cast("long").alias("offset"), "packet_index",
                       *[r6(F.get("csi_real", F.lit(i))).alias(f"c{i}") for i in range(3)], "source_label", "valid",
                       r6(F.when(F.col("packet_index") >= 0, F.col("timestamp_s"))).alias("timestamp_s"))


VIEW_SQL = f"""WITH {LENGTHS_SQL},
pt AS (
  SELECT recording_id, n, m, j, CASE WHEN m > 1 AND n > 1 THEN (j * (n - 1)) // (m - 1) ELSE 0 END AS i,
         CASE WHEN m > 1 AND n > 1 THEN ((j * (n - 1)) % (m - 1)) / CAST(m - 1 AS DOUBLE) ELSE 0 END AS w,
         CASE WHEN m = 1 THEN 0 WHEN j = m - 1 THEN n - 1
              ELSE CAST(round_even(j * ((n - 1) / CAST(m - 1 AS DOUBLE)), 0) AS BIGINT) END AS near FROM tgt),
rs AS (
  SELECT pt.recording_id, pt.j, CASE WHEN q.v IS NULL THEN p.v ELSE p.v + (q.v - p.v) * w END AS v,
         CASE WHEN q.k IS NULL THEN p.k ELSE p.k + (q.k - p.k) * w END AS k, r.source_label, r.valid
  FROM pt JOIN ix p ON p.recording_id = pt.recording_id AND p.packet_index = pt.i
  LEFT JOIN ix q ON q.recording_id = pt.recording_id AND q.packet_index = pt.i + 1
  JOIN ix r ON r.recording_id = pt.recording_id AND r.packet_index = pt.near),
pos AS (SELECT recording_id, unnest(generate_series(0, CAST(ceil(m / 16.0) AS BIGINT) * 16 - 1)) AS p FROM len)
SELECT pos.recording_id, CAST(p // 16 AS BIGINT) AS window_index, CAST(p // 16 * 16 AS BIGINT) AS window_start_index,
       CAST(p % 16 AS BIGINT) AS offset, coalesce(j, -1) AS packet_index, {q6('CAST(coalesce(v, 0) AS FLOAT)')} AS c0,
       {q6('CAST(coalesce(k, 0) AS FLOAT)')} AS c1, 0.0 AS c2, coalesce(source_label, '') AS source_label,
       coalesce(valid, false) AS valid, {q6('j / 2.0::DOUBLE')} AS timestamp_s
FROM pos LEFT JOIN rs ON rs.recording_id = pos.recording_id AND rs.j = pos.p"""


def _prepared(spark, sf):
    packets = indexed_events(spark, sf).select(ID, "packet_index", "csi_real", "csi_imag", "source_label", "valid")
    packets = cut_lineage(S.add_amplitude(packets), "indexed")
    n = packets.groupBy(ID).agg(F.count(F.lit(1)).alias("n"))
    recordings = n.select(
        ID, F.lit("wifi-presence-movement").alias("dataset_id"), F.when(F.col("n") % 3 > 0, 2.0).alias("sample_rate_hz"),
        F.array(*map(F.lit, ("time", "link", "subcarrier"))).alias("axis_order"), F.lit(2).alias("links"),
        F.lit(None).cast("int").alias("tx_links"), F.lit(None).cast("int").alias("rx_links"),
        F.when(F.col("n") % 7 == 0, F.lit("length divisible by seven")).alias("error"))
    return E.prepare_packets(packets, recordings, "wifi-presence-movement", ViewOptions(target_rate_hz=1.0), seed=5)


def prepare(spark, sf):
    done = _prepared(spark, sf)
    windows = done.windows.groupBy(ID).agg(
        F.count_distinct("window_index").alias("windows"), F.max("window_length").alias("window_length"),
        F.count_if(F.col("packet_index") >= 0).alias("resampled"))
    mean = done.quality.where(F.col("array") == "csi_real").select(ID, r6("mean").alias("mean_real"))
    parts = done.split.select(F.substring_index("sample_id", "/", -1).alias(ID), "partition")
    out = done.manifest.select(F.col("source").alias(ID), "status", "error")
    for other in (windows, mean, parts):
        out = out.join(other, ID, "left")
    return out


PREPARE_SQL = f"""WITH {EVENTS_SQL},
c AS (SELECT recording_id, count(*) AS cnt, (sum(v) + sum(k)) / (2 * count(*)) AS mean_real FROM ev GROUP BY 1),
good AS (
  SELECT *, CASE WHEN cnt % 3 > 0 THEN CAST(greatest(1, round_even(cnt * 1.0::DOUBLE / 2.0, 0)) AS BIGINT) ELSE cnt END AS m
  FROM c WHERE cnt % 7 <> 0),
win AS (SELECT min(m) AS w FROM good),
tot AS (SELECT count(*) AS n FROM good), {_sizes('tot')},
rk AS (SELECT recording_id, row_number() OVER (ORDER BY md5('standardized/views/' || recording_id || ':5'),
       'standardized/views/' || recording_id) - 1 AS r FROM good)
SELECT c.recording_id, CASE WHEN c.cnt % 7 = 0 THEN 'failed' ELSE 'converted' END AS status,
       CASE WHEN c.cnt % 7 = 0 THEN 'length divisible by seven' END AS error,
       CAST(ceil(m / CAST(w AS DOUBLE)) AS BIGINT) AS windows, CASE WHEN m IS NOT NULL THEN w END AS window_length,
       m AS resampled, CASE WHEN m IS NOT NULL THEN {q6('c.mean_real')} END AS mean_real,
       CASE WHEN r < n0 THEN 'train' WHEN r < n0 + n1 THEN 'val' WHEN r IS NOT NULL THEN 'test' END AS "partition"
FROM c LEFT JOIN good USING (recording_id) LEFT JOIN rk USING (recording_id), win, cut"""


def generic_adapter(spark, sf):
    em = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("packet_index"), F.slice("embedding", 1, 32).alias("real"),
        F.slice("embedding", 33, 32).alias("imag_csi"), F.col("label").alias("y"), F.col("label").alias("room"))
    rows = AD.generic(em, keep=["packet_index"])
    return cells(rows, "amplitude", "packet_index", "source_label", "environment")


def wallhack_adapter(spark, sf):
    """Vectors written as literal cells, one file per label, through the whole adapter."""
    path = scratch_path(spark, "literal")
    em = table(spark, sf, "embeddings")
    text = F.concat(F.lit("["), F.array_join(F.transform("embedding", lambda x: x.cast("string")), ", "), F.lit("]"))
    em.select(F.concat(F.lit("NLOS_"), F.col("label").cast("string")).alias("set"), text.alias("data"),
              (F.col("label") % 4).alias("class")).write.partitionBy("set").csv(path, header=True, escape='"')
    rows = AD.wallhack18k(spark, path)
    return rows.groupBy(F.regexp_extract(ID, "set=NLOS_([0-9]+)", 1).cast("int").alias("label"), "source_label").agg(
        F.count(F.lit(1)).alias("packets"), F.max(F.size("amplitude")).alias("carriers"),
        r6(F.round(F.sum(F.aggregate("amplitude", F.lit(0.0), lambda a, x: a + x.cast("double"))), 3)).alias("total"))


WALLHACK_SQL = f"""WITH {FULL_SQL},
iq AS (SELECT a.label, a.vec_id, a.pos // 2 AS s, sqrt(a.x * a.x + b.x * b.x) AS amp
       FROM full_cells a JOIN full_cells b ON a.vec_id = b.vec_id AND b.pos = a.pos + 1 WHERE a.pos % 2 = 0)
SELECT CAST(label AS INT) AS label, CASE label % 4 WHEN 0 THEN 'no_presence' WHEN 1 THEN 'walking' WHEN 2 THEN 'arm_waving' ELSE '3' END AS source_label,
       count(DISTINCT vec_id) AS packets, 26 AS carriers, {q6('round(sum(CAST(CAST(amp AS FLOAT) AS DOUBLE)), 3)')} AS total
FROM iq WHERE s BETWEEN 6 AND 31 GROUP BY 1, 2"""

def _by_label(spark, sf, dataset_id, write, **more):
    """Embeddings as the sources of a data set, one file per label, prepared by its id; then label 0 comes once
    more as label 99 and the job runs again."""
    root, out = scratch_path(spark, "sources"), scratch_path(spark, "prepared")
    em = table(spark, sf, "embeddings")
    number = F.regexp_extract("source", "set=([0-9]+)", 1).cast("int").alias("label")
    write(em.repartition("label"), root)
    first = prepare_dataset(spark, dataset_id, root, out, check=False, **more).state.select(number, F.col("status").alias("first"))
    write(em.where("label = 0").withColumn("label", F.lit(99)).repartition(1), root)
    run = prepare_dataset(spark, dataset_id, root, out, check=False, **more)
    packets = run.table("packets").groupBy(F.col(ID).alias("source")).agg(F.count(F.lit(1)).alias("packets"), F.max(F.size("amplitude")).alias("channels"))
    windows = run.table("windows").groupBy(F.col(ID).alias("source")).agg(
        F.count_if(F.col("packet_index") >= 0).alias("resampled"), F.max("window_length").alias("window_length"))
    rows = run.state.join(packets, "source", "left").join(windows, "source", "left")
    return rows.select(number, F.col("status").alias("second"), F.substring("error", 1, 20).alias("error"), "packets", "channels", "resampled",
                       "window_length").join(first, "label", "left")


def prepare_literal_cells(spark, sf):
    """wallhack18k by its id: one source has a cell that is no list; the second run converts the new one only."""
    def write(em, root):
        text = F.concat(F.lit("["), F.array_join(F.transform("embedding", lambda x: x.cast("string")), ", "), F.when(F.col("label") == 3, "; ").otherwise("]"))
        em.select(F.col("label").alias("set"), text.alias("data"), (F.col("label") % 4).alias("class")).write.mode("append").partitionBy("set").csv(root, header=True, escape='"')
    return _by_label(spark, sf, "wallhack18k", write, setting="random")


def prepare_packet_lines(spark, sf):
    """wifi-presence-movement by its id, gzip JSON Lines; the packets of one source are ragged."""
    def write(em, root):
        def cell(k, link):
            i = k * 2 + link
            return F.struct(F.get("embedding", i).cast("double").alias("r"), F.get("embedding", i + 32).cast("double").alias("i"))
        csi = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.when((k == 0) & (F.col("label") == 4), F.array(cell(k, 0))).otherwise(
            F.array(cell(k, 0), cell(k, 1))))
        em.select(F.col("label").alias("set"), (F.col("vec_id") / 100).alias("t"), csi.alias("csi")).write.mode("append").partitionBy("set").json(root, compression="gzip")
    return _by_label(spark, sf, "wifi-presence-movement", write, setting="random")


def prepare_matrix(spark, sf):
    """glasgow-multiuser by its id: CSV matrices of 52 columns; cells that are no numbers spoil one source."""
    def write(em, root):
        last = F.when((F.col("label") == 5) & (F.col("vec_id") % 3 == 0), "x").otherwise(F.get("embedding", F.lit(51)).cast("string"))
        em.select(F.col("label").alias("set"), *[F.get("embedding", F.lit(i)).cast("string").alias(f"c{i}") for i in range(51)], last.alias("c51")
                  ).write.mode("append").partitionBy("set").csv(root)
    return _by_label(spark, sf, "glasgow-multiuser", write, setting="random")


# packets per label; the second at the rate of the profile, from the median gap of the timestamps
PLAIN_LENGTHS = "SELECT label, count(*) AS n, count(*) AS m FROM embeddings GROUP BY 1"
TIMED_LENGTHS = """SELECT label, count(*) AS n, CAST(round_even(count(*) * 100.0::DOUBLE / (1.0::DOUBLE / median(t - before) FILTER (t > before)), 0) AS BIGINT) AS m
  FROM (SELECT label, t, lag(t) OVER (PARTITION BY label ORDER BY vec_id) AS before
        FROM (SELECT label, vec_id, vec_id / 100.0::DOUBLE - min(vec_id / 100.0::DOUBLE) OVER (PARTITION BY label) AS t FROM embeddings)) GROUP BY 1"""


def _by_id_sql(bad: int, error: str, channels: int, limit: int, lengths: str = PLAIN_LENGTHS) -> str:
    return f"""WITH c AS ({lengths}),
a AS (SELECT CAST(label AS INT) AS label, n, m FROM c UNION ALL SELECT 99, n, m FROM c WHERE label = 0),
w AS (SELECT least(min(m), {limit}) AS w FROM a WHERE label <> {bad}), ok AS (SELECT *, label <> {bad} AS good FROM a)
SELECT label, CASE WHEN label = 99 THEN NULL WHEN good THEN 'converted' ELSE 'failed' END AS first,
       CASE WHEN label = 99 THEN 'converted' WHEN good THEN 'skipped' ELSE 'failed' END AS second, CASE WHEN NOT good THEN substring('{error}', 1, 20) END AS error,
       CASE WHEN good THEN n END AS packets, CASE WHEN good THEN {channels} END AS channels, CASE WHEN good THEN m END AS resampled,
       CASE WHEN good THEN CAST(w AS BIGINT) END AS window_length FROM ok, w"""


QUERIES = {
    "prepare_literal_cells": prepare_literal_cells, "prepare_packet_lines": prepare_packet_lines, "prepare_matrix": prepare_matrix,
    "resolve_profiles": resolve_profiles, "task_view": task_view, "split_registry": split_registry,
    "standardize": standardize, "create_view": create_view, "prepare": prepare,
    "generic_adapter": generic_adapter, "wallhack_adapter": wallhack_adapter,
}
SQL = {
    "prepare_literal_cells": _by_id_sql(3, "not a list of numbers", 26, 300),
    "prepare_packet_lines": _by_id_sql(4, "inconsistent packet shape", 32, 300, TIMED_LENGTHS),
    "prepare_matrix": _by_id_sql(5, "not a rectangular numeric CSV", 52, 300),
    "split_registry": """WITH s(group_by, settings) AS (VALUES ('subject', 14), ('environment', 15), ('device', 6)),
        h AS (SELECT CASE lang WHEN 'en' THEN 'subject' WHEN 'fr' THEN 'environment' ELSE 'device' END AS group_by,
                     count(*) AS samples FROM documents GROUP BY 1)
        SELECT group_by, samples, CAST(settings AS BIGINT) AS settings FROM s JOIN h USING (group_by)""",
    "resolve_profiles": PROFILE_SQL, "task_view": TASK_SQL, "standardize": STANDARD_SQL, "create_view": VIEW_SQL,
    "prepare": PREPARE_SQL,
    "generic_adapter": f"""WITH c AS (SELECT vec_id, label, CAST(i AS INT) AS pos, CAST(embedding[i + 1] AS DOUBLE) AS a, CAST(embedding[i + 33] AS DOUBLE) AS b
            FROM embeddings, range(32) t(i))
        SELECT vec_id AS packet_index, label AS source_label, label AS environment, pos, {q6('CAST(sqrt(a * a + b * b) AS FLOAT)')} AS x FROM c""",
    "wallhack_adapter": WALLHACK_SQL,
}
