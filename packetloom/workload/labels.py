"""Queries over label runs, intervals and label catalogs."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.functions import vocabularies as V
from packetloom.operators import sampling as SA
from packetloom.operators import segments as D
from packetloom.session import cut_lineage
from packetloom.workload.tables import (
    INDEXED_SQL, EVENTS_SQL, event_packets, indexed_events, q6, r6, table)

ID = "recording_id"


def _indexed(spark, sf):
    return cut_lineage(indexed_events(spark, sf).select(
        ID, "packet_index", "timestamp_s", "source_label"), "indexed")


def _turns(spark, sf):
    return table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias(ID), F.col("turn").alias("packet_index"),
        F.col("role").alias("source_label"))


RUNS_SQL = """
flags AS (
  SELECT *, CASE WHEN source_label = lag(source_label) OVER (PARTITION BY recording_id ORDER BY packet_index)
            THEN 0 ELSE 1 END AS s FROM src),
numbered AS (SELECT *, sum(s) OVER (PARTITION BY recording_id ORDER BY packet_index) AS run FROM flags),
runs AS (
  SELECT recording_id, CAST(run AS BIGINT) AS run, any_value(source_label) AS source_label, min(packet_index) AS a,
         max(packet_index) + 1 AS b FROM numbered GROUP BY recording_id, run)"""
EVENT_SRC = INDEXED_SQL + ", src AS (SELECT recording_id, packet_index, source_label FROM ix)," + RUNS_SQL
TURN_SRC = ("src AS (SELECT CAST(conv_id AS VARCHAR) AS recording_id, turn AS packet_index, role AS source_label "
            "FROM conversations)," + RUNS_SQL)


def label_runs(spark, sf):
    rates = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias(ID),
        F.when(F.col("c_nationkey") > 3, F.col("c_nationkey").cast("double")).alias("sample_rate_hz"))
    return D.label_runs(_indexed(spark, sf), rates).select(
        ID, "run", "source_label", "start_index", "end_index",
        r6("start_seconds").alias("start_seconds"), r6("end_seconds").alias("end_seconds"))


LABEL_RUNS_SQL = f"""WITH {EVENT_SRC},
many AS (SELECT recording_id FROM src GROUP BY 1 HAVING count(*) > 1)
SELECT runs.recording_id, run, source_label, a AS start_index, b AS end_index,
       {q6('a / CASE WHEN c_nationkey > 3 THEN CAST(c_nationkey AS DOUBLE) ELSE 1.0 END')} AS start_seconds,
       {q6('b / CASE WHEN c_nationkey > 3 THEN CAST(c_nationkey AS DOUBLE) ELSE 1.0 END')} AS end_seconds
FROM runs JOIN many USING (recording_id)
LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = runs.recording_id"""


def turn_runs(spark, sf):
    return D.label_runs(_turns(spark, sf), 2.0).select(
        ID, "run", "source_label", "start_index", "end_index", "start_seconds", "end_seconds")


def longest_run(spark, sf):
    runs = D.numbered_runs(_indexed(spark, sf), "source_label", [ID], "packet_index")
    labels = F.array(*map(F.lit, ("view", "purchase", "click", "signup", "error", "never")))
    expected = runs.select(ID).distinct().select(ID, F.explode(labels).alias("source_label"))
    return D.longest_run(runs, cap=2, expected=expected)


LONGEST_SQL = f"""WITH {EVENT_SRC},
best AS (
  SELECT recording_id, source_label, a, least(b, a + 2) AS b FROM runs
  QUALIFY row_number() OVER (PARTITION BY recording_id, source_label ORDER BY b - a DESC, a) = 1),
expected AS (
  SELECT * FROM (SELECT DISTINCT recording_id FROM src),
       (VALUES ('view'), ('purchase'), ('click'), ('signup'), ('error'), ('never')) t(source_label))
SELECT recording_id, source_label, a AS start_index, b AS end_index,
       CASE WHEN a IS NULL THEN 'no interval labelled ' || source_label END AS error
FROM expected LEFT JOIN best USING (recording_id, source_label)"""


def _intervals(spark, sf):
    """Orders as intervals on the event recordings of their customers' numbers."""
    orders = table(spark, sf, "orders")
    return orders.select(
        F.col("o_custkey").cast("string").alias(ID), F.col("o_orderkey").alias("interval_order"),
        (F.col("o_orderkey") % 90 - 5).alias("start_index"),
        (F.col("o_orderkey") % 90 - 5 + F.col("o_custkey") % 17).alias("end_index"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("label"))


INTERVAL_SQL = """
iv AS (
  SELECT CAST(o_custkey AS VARCHAR) AS recording_id, o_orderkey AS interval_order, o_orderkey % 90 - 5 AS a,
         o_orderkey % 90 - 5 + o_custkey % 17 AS b,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS label FROM orders),
len AS (SELECT recording_id, count(*) AS n FROM ev GROUP BY 1),
chk AS (
  SELECT iv.recording_id, interval_order, label, greatest(0, a) AS a, least(n, b) AS b,
         CASE WHEN label IS NULL THEN 'unknown label id'
              WHEN least(n, b) <= greatest(0, a) THEN 'invalid segment' END AS error
  FROM iv JOIN len USING (recording_id))"""


def _checked(spark, sf):
    lengths = event_packets(spark, sf).groupBy(ID).agg(F.count(F.lit(1)).alias("source_length"))
    return D.checked_intervals(_intervals(spark, sf), lengths)


def checked_intervals(spark, sf):
    return _checked(spark, sf)


def paint_labels(spark, sf):
    good = cut_lineage(_checked(spark, sf).where(F.col("error").isNull()), "intervals")
    painted = D.paint_labels(_indexed(spark, sf), good, width=32)
    return painted.select(ID, "packet_index", "source_label")


PAINT_SQL = f"""WITH {INDEXED_SQL}, {INTERVAL_SQL},
hit AS (
  SELECT ix.recording_id, packet_index, arg_max(label, interval_order) AS label
  FROM ix JOIN chk ON chk.recording_id = ix.recording_id AND packet_index >= a AND packet_index < b AND error IS NULL
  GROUP BY 1, 2)
SELECT recording_id, packet_index, coalesce(label, 'unlabeled') AS source_label
FROM ix LEFT JOIN hit USING (recording_id, packet_index)"""


def _time_intervals(spark, sf):
    base = 473352.0
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias(ID), F.col("o_orderkey").alias("interval_order"),
        (F.lit(base) + F.col("o_orderkey") % 700).alias("start_seconds"),
        (F.lit(base) + F.col("o_orderkey") % 700 + F.col("o_custkey") % 50).alias("end_seconds"),
        F.col("o_orderpriority").alias("label"))


TIME_SQL = EVENTS_SQL + """,
iv AS (
  SELECT CAST(o_custkey AS VARCHAR) AS recording_id, o_orderkey AS interval_order, o_orderpriority AS label,
         473352.0::DOUBLE + o_orderkey % 700 AS a, 473352.0::DOUBLE + o_orderkey % 700 + o_custkey % 50 AS b FROM orders),
tag AS (
  SELECT ev.recording_id, ev.timestamp_s, source_order, arg_min(label, interval_order) AS label
  FROM ev JOIN iv ON iv.recording_id = ev.recording_id AND timestamp_s BETWEEN a AND b GROUP BY 1, 2, 3)"""


def tag_intervals(spark, sf):
    out = D.tag_intervals(event_packets(spark, sf), _time_intervals(spark, sf), row_id="source_order",
                          width=24.0)
    return out.select(ID, "source_order", "label")


def capture_intervals(spark, sf):
    out = SA.capture_intervals(event_packets(spark, sf), _time_intervals(spark, sf), 40,
                               row_id="source_order", width=24.0)
    return out.select(ID, "source_order", "label")


def capture_completeness(spark, sf):
    """The labels of the capture, and those of the most urgent orders once more at a time without packets."""
    intervals = _time_intervals(spark, sf)
    late = intervals.where("label = '1-URGENT'").withColumn("label", F.lit("late")).withColumn(
        "start_seconds", F.col("start_seconds") + 1e6).withColumn("end_seconds", F.col("end_seconds") + 1e6)
    declared = intervals.unionByName(late)
    captured = SA.capture_intervals(event_packets(spark, sf), declared, 40, row_id="source_order", width=24.0)
    return SA.completeness(captured, declared, "label", "no packet for label")


def rescale_annotations(spark, sf):
    docs = table(spark, sf, "documents")
    annotations = docs.select(
        F.col("source").alias("name"), "doc_id",
        F.when(F.col("lang") == "es", F.lit("x")).otherwise((F.col("doc_id") % 9).cast("string")).alias("class"),
        F.col("n_chars").cast("string").alias("start"),
        F.when(F.col("lang") == "de", F.lit("late")).otherwise(
            (F.col("n_chars") + 30).cast("string")).alias("end"))
    info = table(spark, sf, "supplier").select(
        F.concat(F.lit("src"), F.col("s_nationkey").cast("string")).alias("name"),
        F.col("s_suppkey").alias("row_index"), (F.col("s_suppkey") % 4).cast("string").alias("count"),
        F.lit("3").alias("sample_count"))
    out = D.rescale_annotations(annotations, info, V.WIFI_TAD_CLASSES)
    return out.select("doc_id", "label_id", "label", r6("start_seconds").alias("start_seconds"),
                      r6("end_seconds").alias("end_seconds"))


RESCALE_SQL = f"""
WITH info AS (
  SELECT 'src' || s_nationkey AS name, arg_min(s_suppkey % 4, s_suppkey) AS c FROM supplier GROUP BY 1),
a AS (
  SELECT doc_id, CAST(doc_id % 9 AS INT) AS label_id, n_chars, coalesce(3.0::DOUBLE / nullif(c, 0), 1.0) AS r
  FROM documents LEFT JOIN info ON name = source WHERE lang NOT IN ('es', 'de'))
SELECT doc_id, label_id, CASE label_id WHEN 1 THEN 'run' WHEN 2 THEN 'walk' WHEN 3 THEN 'jump' WHEN 4 THEN 'wave'
       WHEN 5 THEN 'bend' WHEN 6 THEN 'stand' ELSE 'sit' END AS label,
       {q6('CAST(CAST(n_chars * r AS FLOAT) AS DOUBLE) / 100.0')} AS start_seconds,
       {q6('CAST(CAST((n_chars + 30) * r AS FLOAT) AS DOUBLE) / 100.0')} AS end_seconds
FROM a WHERE label_id BETWEEN 1 AND 7"""


def _segments(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias(ID), F.col("o_orderkey").alias("segment_id"),
        ((F.col("o_orderkey") % 401) / 10.0).alias("start_seconds"),
        ((F.col("o_orderkey") % 401 + F.col("o_custkey") % 99) / 10.0).alias("end_seconds"))


def _rated(spark, sf):
    return event_packets(spark, sf).groupBy(ID).agg(
        F.count(F.lit(1)).alias("source_length"), F.max("source_order").alias("m")).select(
        ID, "source_length", F.when(F.col("m") % 4 > 0, 1.5).alias("sample_rate_hz"))


def segment_to_index(spark, sf):
    return D.segment_to_index(_segments(spark, sf), _rated(spark, sf)).select(
        ID, "segment_id", "start_index", "end_index")


SEGMENT_INDEX = """
sg AS (
  SELECT CAST(o_custkey AS VARCHAR) AS recording_id, o_orderkey AS segment_id,
         (o_orderkey % 401) / 10.0::DOUBLE AS s, (o_orderkey % 401 + o_custkey % 99) / 10.0::DOUBLE AS e FROM orders),
rec AS (SELECT recording_id, count(*) AS n, CASE WHEN max(source_order) % 4 > 0 THEN 1.5::DOUBLE END AS hz FROM ev GROUP BY 1),
x AS (
  SELECT recording_id, segment_id, n, s, e, hz, CAST(round_even(s * hz, 0) AS BIGINT) AS lo,
         CAST(round_even(e * hz, 0) AS BIGINT) AS hi FROM sg JOIN rec USING (recording_id)),
si AS (
  SELECT recording_id, segment_id,
         CASE WHEN hz IS NOT NULL AND lo >= 0 AND lo < n AND lo < hi AND hi <= n THEN lo
              ELSE greatest(0, least(CAST(round_even(s, 0) AS BIGINT), n)) END AS start_index,
         CASE WHEN hz IS NOT NULL AND lo >= 0 AND lo < n AND lo < hi AND hi <= n THEN hi
              ELSE greatest(0, least(CAST(round_even(e, 0) AS BIGINT), n)) END AS end_index
  FROM x)"""


def slice_segments(spark, sf):
    segments = cut_lineage(D.segment_to_index(_segments(spark, sf), _rated(spark, sf)), "segments")
    out = D.slice_segments(_indexed(spark, sf), segments, width=32)
    return out.groupBy("segment_id").agg(
        F.count(F.lit(1)).alias("packets"), F.max("packet_index").alias("last_index"),
        F.min_by("source_label", "packet_index").alias("first_label"),
        F.max_by("source_label", "packet_index").alias("last_label"))


SLICE_SQL = f"""WITH {INDEXED_SQL}, {SEGMENT_INDEX},
cut AS (
  SELECT segment_id, packet_index - start_index AS p, source_label FROM ix JOIN si
  ON si.recording_id = ix.recording_id AND packet_index >= start_index AND packet_index < end_index AND end_index > start_index
  UNION ALL
  SELECT segment_id, packet_index, source_label FROM ix JOIN si ON si.recording_id = ix.recording_id AND end_index <= start_index)
SELECT segment_id, count(*) AS packets, max(p) AS last_index, arg_min(source_label, p) AS first_label,
       arg_max(source_label, p) AS last_label FROM cut GROUP BY 1"""


def clip_or_segments(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias(ID), F.when(F.col("l_linestatus") == "O", F.col("l_returnflag"))
        .otherwise(F.lit("")).alias("source_label"))
    had = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias(ID), F.col("o_orderpriority").alias("clip_label"))
    return D.clip_or_segments(rows, had)


CLIP_SQL = """
WITH l AS (
  SELECT l_orderkey, count(*) AS labelled, min(l_returnflag) AS a, max(l_returnflag) AS b
  FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)
SELECT l_orderkey AS recording_id, labelled, coalesce(o_orderpriority, CASE WHEN a = b THEN a END) AS clip_label,
       a <> b AS has_segments
FROM l LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'P'"""


def _entries(spark, sf):
    docs = table(spark, sf, "documents")
    recordings = docs.select(
        F.col("doc_id").cast("string").alias(ID), F.when(F.col("lang") != "de", F.col("lang")).alias("clip_label"),
        F.when(F.col("lang") == "en", F.create_map(
            F.lit("Origin"), F.array(F.col("source"), F.lit(" ")), F.lit("Language"), F.array(F.col("lang"))))
        .alias("label_sets"))
    runs = D.label_runs(_turns(spark, sf)).withColumn("label", F.col("source_label"))
    segments = _segments(spark, sf).withColumn("label", F.when(
        F.col("segment_id") % 5 == 0, F.lit("nan")).otherwise(F.lit("busy_time")))
    samples = table(spark, sf, "embeddings").select(
        F.lit("vectors").alias(ID), F.col("vec_id").alias("sample_index"), F.lit("Gesture").alias("task"),
        F.when(F.col("label") == 3, F.lit("none")).otherwise(
            F.concat(F.lit("class_"), F.col("label").cast("string"))).alias("label"))
    return D.label_catalog(recordings, segments, runs, samples, segment_task="Activity")


def label_catalog(spark, sf):
    return _entries(spark, sf).withColumn("start_seconds", r6("start_seconds")).withColumn(
        "end_seconds", r6("end_seconds"))


CATALOG_ENTRIES = f"""
{TURN_SRC},
many AS (SELECT recording_id FROM src GROUP BY 1 HAVING count(*) > 1),
entries AS (
  SELECT 'Origin/' || source AS label_key, CAST(doc_id AS VARCHAR) AS recording_id, NULL::BIGINT AS sample_index,
         NULL::DOUBLE AS start_seconds, NULL::DOUBLE AS end_seconds, 'label_sets' AS origin FROM documents WHERE lang = 'en'
  UNION ALL SELECT 'Language/en', CAST(doc_id AS VARCHAR), NULL, NULL, NULL, 'label_sets' FROM documents WHERE lang = 'en'
  UNION ALL SELECT lang, CAST(doc_id AS VARCHAR), NULL, NULL, NULL, 'clip' FROM documents WHERE lang NOT IN ('en', 'de')
  UNION ALL SELECT 'Gesture/' || CASE WHEN label = 3 THEN 'unknown' ELSE 'class ' || label END, 'vectors', vec_id, NULL, NULL, 'sample' FROM embeddings
  UNION ALL SELECT 'Activity/busy time', CAST(o_custkey AS VARCHAR), NULL, {q6('(o_orderkey % 401) / 10.0::DOUBLE')},
         {q6('(o_orderkey % 401 + o_custkey % 99) / 10.0::DOUBLE')}, 'segment' FROM orders WHERE o_orderkey % 5 <> 0
  UNION ALL SELECT 'Activity/' || source_label, recording_id, NULL, CAST(a AS DOUBLE), CAST(b AS DOUBLE), 'run'
         FROM runs JOIN many USING (recording_id))"""


def choose_representative(spark, sf):
    entries = _entries(spark, sf).withColumn("is_native", F.col("origin") != "run").withColumn(
        "label_count", F.length("label_key").cast("long"))
    entries = entries.withColumn("entry_order", F.conv(F.substring(F.md5(F.concat_ws(
        "|", "label_key", "recording_id", F.coalesce("sample_index", F.lit(-1)).cast("string"),
        F.rint(F.coalesce("start_seconds", F.lit(-1.0)) * 10).cast("long").cast("string"))), 1, 12), 16, 10
    ).cast("long"))
    return D.choose_representative(entries).select(
        "label_key", "recording_id", "sample_index", r6("start_seconds").alias("start_seconds"), "origin")


CHOOSE_SQL = f"""WITH {CATALOG_ENTRIES},
o AS (
  SELECT *, md5(label_key || '|' || recording_id || '|' || coalesce(sample_index, -1) || '|' ||
         CAST(round_even(coalesce(start_seconds, -1.0) * 10, 0) AS BIGINT)) AS h FROM entries)
SELECT label_key, recording_id, sample_index, start_seconds, origin FROM o
QUALIFY row_number() OVER (PARTITION BY label_key ORDER BY start_seconds IS NULL, origin = 'run',
        coalesce(end_seconds - start_seconds, 0) DESC, substr(h, 1, 12)) = 1"""


def order_by_vocabulary(spark, sf):
    order = table(spark, sf, "nation").where("n_nationkey < 3").select(
        F.element_at(F.array(*map(F.lit, ("2-HIGH", "5-LOW", "1-URGENT"))), F.col("n_nationkey") + 1).alias("label"),
        F.col("n_nationkey").alias("position"))
    counts = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    return SA.order_by_vocabulary(counts, "o_orderpriority", order).orderBy("label_order", "o_orderpriority")


QUERIES = {
    "label_runs": label_runs, "turn_runs": turn_runs, "longest_run": longest_run,
    "checked_intervals": checked_intervals, "paint_labels": paint_labels,
    "tag_intervals": tag_intervals, "capture_intervals": capture_intervals,
    "capture_completeness": capture_completeness,
    "rescale_annotations": rescale_annotations, "segment_to_index": segment_to_index,
    "slice_segments": slice_segments, "clip_or_segments": clip_or_segments,
    "label_catalog": label_catalog, "choose_representative": choose_representative,
    "order_by_vocabulary": order_by_vocabulary,
}
SQL = {
    "label_runs": LABEL_RUNS_SQL,
    "turn_runs": f"""WITH {TURN_SRC}, many AS (SELECT recording_id FROM src GROUP BY 1 HAVING count(*) > 1)
        SELECT recording_id, run, source_label, a AS start_index, b AS end_index, a / 2.0::DOUBLE AS start_seconds,
               b / 2.0::DOUBLE AS end_seconds FROM runs JOIN many USING (recording_id)""",
    "longest_run": LONGEST_SQL,
    "checked_intervals": f"""WITH {EVENTS_SQL}, {INTERVAL_SQL}
        SELECT recording_id, interval_order, a AS start_index, b AS end_index, label, error FROM chk""",
    "paint_labels": PAINT_SQL,
    "tag_intervals": f"WITH {TIME_SQL} SELECT recording_id, source_order, label FROM tag",
    "capture_intervals": f"""WITH {TIME_SQL} SELECT recording_id, source_order, label FROM tag
        QUALIFY row_number() OVER (PARTITION BY label ORDER BY timestamp_s, recording_id, source_order) <= 40""",
    "capture_completeness": f"""WITH {TIME_SQL} SELECT label, least(count(*), 40) AS rows, CAST(NULL AS VARCHAR) AS error FROM tag GROUP BY 1
        UNION ALL SELECT DISTINCT o_orderpriority, 0, 'no packet for label: ' || o_orderpriority FROM orders
        WHERE o_orderpriority NOT IN (SELECT label FROM tag)
        UNION ALL SELECT DISTINCT 'late', 0, 'no packet for label: late' FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "rescale_annotations": RESCALE_SQL,
    "segment_to_index": f"""WITH {EVENTS_SQL}, {SEGMENT_INDEX}
        SELECT recording_id, segment_id, start_index, end_index FROM si""",
    "slice_segments": SLICE_SQL, "clip_or_segments": CLIP_SQL,
    "label_catalog": f"WITH {CATALOG_ENTRIES} SELECT * FROM entries",
    "choose_representative": CHOOSE_SQL,
    "order_by_vocabulary": """SELECT o_orderpriority, count(*) AS orders, CAST(CASE o_orderpriority WHEN '2-HIGH' THEN 0
        WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 10000 END AS BIGINT) AS label_order FROM orders GROUP BY 1""",
}
