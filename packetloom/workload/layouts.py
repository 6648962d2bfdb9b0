"""Queries over tensor layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.operators import layout as L
from packetloom.operators import signal as S
from packetloom.operators.ordered import with_position
from packetloom.session import cut_lineage
from packetloom.workload.tables import FULL_SQL, cells, q6, r6, table


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("label").cast("string").alias("recording_id"), F.col("vec_id").alias("packet_index"),
        F.col("embedding").alias("amplitude"))


def _recordings(spark, sf):
    labels = table(spark, sf, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return labels.select(
        F.col("label").cast("string").alias("recording_id"),
        F.when(F.col("label") % 3 == 0, F.lit("figshare-csi-har")).when(
            F.col("label") % 3 == 1, F.lit("xrf55")).otherwise(F.lit("other")).alias("dataset_id"),
        F.when(F.col("label") == 9, F.array(*map(F.lit, ("time", "link", "feature")))).when(
            F.col("label") == 8, F.array(*map(F.lit, ("time", "subcarrier", "tx_link", "rx_link"))))
        .otherwise(F.array(*map(F.lit, ("time", "link", "subcarrier")))).alias("axis_order"),
        F.lit(4).alias("links"), F.when(F.col("label") == 2, 4).alias("tx_links"),
        F.when(F.col("label") == 2, 1).alias("rx_links"))


def canonicalize_links(spark, sf):
    packets, _ = L.canonicalize_links(_vectors(spark, sf), _recordings(spark, sf))
    return cells(packets, "amplitude", "recording_id", "packet_index")


CANONICAL_SQL = f"""WITH {FULL_SQL}
SELECT CAST(label AS VARCHAR) AS recording_id, vec_id AS packet_index,
       CAST(CASE WHEN label IN (8, 9) THEN pos ELSE pos % 16 * 4 + pos // 16 END AS INT) AS pos,
       {q6('x')} AS x FROM full_cells"""


def link_layouts(spark, sf):
    _, rec = L.canonicalize_links(_vectors(spark, sf), _recordings(spark, sf))
    return rec.select("recording_id", F.array_join("axis_order", ",").alias("axes"),
                      F.col("tx_links").cast("int").alias("tx_links"),
                      F.col("rx_links").cast("int").alias("rx_links"),
                      "antenna_mapping_evidence", "tensor_exception",
                      F.size("rx_link_index").alias("rx_count"))


LAYOUT_SQL = """
WITH r AS (SELECT DISTINCT label FROM embeddings),
c AS (
  SELECT label, label IN (8, 9) AS untouched,
         CASE WHEN label IN (8, 9) THEN NULL WHEN label = 2 THEN 4 WHEN label % 3 = 0 THEN 2 ELSE 1 END AS tx
  FROM r)
SELECT CAST(label AS VARCHAR) AS recording_id,
       CASE WHEN label = 9 THEN 'time,link,feature' ELSE 'time,subcarrier,tx_link,rx_link' END AS axes,
       CAST(tx AS INT) AS tx_links, CAST(4 // tx AS INT) AS rx_links,
       CASE WHEN untouched THEN NULL WHEN label % 3 = 1 THEN
            'preserved flattened streams; source factorization unavailable'
            ELSE 'released antenna layout' END AS antenna_mapping_evidence,
       label = 9 AS tensor_exception, CASE WHEN untouched THEN NULL ELSE CAST(4 // tx AS INT) END AS rx_count
FROM c"""


def infer_axes(spark, sf):
    part = table(spark, sf, "part")
    n = F.col("p_size")
    shape = F.slice(F.array(n, n + 1, n + 2, n + 3, n + 4), F.lit(1), (n % 5 + 1).cast("int"))
    out = L.infer_axes(part.select("p_partkey", shape.alias("shape")))
    return out.select("p_partkey", F.array_join("axis_order", ",").alias("axes"), "error",
                      F.array_join(F.transform("shape", lambda x: x.cast("string")), "x").alias("shape"))


AXES_SQL = """
WITH p AS (SELECT p_partkey, p_size AS n, p_size % 5 + 1 AS r FROM part)
SELECT p_partkey, CASE WHEN r <= 3 THEN 'time,link,subcarrier' WHEN r = 4 THEN 'sample,time,link,subcarrier' END AS axes,
       CASE WHEN r = 5 THEN '1-D to 4-D arrays are supported, got 5-D' END AS error,
       CASE r WHEN 1 THEN n || 'x1x1' WHEN 2 THEN n || 'x1x' || (n + 1)
            WHEN 3 THEN n || 'x' || (n + 1) || 'x' || (n + 2)
            WHEN 4 THEN n || 'x' || (n + 1) || 'x' || (n + 2) || 'x' || (n + 3)
            ELSE n || 'x' || (n + 1) || 'x' || (n + 2) || 'x' || (n + 3) || 'x' || (n + 4) END AS shape
FROM p"""


def infer_bench_axes(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_quantity").cast("int").alias("a"),
        (F.col("l_partkey") % 250).cast("int").alias("b"), (F.col("l_suppkey") % 64).cast("int").alias("c"))
    shape = F.when(F.col("a") % 4 == 0, F.array(F.col("b") % 90, F.col("b"), F.col("c"), F.lit(30))).otherwise(
        F.array((F.col("a") * 2).cast("int"), F.col("b"), F.col("c")))
    out = L.infer_bench_axes(li.withColumn("shape", shape))
    return out.groupBy(F.array_join("source_axis_order", ",").alias("axes"),
                       F.col("error").isNotNull().alias("failed")).agg(F.count(F.lit(1)).alias("n"))


BENCH_SQL = """
WITH l AS (
  SELECT CAST(l_quantity AS INT) AS q, CAST(l_partkey % 250 AS INT) AS b, CAST(l_suppkey % 64 AS INT) AS c FROM lineitem),
s AS (SELECT CASE WHEN q % 4 = 0 THEN 4 ELSE 3 END AS r, CASE WHEN q % 4 = 0 THEN b % 90 ELSE q * 2 END AS d0,
             b AS d1, c AS d2, CASE WHEN q % 4 = 0 THEN 30 ELSE c END AS last FROM l),
x AS (
  SELECT CASE WHEN r = 4 THEN 'sample,time,link,subcarrier'
         WHEN d0 <= 32 AND d1 > d0 THEN 'sample,time,subcarrier'
         WHEN d2 <= 16 AND d1 >= 32 AND d0 >= 16 AND d0 <> d1 THEN 'subcarrier,time,link'
         WHEN d0 IN (56, 64, 114, 168, 208, 232) AND d1 >= d0 THEN 'subcarrier,time,link'
         WHEN last IN (56, 64, 114, 168, 208, 232, 30, 52, 100) AND d1 >= d0 THEN 'time,link,subcarrier' END AS axes
  FROM s)
SELECT axes, axes IS NULL AS failed, count(*) AS n FROM x GROUP BY 1, 2"""


def permute_axes(spark, sf):
    rows = L.permute_axes(table(spark, sf, "embeddings"), "embedding", ["rx", "tx", "sub"],
                          ["sub", "tx", "rx"], {"rx": 2, "tx": 4, "sub": 8})
    return cells(rows, "embedding", "vec_id")


PERMUTE_SQL = f"""WITH {FULL_SQL}
SELECT vec_id, CAST((pos % 8) * 8 + (pos // 8) % 4 * 2 + pos // 32 AS INT) AS pos, {q6('x')} AS x FROM full_cells"""


def columns_to_vector(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("tx1rx2_sub10"),
        F.col("l_discount").alias("tx1rx2_sub9"), F.col("l_tax").alias("tx1rx1_sub2"),
        F.col("l_extendedprice").alias("tx2rx1_sub1"))
    rows = L.columns_to_vector(li, r"tx\d+rx\d+_sub\d+", 4, "v")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", *[
        F.get("v", F.lit(i)).alias(f"v{i}") for i in range(4)])


def _rows(spark, sf):
    """Order lines as matrix rows of their order; a discount of 10% stands for an empty row."""
    li = table(spark, sf, "lineitem")
    keep = ["l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    empty = F.col("l_discount") == 0.1
    rows = li.select(F.col("l_orderkey").alias("recording_id"), *keep, F.array(
        F.when(empty, 0.0).otherwise(F.col("l_quantity")),
        F.when(empty, 0.0).otherwise(F.col("l_extendedprice"))).alias("x"))
    rows = rows.withColumn("_b", F.floor(F.col("l_partkey") / 4096))
    return cut_lineage(with_position(rows, ["recording_id"], keep, "_b", "row_index").select(
        "recording_id", "row_index", "x"), "rows")


ROWS_SQL = """
rows AS (
  SELECT l_orderkey AS recording_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey,
           l_linenumber, l_extendedprice, l_quantity, l_discount, l_tax) - 1 AS row_index,
         CASE WHEN l_discount = 0.1 THEN 0.0::DOUBLE ELSE l_quantity END AS q,
         CASE WHEN l_discount = 0.1 THEN 0.0::DOUBLE ELSE l_extendedprice END AS p
  FROM lineitem)"""


def group_rows(spark, sf):
    out = L.group_rows(_rows(spark, sf), 2, ["x"])
    return out.select("recording_id", "packet_index", *[
        r6(F.get("x", F.lit(i))).alias(f"x{i}") for i in range(4)])


GROUP_SQL = f"""WITH {ROWS_SQL}
SELECT recording_id, CAST(row_index // 2 AS BIGINT) AS packet_index,
       {q6('max(CASE WHEN row_index % 2 = 0 THEN q END)')} AS x0, {q6('max(CASE WHEN row_index % 2 = 0 THEN p END)')} AS x1,
       {q6('max(CASE WHEN row_index % 2 = 1 THEN q END)')} AS x2, {q6('max(CASE WHEN row_index % 2 = 1 THEN p END)')} AS x3
FROM rows GROUP BY recording_id, row_index // 2 HAVING count(*) = 2 AND sum(q) > 0"""


def deinterleave_streams(spark, sf):
    out = L.deinterleave_streams(_rows(spark, sf), 2, ["x"])
    return out.select("recording_id", "packet_index", *[
        r6(F.get("x", F.lit(i))).alias(f"x{i}") for i in range(4)])


STREAM_SQL = f"""WITH {ROWS_SQL},
d AS (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY row_index) - 1 AS i FROM rows WHERE q > 0 OR p > 0)
SELECT recording_id, CAST(i // 2 AS BIGINT) AS packet_index,
       {q6('max(CASE WHEN i % 2 = 0 THEN q END)')} AS x0, {q6('max(CASE WHEN i % 2 = 0 THEN p END)')} AS x1,
       {q6('max(CASE WHEN i % 2 = 1 THEN q END)')} AS x2, {q6('max(CASE WHEN i % 2 = 1 THEN p END)')} AS x3
FROM d GROUP BY recording_id, i // 2 HAVING count(*) = 2"""


def unfold_frames(spark, sf):
    frames = table(spark, sf, "embeddings").select(
        F.col("label").alias("recording_id"), F.col("vec_id").alias("frame_index"), "embedding")
    out = L.unfold_frames(frames, "embedding", 8, width=8)
    return cells(out, "embedding", "recording_id", "packet_index")


UNFOLD_SQL = f"""WITH {FULL_SQL}
SELECT label AS recording_id, CAST(vec_id * 8 + pos % 8 AS BIGINT) AS packet_index, CAST(pos // 8 AS INT) AS pos,
       {q6('x')} AS x FROM full_cells"""


def stride_packets(spark, sf):
    return L.stride_packets(table(spark, sf, "events").select(
        F.col("event_id").alias("packet_index"), "event_type", "value"), 4)


def drop_zero_slots(spark, sf):
    holes = F.array(*[F.lit(i) for i in range(64) if i % 16 >= 9 or i // 16 == 2])
    packets = table(spark, sf, "embeddings").select(
        F.col("label").cast("string").alias("recording_id"), "vec_id", F.transform(
            "embedding", lambda x, i: F.when(F.array_contains(holes, i), F.lit(0).cast("float")).otherwise(x)
        ).alias("amplitude"))
    out = L.drop_zero_slots(packets, 4, 16, ["amplitude"], patterns=[[0, 1, 3]], active_carriers=9)
    return cells(out, "amplitude", "vec_id")


ZERO_SQL = f"""WITH {FULL_SQL},
z AS (SELECT label, vec_id, pos // 16 AS l, pos % 16 AS s,
             CASE WHEN pos % 16 >= 9 OR pos // 16 = 2 THEN 0 ELSE x END AS x FROM full_cells),
ul AS (SELECT label, l FROM z GROUP BY 1, 2 HAVING bool_or(x <> 0)),
us AS (SELECT label, s FROM z GROUP BY 1, 2 HAVING bool_or(x <> 0))
SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY z.l, z.s) - 1 AS INT) AS pos, {q6('x')} AS x
FROM z JOIN ul ON ul.label = z.label AND ul.l = z.l JOIN us ON us.label = z.label AND us.s = z.s"""


def slice_blocks(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.when(
        F.col("label") % 2 == 0, F.col("embedding")).otherwise(F.slice("embedding", 1, 40)).alias("m"))
    out = L.slice_blocks(rows, "m", (9, 5), (4, 3, 1))
    return out.select("vec_id", "links", "subcarriers", F.posexplode(
        F.arrays_zip("amplitude", "phase_rad")).alias("pos", "z")).select(
        "vec_id", "links", "subcarriers", "pos", r6("z.amplitude").alias("amplitude"),
        r6("z.phase_rad").alias("phase_rad"))


SLICE_SQL = f"""
WITH f AS (SELECT vec_id, embedding, CASE WHEN label % 2 = 0 THEN 3 ELSE 1 END AS n, 9 AS s FROM embeddings),
c AS (SELECT vec_id, n, s, p, CAST(embedding[p + 1] AS DOUBLE) AS a, CAST(embedding[p + s * n + 1] AS DOUBLE) AS b
      FROM f, range(s, s * (n + 1)) t(p))
SELECT vec_id, n AS links, s AS subcarriers, CAST(p - s AS INT) AS pos, {q6('a')} AS amplitude, {q6('b')} AS phase_rad FROM c"""


def orient_time_first(spark, sf):
    """Runs of 48 vectors hold a recording of 16 rows, which is turned, and one of 32, which is not."""
    place = F.col("vec_id") % 48
    em = table(spark, sf, "embeddings").select(
        F.concat(F.expr("cast(vec_id div 48 as string)"), F.when(place < 16, "a").otherwise("b")).alias("recording_id"),
        F.when(place < 16, place).otherwise(place - 16).alias("row_index"), "embedding")
    return cells(L.orient_time_first(em, "embedding", [16]), "embedding", "recording_id", "packet_index")


ORIENT_SQL = f"""WITH {FULL_SQL},
e AS (SELECT vec_id, (vec_id // 48) || CASE WHEN vec_id % 48 < 16 THEN 'a' ELSE 'b' END AS rec FROM embeddings),
r AS (SELECT vec_id, rec, row_number() OVER (PARTITION BY rec ORDER BY vec_id) - 1 AS i, count(*) OVER (PARTITION BY rec) AS n FROM e)
SELECT rec AS recording_id, CASE WHEN n = 16 THEN CAST(pos AS BIGINT) ELSE i END AS packet_index,
       CAST(CASE WHEN n = 16 THEN i ELSE pos END AS INT) AS pos, {q6('x')} AS x
FROM r JOIN full_cells USING (vec_id)"""


def select_receivers(spark, sf):
    rows = L.select_receivers(table(spark, sf, "embeddings"), "embedding", [3, 0], 4, 16)
    return cells(rows, "embedding", "vec_id")


def flattened_links(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.array(
        F.col("p_size"), F.lit(30), F.col("p_size") % 3 + 1, F.lit(3)).alias("shape"))
    return S.flattened_links(part).select("p_partkey", F.array_join(
        F.transform("shape", lambda x: x.cast("string")), "x").alias("shape"))


QUERIES = {
    "canonicalize_links": canonicalize_links, "link_layouts": link_layouts,
    "infer_axes": infer_axes, "infer_bench_axes": infer_bench_axes, "permute_axes": permute_axes,
    "columns_to_vector": columns_to_vector, "group_rows": group_rows,
    "deinterleave_streams": deinterleave_streams, "unfold_frames": unfold_frames,
    "stride_packets": stride_packets, "drop_zero_slots": drop_zero_slots,
    "slice_blocks": slice_blocks, "orient_time_first": orient_time_first,
    "select_receivers": select_receivers, "flattened_links": flattened_links,
}
SQL = {
    "canonicalize_links": CANONICAL_SQL, "link_layouts": LAYOUT_SQL, "infer_axes": AXES_SQL,
    "infer_bench_axes": BENCH_SQL, "permute_axes": PERMUTE_SQL,
    "columns_to_vector": """SELECT l_orderkey, l_linenumber, l_partkey, l_tax AS v0, l_discount AS v1,
        l_quantity AS v2, l_extendedprice AS v3 FROM lineitem""",
    "group_rows": GROUP_SQL, "deinterleave_streams": STREAM_SQL, "unfold_frames": UNFOLD_SQL,
    "stride_packets": """SELECT CAST(event_id // 4 AS BIGINT) AS packet_index, event_type, value
        FROM events WHERE event_id % 4 = 0""",
    "drop_zero_slots": ZERO_SQL, "slice_blocks": SLICE_SQL, "orient_time_first": ORIENT_SQL,
    "select_receivers": f"""WITH {FULL_SQL} SELECT vec_id, CAST(CASE WHEN pos >= 48 THEN pos - 48 ELSE pos + 16 END
        AS INT) AS pos, {q6('x')} AS x FROM full_cells WHERE pos >= 48 OR pos < 16""",
    "flattened_links": """SELECT p_partkey, p_size || 'x30x1x' || ((p_size % 3 + 1) * 3) AS shape FROM part""",
}
