"""Queries that write files derived from the tables with Spark and read them back as sources."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as ST

from packetloom.session import scratch_path
from packetloom.sources import discovery as DI
from packetloom.sources import tables as TB
from packetloom.sources import text as TX
from packetloom.workload.tables import EVENTS_SQL, FULL_SQL, cells, complex_cells, event_packets, q6, r6, table


def read_wide_csv(spark, sf):
    path = scratch_path(spark, "wide")
    ev = event_packets(spark, sf)
    value, k = F.get("csi_real", F.lit(0)), F.get("csi_real", F.lit(1))
    ev.select("timestamp_s", value.alias("real_l0_s0"), k.alias("imag_l0_s0"), k.alias("real_l1_s2"),
              value.alias("amplitude_l0_s1"), F.lit("x").alias("note")).write.csv(path, header=True)
    rows = TX.read_wide_csv(spark, path)
    return rows.select(r6("timestamp_s").alias("timestamp_s"), "source_representation", "links", "subcarriers",
                       *[r6(F.get("csi_real", F.lit(i))).alias(f"re{i}") for i in range(6)],
                       r6(F.get("csi_imag", F.lit(0))).alias("im0"), r6(F.get("csi_imag", F.lit(5))).alias("im5"))


def read_packet_jsonl(spark, sf):
    path = scratch_path(spark, "jsonl")
    em = table(spark, sf, "embeddings")
    cell = lambda s, l: F.struct(
        F.get("embedding", s * 4 + l).cast("double").alias("r"),
        F.get("embedding", s * 4 + l + 32).cast("double").alias("i"))
    csi = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda s: F.transform(
        F.sequence(F.lit(0), F.when((F.col("vec_id") % 50 == 7) & (s == 3), 2).otherwise(3)), lambda l: cell(s, l)))
    em.select(F.concat(F.lit("busy_"), (F.col("label") % 3).cast("string")).alias("state"),
              F.col("vec_id").cast("double").alias("t"), csi.alias("csi")).write.partitionBy("state").option(
        "compression", "gzip").json(path)
    rows = TX.read_packet_jsonl(spark, path, partitions=8)
    return complex_cells(rows, F.col("timestamp_s").cast("long").alias("vec_id"), "source_label", "packet_error", "links", "subcarriers")


JSONL_SQL = f"""
SELECT vec_id, 'State=busy ' || (label % 3) AS source_label,
       CASE WHEN vec_id % 50 = 7 THEN 'inconsistent packet shape' END AS packet_error, 4 AS links, 8 AS subcarriers,
       CASE WHEN vec_id % 50 <> 7 THEN CAST(i AS INT) END AS pos,
       CASE WHEN vec_id % 50 <> 7 THEN {q6('embedding[(i % 8) * 4 + i // 8 + 1]')} END AS re,
       CASE WHEN vec_id % 50 <> 7 THEN {q6('embedding[32 + (i % 8) * 4 + i // 8 + 1]')} END AS im
FROM embeddings, range(32) t(i) WHERE vec_id % 50 <> 7 OR i = 0"""


def read_numeric_csv(spark, sf):
    path = scratch_path(spark, "matrix")
    li = table(spark, sf, "lineitem")
    line = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    li.select("l_orderkey", F.lit(None).cast("string").alias("blank"), "l_quantity",
              F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.col("l_tax").cast("string")).alias("tax"),
              line.alias("line")).write.csv(path, header=True)
    rows = TX.read_numeric_csv(spark, path)
    return rows.select(F.get("values", F.lit(0)).cast("long").alias("l_orderkey"),
                       F.get("values", F.lit(1)).alias("l_quantity"), F.get("values", F.lit(2)).alias("l_tax"),
                       (F.col("row_index") == F.get("values", F.lit(3)).cast("long")).alias("in_order"), "error")


def read_array_cell_csv(spark, sf):
    path = scratch_path(spark, "cells")
    em = table(spark, sf, "embeddings")
    text = F.concat(F.lit("["), F.array_join(F.transform("embedding", lambda x: F.format_number(x, 5)), ", "), F.lit("]"))
    em.select("vec_id", text.alias("data"), F.when(F.col("label") != 4, F.col("label").cast("string")).otherwise(F.lit("")
              ).alias("class")).write.csv(path, header=True, escape='"')
    rows = TX.read_array_cell_csv(spark, path)
    each = rows.select("source_label", F.size("values").alias("width"), F.posexplode("values").alias("pos", "x"))
    return each.withColumn("x", r6(F.round(F.col("x").cast("double"), 4)))


def read_json_arrays(spark, sf):
    path = scratch_path(spark, "json")
    table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("packet_index"), F.col("embedding").alias("amp"), F.col("label").cast("string").alias("target"),
        F.concat(F.lit("u"), F.col("label").cast("string")).alias("user_id")).write.json(path)
    schema = ST.StructType([
        ST.StructField("packet_index", ST.LongType()), ST.StructField("amp", ST.ArrayType(ST.FloatType())),
        ST.StructField("target", ST.StringType()), ST.StructField("user_id", ST.StringType())])
    rows = TB.resolve_aliases(TX.read_json_arrays(spark, path, schema), keep=("packet_index",))
    return cells(rows, "data", "packet_index", "source_label", "subject")


def resolve_widest(spark, sf):
    em = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("recording_id"), F.slice("embedding", 1, 3).alias("Small"), F.col("embedding").alias("Large"),
        F.col("label").alias("ROOM"))
    rows = TB.resolve_aliases(em, ignore_case=True)
    return rows.select("recording_id", "environment", r6(F.get("data", F.lit(63))).alias("last"))


def read_array_table(spark, sf):
    path = scratch_path(spark, "tensors")
    nested = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda t: F.slice("embedding", t * 8 + 1, 8))
    TB.write_table(table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("recording_id"), F.col("label").alias("dataset_id"), nested.alias("tensor")), path)
    rows = TB.samples_to_packets(TB.read_array_table(spark, path), "tensor")
    return rows.select("recording_id", F.col("dataset_id").cast("int").alias("label"), "packet_index",
                       F.posexplode("amplitude").alias("pos", "x")).withColumn("x", r6("x"))


def write_sinks(spark, sf):
    """Every sink format, counted after reading back."""
    li = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "dataset_id")
    out = None
    for fmt in ("parquet", "json", "orc"):
        path = scratch_path(spark, fmt)
        TB.write_table(li.select("dataset_id", "l_orderkey", "l_linenumber"), path, fmt=fmt,
                       sort_by=["l_orderkey", "l_linenumber"])
        back = spark.read.format(fmt).load(path).groupBy("dataset_id").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("l_orderkey").alias("keys")).withColumn("sink", F.lit(fmt))
        out = back if out is None else out.unionByName(back)
    return out


def discover_sources(spark, sf):
    pages = table(spark, sf, "pages").select(
        F.regexp_replace(F.regexp_replace("url", "^https?://", ""), r"[?#].*$", "").alias("relative_path"),
        F.encode("html", "UTF-8").alias("content"))
    found = DI.discover_sources(pages, ["**/en/*", "*.example.org/**/*.html"], sniff="<title>")
    first = DI.discover_sources(pages, ["**/en/*"], limit=25)
    return found.select("relative_path", F.lit("all").alias("kind")).unionByName(
        first.select("relative_path", F.lit("first").alias("kind")))


DISCOVER_SQL = r"""
WITH p AS (SELECT regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS path, html FROM pages)
SELECT DISTINCT path AS relative_path, 'all' AS kind FROM p
WHERE (regexp_matches(path, '^(.*/)?en/[^/]*$') OR regexp_matches(path, '^[^/]*\.example\.org/(.*/)?[^/]*\.html$'))
      AND contains(substr(html, 1, 2048), '<title>')
UNION ALL
SELECT * FROM (SELECT DISTINCT path, 'first' FROM p WHERE regexp_matches(path, '^(.*/)?en/[^/]*$') ORDER BY path LIMIT 25)"""


def list_files(spark, sf):
    path = scratch_path(spark, "listing")
    table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status")).write.partitionBy(
        "status").json(path)
    files = DI.list_files(spark, path)
    folder = F.regexp_extract("relative_path", r"^status=([A-Z])/part-.*\.json$", 1)
    return DI.matching_patterns(files, ["status=*/*.json"]).select(folder.alias("status"), (F.col("length") > 0).alias("filled")).distinct()


def read_overrides(spark, sf):
    path = scratch_path(spark, "overrides")
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    docs.select(F.when(F.col("quality") == 1, F.concat(F.lit("s"), F.col("doc_id").cast("string"))).alias("sample_id"),
                F.when(F.col("lang") != "de", F.concat(F.col("lang"), F.lit("\\f"), F.col("doc_id").cast("string"))
                       ).alias("source_file"), F.col("source").alias("environment"),
                F.when(F.col("toxic") == 0, F.col("lang")).otherwise(F.lit("")).alias("device")).write.csv(path, header=True)
    rows = DI.read_overrides(spark, path)
    return rows.select("key", *[F.col("metadata")[k].alias(k) for k in ("sample_id", "environment", "device")])


OVERRIDE_SQL = r"""
WITH d AS (
  SELECT CASE WHEN quality = 1 THEN 's' || d.doc_id END AS sample_id,
         CASE WHEN lang <> 'de' THEN lang || '/f' || d.doc_id END AS file, source, CASE WHEN toxic = 0 THEN lang END AS device
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT coalesce(sample_id, file) AS key, sample_id, source AS environment, device FROM d WHERE coalesce(sample_id, file) IS NOT NULL"""


def external_split(spark, sf):
    docs = table(spark, sf, "documents")
    d = F.col("doc_id").cast("string")
    text = F.when(F.col("lang") == "en", F.concat(
        F.lit('{"training": ["a'), d, F.lit('", ["b", {"files": ["c'), d, F.lit('", 7]}]], "valid": {"ids": ["v'), d,
        F.lit('"]}, "other": ["x"]}'))).when(F.col("lang") == "fr", F.concat(F.lit('["p'), d, F.lit('", "q"]'))
    ).otherwise(F.concat(F.lit('{"test": "t'), d, F.lit('"}')))
    path = F.concat(F.lit("lists/"), F.when(F.col("doc_id") % 2 == 0, F.lit("my_train.json")).otherwise(F.lit("plain.json")))
    return DI.split_members(docs.select("doc_id", path.alias("path"), text.alias("text"))).select(
        "path", "partition", "position", "member")


EXTERNAL_SQL = """
WITH d AS (SELECT doc_id, lang, 'lists/' || CASE WHEN doc_id % 2 = 0 THEN 'my_train.json' ELSE 'plain.json' END AS path FROM documents)
SELECT path, 'train' AS "partition", CAST(i AS INT) AS position, CASE i WHEN 0 THEN 'a' || doc_id WHEN 1 THEN 'b' WHEN 2 THEN 'c' || doc_id ELSE '7' END AS member
FROM d, range(4) t(i) WHERE lang = 'en'
UNION ALL SELECT path, 'val', 0, 'v' || doc_id FROM d WHERE lang = 'en'
UNION ALL SELECT path, 'train', 0, 'p' || doc_id FROM d WHERE lang = 'fr' AND doc_id % 2 = 0
UNION ALL SELECT path, 'train', 1, 'q' FROM d WHERE lang = 'fr' AND doc_id % 2 = 0
UNION ALL SELECT path, 'test', 0, 't' || doc_id FROM d WHERE lang IN ('de', 'es')"""


def audit_sources(spark, sf):
    docs = table(spark, sf, "documents")
    files = docs.where("lang <> 'es' OR doc_id % 2 = 0").select(
        F.col("doc_id").alias("name"), F.octet_length("text").cast("long").alias("length"),
        F.encode("text", "UTF-8").alias("content"))
    body = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    digest = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("md5:"), F.md5(F.encode(body, "UTF-8")))).otherwise(
        F.concat(F.lit("sha256:"), F.sha2(F.encode(body, "UTF-8"), 256)))
    expected = docs.select(F.col("doc_id").alias("name"), F.when(
        F.col("doc_id") % 3 == 0, F.octet_length("text") + (F.col("doc_id") % 4 == 0).cast("int")).cast("long").alias("bytes"),
        digest.alias("checksum"))
    return DI.audit_sources(files, expected)


AUDIT_SQL = """
WITH d AS (SELECT doc_id, text, lang = 'es' AND doc_id % 2 <> 0 AS lost, octet_length(encode(text)) AS n FROM documents)
SELECT doc_id AS name, CASE WHEN NOT lost THEN n END AS length, CASE WHEN NOT lost THEN sha256(text) END AS sha256,
       CASE WHEN lost THEN 'missing file' WHEN doc_id % 3 = 0 AND doc_id % 4 = 0 THEN 'size mismatch'
            WHEN doc_id % 5 = 0 THEN 'checksum mismatch' END AS error FROM d"""

PRINTED = "round(CAST(CAST(printf('%.5f', CAST(embedding[{i}] AS DOUBLE)) AS FLOAT) AS DOUBLE), 4)"

QUERIES = {
    "read_wide_csv": read_wide_csv, "read_packet_jsonl": read_packet_jsonl, "read_numeric_csv": read_numeric_csv,
    "read_array_cell_csv": read_array_cell_csv, "read_json_arrays": read_json_arrays, "resolve_widest": resolve_widest,
    "read_array_table": read_array_table, "write_sinks": write_sinks, "discover_sources": discover_sources,
    "list_files": list_files, "read_overrides": read_overrides, "external_split": external_split,
    "audit_sources": audit_sources,
}
SQL = {
    "read_wide_csv": f"""WITH {EVENTS_SQL} SELECT {q6('timestamp_s')} AS timestamp_s, 'complex_csi' AS source_representation,
        2 AS links, 3 AS subcarriers, {q6('v')} AS re0, 0.0 AS re1, 0.0 AS re2, 0.0 AS re3, 0.0 AS re4, {q6('k')} AS re5,
        {q6('k')} AS im0, 0.0 AS im5 FROM ev""",
    "read_packet_jsonl": JSONL_SQL,
    "read_numeric_csv": """SELECT l_orderkey, l_quantity, CASE WHEN l_linenumber <> 7 THEN l_tax END AS l_tax, true AS in_order,
        CASE WHEN l_linenumber = 7 THEN 'not a rectangular numeric CSV' END AS error FROM lineitem""",
    "read_array_cell_csv": f"""SELECT CASE WHEN label <> 4 THEN CAST(label AS VARCHAR) END AS source_label, 64 AS width,
        CAST(i AS INT) AS pos, {q6(PRINTED.format(i="i + 1"))} AS x FROM embeddings, range(64) t(i)""",
    "read_json_arrays": f"""WITH {FULL_SQL} SELECT vec_id AS packet_index, CAST(label AS VARCHAR) AS source_label, 'u' || label AS subject,
        pos, {q6('x')} AS x FROM full_cells""",
    "resolve_widest": f"SELECT vec_id AS recording_id, label AS environment, {q6('embedding[64]')} AS last FROM embeddings",
    "read_array_table": f"""WITH {FULL_SQL} SELECT vec_id AS recording_id, label, CAST(pos // 8 AS INT) AS packet_index,
        CAST(pos % 8 AS INT) AS pos, {q6('x')} AS x FROM full_cells""",
    "write_sinks": """SELECT l_returnflag AS dataset_id, count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS keys, sink
        FROM lineitem, (VALUES ('parquet'), ('json'), ('orc')) s(sink) GROUP BY 1, 4""",
    "discover_sources": DISCOVER_SQL,
    "list_files": "SELECT DISTINCT o_orderstatus AS status, true AS filled FROM orders",
    "read_overrides": OVERRIDE_SQL, "external_split": EXTERNAL_SQL, "audit_sources": AUDIT_SQL,
}
