"""Queries over companion, annotation, registry and manifest joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.functions import text as T
from packetloom.operators import joins as J
from packetloom.workload.tables import table


def pair_join(spark, sf):
    em = table(spark, sf, "embeddings")
    real = em.where("label <> 0").select("vec_id", F.slice("embedding", 1, 32).alias("re"))
    imag = em.where("label <> 1").select("vec_id", F.when(
        F.col("label") == 2, F.slice("embedding", 33, 31)).otherwise(F.slice("embedding", 33, 32)).alias("im"))
    return J.pair_join(real, imag, ["vec_id"], ("re", "im")).select(
        "vec_id", F.size("re").alias("re_width"), F.size("im").alias("im_width"), "error")


PAIR_SQL = """
SELECT vec_id, CAST(CASE WHEN label = 0 THEN NULL ELSE 32 END AS INT) AS re_width,
       CAST(CASE label WHEN 1 THEN NULL WHEN 2 THEN 31 ELSE 32 END AS INT) AS im_width,
       CASE WHEN label IN (0, 1) THEN 'matching companion row not found'
            WHEN label = 2 THEN 'companion shapes differ' END AS error
FROM embeddings"""


def positional_join(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_index"), F.lit(1).alias("recording_id"), "lang")
    labels = table(spark, sf, "labels").select(
        (F.col("doc_id") + 3).alias("row_index"), F.lit(1).alias("recording_id"), "quality")
    strict = J.positional_join(docs, labels).withColumn("mode", F.lit("strict"))
    cut = J.positional_join(docs, labels, truncate=True).withColumn("mode", F.lit("truncate"))
    return strict.unionByName(cut).select("row_index", "lang", "quality", "error", "mode")


POSITION_SQL = """
WITH l AS (SELECT doc_id + 3 AS row_index, quality FROM labels)
SELECT coalesce(doc_id, row_index) AS row_index, lang, quality,
       CASE WHEN doc_id IS NULL OR row_index IS NULL THEN 'data and label counts differ' END AS error, 'strict' AS mode
FROM documents FULL OUTER JOIN l ON doc_id = row_index
UNION ALL
SELECT doc_id, lang, quality, NULL, 'truncate' FROM documents LEFT JOIN l ON doc_id = row_index"""


def annotation_join(spark, sf):
    path = F.regexp_replace(F.col("url"), r"^https?://", "")
    pages = table(spark, sf, "pages").select("page_id", F.regexp_replace(path, r"[?#].*$", "").alias("path"))
    host = F.substring_index("path", "/", 1)
    whole = pages.where(F.col("page_id") % 2 == 0).select(
        host.alias("folder"), F.col("page_id").alias("row_index"), T.file_stem("path").alias("label"),
        F.lit("host").alias("level"))
    inner = pages.where(F.col("page_id") % 5 == 0).select(
        F.concat_ws("/", host, F.get(F.split("path", "/"), F.lit(1))).alias("folder"),
        F.col("page_id").alias("row_index"), T.file_stem("path").alias("label"), F.lit("language").alias("level"))
    return J.annotation_join(pages, whole.unionByName(inner)).select(
        "page_id", "path", "annotation_folder", "level")


ANNOTATION_SQL = r"""
WITH p AS (SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS path FROM pages),
s AS (SELECT *, string_split(path, '/') AS parts, regexp_replace(string_split(path, '/')[-1], '^(.+)\.[^.]*$', '\1') AS stem FROM p),
a AS (
  SELECT parts[1] AS folder, page_id AS row_index, stem AS label, 'host' AS level FROM s WHERE page_id % 2 = 0
  UNION ALL
  SELECT parts[1] || '/' || parts[2], page_id, stem, 'language' FROM s WHERE page_id % 5 = 0),
up AS (SELECT page_id, d, array_to_string(parts[1:d], '/') AS folder FROM s, range(1, 9) t(d) WHERE d < len(parts)),
near AS (SELECT page_id, arg_max(folder, d) AS folder FROM up WHERE folder IN (SELECT folder FROM a) GROUP BY 1),
first AS (SELECT folder, label, arg_min(level, row_index) AS level FROM a GROUP BY 1, 2)
SELECT s.page_id, s.path, CASE WHEN f.level IS NOT NULL THEN f.folder END AS annotation_folder, f.level
FROM s LEFT JOIN near USING (page_id) LEFT JOIN first f ON f.folder = near.folder AND f.label = s.stem"""


def layer_metadata(spark, sf):
    docs = table(spark, sf, "documents")
    inventory = docs.select(
        F.concat_ws("::", F.col("source"), F.col("doc_id").cast("string")).alias("sample_id"),
        F.concat_ws("/", F.col("lang"), F.col("source")).alias("source_file"), "doc_id",
        F.create_map(F.lit("subject"), F.lit("inferred"), F.lit("day"), F.col("lang")).alias("inferred"),
        F.when(F.col("lang") == "en", F.create_map(F.lit("trial"), F.col("doc_id").cast("string"))
               ).alias("sample_values"))
    labels = table(spark, sf, "labels").join(docs, "doc_id").select(
        F.concat_ws("::", F.col("source"), F.col("doc_id").cast("string")).alias("key"),
        F.create_map(F.lit("trial"), F.concat(F.lit("q"), F.col("quality").cast("string"))).alias("metadata"))
    files = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")).select(
        F.when(F.col("source").isin("src1", "src2"), F.concat(F.lit("fr/"), "source")).otherwise(
            F.col("source")).alias("key"),
        F.create_map(F.lit("subject"), F.col("source"), F.lit("band"), F.col("n").cast("string")).alias("metadata"))
    out = J.layer_metadata(inventory, labels.unionByName(files))
    return out.select("doc_id", *[F.col("metadata")[k].alias(k) for k in ("subject", "day", "trial", "band")])


LAYER_SQL = """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.source IN ('src1', 'src2') AND lang <> 'fr' THEN 'inferred' ELSE d.source END AS subject,
       lang AS day, coalesce('q' || l.quality, CASE WHEN lang = 'en' THEN CAST(d.doc_id AS VARCHAR) END) AS trial,
       CASE WHEN d.source IN ('src1', 'src2') AND lang <> 'fr' THEN NULL ELSE CAST(n.n AS VARCHAR) END AS band
FROM documents d JOIN n USING (source) LEFT JOIN labels l ON l.doc_id = d.doc_id"""


def attach_config(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("recording_id"))
    pairs = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("recording_id"),
        F.concat(F.lit(" Msg-"), "l_returnflag", F.lit(" (Hz)")).alias("key"),
        F.concat(F.lit(" "), F.col("l_partkey").cast("string")).alias("value"),
        F.struct("l_linenumber", "l_partkey").alias("row_index"))
    out = J.attach_config(orders, pairs)
    return out.select("recording_id", *[F.col("config")[f"msg_{c}_hz"].alias(c) for c in "anr"])


CONFIG_SQL = """
WITH l AS (
  SELECT l_orderkey, l_returnflag, arg_max(CAST(l_partkey AS VARCHAR), (l_linenumber, l_partkey)) AS v FROM lineitem GROUP BY 1, 2)
SELECT o_orderkey AS recording_id, max(CASE WHEN l_returnflag = 'A' THEN v END) AS a,
       max(CASE WHEN l_returnflag = 'N' THEN v END) AS n, max(CASE WHEN l_returnflag = 'R' THEN v END) AS r
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1"""


def coverage_diff(spark, sf):
    orders = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"))
    lines = table(spark, sf, "lineitem").where("l_returnflag <> 'A'").select(F.col("l_orderkey").alias("id"))
    return J.coverage_diff(orders, lines, "id")


COVERAGE_SQL = """
WITH a AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P'),
b AS (SELECT l_orderkey AS id FROM lineitem WHERE l_returnflag <> 'A')
SELECT id, 'missing' AS problem FROM (SELECT id FROM a EXCEPT SELECT id FROM b)
UNION ALL SELECT id, 'extra' FROM (SELECT id FROM b EXCEPT SELECT id FROM a)"""


def _run(spark, sf):
    orders = table(spark, sf, "orders")
    status = F.when(F.col("o_orderstatus") == "P", "failed").when(
        F.col("o_orderstatus") == "O", "skipped").otherwise("converted")
    records = orders.select(
        F.col("o_orderpriority").alias("dataset_id"), status.alias("status"),
        F.when(status != "failed", F.concat(F.lit("out/"), F.col("o_custkey").cast("string"))).alias("output"),
        F.when(status == "failed", F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(
            F.concat(F.lit("bad shape "), (F.col("o_orderkey") % 5).cast("string")))).alias("error"))
    members = table(spark, sf, "events").select(F.concat(
        F.lit("out/"), (F.col("user_id") * 7).cast("string"), F.lit("::"), F.col("event_id").cast("string")).alias("member"))
    files = table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.concat(F.lit("out/"), F.col("c_custkey").cast("string")).alias("path"))
    return records, members, files


RUN_SQL = """
rec AS (
  SELECT o_orderpriority AS dataset_id, o_orderkey, o_custkey,
         CASE o_orderstatus WHEN 'P' THEN 'failed' WHEN 'O' THEN 'skipped' ELSE 'converted' END AS status FROM orders),
files AS (SELECT 'out/' || c_custkey AS path FROM customer WHERE c_acctbal > 0),
lost AS (
  SELECT 'out/' || o_custkey AS path, 'output' AS kind FROM rec WHERE status <> 'failed' AND 'out/' || o_custkey NOT IN (SELECT path FROM files)
  UNION ALL
  SELECT 'out/' || (user_id * 7), 'split member' FROM events WHERE 'out/' || (user_id * 7) NOT IN (SELECT path FROM files))"""


def check_manifest(spark, sf):
    lost = J.check_manifest(*_run(spark, sf))
    return lost.groupBy("kind", "path").agg(F.count(F.lit(1)).alias("references"))


def manifest_ok(spark, sf):
    run = _run(spark, sf)
    return J.manifest_ok(run[0], J.check_manifest(*run))


def coverage_join(spark, sf):
    plan = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("plan_id"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string"), F.lit("/a")
                                                      ).alias("expected_path"))
    records = table(spark, sf, "customer").select(
        F.concat(F.when(F.col("c_acctbal") > 0, F.lit("wrap\\")).otherwise(F.lit("")), F.lit("n"),
                 F.col("c_nationkey").cast("string"), F.lit("/"),
                 F.when(F.col("c_mktsegment") == "BUILDING", "a").otherwise("b")).alias("path"),
        F.col("c_custkey").alias("record_order"))
    return J.coverage_join(plan, records, "wrap")


COVER_JOIN_SQL = r"""
WITH c AS (
  SELECT c_custkey AS record_order, 'n' || c_nationkey || '/' || CASE WHEN c_mktsegment = 'BUILDING' THEN 'a' ELSE 'b' END AS tail,
         CASE WHEN c_acctbal > 0 THEN 'wrap\' ELSE '' END AS head FROM customer),
f AS (SELECT tail AS expected_path, arg_max(head || tail, record_order) AS path, max(record_order) AS record_order FROM c GROUP BY 1)
SELECT s_suppkey AS plan_id, 'n' || s_nationkey || '/a' AS expected_path, path, record_order
FROM supplier JOIN f ON f.expected_path = 'n' || s_nationkey || '/a'"""


def enrich_catalog(spark, sf):
    catalog = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).alias("collection"))
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id"))
    adapters = orders.agg(F.count(F.lit(1)).alias("conversion"))
    splits = orders.agg(F.max("o_orderpriority").alias("split_settings"))
    examples = table(spark, sf, "orders").where("o_orderstatus = 'F'").groupBy(
        F.col("o_custkey").alias("id")).agg(F.min("o_orderkey").alias("example"))
    users = table(spark, sf, "events").groupBy(F.col("user_id").alias("id"))
    plans = users.agg(F.count(F.lit(1)).alias("sample_plan"))
    collections = users.agg(F.max("event_type").alias("collection"))
    return J.enrich_catalog(catalog, adapters, splits, examples, plans, collections)


ENRICH_SQL = """
WITH o AS (SELECT o_custkey AS id, count(*) AS conversion, max(o_orderpriority) AS split_settings,
                  min(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS example FROM orders GROUP BY 1),
e AS (SELECT user_id AS id, count(*) AS sample_plan, max(event_type) AS collection FROM events GROUP BY 1)
SELECT c_custkey AS id, conversion, split_settings, example, sample_plan,
       coalesce(CASE WHEN c_acctbal < 0 THEN c_mktsegment END, e.collection) AS collection
FROM customer JOIN o ON o.id = c_custkey AND example IS NOT NULL LEFT JOIN e ON e.id = c_custkey"""


def pending_sources(spark, sf):
    sources = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("source"), F.col("c_mktsegment").alias("view_options"),
        F.to_timestamp(F.lit("1997-01-01")).cast("timestamp_ntz").alias("modified"))
    manifest = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").alias("source"),
        F.when(F.col("o_orderstatus") == "P", F.lit("old")).otherwise(F.col("c_mktsegment")).alias("view_options"),
        F.col("o_orderdate").alias("output_modified"), (F.col("o_orderkey") % 4 == 0).alias("full_source_preserved"))
    return J.pending_sources(sources, manifest).select("source", "view_options")


PENDING_SQL = """
SELECT c_custkey AS source, c_mktsegment AS view_options FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus <> 'P'
                  AND o_orderkey % 4 = 0 AND o_orderdate >= TIMESTAMP '1997-01-01')"""


def check_companions(spark, sf):
    files = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("session"), F.concat(F.lit("f"), F.col("l_linenumber").cast("string")).alias("name"))
    out = J.check_companions(files, ["f1", "f2"], ["f7", "f6"])
    return out.select("session", F.array_join("missing", ",").alias("missing"),
                      F.array_join("optional_present", ",").alias("optional_present"), "error")


COMPANION_SQL = """
WITH h AS (SELECT l_orderkey AS session, bool_or(l_linenumber = 1) AS a, bool_or(l_linenumber = 2) AS b,
                  bool_or(l_linenumber = 6) AS f, bool_or(l_linenumber = 7) AS g FROM lineitem GROUP BY 1)
SELECT session, concat_ws(',', CASE WHEN NOT a THEN 'f1' END, CASE WHEN NOT b THEN 'f2' END) AS missing,
       concat_ws(',', CASE WHEN f THEN 'f6' END, CASE WHEN g THEN 'f7' END) AS optional_present,
       CASE WHEN NOT (a AND b) THEN 'expected session files missing: ' || session END AS error FROM h"""

QUERIES = {
    "pair_join": pair_join, "positional_join": positional_join, "annotation_join": annotation_join,
    "layer_metadata": layer_metadata, "attach_config": attach_config, "coverage_diff": coverage_diff,
    "check_manifest": check_manifest, "manifest_ok": manifest_ok, "coverage_join": coverage_join,
    "enrich_catalog": enrich_catalog, "pending_sources": pending_sources,
    "check_companions": check_companions,
}
SQL = {
    "pair_join": PAIR_SQL, "positional_join": POSITION_SQL, "annotation_join": ANNOTATION_SQL,
    "layer_metadata": LAYER_SQL, "attach_config": CONFIG_SQL, "coverage_diff": COVERAGE_SQL,
    "check_manifest": f'WITH {RUN_SQL} SELECT kind, path, count(*) AS "references" FROM lost GROUP BY 1, 2',
    "manifest_ok": f"""WITH {RUN_SQL},
        a AS (SELECT count_if(status = 'converted') AS converted, count_if(status = 'skipped') AS skipped,
                     count_if(status = 'failed') AS failed FROM rec),
        b AS (SELECT count_if(kind = 'output') AS missing_outputs, count_if(kind = 'split member') AS missing_members FROM lost)
        SELECT *, converted > 0 AND failed = 0 AND missing_outputs = 0 AND missing_members = 0 AS ok FROM a, b""",
    "coverage_join": COVER_JOIN_SQL, "enrich_catalog": ENRICH_SQL, "pending_sources": PENDING_SQL,
    "check_companions": COMPANION_SQL,
}
