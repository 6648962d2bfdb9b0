"""Queries over quality reports, catalogs and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.functions import text as T
from packetloom.operators import catalog as C
from packetloom.operators import quality as Q
from packetloom.workload.links import RUN_SQL, _run
from packetloom.workload.tables import FULL_SQL, q6, r6, table


def quality_report(spark, sf):
    em = table(spark, sf, "embeddings").select(
        F.col("label").alias("recording_id"), F.transform(
            "embedding", lambda x, i: F.when(i == 5, F.lit(float("nan")).cast("float")).when(
                i == 6, F.lit(float("inf")).cast("float")).otherwise(x)).alias("signal"),
        F.col("vec_id").alias("packet_index"), (F.col("vec_id") % 3 > 0).alias("valid"))
    out = Q.quality_report(em, ["signal", "packet_index"])
    return out.select("recording_id", "array", "dtype", "packets", "width", "nan_count",
                      r6("min").alias("min"), r6("max").alias("max"), r6("mean").alias("mean"),
                      r6("valid_fraction").alias("valid_fraction"))


QUALITY_SQL = f"""WITH {FULL_SQL},
f AS (SELECT label, avg(CASE WHEN vec_id % 3 > 0 THEN 1 ELSE 0 END) AS vf, count(*) AS n FROM embeddings GROUP BY 1)
SELECT c.label AS recording_id, 'signal' AS array, 'float' AS dtype, any_value(n) AS packets, CAST(64 AS BIGINT) AS width,
       CAST(any_value(n) AS BIGINT) AS nan_count, {q6('min(x)')} AS min, {q6('max(x)')} AS max, {q6('avg(x)')} AS mean,
       {q6('any_value(vf)')} AS valid_fraction
FROM full_cells c JOIN f ON f.label = c.label WHERE pos NOT IN (5, 6) GROUP BY c.label
UNION ALL
SELECT e.label, 'packet_index', 'long', any_value(n), 1, 0, {q6('min(vec_id)')}, {q6('max(vec_id)')}, {q6('avg(vec_id)')},
       {q6('any_value(vf)')}
FROM embeddings e JOIN f ON f.label = e.label GROUP BY e.label"""


def robust_range(spark, sf):
    li = table(spark, sf, "lineitem")
    flag = li.select("l_returnflag", "l_extendedprice", "l_discount", "l_tax")
    plain = Q.robust_range(flag, F.col("l_extendedprice"), ["l_returnflag"]).withColumn("what", F.lit("price"))
    signed = Q.robust_range(flag, F.col("l_tax") - F.col("l_discount"), ["l_returnflag"], signed=True
                            ).withColumn("what", F.lit("signed"))
    flat = Q.robust_range(flag, F.col("l_tax") * 0 + 3.0, ["l_returnflag"]).withColumn("what", F.lit("flat"))
    out = plain.unionByName(signed).unionByName(flat)
    return out.select("what", "l_returnflag", r6("low").alias("low"), r6("high").alias("high"))


RANGE_SQL = f"""
SELECT 'price' AS what, l_returnflag, {q6('quantile_cont(l_extendedprice, 0.02)')} AS low,
       {q6('quantile_cont(l_extendedprice, 0.98)')} AS high FROM lineitem GROUP BY 2
UNION ALL
SELECT 'signed', l_returnflag, {q6('-quantile_cont(abs(l_tax - l_discount), 0.99)')},
       {q6('quantile_cont(abs(l_tax - l_discount), 0.99)')} FROM lineitem GROUP BY 2
UNION ALL SELECT DISTINCT 'flat', l_returnflag, 3.0, 4.0 FROM lineitem"""


def overall_range(spark, sf):
    out = Q.robust_range(table(spark, sf, "lineitem"), F.col("l_extendedprice"))
    return out.select(r6("low").alias("low"), r6("high").alias("high"))


def manifest_summary(spark, sf):
    return Q.manifest_summary(_run(spark, sf)[0])


def failure_groups(spark, sf):
    return Q.failure_groups(_run(spark, sf)[0])


def label_sets(spark, sf):
    out = Q.label_sets(table(spark, sf, "lineitem"), {"flags": "l_returnflag", "lines": "l_linenumber"},
                       ["l_orderkey"])
    return out.select("l_orderkey", F.array_join("flags", ",").alias("flags"), F.array_join("lines", ",").alias("lines"))


def assert_uniform(spark, sf):
    em = table(spark, sf, "embeddings").select(F.col("label").alias("recording_id"), F.slice(
        "embedding", F.lit(1), F.when(F.col("vec_id") % 40 == 0, 60).otherwise(64)).alias("x"))
    return Q.assert_uniform(em, "x")


def search_catalog(spark, sf):
    part = table(spark, sf, "part")
    found = C.search_catalog(part, "ECONOMY", "Brand#7", " RING ", "p_type", "p_brand")
    return found.select("p_partkey", "p_name")


def catalog_stats(spark, sf):
    catalog = table(spark, sf, "customer")
    tasks = catalog.select("c_mktsegment").distinct()
    access = F.when(F.col("c_acctbal") > 0, F.lit("direct")).otherwise(F.lit("account"))
    return C.catalog_stats(catalog, tasks, F.col("c_nationkey"), access)


def task_counts(spark, sf):
    part = table(spark, sf, "part").select(F.array_distinct(F.concat(
        F.split("p_name", " "), F.array("p_type"))).alias("tasks"))
    tasks = table(spark, sf, "nation").select(F.col("n_name").alias("id")).unionByName(
        table(spark, sf, "part").select(F.col("p_type").alias("id")).distinct())
    return C.task_counts(part, tasks)


def catalog_rollup(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return C.catalog_rollup(docs, ["lang", "source", "quality"])


def validate_catalog(spark, sf):
    part = table(spark, sf, "part")
    size = F.col("p_size")
    catalog = part.select(
        F.col("p_partkey").alias("file"), F.when(size == 7, F.lit("same")).otherwise(
            F.concat(F.lit("d"), F.col("p_partkey").cast("string"))).alias("id"),
        F.col("p_name").alias("name"), F.when(size != 3, F.lit(2020)).alias("year"),
        F.lit("summary").alias("summary"), F.array(F.col("p_type"), F.col("p_brand")).alias("tasks"),
        F.array(F.lit("csi")).alias("modalities"), F.struct(F.lit("x").alias("platform")).alias("hardware"),
        F.lit("s").alias("settings"), F.lit("s").alias("scale"),
        F.struct(F.when(size % 11 == 0, F.lit("ftp://x")).otherwise(F.lit("https://x.org/a")).alias("landing_page")
                 ).alias("original"),
        F.lit("s").alias("standardization"),
        F.when(size == 5, F.array().cast("array<struct<url:string>>")).otherwise(F.array(F.struct(
            F.when(size == 9, F.lit("http:/broken")).otherwise(F.lit("http://ok.org")).alias("url")))).alias("sources"),
        F.lit("2026-01-01").alias("verified_at"))
    tasks = part.select(F.col("p_type").alias("id")).distinct().unionByName(
        part.where("p_size <> 4").select(F.col("p_brand").alias("id")).distinct()).where("id <> 'Brand#3'")
    return C.validate_catalog(catalog, tasks)


VALIDATE_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS file, 'missing field year' AS violation FROM part WHERE p_size = 3
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'at least one source is required' FROM part WHERE p_size = 5
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'invalid source URL' FROM part WHERE p_size = 9
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'invalid landing page' FROM part WHERE p_size % 11 = 0
UNION ALL SELECT * FROM (SELECT CAST(p_partkey AS VARCHAR), 'duplicate id same' FROM part WHERE p_size = 7
          QUALIFY row_number() OVER (ORDER BY p_partkey) > 1)
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'unknown task Brand#3' FROM part WHERE p_brand = 'Brand#3'"""


def _registry(spark, sf):
    cust = table(spark, sf, "customer")
    name = F.concat(F.lit("d"), F.col("c_custkey").cast("string"))
    catalog = cust.where("c_custkey % 50 <> 1").select(name.alias("id"))
    return cust.where("c_custkey % 50 <> 2").withColumn("id", name), catalog


def validate_adapters(spark, sf):
    rows, catalog = _registry(spark, sf)
    registry = rows.select(
        "id", F.when(F.col("c_nationkey") == 1, F.lit("mystery")).when(
            F.col("c_nationkey") == 2, F.col("id")).otherwise(F.lit("generic")).alias("handler"),
        F.when(F.col("c_nationkey") == 3, F.array().cast("array<string>")).otherwise(
            F.array(F.lit("**/*.csv"))).alias("patterns"),
        F.when(F.col("c_nationkey") == 4, F.lit("sketch")).otherwise(F.lit("format-profile")).alias("implementation"),
        F.when(F.col("c_nationkey") == 5, F.lit("none")).otherwise(F.lit("https://x.org")).alias("official_reference"))
    return C.validate_adapters(registry, catalog)


GAP_SQL = """
UNION ALL SELECT 'd' || c_custkey, 'missing registry entry' FROM customer WHERE c_custkey % 50 = 2
UNION ALL SELECT 'd' || c_custkey, 'extra registry entry' FROM customer WHERE c_custkey % 50 = 1"""
ADAPTER_SQL = """
WITH r AS (SELECT 'd' || c_custkey AS id, c_nationkey AS n, c_custkey FROM customer WHERE c_custkey % 50 <> 2)
SELECT id, 'unknown handler' AS violation FROM r WHERE n = 1 OR (n = 2 AND c_custkey % 50 = 1)
UNION ALL SELECT id, 'no source patterns' FROM r WHERE n = 3
UNION ALL SELECT id, 'invalid implementation tier' FROM r WHERE n = 4
UNION ALL SELECT id, 'no valid official reference' FROM r WHERE n = 5""" + GAP_SQL


def validate_splits(spark, sf):
    rows, catalog = _registry(spark, sf)
    n = F.col("c_nationkey")
    kind = F.when(n == 1, "lottery").when(n == 2, "group_holdout").otherwise("random")
    setting = F.struct(
        F.lit("a").alias("id"), kind.alias("kind"), F.when(n == 3, "rumour").otherwise("hub").alias("provenance"),
        F.when(F.col("c_acctbal") > 0, F.lit("subject")).alias("group_by"))
    registry = rows.select("id", F.when(n == 4, "b").otherwise("a").alias("default"), F.when(
        n == 5, F.array(setting, setting)).otherwise(F.array(setting)).alias("settings"))
    return C.validate_splits(registry, catalog)


SPLIT_REGISTRY_SQL = """
WITH r AS (SELECT 'd' || c_custkey AS id, c_nationkey AS n, c_acctbal AS b FROM customer WHERE c_custkey % 50 <> 2)
SELECT id, 'invalid default' AS violation FROM r WHERE n = 4
UNION ALL SELECT id, 'duplicate setting ids' FROM r WHERE n = 5
UNION ALL SELECT id || '/a', 'unknown kind' FROM r WHERE n = 1
UNION ALL SELECT id || '/a', 'invalid provenance' FROM r WHERE n = 3
UNION ALL SELECT id || '/a', 'needs group_by' FROM r WHERE n = 2 AND b <= 0""" + GAP_SQL


def validate_examples(spark, sf):
    part = table(spark, sf, "part")
    rows = part.select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") == 1, F.lit(" ")).otherwise(F.col("p_name")).alias("source_path"),
        F.when(F.col("p_size") == 2, F.lit(None)).otherwise(F.lit("amplitude")).alias("primary_array"),
        F.col("p_type").alias("expected_shape"), F.when(F.col("p_size") < 3, F.lit("")).otherwise(F.lit("n")).alias("note"))
    return C.validate_examples(rows)


EXAMPLE_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS id, 'invalid source_path' AS violation FROM part WHERE p_size = 1
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'invalid primary_array' FROM part WHERE p_size = 2
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'invalid note' FROM part WHERE p_size < 3"""


def check_constraints(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").withColumn(
        "words", F.split("text", " ")).withColumn(
        "day", F.when(F.col("n_chars") % 7 == 0, F.lit("2026-02-30")).otherwise(F.lit("2026-02-27")))
    return C.check_constraints(docs, "doc_id", {
        "lang": {"enum": ["en", "fr", "de"]}, "source": {"pattern": "^src1?[0-5]$", "min_length": 5},
        "quality": {"required": True, "minimum": 1}, "n_chars": {"maximum": 9000, "exclusive_minimum": 40},
        "words": {"min_items": 6, "unique_items": True}, "day": {"date": True}})


CONSTRAINT_SQL = r"""
WITH d AS (
  SELECT d.*, l.quality, string_split(text, ' ') AS words FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT CAST(doc_id AS VARCHAR) AS id, 'lang: enum' AS violation FROM d WHERE lang NOT IN ('en', 'fr', 'de')
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'source: pattern' FROM d WHERE NOT regexp_matches(source, '^src1?[0-5]$')
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'source: min_length' FROM d WHERE length(source) < 5
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'quality: required' FROM d WHERE quality IS NULL
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'quality: minimum' FROM d WHERE quality < 1
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'n_chars: maximum' FROM d WHERE n_chars > 9000
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'n_chars: exclusive_minimum' FROM d WHERE n_chars <= 40
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'words: min_items' FROM d WHERE len(words) < 6
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'words: unique_items' FROM d WHERE len(list_distinct(words)) < len(words)
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'day: date' FROM d WHERE n_chars % 7 = 0"""


def with_rejects(spark, sf):
    li = table(spark, sf, "lineitem")
    good, bad = C.with_rejects(li, {
        "no quantity": F.col("l_quantity") > 3, "discount too high": F.col("l_discount") < 0.1,
        "returned": F.col("l_returnflag") != "R"})
    both = bad.select("error").unionByName(good.select(F.lit(None).cast("string").alias("error")))
    return C.conversion_records(both).groupBy("status", "error").agg(F.count(F.lit(1)).alias("records"))


REJECT_SQL = """
WITH e AS (SELECT CASE WHEN NOT l_quantity > 3 THEN 'no quantity' WHEN NOT l_discount < 0.1 THEN 'discount too high'
                  WHEN l_returnflag = 'R' THEN 'returned' END AS error FROM lineitem)
SELECT CASE WHEN error IS NULL THEN 'converted' ELSE 'failed' END AS status, error, count(*) AS records FROM e GROUP BY 1, 2"""


def expand_vocabulary(spark, sf):
    part = table(spark, sf, "part")
    size = F.col("p_size").cast("string")
    text = F.concat(F.lit("Labels: "), "p_name", F.lit(" · S"), F.lpad(size, 3, "0"), F.lit("–"),
                    (F.col("p_size") + 4).cast("string"), F.lit(" , "), "p_brand", F.lit(" | x "),
                    size, F.lit("-3"))
    return part.select("p_partkey", F.posexplode(T.expand_vocabulary(text)).alias("pos", "entry"))


EXPAND_SQL = """
WITH a AS (
  SELECT p_partkey, 0 AS g, 0 AS k, p_name AS entry FROM part
  UNION ALL SELECT p_partkey, 1, i, 'S' || lpad(CAST(p_size + i AS VARCHAR), 3, '0') FROM part, range(5) t(i)
  UNION ALL SELECT p_partkey, 2, 0, p_brand FROM part
  UNION ALL SELECT p_partkey, 3, 0, 'x ' || p_size || '-3' FROM part WHERE p_size > 3
  UNION ALL SELECT p_partkey, 3, i, 'x ' || i FROM part, range(1, 4) t(i) WHERE p_size <= 3 AND i >= p_size)
SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY g, k) - 1 AS INT) AS pos, entry FROM a"""

QUERIES = {
    "quality_report": quality_report, "robust_range": robust_range, "overall_range": overall_range,
    "manifest_summary": manifest_summary, "failure_groups": failure_groups, "label_sets": label_sets,
    "assert_uniform": assert_uniform, "search_catalog": search_catalog, "catalog_stats": catalog_stats,
    "task_counts": task_counts, "catalog_rollup": catalog_rollup, "validate_catalog": validate_catalog,
    "validate_adapters": validate_adapters, "validate_splits": validate_splits,
    "validate_examples": validate_examples, "check_constraints": check_constraints,
    "with_rejects": with_rejects, "expand_vocabulary": expand_vocabulary,
}
SQL = {
    "quality_report": QUALITY_SQL, "robust_range": RANGE_SQL,
    "overall_range": f"""SELECT {q6('quantile_cont(l_extendedprice, 0.02)')} AS low,
        {q6('quantile_cont(l_extendedprice, 0.98)')} AS high FROM lineitem""",
    "manifest_summary": f"""WITH {RUN_SQL} SELECT dataset_id, count(*) AS source_count,
        count_if(status = 'converted') AS converted, count_if(status = 'skipped') AS skipped,
        count_if(status = 'failed') AS failed FROM rec GROUP BY 1""",
    "failure_groups": """SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'unknown error' ELSE 'bad shape ' || (o_orderkey % 5) END AS error,
        count(*) AS records FROM orders WHERE o_orderstatus = 'P' GROUP BY 1""",
    "label_sets": """SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags,
        string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) AS lines
        FROM lineitem GROUP BY 1""",
    "assert_uniform": """SELECT label AS recording_id, CAST(min(CASE WHEN vec_id % 40 = 0 THEN 60 ELSE 64 END) AS INT) AS narrowest,
        CAST(max(CASE WHEN vec_id % 40 = 0 THEN 60 ELSE 64 END) AS INT) AS widest,
        CASE WHEN bool_or(vec_id % 40 = 0) AND NOT bool_and(vec_id % 40 = 0) THEN 'inconsistent vector lengths' END AS error
        FROM embeddings GROUP BY 1""",
    "search_catalog": """SELECT p_partkey, p_name FROM part WHERE p_type = 'ECONOMY' AND p_brand = 'Brand#7'
        AND contains(lower(p_name), 'ring')""",
    "catalog_stats": """SELECT count(*) AS datasets, count(DISTINCT c_nationkey) AS hardware_platforms,
        count_if(c_acctbal > 0) AS open_or_direct, count(DISTINCT c_mktsegment) AS tasks FROM customer""",
    "task_counts": """WITH t AS (SELECT unnest(list_distinct(list_append(string_split(p_name, ' '), p_type))) AS task FROM part),
        k AS (SELECT n_name AS task FROM nation UNION ALL SELECT DISTINCT p_type FROM part)
        SELECT k.task, count(t.task) AS dataset_count FROM k LEFT JOIN t ON t.task = k.task GROUP BY 1""",
    "catalog_rollup": """WITH d AS (SELECT lang, source, quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
        SELECT 'lang' AS facet, lang AS value, count(*) AS entries FROM d GROUP BY 2
        UNION ALL SELECT 'source', source, count(*) FROM d GROUP BY 2
        UNION ALL SELECT 'quality', CAST(quality AS VARCHAR), count(*) FROM d GROUP BY 2""",
    "validate_catalog": VALIDATE_SQL, "validate_adapters": ADAPTER_SQL,
    "validate_splits": SPLIT_REGISTRY_SQL, "validate_examples": EXAMPLE_SQL,
    "check_constraints": CONSTRAINT_SQL, "with_rejects": REJECT_SQL, "expand_vocabulary": EXPAND_SQL,
}
