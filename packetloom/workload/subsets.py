"""Queries over splits, inventories and representative subsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.functions.text import natural_key
from packetloom.operators import sampling as SA
from packetloom.operators import splits as SP
from packetloom.operators.ordered import with_neighbour
from packetloom.workload.tables import table


def _inventory(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("sample_id"), "doc_id", "lang", "source",
                       F.concat_ws("/", "lang", "source").alias("source_file"), "n_chars")


def _sizes(table_name: str, n: str = "n") -> str:
    """Largest-remainder sizes of 0.7/0.15/0.15 with stable ties, as SQL."""
    return f"""
    sz AS (
      SELECT {n}, floor(0.7::DOUBLE * {n}) AS f0, floor(0.15::DOUBLE * {n}) AS f1, 0.7::DOUBLE * {n} - floor(0.7::DOUBLE * {n}) AS r0,
             0.15::DOUBLE * {n} - floor(0.15::DOUBLE * {n}) AS r1 FROM {table_name}),
    cut AS (
      SELECT CAST(f0 + CASE WHEN CASE WHEN r1 > r0 THEN 2 ELSE 0 END < {n} - f0 - 2 * f1 THEN 1 ELSE 0 END AS BIGINT) AS n0,
             CAST(f1 + CASE WHEN CASE WHEN r0 >= r1 THEN 1 ELSE 0 END < {n} - f0 - 2 * f1 THEN 1 ELSE 0 END AS BIGINT) AS n1 FROM sz)"""


def random_split(spark, sf):
    out = SP.random_split(_inventory(spark, sf), seed=42)
    return out.select("sample_id", "split_rank", "partition")


RANDOM_CORE = f"""
tot AS (SELECT count(*) AS n FROM documents), {_sizes('tot')},
rk AS (SELECT CAST(doc_id AS VARCHAR) AS sample_id,
              row_number() OVER (ORDER BY md5(doc_id || ':42'), CAST(doc_id AS VARCHAR)) - 1 AS split_rank FROM documents),
sp AS (SELECT sample_id, split_rank, CASE WHEN split_rank < n0 THEN 'train' WHEN split_rank < n0 + n1 THEN 'val' ELSE 'test' END
       AS "partition" FROM rk, cut)"""


def split_manifest(spark, sf):
    out = SP.split_manifest(SP.random_split(_inventory(spark, sf), seed=42), "random", "random")
    return out.select("partition", "members", "setting", "kind", "provenance",
                      F.col("seed").cast("long").alias("seed"), F.array_join(
                          F.transform("ratios", lambda r: r.cast("string")), ",").alias("ratios"))


def predefined_split(spark, sf):
    inv = _inventory(spark, sf)
    path = F.concat_ws("/", F.lit("data"), F.when(F.col("lang") == "en", "training").when(
        F.col("lang") == "fr", "Validation").when(F.col("lang") == "es", "pretest").otherwise("x_test.npz"), "source")
    rows = inv.withColumn("source_file", path)
    out = SP.predefined_split(rows, check=False, split=SP.path_split("source_file"))
    return out.select("sample_id", "source_file", "partition")


def group_holdout(spark, sf):
    out = SP.group_holdout(_inventory(spark, sf), F.col("source"), seed=7)
    return out.select("sample_id", "group", "partition")


GROUP_CORE = """
g AS (SELECT DISTINCT source AS grp, CAST(regexp_extract(source, '([0-9]+)', 1) AS INT) AS num FROM documents),
last AS (SELECT arg_max(grp, num) AS grp FROM g),
rest AS (SELECT grp, row_number() OVER (ORDER BY md5(grp || ':7'), grp) - 1 AS r, count(*) OVER () AS m
         FROM g WHERE grp NOT IN (SELECT grp FROM last)),
asg AS (
  SELECT grp, CASE WHEN r < CASE WHEN m < 2 THEN 0 ELSE greatest(1, round_even((SELECT count(*) FROM g) * 0.15::DOUBLE, 0)) END
         THEN 'val' ELSE 'train' END AS "partition" FROM rest
  UNION ALL SELECT grp, 'test' FROM last)"""


def group_holdout_named(spark, sf):
    cust = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("sample_id"), F.lit("c").alias("source_file"),
        F.col("c_nationkey").alias("nation"))
    out = SP.group_holdout(cust, F.col("nation"), [0.5, 0.0, 0.5], holdout=["3", "11"])
    return out.groupBy("group", "partition").agg(F.count(F.lit(1)).alias("members"))


def leaked_groups(spark, sf):
    split = SP.random_split(_inventory(spark, sf), seed=42)
    return SP.leaked_groups(split, "source")


def trial_order_split(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("source_file"),
        F.when(F.col("o_orderstatus") != "P", F.format_string("%02d", F.col("o_orderkey") % 31)).alias("trial"))
    return SP.trial_order_split(orders, F.col("trial"), check=False).select("o_orderkey", "partition")


def source_groups(spark, sf):
    return SP.source_groups(_inventory(spark, sf), F.col("source")).select("sample_id", "partition")


def build_inventory(spark, sf):
    orders = table(spark, sf, "orders")
    n = (F.col("o_orderkey") % 3 + 1).cast("int")
    recordings = orders.select(
        F.when(F.col("o_orderstatus") == "P", "failed").when(F.col("o_orderstatus") == "O", "skipped")
        .otherwise("converted").alias("status"),
        F.concat(F.lit("out/"), F.col("o_orderkey").cast("string")).alias("output"),
        F.concat(F.lit("room"), F.col("o_custkey").cast("string"), F.lit("/user_"),
                 F.col("o_orderkey").cast("string"), F.lit(".mat")).alias("source_file"),
        n.alias("sample_count"),
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.create_map(
            F.lit("day"), F.concat(F.lit("d"), i.cast("string")))).alias("sample_values"))
    overrides = table(spark, sf, "customer").select(
        F.concat(F.lit("out/"), F.col("c_custkey").cast("string"), F.lit("::1")).alias("key"),
        F.create_map(F.lit("day"), F.col("c_mktsegment")).alias("metadata"))
    out = SP.build_inventory(recordings, overrides)
    return out.select("sample_id", F.col("index").cast("long").alias("index"),
                      *[F.col("metadata")[k].alias(k) for k in ("subject", "environment", "day")])


INVENTORY_SQL = """
WITH r AS (SELECT *, o_orderkey % 3 + 1 AS n, unnest(range(o_orderkey % 3 + 1)) AS i FROM orders WHERE o_orderstatus <> 'P')
SELECT 'out/' || o_orderkey || CASE WHEN n > 1 THEN '::' || i ELSE '' END AS sample_id,
       CASE WHEN n > 1 THEN CAST(i AS BIGINT) END AS index,
       CASE WHEN o_orderkey = 0 THEN '0' ELSE CAST(o_orderkey AS VARCHAR) END AS subject,
       CAST(o_custkey AS VARCHAR) AS environment,
       CASE WHEN n > 1 AND i = 1 AND c_custkey IS NOT NULL THEN c_mktsegment WHEN n > 1 THEN 'd' || i END AS day
FROM r LEFT JOIN customer ON c_custkey = o_orderkey"""


def natural_order(spark, sf):
    docs = table(spark, sf, "documents").select("source").distinct().unionByName(
        table(spark, sf, "supplier").select(
            F.concat(F.lit("Nation"), F.col("s_nationkey").cast("string"), F.lit("_x")).alias("source")))
    number = F.regexp_extract("source", "([0-9]+)", 1).try_cast("long")
    names = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")).select(
        "source", "n", F.col("source").startswith("Nation").alias("kind"), natural_key("source").alias("key"),
        F.floor(number / F.lit(64)).alias("bucket"))
    rows = with_neighbour(names, ["kind"], ["key"], "bucket", ["source"], "next")
    return rows.select("source", "n", F.col("next.source").alias("successor"))


NATURAL_SQL = """
WITH a AS (SELECT DISTINCT source FROM documents UNION ALL SELECT 'Nation' || s_nationkey || '_x' FROM supplier),
n AS (SELECT source, count(*) AS n, CAST(regexp_extract(source, '([0-9]+)', 1) AS INT) AS k FROM a GROUP BY 1)
SELECT source, n, lead(source) OVER (PARTITION BY source LIKE 'Nation%' ORDER BY k) AS successor FROM n"""


def coverage_plan(spark, sf):
    plan = table(spark, sf, "events").select(
        F.col("event_type").alias("task"), F.col("event_id").alias("position"),
        F.concat(F.lit("f"), F.col("user_id").cast("string")).alias("file"))
    return SA.coverage_plan(plan)


PLAN_SQL = """
WITH f AS (SELECT event_type AS task, 'f' || user_id AS file, min(event_id) AS p FROM events GROUP BY 1, 2)
SELECT task, file, row_number() OVER (PARTITION BY task ORDER BY p) AS file_order FROM f
UNION ALL SELECT DISTINCT event_type, event_type || '/metadata/label_mapping.json', 0 FROM events"""


def clip_per_action(spark, sf):
    actions = table(spark, sf, "part").select(F.col("p_size").alias("action_id")).distinct()
    return SA.clip_per_action(actions, 1, 2)


def stratified_pick(spark, sf):
    em = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("index"), (F.col("vec_id") % 16).alias("location"), F.col("label").alias("gesture"))
    return SA.stratified_pick(em, "location", F.col("location") % 6, "gesture")


def stratified_completeness(spark, sf):
    """Which of the seventeen declared locations the picks of sixteen reach."""
    declared = table(spark, sf, "embeddings").select((F.col("vec_id") % 17).alias("location"))
    return SA.completeness(stratified_pick(spark, sf), declared, "location", "no sample of location")


def pick_per_class(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "n_chars", F.when(
        F.col("lang") == "de", F.lit("global")).otherwise(F.concat_ws("/", "lang", "source")).alias("class"))
    return SA.pick_per_class(docs, "class", F.struct("n_chars", "doc_id")).select("class", "doc_id", "n_chars")


def class_coverage(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        F.concat_ws("/", "lang", "source").alias("class"), "doc_id")
    picked = SA.pick_per_class(docs, "class", F.col("doc_id"))
    sources = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: F.concat(F.lit("src"), i.cast("string")))
    documented = table(spark, sf, "documents").select("lang").distinct().select(
        "lang", F.explode(sources).alias("source")).select(F.concat_ws("/", "lang", "source").alias("class"))
    return SA.class_coverage(picked, documented, "class")


def greedy_cover(spark, sf):
    part = table(spark, sf, "part")
    items = part.select(F.col("p_partkey").alias("id"),
                        F.concat(F.split("p_name", " "), F.array("p_brand", "p_type")).alias("features"))
    return SA.cover_steps(items, "features", F.col("id")).join(part, F.col("id") == F.col("p_partkey")).select(
        "step", "gain", "p_partkey", "p_name", "p_brand", "p_type")


COVER_SQL = """
WITH RECURSIVE item AS (
  SELECT p_partkey AS id, list_distinct(string_split(p_name, ' ') || [p_brand, p_type]) AS f FROM part),
pick AS (
  SELECT CAST(0 AS BIGINT) AS step, CAST(0 AS BIGINT) AS id, CAST(0 AS BIGINT) AS gain, CAST([] AS VARCHAR[]) AS covered
  UNION ALL
  SELECT * FROM (
    SELECT step + 1, i.id, CAST(len(list_filter(i.f, lambda x: NOT list_contains(covered, x))) AS BIGINT) AS won, covered || i.f
    FROM pick, item i ORDER BY won DESC, i.id LIMIT 1) WHERE won > 0)
SELECT step, gain, p_partkey, p_name, p_brand, p_type FROM pick JOIN part ON p_partkey = id WHERE step > 0"""


QUERIES = {
    "random_split": random_split, "split_manifest": split_manifest, "predefined_split": predefined_split,
    "group_holdout": group_holdout, "group_holdout_named": group_holdout_named,
    "leaked_groups": leaked_groups, "trial_order_split": trial_order_split, "source_groups": source_groups,
    "build_inventory": build_inventory, "natural_order": natural_order, "coverage_plan": coverage_plan,
    "clip_per_action": clip_per_action, "stratified_pick": stratified_pick,
    "stratified_completeness": stratified_completeness, "pick_per_class": pick_per_class,
    "class_coverage": class_coverage, "greedy_cover": greedy_cover,
}
SQL = {
    "random_split": f'WITH {RANDOM_CORE} SELECT sample_id, split_rank, "partition" FROM sp',
    "split_manifest": f"""WITH {RANDOM_CORE} SELECT "partition", count(*) AS members, 'random' AS setting, 'random' AS kind,
        'hub' AS provenance, CAST(42 AS BIGINT) AS seed, '0.7,0.15,0.15' AS ratios FROM sp GROUP BY 1""",
    "predefined_split": """SELECT CAST(doc_id AS VARCHAR) AS sample_id, 'data/' || CASE lang WHEN 'en' THEN 'training'
        WHEN 'fr' THEN 'Validation' WHEN 'es' THEN 'pretest' ELSE 'x_test.npz' END || '/' || source AS source_file,
        CASE lang WHEN 'en' THEN 'train' WHEN 'fr' THEN 'val' WHEN 'es' THEN NULL ELSE 'test' END AS "partition" FROM documents""",
    "group_holdout": f"""WITH {GROUP_CORE} SELECT CAST(doc_id AS VARCHAR) AS sample_id, source AS "group", "partition"
        FROM documents JOIN asg ON grp = source""",
    "group_holdout_named": """SELECT CAST(c_nationkey AS VARCHAR) AS "group", CASE WHEN c_nationkey IN (3, 11) THEN 'test' ELSE 'train' END
        AS "partition", count(*) AS members FROM customer GROUP BY 1, 2""",
    "leaked_groups": f"""WITH {RANDOM_CORE} SELECT source, count(DISTINCT "partition") AS partitions FROM sp
        JOIN documents ON CAST(doc_id AS VARCHAR) = sample_id GROUP BY 1 HAVING count(DISTINCT "partition") > 1""",
    "trial_order_split": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 31 <= 14 THEN 'train'
        ELSE 'test' END AS "partition" FROM orders""",
    "source_groups": """SELECT CAST(doc_id AS VARCHAR) AS sample_id, source AS "partition" FROM documents""",
    "build_inventory": INVENTORY_SQL, "natural_order": NATURAL_SQL, "coverage_plan": PLAN_SQL,
    "clip_per_action": """SELECT DISTINCT p_size AS action_id, '01_' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '_02.npy' AS file FROM part""",
    "stratified_pick": """SELECT vec_id % 16 AS location, vec_id AS index, label AS gesture FROM embeddings
        QUALIFY row_number() OVER (PARTITION BY vec_id % 16 ORDER BY CASE WHEN label = vec_id % 16 % 6 THEN 0 ELSE 1 END, vec_id) = 1""",
    "stratified_completeness": """SELECT DISTINCT vec_id % 17 AS location, CASE WHEN vec_id % 17 < 16 THEN 1 ELSE 0 END AS rows,
        CASE WHEN vec_id % 17 = 16 THEN 'no sample of location: 16' END AS error FROM embeddings""",
    "pick_per_class": """WITH d AS (SELECT *, CASE WHEN lang = 'de' THEN 'global' ELSE lang || '/' || source END AS class FROM documents)
        SELECT class, doc_id, n_chars FROM d QUALIFY row_number() OVER (PARTITION BY class ORDER BY n_chars, doc_id) = 1""",
    "class_coverage": """SELECT a.lang || '/' || b.source AS class FROM (SELECT DISTINCT lang FROM documents) a,
        (SELECT 'src' || i AS source FROM range(20) t(i)) b
        WHERE a.lang || '/' || b.source NOT IN (SELECT lang || '/' || source FROM documents d JOIN labels l ON l.doc_id = d.doc_id)""",
    "greedy_cover": COVER_SQL,
}
