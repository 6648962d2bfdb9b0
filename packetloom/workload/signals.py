"""Queries over per-packet signal arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.functions import arrays as A
from packetloom.functions import text as T
from packetloom.operators import signal as S
from packetloom.workload.tables import (
    FULL_SQL, IQ_SQL, cells, embedding_packets, q6, r6, table)


def amplitude(spark, sf):
    return cells(S.add_amplitude(embedding_packets(spark, sf)), "amplitude", "vec_id")


def phase(spark, sf):
    return cells(S.add_phase(embedding_packets(spark, sf)), "phase_rad", "vec_id")


def from_polar(spark, sf):
    polar = embedding_packets(spark, sf).select(
        "vec_id", F.col("csi_real").alias("amplitude"), F.col("csi_imag").alias("phase_rad"))
    rows = S.from_polar(polar)
    both = rows.select("vec_id", F.posexplode(F.arrays_zip("csi_real", "csi_imag")).alias("pos", "z"))
    return both.select("vec_id", "pos", r6("z.csi_real").alias("re"), r6("z.csi_imag").alias("im"))


def power_db(spark, sf):
    packets = S.add_amplitude(embedding_packets(spark, sf)).withColumn(
        "valid", F.get("csi_real", F.lit(0)) > 0)
    out = S.power_db_rel(packets, ["label"])
    rows = out.select("vec_id", r6(F.col("reference_power") * 1e3).alias("reference"),
                      F.posexplode("power_db_rel").alias("pos", "x"))
    return rows.withColumn("x", r6(F.round(F.col("x").cast("double"), 3)))


POWER_SQL = f"""WITH {IQ_SQL},
amp AS (
  SELECT *, CAST(CAST(sqrt(re * re + im * im) AS FLOAT) AS DOUBLE) AS a,
         first_value(re) OVER (PARTITION BY vec_id ORDER BY pos) > 0 AS valid FROM iq),
ref AS (SELECT label, greatest(median(a * a), 1.1754943508222875e-38) AS ref FROM amp WHERE valid GROUP BY 1)
SELECT vec_id, pos, {q6('coalesce(ref, 1.0) * 1e3')} AS reference,
       {q6('''round(CAST(CAST(CASE WHEN valid THEN 10.0 * log10(greatest(a * a, 1.1754943508222875e-38)
            / coalesce(ref, 1.0)) ELSE 0 END AS FLOAT) AS DOUBLE), 3)''')} AS x
FROM amp LEFT JOIN ref USING (label)"""


def deinterleave(spark, sf):
    rows = S.deinterleave_iq(table(spark, sf, "embeddings"), "embedding")
    both = rows.select("vec_id", F.posexplode(F.arrays_zip("csi_real", "csi_imag")).alias("pos", "z"))
    return both.select("vec_id", "pos", r6("z.csi_real").alias("re"), r6("z.csi_imag").alias("im"))


def select_subcarriers(spark, sf):
    rows = S.select_subcarriers(table(spark, sf, "embeddings"),
                                S.training_field_indices(include_ht=True), ["embedding"])
    both = rows.select("vec_id", F.posexplode(F.arrays_zip("subcarrier_index", "embedding")
                                              ).alias("pos", "z"))
    return both.select("vec_id", "pos", F.col("z.subcarrier_index").alias("carrier"),
                       r6("z.embedding").alias("x"))


def drop_null_carriers(spark, sf):
    rules = table(spark, sf, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    rules = rules.select("label", F.sequence(F.col("label") % 7, F.col("label") + 40, F.lit(3)
                                             ).alias("remove"))
    rows = S.drop_null_carriers(table(spark, sf, "embeddings"), rules, ["label"], ["embedding"])
    both = rows.select("vec_id", F.posexplode(F.arrays_zip("subcarrier_index", "embedding")
                                              ).alias("pos", "z"))
    return both.select("vec_id", "pos", F.col("z.subcarrier_index").alias("carrier"),
                       r6("z.embedding").alias("x"))


def fftshift(spark, sf):
    odd = F.slice("embedding", F.lit(1), F.size("embedding") - 1)
    rows = table(spark, sf, "embeddings").select("vec_id", F.when(
        F.col("label") % 2 == 0, F.col("embedding")).otherwise(odd).alias("x"))
    return cells(S.fftshift(rows, "x"), "x", "vec_id")


def stride_bins(spark, sf):
    return cells(S.stride_bins(table(spark, sf, "embeddings"), "embedding", 4), "embedding", "vec_id")


def affine(spark, sf):
    rows = S.affine_companion(table(spark, sf, "embeddings"), "embedding", 0.0025, 0.0119, "y")
    return cells(rows.select("vec_id", "y"), "y", "vec_id")


def normalize_packet(spark, sf):
    rows = S.normalize_packet(embedding_packets(spark, sf))
    both = rows.select("vec_id", F.posexplode(F.arrays_zip("csi_real", "csi_imag")).alias("pos", "z"))
    return both.select("vec_id", "pos", r6("z.csi_real").alias("re"), r6("z.csi_imag").alias("im"))


def repair_nonfinite(spark, sf):
    broken = table(spark, sf, "embeddings").select("vec_id", F.transform(
        "embedding", lambda x, i: F.when((x > 0.2) & (i % 3 == 0), F.lit(float("nan")).cast("float"))
        .when(x > 0.2, F.lit(float("inf")).cast("float")).otherwise(x)).alias("amplitude"))
    return cells(S.repair_nonfinite(broken), "amplitude", "vec_id")


def drop_zero_packets(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.transform(
        "embedding", lambda x: F.when(F.col("label") % 4 == 0, F.lit(0).cast("float")).otherwise(x)
    ).alias("x"))
    return S.drop_zero_packets(rows, ["x"]).select("vec_id", r6(F.get("x", F.lit(5))).alias("x"))


def link_stack(spark, sf):
    tx = S.link_stack(table(spark, sf, "embeddings"), "embedding", (16, 2, 2), "tx")
    rx = S.link_stack(table(spark, sf, "embeddings"), "embedding", (16, 2, 2), "rx")
    both = tx.withColumn("major", F.lit("tx")).unionByName(rx.withColumn("major", F.lit("rx")))
    return both.select("vec_id", "major", "link", "link_name",
                       F.posexplode("embedding").alias("pos", "x")).withColumn("x", r6("x"))


STACK_SQL = f"""WITH {FULL_SQL},
parts AS (
  SELECT vec_id, x, CAST(pos // 4 AS INT) AS s, CAST((pos // 2) % 2 AS INT) AS tx, CAST(pos % 2 AS INT) AS rx
  FROM full_cells)
SELECT vec_id, 'tx' AS major, tx * 2 + rx AS link, 'T' || (tx + 1) || 'R' || (rx + 1) AS link_name,
       s AS pos, {q6('x')} AS x FROM parts
UNION ALL
SELECT vec_id, 'rx', rx * 2 + tx, 'R' || (rx + 1) || 'T' || (tx + 1), s, {q6('x')} FROM parts"""


def marginal(spark, sf):
    rows = S.marginal(table(spark, sf, "embeddings"), "embedding", (4, 4, 4), 2, "m")
    return cells(rows.select("vec_id", "m"), "m", "vec_id")


def decode_labels(spark, sf):
    ev = S.decode_labels(table(spark, sf, "orders"), "o_orderstatus",
                         {"F": "finished", "O": "open"}, "status_name")
    names = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"))
    cust = S.decode_labels(table(spark, sf, "customer"), "c_nationkey", names, "nation", "null")
    return ev.groupBy(F.col("status_name").alias("name")).agg(F.count(F.lit(1)).alias("n")).unionByName(
        cust.groupBy(F.col("nation").alias("name")).agg(F.count(F.lit(1)).alias("n")))


def clean_labels(spark, sf):
    raw = F.when(F.col("lang") == "de", F.lit("None")).when(
        F.col("lang") == "fr", F.lit("  ")).otherwise(
        F.concat(F.lit(" "), "source", F.lit("_"), "lang", F.lit(" ")))
    docs = table(spark, sf, "documents").select("doc_id", T.clean_label(
        raw, {"src0_en": "the web"}).alias("label"))
    return docs


def slugs(spark, sf):
    part = table(spark, sf, "part")
    key = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(
        F.concat_ws("/", F.col("p_type"), F.col("p_brand"), F.col("p_name")))
    return part.select("p_partkey", T.slugify(key).alias("slug"), T.task_of(key).alias("task"),
                       T.label_of(key).alias("label"), T.label_folder(key).alias("folder"))


SLUG_SQL = """
WITH k AS (
  SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name
         ELSE p_type || '/' || p_brand || '/' || p_name END AS key FROM part),
s AS (
  SELECT p_partkey, key, CASE WHEN contains(key, '/') THEN trim(split_part(key, '/', 1)) END AS task,
         CASE WHEN contains(key, '/') THEN trim(substr(key, instr(key, '/') + 1)) ELSE key END AS label
  FROM k),
g AS (
  SELECT *, trim(regexp_replace(lower(key), '[^a-z0-9]+', '_', 'g'), '_') AS slug,
         trim(regexp_replace(lower(label), '[^a-z0-9]+', '_', 'g'), '_') AS lslug,
         trim(regexp_replace(lower(task), '[^a-z0-9]+', '_', 'g'), '_') AS tslug FROM s)
SELECT p_partkey, slug, task, label, CASE WHEN task IS NULL THEN lslug ELSE tslug || '/' || lslug END AS folder
FROM g"""


def label_text(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    docs = docs.withColumn("user_1", F.when(F.col("quality") == 1, F.col("source"))).withColumn(
        "user_2", F.col("lang")).withColumn("user_3", F.when(F.col("toxic") == 0, F.col("source")))
    rows = docs.withColumn("names", T.distinct_filled(["user_1", "user_2", "user_3"]))
    return rows.select("doc_id", T.joined("names").alias("activity"),
                       T.people(F.size("names")).alias("occupancy"),
                       F.concat(F.size("names").cast("string"), F.lit(" GHz")).alias("band"))


LABEL_TEXT_SQL = """
WITH u AS (
  SELECT d.doc_id, CASE WHEN quality = 1 THEN source END AS a, lang AS b,
         CASE WHEN toxic = 0 AND NOT coalesce(quality = 1, false) THEN source END AS c
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
t AS (SELECT doc_id, concat_ws(' + ', a, b, c) AS activity,
             CASE WHEN a IS NULL THEN 0 ELSE 1 END + 1 + CASE WHEN c IS NULL THEN 0 ELSE 1 END AS n FROM u)
SELECT doc_id, activity, n || CASE WHEN n = 1 THEN ' person' ELSE ' people' END AS occupancy,
       n || ' GHz' AS band FROM t"""


def safe_names(spark, sf):
    part = table(spark, sf, "part")
    path = F.concat_ws("/", F.col("p_type"), F.col("p_brand"),
                       F.concat("p_name", F.lit("."), F.col("p_size").cast("string"), F.lit(".mat")))
    return part.select("p_partkey", T.safe_stem(path).alias("stem"))


QUERIES = {
    "amplitude": amplitude, "phase": phase, "from_polar": from_polar, "power_db_rel": power_db,
    "deinterleave_iq": deinterleave, "select_subcarriers": select_subcarriers,
    "drop_null_carriers": drop_null_carriers, "fftshift": fftshift, "stride_bins": stride_bins,
    "affine_companion": affine, "normalize_packet": normalize_packet,
    "repair_nonfinite": repair_nonfinite, "drop_zero_packets": drop_zero_packets,
    "link_stack": link_stack, "marginal": marginal, "decode_labels": decode_labels,
    "clean_label": clean_labels, "slug_and_task": slugs, "label_text": label_text,
    "safe_stem": safe_names,
}
SQL = {
    "amplitude": f"WITH {IQ_SQL} SELECT vec_id, pos, {q6('CAST(sqrt(re * re + im * im) AS FLOAT)')} AS x FROM iq",
    "phase": f"WITH {IQ_SQL} SELECT vec_id, pos, {q6('CAST(atan2(im, re) AS FLOAT)')} AS x FROM iq",
    "from_polar": f"""WITH {IQ_SQL} SELECT vec_id, pos, {q6('CAST(re * cos(im) AS FLOAT)')} AS re,
        {q6('CAST(re * sin(im) AS FLOAT)')} AS im FROM iq""",
    "power_db_rel": POWER_SQL,
    "deinterleave_iq": f"""WITH c AS (SELECT vec_id, CAST(i AS INT) AS pos, CAST(embedding[2 * i + 2] AS DOUBLE) AS a, CAST(embedding[2 * i + 1] AS DOUBLE) AS b
            FROM embeddings, range(32) t(i))
        SELECT vec_id, pos, {q6('a')} AS re, {q6('b')} AS im FROM c""",
    "select_subcarriers": f"""WITH {FULL_SQL}
        SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY pos) - 1 AS INT) AS pos,
               CAST(pos AS INT) AS carrier, {q6('x')} AS x
        FROM full_cells WHERE (pos BETWEEN 6 AND 58) AND pos <> 32""",
    "drop_null_carriers": f"""WITH {FULL_SQL}
        SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY pos) - 1 AS INT) AS pos,
               CAST(pos AS INT) AS carrier, {q6('x')} AS x
        FROM full_cells
        WHERE NOT (pos BETWEEN label % 7 AND label + 40 AND (pos - label % 7) % 3 = 0)""",
    "fftshift": f"""WITH {FULL_SQL},
        n AS (SELECT *, CASE WHEN label % 2 = 0 THEN 64 ELSE 63 END AS n FROM full_cells)
        SELECT vec_id, CAST((pos + n // 2) % n AS INT) AS pos, {q6('x')} AS x FROM n WHERE pos < n""",
    "stride_bins": f"""WITH {FULL_SQL} SELECT vec_id, CAST(pos // 4 AS INT) AS pos, {q6('x')} AS x
        FROM full_cells WHERE pos % 4 = 0""",
    "affine_companion": f"""WITH {FULL_SQL} SELECT vec_id, pos,
        {q6('CAST((x - 0.0025::DOUBLE) / 0.0119::DOUBLE AS FLOAT)')} AS x FROM full_cells""",
    "normalize_packet": f"""WITH {IQ_SQL},
        m AS (SELECT vec_id, greatest(avg(CAST(CAST(sqrt(re * re + im * im) AS FLOAT) AS DOUBLE)),
                     1.1920928955078125e-07) AS m FROM iq GROUP BY 1)
        SELECT vec_id, pos, {q6('CAST(re / m AS FLOAT)')} AS re, {q6('CAST(im / m AS FLOAT)')} AS im
        FROM iq JOIN m USING (vec_id)""",
    "repair_nonfinite": f"""WITH {FULL_SQL},
        m AS (SELECT vec_id, CAST(avg(x) AS FLOAT) AS fill FROM full_cells WHERE x <= CAST(0.2 AS DOUBLE) GROUP BY 1)
        SELECT vec_id, pos, {q6('CASE WHEN x > CAST(0.2 AS DOUBLE) THEN coalesce(fill, 0) ELSE x END')} AS x
        FROM full_cells LEFT JOIN m USING (vec_id)""",
    "drop_zero_packets": f"""SELECT vec_id, {q6('embedding[6]')} AS x FROM embeddings
        WHERE label % 4 <> 0""",
    "link_stack": STACK_SQL,
    "marginal": f"""WITH {FULL_SQL} SELECT vec_id, CAST(pos // 4 AS INT) AS pos,
        {q6('CAST(sum(x) AS FLOAT)')} AS x FROM full_cells GROUP BY vec_id, pos // 4""",
    "decode_labels": """
        SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END
               AS name, count(*) AS n FROM orders GROUP BY 1
        UNION ALL
        SELECT n_name, count(*) FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
    "clean_label": """
        SELECT doc_id, CASE WHEN lang IN ('de', 'fr') THEN NULL
               WHEN source = 'src0' AND lang = 'en' THEN 'the web'
               ELSE replace(source || '_' || lang, '_', ' ') END AS label FROM documents""",
    "slug_and_task": SLUG_SQL,
    "label_text": LABEL_TEXT_SQL,
    "safe_stem": """SELECT p_partkey, replace(p_type || '__' || p_brand || '__' || p_name || '.' || p_size,
        ' ', '_') AS stem FROM part""",
}
