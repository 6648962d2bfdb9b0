"""Queries over metadata written into paths; the paths are put together from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.functions import paths as P
from packetloom.functions import vocabularies as V
from packetloom.workload.tables import table

METADATA = r"""
WITH p AS (SELECT page_id, lower(replace(url, '\', '/')) AS t FROM pages),
x AS (
  SELECT page_id, t,
    nullif(regexp_extract(t, '(?:subject|subj|person|user|participant|volunteer|p)[-_ ]?0*([0-9]+)', 1), '') AS subject1,
    nullif(regexp_extract(t, '(?:subject|subj|person|user|participant|volunteer|p)[-_ ]?0*([0-9]+)', 0), '') AS subject0,
    nullif(regexp_extract(t, '(?:trial|repeat|repetition|rep|r)[-_ ]?0*([0-9]+)', 1), '') AS trial1,
    nullif(regexp_extract(t, '(?:trial|repeat|repetition|rep|r)[-_ ]?0*([0-9]+)', 0), '') AS trial0,
    nullif(regexp_extract(t, '(?:location|loc|position|pos)[-_ ]?([a-z0-9]+)', 1), '') AS location,
    nullif(regexp_extract(t, '(?:environment|env|room|scene)[-_ ]?([a-z0-9]+)', 1), '') AS environment,
    nullif(regexp_extract(t, '(?:device|receiver|rx|deployment)[-_ ]?([a-z0-9]+)|\b(bq|pifa)\b', 1), '') AS device1,
    nullif(regexp_extract(t, '(?:device|receiver|rx|deployment)[-_ ]?([a-z0-9]+)|\b(bq|pifa)\b', 2), '') AS device2,
    nullif(regexp_extract(t, '(?:scenario|los|nlos|through[-_ ]?wall)[-_ ]?([a-z0-9]+)?', 1), '') AS scenario1,
    nullif(regexp_extract(t, '(?:scenario|los|nlos|through[-_ ]?wall)[-_ ]?([a-z0-9]+)?', 0), '') AS scenario0
  FROM p)
SELECT page_id, coalesce(subject1, subject0) AS subject, coalesce(trial1, trial0) AS trial, location, environment,
       CASE WHEN contains(t, 'bq') THEN 'bq' WHEN contains(t, 'pifa') THEN 'pifa' ELSE coalesce(device1, device2) END AS device,
       CASE WHEN contains(t, 'los') AND NOT contains(t, 'nlos') THEN 'los' WHEN contains(t, 'nlos') THEN 'nlos'
            ELSE coalesce(scenario1, scenario0) END AS scenario
FROM x"""


def path_metadata(spark, sf):
    rows = P.extract_metadata(table(spark, sf, "pages"), "url")
    return rows.select("page_id", *[F.col("metadata")[k].alias(k) for k in (
        "subject", "trial", "location", "environment", "device", "scenario")])


def release_metadata(spark, sf):
    """Triples, risk folders, split words and release groups on paths made from order lines."""
    li = table(spark, sf, "lineitem")
    n = F.col("l_linenumber")
    path = F.when(n == 1, F.concat(F.lit("E0"), F.col("l_suppkey").cast("string"), F.lit("/S0"),
                                   F.col("l_partkey").cast("string"), F.lit("/A"), n.cast("string"))).when(
        n == 2, F.lit("x\\med_unseen\\f.csv")).when(n == 3, F.concat(F.lit("High/"), "l_returnflag")).when(
        n == 4, F.concat(F.lit("lab+home276/val.mat"))).when(
        n == 5, F.concat(F.lit("exp3-"), F.col("l_suppkey").cast("string"), F.lit("_5g"))).otherwise(
        F.concat("l_returnflag", F.lit("/through_wall/test")))
    rows = P.extract_metadata(li.select(path.alias("path")), "path")
    keys = ("environment", "subject", "activity", "predefined_split", "release_group", "experiment", "band", "scenario")
    return rows.select(*[F.col("metadata")[k].alias(k) for k in keys]).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"))


RELEASE_SQL = """
WITH x AS (
  SELECT CASE l_linenumber WHEN 1 THEN CAST(l_suppkey AS VARCHAR) END AS environment,
         CASE l_linenumber WHEN 1 THEN CAST(l_partkey AS VARCHAR) WHEN 5 THEN '3' END AS subject,
         CASE l_linenumber WHEN 1 THEN '1' WHEN 2 THEN 'medium' WHEN 3 THEN 'high' END AS activity,
         CASE l_linenumber WHEN 2 THEN 'test' WHEN 3 THEN 'train' WHEN 4 THEN 'val' WHEN 6 THEN 'test' WHEN 7 THEN 'test' END AS predefined_split,
         CASE l_linenumber WHEN 4 THEN 'lab+home276' END AS release_group,
         CASE l_linenumber WHEN 5 THEN '3' END AS experiment,
         CASE l_linenumber WHEN 5 THEN NULL END::VARCHAR AS band,
         CASE WHEN l_linenumber >= 6 THEN 'nlos' END AS scenario FROM lineitem)
SELECT *, count(*) AS n FROM x GROUP BY ALL"""


def task_folders(spark, sf):
    li = table(spark, sf, "lineitem")
    task = F.element_at(F.array(*map(F.lit, V.BENCH_TASK_PROFILES)), (F.col("l_linenumber")).cast("int"))
    path = F.concat_ws("/", F.lit("root"), task, F.concat(F.lit("act_"), F.when(
        F.col("l_returnflag") == "A", F.lit("walking_fast")).otherwise(F.col("l_returnflag"))),
        F.concat(F.lit("user_U"), "l_linestatus"), F.concat(F.lit("sub_"), "l_returnflag"),
        F.concat(F.lit("motionsrc_00"), F.floor("l_tax").cast("string")), F.concat(F.lit("env_"), "l_linestatus"))
    rows = P.extract_task_folders(li.select(path.alias("path")), "path")
    keys = ("task", "subject", "environment", "location", "activity", "class")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


FOLDER_SQL = """
WITH x AS (
  SELECT CASE l_linenumber WHEN 1 THEN 'BreathingDetection' WHEN 2 THEN 'FallDetection' WHEN 3 THEN 'Localization'
         WHEN 4 THEN 'MotionSourceRecognition' WHEN 5 THEN 'HumanActivityRecognition' WHEN 6 THEN 'HumanIdentification'
         ELSE 'ProximityRecognition' END AS task, 'U' || l_linestatus AS subject, l_linestatus AS environment, '0' AS location,
         CASE WHEN l_returnflag = 'A' THEN CASE WHEN l_linenumber <= 2 THEN 'walking' ELSE 'walking_fast' END ELSE l_returnflag END AS activity,
         CASE l_linenumber WHEN 3 THEN '0' WHEN 4 THEN l_returnflag WHEN 6 THEN 'U' || l_linestatus
              WHEN 7 THEN CASE WHEN l_returnflag = 'A' THEN 'walking_fast' ELSE l_returnflag END
              ELSE CASE WHEN l_returnflag = 'A' THEN 'walking' ELSE l_returnflag END END AS class FROM lineitem)
SELECT *, count(*) AS n FROM x GROUP BY ALL"""


def file_contracts(spark, sf):
    part = table(spark, sf, "part")
    n = F.col("p_size").cast("string")
    wiar = part.select("p_partkey", F.concat(F.lit("CSI_a"), n, F.lit("_"), F.col("p_partkey").cast("string"),
                                             F.when(F.col("p_partkey") % 9 == 0, F.lit(".mat")).otherwise(F.lit(".dat"))).alias("path"))
    a = P.extract_action_trial(wiar, "path").select(
        "p_partkey", F.lit("action_trial").alias("contract"), F.col("activity_id").cast("long").alias("a"),
        F.col("trial_id").cast("long").alias("b"), F.col("activity_label").alias("name"), "error")
    clip = part.select("p_partkey", F.concat(F.lit("x/Scene"), n, F.lit("/"), F.lpad(F.col("p_partkey").cast("string"), 2, "0"),
                                             F.lit("_"), (F.col("p_size") + 20).cast("string"), F.lit("_03.npy")).alias("path"))
    b = P.extract_clip_id(clip, "path").select(
        "p_partkey", F.lit("clip").alias("contract"), F.col("activity_id").cast("long").alias("a"),
        F.col("scene_id").cast("long").alias("b"), F.col("subject_id").cast("string").alias("name"), "error")
    seq = part.select("p_partkey", F.concat(F.lit("d/"), n, F.lit("_"), (F.col("p_size") % 5).cast("string"), F.lit("_7"),
                                            F.when(F.col("p_size") == 6, F.lit("b")).otherwise(F.lit("")), F.lit(".h5")).alias("path"))
    c = P.extract_sequence(seq, "path").select(
        "p_partkey", F.lit("sequence").alias("contract"), F.col("subject_id").cast("long").alias("a"),
        F.col("sequence_group").cast("long").alias("b"), F.col("scene").alias("name"), F.lit(None).cast("string").alias("error"))
    return a.unionByName(b).unionByName(c)


def _case(column: str, names: dict) -> str:
    arms = " ".join("WHEN {} THEN '{}'".format(
        k if isinstance(k, int) else f"'{k}'", v.replace("'", "''")) for k, v in names.items())
    return f"CASE {column} {arms} END"


CONTRACT_SQL = f"""
SELECT p_partkey, 'action_trial' AS contract, CASE WHEN p_partkey % 9 > 0 THEN CAST(p_size AS BIGINT) END AS a,
       CASE WHEN p_partkey % 9 > 0 THEN p_partkey END AS b, CASE WHEN p_partkey % 9 > 0 THEN {_case('p_size', V.WIAR_ACTIVITIES)} END AS name,
       CASE WHEN p_partkey % 9 = 0 THEN 'file name must match csi_a<activity>_<trial>.dat'
            WHEN p_size > 16 THEN 'activity id must be 1-16' END AS error FROM part
UNION ALL
SELECT p_partkey, 'clip', p_size + 20, p_size, CAST(CAST(CASE WHEN p_partkey < 100 THEN p_partkey ELSE CAST(substr(CAST(p_partkey AS VARCHAR), 1, 2) AS BIGINT) END AS BIGINT) AS VARCHAR),
       CASE WHEN p_size + 20 > 55 THEN 'action id must be 1..55' END FROM part
UNION ALL
SELECT p_partkey, 'sequence', CASE WHEN p_size <> 6 THEN p_size END, CASE WHEN p_size <> 6 THEN 7 END,
       CASE WHEN p_size = 6 THEN NULL WHEN p_size % 5 = 1 THEN 'dining room' WHEN p_size % 5 = 2 THEN 'study room'
            WHEN p_size % 5 = 3 THEN 'bedroom' ELSE 'scene ' || (p_size % 5) END, NULL FROM part"""


def folder_labels(spark, sf):
    """Gesture folders, antenna settings, risk folders, rooms and activity letters."""
    part = table(spark, sf, "part")
    size = F.col("p_size")
    path = F.concat(
        F.when(size % 2 == 0, "LOS").otherwise("NLOS"), F.lit("/"), F.when(size % 3 == 0, "BQ").otherwise("PIFA"),
        F.lit("/Train/"), F.when(size % 5 == 0, "med_unseen").otherwise("Low"), F.lit("/Room_"), (size % 4).cast("string"),
        F.lit("/"), (size % 10).cast("string"), F.lit("-push_pull/USER"), size.cast("string"), F.lit("-x_"),
        F.substring("p_type", 1, 1), F.lit("_"), size.cast("string"), F.lit(".csv"))
    rows = part.select("p_partkey", path.alias("path"))
    rows = P.extract_gesture(rows, "path").drop("activity_label")
    rows = P.extract_antenna_setting(rows.withColumnRenamed("room", "_r"), "path").withColumnRenamed("room", "door")
    rows = P.extract_risk_folder(rows, "path").withColumnRenamed("activity_label", "risk")
    rows = P.extract_activity_letter(rows, "path").withColumnRenamed("activity_label", "letter_name")
    rows = P.extract_room_activity(rows, "path")
    return rows.select("p_partkey", "gesture", "subject", "split", "path_setting", "antenna", "door", "risk",
                       "release_split", "source_label", "letter_name", "room", F.col("activity_label").alias("activity"))


FOLDER_LABEL_SQL = f"""
SELECT p_partkey, 'push pull' AS gesture, 'user' || p_size AS subject, 'train' AS split,
       CASE WHEN p_size % 2 = 0 THEN 'LOS' ELSE 'NLOS' END AS path_setting, CASE WHEN p_size % 3 = 0 THEN 'BQ' ELSE 'PIFA' END AS antenna,
       CASE WHEN p_size % 2 = 1 THEN 'room ' || p_size END AS door, CASE WHEN p_size % 5 = 0 THEN 'medium' ELSE 'low' END AS risk,
       CASE WHEN p_size % 5 = 0 THEN 'unseen test' ELSE 'training' END AS release_split,
       CASE WHEN substr(p_type, 1, 1) BETWEEN 'A' AND 'L' THEN substr(p_type, 1, 1) END AS source_label,
       {_case('substr(p_type, 1, 1)', V.EXPOSING_CSI_ACTIVITIES)} AS letter_name,
       'room ' || (p_size % 4) AS room, (p_size % 10) || '-push pull' AS activity FROM part"""


def campaign_stems(spark, sf):
    part = table(spark, sf, "part")
    size = F.col("p_size")
    letters = F.element_at(F.array(*map(F.lit, ("WG", "#", "JJW", "Q", "F"))), (size % 5 + 1).cast("int"))
    people = F.element_at(F.array(*map(F.lit, ("#", "AB", "C"))), (size % 3 + 1).cast("int"))
    machines = F.element_at(F.array(*map(F.lit, ("12", "#", "3x"))), (size % 3 + 1).cast("int"))
    status = F.element_at(F.array(*map(F.lit, ("O", "R", "#"))), (size % 3 + 1).cast("int"))
    stem = F.when(size == 50, F.lit("short_name")).otherwise(F.concat_ws(
        "_", F.col("p_type"), F.lit("S1"), F.lit("RX"), F.lit("app"), people, letters, machines, status, size.cast("string")))
    rows = P.extract_campaign(part.select("p_partkey", F.concat(F.lit("a/"), stem, F.lit(".mat")).alias("path")), "path")
    return rows.select("p_partkey", "campaign", "application", "sequence", "occupancy", "activity_label",
                       F.array_join("activities", "|").alias("activities"), F.array_join("identities", "|").alias("identities"),
                       "machine_combination", "machine_state")


CAMPAIGN_SQL = """
SELECT p_partkey, CASE WHEN p_size < 50 THEN p_type END AS campaign, CASE WHEN p_size < 50 THEN 'app' END AS application,
       CASE WHEN p_size < 50 THEN CAST(p_size AS VARCHAR) END AS sequence,
       CASE WHEN p_size = 50 THEN NULL WHEN p_size % 3 = 0 THEN '0 people' WHEN p_size % 3 = 1 THEN '2 people' ELSE '1 people' END AS occupancy,
       CASE WHEN p_size = 50 THEN NULL WHEN p_size % 5 = 0 THEN 'walking + sit down / get up' WHEN p_size % 5 = 2 THEN 'jumping + jumping + walking'
            WHEN p_size % 5 = 4 THEN 'falling' END AS activity_label,
       CASE WHEN p_size = 50 THEN NULL WHEN p_size % 5 = 0 THEN 'walking|sit down / get up' WHEN p_size % 5 = 2 THEN 'jumping|walking'
            WHEN p_size % 5 = 3 THEN '' WHEN p_size % 5 = 4 THEN 'falling' END AS activities,
       CASE WHEN p_size = 50 OR p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN 'person A|person B' ELSE 'person C' END AS identities,
       CASE WHEN p_size = 50 OR p_size % 3 = 1 THEN NULL WHEN p_size % 3 = 0 THEN 'machine 1 + machine 2' ELSE 'machine 3' END AS machine_combination,
       CASE WHEN p_size = 50 THEN NULL WHEN p_size % 3 = 0 THEN 'powered on' WHEN p_size % 3 = 1 THEN 'running' END AS machine_state
FROM part"""


def monitor_codes(spark, sf):
    part = table(spark, sf, "part")
    n = F.col("p_size")
    stem = F.concat(F.element_at(F.array(*map(F.lit, ("AR1a_", "PI2b_p", "PC3_n"))), (n % 3 + 1).cast("int")),
                    (n % 12).cast("string"), F.lit("_"), F.substring("p_type", 1, 1), F.lit("_2"))
    rows = P.extract_monitor_codes(part.select("p_partkey", F.concat(stem, F.lit(".mat")).alias("path")), "path")
    return rows.select("p_partkey", "source_label", "activity_label", "subject", "occupancy_label", "subset")


MONITOR_SQL = f"""
SELECT p_partkey, CASE WHEN substr(p_type, 1, 1) IN ('S', 'L', 'E') THEN substr(p_type, 1, 1) END AS source_label,
       {_case('substr(p_type, 1, 1)', {k: V.WIFI_80MHZ_ACTIVITIES[k] for k in 'SLE'})} AS activity_label,
       CASE WHEN p_size % 3 <> 1 THEN NULL WHEN p_size % 12 = 0 THEN 'empty room' ELSE 'p' || lpad(CAST(p_size % 12 AS VARCHAR), 2, '0') END AS subject,
       CASE WHEN p_size % 3 <> 2 THEN NULL WHEN p_size % 12 = 0 THEN 'empty room' ELSE (p_size % 12) || ' people' END AS occupancy_label,
       CASE p_size % 3 WHEN 0 THEN 'AR1A' WHEN 1 THEN 'PI2B' END AS subset FROM part"""


def occupancy_scenarios(spark, sf):
    part = table(spark, sf, "part")
    n = F.col("p_size")
    word = F.element_at(F.array(*map(F.lit, ("Sitting", "walk", "Empty Room", "Standing_walk", "Dance"))), (n % 5 + 1).cast("int"))
    folder = F.when(n % 4 == 0, word).otherwise(F.concat((n % 4).cast("string"), F.lit("_Subjects_"), word))
    rows = P.extract_occupancy_scenario(part.select("p_partkey", F.concat(folder, F.lit("/a.csv")).alias("path")), "path")
    a = rows.select("p_partkey", F.lit("scenario").alias("kind"), "scenario", "occupancy", "activity_label")
    stem = F.concat(F.element_at(F.array(*map(F.lit, ("WalkingRxTx_", "emptyroom", "Jumping_up"))), (n % 3 + 1).cast("int")),
                    F.when(n % 2 == 0, F.concat(F.lit("L"), n.cast("string"), F.lit("Z2"))).otherwise(F.lit("Z7")))
    rows = P.extract_activity_location(part.select("p_partkey", F.concat(
        F.when(n % 5 == 0, "Location9").otherwise("x"), F.lit("/"), stem, F.lit(".csv")).alias("path")), "path")
    b = rows.select("p_partkey", F.lit("place").alias("kind"), F.col("location").alias("scenario"),
                    F.lit(None).cast("string").alias("occupancy"), "activity_label")
    return a.unionByName(b)


SCENARIO_SQL = """
WITH a AS (
  SELECT p_partkey, p_size % 4 AS o, CASE p_size % 5 WHEN 0 THEN 'sitting' WHEN 1 THEN 'walking' WHEN 2 THEN 'empty room'
         WHEN 3 THEN 'standing walking' ELSE 'dance' END AS spoken,
         CASE p_size % 5 WHEN 0 THEN 'sitting' WHEN 1 THEN 'walking' WHEN 2 THEN 'empty room' END AS one FROM part)
SELECT p_partkey, 'scenario' AS kind, CASE WHEN o > 0 THEN o || ' people: ' || spoken ELSE '0 people: empty room' END AS scenario,
       o || ' people' AS occupancy, coalesce(one, CASE WHEN o > 0 THEN o || ' people: ' || spoken ELSE '0 people: empty room' END) AS activity_label
FROM a
UNION ALL
SELECT p_partkey, 'place', CASE WHEN p_size % 2 = 0 THEN 'location ' || p_size || ', zone 2'
       WHEN p_size % 5 = 0 THEN 'location 9, zone 7' END, NULL,
       CASE p_size % 3 WHEN 0 THEN 'walking Rx to Tx' WHEN 1 THEN 'empty room' ELSE 'Jumping up' || CASE WHEN p_size % 2 = 0
       THEN 'L' || p_size || 'Z2' ELSE 'Z7' END END FROM part"""


def fallback_labels(spark, sf):
    part = table(spark, sf, "part")
    n = F.col("p_size").cast("string")
    out = None
    for dataset, path in (
            ("mm-fi", F.concat(F.lit("E/A"), n, F.lit("/wifi"))), ("wiar", F.concat(F.lit("csi_a"), n, F.lit("_4.dat"))),
            ("ntu-fi", F.concat(F.lit("x/"), F.translate("p_name", " ", "_"), F.lit("/f.mat"))),
            ("wireless-har-wifi-uwb", F.concat(F.lit("x/pickup/"), n)), ("wimans", F.concat(F.lit("act"), n, F.lit("_2.npy"))),
            ("aril", F.col("p_name"))):
        rows = part.select("p_partkey", F.lit(dataset).alias("dataset_id"), path.alias("path"))
        rows = rows.select("p_partkey", "dataset_id", P.fallback_label("path", dataset).alias("label"))
        out = rows if out is None else out.unionByName(rows)
    return out


FALLBACK_SQL = f"""
SELECT p_partkey, 'mm-fi' AS dataset_id, 'A' || p_size AS label FROM part
UNION ALL SELECT p_partkey, 'wiar', {_case('p_size', V.WIAR_ACTIVITIES)} FROM part
UNION ALL SELECT p_partkey, 'ntu-fi', p_name FROM part
UNION ALL SELECT p_partkey, 'wireless-har-wifi-uwb', 'pick up' FROM part
UNION ALL SELECT p_partkey, 'wimans', 'act' || p_size FROM part
UNION ALL SELECT p_partkey, 'aril', NULL FROM part"""

QUERIES = {
    "path_metadata": path_metadata, "release_metadata": release_metadata, "task_folders": task_folders,
    "file_contracts": file_contracts, "folder_labels": folder_labels, "campaign_stems": campaign_stems,
    "monitor_codes": monitor_codes, "occupancy_scenarios": occupancy_scenarios, "fallback_labels": fallback_labels,
}
SQL = {
    "path_metadata": METADATA, "release_metadata": RELEASE_SQL, "task_folders": FOLDER_SQL,
    "file_contracts": CONTRACT_SQL, "folder_labels": FOLDER_LABEL_SQL, "campaign_stems": CAMPAIGN_SQL,
    "monitor_codes": MONITOR_SQL, "occupancy_scenarios": SCENARIO_SQL, "fallback_labels": FALLBACK_SQL,
}
