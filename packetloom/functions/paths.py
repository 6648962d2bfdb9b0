"""Metadata written into file paths, as Column expressions and DataFrame helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions import text as T
from packetloom.functions import vocabularies as V

# Patterns of the group fields, tried on the lower-case path.
GROUP_PATTERNS = {
    "subject": r"(?:subject|subj|person|user|participant|volunteer|p)[-_ ]?0*(\d+)",
    "environment": r"(?:environment|env|room|scene)[-_ ]?([a-z0-9]+)",
    "scenario": r"(?:scenario|los|nlos|through[-_ ]?wall)[-_ ]?([a-z0-9]+)?",
    "device": r"(?:device|receiver|rx|deployment)[-_ ]?([a-z0-9]+)|\b(bq|pifa)\b",
    "location": r"(?:location|loc|position|pos)[-_ ]?([a-z0-9]+)",
    "orientation": r"(?:orientation|orient|angle)[-_ ]?([a-z0-9]+)",
    "day": r"(?:day|date|session)[-_ ]?([a-z0-9]+)",
    "band": r"(?:band|freq)[-_ ]?([a-z0-9.]+)|\b(2\.4g|5g|6g)\b",
    "trial": r"(?:trial|repeat|repetition|rep|r)[-_ ]?0*(\d+)",
    "occupancy": r"(?:occupancy|people|persons|count)[-_ ]?0*(\d+)",
    "experiment": r"(?:experiment|exp)[-_ ]?([a-z0-9]+)",
}
TWO_GROUPS = ("device", "band")
SPLIT_PATTERNS = {
    "train": r"(?:^|[/_.-])train(?:ing)?(?:[/_.-]|$)",
    "val": r"(?:^|[/_.-])val(?:idation)?(?:[/_.-]|$)",
    "test": r"(?:^|[/_.-])test(?:ing)?(?:[/_.-]|$)",
}
TRIPLE_PATTERN = r"(?:^|/)e0*(\d+)/s0*(\d+)/a0*(\d+)(?:/|$)"
RISK_PATTERN = r"(?:^|/)(low|med|high)(_unseen)?(?:/|$)"
RELEASE_GROUPS = ("lab+home276", "home276", "lab276", "lab150")
METADATA_FIELDS = (*GROUP_PATTERNS, "activity", "predefined_split", "release_group")


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def predefined_split(path, lowered: Column | None = None) -> Column:
    text = F.lower(T.unix_path(path)) if lowered is None else lowered
    out = F.lit(None).cast("string")
    for name, pattern in reversed(SPLIT_PATTERNS.items()):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def path_metadata(path, lowered: Column | None = None) -> dict[str, Column]:
    """One Column per metadata field; rules further down win over earlier ones.

    ``lowered`` is the path in lower case with forward slashes, where a caller has it already.
    """
    text = F.lower(T.unix_path(path)) if lowered is None else lowered
    triple = text.rlike(TRIPLE_PATTERN)
    fields: dict[str, Column] = {}
    for field, pattern in GROUP_PATTERNS.items():
        groups = [_filled(F.regexp_extract(text, pattern, g))
                  for g in range(1, 3 if field in TWO_GROUPS else 2)]
        fields[field] = F.coalesce(*groups, _filled(F.regexp_extract(text, pattern, 0)))
    for position, field in ((1, "environment"), (2, "subject")):
        fields[field] = F.coalesce(fields[field], F.when(
            triple, F.regexp_extract(text, TRIPLE_PATTERN, position)))
    risk = _filled(F.regexp_extract(text, RISK_PATTERN, 1))
    unseen = _filled(F.regexp_extract(text, RISK_PATTERN, 2))
    fields["activity"] = F.coalesce(
        F.when(risk == "med", F.lit("medium")).otherwise(risk),
        F.when(triple, F.regexp_extract(text, TRIPLE_PATTERN, 3)))
    fields["predefined_split"] = F.when(
        risk.isNotNull(), F.when(unseen.isNotNull(), F.lit("test")).otherwise(F.lit("train"))
    ).otherwise(predefined_split(path, text))
    blocked = F.contains(text, F.lit("nlos"))
    fields["scenario"] = F.when(F.contains(text, F.lit("los")) & ~blocked, F.lit("los")).when(
        blocked | F.contains(text, F.lit("through-wall")) | F.contains(text, F.lit("through_wall")),
        F.lit("nlos")).otherwise(fields["scenario"])
    fields["device"] = F.when(F.contains(text, F.lit("bq")), F.lit("bq")).when(
        F.contains(text, F.lit("pifa")), F.lit("pifa")).otherwise(fields["device"])
    release = F.lit(None).cast("string")
    for name in reversed(RELEASE_GROUPS):
        release = F.when(F.contains(text, F.lit(name)), F.lit(name)).otherwise(release)
    fields["release_group"] = release
    return fields


def extract_metadata(df: DataFrame, path: str, out: str = "metadata") -> DataFrame:
    """The fields found in a path as one map without empty entries."""
    rows = df.withColumn("_lowered", F.lower(T.unix_path(path)))
    # The patterns get a projection of their own: inside a map's lambda Spark would interpret
    # them and evaluate shared parts again and again.
    fields = path_metadata(path, F.col("_lowered"))
    rows = rows.withColumns({f"_f_{name}": value for name, value in fields.items()})
    entries = F.array_compact(F.array(*[
        F.when(F.col(f"_f_{name}").isNotNull(), F.struct(
            F.lit(name).alias("k"), F.col(f"_f_{name}").alias("v")))
        for name in fields]))
    return rows.withColumn(out, F.map_from_entries(entries)).drop(
        "_lowered", *[f"_f_{name}" for name in fields])


def extract_task_folders(df: DataFrame, path: str) -> DataFrame:
    """Labels of task folders and, per task, which of them is the class.

    The last folder with a prefix wins.  Walking variants count as ``walking``.
    """
    df = df.withColumn("_parts", T.path_parts(path))

    def last(condition) -> Column:
        return F.element_at(F.filter("_parts", condition), -1)

    def tagged(prefix: str) -> Column:
        return F.substr(last(lambda p: F.startswith(p, F.lit(prefix))), F.lit(len(prefix) + 1))

    task = last(lambda p: p.isin(*V.BENCH_TASK_PROFILES))
    df = df.withColumn("_activity", tagged("act_")).withColumn(
        "_source", F.regexp_replace(tagged("motionsrc_"), "^0+", ""))
    source, raw_activity = F.col("_source"), F.col("_activity")
    rows = (df.withColumn("task", task).withColumn("subject", tagged("user_"))
            .withColumn("environment", tagged("env_")).withColumn("subject_type", tagged("sub_"))
            .withColumn("difficulty", tagged("Diff_"))
            .withColumn("location", F.when(source == "", F.lit("0")).otherwise(source)))
    walking = F.when(F.startswith(raw_activity, F.lit("walking")), F.lit("walking")).otherwise(
        raw_activity)
    rows = rows.withColumn("_text", F.array_join("_parts", "/"))
    text = F.col("_text")

    def within(name: str, needed: Column) -> Column:
        return F.contains(text, F.lit(name)) & needed.isNotNull()

    cases = [
        (within("HumanIdentification", F.col("subject")), F.col("subject"), raw_activity),
        (within("MotionSourceRecognition", F.col("subject_type")), F.col("subject_type"), raw_activity),
        (within("Localization", F.col("location")), F.col("location"), raw_activity),
        (within("HumanActivityRecognition", raw_activity), walking, raw_activity),
        (within("ProximityRecognition", raw_activity), raw_activity, raw_activity),
    ]
    label, activity = walking, walking
    for condition, class_value, activity_value in reversed(cases):
        label = F.when(condition, class_value).otherwise(label)
        activity = F.when(condition, activity_value).otherwise(activity)
    return rows.withColumn("_class", label).withColumn("activity", activity).withColumnRenamed(
        "_class", "class").drop("_parts", "_activity", "_source", "_text")


def _first_error(df: DataFrame, error: Column) -> Column:
    """An error that a row has already stays."""
    return F.coalesce(F.col("error"), error) if "error" in df.columns else error


def extract_action_trial(df: DataFrame, path: str) -> DataFrame:
    """``csi_a<activity>_<trial>.dat``: ids, name, and an error text when the contract is broken."""
    name, pattern = T.file_name(path), r"(?i)^csi_a(\d+)_(\d+)\.dat$"
    activity = F.regexp_extract(name, pattern, 1).try_cast("int")
    names = F.create_map(*[F.lit(x) for kv in V.WIAR_ACTIVITIES.items() for x in kv])
    error = F.when(~name.rlike(pattern), F.lit("file name must match csi_a<activity>_<trial>.dat")
                   ).when(~activity.between(1, 16), F.lit("activity id must be 1-16"))
    return (df.withColumn("activity_id", activity)
            .withColumn("trial_id", F.regexp_extract(name, pattern, 2).try_cast("int"))
            .withColumn("activity_label", F.try_element_at(names, activity))
            .withColumn("error", _first_error(df, error)))


def extract_clip_id(df: DataFrame, path: str) -> DataFrame:
    """``subject_action_repetition.npy`` and the scene folder above it."""
    name, pattern = T.file_name(path), r"^(\d+)_(\d+)_(\d+)\.npy$"
    action = F.regexp_extract(name, pattern, 2).try_cast("int")
    names = F.create_map(*[F.lit(x) for kv in V.XRF55_ACTIONS.items() for x in kv])
    scene = T.first_part(path, lambda p: p.rlike(r"(?i)^scene\d+$"), last=True)
    error = F.when(~name.rlike(pattern), F.lit("file name must be subject_action_repetition.npy")
                   ).when(~action.between(1, 55), F.lit("action id must be 1..55"))
    return (df.withColumn("subject_id", F.regexp_extract(name, pattern, 1).try_cast("int"))
            .withColumn("activity_id", action)
            .withColumn("repetition_id", F.regexp_extract(name, pattern, 3).try_cast("int"))
            .withColumn("scene_id", F.regexp_extract(scene, r"(\d+)$", 1).try_cast("int"))
            .withColumn("activity_label", F.try_element_at(names, action))
            .withColumn("error", _first_error(df, error)))


def extract_sequence(df: DataFrame, path: str) -> DataFrame:
    """``subject_scene_group`` stems; other stems give NULL settings."""
    stem, pattern = T.file_stem(path), r"^(\d+)_(\d+)_(\d+)$"
    scene = F.regexp_extract(stem, pattern, 2).try_cast("int")
    names = F.create_map(*[F.lit(x) for kv in V.XRF_V2_SCENES.items() for x in kv])
    return (df.withColumn("subject_id", F.regexp_extract(stem, pattern, 1).try_cast("int"))
            .withColumn("scene_id", scene)
            .withColumn("scene", F.coalesce(F.try_element_at(names, scene),
                                            F.concat(F.lit("scene "), scene.cast("string"))))
            .withColumn("sequence_group", F.regexp_extract(stem, pattern, 3).try_cast("int")))


def extract_gesture(df: DataFrame, path: str) -> DataFrame:
    """``N-name`` gesture folder, ``userN-`` file prefix and the train or test part."""
    gesture = F.translate(F.regexp_replace(T.parent_name(path), r"^\d+-", ""), "_", " ")
    return (df.withColumn("gesture", gesture)
            .withColumn("subject", F.lower(_filled(
                F.regexp_extract(T.file_name(path), r"(?i)^(user\d+)-", 1))))
            .withColumn("split", F.lower(T.first_part(
                path, lambda p: F.lower(p).isin("train", "test")))))


def extract_antenna_setting(df: DataFrame, path: str) -> DataFrame:
    """LOS/NLOS, antenna type, and the trailing room number of NLOS recordings."""
    setting = T.first_part(path, lambda p: p.isin("LOS", "NLOS"))
    room = _filled(F.regexp_extract(T.file_stem(path), r"(\d+)$", 1))
    return (df.withColumn("path_setting", setting)
            .withColumn("antenna", T.first_part(path, lambda p: p.isin("BQ", "PIFA")))
            .withColumn("room", F.when(setting == "NLOS", F.concat(F.lit("room "), room))))


def extract_campaign(df: DataFrame, path: str) -> DataFrame:
    """Nine underscore fields: campaign, set, receiver, application, people, activity, machines,
    status, sequence.  Several letters in one field are several labels; ``#`` means none."""
    parts = F.split(T.file_stem(path), "_")
    whole = F.size(parts) >= 9

    def part(i: int) -> Column:
        return F.when(whole, F.get(parts, F.lit(i)))

    def letters(c: Column) -> Column:
        return F.filter(F.split(c, ""), lambda x: x != "")

    people, activity, machines, status = part(4), part(5), part(6), part(7)
    names = F.create_map(*[F.lit(x) for kv in V.EHUNAM_ACTIVITIES.items() for x in kv])
    acts = F.when(activity != "#", F.filter(
        F.transform(letters(activity), lambda x: F.try_element_at(names, x)),
        lambda x: x.isNotNull()))
    machine_names = F.when(machines != "#", F.transform(
        F.filter(letters(machines), lambda x: x.rlike(r"^\d$")),
        lambda x: F.concat(F.lit("machine "), x)))
    count = F.when(people == "#", F.lit(0)).otherwise(F.length(people))
    for i, name in enumerate(("campaign", "collection_set", "receiver", "application")):
        df = df.withColumn(name, part(i))
    return (df.withColumn("sequence", part(8))
            .withColumn("occupancy", F.concat(count.cast("string"), F.lit(" people")))
            .withColumn("identities", F.when(people != "#", F.transform(
                letters(people), lambda x: F.concat(F.lit("person "), x))))
            .withColumn("activities", F.array_distinct(acts))
            .withColumn("activity_label", T.joined(acts))
            .withColumn("machines", machine_names)
            .withColumn("machine_combination", F.array_join(machine_names, " + "))
            .withColumn("machine_state", F.when(status == "O", F.lit("powered on")).when(
                status == "R", F.lit("running"))))


def extract_monitor_codes(df: DataFrame, path: str) -> DataFrame:
    """Activity letter, ``PI.._pNN`` identity, ``PC.._nNN`` occupancy and subset code of a stem."""
    stem = T.file_stem(path)
    code = _filled(F.regexp_extract(F.upper(stem), r"(?:^|_)([WRJLSCGE])(?:_|\d|$)", 1))
    person = F.regexp_extract(stem, r"(?i)PI\d+[a-z]?_p(\d+)", 1).try_cast("int")
    people = F.regexp_extract(stem, r"(?i)PC\d+[a-z]?_n(\d+)", 1).try_cast("int")
    names = F.create_map(*[F.lit(x) for kv in V.WIFI_80MHZ_ACTIVITIES.items() for x in kv])
    padded = F.when(person < 100, F.lpad(person.cast("string"), 2, "0")).otherwise(
        person.cast("string"))
    return (df.withColumn("source_label", code)
            .withColumn("activity_label", F.try_element_at(names, code))
            .withColumn("subject", F.when(person == 0, F.lit("empty room")).otherwise(
                F.concat(F.lit("p"), padded)))
            .withColumn("occupancy_label", F.when(people == 0, F.lit("empty room")).otherwise(
                F.concat(people.cast("string"), F.lit(" people"))))
            .withColumn("subset", F.upper(_filled(
                F.regexp_extract(stem, r"(?i)\b(AR|PI|PC)(\d+)([a-z])", 0)))))


def extract_occupancy_scenario(df: DataFrame, path: str) -> DataFrame:
    """``<n>_Subjects_<scenario>`` folders: scenario, occupancy and its distinct activities."""
    folder, pattern = T.parent_name(path), r"^(\d+)_Subjects?_(.+)$"
    counted = folder.rlike(pattern)
    occupancy = F.coalesce(F.regexp_extract(folder, pattern, 1).try_cast("int"), F.lit(0))
    raw = F.when(counted, F.regexp_extract(folder, pattern, 2)).otherwise(folder)
    tokens = F.regexp_extract_all(
        raw, F.lit(r"(?i)(Sitting|Standing|Walking|Walk|Empty(?: Room)?)"), F.lit(1))
    activities = F.array_distinct(F.transform(tokens, lambda t: F.when(
        F.lower(t) == "walk", F.lit("walking")).when(
        F.startswith(F.lower(t), F.lit("empty")), F.lit("empty room")).otherwise(F.lower(t))))
    spoken = F.regexp_replace(F.lower(F.trim(F.regexp_replace(raw, "_+", " "))),
                              r"\bwalk\b", "walking")
    scenario = F.when(occupancy > 0, F.concat(occupancy.cast("string"), F.lit(" people: "), spoken)
                      ).otherwise(F.lit("0 people: empty room"))
    return (df.withColumn("release_class", folder).withColumn("scenario", scenario)
            .withColumn("occupancy", F.concat(occupancy.cast("string"), F.lit(" people")))
            .withColumn("activities", F.when(F.size(activities) > 0, activities).otherwise(
                F.array(F.lit("empty room"))))
            .withColumn("activity_label", F.when(
                F.size(activities) == 1, F.get(activities, F.lit(0))).otherwise(scenario)))


def extract_activity_location(df: DataFrame, path: str) -> DataFrame:
    """Activity at the head of the stem, ``L<n>Z<m>`` in it (or ``Location<n>`` as folder)."""
    stem = T.file_stem(path)
    raw = _filled(F.regexp_extract(
        stem, r"(?i)^(EmptyRoom|Leaning|NoActivity|Sitting|Standing|WalkingRxTx|WalkingTxRx)", 1))
    names = F.create_map(*[F.lit(x) for kv in V.GLASGOW_ACTIVITIES.items() for x in kv])
    both = r"(?i)L(\d+)Z(\d+)"
    place = F.coalesce(_filled(F.regexp_extract(stem, both, 1)),
                       _filled(F.regexp_extract(T.parent_name(path), r"(?i)Location(\d+)", 1)))
    zone = F.coalesce(_filled(F.regexp_extract(stem, both, 2)),
                      _filled(F.regexp_extract(stem, r"(?i)Z(\d+)", 1)))
    return (df.withColumn("activity_label", F.coalesce(
                F.try_element_at(names, F.lower(raw)), F.translate(stem, "_", " ")))
            .withColumn("location", F.when(
                place.isNotNull() & zone.isNotNull(),
                F.concat(F.lit("location "), place, F.lit(", zone "), zone))))


def extract_risk_folder(df: DataFrame, path: str) -> DataFrame:
    """The risk folder of a recording, its level and whether it is the unseen part."""
    folder = F.lower(T.first_part(path, lambda p: F.lower(p).isin(
        "low", "low_unseen", "med", "med_unseen", "high", "high_unseen")))
    level = F.substring_index(folder, "_", 1)
    return (df.withColumn("release_folder", folder)
            .withColumn("activity_label", F.when(level == "med", F.lit("medium")).otherwise(level))
            .withColumn("release_split", F.when(F.endswith(folder, F.lit("_unseen")),
                                                F.lit("unseen test")).when(
                folder.isNotNull(), F.lit("training")))
            .withColumn("error", _first_error(df, F.when(folder.isNull(), F.lit(
                "the label is the official folder: low, med or high, with or without _unseen")))))


def extract_room_activity(df: DataFrame, path: str) -> DataFrame:
    """Activity folder and ``Room_<n>`` of a room-wise release."""
    folder = T.parent_name(path)
    raw = F.when(folder.rlike(r"(?i)^room_\d+$"),
                 F.regexp_replace(T.file_stem(path), r"_\d+$", "")).otherwise(folder)
    names = F.create_map(*[F.lit(x) for kv in V.WIRELESS_HAR_LABELS.items() for x in kv])
    room = T.first_part(path, lambda p: p.rlike(r"(?i)^room_\d+$"))
    return (df.withColumn("source_activity_code", F.lower(raw))
            .withColumn("activity_label", F.coalesce(
                F.try_element_at(names, F.lower(raw)), F.translate(F.lower(raw), "_", " ")))
            .withColumn("room", F.lower(F.translate(room, "_", " "))))


def extract_activity_letter(df: DataFrame, path: str) -> DataFrame:
    code = _filled(F.regexp_extract(F.upper(T.file_stem(path)), r"(?:^|_)([A-L])(?:_|$)", 1))
    names = F.create_map(*[F.lit(x) for kv in V.EXPOSING_CSI_ACTIVITIES.items() for x in kv])
    return df.withColumn("source_label", code).withColumn(
        "activity_label", F.try_element_at(names, code))


def fallback_label(path, dataset_id: str) -> Column:
    """The label a path implies where a recording brings none of its own."""
    if dataset_id == "mm-fi":
        return T.first_part(path, lambda p: p.rlike(r"^A\d+$"), last=True)
    if dataset_id == "wiar":
        number = F.regexp_extract(T.file_stem(path), r"(?i)^csi_a(\d+)_\d+$", 1).try_cast("int")
        return F.try_element_at(
            F.create_map(*[F.lit(x) for kv in V.WIAR_ACTIVITIES.items() for x in kv]), number)
    if dataset_id in ("ntu-fi", "wireless-har-wifi-uwb"):
        return T.clean_label(T.parent_name(path), V.DISPLAY_LABELS.get(dataset_id))
    if dataset_id in ("wimans", "xrf55", "xrf-v2"):
        return T.clean_label(F.substring_index(T.file_stem(path), "_", 1))
    return F.lit(None).cast("string")
