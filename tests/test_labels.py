import pytest
from pyspark.sql import functions as F

from packetloom.functions import paths as P
from packetloom.functions import text as T
from packetloom.operators import quality as Q
from packetloom.operators import segments as D

ID = "recording_id string, packet_index long"


def test_intervals_painted_in_order(spark):
    packets = spark.createDataFrame([("r", i) for i in range(8)], ID)
    iv = spark.createDataFrame([("r", 0, 0, 4, "a"), ("r", 1, 2, 8, "b"), ("r", 2, 6, 7, "c")],
                               "recording_id string, interval_order long, start_index long, end_index long, label string")
    for width in (1, 3, 4096):
        rows = D.paint_labels(packets, iv, width=width).orderBy("packet_index").collect()
        assert "".join(r["source_label"] for r in rows) == "aabbbbcb"
    none = D.paint_labels(packets, iv.where("label = 'c'")).where("source_label = 'unlabeled'").count()
    assert none == 7
    lengths = spark.createDataFrame([("r", 8)], "recording_id string, source_length long")
    checked = D.checked_intervals(iv.unionByName(iv.where("label = 'c'").withColumn("start_index", F.lit(9)).withColumn(
        "end_index", F.lit(12)).withColumn("interval_order", F.lit(3))), lengths).orderBy("interval_order").collect()
    assert [r["error"] for r in checked] == [None, None, None, "invalid segment"]


def test_runs_of_any_bucket_width(spark, monkeypatch):
    text = "aaabbaccccca" * 3
    df = spark.createDataFrame([("r", i, c) for i, c in enumerate(text)] + [("one", 0, "x")], ID + ", source_label string")
    import itertools
    want, at = [], 0
    for label, run in itertools.groupby(text):
        n = len(list(run))
        want.append((label, at, at + n))
        at += n
    from packetloom.operators import ordered
    for width in (1, 2, 5, 4096):
        monkeypatch.setattr(D, "index_bucket", lambda c, w=width: ordered.index_bucket(c, w))
        runs = D.label_runs(df, 2.0).orderBy("start_index").collect()
        assert [(r["source_label"], r["start_index"], r["end_index"]) for r in runs] == want
        assert runs[1]["start_seconds"] == 1.5
    best = {r["source_label"]: (r["start_index"], r["end_index"]) for r in D.longest_run(
        D.numbered_runs(df, "source_label", ["recording_id"], "packet_index").where("recording_id = 'r'"), cap=4).collect()}
    assert best == {"a": (11, 15), "b": (3, 5), "c": (6, 10)}


def test_segment_to_index_falls_back_to_indices(spark):
    seg = spark.createDataFrame([("r", 0, 0.1, 0.3), ("r", 1, 3.0, 99.0), ("u", 2, 2.5, 3.5)],
                                "recording_id string, segment_id long, start_seconds double, end_seconds double")
    rec = spark.createDataFrame([("r", 10, 10.0), ("u", 10, None)], "recording_id string, source_length long, sample_rate_hz double")
    got = {r["segment_id"]: (r["start_index"], r["end_index"]) for r in D.segment_to_index(seg, rec).collect()}
    assert got == {0: (1, 3), 1: (3, 10), 2: (2, 4)}
    packets = spark.createDataFrame([("r", i) for i in range(10)] + [("u", i) for i in range(10)], ID)
    cut = D.slice_segments(packets, D.segment_to_index(seg, rec), width=2).groupBy("segment_id").count().collect()
    assert {r["segment_id"]: r["count"] for r in cut} == {0: 2, 1: 7, 2: 2}


def test_clip_label_or_segments(spark):
    df = spark.createDataFrame([("a", "x"), ("a", ""), ("a", "x"), ("b", "x"), ("b", "y")], "recording_id string, source_label string")
    got = {r["recording_id"]: (r["clip_label"], r["has_segments"]) for r in D.clip_or_segments(df).collect()}
    assert got == {"a": ("x", False), "b": (None, True)}


def test_label_text(spark):
    df = spark.createDataFrame([("  ",), ("sit ",), ("W",), ("none",), ("lie_down",)], "t string")
    got = [r[0] for r in df.select(T.clean_label("t", {"W": "walking"})).collect()]
    assert got == [None, "sit", "walking", None, "lie down"]
    key = spark.createDataFrame([("Activity/sit down / get up",), ("plain",)], "t string").select(
        T.task_of("t").alias("task"), T.label_of("t").alias("label"), T.label_folder("t").alias("folder")).collect()
    assert (key[0]["task"], key[0]["label"]) == ("Activity", "sit down / get up")
    assert (key[1]["task"], key[1]["label"], key[0]["folder"]) == (None, "plain", "activity/sit_down_get_up")


def test_vocabulary_ranges(spark):
    df = spark.createDataFrame([("Room: A1-A3 · S 08–10, x",), ("a 3-1 | b 0-900",), ("u 1 - 3",)], "t string")
    got = [r[0] for r in df.select(T.expand_vocabulary("t")).collect()]
    assert got == [["A1-A3", "S 08", "S 09", "S 10", "x"], ["a 3-1", "b 0-900"], ["u 1", "u 2", "u 3"]]


def test_natural_order(spark):
    df = spark.createDataFrame([("s10",), ("S2",), ("s1b",), ("s",)], "t string")
    assert [r[0] for r in df.orderBy(T.natural_key("t")).collect()] == ["s", "s1b", "S2", "s10"]


@pytest.mark.parametrize("pattern,path,hit", [
    ("**/*.csv", "a.csv", True), ("**/*.csv", "x/y/a.csv", True), ("**/data/*.csv", "x/data/y/a.csv", False),
    ("**/WiFi_CSI/**/*.mat", "r/WiFi_CSI/a.mat", True), ("**/*_id*.json", "x/train_id_1.json", True),
    ("*.csv", "x/a.csv", False)])
def test_globs(pattern, path, hit):
    import re
    assert bool(re.match(T.glob_to_regex(pattern), path)) is hit


def test_path_rules_override(spark):
    df = spark.createDataFrame([("E01/S02/A03/x.mat",), ("exp3_r5/NLOS_bq.csv",), ("med_unseen/train/x",)], "p string")
    got = [r[0] for r in P.extract_metadata(df, "p").select("metadata").collect()]
    assert (got[0]["environment"], got[0]["subject"], got[0]["activity"]) == ("01"[1:], "2", "3")
    assert (got[1]["subject"], got[1]["trial"], got[1]["scenario"], got[1]["device"]) == ("3", "5", "nlos", "bq")
    assert (got[2]["activity"], got[2]["predefined_split"]) == ("medium", "test")


def test_robust_limits_ignore_spikes(spark):
    values = [float(i % 50) for i in range(1000)] + [1e9, float("inf"), float("nan")]
    df = spark.createDataFrame([("r", v) for v in values], "recording_id string, v double")
    row = Q.robust_range(df, F.col("v"), ["recording_id"]).first()
    assert 0 <= row["low"] <= 1 and 48 <= row["high"] <= 49
    flat = spark.createDataFrame([("r", 2.0)] * 3, "recording_id string, v double")
    assert tuple(Q.robust_range(flat, F.col("v"), ["recording_id"]).first())[1:] == (2.0, 3.0)
    zero = spark.createDataFrame([("r", 0.0)] * 3, "recording_id string, v double")
    assert tuple(Q.robust_range(zero, F.col("v"), ["recording_id"], signed=True).first())[1:] == (-1.0, 1.0)
    groups = spark.createDataFrame([("r",), ("empty",)], "recording_id string")
    ranges = Q.robust_range(flat, F.col("v"), ["recording_id"])
    filled = {r[0]: tuple(r)[1:] for r in Q.with_default_range(ranges, groups, ["recording_id"], True).collect()}
    assert filled["empty"] == (-1.0, 1.0)


def test_quality_counts_nan_and_leaves_out_inf(spark):
    df = spark.createDataFrame([("r", [1.0, float("nan")], True), ("r", [float("inf"), 3.0], False)],
                               "recording_id string, amplitude array<float>, valid boolean")
    row = Q.quality_report(df, ["amplitude"]).first()
    assert (row["nan_count"], row["min"], row["max"], row["mean"], row["valid_fraction"]) == (1, 1.0, 3.0, 2.0, 0.5)


def test_representative_prefers_segments_then_native(spark):
    rows = [("k", "a", None, None, True, 1, 0), ("k", "b", 0.0, 2.0, False, 1, 1), ("k", "c", 0.0, 1.0, True, 1, 2),
            ("k", "d", 0.0, 1.0, True, 1, 3), ("w", "e", None, None, False, 2, 4), ("w", "f", None, None, False, 1, 5)]
    df = spark.createDataFrame(rows, "label_key string, recording_id string, start_seconds double, end_seconds double, "
                                     "is_native boolean, label_count long, entry_order long")
    assert {r["label_key"]: r["recording_id"] for r in D.choose_representative(df).collect()} == {"k": "c", "w": "f"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranges_of_few_groups_leave_rows_where_they_are(spark):
    df = spark.range(5_000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    out = Q.robust_range(df, F.col("v"), ["g"])
    assert "SortMergeJoin [g" not in plan_of(out).split("BroadcastHashJoin")[-1] and "_salt" not in plan_of(out)
    rows = {r["g"]: (round(r["low"], 6), round(r["high"], 6)) for r in out.collect()}
    assert rows[0] == (99.96, 4898.04) and len(rows) == 3


def test_rates_of_other_recordings_are_not_sent_along(spark):
    rows = [("a", i, "x" if i < 3 else "y") for i in range(5)] + [("b", 0, "x")]
    df = spark.createDataFrame(rows, "recording_id string, packet_index long, source_label string")
    rates = spark.range(2_000).select(F.when(F.col("id") == 7, "a").otherwise(F.col("id").cast("string")).alias("recording_id"),
                                      F.lit(2.0).alias("sample_rate_hz"))
    out = D.label_runs(df, rates)
    assert "_salt" not in plan_of(out) and "sample_rate_hz" not in plan_of(out)
    got = sorted(tuple(r) for r in out.select("recording_id", "run", "end_index", "end_seconds").collect())
    assert got == [("a", 1, 3, 1.5), ("a", 2, 5, 2.5)]
