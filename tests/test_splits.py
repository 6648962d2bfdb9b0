import random

import pytest
from pyspark.sql import functions as F

from packetloom.operators import sampling as SA
from packetloom.operators import splits as SP
from packetloom.plans.jobs import make_split
from packetloom.plans.registry import SPLIT_SETTINGS, split_setting, split_settings


def inventory(spark, paths):
    records = spark.createDataFrame([("converted", f"out/{i}", p, 1) for i, p in enumerate(paths)],
                                    "status string, output string, source_file string, sample_count int")
    return SP.build_inventory(records)


def test_holdout_does_not_leak(spark):
    inv = inventory(spark, [f"subject_{s}/trial_{t}.csv" for s in (1, 2, 3) for t in range(4)])
    split = make_split(inv, "csida", "cross_subject", holdout=["3"])
    assert {r["group"] for r in split.where("partition = 'test'").collect()} == {"3"}
    assert SP.leaked_groups(split).count() == 0
    last = make_split(inv, "csida", "cross_subject")
    assert {r["group"] for r in last.where("partition = 'test'").collect()} == {"3"}
    with pytest.raises(ValueError, match="unknown holdout"):
        make_split(inv, "csida", "cross_subject", holdout=["9"])
    with pytest.raises(ValueError, match="metadata missing"):
        make_split(inventory(spark, ["subject_1/a", "b"]), "csida", "cross_subject")
    with pytest.raises(ValueError, match="at least two"):
        make_split(inventory(spark, ["subject_1/a", "subject_1/b"]), "csida", "cross_subject")


def test_natural_last_group(spark):
    inv = inventory(spark, [f"subject_{s}/x" for s in (2, 9, 10)])
    split = SP.group_holdout(inv, F.col("metadata")["subject"])
    assert [r["group"] for r in split.where("partition = 'test'").collect()] == ["10"]
    assert SP.group_holdout(inv, F.col("metadata")["subject"], [1.0, 0.0, 0.0]).where("partition = 'val'").count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 33])
def test_random_sizes_are_exact(spark, n):
    ids = spark.range(n).select(F.col("id").cast("string").alias("sample_id"))
    got = {r["partition"]: r["count"] for r in SP.random_split(ids, [0.7, 0.15, 0.15], 1).groupBy("partition").count().collect()}
    exact = [0.7 * n, 0.15 * n, 0.15 * n]
    counts = [int(e) for e in exact]
    for i in sorted(range(3), key=lambda i: -(exact[i] - counts[i]))[:n - sum(counts)]:
        counts[i] += 1
    assert [got.get(p, 0) for p in ("train", "val", "test")] == counts
    with pytest.raises(ValueError):
        SP.checked_ratios([0.5, 0.5, 0.5])


def test_random_is_repeatable(spark):
    ids = spark.range(50).select(F.col("id").cast("string").alias("sample_id"))
    a = {r["sample_id"]: r["partition"] for r in SP.random_split(ids, seed=3).collect()}
    b = {r["sample_id"]: r["partition"] for r in SP.random_split(ids.repartition(7), seed=3).collect()}
    c = {r["sample_id"]: r["partition"] for r in SP.random_split(ids, seed=4).collect()}
    assert a == b and a != c


def test_predefined_and_risk_folders(spark):
    split = make_split(inventory(spark, ["train/a.csv", "test/b.csv"]), "ut-har")
    assert sorted(r["partition"] for r in split.collect()) == ["test", "train"]
    with pytest.raises(ValueError, match="cannot be inferred"):
        make_split(inventory(spark, ["a.csv"]), "ut-har")
    folders = ["low", "low_unseen", "med", "med_unseen", "high", "high_unseen"]
    got = make_split(inventory(spark, [f"{f}/x.csv" for f in folders]), "wipe-fall").groupBy("partition").count().collect()
    assert {r["partition"]: r["count"] for r in got} == {"train": 3, "test": 3}


def test_trials_and_source_groups(spark):
    split = make_split(inventory(spark, ["a/trial_14", "a/trial_15"]), "xrf55").orderBy("sample_id").collect()
    assert [r["partition"] for r in split] == ["train", "test"]
    groups = make_split(inventory(spark, ["lab276/a", "home276/b", "lab+home276/c"]), "signfi").orderBy("sample_id").collect()
    assert [r["partition"] for r in groups] == ["lab276", "home276", "lab+home276"]


def test_overrides_win(spark):
    records = spark.createDataFrame([("converted", "o", "user_1/f.mat", 2), ("failed", None, "x", 1)],
                                    "status string, output string, source_file string, sample_count int")
    over = spark.createDataFrame([("f.mat", {"subject": "7", "device": "d"}), ("o::1", {"subject": "8"})],
                                 "key string, metadata map<string,string>")
    rows = SP.build_inventory(records, over).orderBy("sample_id").collect()
    assert [(r["sample_id"], r["metadata"]["subject"], r["metadata"]["device"]) for r in rows] == [
        ("o::0", "7", "d"), ("o::1", "8", "d")]


def test_registry():
    known = {row[0] for row in SPLIT_SETTINGS}
    assert len(known) == 25 and len({row[:2] for row in SPLIT_SETTINGS}) == len(SPLIT_SETTINGS)
    assert all(2 <= len(split_settings(d)) <= 8 for d in known)
    assert all(sum(row[-1] for row in SPLIT_SETTINGS if row[0] == d) == 1 for d in known)
    assert split_setting("mm-fi")["ratios"] == [0.8, 0.1, 0.1]
    assert split_setting("wallhack18k", "cross_environment")["group_by"] == "scenario"
    with pytest.raises(ValueError, match="choose one of"):
        split_setting("aril", "nothing")


def test_stratified_pick(spark):
    rows = [(i, i % 16, (i // 16 + i) % 6) for i in range(96)]
    items = spark.createDataFrame(rows, "index long, location int, gesture int")
    picked = SA.stratified_pick(items, "location", F.col("location") % 6, "gesture").collect()
    assert len(picked) == 16 and {r["gesture"] for r in picked} == set(range(6))
    assert all(r["gesture"] == r["location"] % 6 for r in picked)


def greedy(items):
    left, chosen = {f for _, fs in items for f in fs}, []
    while left:
        best = min(items, key=lambda it: (-len(set(it[1]) & left), it[0]))
        chosen.append(best[0])
        left -= set(best[1])
    return chosen


def test_greedy_cover_equals_brute_force(spark):
    items = [(i, [f"a{i % 6}", f"b{i % 2}", f"c{(i * 7) % 3}", f"d{(i // 3) % 5}"]) for i in range(60)]
    df = spark.createDataFrame(items, "id long, features array<string>")
    assert SA.greedy_cover(df, "features", F.col("id")) == greedy(items)
    assert SA.greedy_cover(df, "features", F.col("id"), 2) == greedy(items)[:2]


def test_cover_steps_random_sets_and_ties(spark):
    draw = random.Random(3)
    for size in (3, 40):
        items = [(i, [f"f{draw.randrange(size)}" for _ in range(draw.randrange(5))]) for i in range(80)]
        items = [(i, fs, draw.randrange(4)) for i, fs in items]       # many equal sizes
        df = spark.createDataFrame(items, "id long, features array<string>, bytes long")
        left, want = {f for _, fs, _ in items for f in fs}, []
        while left:
            best = min(items, key=lambda it: (-len(set(it[1]) & left), it[2], it[0]))
            want.append((len(want) + 1, best[0], len(set(best[1]) & left)))
            left -= set(best[1])
        got = [tuple(r) for r in SA.cover_steps(df, "features", F.col("bytes")).orderBy("step").collect()]
        assert got == want


def test_cover_steps_required_nulls_and_empty(spark):
    schema = "id long, features array<string>"
    df = spark.createDataFrame([(1, ["a", None, "a"]), (2, None), (3, []), (4, ["a", "b", "x"])], schema)
    wanted = spark.createDataFrame([("a",), ("b",), (None,)], "name string")
    assert [tuple(r) for r in SA.cover_steps(df, "features", F.col("id"), wanted).collect()] == [(1, 4, 2)]
    assert SA.cover_steps(df.limit(0), "features", F.col("id")).collect() == []
    with pytest.raises(ValueError, match="stalled.*'q'"):
        SA.cover_steps(df, "features", F.col("id"), spark.createDataFrame([("q",)], "name string"))


def test_capture_has_a_cap(spark):
    packets = spark.createDataFrame([("r", i, i / 10) for i in range(100)],
                                    "recording_id string, packet_index long, timestamp_s double")
    iv = spark.createDataFrame([("r", 0, 1.0, 3.0, "a"), ("r", 1, 2.0, 9.0, "b"), ("r", 2, 50.0, 60.0, "c")],
                               "recording_id string, interval_order long, start_seconds double, end_seconds double, label string")
    out = SA.capture_intervals(packets, iv, 15, width=0.5)
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {"a": 15, "b": 15}
    assert out.where("label = 'b'").agg(F.min("packet_index")).first()[0] == 31
    assert [r["label"] for r in SA.missing_labels(out, iv).collect()] == ["c"]
    told = SA.completeness(out, iv, "label", "no packet for label").collect()
    assert {tuple(r) for r in told} == {("a", 15, None), ("b", 15, None), ("c", 0, "no packet for label: c")}
