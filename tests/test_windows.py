import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.functions import arrays as A
from packetloom.operators import windows as W
from packetloom.plans.jobs import create_view, prepare_packets, view_policy
from packetloom.plans.profiles import ViewOptions, resolve_profile, task_view


def tensor(spark, counts, width, name="c", start=0.0):
    """Recordings ``{id: packets}`` of constant width."""
    return spark.createDataFrame(
        [(rid, i, [start + float(i)] * width, True) for rid, n in counts.items() for i in range(n)],
        "recording_id string, packet_index long, amplitude array<float>, valid boolean")


def described(spark, rates, axes=("time", "subcarrier", "tx_link", "rx_link")):
    return spark.createDataFrame([(k, v, list(axes)) for k, v in rates.items()],
                                 "recording_id string, sample_rate_hz double, axis_order array<string>")


def test_batch_windows_keep_every_packet(spark):
    rows = [(f"r", s, i, [float(i)] * 90) for s in range(2) for i in range(250)]
    df = spark.createDataFrame(rows, "recording_id string, sample_index int, packet_index long, amplitude array<float>")
    windows, meta = create_view(df, described(spark, {"r": None}), ViewOptions(target_length=128, layout="flat"))
    assert windows.count() == 4 * 128 and windows.where("valid").count() == 500
    table = W.window_table(df, 128).orderBy("sample_index", "window_index").collect()
    assert [r["window_valid_length"] for r in table] == [128, 122, 128, 122]
    assert [r["sample_index"] for r in table] == [0, 0, 1, 1]
    assert meta.first()["output_window_count"] == 4
    tail = windows.where("not valid").select("packet_index", "amplitude").first()
    assert tail["packet_index"] == -1 and set(tail["amplitude"]) == {0.0}


def test_shortest_recording_sets_the_window(spark):
    df = tensor(spark, {"a": 2, "b": 5}, 3)
    recordings = described(spark, {"a": None, "b": None}).withColumn("dataset_id", F.lit("wallhack18k"))
    done = prepare_packets(df, recordings, "wallhack18k", setting="random")
    assert done.policy.first()["selected_window_length"] == 2
    lengths = (done.windows.where("valid").where("recording_id = 'b'").groupBy("window_index")
               .count().orderBy("window_index").collect())
    assert [r["count"] for r in lengths] == [2, 2, 1]
    assert done.windows.where("recording_id = 'b' and valid").count() == 5


def test_upsampled_view(spark):
    df = tensor(spark, {"r": 4}, 6)
    windows, meta = create_view(df, described(spark, {"r": 4.0}), ViewOptions(target_rate_hz=8.0, target_length=8))
    rows = windows.orderBy("packet_index").collect()
    assert len(rows) == 8 and all(r["valid"] for r in rows)
    assert [r["timestamp_s"] for r in rows] == [i / 8 for i in range(8)]
    assert meta.first()["duration_s"] == 1.0


def test_rate_conversion_of_a_batch(spark):
    rows = [("r", s, i, [1.0, 2.0]) for s in range(2) for i in range(1800)]
    df = spark.createDataFrame(rows, "recording_id string, sample_index int, packet_index long, amplitude array<float>")
    windows, meta = create_view(df, described(spark, {"r": 1000.0}), ViewOptions(target_rate_hz=100.0, duration_s=1.8))
    assert meta.first()["window_length"] == 180
    assert windows.count() == 2 * 180


def test_channel_fit(spark):
    df = spark.createDataFrame([([float(i) for i in range(64)],)], "amplitude array<float>")
    out, shape = W.fit_channels(df, (64, 1, 1), ["amplitude"], 20, 2, 3)
    got = np.array(out.first()["amplitude"]).reshape(shape)
    assert shape == (20, 2, 3) and got[:, 0, 0].tolist() == list(range(22, 42))
    assert (got[:, 1] == 0).all() and (got[:, 0, 1:] == 0).all()
    masks = W.dimension_masks(df, (64, 1, 1), 20, 2, 3).first()
    assert all(masks["subcarrier_mask"]) and masks["tx_link_mask"] == [True, False]
    assert masks["rx_link_mask"] == [True, False, False]
    coords = df.select(A.fit_coordinate(F.array(*map(F.lit, (7, 8, 9))), 6, True).alias("c")).first()["c"]
    assert coords == [-1, 7, 8, 9, -1, -1]


def test_options_and_profiles():
    with pytest.raises(ValueError, match="positive"):
        ViewOptions(target_rate_hz=0)
    with pytest.raises(ValueError, match="layout"):
        ViewOptions(layout="round")
    with pytest.raises(ValueError, match="unknown task profile"):
        resolve_profile("clip-9s")
    assert resolve_profile("native-10hz").length_limit == 300
    assert resolve_profile(None).profile == "general-sensing"
    shaped = resolve_profile("vital-sign", ViewOptions(subcarriers=30))
    assert shaped.target_rate_hz == 10.0 and shaped.subcarriers == 30


def test_unknown_bin_cadence_gets_no_rate(spark):
    df = spark.createDataFrame([("r", i, [0.0] * 4) for i in range(22)],
                               "recording_id string, packet_index long, bvp array<float>")
    rec = described(spark, {"r": None}, ("time_bin", "velocity_x_bin", "velocity_y_bin")).withColumn(
        "tensor_exception", F.lit(True))
    _, meta = create_view(df, rec, ViewOptions(target_rate_hz=100.0, target_length=22))
    row = meta.first()
    assert row["sample_rate_hz"] is None and row["semantic_bins"] and not row["target_rate_assumed"]


def test_windows_per_task(spark):
    df = tensor(spark, {"x/BreathingDetection/a": 240, "x/FallDetection/b": 500}, 2)
    rec = described(spark, {"x/BreathingDetection/a": None, "x/FallDetection/b": None}).withColumn(
        "labels", F.create_map().cast("map<string,string>"))
    view, per, policy = view_policy(df.withColumn("sample_index", F.lit(0)), rec, "csi-bench", None)
    got = {r["recording_id"].split("/")[1]: r["window_length"] for r in per.collect()}
    assert got == {"BreathingDetection": 240, "FallDetection": 300}
    asked = task_view(rec.withColumn("_t", F.lit(None).cast("string")), "_t", "recording_id").collect()
    assert {r["task"]: r["target_rate_hz"] for r in asked} == {"BreathingDetection": 10.0, "FallDetection": 100.0}


def test_link_mean(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 6.0],)], "amplitude array<float>")
    assert W.fit_links(df, (2, 2), ["amplitude"], 1).first()["amplitude"] == [2.0, 4.0]
    assert W.fit_links(df, (2, 2), ["amplitude"], 3).first()["amplitude"] == [1.0, 2.0, 3.0, 6.0, 0.0, 0.0]
