import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.operators.catalog import SIDECAR_CONSTRAINTS, check_constraints
from packetloom.plans.jobs import standardize, standardize_files
from packetloom.plans.profiles import ViewOptions
from packetloom.plans.views import build_view

PACKETS = ("recording_id string, sample_index int, packet_index long, timestamp_s double, amplitude array<float>, "
           "source_label string")
AXES = ["time", "link", "subcarrier"]


def rows_of(spark, clips, width=6):
    """``{(id, sample): (times, labels)}`` as packets that count up."""
    return spark.createDataFrame(
        [(rid, s, i, t, [float(i)] * width, lab) for (rid, s), (times, labels) in clips.items()
         for i, (t, lab) in enumerate(zip(times, labels))], PACKETS)


def sidecars(spark, entries):
    return spark.createDataFrame(entries, "recording_id string, sample_rate_hz double, axis_order array<string>, links int, "
                                          "labels map<string,string>, tensor_exception boolean")


def test_rate_from_timestamps_and_labels(spark):
    times = [0.0, 0.5, 1.0, 1.5, 4.0, 4.5]
    df = rows_of(spark, {("one", 0): (times, ["a"] * 6), ("many", 0): (times, ["", "a", "a", "", "b", "b"]),
                         ("rated", 0): (times, ["x", "x", "", None, "x", "x"]), ("batch", 0): (times, list("aabbcc")),
                         ("batch", 1): (times, list("aabbcc"))})
    rec = sidecars(spark, [("one", None, AXES, 2, {}, False), ("many", -1.0, AXES, 2, None, None),
                           ("rated", 4.0, AXES, 2, {"activity": "kept"}, False), ("batch", None, ["sample", *AXES], 2, {}, False)])
    view = build_view(df, rec, ViewOptions(duration_s=3.0))
    meta = {r["recording_id"]: r for r in view.recordings.collect()}
    assert meta["one"]["source_sample_rate_hz"] == 2.0 and meta["rated"]["sample_rate_hz"] == 4.0
    assert meta["one"]["window_length"] == 6 and meta["rated"]["window_length"] == 12
    assert meta["one"]["labels"] == {"activity": "a"} and not meta["one"]["segmented"]
    assert meta["rated"]["labels"] == {"activity": "kept"}
    assert meta["many"]["segmented"] and not meta["batch"]["segmented"]
    assert meta["many"]["shape"] == [6, 2, 3] and meta["many"]["axis_order"] == AXES
    assert meta["batch"]["shape"] == [2, 6, 2, 3] and meta["batch"]["axis_order"] == ["sample", *AXES]
    assert meta["one"]["view_options"]["duration_s"] == 3.0 and not meta["one"]["target_rate_assumed"]
    got = [tuple(r)[2:] for r in view.segments.orderBy("run").collect()]
    assert got == [("a", 0, 2, 0.0, 1.0), ("b", 2, 4, 1.0, 2.0)]      # packets without a label take no time
    tail = view.windows.where("recording_id = 'rated'").orderBy("offset").collect()
    assert [r["timestamp_s"] for r in tail[:6]] == [i / 4 for i in range(6)]
    assert all(math.isnan(r["timestamp_s"]) and r["packet_index"] == -1 and r["source_label"] == "" for r in tail[6:])
    assert {r["window_valid_length"] for r in tail} == {6} and {r["window_end_index"] for r in tail} == {6}


def test_several_windows_have_no_segments(spark):
    df = rows_of(spark, {("r", 0): ([float(i) for i in range(7)], list("aaabbbb"))})
    view = build_view(df, sidecars(spark, [("r", 1.0, AXES, 1, {}, False)]), ViewOptions(target_length=3))
    meta = view.recordings.first()
    assert view.segments.count() == 0 and not meta["segmented"] and meta["labels"] == {}
    assert meta["shape"] == [3, 3, 1, 6] and meta["axis_order"] == ["sample", *AXES] and meta["output_window_count"] == 3
    ends = view.windows.select("window_index", "window_valid_length", "window_end_index").distinct().orderBy("window_index").collect()
    assert [tuple(r) for r in ends] == [(0, 3, 3), (1, 3, 6), (2, 1, 7)]


def test_times_without_a_rate(spark):
    """Semantic bins take no rate from the options: times lie from first to last, or are NULL."""
    df = rows_of(spark, {("bins", 0): ([5.0, 5.0, 5.0], [""] * 3), ("none", 0): ([None] * 3, [""] * 3)}, 4)
    axes = ["time_bin", "velocity_x_bin", "velocity_y_bin"]
    rec = sidecars(spark, [("bins", None, axes, None, {}, True), ("none", None, axes, None, {}, True)])
    for options in (ViewOptions(target_rate_hz=100.0, target_length=4), ViewOptions(target_length=4)):
        view = build_view(df, rec, options)
        rows = view.windows.where("packet_index >= 0").orderBy("recording_id", "packet_index").collect()
        assert [r["timestamp_s"] for r in rows] == [5.0] * 3 + [None] * 3
        meta = view.recordings.where("recording_id = 'bins'").first()
        assert meta["sample_rate_hz"] is None and meta["semantic_bins"] and meta["duration_s"] is None
        assert meta["axis_order"] == axes and meta["shape"] is None       # 4 cells do not tell their two sizes


@pytest.mark.parametrize("options, shape, mask", [
    (ViewOptions(links=1), [2, 1, 3], [True] * 3), (ViewOptions(links=3, subcarriers=5), [2, 3, 5], [False, True, True, True, False]),
    (ViewOptions(links=2, subcarriers=1, layout="flat"), [2, 2], [True])])
def test_channel_counts_by_name(spark, options, shape, mask):
    """Axes are found by name in each recording; links are averaged into one, subcarriers cut around the centre."""
    x = np.arange(12, dtype=np.float32).reshape(2, 2, 3)
    df = spark.createDataFrame([("r", i, x[i].ravel().tolist()) for i in range(2)],
                               "recording_id string, packet_index long, amplitude array<float>")
    view = build_view(df, sidecars(spark, [("r", 2.0, AXES, 2, {}, False)]), options)
    meta = view.recordings.first()
    assert meta["shape"] == shape and meta["subcarrier_mask"] == mask
    want = x.mean(axis=1, keepdims=True) if options.links == 1 else x
    if options.links == 3:
        want = np.pad(x, ((0, 0), (0, 1), (1, 1)))
    if options.subcarriers == 1:
        want = x[:, :, 1:2]
    got = np.array([r["amplitude"] for r in view.windows.orderBy("packet_index").collect()])
    assert np.array_equal(got, want.reshape(2, -1))


def test_unknown_counts_and_missing_time_axis(spark):
    df = spark.createDataFrame([("r", i, [0.0] * 5) for i in range(2)], "recording_id string, packet_index long, amplitude array<float>")
    with pytest.raises(Exception, match="size of axis link is not known"):
        build_view(df, sidecars(spark, [("r", 2.0, AXES, 2, {}, False)]), ViewOptions(links=1)).windows.collect()
    with pytest.raises(Exception, match="no time axis"):
        build_view(df, sidecars(spark, [("r", 2.0, ["link", "subcarrier"], 2, {}, False)]), ViewOptions(target_length=2))


def test_phase_is_taken_again(spark):
    df = spark.createDataFrame([("r", i, [1.0], [float(i)], [9.0]) for i in range(3)],
                               "recording_id string, packet_index long, csi_real array<float>, csi_imag array<float>, phase_rad array<float>")
    view = build_view(df, sidecars(spark, [("r", 1.0, AXES, 1, None, False)]), ViewOptions(target_length=3))
    got = [r["phase_rad"][0] for r in view.windows.orderBy("packet_index").collect()]
    assert np.allclose(got, np.arctan2([0, 1, 2], 1), atol=1e-6)
    assert any("phase" in t for t in view.recordings.select(F.explode("transformations")).toPandas()["col"])


def test_sidecars_pass_their_constraints_and_enter_a_view(spark, folder):
    head = "timestamp_s," + ",".join(f"amplitude_l{i}_s{s}" for i in range(2) for s in range(3))
    files = {"good one.csv": "\n".join([head, *[f"{i / 10},{','.join([str(i)] * 6)}" for i in range(21)]]),
             "cell.csv": f"{head}\n0.0,1,2,3,4,5,6\n0.1,1,2,x,4,5,6\n", "head.csv": "t,a\n0,1\n", "none.csv": "",
             "short.csv": f"{head}\n0.0,1,2,3,4,5,6\n"}
    for name, text in files.items():
        (folder / name).write_text(text)
    made = standardize_files(spark, str(folder), "demo", 10.0)
    assert check_constraints(made.recordings, "recording_id", SIDECAR_CONSTRAINTS).count() == 0
    cards = made.recordings.collect()
    assert len(cards) == 1 and cards[0]["shape"][1:] == [2, 3]
    assert cards[0]["source_sha256"] == hashlib.sha256(files["good one.csv"].encode()).hexdigest()
    errors = {r["recording_id"].rsplit("/", 1)[-1]: r["error"] for r in made.failed.collect()}
    assert set(errors) == {"cell.csv", "head.csv", "none.csv", "short.csv"} and "not a number" in errors["cell.csv"]
    view = build_view(made.packets, made.recordings, ViewOptions(target_rate_hz=5.0, target_length=4, links=1))
    assert view.recordings.first()["shape"] == [3, 4, 1, 3] and view.windows.where("packet_index >= 0").count() == 10
    with pytest.raises(ValueError, match="csv"):
        standardize(spark, str(folder), "demo", 10.0, out=str(folder / "out"))
    assert spark.read.parquet(str(folder / "out" / "recordings")).count() == 1
