import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.functions import vocabularies as V
from packetloom.plans import adapters as AD
from packetloom.plans import jobs as E
from packetloom.plans.registry import SOURCE_PATTERNS

RNG = np.random.default_rng(11)


def iq_rows(spark, matrix, path="p", index="row_index"):
    """Complex ``row x carrier`` matrix as rows."""
    rows = [("r", path, i, m.real.astype(float).tolist(), m.imag.astype(float).tolist())
            for i, m in enumerate(matrix)]
    return spark.createDataFrame(
        rows, f"recording_id string, path string, {index} long, csi_real array<double>, csi_imag array<double>")


def tensor(df, column, shape, *keys):
    rows = df.orderBy(*(keys or ("packet_index",))).select(column).collect()
    return np.array([r[0] for r in rows]).reshape((len(rows), *shape))


def complex_noise(*shape):
    return (RNG.normal(size=shape) + 1j * RNG.normal(size=shape)).astype(np.complex64)


def test_every_dataset_has_an_adapter():
    assert set(AD.ADAPTERS) == set(SOURCE_PATTERNS) and len(AD.ADAPTERS) == 25
    with pytest.raises(ValueError, match="no adapter"):
        AD.adapter_for("nothing")


def test_aril(spark):
    data = RNG.normal(size=(2, 52, 192)).astype(np.float32)
    df = spark.createDataFrame([("r", i, data[i].ravel().tolist(), i, i) for i in range(2)],
                               "recording_id string, sample_index int, data array<float>, activity int, location int")
    out = AD.aril(df)
    got = tensor(out, "amplitude", (52,), "sample_index", "packet_index").reshape(2, 192, 52)
    assert np.allclose(got, data.transpose(0, 2, 1))
    assert {r[0] for r in out.select("source_label").distinct().collect()} == {"hand_up", "hand_down"}


@pytest.mark.parametrize("shape,source,canonical", [
    ((56, 70, 2), "carrier rows", (1, 0, 2)), ((40, 50, 30), "packet rows", (0, 2, 1))])
def test_csi_bench_tensors(spark, shape, source, canonical):
    data = RNG.normal(size=shape).astype(np.float32)
    df = spark.createDataFrame([("r", i, m.ravel().tolist()) for i, m in enumerate(data)],
                               "recording_id string, row_index long, data array<float>")
    shapes = spark.createDataFrame([("r", list(shape))], "recording_id string, shape array<int>")
    want = data.transpose(canonical)
    with pytest.raises(Exception, match="not recognized"):
        AD.csi_bench(df, shapes.withColumn("shape", F.array(*map(F.lit, (40, 3, 30))))).collect()
    assert np.allclose(tensor(AD.csi_bench(df, shapes), "amplitude", want.shape[1:]), want)


def test_csi_bench_clips(spark):
    data = RNG.normal(size=(3, 8, 2, 30)).astype(np.float32)
    df = spark.createDataFrame([("r", i, m.ravel().tolist()) for i, m in enumerate(data)],
                               "recording_id string, row_index long, data array<float>")
    shapes = spark.createDataFrame([("r", [3, 8, 2, 30])], "recording_id string, shape array<int>")
    got = tensor(AD.csi_bench(df, shapes), "amplitude", (30, 2), "sample_index", "packet_index")
    assert np.allclose(got.reshape(3, 8, 30, 2), data.transpose(0, 1, 3, 2))


def test_csida(spark):
    amp = RNG.uniform(1, 2, size=(2, 4, 3, 114)).astype(np.float32)
    pha = RNG.uniform(-3, 3, size=(2, 4, 3, 114)).astype(np.float32)
    make = lambda name, x: spark.createDataFrame(
        [("r", i, m.ravel().tolist()) for i, m in enumerate(x)],
        f"recording_id string, sample_index int, {name} array<float>")
    out = AD.csida(make("amplitude", amp), make("phase_rad", pha))
    real = tensor(out, "csi_real", (114, 3), "sample_index", "packet_index").reshape(2, 4, 114, 3)
    assert np.allclose(real, (amp * np.cos(pha)).transpose(0, 1, 3, 2), atol=1e-5)


@pytest.mark.parametrize("carriers,bandwidth,env,kept", [
    (64, 20, "lab", 56), (56, 20, "lab", 56), (256, 80, "Industrial hall", 208), (256, 80, "lab", 241)])
def test_ehunam_null_carriers(spark, carriers, bandwidth, env, kept):
    df = iq_rows(spark, complex_noise(2, carriers), "a/C_S_R_app_AB_WG_1_O_9.mat", "packet_index").withColumn(
        "bandwidth", F.lit(bandwidth)).withColumn("environment", F.lit(env))
    row = AD.ehunam(df).first()
    assert len(row["amplitude"]) == kept == len(row["subcarrier_index"])
    assert row["occupancy"] == "2 people" and row["activity_label"] == "walking + sit down / get up"


def test_exposing_csi_deinterleaves_after_dropping_empty_rows(spark):
    x = complex_noise(9, 2048)
    x[2] = 0
    out = AD.exposing_csi(iq_rows(spark, x, "S1_A_1.mat"))
    kept = np.delete(np.fft.fftshift(x[[0, 1, 3, 4, 5, 6, 7, 8]], axes=1), V.NULL_2048_BINS, axis=1)
    kept = kept / np.abs(kept).mean(axis=1, keepdims=True)
    want = np.abs(kept).reshape(2, 4, -1).transpose(0, 2, 1)
    got = tensor(out, "amplitude", (1990, 4))
    assert np.allclose(got, want, atol=1e-4)
    assert out.first()["activity_label"] == "walk"


def test_wifi_80mhz_drops_groups_not_rows(spark):
    x = complex_noise(14, 242)
    x[4:8] = 0
    x[9] = 0
    got = tensor(AD.wifi_80mhz(iq_rows(spark, x, "AR1a_W_1.mat"), 242), "amplitude", (242, 4))
    want = np.abs(x[:12].reshape(3, 4, 242)[[0, 2]]).transpose(0, 2, 1)
    assert np.allclose(got, want, atol=1e-5)
    y = complex_noise(4, 1024)
    want = np.delete(np.fft.fftshift(y, axes=1)[:, ::4], V.NULL_256_BINS, axis=1)
    got = tensor(AD.wifi_80mhz(iq_rows(spark, y, "PI1_p03.mat"), 1024), "amplitude", (242, 4))
    assert np.allclose(got, np.abs(want).reshape(1, 4, 242).transpose(0, 2, 1), atol=1e-5)


def test_mm_fi_unfolds_and_repairs(spark):
    x = RNG.normal(size=(3, 3, 114, 10)).astype(np.float32)
    x[1, 2, 5, 4] = np.nan
    df = spark.createDataFrame([("r", "E01/S01/A27/wifi-csi", i, m.ravel().tolist()) for i, m in enumerate(x)],
                               "recording_id string, path string, frame_index long, amplitude array<float>")
    out = AD.mm_fi(df)
    got = tensor(out, "amplitude", (114, 3))
    assert got.shape == (30, 114, 3) and np.isfinite(got).all()
    fill = np.nanmean(x[1, :, :, 4])
    assert got[14, 5, 2] == pytest.approx(fill, abs=1e-5)
    assert np.allclose(got[25], x[2, :, :, 5].T)
    assert out.first()["source_label"] == "bowing"


def test_nist_keeps_measured_slots(spark):
    full = np.zeros((4, 9, 114))
    full[:, [0, 1, 3, 4, 6, 7], :56] = RNG.uniform(1, 2, size=(4, 6, 56))
    make = lambda x: spark.createDataFrame(
        [("r/FrameRate5/BreathingPattern2", i, m.ravel().tolist()) for i, m in enumerate(x)],
        "recording_id string, row_index long, values array<double>")
    config = spark.createDataFrame([("r/FrameRate5/BreathingPattern2", 0, "msgFreq", "10"), ("r/FrameRate5/BreathingPattern2", 1, "bpm", "15")],
                                   "recording_id string, row_index long, key string, value string")
    out = AD.nist_breathesmart(make(full), make(full * 2), config=config)
    got = tensor(out, "csi_real", (56, 2, 3))
    want = full.reshape(4, 3, 3, 114)[:, :, :2, :56].transpose(0, 3, 2, 1)
    assert np.allclose(got, want, atol=1e-6)
    rows = out.orderBy("packet_index").collect()
    assert [r["timestamp_s"] for r in rows] == pytest.approx([0, .1, .2, .3])
    assert rows[0]["source_label"] == "BreathingPattern2"
    broken = full.copy()
    broken[:, 2, 0] = 1
    with pytest.raises(Exception, match="documented layout"):
        AD.nist_breathesmart(make(broken), make(broken)).collect()


def test_ntu_fi(spark):
    x = RNG.normal(size=(342, 2000)).astype(np.float32)
    df = spark.createDataFrame([("r", "train_amp/run/a.mat", i, m.tolist()) for i, m in enumerate(x)],
                               "recording_id string, path string, row_index long, data array<float>")
    out = AD.ntu_fi(df)
    got = tensor(out, "amplitude", (114, 3))
    assert np.allclose(got, x.reshape(3, 114, 2000)[:, :, ::4].transpose(2, 1, 0))
    row = out.orderBy("packet_index").first()
    assert row["official_normalized_amplitude"][0] == pytest.approx((x[0, 0] - 42.3199) / 4.9802, rel=1e-5)
    assert row["source_label"] == "run"


def test_operanet_orders_columns(spark):
    names = [f"tx{t}rx{r}_sub{s}" for s in range(1, 31) for r in range(1, 4) for t in range(1, 4)]
    cols = {n: RNG.normal(size=3) for n in names}
    data = [["r", i, 1000.0 + 5 * i] + [float(cols[n][i]) for n in names] + [0.0] * 270 for i in range(3)]
    schema = ("recording_id string, packet_index long, timestamp_ms double, " + ", ".join(f"{n} double" for n in names)
              + ", " + ", ".join(f"{n}_imag double" for n in names))
    out = AD.operanet(spark.createDataFrame(data, schema))
    got = tensor(out, "csi_real", (30, 3, 3))
    for t, r, s in ((1, 1, 1), (3, 2, 10), (2, 3, 30)):
        assert got[:, s - 1, t - 1, r - 1] == pytest.approx(cols[f"tx{t}rx{r}_sub{s}"])
    row = out.orderBy("packet_index").collect()[2]
    assert row["timestamp_s"] == pytest.approx(0.01) and row["sample_rate_hz"] == pytest.approx(200.0)


def test_signfi(spark):
    x = complex_noise(5, 30, 3, 4)
    rows = [("r", i, m.real.ravel().astype(float).tolist(), m.imag.ravel().astype(float).tolist()) for i, m in enumerate(x)]
    out = AD.signfi(spark.createDataFrame(
        rows, "recording_id string, packet_index long, csi_real array<float>, csi_imag array<float>"), 4)
    got = tensor(out, "amplitude", (30, 3), "sample_index", "packet_index").reshape(4, 5, 30, 3)
    assert np.allclose(got, np.abs(x).transpose(3, 0, 1, 2), atol=1e-5)


def test_ut_har(spark):
    x = RNG.normal(size=(2, 250, 90)).astype(np.float32)
    df = spark.createDataFrame([("r", i, m.ravel().tolist()) for i, m in enumerate(x)],
                               "recording_id string, row_index long, data array<float>")
    labels = spark.createDataFrame([("r", 0, 1), ("r", 1, 6)], "recording_id string, row_index long, label int")
    out = AD.ut_har(df, labels)
    got = tensor(out, "amplitude", (30, 3), "sample_index", "packet_index").reshape(2, 250, 30, 3)
    assert np.allclose(got, x.reshape(2, 250, 3, 30).transpose(0, 1, 3, 2))
    assert {r[0] for r in out.select("source_label").distinct().collect()} == {"fall", "stand_up"}
    with pytest.raises(Exception, match="counts differ"):
        AD.ut_har(df, labels.limit(1)).collect()


def test_wallhack_prepare(spark, folder):
    (folder / "NLOS" / "BQ").mkdir(parents=True)
    for name, n in (("w1", 2), ("w12", 5)):
        cells = [f'"{RNG.integers(-9, 9, 128).tolist()}",{1}' for _ in range(n)]
        (folder / "NLOS" / "BQ" / f"{name}.csv").write_text("data,class\n" + "\n".join(cells) + "\n")

    def adapter(session, paths):
        packets = AD.wallhack18k(session, paths)
        recs = packets.select("recording_id").distinct().withColumn("sample_rate_hz", F.lit(100.0)).withColumn(
            "axis_order", F.array(*map(F.lit, ("time", "link", "subcarrier")))).withColumn(
            "dataset_id", F.lit("wallhack18k")).withColumn("links", F.lit(1)).withColumn(
            "tx_links", F.lit(None).cast("int")).withColumn("rx_links", F.lit(None).cast("int"))
        return packets, recs

    out = folder / "out"
    done = E.prepare(spark, "wallhack18k", str(folder), str(out), adapter, setting="random")
    packets = spark.read.parquet(f"{out}/packets")
    assert packets.count() == 7 and {len(r[0]) for r in packets.select("amplitude").collect()} == {52}
    assert {r[0] for r in packets.select("source_label").collect()} == {"walking"}
    assert {r[0] for r in packets.select("room").collect()} == {"room 1", "room 12"}
    assert {r[0] for r in packets.select("subcarrier_index").distinct().select(F.get("subcarrier_index", F.lit(0))).collect()} == {6}
    assert spark.read.parquet(f"{out}/windows").where("valid").count() == 7
    assert spark.read.parquet(f"{out}/split").count() == 2
    assert done.policy.first()["selected_window_length"] == 2
    with pytest.raises(FileNotFoundError):
        E.prepare(spark, "aril", str(folder), str(out), adapter)
    with pytest.raises(ValueError, match="unsupported dataset"):
        E.prepare(spark, "zzz", str(folder), str(out), adapter)


def test_wiar(spark):
    x = complex_noise(3, 2, 3, 30)
    rows = [("r", "csi_a12_3.dat", i, 1e6 * i + 5.0, m.real.ravel().astype(float).tolist(), m.imag.ravel().astype(float).tolist())
            for i, m in enumerate(x)]
    out = AD.wiar(spark.createDataFrame(rows, "recording_id string, path string, packet_index long, timestamp_low double, "
                                              "csi_real array<float>, csi_imag array<float>"), 2, 3)
    assert np.allclose(tensor(out, "amplitude", (30, 2, 3)), np.abs(x).transpose(0, 3, 1, 2), atol=1e-5)
    row = out.orderBy(F.desc("packet_index")).first()
    assert row["timestamp_s"] == 2.0 and row["source_label"] == "walk" and row["trial_id"] == 3


def test_widar_csv(spark, folder):
    target = folder / "train" / "3-push_pull"
    target.mkdir(parents=True)
    x = RNG.uniform(0, 1, size=(22, 400))
    np.savetxt(target / "user7-a.csv", x, delimiter=",")
    out = AD.widar3(spark, str(target))
    assert np.allclose(tensor(out, "bvp", (20, 20)), x.reshape(22, 20, 20), atol=1e-6)
    row = out.first()
    assert (row["gesture"], row["subject"], row["split"]) == ("push pull", "user7", "train")


def test_presence_jsonl(spark, folder):
    (folder / "mobile").mkdir()
    x = complex_noise(2, 30, 3)
    lines = [json.dumps({"t": 100.0 + 0.1 * i, "csi": [[{"r": float(v.real), "i": float(v.imag)} for v in row] for row in p]})
             for i, p in enumerate(x)]
    (folder / "mobile" / "a.json").write_text("\n".join(lines) + "\n")
    out = AD.wifi_presence_movement(spark, str(folder / "mobile"))
    assert np.allclose(tensor(out, "amplitude", (3, 30), "timestamp_s"), np.abs(x).transpose(0, 2, 1), atol=1e-5)
    rows = out.orderBy("timestamp_s").collect()
    assert [r["timestamp_s"] for r in rows] == pytest.approx([0, 0.1]) and rows[0]["source_label"] == "Mobile"


def test_wifi_tad_segments(spark):
    x = RNG.normal(size=(100, 30))
    df = spark.createDataFrame([("v", i, m.tolist()) for i, m in enumerate(x)],
                               "recording_id string, row_index long, data array<double>")
    info = spark.createDataFrame([("v", 0, "300", "100")], "name string, row_index long, count string, sample_count string")
    anno = spark.createDataFrame([("v", "2", "30", "90"), ("v", "9", "1", "2"), ("v", "2", "x", "2")],
                                 "name string, class string, start string, end string")
    packets, segments = AD.wifi_tad(df, anno, info)
    for one in packets.collect():
        assert one["official_normalized_amplitude"] == pytest.approx([v / 40 for v in one["amplitude"]], rel=1e-5)
    row = segments.collect()
    assert len(row) == 1 and row[0]["label"] == "walk" and row[0]["start_seconds"] == pytest.approx(0.1)
    turned = spark.createDataFrame([("v", i, m.tolist()) for i, m in enumerate(x.T)],
                                   "recording_id string, row_index long, data array<double>")
    assert np.allclose(tensor(AD.wifi_tad(turned)[0], "amplitude", (30,)), x, atol=1e-5)


def test_wimans(spark):
    x = RNG.normal(size=(6, 3, 3, 30)).astype(np.float32)
    df = spark.createDataFrame([("r", "d/wifi_csi/amp/act_1.npy", i, m.ravel().tolist()) for i, m in enumerate(x)],
                               "recording_id string, path string, packet_index long, amplitude array<float>")
    anno = spark.createDataFrame([("d", 0, "act_1", "2", "classroom", "5", "walk", "walk", "a", "b")],
                                 "folder string, row_index long, label string, number_of_users string, environment string, "
                                 "wifi_band string, user_1_activity string, user_2_activity string, user_1_location string, user_2_location string")
    out = AD.wimans(df, anno)
    assert np.allclose(tensor(out, "amplitude", (30, 3, 3)), x.transpose(0, 3, 1, 2))
    row = out.orderBy(F.desc("packet_index")).first()
    assert (row["source_label"], row["occupancy"], row["band"], row["locations"]) == ("walk", "2 people", "5 GHz", ["a", "b"])
    assert row["timestamp_s"] == pytest.approx(2.5) and row["sample_rate_hz"] == 2.0
    assert AD.wimans(df).first()["source_label"] == "act_1"


def test_wipe_fall_and_glasgow_csv(spark, folder):
    x = RNG.uniform(1, 2, size=(51, 80))
    for name in ("high_unseen/a", "2_Subjects_Sitting_Walk/b", "z/SittingL2Z3_1"):
        path = folder / f"{name}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        np.savetxt(path, x, delimiter=",")
    out = AD.wipe_fall(spark, str(folder / "high_unseen"))
    assert np.allclose(tensor(out, "amplitude", (51,)), x.T, atol=1e-6)
    assert (out.first()["source_label"], out.first()["release_split"]) == ("high", "unseen test")
    row = AD.glasgow_multiuser(spark, str(folder / "2_Subjects_Sitting_Walk")).first()
    assert row["scenario"] == "2 people: sitting walking" and row["activities"] == ["sitting", "walking"]
    row = AD.glasgow_activity_localization(spark, str(folder / "z")).first()
    assert (row["source_label"], row["location"]) == ("sitting", "location 2, zone 3")


def test_figshare_csv(spark, folder):
    x = RNG.normal(size=(3, 114 + 2 * 4 * 114))
    np.savetxt(folder / "data.csv", x, delimiter=",")
    (folder / "label.csv").write_text("0,walking\n1,walking\n2,sitting\n3,extra\n")
    out = AD.figshare_csi_har(spark, str(folder / "data.csv"), str(folder / "label.csv"))
    want = x[:, 114:114 * 5].reshape(3, 4, 114).transpose(0, 2, 1)
    assert np.allclose(tensor(out, "amplitude", (114, 4)), want, atol=1e-5)
    assert [r["source_label"] for r in out.orderBy("packet_index").collect()] == ["walking", "walking", "sitting"]


def test_wireless_har(spark):
    names = [f"tx1rx{r}_sub{s}" for r in range(1, 4) for s in range(1, 31)]
    values = RNG.normal(size=(2, 90))
    data = [["r", "x/WiFi_CSI/Room_2/pickup/a.mat", i] + v.tolist() + [0.0] * 90 for i, v in enumerate(values)]
    schema = "recording_id string, path string, packet_index long, " + ", ".join(
        [f"{n} double" for n in names] + [f"{n}_imag double" for n in names])
    df = spark.createDataFrame(data, schema)
    out = AD.wireless_har(df)
    assert np.allclose(tensor(out, "csi_real", (30, 3)), values.reshape(2, 3, 30).transpose(0, 2, 1))
    assert (out.first()["activity_label"], out.first()["room"]) == ("pick up", "room 2")
    with pytest.raises(ValueError, match="missing columns: tx1rx1_sub2"):
        AD.wireless_har(df.drop("tx1rx1_sub2"))


def test_xrf_v2_paints_later_intervals_over(spark):
    x = RNG.normal(size=(8, 3, 3, 30)).astype(np.float32)
    df = spark.createDataFrame([("r", "d/5_2_1.h5", i, m.ravel().tolist(), m.ravel().tolist()) for i, m in enumerate(x)],
                               "recording_id string, path string, packet_index long, amplitude array<float>, phase_rad array<float>")
    iv = spark.createDataFrame([("r", 0, 11, -3, 6), ("r", 1, 7, 4, 99)],
                               "recording_id string, interval_order long, label_id int, start_index long, end_index long")
    out = AD.xrf_v2(df, iv, [2, 0])
    assert np.allclose(tensor(out, "amplitude", (30, 3, 2)), x[:, [2, 0]].transpose(0, 3, 2, 1))
    assert [r["source_label"] for r in out.orderBy("packet_index").collect()] == ["typing"] * 4 + ["sitting down"] * 4
    assert out.first()["scene"] == "study room"
    with pytest.raises(Exception, match="unknown label id"):
        AD.xrf_v2(df, iv.withColumn("label_id", F.lit(99))).collect()
    with pytest.raises(ValueError, match="receivers"):
        AD.xrf_v2(df, iv, [3])


def test_xrf55(spark):
    x = RNG.normal(size=(270, 1000)).astype(np.float32)
    df = spark.createDataFrame([("r", "Scene2/01_24_03.npy", i, m.tolist()) for i, m in enumerate(x)],
                               "recording_id string, path string, row_index long, data array<float>")
    out = AD.xrf55(df)
    assert np.allclose(tensor(out, "amplitude", (30, 9)), x.reshape(9, 30, 1000).transpose(2, 1, 0))
    assert (out.first()["source_label"], out.first()["scene_id"], out.first()["subject_id"]) == ("Tai Chi", 2, 1)


def test_generic_prefers_complex_parts(spark):
    df = spark.createDataFrame([("r", 0, [3.0], [4.0], [9.0], "a", 7)],
                               "recording_id string, packet_index long, real array<double>, imag array<double>, csi array<double>, y string, person int")
    row = AD.generic(df).first()
    assert row["amplitude"] == [5.0] and row["source_label"] == "a" and row["subject"] == 7
    with pytest.raises(ValueError, match="could not find"):
        AD.generic(df.select("recording_id", "packet_index", "y"))
