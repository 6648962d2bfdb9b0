import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.operators import resample as R
from packetloom.operators import timeline as TL
from packetloom.operators.quantiles import exact_cell_percentiles, exact_percentiles
from packetloom.plans.jobs import standardize, standardize_packets

SCHEMA = ("recording_id string, source_order long, timestamp_s double, csi_real array<float>, "
          "csi_imag array<float>")


def packets(spark, times, real, imag=None, name="r"):
    imag = imag or [[0.0] * len(r) for r in real]
    return spark.createDataFrame(
        [(name, i, float(t), r, m) for i, (t, r, m) in enumerate(zip(times, real, imag))], SCHEMA)


def test_short_fixed_rate(spark):
    df = packets(spark, [0, .02, .04, .06, .08], [[1.0, 1.0]] * 5)
    rows = standardize_packets(df, 100.0, 0.1).orderBy("packet_index").collect()
    assert len(rows) == 10
    assert rows[-1]["timestamp_s"] == pytest.approx(0.09)
    assert not rows[-1]["valid"]
    assert all(v == pytest.approx(0.0) for r in rows if r["valid"] for v in r["power_db_rel"])


def test_unsorted_and_duplicate_timestamps(spark):
    df = packets(spark, [.02, 0, .02, .04], [[0.0], [1.0], [2.0], [3.0]])
    clean = TL.prepare_time(df).orderBy("timestamp_s").collect()
    assert [r["timestamp_s"] for r in clean] == pytest.approx([0, .02, .04])
    assert [r["csi_real"][0] for r in clean] == [1.0, 0.0, 3.0]
    assert R.resample_time(TL.prepare_time(df), 50.0, 0.06).count() == 3


def test_bad_times_and_short_recordings(spark):
    df = packets(spark, [float("nan"), 1.0, 1.0], [[1.0]] * 3)
    assert TL.prepare_time(df).count() == 0
    assert TL.short_recordings(df).first()["unique_timestamps"] == 1
    with pytest.raises(ValueError):
        R.resample_time(df, 0.0)
    with pytest.raises(ValueError):
        R.resample_time(df, 1.0, -1.0)


@pytest.mark.parametrize("rate,duration", [(7.0, None), (3.3, 4.0), (50.0, 1.5), (0.5, None)])
def test_grid_equals_numpy(spark, rate, duration):
    rng = np.random.default_rng(3)
    t = np.sort(rng.uniform(5, 9, 60))
    x = rng.normal(size=(60, 3)).astype(np.float32)
    y = rng.normal(size=(60, 3)).astype(np.float32)
    df = packets(spark, t.tolist(), x.tolist(), y.tolist())
    grid = R.standard_grid(TL.prepare_time(df), rate, duration, bucket_s=0.7)
    rows = grid.orderBy("packet_index").collect()
    t = t - t[0]
    span = duration if duration is not None else t[-1] + 1.0 / rate
    n = max(1, int(np.rint(span * rate)))
    at = np.arange(n) / rate
    near = np.abs(at[:, None] - t[None, :]).min(axis=1)
    valid = (at <= t[-1]) & (near <= max(1.5 / rate, 1.5 * np.median(np.diff(t))))
    assert [r["packet_index"] for r in rows] == list(range(n))
    assert [r["valid"] for r in rows] == valid.tolist()
    for c in range(3):
        want = np.interp(at, t, x[:, c]).astype(np.float32) * valid
        assert np.allclose([r["csi_real"][c] for r in rows], want, atol=1e-6)
        both = np.hypot(want, np.interp(at, t, y[:, c]).astype(np.float32) * valid)
        assert np.allclose([r["amplitude"][c] for r in rows], both, atol=1e-6)


def test_demo_wide_csv(spark, folder):
    lines = ["timestamp_s," + ",".join(f"real_l0_s{s},imag_l0_s{s}" for s in range(4))]
    for i in range(198):
        t = i / 50 + (0.001 if i % 7 == 0 else 0.0)
        lines.append(",".join([repr(t)] + ["1.5,0.5"] * 4))
    (folder / "demo.csv").write_text("\n".join(lines) + "\n")
    done, sidecars = standardize(spark, str(folder / "demo.csv"), "demo", 50.0, 3.9)
    assert done.count() == round(50.0 * 3.9)
    card = sidecars.first()
    assert card["standard_representation"] == "complex_csi"
    assert card["shape"] == [195, 1, 4] and card["duration_s"] == pytest.approx(3.9)


def test_percentiles_are_exact_beyond_the_sketch(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.exponential(1, 6000), np.full(3000, 0.25)])
    df = spark.createDataFrame([(int(i % 3 == 0), float(v)) for i, v in enumerate(x)], "g int, x double")
    wanted = {"a": 0.02, "b": 0.5, "c": 0.98, "d": 0.0, "e": 1.0}
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], F.col("x"), wanted, accuracy=100).collect()}
    for g in (0, 1):
        part = x[[i for i in range(len(x)) if int(i % 3 == 0) == g]]
        for name, p in wanted.items():
            assert got[g][name] == pytest.approx(np.percentile(part, p * 100), abs=1e-12)


def test_percentiles_of_rows_and_cells_at_every_size(spark):
    rng = np.random.default_rng(1)
    groups = {n: np.round(rng.normal(size=n), 1 + n % 3) for n in [*range(1, 30), 60, 150, 900, 4000]}
    wanted = {"a": 0.0, "b": 0.02, "c": 0.25, "d": 0.5, "e": 0.98, "f": 1.0}
    rows = spark.createDataFrame([(n, float(v)) for n, x in groups.items() for v in x] + [(3, None), (3, float("nan"))], "g int, x double")
    packets = spark.createDataFrame(
        [(n, [*map(float, x[i: i + 7]), None]) for n, x in groups.items() for i in range(0, n, 7)] + [(3, [float("nan")]), (4, None), (5, [])],
        "g int, x array<double>")
    for accuracy in (20, 200, 10_000):
        one = exact_percentiles(rows, ["g"], F.col("x"), wanted, accuracy)
        many = exact_cell_percentiles(packets, ["g"], F.col("x"), wanted, accuracy)
        for got in (one.collect(), many.collect()):
            assert {r["g"] for r in got} == set(groups)
            for r in got:
                assert [r[k] for k in wanted] == pytest.approx([np.percentile(groups[r["g"]], p * 100) for p in wanted.values()], abs=1e-12)


def test_median_of_all_cells_of_one_recording(spark):
    packets = spark.range(2000).select(F.lit("r").alias("g"), F.transform(
        F.sequence(F.lit(0), F.lit(99)), lambda k: (F.col("id") * 100 + k).cast("double")).alias("x"))
    assert exact_cell_percentiles(packets, ["g"], F.col("x"), {"m": 0.5}, accuracy=1000).first()["m"] == pytest.approx(99999.5)


def test_rates_and_clock(spark):
    df = packets(spark, [0.0, 0.5, 0.5, 1.0, 2.0], [[1.0]] * 5).withColumn("packet_index", F.col("source_order"))
    assert TL.source_rate(df, order_by=["packet_index"]).first()["source_rate_hz"] == pytest.approx(2.0)
    assert TL.span_rate(df, 9.0).first()["rate_hz"] == pytest.approx(2.0)
    back = packets(spark, [0.0, 2.0, 1.0], [[1.0]] * 3).withColumn("packet_index", F.col("source_order"))
    assert TL.span_rate(back, 9.0).first()["rate_hz"] == 9.0
    clocks = spark.createDataFrame(
        [("r", 0, "23:59:59.500"), ("r", 1, "23:59:59.750"), ("r", 2, "00:00:00.250")],
        "recording_id string, packet_index long, clock string")
    assert [r["elapsed_ms"] for r in TL.elapsed_ms(clocks, "clock").orderBy("packet_index").collect()] == [0, 250, 750]
    rates = spark.createDataFrame(
        [("12", "x"), ("fast", "a/FrameRate25/b"), (None, "x")], "c string, p string").select(
        TL.rate_from_config(F.col("c"), F.col("p")).alias("hz")).collect()
    assert [r["hz"] for r in rates] == [12.0, 25.0, 10.0]


def test_index_grids_equal_numpy(spark):
    rng = np.random.default_rng(1)
    for n, m in ((5, 12), (12, 5), (1, 4), (7, 1), (6, 6), (9, 17)):
        x = rng.normal(size=n).astype(np.float32)
        df = spark.createDataFrame([("r", i, [float(v)], str(i)) for i, v in enumerate(x)],
                                   "recording_id string, packet_index long, amplitude array<float>, source_label string")
        lengths = spark.createDataFrame([("r", n, m)], "recording_id string, source_length long, target_length long")
        got = R.resample_index(df, lengths, "linear", ["amplitude"], ["source_label"]).orderBy("packet_index").collect()
        want = np.repeat(x, m) if n == 1 else np.interp(np.linspace(0, 1, m), np.linspace(0, 1, n), x)
        near = [0] if m == 1 else np.rint(np.linspace(0, n - 1, m)).astype(int).tolist()
        assert np.allclose([r["amplitude"][0] for r in got], want, atol=1e-6)
        assert [int(r["source_label"]) for r in got] == near


def test_wrapped_phase_is_recomputed(spark):
    pts = [(math.cos(a), math.sin(a), a) for a in (3.0, -3.0)]
    df = spark.createDataFrame(
        [("r", i, [c], [s], [a]) for i, (c, s, a) in enumerate(pts)],
        "recording_id string, packet_index long, csi_real array<float>, csi_imag array<float>, phase_rad array<float>")
    lengths = spark.createDataFrame([("r", 2, 4)], "recording_id string, source_length long, target_length long")
    out = R.recompute_phase(R.resample_index(df, lengths, "linear", ["csi_real", "csi_imag", "phase_rad"]))
    assert all(abs(r["phase_rad"][0]) > 2.5 for r in out.collect())
