"""Prepare by data set id: bad sources fail alone, later runs do what changed, readers see whole runs."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.operators import errors as ER
from packetloom.operators import layout as L
from packetloom.operators import signal as S
from packetloom.plans import adapters as AD
from packetloom.plans.prepare import prepare_dataset, published, read_prepared
from packetloom.plans.registry import SOURCE_PATTERNS
from packetloom.plans.releases import RELEASES
from packetloom.sources.discovery import first_characters, folder_sources, list_files, split_members

RNG = np.random.default_rng(4)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def matrix(rows, columns):
    return "\n".join(",".join(f"{v:.4f}" for v in row) for row in RNG.uniform(1, 2, (rows, columns))) + "\n"


def packets(n, carriers=30, links=3):
    return "".join(json.dumps({"t": 100 + 0.1 * i, "csi": [[{"r": 1.0 + k, "i": 0.5} for _ in range(links)] for k in range(carriers)]}) + "\n" for i in range(n))


def cells(n, width=128):
    return "data,class\n" + "".join(f'"{RNG.integers(-9, 9, width).tolist()}",1\n' for _ in range(n))


def status(state):
    return {r.source.rsplit("/", 2)[-2] + "/" + r.source.rsplit("/", 1)[-1]: (r.status, r.error) for r in state.collect()}


def test_the_registry_is_complete():
    assert set(RELEASES) == set(SOURCE_PATTERNS) == set(AD.ADAPTERS)


def test_literal_cells_over_several_runs(spark, folder):
    root, out = folder / "in", str(folder / "out")
    put(root / "NLOS/BQ/w1.csv", cells(2))
    put(root / "NLOS/BQ/w2 b.csv", cells(5))
    put(root / "NLOS/BQ/w3.csv", cells(3))
    put(root / "NLOS/notes.csv", "nothing of that kind\n1\n")          # the sniff leaves it out
    first = prepare_dataset(spark, "wallhack18k", str(root), out, setting="random")
    assert status(first.state) == {f"BQ/{n}.csv": ("converted", None) for n in ("w1", "w2 b", "w3")}
    assert first.table("packets").count() == 10 and first.table("windows").where("valid").count() == 10
    assert first.table("split").count() == 3 and first.table("policy").first()["selected_window_length"] == 2

    again = prepare_dataset(spark, "wallhack18k", str(root), out, setting="random")
    assert {s for s, _ in status(again.state).values()} == {"skipped"}
    assert spark.read.parquet(f"{out}/packets").select("run_id").distinct().count() == 1
    assert again.table("windows").where("valid").count() == 10 and again.table("split").count() == 3

    # one changed, one bad now: what was published before stays readable until the new run is
    put(root / "NLOS/BQ/w3.csv", cells(4))
    put(root / "NLOS/BQ/w1.csv", "data,class\n\"[1, oops]\",1\n")
    with pytest.raises(RuntimeError, match="1 conversion"):
        prepare_dataset(spark, "wallhack18k", str(root), out, setting="random")
    now = status(read_prepared(spark, out, "state"))
    assert now["BQ/w1.csv"] == ("failed", "not a list of numbers") and now["BQ/w3.csv"] == ("converted", None)
    assert read_prepared(spark, out, "packets").count() == 9 and read_prepared(spark, out, "windows").where("valid").count() == 9

    run = published(spark, out)
    (folder / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        prepare_dataset(spark, "wallhack18k", str(folder / "none"), out)
    assert published(spark, out) == run and read_prepared(spark, out, "packets").count() == 9


def test_a_split_that_cannot_be_made_keeps_the_conversion(spark, folder):
    put(folder / "in/x/a.csv", cells(2))
    with pytest.raises(ValueError, match="converted and published"):
        prepare_dataset(spark, "wallhack18k", str(folder / "in"), str(folder / "out"), setting="random", ratios=[0.9, 0.9, 0.1])
    assert read_prepared(spark, str(folder / "out"), "packets").count() == 2


@pytest.mark.parametrize("dataset_id,files,failed,packets_left", [
    ("wifi-presence-movement", {"mobile/a.json": packets(3), "mobile/ragged_csi.json": packets(2) + packets(1, 29), "mobile/empty_csi.json": "", "still/csi.json": packets(2)},
     {"mobile/ragged_csi.json": "inconsistent packet shapes", "mobile/empty_csi.json": "source has no rows"}, 2),
    ("wipe-fall", {"high_unseen/a.csv": matrix(51, 60), "low/b.csv": matrix(51, 60), "low/odd.csv": matrix(9, 60)}, {"low/odd.csv": "expected the documented 51"}, 120),
    ("nist-breathesmart", {f"s/{n}_csi_{k}_log.csv": "".join(
        ",".join(str(1 + (c % 7)) if (c % 114 < 56 and c // 114 not in (2, 5, 8)) else "0" for c in range(width)) + "\n" for _ in range(3))
        for n, k, width in (("a", "real", 1026), ("a", "imag", 1026), ("b", "real", 1026), ("b", "imag", 1025), ("c", "real", 1026), ("c", "imag", 1026))},
     {"s/b_csi_real_log.csv": "companion shapes differ"}, 6),
    ("figshare-csi-har", {"r1/data.csv": matrix(3, 114 * 9), "r1/label.csv": "0,walk\n1,sit\n2,sit\n", "r2/data.csv": matrix(3, 114 * 9), "r2/label.csv": "0,walk\n", "r3/data.csv": matrix(2, 20)},
     {"r2/data.csv": "fewer labels", "r3/data.csv": "unsupported width"}, 3)])
def test_bad_sources_of_text_releases_fail_alone(spark, folder, dataset_id, files, failed, packets_left):
    for name, text in files.items():
        put(folder / "in" / name, text)
    run = prepare_dataset(spark, dataset_id, str(folder / "in"), str(folder / "out"), setting="random" if dataset_id == "wallhack18k" else None, check=False)
    got = status(run.state)
    assert {k: True for k, (s, _) in got.items() if s == "failed"} == {k: True for k in failed}
    assert all(text in got[k][1] for k, text in failed.items())
    good = read_prepared(spark, str(folder / "out"), "packets")
    if dataset_id == "wifi-presence-movement":
        assert "mobile/a.json" not in got        # the patterns of this release want csi in the name
    assert good.count() == packets_left and good.select("recording_id").distinct().count() == len(got) - len(failed)


def test_decoded_arrays_by_id(spark, folder):
    rows = [(f"{p}_data_split_amp.mat", f"r{p}", 0, RNG.uniform(1, 2, n).tolist(), 1, 1) for p, n in (("train", 52 * 192), ("test", 52 * 192), ("odd_train", 7))]
    spark.createDataFrame(rows, "path string, recording_id string, sample_index int, data array<double>, activity int, location int").write.parquet(str(folder / "in/decoded/arrays"))
    run = prepare_dataset(spark, "aril", str(folder / "in"), str(folder / "out"), setting="random", check=False)
    got = {r.source: (r.status, r.error) for r in run.state.collect()}
    assert got["odd_train_data_split_amp.mat"] == ("failed", "expected samples of 52 x 192, got 7 values")
    assert got["train_data_split_amp.mat"][0] == "converted" and run.table("packets").count() == 2 * 192
    assert run.table("segments").count() == 0 and run.table("view_recordings").count() == 2


def test_figshare_keeps_the_place_of_empty_rows_and_columns(spark, folder):
    values = np.arange(5 * 169, dtype=float).reshape(5, 169)
    lines = [",".join("" if c == 3 or r == 2 else str(v) for c, v in enumerate(row)) for r, row in enumerate(values)]
    put(folder / "data.csv", "\n".join(lines) + "\n")
    put(folder / "label.csv", "".join(f"{i},r{i}\n" for i in range(5)))
    out = AD.figshare_csi_har(spark, str(folder / "data.csv"), str(folder / "label.csv")).orderBy("packet_index").collect()
    assert [r.source_label for r in out] == ["r0", "r1", "r2", "r3", "r4"] and all(r.error is None for r in out)
    assert [r.amplitude[0] for r in out][:2] == [56.0, 169 + 56.0] and np.isnan(out[2].amplitude).all()


def test_operators_write_into_an_open_channel(spark):
    rows = spark.createDataFrame([("a", 0, [1.0, 2.0]), ("a", 1, [1.0]), ("b", 0, [3.0, 4.0])], "recording_id string, row_index int, v array<double>")
    with pytest.raises(Exception, match="even number"):
        S.deinterleave_iq(rows, "v").collect()
    open_ = ER.open_channel(rows)
    got = {(r.recording_id, r.row_index): (r.error, r.csi_real) for r in S.deinterleave_iq(open_, "v").collect()}
    assert got[("a", 1)][0].startswith("an interleaved") and got[("a", 1)][1] is None and got[("b", 0)] == (None, [4.0])
    wide = L.permute_axes(open_, "v", ["x", "y"], ["y", "x"], {"x": 1, "y": 2})
    assert {(r.recording_id, r.row_index): r.error for r in wide.collect()}[("a", 1)] == "expected 1x2 values, got 1"
    frames = L.unfold_frames(open_.withColumnRenamed("row_index", "frame_index"), "v", 2)
    assert [(r.recording_id, r.packet_index is None, r.error) for r in frames.collect()].count(("a", True, "unexpected frame size 1")) == 1
    aside = ER.set_aside(wide, lambda good: good.groupBy("recording_id").agg(F.count(F.lit(1)).alias("n"))).collect()
    assert {(r.recording_id, r.n, r.error) for r in aside} == {("b", 1, None), ("a", None, "expected 1x2 values, got 1")}


def test_folders_and_heads(spark, folder):
    for name in ("S1/wifi-csi/f1.mat", "S1/wifi-csi/deep/wifi-csi/f2.mat", "S2/other/x.mat", "wifi-csi/f.mat"):
        put(folder / name, "x" * 10)
    found = {r.relative_path: (r.files, r.length) for r in folder_sources(list_files(spark, str(folder)), SOURCE_PATTERNS["mm-fi"]).collect()}
    assert found == {"S1/wifi-csi": (2, 20), "wifi-csi": (1, 10)}
    put(folder / "t/a.txt", "first\nsecond line\n" + "z" * 9000)
    heads = {r.path.rsplit("/", 1)[1]: r.head for r in first_characters(spark, str(folder / "t"), 20).collect()}
    assert heads == {"a.txt": "first\nsecond line\nzz"}


def test_split_lists_of_any_depth(spark):
    deep = json.dumps("x")
    for i in range(40):
        deep = f'["b{i}", {deep}]' if i % 2 else f'[{deep}, "a{i}"]'
    rows = [("train.json", deep), ("test.json", '["plain", "[odd", 3]'), ("val.json", '{"val": [["v1", {"ids": ["v2", ["v3"]]}], "v4"]}')]
    got = split_members(spark.createDataFrame(rows, "path string, text string")).collect()
    lists = {}
    for r in sorted(got, key=lambda r: r.position):
        lists.setdefault(r.path, []).append(r.member)
    assert lists["train.json"] == [f"b{i}" for i in range(39, 0, -2)] + ["x"] + [f"a{i}" for i in range(0, 40, 2)]
    assert lists["test.json"] == ["plain", "[odd", "3"] and lists["val.json"] == ["v1", "v2", "v3", "v4"]
