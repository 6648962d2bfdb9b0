import json

import pytest
from pyspark.sql import functions as F

from packetloom.sources import discovery as DI
from packetloom.sources import tables as TB
from packetloom.sources import text as TX


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_wide_csv_kinds(spark, folder):
    amp = TX.read_wide_csv(spark, write(folder / "a.csv", "timestamp_s,amplitude_l1_s0\n0.5,3\n")).first()
    assert (amp["source_representation"], amp["csi_real"], amp["csi_imag"]) == ("amplitude_only", [0.0, 3.0], [0.0, 0.0])
    mixed = TX.read_wide_csv(spark, write(folder / "b.csv", "timestamp_s,real_l0_s0,imag_l0_s1,amplitude_l0_s0\n0,1,2,9\n")).first()
    assert (mixed["csi_real"], mixed["csi_imag"]) == ([1.0, 0.0], [0.0, 2.0])
    with pytest.raises(ValueError, match="timestamp_s"):
        TX.read_wide_csv(spark, write(folder / "c.csv", "t,real_l0_s0\n0,1\n"))
    with pytest.raises(ValueError, match="pairs or amplitude"):
        TX.read_wide_csv(spark, write(folder / "d.csv", "timestamp_s,real_l0_s0\n0,1\n"))


def test_numeric_matrix(spark, folder):
    path = write(folder / "m.csv", "a,b,c\n1,,2\n,,\n3,,4\n5,,x\n")
    rows = TX.read_numeric_csv(spark, path).orderBy("row_index").collect()
    assert [r["row_index"] for r in rows] == [0, 1, 2]
    assert [r["values"] for r in rows] == [[1.0, 2.0], [3.0, 4.0], [5.0, None]]
    assert [r["error"] is not None for r in rows] == [False, False, True]
    wide = write(folder / "w.csv", ",".join(str(i) for i in range(30_000)) + "\n")
    assert len(TX.read_numeric_csv(spark, wide).first()["values"]) == 30_000


def test_row_order_survives_file_splits(spark, folder):
    path = write(folder / "big.csv", "".join(f"{i},{i * 2}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        rows = TX.read_numeric_csv(spark, path)
        assert rows.where(F.get("values", F.lit(0)) != F.col("row_index")).count() == 0 and rows.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_are_numbered_where_they_are(spark, folder):
    for name, first in (("a", 0), ("b", 50_000)):
        write(folder / "in" / f"{name}.csv", "".join(f"{first + i},\n" + ("no,number\n" if i % 3 == 0 else "") for i in range(6_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        for keep_empty in (False, True):
            rows = TX.read_numeric_csv(spark, str(folder / "in"), strict=False, keep_empty=keep_empty)
            assert "Window" not in rows._jdf.queryExecution().executedPlan().toString()
            found = rows.groupBy("recording_id").agg(F.count("*").alias("n"), F.count_distinct("row_index").alias("d"), F.max("row_index").alias("m")).collect()
            assert [(r.n, r.d, r.m + 1) for r in found] == [(8_000 if keep_empty else 6_000,) * 3] * 2
            if not keep_empty:
                assert rows.where(F.get("values", F.lit(0)) % 50_000 != F.col("row_index")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ragged_and_incomplete_json(spark, folder):
    good = {"t": 1.0, "csi": [[{"r": 1, "i": 2}, {"r": 3, "i": 4}], [{"r": 5, "i": 6}, {"r": 7, "i": 8}]]}
    ragged = {"t": 2.0, "csi": [[{"r": 1, "i": 2}], [{"r": 5, "i": 6}, {"r": 7, "i": 8}]]}
    write(folder / "original" / "p.json", "\n".join([json.dumps(good), json.dumps(ragged), json.dumps({"t": 3.0}), '{"t": 4.0, "cs']))
    rows = TX.read_packet_jsonl(spark, str(folder / "original")).orderBy("timestamp_s").collect()
    ok = [r for r in rows if r["packet_error"] is None]
    assert len(ok) == 1 and ok[0]["csi_real"] == [1.0, 5.0, 3.0, 7.0] and ok[0]["source_label"] is None
    assert sum(r["packet_error"] == "inconsistent packet shape" for r in rows) == 1


def test_literal_cells(spark, folder):
    path = write(folder / "c.csv", 'data,class\n"[1, 2, 3, 4]",0\n"[5, 6, 7, 8]",\n')
    rows = TX.read_array_cell_csv(spark, path).orderBy("packet_index").collect()
    assert [r["values"] for r in rows] == [[1.0, 2.0, 3.0, 4.0], [5.0, 6.0, 7.0, 8.0]]
    assert [r["source_label"] for r in rows] == ["0", None]
    with pytest.raises(ValueError, match="data column"):
        TX.read_array_cell_csv(spark, write(folder / "n.csv", "x\n1\n"))


def test_aliases():
    assert TB.choose_alias(["amp", "csi"], TB.DATA_KEYS) == "csi"
    assert TB.choose_alias(["USER_ID"], TB.METADATA_KEYS["subject"]) is None
    assert TB.choose_alias(["USER_ID"], TB.METADATA_KEYS["subject"], ignore_case=True) == "USER_ID"


def test_discovery_and_overrides(spark, folder):
    for name in ("b/x.csv", "a.csv", "c.txt"):
        write(folder / "src" / name, "data,1\n" if name != "a.csv" else "none\n")
    files = DI.list_files(spark, str(folder / "src"), content=True)
    names = lambda d: [r["relative_path"] for r in d.orderBy("relative_path").collect()]
    assert names(DI.discover_sources(files, ["**/*.csv", "*.csv"])) == ["a.csv", "b/x.csv"]
    assert names(DI.discover_sources(files, ["**/*.csv"], sniff="data")) == ["b/x.csv"]
    assert names(DI.discover_sources(files, ["**/*.csv"], limit=1)) == ["a.csv"]
    path = write(folder / "metadata.jsonl", '{"source_file": "a\\\\b.csv", "subject": 3, "day": ""}\n{"sample_id": "s", "source_file": "q", "trial": null}\n{"day": "1"}\n')
    rows = {r["key"]: r["metadata"] for r in DI.read_overrides(spark, jsonl_path=path).collect()}
    assert rows == {"a/b.csv": {"source_file": "a\\b.csv", "subject": "3"}, "s": {"sample_id": "s", "source_file": "q"}}


def test_sniffing_drops_bytes_that_are_no_text(spark):
    size = 4 * DI.SNIFF_LENGTH
    texts = {
        "cut.csv": b"data" + b"x" * (size - 5) + "é".encode() + b"y" * 20,          # a character across the first bytes
        "odd.csv": b"\xff\xfe\x80da" + b"\xc3" + b"ta" + b"\xf0\x9f",
        "far.csv": b"\xff" * (size + 10) + b"data",                                # odd bytes do not count
        "late.csv": "é".encode() * DI.SNIFF_LENGTH + b"data",
        "sign.csv": "\ufffd".encode() * (DI.SNIFF_LENGTH - 3) + b"data",            # a real sign does
        "last.csv": "\U0001f600".encode() * (DI.SNIFF_LENGTH - 4) + b"data", "none.csv": None, "empty.csv": b""}
    rows = [(n, None if t is None else bytearray(t)) for n, t in texts.items()]
    files = spark.createDataFrame(rows, "relative_path string, content binary")
    want = sorted(n for n, t in texts.items() if t and "data" in t.decode("utf-8", "ignore")[:DI.SNIFF_LENGTH])
    assert want == ["cut.csv", "far.csv", "last.csv", "odd.csv"]
    assert sorted(r["relative_path"] for r in DI.discover_sources(files, ["*.csv"], sniff="data").collect()) == want
    heads = {r["relative_path"]: r["head"] for r in files.select("relative_path", DI.leading_text(F.col("content")).alias("head")).collect()}
    assert heads == {n: None if t is None else t.decode("utf-8", "ignore")[:DI.SNIFF_LENGTH] for n, t in texts.items()}


def test_external_lists(spark, folder):
    write(folder / "a_id.json", json.dumps({"training": ["x", ["y"]], "valid": {"ids": ["v"]}, "test": {"nothing": 1}}))
    write(folder / "cross_test.json", json.dumps(["p", "q"]))
    write(folder / "plain.json", json.dumps(["lost"]))
    rows = DI.read_external_split(spark, str(folder)).collect()
    got = sorted((r["partition"], r["member"]) for r in rows if r["partition"] != "test") + sorted(
        r["member"] for r in rows if r["path"].endswith("cross_test.json"))
    assert got == [("train", "x"), ("train", "y"), ("val", "v"), "p", "q"]
    assert not any(r["member"] == "lost" for r in rows)


def test_audit(spark, folder):
    write(folder / "f" / "a.bin", "hello")
    files = DI.list_files(spark, str(folder / "f"), content=True).withColumn("name", F.col("relative_path"))
    md5 = "5d41402abc4b2a76b9719d911017c592"
    want = spark.createDataFrame([("a.bin", 5, f"md5:{md5}"), ("b.bin", 1, None)], "name string, bytes long, checksum string")
    got = {r["name"]: r["error"] for r in DI.audit_sources(files, want).collect()}
    assert got == {"a.bin": None, "b.bin": "missing file"}
    wrong = want.withColumn("checksum", F.lit("md5:0"))
    assert DI.audit_sources(files, wrong).where("name = 'a.bin'").first()["error"] == "checksum mismatch"


def test_overwriting_one_data_set_leaves_the_others(spark, folder):
    from packetloom.sources.tables import write_table
    path = str(folder / "sink")
    for name in ("one", "two"):
        write_table(spark.createDataFrame([(name, 1)], "dataset_id string, n int"), path, mode="overwrite")
    write_table(spark.createDataFrame([("two", 2)], "dataset_id string, n int"), path, mode="overwrite")
    assert sorted((r.dataset_id, r.n) for r in spark.read.parquet(path).collect()) == [("one", 1), ("two", 2)]


def test_odd_items_of_a_split_list_cost_themselves_only(spark):
    from packetloom.sources.discovery import split_members
    texts = ['{"train":["a","b",{"note":"x"}]}', '{"train":["a","[run1]/b.mat","c"]}', '{"train":[[[[["deep5"]]]]]}']
    rows = spark.createDataFrame([(f"s{i}.json", t) for i, t in enumerate(texts)], "path string, text string")
    found = {}
    for r in split_members(rows).orderBy("path", "position").collect():
        found.setdefault(r.path, []).append(r.member)
    assert found == {"s0.json": ["a", "b"], "s1.json": ["a", "[run1]/b.mat", "c"], "s2.json": ["deep5"]}


def test_every_csv_file_is_read_by_its_own_header(spark, folder):
    write(folder / "a.csv", "timestamp_s,real_l0_s0,imag_l0_s0\n0.5,1,2\n")
    write(folder / "b.csv", '\ufeffimag_l0_s0,note,real_l0_s0,timestamp_s\n4,"x, ""y""",3,1.5\n,z,7,2.5\n')
    write(folder / "c.csv", "timestamp_s,amplitude_l1_s0\n3.5,9\n")
    write(folder / "d.csv", "timestamp_s,real_l0_s0,imag_l0_s0\n")
    write(folder / "e.csv", "")
    rows = TX.read_wide_csv(spark, str(folder))
    got = [(r.timestamp_s, r.csi_real, r.csi_imag, r.source_representation) for r in rows.orderBy("timestamp_s").collect()]
    assert got == [(0.5, [1.0], [2.0], "complex_csi"), (1.5, [3.0], [4.0], "complex_csi"), (2.5, [7.0], [0.0], "complex_csi"),
                   (3.5, [0.0, 9.0], [0.0, 0.0], "amplitude_only")]
    lost = TX.without_rows(spark, str(folder), rows).collect()
    assert sorted(r.recording_id[-5:] for r in lost) == ["d.csv", "e.csv"] and {r.error for r in lost} == {"source has no rows"}


def test_bad_wide_cells_and_headers_are_named(spark, folder):
    write(folder / "a.csv", "timestamp_s,real_l0_s0,imag_l0_s0\n0.5,1,2\n1.5,x,2\n")
    write(folder / "b.csv", "t,real_l0_s0\n0,1\n")
    rows = TX.read_wide_csv(spark, str(folder), strict=False).orderBy("recording_id", "timestamp_s").collect()
    assert [r.packet_error for r in rows] == [None, "a cell is not a number", "CSV must contain a timestamp_s column"]
    assert [r.csi_real for r in rows] == [[1.0], None, None]
    with pytest.raises(Exception, match="not a number"):
        TX.read_wide_csv(spark, str(folder / "a.csv")).collect()


def test_cell_files_with_other_headers_and_bad_lists(spark, folder):
    write(folder / "a.csv", 'data,class\n"[1, 2]",0\nnone,1\n')
    write(folder / "b.csv", 'class,n,data\n5,x,"[3, 4]"\n')
    rows = TX.read_array_cell_csv(spark, str(folder)).orderBy("recording_id", "packet_index").collect()
    assert [(r["values"], r.source_label, r.error) for r in rows] == [
        ([1.0, 2.0], "0", None), (None, "1", "not a list of numbers"), ([3.0, 4.0], "5", None)]


def test_unverified_and_repeated_facts(spark, folder):
    files = spark.createDataFrame([("a.bin", 5, None)], "name string, length long, content binary")
    want = spark.createDataFrame([("a.bin", 5, "md5:0")], "name string, bytes long, checksum string")
    assert DI.audit_sources(files, want).first()["error"] == "checksum not verified"
    path = write(folder / "m.csv", "sample_id,day\ns,1\ns,2\n")
    assert DI.read_overrides(spark, path).first()["metadata"]["day"] == "2"
