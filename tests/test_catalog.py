import pytest
from pyspark.sql import functions as F

from packetloom.operators import catalog as C
from packetloom.operators import joins as J

ENTRY = ("id string, name string, year int, summary string, tasks array<string>, modalities array<string>, "
         "hardware struct<platform:string>, settings struct<environments:int,subjects:int,scenario:string>, scale string, "
         "original struct<landing_page:string,access:string,license:string,redistribution:string,formats:array<string>>, "
         "standardization struct<status:string,profile:string,notes:string>, sources array<struct<type:string,url:string>>, "
         "verified_at string, file string")


def entry(i, **changes):
    row = {"id": f"set-{i}", "name": f"Set {i}", "year": 2020, "summary": "A recorded data set for tests.", "tasks": ["har"],
           "modalities": ["csi"], "hardware": ("card",), "settings": (1, None, "room"), "scale": "x",
           "original": ("https://x.org/a", "direct", "CC", "allowed", ["csv"]), "standardization": ("planned", "p", "n"),
           "sources": [("paper", "https://x.org")], "verified_at": "2026-01-01", "file": f"{i}.json"}
    row.update(changes)
    return tuple(row.values())


@pytest.fixture(scope="module")
def tasks(spark):
    return spark.createDataFrame([("har",), ("fall",)], "id string")


def test_good_catalog_has_no_violations(spark, tasks):
    df = spark.createDataFrame([entry(i) for i in range(10)], ENTRY)
    assert C.validate_catalog(df, tasks).count() == 0
    assert C.check_constraints(df, "id", C.CATALOG_CONSTRAINTS).count() == 0


def test_violations_are_named(spark, tasks):
    df = spark.createDataFrame([
        entry(0), entry(0, file="b.json"), entry(1, tasks=["har", "dance"]), entry(2, sources=[]),
        entry(3, sources=[("paper", "ftp://x")]), entry(4, year=None), entry(5, original=("nowhere", "free", "CC", "allowed", [])),
        entry(6, year=1999, id="Bad ID", tasks=["har", "har"], verified_at="yesterday", summary="short")], ENTRY)
    got = {(r["file"], r["violation"]) for r in C.validate_catalog(df, tasks).collect()}
    assert got == {("b.json", "duplicate id set-0"), ("1.json", "unknown task dance"),
                   ("2.json", "at least one source is required"), ("3.json", "invalid source URL"),
                   ("4.json", "missing field year"), ("5.json", "invalid landing page")}
    broken = {r["violation"] for r in C.check_constraints(df, "file", C.CATALOG_CONSTRAINTS).where("id = '6.json'").collect()}
    assert broken == {"id: pattern", "year: minimum", "tasks: unique_items", "verified_at: date", "summary: min_length"}
    assert C.check_constraints(df, "file", C.CATALOG_CONSTRAINTS).where("violation = 'original.access: enum'").count() == 1
    with pytest.raises(ValueError, match="unknown constraint"):
        C.check_constraints(df, "file", {"id": {"shiny": True}})


def test_search(spark):
    df = spark.createDataFrame([entry(0), entry(1, tasks=["fall"]), entry(2, name="Kitchen")], ENTRY).withColumn(
        "access", F.col("original.access"))
    ids = lambda d: sorted(r["id"] for r in d.collect())
    assert ids(C.search_catalog(df, task="fall")) == ["set-1"]
    assert ids(C.search_catalog(df, query=" kitCHEN ")) == ["set-2"]
    assert ids(C.search_catalog(df, access="account")) == []
    assert len(ids(C.search_catalog(df))) == 3


def test_rejects_do_not_stop_others(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "")], "n int, t string")
    good, bad = C.with_rejects(df, {"no number": F.col("n").isNotNull(), "no text": F.col("t") != ""})
    assert good.count() == 1 and {r["error"] for r in bad.collect()} == {"no number", "no text"}
    with pytest.raises(RuntimeError, match="2 conversion"):
        C.require_success(C.conversion_records(bad))
    with pytest.raises(FileNotFoundError):
        C.require_success(C.conversion_records(bad).limit(0))


def test_pending_sources(spark):
    src = spark.createDataFrame([("a", "o", 5), ("b", "o", 5), ("c", "p", 5), ("d", "o", 5)],
                                "source string, view_options string, modified long")
    man = spark.createDataFrame([("a", "o", 5, True), ("b", "o", 4, True), ("c", "o", 9, True), ("d", "o", 9, False)],
                                "source string, view_options string, output_modified long, full_source_preserved boolean")
    assert sorted(r["source"] for r in J.pending_sources(src, man).collect()) == ["b", "c", "d"]
    assert J.pending_sources(src, man, force=True).count() == 4
