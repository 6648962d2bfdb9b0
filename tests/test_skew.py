"""A hot recording must not travel through one task, and bucket edges must not show."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from packetloom.operators import ordered as O
from packetloom.operators import quantiles as Q
from packetloom.operators import timeline as TL
from packetloom.operators.segments import numbered_runs


@pytest.fixture(scope="module")
def packets(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("recording_id"), F.col("id").alias("packet_index"))
    rest = spark.range(6000).select((F.col("id") % 97).cast("string").alias("recording_id"),
                                    F.floor(F.col("id") / 97).alias("packet_index"))
    df = hot.unionByName(rest).withColumn("x", F.pmod(F.hash("recording_id", "packet_index"), F.lit(7)))
    return df.withColumn("timestamp_s", F.col("packet_index") * 0.37 + F.col("x") * 0.01)


@pytest.mark.parametrize("width", [1, 7, 64, 100_000])
def test_bucketed_equals_plain_windows(packets, width):
    w = Window.partitionBy("recording_id").orderBy("packet_index")
    plain = packets.select(
        "recording_id", "packet_index", F.lead("x").over(w).alias("nxt"), F.lag("x").over(w).alias("prv"),
        F.sum("x").over(w).alias("total"), (F.row_number().over(w) - 1).alias("at"))
    rows = packets.withColumn("_b", O.index_bucket("packet_index", width))
    key = ["recording_id"]
    rows = O.with_neighbour(rows, key, ["packet_index"], "_b", ["x"], "_n")
    rows = O.with_neighbour(rows, key, ["packet_index"], "_b", ["x"], "_p", step=-1)
    rows = O.with_running_total(rows, key, ["packet_index"], "_b", F.col("x"), "total")
    rows = O.with_position(rows, key, ["packet_index"], "_b", "at")
    ours = rows.select("recording_id", "packet_index", F.col("_n.x").alias("nxt"), F.col("_p.x").alias("prv"), "total", "at")
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def window_keys(df):
    """Partition keys of the windows that run on packet rows (not on bucket tables)."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return re.findall(r"Window \[.*?\], \[(.*?)\], \[", plan)


def test_packet_windows_are_bucketed(packets):
    runs = numbered_runs(packets.withColumn("source_label", F.col("x").cast("string")), "source_label",
                         ["recording_id"], "packet_index")
    keys = window_keys(runs)
    assert sum("_bucket" in k for k in keys) >= 1
    # a window over the recording alone sees one row per bucket: an aggregate lies below it
    plan = runs._jdf.queryExecution().optimizedPlan().toString()
    for found in re.finditer(r"Window \[.*?\], \[(.*?)\], \[", plan):
        if "_bucket" not in found[1]:
            assert re.search(r"Aggregate \[recording_id#\d+, _bucket#", plan[found.end():])


def test_median_of_a_hot_group_ranks_few_rows(packets):
    got = {r["recording_id"]: r["m"] for r in Q.exact_percentiles(
        packets, ["recording_id"], F.col("timestamp_s"), {"m": 0.5}, accuracy=50).collect()}
    want = {r["recording_id"]: r["m"] for r in packets.groupBy("recording_id").agg(
        F.median("timestamp_s").alias("m")).collect()}
    assert got == pytest.approx(want)


def test_facts_reach_every_packet(packets):
    facts = packets.groupBy("recording_id").agg(F.count(F.lit(1)).alias("n"))
    for salts in (1, 5, 16):
        rows = O.join_facts(packets, facts, ["recording_id"], F.col("packet_index"), salts)
        assert rows.count() == packets.count() and rows.where("n is null").count() == 0
    assert rows.where("recording_id = 'hot'").select("n").distinct().first()["n"] == 3000


def test_long_ranges_explode_in_chunks(spark):
    df = spark.createDataFrame([(0, 9999), (5, 4), (7, 7)], "a long, b long")
    rows = O.explode_range(df, F.col("a"), F.col("b"), "k", chunk=100)
    assert rows.count() == 10001 and rows.where("a = 0").agg(F.countDistinct("k")).first()[0] == 10000


def test_duplicate_timestamps_of_a_hot_recording(packets):
    same = packets.withColumn("timestamp_s", F.floor(F.col("packet_index") / 10).cast("double")).withColumn(
        "source_order", F.col("packet_index"))
    kept = TL.earliest_per_timestamp(same)
    assert kept.where("recording_id = 'hot'").count() == 300
    assert kept.where("packet_index % 10 <> 0").count() == 0
