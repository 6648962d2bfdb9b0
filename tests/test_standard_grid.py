import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.operators import quantiles as Q
from packetloom.operators import resample as R
from packetloom.operators import timeline as TL
from packetloom.plans.jobs import standardize_packets
from test_timeline import SCHEMA, packets


def test_grid_points_are_not_moved(spark):
    """Facts of recordings meet the packets, not the grid points made from them."""
    df = packets(spark, [0.0, 1.0, 900.0], [[1.0, 2.0]] * 3)
    out = standardize_packets(df, 10.0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Generate explode(sequence(_chunk") < plan.index("Join")
    rows = out.orderBy("packet_index").collect()
    assert [r["packet_index"] for r in rows] == list(range(9001))
    assert rows[5]["valid"] and rows[5]["reference_power"] == 2.5


def test_percentiles_of_small_and_large_groups(spark, monkeypatch):
    monkeypatch.setattr(Q, "SMALL_GROUP", 100)
    rng = np.random.default_rng(5)
    groups = {n: np.round(rng.normal(size=n), 2) for n in (1, 2, 3, 99, 100, 101, 700)}
    wanted = {"a": 0.0, "b": 0.02, "c": 0.5, "d": 1.0}
    nothing = [(3, None), (3, float("nan")), (8, None), (None, 1.0)]
    rows = spark.createDataFrame([(n, float(v)) for n, x in groups.items() for v in x] + nothing, "g int, x double")
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("_size"))
    cells = spark.createDataFrame([(n, [*map(float, x[i: i + 7]), None]) for n, x in groups.items() for i in range(0, n, 7)] + [(8, [None]), (None, [1.0])],
                                  "g int, x array<double>")
    for got in (Q.exact_percentiles(rows, ["g"], F.col("x"), wanted, 50, sizes=sizes),
                Q.exact_cell_percentiles(cells, ["g"], F.col("x"), wanted, 50, sizes=sizes)):
        found = {r["g"]: r for r in got.collect()}
        assert set(found) == set(groups)
        for n, r in found.items():
            assert [r[k] for k in wanted] == pytest.approx([np.percentile(groups[n], p * 100) for p in wanted.values()], abs=1e-12)


@pytest.mark.parametrize("duration", [None, 4.0])
def test_cells_of_spans_are_those_of_the_grid(spark, duration):
    rng = np.random.default_rng(7)
    rows = []
    for name, n in (("a", 40), ("b", 3)):
        for i, t in enumerate(np.sort(rng.uniform(5, 11, n))):
            wide = [None if v > 1.5 else float(v) for v in rng.normal(size=2 + i % 3)]
            rows.append((name, i, float(t), wide, [float(v) for v in rng.normal(size=3)]))
    rows.append(("b", 3, 200.0, None, [1.0]))
    df = spark.createDataFrame(rows, SCHEMA)
    spans = R.grid_spans(TL.prepare_time(df), bucket_s=0.7)
    gaps = R.span_gaps(spans)
    grid = R.valid_grid(spans, gaps, 7.0, duration).where("valid").select("recording_id", F.explode("amplitude").alias("x"))
    made = R.valid_cells(spans, gaps, 7.0, duration).select("recording_id", F.col("amplitude").alias("x"))
    want, got = (sorted(tuple(r) for r in x.where("x is not null").collect()) for x in (grid, made))
    assert got == want and len(got) > 40
