"""Quality reports, robust ranges and manifest summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions.arrays import is_finite
from packetloom.operators.quantiles import exact_percentiles
from packetloom.operators.timeline import RECORDING

NUMBERS = ("byte", "short", "integer", "long", "float", "double", "decimal")


def _element_type(df: DataFrame, column: str) -> str:
    kind = df.schema[column].dataType
    return (kind.elementType if kind.typeName() == "array" else kind).typeName()


def quality_report(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = RECORDING,
                   valid: str | None = "valid") -> DataFrame:
    """One row per recording and array: counts, NaNs, and min, max and mean of the finite values.

    Arrays are reduced inside their row, then across rows: nothing is exploded.
    """
    def as_array(c: str) -> Column:
        value = F.col(c)
        if df.schema[c].dataType.typeName() != "array":
            value = F.array(value)
        return F.transform(value, lambda x: x.cast("double"))

    aggs, picks = [F.count(F.lit(1)).alias("packets")], []
    if valid and valid in df.columns:
        aggs.append(F.avg(F.col(valid).cast("int")).alias("valid_fraction"))
    else:
        aggs.append(F.lit(None).cast("double").alias("valid_fraction"))
    thin = df
    for i, c in enumerate(columns):
        numeric = _element_type(df, c) in NUMBERS
        values = as_array(c) if numeric else F.array().cast("array<double>")
        finite = F.filter(values, is_finite)
        size = F.size(F.col(c)) if df.schema[c].dataType.typeName() == "array" else F.lit(1)
        thin = thin.withColumn(f"_p{i}", F.struct(
            size.alias("width"),
            F.size(F.filter(values, lambda x: F.isnan(x))).alias("nans"),
            F.size(finite).alias("n"), F.array_min(finite).alias("low"),
            F.array_max(finite).alias("high"),
            F.aggregate(finite, F.lit(0.0), lambda a, x: a + x).alias("total")))
        p = F.col(f"_p{i}")
        aggs += [F.max(p["width"]).alias(f"_width{i}"), F.sum(p["nans"]).alias(f"_nans{i}"),
                 F.sum(p["n"]).alias(f"_n{i}"), F.min(p["low"]).alias(f"_low{i}"),
                 F.max(p["high"]).alias(f"_high{i}"), F.sum(p["total"]).alias(f"_total{i}")]
        picks.append(F.struct(
            F.lit(c).alias("array"), F.lit(_element_type(df, c)).alias("dtype"),
            F.col("packets").alias("packets"), F.col(f"_width{i}").cast("long").alias("width"),
            F.when(F.lit(numeric), F.col(f"_nans{i}")).alias("nan_count"),
            F.col(f"_low{i}").alias("min"), F.col(f"_high{i}").alias("max"),
            F.when(F.col(f"_n{i}") > 0, F.col(f"_total{i}") / F.col(f"_n{i}")).alias("mean"),
            F.col("valid_fraction").alias("valid_fraction")))
    report = thin.groupBy(*keys).agg(*aggs)
    return report.select(*keys, F.explode(F.array(*picks)).alias("_r")).select(*keys, "_r.*")


def robust_range(df: DataFrame, value: Column, keys: Sequence[str] = (), signed: bool = False
                 ) -> DataFrame:
    """Display limits that ignore spikes.

    Unsigned: 2nd to 98th percentile of the finite values, falling back to min..max and then to
    a width of 1.  Signed: plus and minus the 99th percentile of the size, 1 where that is 0.
    """
    finite = df.select(*keys, value.cast("double").alias("_v")).where(is_finite(F.col("_v")))
    if signed:
        limit = exact_percentiles(finite, keys, F.abs("_v"), {"_p": 0.99})
        size = F.when(F.col("_p") != 0, F.col("_p")).otherwise(F.lit(1.0))
        return limit.select(*keys, (-size).alias("low"), size.alias("high"))
    cuts = exact_percentiles(finite, keys, F.col("_v"),
                             {"_p2": 0.02, "_p98": 0.98, "_min": 0.0, "_max": 1.0})
    wide = F.col("_p98") > F.col("_p2")
    low = F.when(wide, F.col("_p2")).otherwise(F.col("_min"))
    high = F.when(wide, F.col("_p98")).otherwise(F.col("_max"))
    return cuts.select(*keys, low.alias("low"), F.when(high <= low, low + 1.0).otherwise(high
                                                                                         ).alias("high"))


def with_default_range(ranges: DataFrame, groups: DataFrame, keys: Sequence[str],
                       signed: bool = False) -> DataFrame:
    """Groups without one finite value get (0, 1), or (-1, 1) when signed."""
    return (groups.join(ranges, list(keys), "left")
            .withColumn("low", F.coalesce("low", F.lit(-1.0 if signed else 0.0)))
            .withColumn("high", F.coalesce("high", F.lit(1.0))))


def manifest_summary(records: DataFrame, keys: Sequence[str] = ("dataset_id",)) -> DataFrame:
    return records.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("source_count"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("converted", "skipped", "failed")])


def failure_groups(records: DataFrame) -> DataFrame:
    """Error texts of failed records, most frequent first."""
    text = F.when(F.coalesce("error", F.lit("")) == "", F.lit("unknown error")).otherwise(F.col("error"))
    return (records.where(F.col("status") == "failed").groupBy(text.alias("error"))
            .agg(F.count(F.lit(1)).alias("records"))
            .orderBy(F.desc("records"), "error"))


def label_sets(df: DataFrame, columns: dict[str, str], keys: Sequence[str] = RECORDING) -> DataFrame:
    """Sorted distinct values per recording; a set is bounded by the vocabulary of its column."""
    return df.groupBy(*keys).agg(*[
        F.sort_array(F.collect_set(F.trim(F.col(c).cast("string")))).alias(name)
        for name, c in columns.items()])


def assert_uniform(df: DataFrame, column: str, keys: Sequence[str] = RECORDING) -> DataFrame:
    """Recordings whose packets do not all have the same width."""
    size = F.size(column)
    return (df.groupBy(*keys).agg(F.min(size).alias("narrowest"), F.max(size).alias("widest"))
            .withColumn("error", F.when(F.col("narrowest") != F.col("widest"),
                                        F.lit("inconsistent vector lengths"))))
