"""Resampling onto uniform grids, by timestamp or by index.

Every source packet emits the grid points that lie between it and its successor, so a
recording is never collected and no as-of join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions.arrays import amplitude, as_floats, phase
from packetloom.operators.ordered import (
    SECONDS_PER_BUCKET, explode_range, index_bucket, join_facts, time_bucket, with_neighbour)
from packetloom.operators.quantiles import exact_median
from packetloom.operators.timeline import RECORDING, packet_gaps
from packetloom.session import cut_lineage

INTERPOLATIONS = ("none", "nearest", "linear")


def _between(a: Column, b: Column, weight: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: (
        x.cast("double") + (y.cast("double") - x.cast("double")) * weight).cast("float"))


def _slopes(y0: Column, y1: Column, run: Column) -> Column:
    """Change per second of every channel, 0 behind the last packet (``run`` is NULL)."""
    return F.when(run.isNull(), F.transform(y0, lambda a: F.lit(0.0))).otherwise(
        F.zip_with(y0, y1, lambda a, b: (b.cast("double") - a.cast("double")) / run))


def _on_line(y0: Column, slope: Column, x: Column) -> Column:
    """Slope form, evaluated in double and cast last."""
    return F.zip_with(y0, slope, lambda a, m: (m * x + a.cast("double")).cast("float"))


def grid_length(duration: Column, rate_hz: float) -> Column:
    return F.greatest(F.lit(1), F.rint(duration * F.lit(float(rate_hz)))).cast("long")


def grid_spans(df: DataFrame, keys: Sequence[str] = RECORDING, time: str = "timestamp_s",
               signals: Sequence[str] = ("csi_real", "csi_imag"),
               bucket_s: float = SECONDS_PER_BUCKET) -> DataFrame:
    """Every packet with the time of its successor (``after_s``) and the slopes of its signals up to there:
    all that the grid points between them need.

    Input is what ``prepare_time`` returns.
    """
    keys = list(keys)
    rows = df.select(*keys, time, *signals).withColumn("_bucket", time_bucket(time, bucket_s))
    rows = with_neighbour(rows, keys, [time], "_bucket", [time, *signals], "_next")
    after = F.col(f"_next.{time}")
    rows = rows.withColumn("after_s", after).withColumn("_run", after - F.col(time))
    return rows.select(*keys, time, "after_s", *signals, *[
        _slopes(F.col(s), F.col(f"_next.{s}"), F.col("_run")).alias(f"slope_{s}") for s in signals])


def span_duration(rate_hz: float, duration_s: float | None = None, last: str = "timestamp_s") -> Column:
    """Seconds on the grid of a recording whose last packet is at ``last``."""
    return F.lit(float(duration_s)) if duration_s is not None else F.col(last) + F.lit(1.0) / F.lit(float(rate_hz))


def _grid_range(rate_hz: float, duration_s: float | None, time: str) -> tuple[Column, Column]:
    """First and last grid point that a span may have, a little wider than it is."""
    if rate_hz <= 0:
        raise ValueError("rate_hz must be positive")
    if duration_s is not None and duration_s <= 0:
        raise ValueError("duration_s must be positive")
    rate, after = F.lit(float(rate_hz)), F.col("after_s")
    # Only the last packet of a recording has no successor; it alone needs the grid length,
    # so no per-recording fact has to be joined to every packet.
    final = grid_length(span_duration(rate_hz, duration_s, time), rate_hz) - 1
    last = F.coalesce(F.ceil(after * rate) + 1, final)
    first = F.greatest(F.floor(F.col(time) * rate) - 1, F.lit(0).cast("long"))
    return first, last if duration_s is None else F.least(last, final)


def _inside_span(at: Column, time: str) -> Column:
    return (at >= F.col(time)) & (F.col("after_s").isNull() | (at < F.col("after_s")))


def on_grid(spans: DataFrame, rate_hz: float, duration_s: float | None = None,
            keys: Sequence[str] = RECORDING, time: str = "timestamp_s",
            signals: Sequence[str] = ("csi_real", "csi_imag"), keep: Sequence[str] = ()) -> DataFrame:
    """Grid points of ``grid_spans``, each from its own span, so that no grid point is moved.

    ``keep`` names columns of the spans that their grid points get.
    """
    first, last = _grid_range(rate_hz, duration_s, time)
    grid = explode_range(spans, first, last, "_k").withColumn("_at", F.col("_k") / F.lit(float(rate_hz)))
    # a column of its own: below, the name of the time column already means the grid point
    grid = grid.where(_inside_span(F.col("_at"), time)).withColumn("_x", F.col("_at") - F.col(time))
    values = [_on_line(F.col(s), F.col(f"slope_{s}"), F.col("_x")).alias(s) for s in signals]
    return grid.select(*keys, F.col("_k").alias("packet_index"), F.col("_at").alias(time),
                       F.col(time).alias("before_s"), "after_s", *values, *keep)


def valid_cells(spans: DataFrame, gaps: DataFrame, rate_hz: float, duration_s: float | None = None,
                keys: Sequence[str] = RECORDING, time: str = "timestamp_s") -> DataFrame:
    """The cells of ``amplitude`` at the valid points of ``valid_grid``, one row each.

    Plain columns instead of arrays: what only counts or ranks cells is several times faster on them.
    """
    keys = list(keys)
    first, last = _grid_range(rate_hz, duration_s, time)
    rows = join_facts(spans, gaps.select(*keys, "median_gap_s"), keys, F.hash(time))
    channels = F.arrays_zip(F.col("csi_real").alias("_re"), F.col("slope_csi_real").alias("_to_re"),
                            F.col("csi_imag").alias("_im"), F.col("slope_csi_imag").alias("_to_im"))
    rows = rows.select(*keys, time, "after_s", _tolerance(rate_hz).alias("_reach"), first.alias("_first"),
                       last.alias("_end"), F.explode(channels).alias("_c")).select("*", "_c.*").drop("_c")
    rows = explode_range(rows, F.col("_first"), F.col("_end"), "_k").withColumn("_at", F.col("_k") / F.lit(float(rate_hz)))
    at, before, after = F.col("_at"), F.col(time), F.col("after_s")
    rows = rows.where(_inside_span(at, time) & _is_valid(at, before, after, F.col("_reach"))).withColumn("_x", at - before)
    real, imag = ((F.col(f"_to_{c}") * F.col("_x") + F.col(f"_{c}").cast("double")).cast("float") for c in ("re", "im"))
    return rows.select(*keys, F.hypot(real, imag).cast("float").alias("amplitude"))


def resample_time(df: DataFrame, rate_hz: float, duration_s: float | None = None,
                  keys: Sequence[str] = RECORDING, time: str = "timestamp_s",
                  signals: Sequence[str] = ("csi_real", "csi_imag"),
                  bucket_s: float = SECONDS_PER_BUCKET) -> DataFrame:
    """Linear interpolation of array columns at ``k / rate_hz``, held flat past the last packet.

    Input is what ``prepare_time`` returns.  The result carries ``before_s`` and ``after_s``,
    the timestamps of the packets around each grid point, for ``mark_valid``.
    """
    return on_grid(grid_spans(df, keys, time, signals, bucket_s), rate_hz, duration_s, keys, time, signals)


def span_gaps(spans: DataFrame, keys: Sequence[str] = RECORDING, time: str = "timestamp_s") -> DataFrame:
    """``median_gap_s`` of written spans."""
    return exact_median(spans, keys, F.col("after_s") - F.col(time), "median_gap_s")


def median_gap(df: DataFrame, keys: Sequence[str] = RECORDING, time: str = "timestamp_s",
               bucket_s: float = SECONDS_PER_BUCKET) -> DataFrame:
    gaps = packet_gaps(df, keys, time, bucket=time_bucket(time, bucket_s))
    gaps = cut_lineage(gaps.select(*keys, "gap_s"), "gaps")  # thin; the median reads it twice
    return exact_median(gaps, keys, F.col("gap_s"), "median_gap_s")


def _tolerance(rate_hz: float) -> Column:
    return F.greatest(F.lit(1.5 / float(rate_hz)), F.lit(1.5) * F.col("median_gap_s"))


def _is_valid(at: Column, before: Column, after: Column, tolerance: Column) -> Column:
    nearest = F.least(at - before, F.coalesce(after - at, at - before))
    return (after.isNotNull() | (at <= before)) & (nearest <= tolerance)


def valid_only(grid: DataFrame, rate_hz: float, time: str = "timestamp_s",
               signals: Sequence[str] = ("csi_real", "csi_imag")) -> DataFrame:
    """``mark_valid`` of grid points that have their recording's ``median_gap_s``."""
    rows = grid.withColumn("valid", _is_valid(F.col(time), F.col("before_s"), F.col("after_s"), _tolerance(rate_hz)))
    for s in signals:
        rows = rows.withColumn(s, F.when(F.col("valid"), F.col(s)).otherwise(
            F.transform(F.col(s), lambda x: F.lit(0).cast("float"))))
    return rows.drop("before_s", "after_s", "median_gap_s")


def mark_valid(grid: DataFrame, gaps: DataFrame, rate_hz: float, keys: Sequence[str] = RECORDING,
               time: str = "timestamp_s",
               signals: Sequence[str] = ("csi_real", "csi_imag")) -> DataFrame:
    """``valid``: inside the observed range and close enough to a real packet; invalid signal is 0."""
    rows = join_facts(grid, gaps.select(*keys, "median_gap_s"), list(keys), F.col("packet_index"))
    return valid_only(rows, rate_hz, time, signals)


def valid_grid(spans: DataFrame, facts: DataFrame, rate_hz: float, duration_s: float | None = None,
               keys: Sequence[str] = RECORDING) -> DataFrame:
    """Uniform grid with validity and amplitude; ``facts`` has ``median_gap_s`` of each recording, and what
    its grid points are to get besides.  Facts go to the spans, which may be far fewer than the grid points."""
    keep = [c for c in facts.columns if c not in keys]
    rows = join_facts(spans, facts, list(keys), F.hash("timestamp_s"))
    grid = on_grid(rows, rate_hz, duration_s, keys, keep=keep)
    return valid_only(grid, rate_hz).withColumn("amplitude", amplitude("csi_real", "csi_imag"))


def standard_grid(df: DataFrame, rate_hz: float, duration_s: float | None = None,
                  keys: Sequence[str] = RECORDING,
                  bucket_s: float = SECONDS_PER_BUCKET) -> DataFrame:
    """Cleaned packets -> uniform grid with validity and amplitude."""
    spans = cut_lineage(grid_spans(df, keys, bucket_s=bucket_s), "spans")
    return valid_grid(spans, span_gaps(spans, keys), rate_hz, duration_s, keys)


def packet_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_length"))


def rate_converted_length(length: Column, source_rate: Column, target_rate: Column) -> Column:
    """Length after changing the rate; unchanged where a rate is unknown or both agree to 1e-9."""
    same = source_rate.isNull() | target_rate.isNull() | (
        F.abs(source_rate - target_rate) < F.lit(1e-9))
    return F.when(same, length.cast("long")).otherwise(
        F.greatest(F.lit(1), F.rint(length * target_rate / source_rate)).cast("long"))


def _need_lengths(df: DataFrame, lengths: DataFrame, keys: Sequence[str]) -> DataFrame:
    return join_facts(df, lengths.select(*keys, "source_length", "target_length"),
                      list(keys), F.col("packet_index"))


def _ceil_div(a: Column, b: Column) -> Column:
    """Whole-number ceiling without a detour through doubles."""
    return F.call_function("div", a + b - 1, b)


def resample_index_linear(df: DataFrame, lengths: DataFrame, signals: Sequence[str],
                          keys: Sequence[str] = RECORDING) -> DataFrame:
    """Linear resampling by position from ``source_length`` to ``target_length`` rows."""
    keys = list(keys)
    rows = df.select(*keys, "packet_index", *signals).withColumn("_bucket", index_bucket())
    rows = with_neighbour(rows, keys, ["packet_index"], "_bucket", list(signals), "_next")
    rows = _need_lengths(rows, lengths, keys)
    n, m, i = F.col("source_length"), F.col("target_length"), F.col("packet_index").cast("long")
    steps, gaps = m - 1, n - 1
    keep = n == m
    lone = (n == 1) | (m == 1)
    # target j lies in [i, i+1) of the source when i*(m-1) <= j*(n-1) < (i+1)*(m-1)
    safe = F.when(gaps > 0, gaps).otherwise(F.lit(1).cast("long"))
    first = F.when(keep, i).when(lone, F.when(i == 0, 0).otherwise(1)).otherwise(
        _ceil_div(i * steps, safe))
    last = F.when(keep, i).when(lone, F.when(i == 0, steps).otherwise(0)).otherwise(
        F.least(_ceil_div((i + 1) * steps, safe) - 1, steps))
    grid = explode_range(rows, first.cast("long"), last.cast("long"), "_j")
    weight = F.when(keep | lone, F.lit(0.0)).otherwise(
        (F.col("_j") * gaps - i * steps).cast("double") / F.when(steps > 0, steps).otherwise(1))
    grid = grid.withColumn("_weight", weight)
    values = [F.when(F.col("_next").isNull() | (F.col("_weight") == 0), as_floats(s))
              .otherwise(_between(F.col(s), F.col(f"_next.{s}"), F.col("_weight"))).alias(s)
              for s in signals]
    return grid.select(*keys, F.col("_j").alias("packet_index"), *values)


def nearest_source(j: Column, n: Column, m: Column) -> Column:
    """Source position of target ``j``, halves to even; position 0 for a single target."""
    step = (n - 1).cast("double") / F.when(m > 1, m - 1).otherwise(1)
    return F.when(m == 1, F.lit(0)).when(j == m - 1, n - 1).otherwise(
        F.rint(j * step)).cast("long")


def resample_index_nearest(df: DataFrame, lengths: DataFrame, columns: Sequence[str],
                           keys: Sequence[str] = RECORDING) -> DataFrame:
    """Nearest-position resampling of any columns: labels, masks, integers or signals."""
    keys = list(keys)
    rows = _need_lengths(df.select(*keys, "packet_index", *columns), lengths, keys)
    n, m, i = F.col("source_length"), F.col("target_length"), F.col("packet_index").cast("long")
    step = (n - 1).cast("double") / F.when(m > 1, m - 1).otherwise(1)
    open_step = F.when(step > 0, step).otherwise(F.lit(1.0))
    guard_low = F.when(n == 1, 0).otherwise(F.floor((i - 0.5) / open_step) - 1)
    guard_high = F.when(n == 1, m - 1).otherwise(F.ceil((i + 0.5) / open_step) + 1)
    grid = explode_range(rows, F.greatest(guard_low, F.lit(0)).cast("long"),
                         F.least(guard_high, m - 1).cast("long"), "_j")
    grid = grid.where(nearest_source(F.col("_j"), n, m) == i)
    return grid.select(*keys, F.col("_j").alias("packet_index"), *columns)


def resample_index_none(df: DataFrame, lengths: DataFrame, columns: Sequence[str],
                        keys: Sequence[str] = RECORDING, pads: dict[str, Column] | None = None
                        ) -> DataFrame:
    """Crop to the target length, or pad behind the last packet: arrays 0, masks false, text empty."""
    keys, pads = list(keys), pads or {}
    rows = _need_lengths(df.select(*keys, "packet_index", *columns), lengths, keys)
    kept = rows.where(F.col("packet_index") < F.col("target_length")).select(
        *keys, F.col("packet_index").cast("long").alias("packet_index"), *columns)
    tails = lengths.where("target_length > source_length").select(
        *keys, "source_length", "target_length")
    widths = df.groupBy(*keys).agg(*[
        F.max(F.size(c)).alias(f"_w_{c}") for c in columns
        if df.schema[c].dataType.typeName() == "array"] or [F.lit(1).alias("_w")])
    tails = explode_range(tails.join(widths, keys), F.col("source_length").cast("long"),
                          F.col("target_length").cast("long") - 1, "packet_index")
    return kept.unionByName(tails.select(*keys, "packet_index", *[
        pad_value(df, c, pads).alias(c) for c in columns]))


def pad_value(df: DataFrame, column: str, pads: dict[str, Column] | None = None) -> Column:
    """What stands behind the last packet of a column (arrays need their width as ``_w_<column>``)."""
    pads, kind = pads or {}, df.schema[column].dataType
    if column in pads:
        value = pads[column]
    elif kind.typeName() == "array":
        value = F.array_repeat(F.lit(0), F.col(f"_w_{column}"))
    elif column == "timestamp_s":
        value = F.lit(float("nan"))
    elif column == "packet_index":
        value = F.lit(-1)
    elif kind.typeName() == "boolean":
        value = F.lit(False)
    elif kind.typeName() == "string":
        value = F.lit("")
    else:
        value = F.lit(0)
    return value.cast(kind)


def resample_index(df: DataFrame, lengths: DataFrame, interpolation: str = "linear",
                   signals: Sequence[str] = ("amplitude",), others: Sequence[str] = (),
                   keys: Sequence[str] = RECORDING) -> DataFrame:
    """Signals by the chosen rule; masks by the same rule or nearest; text always nearest."""
    if interpolation not in INTERPOLATIONS:
        raise ValueError(f"interpolation must be one of {', '.join(INTERPOLATIONS)}")
    keys, signals, others = list(keys), list(signals), list(others)
    text = [c for c in others if df.schema[c].dataType.typeName() == "string"]
    plain = [c for c in others if c not in text]
    if interpolation == "nearest":
        return resample_index_nearest(df, lengths, [*signals, *others], keys)
    if interpolation == "none":
        out = resample_index_none(df, lengths, [*signals, *plain], keys)
        if text:
            out = out.join(resample_index_nearest(df, lengths, text, keys),
                           [*keys, "packet_index"], "left")
        return out
    out = resample_index_linear(df, lengths, signals, keys)
    if others:
        out = out.join(resample_index_nearest(df, lengths, others, keys),
                       [*keys, "packet_index"], "left")
    return out


def recompute_phase(df: DataFrame) -> DataFrame:
    """Phase of the resampled real and imaginary parts; wrapped angles are never interpolated."""
    if {"phase_rad", "csi_real", "csi_imag"} <= set(df.columns):
        return df.withColumn("phase_rad", phase("csi_real", "csi_imag"))
    return df
