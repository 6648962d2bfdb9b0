"""Fixed windows over whole recordings, channel fitting and the description of a view.

A window is arithmetic on ``packet_index``; only the padded tail of each clip is generated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from packetloom.functions import arrays as A
from packetloom.operators.errors import flagged
from packetloom.operators.ordered import explode_range, join_facts
from packetloom.operators.resample import pad_value
from packetloom.operators.timeline import RECORDING

CLIP = ("recording_id", "sample_index")


def window_index(index: Column, width: int | Column) -> Column:
    width = F.lit(width) if isinstance(width, int) else width
    return F.call_function("div", index.cast("long"), width.cast("long"))


def window_table(df: DataFrame, width: int, keys: Sequence[str] = CLIP) -> DataFrame:
    """One row per window: its range and how many real packets it holds."""
    if width <= 0:
        raise ValueError("window length must be positive")
    start = F.col("window_index") * F.lit(width)
    return (df.groupBy(*keys, window_index(F.col("packet_index"), width).alias("window_index"))
            .agg(F.count(F.lit(1)).alias("window_valid_length"))
            .withColumn("window_start_index", start)
            .withColumn("window_end_index", start + F.col("window_valid_length")))


def window_counts(df: DataFrame, width: int, keys: Sequence[str] = CLIP) -> DataFrame:
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("resampled_length"))
            .withColumn("window_count", F.greatest(
                F.lit(1), F.ceil(F.col("resampled_length") / F.lit(width)))))


def segment_windows(df: DataFrame, width: int | str, keys: Sequence[str] = CLIP,
                    pads: dict[str, Column] | None = None) -> DataFrame:
    """Packets with their window, offset and validity, the last window of each clip padded.

    ``width`` is one length for all, or the column that holds each clip's own.  No packet is
    dropped.  Padding: signal 0, mask false, time NaN, index -1, label "".
    """
    if isinstance(width, int) and width <= 0:
        raise ValueError("window length must be positive")
    keys = list(keys)
    own = [] if isinstance(width, int) else [width]
    others = [c for c in df.columns if c not in (*keys, *own, "packet_index")]
    if "valid" not in others:
        df, others = df.withColumn("valid", F.lit(True)), [*others, "valid"]
    size = (F.lit(width) if isinstance(width, int) else F.col(width)).cast("long")
    position = F.col("packet_index").cast("long")
    real = df.select(*keys, *own, window_index(position, size).alias("window_index"),
                     F.pmod(position, size).alias("offset"), position.alias("_index"), *others)
    widths = [F.max(F.size(c)).alias(f"_w_{c}") for c in others
              if df.schema[c].dataType.typeName() == "array"]
    ends = df.groupBy(*keys).agg((F.max("packet_index") + 1).cast("long").alias("_n"),
                                 *[F.max(c).alias(c) for c in own], *widths)
    padded_end = F.call_function("div", F.col("_n") + size - 1, size) * size
    tails = explode_range(ends, F.col("_n"), padded_end - 1, "_k")
    tails = tails.select(*keys, *own, window_index(F.col("_k"), size).alias("window_index"),
                         F.pmod(F.col("_k"), size).alias("offset"),
                         F.lit(-1).cast("long").alias("_index"),
                         *[pad_value(df, c, pads).alias(c) for c in others])
    return real.unionByName(tails).withColumnRenamed("_index", "packet_index")


def window_tensors(windows: DataFrame, signal: str, keys: Sequence[str] = CLIP) -> DataFrame:
    """Tensor form: one row per window, its packets in order.  A group is at most one window."""
    return windows.groupBy(*keys, "window_index").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("offset", signal))),
                    lambda x: x[signal]).alias(signal),
        F.transform(F.array_sort(F.collect_list(F.struct("offset", "valid"))),
                    lambda x: x["valid"]).alias("valid_mask"))


def repeat_for_windows(windows: DataFrame, attributes: DataFrame,
                       keys: Sequence[str] = CLIP) -> DataFrame:
    """Per-clip attributes repeated for every window of the clip."""
    flat = [f.name for f in windows.schema.fields if not isinstance(f.dataType, (MapType, ArrayType, StructType))]
    return join_facts(windows, attributes, keys, F.xxhash64(*flat))


def view_time(df: DataFrame, rate: Column, first: Column, last: Column, length: Column,
              index: str = "packet_index", out: str = "timestamp_s") -> DataFrame:
    """Timeline of a view: index/rate, or evenly from first to last where no rate is known."""
    step = (last - first) / F.when(length > 1, length - 1).otherwise(1)
    even = F.when(F.col(index) == length - 1, F.when(length > 1, last).otherwise(first)).otherwise(
        F.col(index) * step + first)
    return df.withColumn(out, F.when(
        F.col(index) < 0, F.lit(float("nan"))).when(
        rate.isNotNull(), F.col(index).cast("double") / rate).otherwise(even))


def fit_channels(df: DataFrame, shape: tuple, signals: Sequence[str],
                 subcarriers: int | None = None, tx_links: int | None = None,
                 rx_links: int | None = None) -> tuple[DataFrame, tuple]:
    """Crop or pad ``S x Tx x Rx`` arrays: subcarriers around the centre, links from the head."""
    for name, count in (("subcarriers", subcarriers), ("tx_links", tx_links), ("rx_links", rx_links)):
        if count is not None and count <= 0:
            raise ValueError(f"{name} must be positive")
    s, tx, rx = shape
    for signal in signals:
        value, size = F.col(signal), [s, tx, rx]
        for axis, target in ((0, subcarriers), (1, tx_links), (2, rx_links)):
            if target is None or target is size[axis] or target == size[axis]:
                continue
            outer, inner = 1, 1
            for n in size[:axis]:
                outer = outer * n
            for n in size[axis + 1:]:
                inner = inner * n
            value = A.fit_axis(value, outer, size[axis], inner, target, centred=axis == 0)
            size[axis] = target
        df = df.withColumn(signal, value)
    return df, (subcarriers or s, tx_links or tx, rx_links or rx)


def fit_links(df: DataFrame, shape: tuple, signals: Sequence[str], links: int) -> DataFrame:
    """Change the link axis of ``link x subcarrier`` arrays; one target link means the average."""
    if links <= 0:
        raise ValueError("links must be positive")
    count, inner = shape
    for signal in signals:
        if isinstance(count, int) and count > 1 and links == 1:
            value = A.axis_reduce(signal, 1, count, inner, "mean")
        else:
            value = A.fit_axis(signal, 1, count, inner, links)
        df = df.withColumn(signal, value)
    return df


def dimension_masks(df: DataFrame, shape: tuple, subcarriers: int | None = None,
                    tx_links: int | None = None, rx_links: int | None = None) -> DataFrame:
    s, tx, rx = shape
    return (df.withColumn("subcarrier_mask", A.axis_mask(s, subcarriers, centred=True))
            .withColumn("tx_link_mask", A.axis_mask(tx, tx_links))
            .withColumn("rx_link_mask", A.axis_mask(rx, rx_links)))


def view_source_info(recordings: DataFrame, target_rate_hz: float | None = None) -> DataFrame:
    """Primary array, time axis, and lengths before and after the rate change.

    ``recordings`` has ``arrays``, ``shape``, ``axis_order``, ``standard_representation`` and
    ``source_rate_hz`` (NULL when unknown).
    """
    from packetloom.operators.resample import rate_converted_length

    names = F.col("arrays")
    stated = F.when(F.array_contains(names, F.col("standard_representation")),
                    F.col("standard_representation"))
    usual = F.get(F.filter(F.array(*[F.lit(n) for n in ("amplitude", "csi_real", "bvp")]),
                           lambda n: F.array_contains(names, n)), F.lit(0))
    axes = F.when(F.size("axis_order") > 0, F.col("axis_order")).when(
        F.size("shape") == 4, F.array(*map(F.lit, ("sample", "time", "link", "subcarrier")))
    ).otherwise(F.array(*map(F.lit, ("time", "link", "subcarrier"))))
    rows = recordings.withColumn("primary", F.coalesce(stated, usual, F.get(names, F.lit(0))))
    rows = rows.withColumn("axes", axes)
    named = F.get(F.filter(
        F.sequence(F.lit(0), F.size("axes") - 1),
        lambda i: F.get(F.col("axes"), i).isin("time", "packet", "time_bin")), F.lit(0))
    rows = rows.withColumn("time_axis", F.coalesce(
        named,
        F.when((F.get("axes", F.lit(0)) == "sample") & (F.size("shape") >= 2), 1),
        F.when(F.size("shape") >= 3, 0)))
    rows = rows.withColumn("source_length", F.get("shape", F.col("time_axis")).cast("long"))
    target = F.lit(target_rate_hz).cast("double")
    return rows.withColumn("rate_length", rate_converted_length(
        F.col("source_length"), F.col("source_rate_hz"), target))


def target_lengths(recordings: DataFrame, target_rate_hz: float | None = None,
                   duration_s: float | None = None, target_length: int | None = None) -> DataFrame:
    """``rate_length`` after the rate change and ``window_length`` by length, duration or ratio."""
    from packetloom.operators.resample import rate_converted_length

    for name, value in (("target_rate_hz", target_rate_hz), ("duration_s", duration_s),
                        ("target_length", target_length)):
        if value is not None and value <= 0:
            raise ValueError(f"{name} must be positive")
    n, source = F.col("source_length"), F.col("source_rate_hz")
    target = F.lit(target_rate_hz).cast("double")
    if target_length is not None:
        window = F.lit(int(target_length)).cast("long")
    elif duration_s is not None:
        rate = F.coalesce(target, source)
        window = F.greatest(F.lit(1), F.rint(F.lit(float(duration_s)) * rate)).cast("long")
    elif target_rate_hz is not None:
        window = F.when(source.isNull(), n.cast("long")).otherwise(
            F.greatest(F.lit(1), F.rint(n * target / source)).cast("long"))
    else:
        window = n.cast("long")
    rows = recordings.withColumn("rate_length", rate_converted_length(n, source, target)).withColumn("window_length", window)
    if target_length is None and duration_s is not None:
        rows = flagged(rows, "window_length", F.coalesce(target, source).isNotNull(),
                       "a duration needs a target rate or a known source rate")
    return rows


def window_policy(recordings: DataFrame, profile_limit: int | None = None,
                  by: Sequence[str] = ()) -> DataFrame:
    """The common window: the shortest resampled recording (per task with ``by``), at most the profile's."""
    shortest = recordings.groupBy(*by).agg(F.min("rate_length").alias("min_resampled_length"),
                                           F.count(F.lit(1)).alias("source_count"))
    limit = F.lit(profile_limit).cast("long")
    return (shortest.withColumn("profile_max_length", limit)
            .withColumn("selected_window_length", F.when(
                limit.isNotNull(), F.least("min_resampled_length", limit)
            ).otherwise(F.col("min_resampled_length"))))


def flatten_layout(recordings: DataFrame, layout: str = "canonical") -> DataFrame:
    """Channels are stored flat already; a flat layout only rewrites the shape and axis names."""
    if layout not in ("canonical", "flat", "link-subcarrier"):
        raise ValueError("layout must be canonical, flat, or link-subcarrier")
    if layout == "canonical":
        return recordings
    lead = F.filter("axis_order", lambda a: a.isin("sample", "time", "packet", "time_bin"))
    axes = F.arrays_zip(F.col("axis_order").alias("a"), F.col("shape").alias("n"))
    kept = F.transform(F.filter(axes, lambda z: F.array_contains(lead, z["a"])), lambda z: z["n"])
    features = F.aggregate(F.filter(axes, lambda z: ~F.array_contains(lead, z["a"])),
                           F.lit(1).cast("long"), lambda acc, z: acc * z["n"])
    return (recordings.withColumn("_shape", F.concat(kept, F.array(features.cast("int"))))
            .withColumn("axis_order", F.concat(lead, F.array(F.lit("feature"))))
            .withColumn("shape", F.col("_shape")).drop("_shape"))


def view_metadata(recordings: DataFrame, options: dict) -> DataFrame:
    """Rate, window counts and the transformation log of a view.

    A bin cadence that is not known is never turned into a rate: ``time_bin`` recordings with a
    declared tensor exception and no source rate keep a NULL rate.
    """
    target = F.lit(options.get("target_rate_hz")).cast("double")
    bins = (F.col("tensor_exception") & F.array_contains("axis_order", "time_bin")
            & F.col("source_rate_hz").isNull())
    rate = F.when(~bins, F.coalesce(target, F.col("source_rate_hz")))
    rows = recordings.withColumn("semantic_bins", bins).withColumn("sample_rate_hz", rate)
    log = F.concat(
        F.lit(f"window view: profile={options.get('profile')}, window_length="),
        F.col("window_length").cast("string"),
        F.lit(f", interpolation={options.get('interpolation', 'linear')}, "
              f"layout={options.get('layout', 'canonical')}, dropped_time_steps=0"))
    windows = F.greatest(F.lit(1), F.ceil(F.col("rate_length") / F.col("window_length")))
    return (rows.withColumn("target_rate_assumed", target.isNotNull()
                            & F.col("source_rate_hz").isNull() & ~bins)
            .withColumn("duration_s", F.col("window_length") / F.col("sample_rate_hz"))
            .withColumn("windows_per_sample", windows)
            .withColumn("output_window_count", windows * F.col("sample_count"))
            .withColumn("dropped_time_steps", F.lit(0))
            .withColumn("full_source_preserved", F.lit(True))
            .withColumn("transformations", F.array_append("transformations", log)))


__all__ = [
    "CLIP", "RECORDING", "dimension_masks", "fit_channels", "fit_links", "flatten_layout",
    "repeat_for_windows", "segment_windows", "target_lengths", "view_metadata",
    "view_source_info", "view_time", "window_counts", "window_index", "window_policy",
    "window_table", "window_tensors",
]
