"""Views whole: windows with their times, what describes them, and the segments of their labels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions import arrays as A
from packetloom.functions.arrays import is_finite
from packetloom.operators import resample as R
from packetloom.operators import segments as D
from packetloom.operators import timeline as TL
from packetloom.operators import windows as W
from packetloom.operators.errors import flagged
from packetloom.operators.ordered import index_bucket, join_facts, with_running_total
from packetloom.plans.profiles import ViewOptions
from packetloom.session import cut_lineage

ID = "recording_id"
CLIP = [ID, "sample_index"]
SIGNALS = ("amplitude", "csi_real", "csi_imag", "phase_rad", "power_db_rel",
           "official_normalized_amplitude", "official_normalized_bvp", "bvp")
COMPLEX = {"phase_rad", "csi_real", "csi_imag"}
LEADING = ("sample", "time", "packet", "time_bin")
COUNTS = {"link": "links", "subcarrier": "subcarriers", "tx_link": "tx_links", "rx_link": "rx_links"}
OPTION_TYPES = {"target_rate_hz": "double", "duration_s": "double", "target_length": "long", "interpolation": "string",
                "layout": "string", "links": "int", "subcarriers": "int", "tx_links": "int", "rx_links": "int",
                "profile": "string"}
SEGMENTS = ("recording_id string, run long, source_label string, start_index long, end_index long, "
            "start_seconds double, end_seconds double")


@dataclass
class View:
    """``windows`` has a row per packet of a window, ``recordings`` and ``segments`` describe them."""

    windows: DataFrame
    recordings: DataFrame
    segments: DataFrame


def describe_clips(packets: DataFrame, recordings: DataFrame) -> DataFrame:
    """Length, channels, first and last time of every clip, and the source rate of its recording.

    A stated positive rate wins; the others are one over the median positive gap of the first clip's
    timestamps, NULL where there is none.
    """
    if "sample_index" not in packets.columns:
        packets = packets.withColumn("sample_index", F.lit(0))
    timed = "timestamp_s" in packets.columns
    widths = [F.coalesce(F.size(s), F.lit(0)) for s in SIGNALS if s in packets.columns]
    width = F.greatest(F.lit(0), *widths) if widths else F.lit(0)
    ends = [(F.min_by, "first_s"), (F.max_by, "last_s")]
    lengths = packets.groupBy(*CLIP).agg(
        F.count(F.lit(1)).alias("source_length"), F.max(width).cast("long").alias("channels"),
        *[(pick("timestamp_s", "packet_index") if timed else F.max(F.lit(None))).cast("double").alias(name)
          for pick, name in ends])
    rate = F.col("sample_rate_hz").cast("double")
    rated = recordings.select(ID, F.when(is_finite(rate) & (rate > 0), rate).alias("source_rate_hz"))
    unknown = rated.where("source_rate_hz is null").select(ID)
    if timed and not unknown.isEmpty():
        thin = packets.where("sample_index = 0").select(ID, "packet_index", "timestamp_s")
        thin = join_facts(thin, unknown, [ID], F.col("packet_index"), how="inner")
        measured = TL.source_rate(thin, order_by=["packet_index"], bucket=index_bucket("packet_index"))
        rated = rated.join(measured.select(ID, "measured_rate_hz"), ID, "left").select(
            ID, F.coalesce("source_rate_hz", "measured_rate_hz").alias("source_rate_hz"))
    return lengths.join(rated, ID, "left")


def source_axes(recordings: DataFrame, clips: DataFrame, signals: Sequence[str]) -> DataFrame:
    """``primary`` array, ``axes``, the axes behind time (``rest``) and their ``sizes`` where they are known."""
    have = set(recordings.columns)

    def given(name: str, kind: str) -> Column:
        return (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name)

    names = F.array().cast("array<string>")
    facts = clips.groupBy(ID).agg(F.max("sample_index").alias("_last"), F.max("channels").alias("_channels"))
    rows = recordings.select(
        ID, F.array(*map(F.lit, signals)).alias("arrays"), given("standard_representation", "string"),
        F.coalesce(given("axis_order", "array<string>"), names).alias("axis_order"),
        F.lit(None).cast("double").alias("source_rate_hz"),
        *[given(c, "long") for c in COUNTS.values()]).join(facts, ID)
    usual = F.when(F.col("_last") > 0, 4).otherwise(3)
    rows = rows.withColumn("shape", F.array_repeat(F.lit(1), F.when(
        F.size("axis_order") > 0, F.size("axis_order")).otherwise(usual)))
    rows = flagged(W.view_source_info(rows), "primary", F.col("time_axis").isNotNull(), F.concat(
        F.lit("no time axis among "), F.concat_ws(", ", "axes")))
    rows = rows.withColumn("rest", F.filter("axes", lambda a: ~a.isin(*LEADING)))
    known = F.transform("rest", lambda a: F.coalesce(*[F.when(a == axis, F.col(c)) for axis, c in COUNTS.items()]))
    rows = rows.withColumn("_known", known)
    product = F.aggregate("_known", F.lit(1).cast("long"), lambda acc, n: acc * F.coalesce(n, F.lit(1)))
    rows = rows.withColumn("_product", F.nullif(product, F.lit(0).cast("long")))
    left = F.call_function("div", F.col("_channels"), F.col("_product"))
    open_axes = F.size(F.filter("_known", lambda n: n.isNull()))
    fits = ((open_axes == 0) & (F.col("_product") == F.col("_channels"))) | (
        (open_axes == 1) & (F.col("_product") * left == F.col("_channels")))
    sizes = F.when(fits, F.transform("_known", lambda n: F.coalesce(n, left)))
    return rows.select(ID, "primary", "axes", "rest", sizes.alias("sizes"),
                       F.get("axes", F.col("time_axis")).alias("time_name"))


def _size(axis: str) -> Column:
    """The size of one axis of a row with ``rest`` and ``sizes``, NULL without it."""
    return F.get("sizes", (F.array_position("rest", axis) - 1).cast("int"))


def _resized(axis: str, target: int) -> Column:
    """``sizes`` after one axis was given ``target`` places."""
    pairs = F.arrays_zip(F.col("rest").alias("a"), F.col("sizes").alias("n"))
    return F.when(F.col("sizes").isNotNull(), F.transform(
        pairs, lambda z: F.when(z["a"] == axis, F.lit(target).cast("long")).otherwise(z["n"])))


def _fit_named(windows: DataFrame, signals: Sequence[str], axis: str, target: int) -> DataFrame:
    """Crop or pad one named axis of every row; the mean where several links become one."""
    at = F.array_position("rest", axis).cast("int")
    count = F.size("sizes")

    def product(part: Column) -> Column:
        return F.aggregate(part, F.lit(1).cast("long"), lambda acc, n: acc * n)

    windows = flagged(windows, list(signals), (at == 0) | F.col("sizes").isNotNull(),
                      f"the size of axis {axis} is not known")
    there = at > 0
    windows = windows.withColumns({
        "_n": F.when(there, _size(axis)), "_outer": F.when(there, product(F.slice("sizes", F.lit(1), at - 1))),
        "_inner": F.when(there, product(F.slice("sizes", at + 1, F.greatest(count - at, F.lit(0)))))})
    for s in signals:
        value = A.fit_axis(s, F.col("_outer"), F.col("_n"), F.col("_inner"), target, centred=axis == "subcarrier")
        if axis == "link" and target == 1:
            value = F.when(F.col("_n") > 1, A.axis_reduce(s, F.col("_outer"), F.col("_n"), F.col("_inner"), "mean")).otherwise(value)
        windows = windows.withColumn(s, F.when(F.col("_n").isNull() | (F.col("_n") == target), F.col(s)).otherwise(value))
    return windows.withColumn("sizes", _resized(axis, target)).drop("_n", "_outer", "_inner")


def label_facts(rows: DataFrame, info: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per recording its one label or that it has segments, and those segments.

    Labels are those of the resampled packets, "" and NULL do not count and take no time.  Segments are
    made of recordings of one clip whose view is one window; several labels elsewhere give neither.
    """
    rows = rows.select(*CLIP, "packet_index", F.coalesce("source_label", F.lit("")).alias("source_label"))
    one = info.groupBy(ID).agg(
        F.count(F.lit(1)).alias("_clips"), F.max(F.ceil(F.col("rate_length") / F.col("window_length"))).alias("_windows"),
        F.max("view_rate_hz").alias("sample_rate_hz"), F.max(F.array_contains("axes", "sample").cast("int")).alias("_batch"))
    one = one.where("_clips = 1 and _windows <= 1 and _batch = 0")
    facts = D.clip_or_segments(rows)
    facts = facts.join(one.select(ID, F.lit(True).alias("_single")), ID, "left").select(
        ID, "clip_label", (F.col("has_segments") & F.coalesce("_single", F.lit(False))).alias("segmented"))
    facts = cut_lineage(facts, "view_labels")
    wanted = facts.where("segmented").select(ID).join(one.select(ID, "sample_rate_hz"), ID)
    thin = join_facts(rows, wanted.select(ID), [ID], F.col("packet_index"), how="inner").select(
        ID, "packet_index", "source_label").withColumn("_bucket", index_bucket("packet_index"))
    told = F.when(F.col("source_label") != "", F.lit(1)).otherwise(F.lit(0)).cast("long")
    thin = with_running_total(thin, [ID], ["packet_index"], "_bucket", told, "_seen").where("source_label <> ''")
    thin = thin.select(ID, (F.col("_seen") - 1).alias("packet_index"), "source_label")
    runs = D.label_runs(thin, wanted)
    return facts, runs.select(ID, "run", "source_label", "start_index", "end_index", "start_seconds", "end_seconds")


def build_view(packets: DataFrame, recordings: DataFrame, options: ViewOptions, channels: tuple | None = None,
               window_length: DataFrame | None = None, clips: DataFrame | None = None) -> View:
    """The windows of a view with times and validity, its recordings, and its segments.

    The whole recording is resampled first and then cut; nothing is dropped and only the last window of
    a clip is padded (signals 0, time NaN, index -1, label "").  A packet's time is index by rate; where no
    rate is known, and for semantic bins, times lie evenly from the clip's first to its last, NULL where
    the source has none.  ``channels`` is the common ``(S, Tx, Rx)``, or ``(links, inner)`` for ``links``;
    without it the counts in ``recordings`` say what each recording has.  ``window_length`` overrides the
    options per recording (see ``prepare``); ``clips`` (what ``describe_clips`` gives) saves a pass.
    """
    if not options.requested:
        raise ValueError("no view options were requested")
    if "sample_index" not in packets.columns:
        packets = packets.withColumn("sample_index", F.lit(0))
    signals = [s for s in SIGNALS if s in packets.columns]
    others = [c for c in ("source_label", "valid") if c in packets.columns]
    for name, default in (("tensor_exception", F.lit(False)), ("transformations", F.array().cast("array<string>"))):
        if name not in recordings.columns:
            recordings = recordings.withColumn(name, default)
    clips = describe_clips(packets, recordings) if clips is None else clips
    info = W.target_lengths(clips, options.target_rate_hz, options.duration_s, options.target_length)
    if window_length is not None:
        info = info.drop("window_length").join(window_length, ID)
    counts = recordings
    if channels is not None:
        named = ("subcarrier", "tx_link", "rx_link") if len(channels) == 3 else ("link", "subcarrier")
        counts = recordings.withColumns({COUNTS[a]: F.lit(n) for a, n in zip(named, channels)})
    axes = source_axes(counts, clips, signals).join(recordings.select(ID, F.coalesce("tensor_exception", F.lit(False)).alias("_odd")), ID)
    info = info.join(axes, ID).withColumn("view_rate_hz", F.when(
        ~(F.col("_odd") & F.array_contains("axes", "time_bin") & F.col("source_rate_hz").isNull()),
        F.coalesce(F.lit(options.target_rate_hz).cast("double"), F.col("source_rate_hz"))))
    info = cut_lineage(info.drop("_odd"), "view_clips")

    rows = packets.select(*CLIP, "packet_index", *signals, *others)
    if options.target_rate_hz is not None:
        lengths = info.withColumn("target_length", F.col("rate_length"))
        rows = R.resample_index(rows, lengths, options.interpolation, signals, others, CLIP)
    if set(signals) >= COMPLEX:
        rows = R.recompute_phase(rows)
    if options.target_rate_hz is not None:
        rows = cut_lineage(rows, "resampled")
    labels = segments = None
    if "source_label" in others:
        labels, segments = label_facts(rows, info)

    asked = {a: getattr(options, c) for a, c in COUNTS.items() if getattr(options, c) is not None}
    fitted = ["rest", "sizes"] if asked and channels is None else []
    own = ["rate_length", "view_rate_hz", "first_s", "last_s", *fitted]     # one value a clip, carried as keys
    per_clip = info.select(*CLIP, "window_length", *own)
    rows = join_facts(rows, per_clip, CLIP, F.col("packet_index"), how="inner")
    windows = W.segment_windows(rows, "window_length", [*CLIP, *own])
    if fitted:
        for axis, target in asked.items():
            windows = _fit_named(windows, signals, axis, target)
    elif len(asked) and len(channels) == 3:
        windows, _ = W.fit_channels(windows, channels, signals, options.subcarriers, options.tx_links, options.rx_links)
    elif "link" in asked:
        windows = W.fit_links(windows, channels, signals, options.links)
    if options.target_rate_hz is not None or "timestamp_s" in packets.columns:
        windows = W.view_time(windows, F.col("view_rate_hz"), F.col("first_s"), F.col("last_s"), F.col("rate_length"))
    start = F.col("window_index") * F.col("window_length")
    filled = F.greatest(F.lit(0), F.least(F.col("window_length"), F.col("rate_length") - start))
    windows = (windows.withColumnRenamed("sample_index", "source_sample_index")
               .withColumns({"window_start_index": start, "window_valid_length": filled.cast("long"),
                             "window_end_index": (start + filled).cast("long")}).drop(*own))
    meta = view_recordings(recordings, info, options, asked, set(signals) >= COMPLEX, labels)
    if segments is None:
        segments = packets.sparkSession.createDataFrame([], SEGMENTS)
    return View(windows, meta, segments)


def view_recordings(recordings: DataFrame, info: DataFrame, options: ViewOptions, asked: dict[str, int],
                    phase: bool, labels: DataFrame | None) -> DataFrame:
    """The recordings of a view: shape and axes of its windows, rates, counts, masks, labels and options."""
    facts = info.groupBy(ID).agg(
        F.count(F.lit(1)).alias("sample_count"),
        *[F.max(c).alias(c) for c in ("source_length", "rate_length", "window_length", "source_rate_hz", "channels")],
        *[F.first(c).alias(c) for c in ("primary", "axes", "rest", "sizes", "time_name")])
    rows = recordings.withColumn("_duration_s", (F.col("duration_s") if "duration_s" in recordings.columns else F.lit(None)).cast("double"))
    rows = rows.drop(*[c for c in facts.columns if c != ID]).join(facts, ID).withColumn("axis_order", F.col("axes"))
    if phase:
        rows = rows.withColumn("transformations", F.array_append("transformations", F.lit("phase taken from the real and imaginary parts of the view")))
    meta = W.view_metadata(rows, {"target_rate_hz": options.target_rate_hz, "profile": options.profile,
                                  "interpolation": options.interpolation, "layout": options.layout})
    for axis in ("subcarrier", "tx_link", "rx_link"):
        target, centred = asked.get(axis), axis == "subcarrier"
        meta = meta.withColumn(f"{axis}_mask", A.axis_mask(_size(axis), target, centred))
        place = f"{axis}_index"
        if place in meta.columns and target is not None:
            meta = meta.withColumn(place, F.when(F.size(place) == _size(axis), A.fit_coordinate(place, target, centred)).otherwise(F.col(place)))
    for axis, target in asked.items():
        meta = meta.withColumn("sizes", _resized(axis, target))
    flat = options.layout != "canonical"
    if flat:        # one feature axis needs no more than the channel count
        meta = meta.withColumns({"rest": F.when(F.col("sizes").isNull(), F.array(F.lit("feature"))).otherwise(F.col("rest")),
                                 "sizes": F.coalesce("sizes", F.array("channels"))})
    batch = F.array_contains("axes", "sample") | (F.col("output_window_count") > 1)
    time = F.when(F.col("time_name") == "time_bin", F.lit("time_bin")).otherwise(F.lit("time"))
    meta = meta.withColumns({
        "axis_order": F.concat(F.when(batch, F.array(F.lit("sample"), time)).otherwise(F.array(time)), F.col("rest")),
        "shape": F.concat(F.when(batch, F.array(F.col("output_window_count").cast("long"), F.col("window_length"))).otherwise(
            F.array("window_length")), F.col("sizes")).cast("array<int>")})
    meta = W.flatten_layout(meta, options.layout)
    if labels is not None:
        meta = meta.join(labels, ID, "left").withColumn("segmented", F.coalesce("segmented", F.lit(False)))
        kind = "map<string,string>"
        had = F.col("labels") if "labels" in meta.columns else F.lit(None).cast(kind)
        if "labels" not in meta.columns or meta.schema["labels"].dataType.simpleString() == kind:
            none = F.create_map().cast(kind)
            full = F.map_concat(F.coalesce(had, none), F.create_map(F.lit("activity"), F.col("clip_label")))
            new = F.col("clip_label").isNotNull() & ~F.map_contains_key(F.coalesce(had, none), F.lit("activity"))
            meta = meta.withColumn("labels", F.when(new, full).otherwise(had))
        meta = meta.drop("clip_label")
    chosen = asdict(options)
    return meta.withColumns({
        "duration_s": F.coalesce("duration_s", "_duration_s"), "standard_representation": F.col("primary"),
        "source_sample_rate_hz": F.col("source_rate_hz"), "derived_from": F.col(ID), "profile": F.lit(options.profile).cast("string"),
        "window_mode": F.lit("segment"),
        "view_options": F.struct(*[F.lit(chosen[n]).cast(t).alias(n) for n, t in OPTION_TYPES.items()]),
    }).drop("_duration_s", "primary", "axes", "rest", "sizes", "time_name")
