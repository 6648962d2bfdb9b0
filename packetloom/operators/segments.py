"""Labels over time: runs, intervals, annotations and label catalogs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions import text as T
from packetloom.operators.ordered import (
    PACKETS_PER_BUCKET, SECONDS_PER_BUCKET, explode_range, index_bucket, join_facts, time_bucket,
    with_change_count)
from packetloom.operators.timeline import RECORDING
from packetloom.session import cut_lineage

FEW = 1_000_000   # recordings whose keys and rates go to every task


def numbered_runs(df: DataFrame, label: str, keys: Sequence[str], index: str) -> DataFrame:
    """One row per run of equal labels: ``[start_index, end_index)``.

    A run may be as long as its recording: it is reduced by partial aggregation, never collected.
    """
    rows = df.select(*keys, index, label).withColumn("_bucket", index_bucket(index))
    rows = with_change_count(rows, keys, [index], "_bucket", [label],
                             lambda prev, own: ~prev[label].eqNullSafe(own[label]), "run", first=1)
    return rows.groupBy(*keys, "run").agg(
        F.first(label).alias(label), F.min(index).cast("long").alias("start_index"),
        (F.max(index) + 1).cast("long").alias("end_index"))


def label_runs(df: DataFrame, rate: DataFrame | float | None = None, label: str = "source_label",
               keys: Sequence[str] = RECORDING, index: str = "packet_index") -> DataFrame:
    """Segments of equal packet labels, in seconds of index/rate (an unknown rate counts as 1).

    Recordings with at most one packet have no segments.
    """
    # written once: the runs and what is known of their recordings both come from them
    runs = cut_lineage(numbered_runs(df, label, keys, index), "runs")
    known = runs.groupBy(*keys).agg(F.max("run").alias("_last"), F.max(F.col("end_index") - F.col("start_index")).alias("_size"))
    known = known.where("_last > 1 OR _size > 1").select(*keys)
    if isinstance(rate, DataFrame):   # only the rates of recordings that have segments go on
        known = known.join(rate.select(*keys, F.col("sample_rate_hz").cast("double").alias("_rate")), list(keys), "left")
    else:
        known = known.withColumn("_rate", F.lit(rate).cast("double"))
    known = cut_lineage(known.select(*[F.col(k).alias(f"_{k}") for k in keys], "_rate"), "known")
    known = F.broadcast(known) if known.count() <= FEW else known.hint("merge")
    kept = runs.join(known, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]).drop(*[f"_{k}" for k in keys])
    hz = F.coalesce(F.when(F.col("_rate") != 0, F.col("_rate")), F.lit(1.0))
    return (kept.withColumn("start_seconds", F.col("start_index") / hz)
            .withColumn("end_seconds", F.col("end_index") / hz).drop("_rate"))


def longest_run(runs: DataFrame, label: str = "source_label", keys: Sequence[str] = RECORDING,
                cap: int | None = None, expected: DataFrame | None = None) -> DataFrame:
    """The longest run per label, the earliest on ties, optionally cut to ``cap`` packets.

    With ``expected`` labels every one is returned and those never seen carry an error text.
    """
    length = F.col("end_index") - F.col("start_index")
    best = runs.groupBy(*keys, label).agg(F.max_by(
        F.struct("start_index", "end_index"),
        F.struct(length, -F.col("start_index"))).alias("_best"))
    best = best.select(*keys, label, F.col("_best.start_index").alias("start_index"),
                       F.col("_best.end_index").alias("end_index"))
    if cap is not None:
        best = best.withColumn("end_index", F.least(
            F.col("end_index"), F.col("start_index") + F.lit(cap)))
    if expected is not None:
        best = (expected.select(*keys, label).join(best, [*keys, label], "left")
                .withColumn("error", F.when(F.col("start_index").isNull(), F.concat(
                    F.lit("no interval labelled "), F.col(label)))))
    return best


def checked_intervals(intervals: DataFrame, lengths: DataFrame,
                      keys: Sequence[str] = RECORDING) -> DataFrame:
    """Intervals clamped to ``[0, length]``; an empty one or a NULL label gets an error text."""
    rows = join_facts(intervals, lengths.select(*keys, "source_length"), list(keys),
                      F.col("interval_order"), how="inner")
    rows = (rows.withColumn("start_index", F.greatest(F.lit(0), F.col("start_index")).cast("long"))
            .withColumn("end_index", F.least(F.col("source_length"), F.col("end_index")).cast("long")))
    return rows.drop("source_length").withColumn("error", F.when(
        F.col("label").isNull(), F.lit("unknown label id")).when(
        F.col("end_index") <= F.col("start_index"), F.lit("invalid segment")))


def _bucketed_intervals(intervals: DataFrame, low: Column, high: Column, width: float) -> DataFrame:
    """Every bucket an interval touches, so that the range join becomes an equi-join."""
    return explode_range(intervals, F.floor(low / F.lit(width)).cast("long"),
                         F.floor(high / F.lit(width)).cast("long"), "_bucket")


def paint_labels(packets: DataFrame, intervals: DataFrame, keys: Sequence[str] = RECORDING,
                 default: str = "unlabeled", width: int = PACKETS_PER_BUCKET) -> DataFrame:
    """Label packets by half-open index intervals; where they overlap the later one wins."""
    pieces = _bucketed_intervals(
        intervals.select(*keys, "interval_order", "start_index", "end_index", "label"),
        F.col("start_index"), F.col("end_index") - 1, width)
    rows = packets.withColumn("_bucket", F.floor(F.col("packet_index") / F.lit(width)).cast("long"))
    cond = [rows[k] == pieces[k] for k in (*keys, "_bucket")] + [
        (rows["packet_index"] >= pieces["start_index"]) & (rows["packet_index"] < pieces["end_index"])]
    hits = rows.select(*keys, "_bucket", "packet_index").join(
        pieces, cond).select(*[rows[k] for k in keys], rows["packet_index"], "interval_order", "label")
    won = hits.groupBy(*keys, "packet_index").agg(
        F.max_by("label", "interval_order").alias("source_label"))
    return (packets.drop("source_label").join(won, [*keys, "packet_index"], "left")
            .withColumn("source_label", F.coalesce("source_label", F.lit(default))))


def tag_intervals(packets: DataFrame, intervals: DataFrame, keys: Sequence[str] = RECORDING,
                  time: str = "timestamp_s", row_id: str = "packet_index",
                  width: float = SECONDS_PER_BUCKET) -> DataFrame:
    """Packets inside at least one closed time interval, tagged with the first one declared."""
    pieces = _bucketed_intervals(
        intervals.select(*keys, "interval_order", "start_seconds", "end_seconds", "label"),
        F.col("start_seconds"), F.col("end_seconds"), width)
    rows = packets.withColumn("_bucket", time_bucket(time, width).cast("long"))
    cond = [rows[k] == pieces[k] for k in (*keys, "_bucket")] + [
        rows[time].between(pieces["start_seconds"], pieces["end_seconds"])]
    hits = rows.select(*keys, "_bucket", time, row_id).join(pieces, cond).select(
        *[rows[k] for k in keys], rows[row_id], "interval_order", "label")
    first = hits.groupBy(*keys, row_id).agg(F.min_by("label", "interval_order").alias("label"))
    return packets.join(first, [*keys, row_id])


def rescale_annotations(annotations: DataFrame, info: DataFrame, classes: dict,
                        rate_hz: float = 100.0) -> DataFrame:
    """Annotated frames in the recording's own sample positions.

    ``annotations`` hold text; rows whose numbers do not parse or whose class is unknown are
    skipped.  The ratio is ``sample_count / count`` of the first info row, 1 without one.
    """
    ratios = info.groupBy("name").agg(F.min_by(
        F.struct("count", "sample_count"), "row_index").alias("_i"))
    rows = annotations.join(ratios, "name", "left")
    count = F.col("_i.count").try_cast("double")
    ratio = F.when(count != 0, F.col("_i.sample_count").try_cast("double") / count).otherwise(
        F.lit(1.0))
    code = F.col("class").try_cast("double").cast("int")
    names = F.create_map(*[F.lit(x) for kv in classes.items() for x in kv])
    rows = (rows.withColumn("label_id", code)
            .withColumn("label", F.try_element_at(names, code))
            .withColumn("start_index", (F.col("start").try_cast("double") * ratio).cast("float"))
            .withColumn("end_index", (F.col("end").try_cast("double") * ratio).cast("float")))
    rows = rows.where(F.col("label").isNotNull() & F.col("start_index").isNotNull()
                      & F.col("end_index").isNotNull())
    return (rows.withColumn("start_seconds", F.col("start_index").cast("double") / rate_hz)
            .withColumn("end_seconds", F.col("end_index").cast("double") / rate_hz)
            .drop("_i", "class", "start", "end"))


def segment_to_index(segments: DataFrame, recordings: DataFrame,
                     keys: Sequence[str] = RECORDING) -> DataFrame:
    """Segments as index ranges: seconds times rate where that fits, else the numbers as indices."""
    facts = recordings.select(*keys, "source_length", "sample_rate_hz")
    rows = join_facts(segments, facts, list(keys), F.col("segment_id"), how="inner")
    n, rate = F.col("source_length"), F.col("sample_rate_hz")
    low, high = (F.rint(F.col(c) * rate).cast("long") for c in ("start_seconds", "end_seconds"))
    fits = rate.isNotNull() & (rate != 0) & (low >= 0) & (low < n) & (low < high) & (high <= n)

    def clamp(c: str) -> Column:
        return F.greatest(F.lit(0).cast("long"), F.least(F.rint(F.col(c)).cast("long"), n))

    return (rows.withColumn("start_index", F.when(fits, low).otherwise(clamp("start_seconds")))
            .withColumn("end_index", F.when(fits, high).otherwise(clamp("end_seconds")))
            .drop("source_length", "sample_rate_hz"))


def slice_segments(packets: DataFrame, segments: DataFrame, keys: Sequence[str] = RECORDING,
                   width: int = PACKETS_PER_BUCKET) -> DataFrame:
    """The packets of every segment, renumbered from its start; an empty range keeps all packets."""
    ids = ["segment_id", "start_index", "end_index"]
    rows = packets.withColumn("_bucket", F.floor(F.col("packet_index") / F.lit(width)).cast("long"))
    real = segments.where("end_index > start_index").select(*keys, *ids)
    pieces = _bucketed_intervals(real, F.col("start_index"), F.col("end_index") - 1, width)
    cond = [rows[k] == pieces[k] for k in (*keys, "_bucket")] + [
        (rows["packet_index"] >= pieces["start_index"]) & (rows["packet_index"] < pieces["end_index"])]
    cut = rows.join(pieces, cond).select(
        "segment_id", (rows["packet_index"] - pieces["start_index"]).alias("_at"),
        *[rows[c] for c in packets.columns if c != "packet_index"])
    whole = segments.where("end_index <= start_index").select(*keys, "segment_id")
    kept = join_facts(packets, whole, keys, F.col("packet_index"), how="inner").select(
        "segment_id", F.col("packet_index").alias("_at"),
        *[c for c in packets.columns if c != "packet_index"])
    return cut.unionByName(kept).withColumnRenamed("_at", "packet_index")


def clip_or_segments(df: DataFrame, existing: DataFrame | None = None, label: str = "source_label",
                     keys: Sequence[str] = RECORDING) -> DataFrame:
    """Per recording: its single label as clip label, or ``has_segments`` when it has several.

    Padding labels ("") do not count and a clip label that exists already is kept.
    """
    facts = df.where(F.col(label) != "").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("labelled"), F.min(label).alias("_low"), F.max(label).alias("_high"))
    one = F.col("_low") == F.col("_high")
    facts = facts.select(*keys, "labelled", F.when(one, F.col("_low")).alias("clip_label"),
                         (~one).alias("has_segments"))
    if existing is not None:
        facts = (facts.join(existing.select(*keys, F.col("clip_label").alias("_had")),
                            list(keys), "left")
                 .withColumn("clip_label", F.coalesce("_had", "clip_label")).drop("_had"))
    return facts


ENTRY = ("label_key", "recording_id", "sample_index", "start_seconds", "end_seconds", "origin")


def label_catalog(recordings: DataFrame, segments: DataFrame | None = None,
                  runs: DataFrame | None = None, samples: DataFrame | None = None,
                  segment_task: str | None = None, clip_task: str | None = None,
                  renames: dict | None = None) -> DataFrame:
    """Every place a label occurs, under ``task/label`` or ``label``.

    ``recordings``: ``recording_id``, ``clip_label``, ``label_sets MAP<STRING,ARRAY<STRING>>``;
    ``segments`` and ``runs``: label with seconds; ``samples``: ``task``, ``label`` per sample.
    """
    def clean(c) -> Column:
        return T.clean_label(c, renames)

    def keyed(task, label: Column) -> Column:
        named = F.lit(task).cast("string") if task is None or isinstance(task, str) else task
        return F.when(named.isNull(), label).otherwise(F.concat_ws("/", named, label))

    def shaped(df: DataFrame, key: Column, origin: str, sample=None, start=None, end=None):
        none = F.lit(None)
        return df.select(
            key.alias("label_key"), "recording_id",
            (none if sample is None else F.col(sample)).cast("long").alias("sample_index"),
            (none if start is None else F.col(start)).cast("double").alias("start_seconds"),
            (none if end is None else F.col(end)).cast("double").alias("end_seconds"),
            F.lit(origin).alias("origin"))

    sets = (recordings.select("recording_id", F.explode("label_sets").alias("task", "values"))
            .select("recording_id", "task", F.explode("values").alias("value"))
            .withColumn("value", clean("value")).where(F.col("value").isNotNull()))
    out = shaped(sets, keyed(F.col("task"), F.col("value")), "label_sets")
    bare = F.coalesce(F.size("label_sets"), F.lit(0)) <= 0
    clips = recordings.where(bare).withColumn("value", clean("clip_label")).where(
        F.col("value").isNotNull())
    out = out.unionByName(shaped(clips, keyed(clip_task, F.col("value")), "clip"))
    if samples is not None:
        named = samples.withColumn("value", F.coalesce(clean("label"), F.lit("unknown")))
        out = out.unionByName(shaped(named, keyed(F.col("task"), F.col("value")), "sample",
                                     sample="sample_index"))
    for table, origin in ((segments, "segment"), (runs, "run")):
        if table is not None:
            named = table.withColumn("value", clean("label")).where(F.col("value").isNotNull())
            out = out.unionByName(shaped(named, keyed(segment_task, F.col("value")), origin,
                                         start="start_seconds", end="end_seconds"))
    return out


def choose_representative(entries: DataFrame, key: str = "label_key") -> DataFrame:
    """One entry per label: segmented before whole, native before view, fewer labels, longer, first.

    ``entries`` has ``start_seconds``/``end_seconds`` (NULL when whole), ``is_native``,
    ``label_count`` and a total order ``entry_order``.
    """
    segmented = F.col("start_seconds").isNotNull()
    length = F.coalesce(F.col("end_seconds") - F.col("start_seconds"), F.lit(0.0))
    rank = F.struct(segmented.cast("int"), F.col("is_native").cast("int"), -F.col("label_count"),
                    length, -F.col("entry_order"))
    others = [c for c in entries.columns if c != key]
    best = entries.groupBy(key).agg(F.max_by(F.struct(*others), rank).alias("_best"))
    return best.select(key, "_best.*")


__all__ = [
    "checked_intervals", "choose_representative", "clip_or_segments", "label_catalog",
    "label_runs", "longest_run", "numbered_runs", "paint_labels", "rescale_annotations",
    "segment_to_index", "slice_segments", "tag_intervals",
]
