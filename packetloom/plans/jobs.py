"""End-to-end jobs: standardize, create_view and prepare."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.functions import text as T
from packetloom.operators import catalog as C
from packetloom.operators import resample as R
from packetloom.operators import splits as SP
from packetloom.operators import timeline as TL
from packetloom.operators import windows as W
from packetloom.operators.layout import canonicalize_links
from packetloom.operators.quality import quality_report
from packetloom.operators.signal import reference_power_of_cells, relative_power
from packetloom.plans.profiles import ViewOptions, resolve_profile, task_view
from packetloom.plans.registry import DATASET_PROFILES, SOURCE_PATTERNS, split_setting
from packetloom.plans.views import SIGNALS, build_view, describe_clips
from packetloom.session import cut_lineage
from packetloom.sources.discovery import discover_sources, list_files, read_external_split
from packetloom.sources.tables import write_table
from packetloom.sources.text import full_path, read_wide_csv, without_rows

TOOL = "packetloom"


# --- standardize ---------------------------------------------------------------------------

def standardize_packets(packets: DataFrame, rate_hz: float = 100.0, duration_s: float | None = None,
                        bucket_s: float = TL.SECONDS_PER_BUCKET) -> DataFrame:
    """Raw packets on a uniform grid with validity, amplitude and relative power.

    Written are the packets beside their successors and one row of facts a recording.  The grid,
    which may have many points a packet, is neither written nor moved: it is made from the spans
    once for the reference power and once for the result.
    """
    keys = ["recording_id"]
    cleaned = cut_lineage(TL.prepare_time(packets), "cleaned")
    spans = cut_lineage(R.grid_spans(cleaned, bucket_s=bucket_s), "spans")
    gaps = cut_lineage(R.span_gaps(spans), "gaps")
    cells = R.grid_length(R.span_duration(rate_hz, duration_s, "_end"), rate_hz) * F.col("_width")
    sizes = spans.groupBy(*keys).agg(F.max("timestamp_s").alias("_end"), F.max(F.size("csi_real")).alias("_width")).select(
        *keys, cells.alias("_size"))
    reference = reference_power_of_cells(R.valid_cells(spans, gaps, rate_hz, duration_s), sizes)
    facts = cut_lineage(gaps.join(reference, keys, "left"), "facts")
    return relative_power(R.valid_grid(spans, facts, rate_hz, duration_s))


STANDARD_AXES = ("time", "link", "subcarrier")


@dataclass
class Standardized:
    """What ``standardize_files`` makes: packets, one sidecar a recording, and the files that failed."""

    packets: DataFrame
    recordings: DataFrame
    failed: DataFrame


def standardized_recordings(packets: DataFrame, standardized: DataFrame, dataset_id: str, rate_hz: float,
                            checksums: DataFrame | None = None) -> DataFrame:
    """The sidecar rows of standardized recordings, with what a view needs: axes, link counts and rate.

    ``checksums`` has ``recording_id, source_sha256``; files without one keep NULL.
    """
    source = packets.groupBy("recording_id").agg(
        F.first("source_representation").alias("source_representation"),
        F.max("links").alias("links"), F.max("subcarriers").alias("subcarriers"))
    facts = standardized.groupBy("recording_id").agg(
        F.count(F.lit(1)).alias("length"), F.avg(F.col("valid").cast("int")).alias("valid_fraction"))
    rows = facts.join(source, "recording_id")
    if checksums is not None:
        rows = rows.join(checksums, "recording_id", "left")
    else:
        rows = rows.withColumn("source_sha256", F.lit(None).cast("string"))
    return rows.select(
        "recording_id", F.lit("1.0").alias("schema_version"), F.lit(dataset_id).alias("dataset_id"),
        T.file_name("recording_id").alias("source_file"), "source_sha256", "source_representation",
        F.when(F.col("source_representation") == "complex_csi", F.lit("complex_csi")).otherwise(
            F.lit("amplitude_as_real_component")).alias("standard_representation"),
        F.array(*[F.col(c).cast("int") for c in ("length", "links", "subcarriers")]).alias("shape"),
        F.array(*map(F.lit, STANDARD_AXES)).alias("axis_order"), "links", "subcarriers",
        F.lit(float(rate_hz)).alias("sample_rate_hz"),
        (F.col("length") / F.lit(float(rate_hz))).alias("duration_s"), F.lit("s").alias("time_unit"),
        F.lit("dB_relative_to_median_valid_sample_power").alias("power_unit"), "valid_fraction",
        F.array(*map(F.lit, ("packets ordered by time", "one packet kept per timestamp",
                             "real and imaginary parts interpolated linearly", "cropped or padded to one interval",
                             "power relative to the median in dB"))).alias("transformations"),
        F.current_timestamp().alias("created_at"), F.lit(TOOL).alias("tool"))


def source_checksums(spark: SparkSession, path: str | list[str], recordings: DataFrame) -> DataFrame:
    """``recording_id, source_sha256`` of files; NULL for a file that one value cannot hold."""
    files = list_files(spark, path, content=True).select(
        full_path(F.col("path")).alias("_path"), F.sha2("content", 256).alias("source_sha256"))
    # readers name their files percent-encoded
    named = full_path(F.url_decode(F.replace(F.col("recording_id"), F.lit("+"), F.lit("%2B"))))
    return recordings.select("recording_id").distinct().withColumn("_path", named).join(files, "_path", "left").drop("_path")


def standardize_files(spark: SparkSession, path: str | list[str], dataset_id: str, rate_hz: float = 100.0,
                      duration_s: float | None = None) -> Standardized:
    """Wide CSV files to standardized packets and sidecars; a file that cannot be used fails alone.

    It fails by its header, by a cell that is not a number, without data lines, or with fewer than two
    timestamps.  The parsed packets are written once.
    """
    raw = cut_lineage(read_wide_csv(spark, path, strict=False), "raw_packets")
    bad = raw.where("packet_error is not null").groupBy("recording_id").agg(F.min("packet_error").alias("error"))
    short = TL.short_recordings(raw.where("packet_error is null")).select("recording_id", "error")
    empty = without_rows(spark, path, raw).select("recording_id", "error")
    failed = bad.unionByName(short).unionByName(empty).groupBy("recording_id").agg(F.min("error").alias("error"))
    failed = cut_lineage(failed, "failed")
    good = raw.join(failed.select("recording_id"), "recording_id", "left_anti").drop("packet_error")
    done = standardize_packets(good, rate_hz, duration_s)
    sums = source_checksums(spark, path, good)
    return Standardized(done, standardized_recordings(good, done, dataset_id, rate_hz, sums), failed)


def standardize(spark: SparkSession, path: str | list[str], dataset_id: str, rate_hz: float = 100.0,
                duration_s: float | None = None, out: str | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """Wide CSV files to standardized packets and their sidecars, written below ``out`` if given.

    A file that failed raises at the end, when the others are written (``failed`` has their errors).
    """
    made = standardize_files(spark, path, dataset_id, rate_hz, duration_s)
    if out:
        write_table(made.packets.withColumn("dataset_id", F.lit(dataset_id)), f"{out}/packets", sort_by=["recording_id", "packet_index"])
        write_table(made.recordings, f"{out}/recordings")
        write_table(made.failed, f"{out}/failed")
    first = made.failed.orderBy("recording_id").first()
    if first:
        raise ValueError(f"{first['recording_id']}: {first['error']}")
    return made.packets, made.recordings


# --- views ---------------------------------------------------------------------------------

def create_view(packets: DataFrame, recordings: DataFrame, options: ViewOptions,
                channels: tuple | None = None, window_length: DataFrame | None = None,
                clips: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Window rows of a view and its metadata; ``views.build_view`` gives the segments too."""
    view = build_view(packets, recordings, options, channels, window_length, clips)
    return view.windows, view.recordings


# --- prepare -------------------------------------------------------------------------------

@dataclass
class Prepared:
    """The tables a prepare run makes."""

    packets: DataFrame
    recordings: DataFrame
    quality: DataFrame
    windows: DataFrame
    view_recordings: DataFrame
    view_quality: DataFrame
    split: DataFrame
    manifest: DataFrame
    policy: DataFrame
    segments: DataFrame


def view_policy(packets: DataFrame | None, recordings: DataFrame, dataset_id: str, options: ViewOptions | None,
                clips: DataFrame | None = None) -> tuple[ViewOptions, DataFrame, DataFrame]:
    """Options in force, window length per recording, and the policy rows.

    ``clips`` (what ``describe_clips`` gives) saves another pass over the packets.

    Explicit lengths are used as they are; otherwise every recording gets the shortest resampled
    length, at most the profile's, per task for the multi-task benchmark.
    """
    base = resolve_profile(DATASET_PROFILES.get(dataset_id), options)
    clips = describe_clips(packets, recordings) if clips is None else clips
    explicit = options is not None and (options.target_length is not None
                                        or options.duration_s is not None)
    if explicit:
        info = W.target_lengths(clips, base.target_rate_hz, base.duration_s, base.target_length)
        per = info.groupBy("recording_id").agg(F.max("window_length").alias("window_length"))
        return base, per, per.groupBy("window_length").agg(
            F.count(F.lit(1)).alias("source_count")).withColumn("mode", F.lit("explicit"))
    if base.profile == "task-auto":
        rows = task_view(recordings.withColumn("_task", F.try_element_at("labels", F.lit("task"))),
                         "_task", "recording_id", base)
        rows = clips.join(rows.select("recording_id", "task", "target_rate_hz", "profile_max_length"),
                          "recording_id")
        rows = rows.withColumn("rate_length", R.rate_converted_length(
            F.col("source_length"), F.col("source_rate_hz"), F.col("target_rate_hz")))
        shortest = rows.groupBy("task").agg(
            F.min("rate_length").alias("min_resampled_length"),
            F.max("profile_max_length").alias("profile_max_length"),
            F.count(F.lit(1)).alias("source_count"))
        policy = shortest.withColumn("selected_window_length", F.least(
            "min_resampled_length", "profile_max_length")).withColumn("mode", F.lit("task-min"))
        per = rows.select("recording_id", "task").distinct().join(
            policy.select("task", F.col("selected_window_length").alias("window_length")), "task")
        return base, per.select("recording_id", "window_length"), policy
    info = W.target_lengths(clips, base.target_rate_hz)
    policy = W.window_policy(info, base.length_limit).withColumn("mode", F.lit("dataset-min"))
    shortest = policy.first()["selected_window_length"]  # the one number every recording waits for
    per = recordings.select("recording_id", F.lit(shortest).cast("long").alias("window_length"))
    return replace(base, duration_s=None), per, policy


def make_split(inventory: DataFrame, dataset_id: str, setting_id: str | None = None, seed: int = 42,
               ratios=None, holdout=None, external: DataFrame | None = None, check: bool = True
               ) -> DataFrame:
    """The data set's split by one of its settings: ``sample_id``, ``partition``, ``setting``."""
    setting = split_setting(dataset_id, setting_id)
    shares = SP.checked_ratios(ratios, setting["ratios"])
    kind = setting["kind"]
    group = F.col("metadata")[setting["group_by"]] if setting["group_by"] else None
    if kind == "random":
        out = SP.random_split(inventory, shares, seed)
    elif kind == "predefined":
        out = SP.predefined_split(inventory, check)
    elif kind == "group_holdout":
        out = SP.group_holdout(inventory, group, shares, seed, holdout, check, setting["group_by"])
    elif kind == "trial_order":
        out = SP.trial_order_split(inventory, group, check)
    elif kind == "source_groups":
        out = SP.source_groups(inventory, group, check)
    else:
        if external is None:
            raise ValueError(f"official split file not found: {setting['pattern']}")
        out = SP.external_split(external, check).withColumnRenamed("member", "sample_id")
    keep = ["sample_id", "partition"] + (["group"] if "group" in out.columns else [])
    return out.select(*keep).withColumn("setting", F.lit(setting["id"]))


def prepare_packets(packets: DataFrame, recordings: DataFrame, dataset_id: str,
                    options: ViewOptions | None = None, setting: str | None = None, seed: int = 42,
                    ratios=None, holdout=None, overrides: DataFrame | None = None,
                    external: DataFrame | None = None, check: bool = True) -> Prepared:
    """Adapter output to canonical packets, quality, views, split and manifest.

    ``recordings`` rows with an ``error`` are reported as failed and left out of everything else.
    """
    if "error" not in recordings.columns:
        recordings = recordings.withColumn("error", F.lit(None).cast("string"))
    if "sample_index" not in packets.columns:
        packets = packets.withColumn("sample_index", F.lit(0))
    good = recordings.where(F.col("error").isNull())
    packets = packets.join(good.select("recording_id"), "recording_id", "left_semi")
    signals = [s for s in SIGNALS if s in packets.columns]
    if {"links", "dataset_id"} <= set(good.columns):
        packets, good = canonicalize_links(packets, good, signals=signals)
    packets = cut_lineage(packets, "packets")
    quality = quality_report(packets, signals)
    clips = cut_lineage(describe_clips(packets, good), "clips")
    options, length, policy = view_policy(packets, good, dataset_id, options, clips)
    view = build_view(packets, good, options, window_length=length, clips=clips)
    counts = packets.groupBy("recording_id").agg(
        (F.max("sample_index") + 1).alias("sample_count"))
    records = C.conversion_records(recordings.select("recording_id", "error"))
    records = records.join(counts, "recording_id", "left").select(
        F.lit(dataset_id).alias("dataset_id"), F.col("recording_id").alias("source"), "status", "error",
        F.when(F.col("status") == "converted", F.concat(
            F.lit("standardized/views/"), T.safe_stem("recording_id"))).alias("output"),
        F.col("recording_id").alias("source_file"), "sample_count")
    split = make_split(SP.build_inventory(records, overrides), dataset_id, setting, seed, ratios,
                       holdout, external, check)
    return Prepared(packets, good, quality, view.windows, view.recordings,
                    quality_report(view.windows, signals, valid="valid"), split, records, policy, view.segments)


def prepare(spark: SparkSession, dataset_id: str, root: str, out: str,
            adapter: Callable[[SparkSession, list[str]], tuple[DataFrame, DataFrame]],
            options: ViewOptions | None = None, limit: int | None = None, setting: str | None = None,
            seed: int = 42, ratios=None, holdout=None) -> Prepared:
    """Discover sources below ``root``, run the adapter on them and write every table to ``out``.

    The list of source paths goes through the driver, as any Spark read of paths does.
    """
    if dataset_id not in SOURCE_PATTERNS:
        raise ValueError(f"unsupported dataset {dataset_id}; supported: {', '.join(sorted(SOURCE_PATTERNS))}")
    found = discover_sources(list_files(spark, root), SOURCE_PATTERNS[dataset_id], limit)
    paths = [r["path"] for r in found.select("path").orderBy("path").toLocalIterator()]
    if not paths:
        raise FileNotFoundError(f"no recognized source files found in {root}")
    packets, recordings = adapter(spark, paths)
    pattern = split_setting(dataset_id, setting)["pattern"]
    external = None
    if pattern:
        lists = discover_sources(list_files(spark, root), [pattern])
        names = [r["path"] for r in lists.select("path").toLocalIterator()]
        external = read_external_split(spark, names) if names else None
    done = prepare_packets(packets, recordings, dataset_id, options, setting, seed, ratios, holdout,
                           external=external)
    tag = F.lit(dataset_id)
    for name in ("packets", "recordings", "quality", "windows", "view_recordings", "view_quality",
                 "split", "manifest", "policy", "segments"):
        table = getattr(done, name).withColumn("dataset_id", tag)
        write_table(table, f"{out}/{name}", mode="overwrite")
    C.require_success(done.manifest)
    return done
