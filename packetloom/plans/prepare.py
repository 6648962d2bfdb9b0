"""Prepare a data set by its id: convert what changed, view what is not current, publish at the end.

A run appends its tables below its own ``run_id`` and touches no earlier file.  ``state`` says for every source
which run holds its packets and which its view; the row in ``published`` is written last, so readers see
the whole of a run or the run before it.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.functions import text as T
from packetloom.operators import splits as SP
from packetloom.operators.errors import ERROR
from packetloom.operators.joins import pending_sources
from packetloom.operators.layout import canonicalize_links
from packetloom.operators.ordered import join_facts
from packetloom.operators.quality import quality_report
from packetloom.plans import jobs
from packetloom.plans.profiles import ViewOptions
from packetloom.plans.registry import SOURCE_PATTERNS, split_setting
from packetloom.plans.releases import ID, RELEASES, Release, decoded, describe
from packetloom.plans.views import SEGMENTS, SIGNALS, build_view, describe_clips
from packetloom.session import cut_lineage
from packetloom.sources.discovery import discover_sources, first_characters, folder_sources, list_files, read_external_split
from packetloom.sources.tables import write_table
from packetloom.sources.text import Chosen, full_path, of_chosen

NATIVE, VIEW = ("packets", "recordings", "quality", "clips"), ("windows", "view_recordings", "view_quality", "segments")
STATE = ("source string, length bigint, modified timestamp, native_run string, native_at timestamp, view_run string, "
         "view_at timestamp, view_options string, status string, error string")


@dataclass
class Run:
    run_id: str
    out: str
    state: DataFrame
    split_error: str | None

    def table(self, name: str) -> DataFrame:
        return read_prepared(self.state.sparkSession, self.out, name)


def find_sources(spark: SparkSession, root: str, patterns: list[str], release: Release, limit: int | None = None) -> DataFrame:
    """``path, length, modified`` of the sources of a release below ``root``, in path order for ``limit``."""
    files = list_files(spark, root, empty=True)
    if not release.text and decoded(spark, root, "arrays") is not None:
        paths = decoded(spark, root, "arrays").select("path").distinct()
        stamp = files.where(F.contains("relative_path", F.lit("decoded/"))).agg(F.max("modificationTime"), F.sum("length")).first()
        found = discover_sources(paths.select("path", F.col("path").alias("relative_path")), patterns, limit)
        return found.select("path", F.lit(stamp[1]).cast("bigint").alias("length"), F.lit(stamp[0]).alias("modified"))
    found = discover_sources(files, patterns)
    if release.folders:
        base = F.lit(root.rstrip("/") + "/")
        folders = folder_sources(files, patterns).withColumn("path", F.concat(base, F.col("relative_path")))
        found = found.unionByName(folders.drop("files"), allowMissingColumns=True)
    if release.sniff:
        heads = first_characters(spark, root).where(F.contains("head", F.lit(release.sniff)))
        heads = of_chosen(heads.withColumnRenamed("path", ID), Chosen(root, found), F.xxhash64(ID)).select(F.col(ID).alias("_head"))
        found = found.join(heads, full_path(F.col("path")) == F.col("_head"), "left_semi")
    found = found.orderBy("relative_path").limit(limit) if limit is not None else found
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def published(spark: SparkSession, out: str) -> str | None:
    """The last run that was published."""
    try:
        rows = spark.read.parquet(f"{out}/published")
    except AnalysisException as gone:
        if "PATH_NOT_FOUND" in str(gone.getCondition()):
            return None
        raise
    return rows.agg(F.max("run_id")).first()[0]


def _of_run(spark: SparkSession, out: str, name: str, run_id: str) -> DataFrame:
    return spark.read.parquet(f"{out}/{name}").where(F.col("run_id") == run_id).drop("run_id")


def _held(spark: SparkSession, out: str, name: str, state: DataFrame) -> DataFrame:
    """The rows of a table that the state points to, whichever run wrote them."""
    run = "view_run" if name in VIEW else "native_run"
    if name == "segments":      # may hold no row at all
        rows = spark.read.schema(f"{SEGMENTS}, run_id string").parquet(f"{out}/{name}")
    else:
        rows = spark.read.option("mergeSchema", "true").parquet(f"{out}/{name}")
    wanted = state.where(F.col(run).isNotNull() & F.col(ERROR).isNull()).select(F.col("source").alias(ID), F.col(run).alias("run_id"))
    spread = F.col("packet_index") if "packet_index" in rows.columns else F.xxhash64(ID)
    return join_facts(rows, wanted, [ID, "run_id"], spread, how="inner").drop("run_id")


def read_prepared(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A table of the last published run: ``packets``, ``recordings``, ``quality``, ``clips``, ``windows``, ``view_recordings``,
    ``view_quality``, ``segments``, ``state``, ``split`` or ``policy``."""
    run_id = published(spark, out)
    if run_id is None:
        raise FileNotFoundError(f"nothing was published in {out}")
    if name in (*NATIVE, *VIEW):
        return _held(spark, out, name, _of_run(spark, out, "state", run_id))
    return _of_run(spark, out, name, run_id)


def _append(df: DataFrame, out: str, name: str, run_id: str) -> None:
    write_table(df.withColumn("run_id", F.lit(run_id)), f"{out}/{name}", partition_by=["run_id"], mode="append")


def _convert(spark: SparkSession, dataset_id: str, release: Release, root: str, out: str, sources: DataFrame, run_id: str) -> DataFrame:
    """Packets of ``sources`` to the run's native tables; ``source, error`` of each."""
    raw = cut_lineage(release.packets(spark, root, sources), "raw_packets")
    if "sample_index" not in raw.columns:
        raw = raw.withColumn("sample_index", F.lit(0))
    found = cut_lineage(describe(raw, dataset_id, release), "described")
    good = found.where(F.col(ERROR).isNull()).drop(ERROR)
    listed = sources.select(full_path(F.col("path")).alias("source"))
    errors = listed.join(found.select(F.col(ID).alias("source"), ERROR, F.lit(True).alias("_seen")), "source", "left").select(
        "source", F.coalesce(ERROR, F.when(F.col("_seen").isNull(), F.lit("source has no rows"))).alias(ERROR))
    if good.isEmpty():
        return errors
    packets = join_facts(raw.drop(ERROR), good.select(ID), [ID], F.xxhash64("sample_index", "packet_index"), how="inner")
    signals = [s for s in SIGNALS if s in packets.columns]
    facts = [c for c in ("links", "tx_links", "rx_links") if c in packets.columns]
    packets, good = canonicalize_links(packets.drop(*facts), good, signals=signals)
    _append(packets, out, "packets", run_id)
    packets = spark.read.parquet(f"{out}/packets").where(F.col("run_id") == run_id)
    _append(good, out, "recordings", run_id)
    _append(quality_report(packets, signals), out, "quality", run_id)
    _append(describe_clips(packets, good), out, "clips", run_id)
    return errors


def prepare_dataset(spark: SparkSession, dataset_id: str, root: str, out: str, options: ViewOptions | None = None,
                    limit: int | None = None, force: bool = False, setting: str | None = None, seed: int = 42,
                    ratios=None, holdout=None, check: bool = True) -> Run:
    """Run the data set's release on the sources below ``root``.

    A source is converted when it is new, its size or time changed, it failed before, or with ``force``; a
    view is made when its packets or its options (with the common window length) changed.  A bad source
    fails alone.  With ``check`` failures and a split that cannot be made raise, after the run is published.
    """
    if dataset_id not in RELEASES:
        raise ValueError(f"unsupported dataset {dataset_id}; supported: {', '.join(sorted(RELEASES))}")
    release = RELEASES[dataset_id]
    run_id = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    now = F.timestamp_micros(F.lit(time.time_ns() // 1000))
    found = cut_lineage(find_sources(spark, root, SOURCE_PATTERNS[dataset_id], release, limit), "sources")
    if found.isEmpty():
        raise FileNotFoundError(f"no recognized source files found in {root}")
    last = published(spark, out)
    before = spark.createDataFrame([], STATE) if last is None else _of_run(spark, out, "state", last)
    sources = found.select("path", full_path(F.col("path")).alias("source"), "length", "modified")
    same = before.where(F.col(ERROR).isNull()).select("source", "length", "modified")
    changed = sources if force else sources.join(same, ["source", "length", "modified"], "left_anti")
    changed = cut_lineage(changed, "changed")
    kept = before.where(F.col(ERROR).isNull()).join(sources.select("source"), "source", "left_semi").join(changed.select("source"), "source", "left_anti")
    if not changed.isEmpty():
        errors = _convert(spark, dataset_id, release, root, out, changed, run_id)
        fresh = changed.join(errors, "source").select(
            "source", "length", "modified", F.when(F.col(ERROR).isNull(), F.lit(run_id)).alias("native_run"), now.alias("native_at"),
            F.lit(None).cast("string").alias("view_run"), F.lit(None).cast("timestamp").alias("view_at"),
            F.lit(None).cast("string").alias("view_options"), F.lit("converted").alias("status"), ERROR)
        kept = kept.unionByName(fresh)
    state = cut_lineage(kept, "native_state")
    good = state.where(F.col(ERROR).isNull())
    split_error = None
    if not good.isEmpty():
        state = _views(spark, dataset_id, out, state, before, options, force, run_id, now)
        split_error = _split(spark, dataset_id, root, out, state, setting, seed, ratios, holdout, run_id)
    made = (F.col("native_run") == run_id) | (F.col("view_run") == run_id)
    state = state.withColumn("status", F.when(F.col(ERROR).isNotNull(), "failed").when(made, "converted").otherwise("skipped"))
    _append(state, out, "state", run_id)
    done = spark.createDataFrame([(run_id, dataset_id, split_error)], "run_id string, dataset_id string, split_error string").coalesce(1)
    done.write.mode("append").parquet(f"{out}/published")
    state = _of_run(spark, out, "state", run_id)
    if check:
        jobs.C.require_success(state)
        if split_error:
            raise ValueError(f"the sources are converted and published, but no split was made: {split_error}")
    return Run(run_id, out, state, split_error)


def _views(spark: SparkSession, dataset_id: str, out: str, state: DataFrame, before: DataFrame, options: ViewOptions | None,
           force: bool, run_id: str, now) -> DataFrame:
    """Make the views that are not current; the state with where each view is."""
    recordings, clips = _held(spark, out, "recordings", state), _held(spark, out, "clips", state)
    base, per, policy = jobs.view_policy(None, recordings, dataset_id, options, clips)
    per = cut_lineage(per, "window_lengths")
    _append(policy, out, "policy", run_id)
    chosen = F.concat_ws("; ", *[F.lit(f"{k}={v}") for k, v in sorted(asdict(base).items()) if v is not None],
                         F.concat(F.lit("window_length="), F.col("window_length").cast("string")))
    wanted = state.where(F.col(ERROR).isNull()).drop("view_options").join(per.select(F.col(ID).alias("source"), chosen.alias("view_options")), "source").select(
        "source", "view_options", F.col("native_at").alias("modified"))
    made = before.where("view_run is not null").select("source", "view_options", F.col("view_at").alias("output_modified"),
                                                       F.lit(True).alias("full_source_preserved"))
    pending = cut_lineage(pending_sources(wanted, made, force).select("source", "view_options"), "pending_views")
    if not pending.isEmpty():
        todo = state.join(pending.select("source"), "source", "left_semi")
        packets = _held(spark, out, "packets", todo)
        signals = [s for s in SIGNALS if s in packets.columns]
        lengths = per.join(pending.select(F.col("source").alias(ID)), ID, "left_semi")
        view = build_view(packets, _held(spark, out, "recordings", todo), base, window_length=lengths,
                          clips=_held(spark, out, "clips", todo))
        _append(view.windows, out, "windows", run_id)
        _append(view.recordings, out, "view_recordings", run_id)
        _append(view.segments, out, "segments", run_id)
        windows = spark.read.parquet(f"{out}/windows").where(F.col("run_id") == run_id)
        _append(quality_report(windows, signals, valid="valid"), out, "view_quality", run_id)
    fresh = pending.select("source", F.col("view_options").alias("_options"), F.lit(run_id).alias("_run"))
    rows = state.join(fresh, "source", "left")
    new = F.col("_run").isNotNull()
    rows = rows.withColumns({"view_options": F.coalesce("_options", "view_options"), "view_run": F.coalesce("_run", "view_run"),
                             "view_at": F.when(new, now).otherwise(F.col("view_at"))}).drop("_options", "_run")
    return cut_lineage(rows, "view_state")


def _split(spark: SparkSession, dataset_id: str, root: str, out: str, state: DataFrame, setting, seed, ratios, holdout, run_id: str) -> str | None:
    """Write the split of all sources in good order; what stands in its way otherwise."""
    counts = _held(spark, out, "clips", state).groupBy(ID).agg((F.max("sample_index") + 1).alias("sample_count"))
    records = state.where(F.col(ERROR).isNull()).join(counts, F.col("source") == F.col(ID)).select(
        F.lit(dataset_id).alias("dataset_id"), "source", F.lit("converted").alias("status"), ERROR,
        F.concat(F.lit("standardized/views/"), T.safe_stem("source")).alias("output"), F.col("source").alias("source_file"), "sample_count")
    try:
        pattern = split_setting(dataset_id, setting)["pattern"]
        external = None
        if pattern:
            lists = discover_sources(list_files(spark, root), [pattern])
            names = [r["path"] for r in lists.select("path").toLocalIterator()]      # official lists, one or two files
            external = read_external_split(spark, names) if names else None
        split = jobs.make_split(SP.build_inventory(records), dataset_id, setting, seed, ratios, holdout, external)
        _append(split, out, "split", run_id)
    except ValueError as problem:
        return str(problem)
    return None
