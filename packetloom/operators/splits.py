"""Deterministic, leakage-safe train, validation and test partitions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.functions.paths import extract_metadata, predefined_split as path_split
from packetloom.functions.text import natural_key
from packetloom.operators.joins import layer_metadata
from packetloom.operators.ordered import explode_range, join_facts

PARTITIONS = ("train", "val", "test")
DEFAULT_RATIOS = (0.7, 0.15, 0.15)  # fixed value: used where neither caller nor setting says
LAST_TRAINING_TRIAL = 14            # fixed value of the trial-order rule
HASH_PREFIX = 3                     # hex digits per rank bucket: 4096 buckets


def checked_ratios(ratios: Sequence[float] | None = None,
                   fallback: Sequence[float] | None = None) -> list[float]:
    chosen = list(ratios or fallback or DEFAULT_RATIOS)
    if len(chosen) != 3 or any(r < 0 for r in chosen) or not math.isclose(
            sum(chosen), 1.0, rel_tol=1e-5, abs_tol=1e-8):
        raise ValueError("ratios must be three non-negative values summing to 1")
    return chosen


def build_inventory(recordings: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """One row per usable sample with its layered metadata.

    ``recordings``: ``status``, ``output``, ``source_file``, ``sample_count`` and optionally
    ``sample_values`` (one map per sample).  Only converted or skipped ones with an output count.
    """
    rows = recordings.where(F.col("status").isin("converted", "skipped") & F.col("output").isNotNull())
    if "sample_values" not in rows.columns:
        rows = rows.withColumn("sample_values", F.lit(None).cast("array<map<string,string>>"))
    # patterns run once per source, before its samples are written out
    rows = extract_metadata(rows, "source_file", "inferred")
    rows = explode_range(rows, F.lit(0).cast("long"), F.col("sample_count").cast("long") - 1, "_i")
    many = F.col("sample_count") > 1
    rows = (rows.withColumn("sample_id", F.when(many, F.concat_ws(
                "::", "output", F.col("_i").cast("string"))).otherwise(F.col("output")))
            .withColumn("index", F.when(many, F.col("_i")))
            .withColumn("sample_values", F.when(many, F.get("sample_values", F.col("_i").cast("int")))))
    if overrides is None:
        overrides = rows.sparkSession.createDataFrame([], "key string, metadata map<string,string>")
    return layer_metadata(rows, overrides).select("sample_id", "source_file", "index", "metadata")


def seeded_rank(df: DataFrame, key: str, seed: int, out: str, counted: Column | None = None,
                total: str = "total", counted_total: str = "counted_total") -> DataFrame:
    """Global 0-based rank in the order of ``md5(key:seed)`` without a global sort.

    With ``counted`` only rows for which it holds take a place.  ``total`` is the number of rows
    and ``counted_total`` that of counted ones.  Only the table of hash prefixes (at most 4096
    rows) is seen as a whole.
    """
    hashed = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    step = F.lit(1) if counted is None else counted.cast("int")
    rows = (df.withColumn("_hash", hashed).withColumn("_step", step.cast("long"))
            .withColumn("_prefix", F.substring("_hash", 1, HASH_PREFIX)))
    ahead = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_prefix").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    prefixes = rows.groupBy("_prefix").agg(F.sum("_step").alias("_c"), F.count(F.lit(1)).alias("_n"))
    prefixes = prefixes.select(
        "_prefix", F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_offset"),
        F.sum("_n").over(everything).alias(total), F.sum("_c").over(everything).alias(counted_total))
    inside = Window.partitionBy("_prefix").orderBy("_hash", key).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("_at", F.sum("_step").over(inside) - 1).join(prefixes, "_prefix")
            .withColumn(out, F.col("_at") + F.col("_offset"))
            .drop("_hash", "_prefix", "_step", "_at", "_offset"))


def largest_remainder(n: Column, ratios: Sequence[float]) -> list[Column]:
    """Exact sizes: floors first, what is left to the largest fractions, earlier ones on ties."""
    exact = [F.lit(float(r)) * n for r in ratios]
    floors = [F.floor(e) for e in exact]
    rest = [e - f for e, f in zip(exact, floors)]
    left = n - sum(floors[1:], floors[0])
    sizes = []
    for i, own in enumerate(rest):
        ahead = F.lit(0)
        for j, other in enumerate(rest):
            if j != i:
                beats = (other > own) | (other == own) if j < i else other > own
                ahead = ahead + beats.cast("int")
        sizes.append(floors[i] + (ahead < left).cast("int"))
    return sizes


def random_split(inventory: DataFrame, ratios: Sequence[float] | None = None, seed: int = 42,
                 key: str = "sample_id") -> DataFrame:
    """Partitions of exact largest-remainder sizes, the same for the same ids and seed."""
    shares = checked_ratios(ratios)
    rows = seeded_rank(inventory, key, seed, "split_rank", total="_n", counted_total="_c")
    train, val, _ = largest_remainder(F.col("_n"), shares)
    return rows.withColumn("partition", F.when(F.col("split_rank") < train, "train").when(
        F.col("split_rank") < train + val, "val").otherwise("test")).drop("_n", "_c")


def _require(missing: DataFrame, column: str, message: str) -> None:
    examples = [r[0] for r in missing.select(column).distinct().orderBy(column).limit(3).collect()]
    if examples:
        raise ValueError(f"{message}: {', '.join(str(e) for e in examples)}")


def predefined_split(inventory: DataFrame, check: bool = True,
                     split: Column | None = None) -> DataFrame:
    """The split the metadata states; a sample without one is an error naming up to three sources."""
    value = split if split is not None else F.col("metadata")["predefined_split"]
    rows = inventory.withColumn("partition", F.when(value.isin(*PARTITIONS), value))
    if check:
        _require(rows.where(F.col("partition").isNull()), "source_file",
                 "official split cannot be inferred for")
    return rows


def group_assignment(groups: DataFrame, group_by: str, ratios: Sequence[float] | None = None,
                     seed: int = 42, holdout: Sequence[str] | None = None) -> DataFrame:
    """Partition of every distinct group: held-out or naturally last for test, a seeded share
    for validation (at least one group if its ratio is positive and two remain), the rest train."""
    shares = checked_ratios(ratios)
    names = groups.select(F.col(group_by).cast("string").alias("group")).distinct()
    if holdout:
        tested = names.withColumn("_test", F.col("group").isin(*[str(h) for h in holdout]))
    else:
        last = names.agg(F.max(F.struct(natural_key("group").alias("k"), "group")).alias("_l"))
        last = last.select(F.col("_l.group").alias("group"), F.lit(True).alias("_test"))
        tested = names.join(last, "group", "left").withColumn(
            "_test", F.coalesce("_test", F.lit(False)))
    rows = seeded_rank(tested, "group", seed, "_rank", ~F.col("_test"), "_groups", "_rest")
    share = F.lit(0) if shares[1] == 0 else F.when(F.col("_rest") < 2, 0).otherwise(
        F.greatest(F.lit(1), F.rint(F.col("_groups") * F.lit(shares[1])).cast("int")))
    return rows.select("group", F.when(F.col("_test"), "test").when(
        F.col("_rank") < share, "val").otherwise("train").alias("partition"))


def group_holdout(inventory: DataFrame, group: Column, ratios: Sequence[float] | None = None,
                  seed: int = 42, holdout: Sequence[str] | None = None,
                  check: bool = True, name: str = "group") -> DataFrame:
    """Whole groups go to one partition.

    Errors: a sample without group, fewer than two groups, an unknown held-out group.
    """
    rows = inventory.withColumn("group", group.cast("string"))
    if check:
        _require(rows.where(F.col("group").isNull()), "source_file", f"{name} metadata missing for")
        few = rows.select("group").distinct().limit(2).collect()
        if len(few) < 2:
            raise ValueError(f"cross-{name} requires at least two distinct groups")
        wanted = {str(h) for h in holdout or ()}
        if wanted:
            known = {r[0] for r in rows.where(F.col("group").isin(*wanted))
                     .select("group").distinct().collect()}
            if wanted - known:
                raise ValueError(f"unknown holdout {name} values {sorted(wanted - known)}")
    assigned = group_assignment(rows.where(F.col("group").isNotNull()), "group", ratios, seed, holdout)
    spread = [c for c in ("sample_id", "source_file") if c in rows.columns]
    return join_facts(rows, assigned, ["group"], F.xxhash64(*spread))


def trial_order_split(inventory: DataFrame, trial: Column, check: bool = True) -> DataFrame:
    """Trials up to the fourteenth train, later ones test; a missing trial is an error."""
    number = trial.try_cast("int")
    rows = inventory.withColumn("partition", F.when(number <= LAST_TRAINING_TRIAL, "train").when(
        number.isNotNull(), "test"))
    if check:
        _require(rows.where(F.col("partition").isNull()), "source_file", "trial metadata missing for")
    return rows


def source_groups(inventory: DataFrame, group: Column, check: bool = True) -> DataFrame:
    """Every group value is its own partition."""
    rows = inventory.withColumn("partition", group.cast("string"))
    if check:
        _require(rows.where(F.col("partition").isNull()), "source_file",
                 "metadata missing for the source groups of")
    return rows


def external_split(members: DataFrame, check: bool = True) -> DataFrame:
    """Official id lists as they stand (see ``sources.discovery.read_external_split``)."""
    if check and members.limit(1).count() == 0:
        raise ValueError("official split file not found")
    return members


def split_manifest(split: DataFrame, setting: str, kind: str, provenance: str = "hub",
                   seed: int = 42, ratios: Sequence[float] | None = None) -> DataFrame:
    """Partition sizes with the settings that made them."""
    counts = split.groupBy("partition").agg(F.count(F.lit(1)).alias("members"))
    shares = checked_ratios(ratios)
    return (counts.withColumn("setting", F.lit(setting)).withColumn("kind", F.lit(kind))
            .withColumn("provenance", F.lit(provenance)).withColumn("seed", F.lit(seed))
            .withColumn("ratios", F.array(*map(F.lit, shares))))


def leaked_groups(split: DataFrame, group: str = "group") -> DataFrame:
    """Groups that occur in more than one partition; empty for a safe split."""
    return (split.select(group, "partition").distinct().groupBy(group)
            .agg(F.count(F.lit(1)).alias("partitions")).where("partitions > 1"))


__all__ = [
    "PARTITIONS", "build_inventory", "checked_ratios", "external_split", "group_assignment",
    "group_holdout", "largest_remainder", "leaked_groups", "path_split", "predefined_split",
    "random_split", "seeded_rank", "source_groups", "split_manifest", "trial_order_split",
]
