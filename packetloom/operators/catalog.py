"""Searching, counting and validating catalogs and registries held as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.operators.joins import coverage_diff
from packetloom.operators.ordered import join_facts

# What a catalog entry must have and which words its registries may use.
REQUIRED_FIELDS = ("id", "name", "year", "summary", "tasks", "modalities", "hardware", "settings",
                   "scale", "original", "standardization", "sources", "verified_at")
HANDLERS = ("generic", "official-profile", "aril", "ut-har", "wallhack18k", "wiar-intel5300",
            "xrf-v2")
TIERS = ("reference-implemented", "schema-implemented", "format-profile")
SPLIT_KINDS = ("random", "predefined", "group_holdout", "trial_order", "external_json",
               "source_groups")
GROUPED_KINDS = ("group_holdout", "trial_order", "source_groups")
PROVENANCES = ("official", "paper", "hub")
EXAMPLE_FIELDS = ("source_path", "primary_array", "expected_shape", "note")
URL_PATTERN = r"^https?://[^/?#\s]+"


def is_url(c: Column) -> Column:
    return F.coalesce(F.lower(c).rlike(URL_PATTERN), F.lit(False))


def search_catalog(df: DataFrame, task: str = "", access: str = "", query: str = "",
                   tasks: str = "tasks", access_column: str = "access") -> DataFrame:
    """Entries of a task AND an access class AND containing the text anywhere; empty means all.

    ``tasks`` is an array column or a single-valued one.
    """
    rows = df
    if task:
        many = df.schema[tasks].dataType.typeName() == "array"
        rows = rows.where(F.array_contains(tasks, task) if many else F.col(tasks) == task)
    if access:
        rows = rows.where(F.col(access_column) == access)
    if query.strip():
        record = F.lower(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
        rows = rows.where(F.contains(record, F.lit(query.strip().lower())))
    return rows


def catalog_stats(catalog: DataFrame, tasks: DataFrame, platform: Column, access: Column
                  ) -> DataFrame:
    """One row: entries, tasks, distinct platforms, directly accessible entries."""
    entries = catalog.select(F.lit(True).alias("entry"), platform.cast("string").alias("platform"),
                             access.alias("access"))
    named = tasks.select(F.lit(False).alias("entry"), F.lit(None).cast("string").alias("platform"),
                         F.lit(None).cast("string").alias("access"))
    return entries.unionByName(named).agg(
        F.count_if("entry").alias("datasets"), F.count_distinct("platform").alias("hardware_platforms"),
        F.count_if(F.col("access") == "direct").alias("open_or_direct"),
        F.count_if(~F.col("entry")).alias("tasks"))


def task_counts(catalog: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    counts = catalog.select(F.explode("tasks").alias("task")).groupBy("task").agg(
        F.count(F.lit(1)).alias("dataset_count"))
    if tasks is None:
        return counts
    return tasks.select(F.col("id").alias("task")).join(counts, "task", "left").withColumn(
        "dataset_count", F.coalesce("dataset_count", F.lit(0).cast("long")))


def catalog_rollup(df: DataFrame, facets: Sequence[str]) -> DataFrame:
    """Counts by each facet on its own, in one pass with grouping sets."""
    sets = [[F.col(f)] for f in facets]
    grouped = df.groupingSets(sets, *[F.col(f) for f in facets]).agg(
        F.count(F.lit(1)).alias("entries"), F.grouping_id().alias("_g"))
    n, facet, value = len(facets), F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, f in enumerate(facets):
        here = F.col("_g") == (2 ** n - 1) - 2 ** (n - 1 - i)
        facet = F.when(here, F.lit(f)).otherwise(facet)
        value = F.when(here, F.col(f).cast("string")).otherwise(value)
    return grouped.select(facet.alias("facet"), value.alias("value"), "entries")


def violations(df: DataFrame, id_column: str, rules: Mapping[str, Column]) -> DataFrame:
    """One row per broken rule.  A rule is the condition that must hold; NULL counts as broken."""
    broken = F.array_compact(F.array(*[
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return df.select(F.col(id_column).cast("string").alias("id"),
                     F.explode(broken).alias("violation"))


def duplicate_ids(df: DataFrame, id_column: str, order: Sequence[str]) -> DataFrame:
    """Every occurrence of an id but the first, by a total order.

    The first one is an aggregate, so an id that many rows share is never gathered.
    """
    place = F.struct(*order)
    first = df.groupBy(id_column).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = first.where("_n > 1").drop("_n")
    rows = join_facts(df, first, [id_column], F.xxhash64(*order), how="inner")
    return rows.where(place > F.col("_first")).drop("_first")


def validate_catalog(catalog: DataFrame, tasks: DataFrame, file: str = "file") -> DataFrame:
    """Violations of catalog entries: ``(file, violation)``.

    Fields missing altogether are reported for every entry, NULL ones for the entry.
    """
    rules: dict[str, Column] = {}
    for f in REQUIRED_FIELDS:
        rules[f"missing field {f}"] = (F.col(f).isNotNull() if f in catalog.columns
                                       else F.lit(False))
    sources = F.col("sources") if "sources" in catalog.columns else F.lit(None)
    rules["at least one source is required"] = F.coalesce(F.size(sources), F.lit(0)) > 0
    rules["invalid source URL"] = F.coalesce(F.forall(sources, lambda s: is_url(s["url"])), F.lit(True))
    rules["invalid landing page"] = is_url(F.col("original.landing_page"))
    out = violations(catalog, file, rules)
    again = duplicate_ids(catalog, "id", [file]).select(
        F.col(file).cast("string").alias("id"),
        F.concat(F.lit("duplicate id "), F.col("id")).alias("violation"))
    named = catalog.select(F.col(file).cast("string").alias("id"), F.explode("tasks").alias("task"))
    strange = named.join(tasks.select(F.col("id").alias("task")).distinct(), "task", "left_anti").select(
        "id", F.concat(F.lit("unknown task "), "task").alias("violation"))
    return out.unionByName(again).unionByName(strange).withColumnRenamed("id", "file")


def validate_adapters(registry: DataFrame, catalog: DataFrame) -> DataFrame:
    """``registry``: id, handler, patterns, implementation, official_reference."""
    ids = catalog.select(F.col("id").alias("_own")).distinct()
    rows = registry.join(ids, F.col("handler") == F.col("_own"), "left")
    out = violations(rows, "id", {
        "unknown handler": F.col("handler").isin(*HANDLERS) | F.col("_own").isNotNull(),
        "no source patterns": F.coalesce(F.size("patterns"), F.lit(0)) > 0,
        "invalid implementation tier": F.col("implementation").isin(*TIERS),
        "no valid official reference": is_url(F.col("official_reference")),
    })
    return out.unionByName(registry_gaps(registry, catalog))


def validate_splits(registry: DataFrame, catalog: DataFrame) -> DataFrame:
    """``registry``: id, default, settings array of (id, kind, provenance, group_by)."""
    ids = F.transform("settings", lambda s: s["id"])
    out = violations(registry, "id", {
        "invalid default": (F.size("settings") > 0) & F.array_contains(ids, F.col("default")),
        "duplicate setting ids": F.size(F.array_distinct(ids)) == F.size(ids),
    })
    each = registry.select("id", F.explode("settings").alias("s")).select(
        F.concat_ws("/", "id", "s.id").alias("id"), "s.kind", "s.provenance", "s.group_by")
    per_setting = violations(each, "id", {
        "unknown kind": F.col("kind").isin(*SPLIT_KINDS),
        "invalid provenance": F.col("provenance").isin(*PROVENANCES),
        "needs group_by": ~F.col("kind").isin(*GROUPED_KINDS)
        | (F.coalesce("group_by", F.lit("")) != ""),
    })
    return out.unionByName(per_setting).unionByName(registry_gaps(registry, catalog))


def registry_gaps(registry: DataFrame, catalog: DataFrame) -> DataFrame:
    gaps = coverage_diff(catalog, registry, "id")
    return gaps.select(F.col("id").cast("string").alias("id"), F.concat(
        F.col("problem"), F.lit(" registry entry")).alias("violation"))


def validate_examples(examples: DataFrame, fields: Sequence[str] = EXAMPLE_FIELDS) -> DataFrame:
    return violations(examples, "id", {
        f"invalid {f}": F.trim(F.col(f)) != "" for f in fields})


def check_constraints(df: DataFrame, id_column: str, spec: Mapping[str, Mapping]) -> DataFrame:
    """Declarative constraints, one ``(id, violation)`` row per breach.

    Per column (dots reach into structs): ``required``, ``enum``, ``const``, ``pattern``,
    ``min_length``, ``minimum``, ``maximum``, ``exclusive_minimum``, ``min_items``,
    ``unique_items``, ``item_minimum``, ``date``.  A NULL breaks only ``required``.
    """
    checks = {
        "enum": lambda c, v: c.isin(*v),
        "const": lambda c, v: c == F.lit(v),
        "pattern": lambda c, v: c.rlike(v),
        "min_length": lambda c, v: F.char_length(c) >= v,
        "minimum": lambda c, v: c >= F.lit(v),
        "maximum": lambda c, v: c <= F.lit(v),
        "exclusive_minimum": lambda c, v: c > F.lit(v),
        "min_items": lambda c, v: F.size(c) >= v,
        "unique_items": lambda c, v: F.size(F.array_distinct(c)) == F.size(c),
        "item_minimum": lambda c, v: F.forall(c, lambda x: x >= v),
        "date": lambda c, v: c.cast("string").try_cast("date").isNotNull(),
    }
    rules: dict[str, Column] = {}
    for name, constraints in spec.items():
        value = F.col(name)
        for kind, arg in constraints.items():
            if kind == "required":
                if arg:
                    rules[f"{name}: required"] = value.isNotNull()
            elif kind in checks:
                rules[f"{name}: {kind}"] = value.isNull() | checks[kind](value, arg)
            else:
                raise ValueError(f"unknown constraint {kind} for {name}")
    return violations(df, id_column, rules)


# The constraints of catalog entries and of recording sidecars.
CATALOG_CONSTRAINTS = {
    "id": {"required": True, "pattern": "^[a-z0-9][a-z0-9-]+$"},
    "name": {"required": True, "min_length": 2},
    "year": {"required": True, "minimum": 2010, "maximum": 2100},
    "summary": {"required": True, "min_length": 20},
    "tasks": {"required": True, "min_items": 1, "unique_items": True},
    "modalities": {"required": True, "min_items": 1},
    "hardware.platform": {"required": True},
    "settings.scenario": {"required": True},
    "original.landing_page": {"required": True},
    "original.access": {"required": True, "enum": ["direct", "account", "application", "unclear"]},
    "original.license": {"required": True},
    "original.redistribution": {"required": True, "enum": ["allowed", "restricted", "unclear"]},
    "original.formats": {"required": True},
    "standardization.status": {"required": True, "enum": ["planned", "adapter-ready", "verified"]},
    "standardization.profile": {"required": True},
    "standardization.notes": {"required": True},
    "sources": {"required": True, "min_items": 1},
    "verified_at": {"required": True, "date": True},
}
SIDECAR_CONSTRAINTS = {
    "schema_version": {"required": True, "const": "1.0"},
    "dataset_id": {"required": True},
    "source_file": {"required": True},
    "source_sha256": {"pattern": "^[a-f0-9]{64}$"},
    "source_representation": {"required": True, "enum": [
        "complex_csi", "amplitude_only", "amplitude_phase", "processed_amplitude",
        "processed_bvp", "raw_iq"]},
    "standard_representation": {"required": True},
    "shape": {"required": True, "min_items": 3, "item_minimum": 1},
    "sample_rate_hz": {"exclusive_minimum": 0},
    "duration_s": {"exclusive_minimum": 0},
    "power_unit": {"required": True},
    "valid_fraction": {"minimum": 0, "maximum": 1},
    "transformations": {"required": True},
    "created_at": {"required": True},
    "tool": {"required": True},
}


def with_rejects(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and failed ones with the first error text; nothing is lost and nothing raises.

    A check is the condition that must hold.
    """
    error = F.lit(None).cast("string")
    for text, ok in reversed(checks.items()):
        error = F.when(~F.coalesce(ok, F.lit(False)), F.lit(text)).otherwise(error)
    rows = df.withColumn("error", error)
    return rows.where(F.col("error").isNull()).drop("error"), rows.where(F.col("error").isNotNull())


def conversion_records(rows: DataFrame, error: str = "error") -> DataFrame:
    """Status per source: ``failed`` with its text, else ``converted``."""
    return rows.withColumn("status", F.when(F.col(error).isNotNull(), "failed").otherwise("converted"))


def require_success(records: DataFrame) -> None:
    """Raise at the end of a run when any source failed or there was none."""
    counts = records.agg(F.count(F.lit(1)).alias("n"),
                         F.count_if(F.col("status") == "failed").alias("failed")).first()
    if counts["n"] == 0:
        raise FileNotFoundError("no recognized source files found")
    if counts["failed"]:
        raise RuntimeError(f"{counts['failed']} conversion(s) failed; see the manifest")
