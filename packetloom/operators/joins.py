"""Joins between packets, companions, annotations, registries and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions import text as T
from packetloom.operators.ordered import join_facts


def pair_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
              values: tuple[str, str]) -> DataFrame:
    """Rows of two companion tables by their keys.

    A row without partner or with a partner of another width keeps its place with an ``error``.
    """
    a, b = values
    rows = left.join(right, list(keys), "full_outer")
    return rows.withColumn("error", F.when(
        F.col(a).isNull() | F.col(b).isNull(), F.lit("matching companion row not found")).when(
        F.size(a) != F.size(b), F.lit("companion shapes differ")))


def positional_join(data: DataFrame, labels: DataFrame, keys: Sequence[str] = ("recording_id",),
                    index: str = "row_index", truncate: bool = False) -> DataFrame:
    """Data row i with label row i.

    ``truncate`` drops labels behind the last data row; otherwise a surplus or missing label
    is a row with an ``error``.
    """
    how = "left" if truncate else "full_outer"
    rows = data.withColumn("_data", F.lit(True)).join(
        labels.withColumn("_label", F.lit(True)), [*keys, index], how)
    mismatch = F.lit(False) if truncate else F.col("_data").isNull() | F.col("_label").isNull()
    return rows.withColumn("error", F.when(mismatch, F.lit("data and label counts differ"))
                           ).drop("_data", "_label")


def label_file_name(name: Column) -> Column:
    """``X_train.csv`` is labelled by ``y_train.csv``; other names label themselves."""
    return F.regexp_replace(name, "^[Xx]_", "y_")


def ancestors(path: Column) -> Column:
    """Every folder above a file, with its depth."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, F.transform(
        F.sequence(F.lit(1), F.size(parts) - 1),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("folder")))
    ).otherwise(F.array().cast("array<struct<depth:int,folder:string>>"))


def annotation_join(recordings: DataFrame, annotations: DataFrame, path: str = "path") -> DataFrame:
    """The annotation row of a file: nearest folder above it that holds annotations, first row
    whose ``label`` is the file's stem.  Files without one keep NULLs.

    ``annotations``: ``folder``, ``row_index``, ``label`` and further columns.
    """
    extra = [c for c in annotations.columns if c not in ("folder", "row_index", "label")]
    folders = annotations.select("folder").distinct()
    above = recordings.select(path, F.explode(ancestors(F.col(path))).alias("_a")).select(
        path, F.col("_a.depth").alias("_depth"), F.col("_a.folder").alias("folder"))
    nearest = (join_facts(above, folders, ["folder"], F.xxhash64(path), how="inner").groupBy(path)
               .agg(F.max_by("folder", "_depth").alias("folder")))
    first = annotations.groupBy("folder", "label").agg(
        F.min_by(F.struct(*extra), "row_index").alias("_row"))
    found = (nearest.withColumn("label", T.file_stem(path)).join(first, ["folder", "label"])
             .select(path, F.col("folder").alias("annotation_folder"), "_row.*"))
    return recordings.join(found, path, "left")


def layer_maps(*layers: Column) -> Column:
    """Merge maps, later ones win; no session setting needed."""
    empty = F.create_map().cast("map<string,string>")

    def over(base: Column, later: Column) -> Column:
        kept = F.map_filter(base, lambda k, v: ~F.map_contains_key(later, k))
        return F.map_concat(kept, later)

    out = F.coalesce(layers[0], empty)
    for layer in layers[1:]:
        out = over(out, F.coalesce(layer, empty))
    return out


def layer_metadata(inventory: DataFrame, overrides: DataFrame) -> DataFrame:
    """Inferred < file override (relative path, else bare name) < per-sample values < sample override.

    ``inventory``: ``sample_id``, ``source_file``, ``inferred`` and ``sample_values`` maps;
    ``overrides``: ``key``, ``metadata``; the last row of a repeated key counts.
    """
    by_path = overrides.select(F.col("key").alias("source_file"), F.col("metadata").alias("_path"))
    by_name = overrides.select(F.col("key").alias("_name"), F.col("metadata").alias("_bare"))
    by_id = overrides.select(F.col("key").alias("sample_id"), F.col("metadata").alias("_sample"))
    spread = F.hash("sample_id")  # one file may hold very many samples
    rows = inventory.withColumn("_name", T.file_name("source_file"))
    rows = join_facts(rows, by_path, ["source_file"], spread)
    rows = join_facts(rows, by_name, ["_name"], spread).join(by_id, "sample_id", "left")
    merged = layer_maps(F.col("inferred"), F.coalesce("_path", "_bare"), F.col("sample_values"),
                        F.col("_sample"))
    return rows.withColumn("metadata", merged).drop("_name", "_path", "_bare", "_sample")


def config_key(c: Column) -> Column:
    text = F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "_")
    return F.regexp_replace(text, "^_+|_+$", "")


def attach_config(recordings: DataFrame, pairs: DataFrame, keys: Sequence[str] = ("recording_id",)
                  ) -> DataFrame:
    """Key/value rows of a config file as one map; of a repeated key the last row counts.

    A config group is bounded by the distinct keys of one file.
    """
    named = pairs.withColumn("_k", config_key(F.col("key"))).where(F.col("_k") != "")
    last = named.groupBy(*keys, "_k").agg(F.max_by(F.trim("value"), "row_index").alias("_v"))
    maps = last.groupBy(*keys).agg(F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("_k", "_v")))).alias("config"))
    return recordings.join(maps, list(keys), "left")


def coverage_diff(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Ids missing from ``found`` and ids that only ``found`` has."""
    a, b = expected.select(key).distinct(), found.select(key).distinct()
    return (a.join(b, key, "left_anti").withColumn("problem", F.lit("missing"))
            .unionByName(b.join(a, key, "left_anti").withColumn("problem", F.lit("extra"))))


def check_manifest(records: DataFrame, members: DataFrame, files: DataFrame) -> DataFrame:
    """Outputs and split members without a file.  Members may be ``path::sample``."""
    have = files.select(F.col("path").alias("_have")).distinct()
    outputs = records.where(F.col("output").isNotNull()).select(F.col("output").alias("path"))
    paths = members.select(F.substring_index("member", "::", 1).alias("path"))
    lost = outputs.withColumn("kind", F.lit("output")).unionByName(
        paths.withColumn("kind", F.lit("split member")))
    return lost.join(have, F.col("path") == F.col("_have"), "left_anti")


def manifest_ok(records: DataFrame, missing: DataFrame) -> DataFrame:
    """One row: counts, and whether the run may be used."""
    facts = records.select(F.col("status").alias("fact")).unionByName(
        missing.select(F.col("kind").alias("fact")))
    names = {"converted": "converted", "skipped": "skipped", "failed": "failed",
             "missing_outputs": "output", "missing_members": "split member"}
    counts = facts.agg(*[F.count_if(F.col("fact") == v).alias(k) for k, v in names.items()])
    return counts.withColumn("ok", (F.col("converted") > 0) & (F.col("failed") == 0)
                           & (F.col("missing_outputs") == 0) & (F.col("missing_members") == 0))


def coverage_join(plan: DataFrame, records: DataFrame, wrapper: str) -> DataFrame:
    """Planned paths with the record that holds them; records may sit in one extra folder.

    Where both forms exist, the one listed last counts.
    """
    direct = records.withColumn("expected_path", T.unix_path("path"))
    inner = direct.where(F.startswith("expected_path", F.lit(wrapper + "/"))).withColumn(
        "expected_path", F.substr("expected_path", F.lit(len(wrapper) + 2)))
    forms = direct.unionByName(inner)
    others = [c for c in records.columns]
    last = forms.groupBy("expected_path").agg(
        F.max_by(F.struct(*others), "record_order").alias("_r"))
    return plan.join(last, "expected_path").select(*plan.columns, "_r.*")


def enrich_catalog(catalog: DataFrame, adapters: DataFrame, splits: DataFrame, examples: DataFrame,
                   plans: DataFrame | None = None, collections: DataFrame | None = None) -> DataFrame:
    """Catalog entries with their registries.

    Adapters, splits and examples are mandatory (inner joins), plans optional, and a collection
    only fills an entry that has none.  Registry tables are ``(id, <payload>)``.
    """
    rows = catalog.join(adapters, "id").join(splits, "id").join(examples, "id")
    if plans is not None:
        rows = rows.join(plans, "id", "left")
    if collections is not None:
        rows = rows.join(collections.withColumnRenamed("collection", "_collection"), "id", "left")
        own = F.col("collection") if "collection" in catalog.columns else F.lit(None)
        rows = rows.withColumn("collection", F.coalesce(own, F.col("_collection"))).drop("_collection")
    return rows


def pending_sources(sources: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """Sources whose output is not current.

    Current: made with the same view options, not older than the source, full source kept.
    ``sources``: ``source``, ``view_options``, ``modified``; ``manifest``: ``source``,
    ``view_options``, ``output_modified``, ``full_source_preserved``.
    """
    if force:
        return sources
    done = manifest.where("full_source_preserved").groupBy("source", "view_options").agg(
        F.max("output_modified").alias("output_modified"))
    s, d = sources.alias("s"), done.alias("d")
    return s.join(d, (F.col("s.source") == F.col("d.source"))
                  & (F.col("s.view_options") == F.col("d.view_options"))
                  & (F.col("d.output_modified") >= F.col("s.modified")), "left_anti")


def check_companions(files: DataFrame, required: Sequence[str], optional: Sequence[str] = (),
                     session: str = "session", name: str = "name") -> DataFrame:
    """Per session: which required files are missing and which optional ones are there."""
    wanted = files.where(F.col(name).isin(*required, *optional))
    have = (files.select(session).distinct().join(
        wanted.groupBy(session).agg(F.collect_set(name).alias("_have")), session, "left"))
    held = F.coalesce("_have", F.array().cast("array<string>"))
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, required)), held))
    extra = F.array(*map(F.lit, optional)) if optional else F.array().cast("array<string>")
    return (have.withColumn("missing", missing)
            .withColumn("optional_present", F.array_sort(F.array_intersect(extra, held)))
            .withColumn("error", F.when(F.size("missing") > 0, F.concat(
                F.lit("expected session files missing: "), F.col(session).cast("string"))))
            .drop("_have"))


def first_per_group(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The first row of each group by a total order, reduced map-side."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("_row")).select(
        *keys, "_row.*")
