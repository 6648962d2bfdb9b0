"""Small representative subsets: heads, one per class, stratified picks and set covers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.operators.ordered import index_bucket, with_position
from packetloom.operators.segments import tag_intervals
from packetloom.session import cut_lineage, scratch_path


def head_per_group(df: DataFrame, keys: Sequence[str], n: int,
                   order_by: Sequence[str] = ("packet_index",)) -> DataFrame:
    """The first ``n`` rows of every group.

    Spark ranks inside the map task first (window group limit), so a hot group sends at most
    ``n`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def capture_intervals(packets: DataFrame, intervals: DataFrame, cap: int,
                      keys: Sequence[str] = ("recording_id",), time: str = "timestamp_s",
                      row_id: str = "packet_index", width: float = 60.0) -> DataFrame:
    """Packets inside labelled intervals, first matching interval each, at most ``cap`` per label.

    The latest interval end is pushed to the scan as a filter.
    """
    end = intervals.agg(F.max("end_seconds")).first()[0]
    inside = packets if end is None else packets.where(F.col(time) <= F.lit(end))
    tagged = tag_intervals(inside, intervals, keys, time, row_id, width)
    return head_per_group(tagged, ["label"], cap, [time, *keys, row_id])


def missing_labels(captured: DataFrame, intervals: DataFrame) -> DataFrame:
    return intervals.select("label").distinct().join(
        captured.select("label").distinct(), "label", "left_anti")


def completeness(found: DataFrame, declared: DataFrame, key: str, message: str) -> DataFrame:
    """Every declared value of ``key`` with its number of rows in ``found``, and ``error`` where it has none.

    For labels that must get a packet, and for locations and gestures that must be among the picks.
    Null counts as a value; values of ``found`` that nothing declares are left out.
    """
    counts = found.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    rows = declared.select(key).distinct().join(counts, F.col(key).eqNullSafe(F.col("_key")), "left")
    return rows.select(key, F.coalesce("_n", F.lit(0)).cast("long").alias("rows"), F.when(
        F.col("_n").isNull(), F.concat_ws(": ", F.lit(message), F.col(key).cast("string"))).alias("error"))


def coverage_plan(plan: DataFrame, metadata_name: str = "metadata/label_mapping.json") -> DataFrame:
    """Per task its mapping file and then its files, each once in first-seen order.

    ``plan``: ``task``, ``position``, ``file``.
    """
    first = plan.groupBy("task", "file").agg(F.min("position").alias("position"))
    ranked = with_position(first.withColumn("_bucket", index_bucket("position")), ["task"],
                           ["position", "file"], "_bucket", "file_order").select(
        "task", "file", (F.col("file_order") + 1).alias("file_order"))
    mapping = first.select("task").distinct().select(
        "task", F.concat_ws("/", "task", F.lit(metadata_name)).alias("file"),
        F.lit(0).cast("long").alias("file_order"))
    return mapping.unionByName(ranked)


def clip_per_action(actions: DataFrame, subject: int = 1, repetition: int = 1) -> DataFrame:
    """The planned clip name ``subject_action_repetition.npy`` of every action id."""
    if subject < 1 or repetition < 1:
        raise ValueError("subject and repetition must be positive")
    return actions.withColumn("file", F.format_string(
        f"{subject:02d}_%02d_{repetition:02d}.npy", F.col("action_id").cast("int")))


def pick_per_class(items: DataFrame, key: str, order: Column) -> DataFrame:
    """One item per class, the first by ``order`` (smallest size, lowest index)."""
    others = [c for c in items.columns if c != key]
    return items.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("_row")).select(
        key, "_row.*")


def class_coverage(picked: DataFrame, documented: DataFrame, key: str) -> DataFrame:
    """Documented classes without any item."""
    return documented.select(key).distinct().join(picked.select(key), key, "left_anti")


def stratified_pick(items: DataFrame, stratum: str, target: Column, value: str,
                    index: str = "index") -> DataFrame:
    """Per stratum the first item whose ``value`` is the wanted one, else the stratum's first."""
    preferred = F.struct(F.when(F.col(value) == target, 0).otherwise(1), F.col(index))
    return pick_per_class(items, stratum, preferred)


def _first_of_equal(table: DataFrame) -> DataFrame:
    """Of the items with one set of features ``f`` the first: the others gain nothing after it."""
    return (table.groupBy(F.array_sort("f").alias("f")).agg(F.min(F.struct("o", "id")).alias("_first"))
            .select("_first.id", "_first.o", "f"))


def cover_steps(items: DataFrame, features: str, order: Column, required: DataFrame | None = None
                ) -> DataFrame:
    """``step, id, gain``: few items that together carry every feature, in the order a greedy picks them.

    A greedy takes the item with the most uncovered features, the smallest ``order`` and ``id`` on
    ties.  An item that comes first, by that rule, for each of its uncovered features is picked
    before anything that shares a feature with it, so all such items are taken in one round; sorted
    by the rule, the picks of all rounds are those of the greedy, one by one.  Items and uncovered
    features stay tables, and the driver learns only whether a round had any.

    ``items``: ``id`` and the array column ``features`` (null arrays and null elements carry
    nothing, rows that repeat an id and its order are one item).  ``required``: one column, the
    features to cover instead of all; it is an error when no item carries one of them.
    """
    spark = items.sparkSession
    table = items.select("id", order.alias("o"), F.array_compact(F.array_distinct(features)).alias("f"))
    links = table.select("id", "o", F.explode("f").alias("feature"))
    if required is not None:
        wanted = required.select(F.col(required.columns[0]).alias("feature")).where("feature is not null").distinct()
        stalled = wanted.join(links, "feature", "left_anti").limit(5).collect()
        if stalled:
            raise ValueError(f"coverage selection stalled: no item carries {[r[0] for r in stalled]}")
        links = links.join(wanted, "feature", "left_semi")
    picks = scratch_path(spark, "cover_picks")
    table = cut_lineage(_first_of_equal(links.groupBy("id", "o").agg(F.collect_set("feature").alias("f"))), "cover")
    schema = table.select(F.struct((-F.size("f")).alias("score"), "o", "id").alias("key")).schema
    rounds = 0
    while not table.isEmpty():
        key = F.struct((-F.size("f")).alias("score"), "o", "id")
        best = cut_lineage(table.select(F.explode("f").alias("feature"), key.alias("key"))
                           .groupBy("feature").agg(F.min("key").alias("key")), "cover_best")
        best.groupBy("key").agg(F.count(F.lit(1)).alias("wins")).where("wins = -key.score").select("key").write.parquet(
            f"{picks}/round={rounds}")
        taken = spark.read.schema(schema).parquet(f"{picks}/round={rounds}")
        covered = best.join(taken, "key", "left_semi").select("feature")
        left = table.select("id", "o", F.explode("f").alias("feature")).join(covered, "feature", "left_anti")
        table = cut_lineage(_first_of_equal(left.groupBy("id", "o").agg(F.collect_list("feature").alias("f"))), "cover")
        rounds += 1
    found = spark.read.schema(schema).parquet(picks) if rounds else table.select(
        F.struct(F.lit(0).alias("score"), "o", "id").alias("key"))
    rows = found.select(F.lit(0).alias("_all"), "key.score", "key.o", "key.id")
    return with_position(rows, ["_all"], ["score", "o", "id"], "score", "step").select(
        (F.col("step") + 1).alias("step"), "id", (-F.col("score")).cast("long").alias("gain"))


def greedy_cover(items: DataFrame, features: str, order: Column, max_steps: int | None = None
                 ) -> list:
    """The ids of ``cover_steps`` as a list, for covers known to be short."""
    steps = cover_steps(items, features, order)
    if max_steps is not None:
        steps = steps.where(F.col("step") <= max_steps)
    return [r["id"] for r in steps.orderBy("step").collect()]


def order_by_vocabulary(df: DataFrame, label: str, order: DataFrame, out: str = "label_order"
                        ) -> DataFrame:
    """Position of each label in a given vocabulary, 10000 for labels outside it."""
    places = order.select(F.col("label").alias("_label"), F.col("position").alias("_position"))
    return (df.join(places, F.col(label) == F.col("_label"), "left")
            .withColumn(out, F.coalesce("_position", F.lit(10_000)).cast("long"))
            .drop("_label", "_position"))


__all__ = [
    "capture_intervals", "class_coverage", "clip_per_action", "completeness", "cover_steps", "coverage_plan",
    "greedy_cover", "head_per_group", "missing_labels", "order_by_vocabulary", "pick_per_class",
    "stratified_pick",
]
