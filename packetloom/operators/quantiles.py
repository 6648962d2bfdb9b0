"""Exact percentiles of groups that may be too large for one task.

Spark's ``percentile`` keeps every distinct value of a group in one buffer.  Here a mergeable
sketch only brackets the wanted ranks; the exact answer comes from counting what lies below
the bracket and ranking the few values inside it.  The input is read twice: for the sketch, which
is worked out at once and written, and for the answer.  Where ``sizes`` of the groups are given, as
many small groups (recordings) call for, those of up to ``SMALL_GROUP`` values are sorted as one array
each instead.  Otherwise every group takes the first path, whatever its size; only for many groups do
the rows have to move to their brackets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.operators.ordered import join_facts
from packetloom.session import cut_lineage

ACCURACY = 10_000
BRACKET_BYTES, BROADCAST_BYTES = 256, 32 << 20   # of one bracket in memory; of those that go to every task
SMALL_GROUP = 20_000    # values of a group that one task may hold
PARTS = 256     # a bracket is ranked in so many ranges of values, each by itself


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: Column,
                      probabilities: Mapping[str, float], accuracy: int = ACCURACY,
                      salts: int = 8, sizes: DataFrame | None = None) -> DataFrame:
    """One row per group with linearly interpolated percentiles, NULL and NaN left out.

    ``sizes`` (keys and ``_size``) has the number of values of each group, or more.
    """
    keys = list(keys)
    thin = df.select(*keys, value.cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v"))
    v, low, high = F.col("_v"), F.col("_b.low"), F.col("_b.high")

    def placed(rows: DataFrame) -> DataFrame:
        return rows.select(
            *keys, "_b", F.when((v >= low) & (v <= high), v).alias("_x"),
            F.when(v <= high, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("_n"),
            F.when(v < low, v).alias("_under"), F.when(v > high, v).alias("_above"))

    def bracketed(rows: DataFrame) -> DataFrame:
        return _percentiles(rows, rows, keys, F.hash("_v"), placed, probabilities, accuracy, salts)

    return _by_size(thin, keys, sizes, F.collect_list("_v"), bracketed, probabilities)


def exact_cell_percentiles(df: DataFrame, keys: Sequence[str], cells: Column,
                           probabilities: Mapping[str, float], accuracy: int = ACCURACY,
                           salts: int = 8, sizes: DataFrame | None = None) -> DataFrame:
    """``exact_percentiles`` over all elements of the array ``cells`` of doubles.

    The bracket goes to the packet: what lies outside is counted inside its array, and only the
    cells within the bracket become rows.
    """
    keys = list(keys)
    packets = df.select(*keys, cells.alias("_v")).withColumn(
        "_v", F.filter("_v", lambda x: x.isNotNull() & ~F.isnan(x))).where(F.size("_v") > 0)

    def placed(rows: DataFrame) -> DataFrame:
        flat = rows.select(*keys, "_b", "_v", F.col("_b.low").alias("_low"), F.col("_b.high").alias("_high"))
        under = F.filter("_v", lambda x: x < F.col("_low"))
        above = F.filter("_v", lambda x: x > F.col("_high"))
        within = F.filter("_v", lambda x: (x >= F.col("_low")) & (x <= F.col("_high")))
        nothing = F.lit(None).cast("double")
        outside = F.struct(nothing.alias("_x"), F.size(under).cast("long").alias("_n"),
                           F.array_max(under).alias("_under"), F.array_min(above).alias("_above"))
        inside = F.transform(within, lambda x: F.struct(
            x.alias("_x"), F.lit(1).cast("long").alias("_n"), nothing.alias("_under"), nothing.alias("_above")))
        return flat.select(*keys, "_b", F.explode(F.concat(F.array(outside), inside)).alias("_r")).select(
            *keys, "_b", "_r.*")

    def bracketed(rows: DataFrame) -> DataFrame:
        values = rows.select(*keys, F.explode("_v").alias("_v"))
        return _percentiles(values, rows, keys, F.xxhash64("_v"), placed, probabilities, accuracy, salts)

    return _by_size(packets, keys, sizes, F.flatten(F.collect_list("_v")), bracketed, probabilities)


def _by_size(rows: DataFrame, keys: list[str], sizes: DataFrame | None, gathered: Column, bracketed,
             probabilities: Mapping[str, float]) -> DataFrame:
    """Percentiles of ``gathered``, the values of a group as one array, and ``bracketed`` for large groups.

    The keys of large groups go to every task: at most one for ``SMALL_GROUP`` values.
    """
    if sizes is None or not keys:
        return bracketed(rows)
    large = cut_lineage(sizes.where(F.col("_size") > SMALL_GROUP).select(*keys), "large")
    some = not large.isEmpty()
    small = rows.join(F.broadcast(large), keys, "left_anti") if some else rows
    for k in keys:      # as joins with the brackets do
        small = small.where(F.col(k).isNotNull())
    ordered = small.groupBy(*keys).agg(F.sort_array(gathered).alias("_sorted"))

    def at(p: float) -> Column:
        place = F.lit(float(p)) * (F.size("_sorted") - 1)
        first, second = (F.get("_sorted", end(place).cast("int")) for end in (F.floor, F.ceil))
        return first + (second - first) * (place - F.floor(place))

    done = ordered.select(*keys, *[at(p).alias(n) for n, p in probabilities.items()])
    return done.unionByName(bracketed(rows.join(F.broadcast(large), keys, "left_semi"))) if some else done


def _percentiles(values: DataFrame, rows: DataFrame, keys: list[str], spread: Column, placed,
                 probabilities: Mapping[str, float], accuracy: int, salts: int) -> DataFrame:
    """Percentiles of ``values`` (``_v``); ``placed`` tells for ``rows`` beside a bracket ``_b`` what is
    within it (``_x``), how many values are not above it (``_n``) and what lies next to it.

    The bracket ``p +- 5/accuracy`` is wider than the sketch's own error and holds about
    ``10/accuracy`` of the values.  In small groups, where the sketch is exact, a wanted rank may be
    the value just beside the bracket, so both neighbours are kept too.  A rank that is neither is
    an error.
    """
    names = list(probabilities)
    wanted = [float(probabilities[n]) for n in names]
    margin = 5.0 / accuracy
    cuts = [bound for p in wanted for bound in (max(0.0, p - margin), min(1.0, p + margin))]
    sketch = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_size"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", cuts, accuracy).alias("_cuts"))
    # the smallest and the largest value need no bracket: an empty one, whose end is the answer
    brackets = sketch.select(*keys, F.array(*[
        F.struct(
            F.lit(i).alias("which"),
            {0.0: F.col("_min"), 1.0: F.col("_max")}.get(p, F.get("_cuts", F.lit(2 * i))).alias("low"),
            {0.0: F.col("_min"), 1.0: F.col("_max")}.get(p, F.get("_cuts", F.lit(2 * i + 1))).alias("high"),
            (F.lit(p) * (F.col("_size") - 1)).alias("at"))
        for i, p in enumerate(wanted)]).alias("_brackets"))

    brackets = cut_lineage(brackets, "brackets")
    if brackets.count() * BRACKET_BYTES * len(wanted) <= BROADCAST_BYTES:    # rows stay where they are read
        held_by = F.broadcast(brackets)
        beside = rows.join(held_by, keys, "inner") if keys else rows.crossJoin(held_by)
    else:
        beside = join_facts(rows, brackets, keys, spread, salts, "inner")
    found = placed(beside.select(*keys, "_v", F.explode("_brackets").alias("_b")))
    x, low, high = F.col("_x"), F.col("_b.low"), F.col("_b.high")
    part = F.when(high > low, F.floor((x - low) / (high - low) * F.lit(PARTS))).otherwise(F.lit(0))
    # Values outside a bracket only count: they fall together into one row with a NULL value.
    group = [*keys, "_which"]
    kept = found.groupBy(*keys, F.col("_b.which").alias("_which"), F.col("_b.at").alias("_at"),
                         F.when(x.isNull(), F.lit(-1)).otherwise(part).cast("int").alias("_part"), "_x").agg(
        F.sum("_n").alias("_n"), F.max("_under").alias("_under"), F.min("_above").alias("_above"))
    parts = Window.partitionBy(*group).orderBy("_part")
    totals = kept.groupBy(*group, "_part").agg(F.sum("_n").alias("_total")).select(
        *group, "_part", (F.sum("_total").over(parts.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                          - F.col("_total")).alias("_base"))
    running = (Window.partitionBy(*group, "_part").orderBy("_x")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = kept.join(totals, [*group, "_part"]).withColumn(
        "_upto", F.sum("_n").over(running) + F.col("_base")).withColumn("_from", F.col("_upto") - F.col("_n"))
    lower, upper = F.floor("_at"), F.ceil("_at")

    def held(rank: Column) -> Column:
        return F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_upto")), F.col("_x")))

    ends = ranked.groupBy(*group).agg(
        held(lower).alias("_lo"), held(upper).alias("_hi"), F.max("_at").alias("_at"),
        F.coalesce(F.sum(F.when(x.isNull(), F.col("_n"))), F.lit(0)).alias("_below"),
        F.sum("_n").alias("_upto"), F.max("_under").alias("_under"), F.min("_above").alias("_above"))

    def value_at(rank: Column, own: str) -> Column:
        near = F.coalesce(F.col(own), F.when(rank == F.col("_below") - 1, F.col("_under")),
                          F.when(rank == F.col("_upto"), F.col("_above")))
        return F.when(near.isNotNull(), near).otherwise(
            F.raise_error(F.lit("a wanted rank lies outside its bracket")).cast("double"))

    first, second = value_at(lower, "_lo"), value_at(upper, "_hi")
    exact = ends.select(*group, (first + (second - first) * (F.col("_at") - lower)).alias("_exact"))
    return exact.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_which") == i, F.col("_exact"))).alias(n) for i, n in enumerate(names)])


def exact_median(df: DataFrame, keys: Sequence[str], value: Column, out: str,
                 salts: int = 8) -> DataFrame:
    """Medians of recordings; ``df`` is read twice, or more often for large groups."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    return exact_percentiles(df, keys, value, {out: 0.5}, salts=salts, sizes=sizes)
