"""Order-dependent columns for recordings that are too long for one task.

A plain ``Window.partitionBy(recording_id)`` sends a whole recording to one task, and one
recording may hold a third of all packets.  Here the caller names an *order bucket*: a
value-derived column that grows with the order (``floor(timestamp_s / 60)``,
``packet_index div 4096``, a hash prefix).  Rows are windowed inside ``keys + bucket``; what
crosses a bucket edge is worked out on the table of buckets, which has one row per bucket,
and joined back on ``keys + bucket``, the partitioning the rows already have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PACKETS_PER_BUCKET = 4096
SECONDS_PER_BUCKET = 60.0


def index_bucket(column: str = "packet_index", width: int = PACKETS_PER_BUCKET) -> Column:
    return F.floor(F.col(column) / F.lit(width))


def time_bucket(column: str = "timestamp_s", width: float = SECONDS_PER_BUCKET) -> Column:
    return F.floor(F.col(column) / F.lit(float(width)))


def _edge_window(keys: Sequence[str], bucket: str):
    return Window.partitionBy(*keys).orderBy(bucket)


def with_neighbour(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], bucket: str,
                   columns: Sequence[str], out: str, step: int = 1) -> DataFrame:
    """Add struct ``out`` with the next (``step=1``) or previous (``step=-1``) row's columns.

    NULL where the recording has no such row.
    """
    if step not in (1, -1):
        raise ValueError("step must be 1 or -1")
    payload = F.struct(*[F.col(c) for c in columns])
    order = F.struct(*[F.col(c) for c in order_by])
    inside = Window.partitionBy(*keys, bucket).orderBy(*order_by)
    shifted = F.lead(payload) if step == 1 else F.lag(payload)
    edge_row = F.min_by(payload, order) if step == 1 else F.max_by(payload, order)
    edges = df.groupBy(*keys, bucket).agg(edge_row.alias("_own"))
    across = F.lead("_own") if step == 1 else F.lag("_own")
    edges = edges.select(*keys, bucket, across.over(_edge_window(keys, bucket)).alias("_edge"))
    rows = df.withColumn("_inside", shifted.over(inside))
    return (rows.join(edges, [*keys, bucket], "left")
            .withColumn(out, F.coalesce("_inside", "_edge"))
            .drop("_inside", "_edge"))


def with_change_count(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], bucket: str,
                      columns: Sequence[str], changed, out: str, first: int = 0) -> DataFrame:
    """Add the running number of rows for which ``changed(previous, current)`` holds.

    ``changed`` gets two struct Columns of ``columns``; ``first`` is what the recording's first
    row counts.  Give it only the columns it needs: then rows and bucket edges come from one and
    the same shuffle.
    """
    payload = F.struct(*[F.col(c) for c in columns])
    order = F.struct(*[F.col(c) for c in order_by])
    inside = Window.partitionBy(*keys, bucket).orderBy(*order_by)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.repartition(*keys, bucket).withColumn("_before", F.lag(payload).over(inside))
    step = F.when(F.col("_before").isNotNull(), changed(F.col("_before"), payload).cast("int"))
    rows = rows.withColumn("_step", F.coalesce(step, F.lit(0)).cast("long"))
    edges = rows.groupBy(*keys, bucket).agg(
        F.min_by(payload, order).alias("_head"), F.max_by(payload, order).alias("_tail"),
        F.sum("_step").alias("_inner"))
    across = _edge_window(keys, bucket)
    edges = edges.withColumn("_last", F.lag("_tail").over(across))
    edges = edges.withColumn("_jump", F.when(F.col("_last").isNull(), F.lit(first)).otherwise(
        changed(F.col("_last"), F.col("_head")).cast("int")).cast("long"))
    offset = (F.sum("_jump").over(across.rowsBetween(Window.unboundedPreceding, Window.currentRow))
              + F.coalesce(F.sum("_inner").over(
                  across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    edges = edges.select(*keys, bucket, offset.alias("_offset"))
    return (rows.withColumn("_running", F.sum("_step").over(upto))
            .join(edges, [*keys, bucket], "left")
            .withColumn(out, F.col("_running") + F.col("_offset"))
            .drop("_before", "_step", "_running", "_offset"))


def with_running_total(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], bucket: str,
                       value: Column, out: str) -> DataFrame:
    """Add the running total of ``value`` up to and including each row."""
    rows = df.withColumn("_step", value)
    inside = (Window.partitionBy(*keys, bucket).orderBy(*order_by)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = _edge_window(keys, bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(*keys, bucket).agg(F.sum("_step").alias("_total"))
               .select(*keys, bucket,
                       F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")))
    return (rows.withColumn("_running", F.sum("_step").over(inside))
            .join(offsets, [*keys, bucket], "left")
            .withColumn(out, F.col("_running") + F.col("_offset"))
            .drop("_step", "_running", "_offset"))


def with_position(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], bucket: str,
                  out: str = "packet_index") -> DataFrame:
    """Add the 0-based position of every row in its recording."""
    counted = with_running_total(df, keys, order_by, bucket, F.lit(1).cast("long"), out)
    return counted.withColumn(out, F.col(out) - F.lit(1))


def join_facts(rows: DataFrame, facts: DataFrame, keys: Sequence[str], spread: Column,
               salts: int = 8, how: str = "left") -> DataFrame:
    """Join one-row-per-recording facts to packets without a hot join key.

    ``spread`` is any value of the row itself (its index or a hash), so a retried task
    salts its rows the same way again.  Beyond the salts, AQE splits what is still skewed; a
    facts table below the broadcast threshold is not shuffled at all.
    """
    if salts < 1:
        raise ValueError("salts must be positive")
    salted = rows.withColumn("_salt", F.pmod(spread.cast("long"), F.lit(salts)).cast("int"))
    copies = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def explode_range(df: DataFrame, first: Column, last: Column, out: str,
                  chunk: int = 4096) -> DataFrame:
    """One row per integer in ``first..last``; an empty range gives no row.

    Exploded in chunks so that a long range never becomes one long array.
    """
    chunks = F.when(first <= last, F.sequence(first, last, F.lit(chunk).cast("long")))
    return (df.withColumn("_last", last).withColumn("_chunk", F.explode(chunks))
            .withColumn(out, F.explode(F.sequence(
                F.col("_chunk"), F.least(F.col("_chunk") + F.lit(chunk - 1), F.col("_last")))))
            .drop("_chunk", "_last"))
