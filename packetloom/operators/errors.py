"""The error channel: a bad row names its error, and its recording fails alone.

A table with an ``error`` column has the channel open.  Operators then write into it what they would
otherwise raise, keep the first error of a row and set the row's arrays to NULL.  The jobs settle a recording
with one aggregate: any error in it fails it as a whole, the others go on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "error"
RECORDING = ("recording_id",)


def open_channel(rows: DataFrame) -> DataFrame:
    return rows if ERROR in rows.columns else rows.withColumn(ERROR, F.lit(None).cast("string"))


def flagged(rows: DataFrame, columns: str | Sequence[str], ok: Column, message: Column | str) -> DataFrame:
    """Rows for which ``ok`` is not true lose ``columns`` and get the message; a closed channel raises it."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    text = F.lit(message) if isinstance(message, str) else F.coalesce(message, F.lit("no usable values"))
    good = F.coalesce(ok, F.lit(False))
    if ERROR not in rows.columns:
        return rows.withColumns({c: F.when(good, F.col(c)).otherwise(F.raise_error(text)) for c in columns})
    good = good & F.col(ERROR).isNull()
    return rows.withColumns({ERROR: F.coalesce(ERROR, F.when(~good, text)), **{c: F.when(good, F.col(c)) for c in columns}})


def failures(rows: DataFrame, keys: Sequence[str] = RECORDING) -> DataFrame:
    """One row with its first error for each recording that has one."""
    return rows.where(F.col(ERROR).isNotNull()).groupBy(*keys).agg(F.min(ERROR).alias(ERROR))


def set_aside(rows: DataFrame, work: Callable[[DataFrame], DataFrame], keys: Sequence[str] = RECORDING) -> DataFrame:
    """``work`` on the recordings without an error; a failed one comes out as one row.

    For operators that regroup rows.  A closed channel goes through ``work`` as it is.
    """
    if ERROR not in rows.columns:
        return work(rows)
    bad = failures(rows, keys)
    lost = bad.select(*[F.col(k).alias(f"_bad_{i}") for i, k in enumerate(keys)])
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_bad_{i}"))
    done = open_channel(work(rows.join(lost, on, "left_anti").drop(ERROR)))
    return done.unionByName(bad, allowMissingColumns=True)


def uniform(rows: DataFrame, size: Column, what: str, spread: Column, keys: Sequence[str] = RECORDING) -> DataFrame:
    """Recordings whose rows differ in ``size`` fail: one partial aggregate, then the fact joins back salted
    by ``spread``, a value of the row itself."""
    from packetloom.operators.ordered import join_facts

    facts = rows.groupBy(*keys).agg(F.min(size).alias("_low"), F.max(size).alias("_high"))
    odd = facts.where("_low <> _high").select(*keys, F.concat(
        F.lit(f"inconsistent {what}: "), F.col("_low").cast("string"), F.lit(" to "), F.col("_high").cast("string")).alias("_odd"))
    joined = join_facts(open_channel(rows), odd, list(keys), spread)
    return joined.withColumn(ERROR, F.coalesce(ERROR, "_odd")).drop("_odd")
