"""Packet-level signal operators that need more than one row or column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions import arrays as A
from packetloom.functions.vocabularies import HT_LTF_INDICES, L_LTF_INDICES
from packetloom.operators.errors import flagged
from packetloom.operators.ordered import join_facts
from packetloom.operators.quantiles import exact_cell_percentiles, exact_percentiles
from packetloom.operators.timeline import RECORDING


def add_amplitude(df: DataFrame) -> DataFrame:
    return df.withColumn("amplitude", A.amplitude("csi_real", "csi_imag"))


def add_phase(df: DataFrame) -> DataFrame:
    return df.withColumn("phase_rad", A.phase("csi_real", "csi_imag"))


def from_polar(df: DataFrame) -> DataFrame:
    """Real and imaginary parts from amplitude and phase; unequal widths are an error."""
    amp = F.col("amplitude")
    rows = flagged(df, "amplitude", F.size("amplitude") == F.size("phase_rad"), "amplitude and phase shapes differ")
    return (rows.withColumn("csi_real", A.polar_real(amp, "phase_rad"))
            .withColumn("csi_imag", A.polar_imag(amp, "phase_rad")))


def reference_power(df: DataFrame, keys: Sequence[str] = RECORDING) -> DataFrame:
    """Median power over the valid cells of a recording, at least the smallest float32."""
    valid = F.col("valid") if "valid" in df.columns else F.lit(True)
    sizes = df.groupBy(*keys).agg(F.sum(F.size("amplitude")).alias("_size"))
    power = exact_cell_percentiles(df.where(valid), keys, F.transform("amplitude", lambda a: a.cast("double") * a.cast("double")),
                                   {"reference_power": 0.5}, sizes=sizes)
    return power.withColumn("reference_power", F.greatest("reference_power", F.lit(A.FLOAT32_TINY)))


def reference_power_of_cells(cells: DataFrame, sizes: DataFrame, keys: Sequence[str] = RECORDING) -> DataFrame:
    """``reference_power`` of valid cells in rows; ``sizes`` (keys and ``_size``) has their number, or more."""
    a = F.col("amplitude").cast("double")
    power = exact_percentiles(cells, keys, a * a, {"reference_power": 0.5}, sizes=sizes)
    return power.withColumn("reference_power", F.greatest("reference_power", F.lit(A.FLOAT32_TINY)))


def relative_power(df: DataFrame) -> DataFrame:
    """``power_db_rel`` of packets that have their recording's ``reference_power``."""
    valid = F.col("valid") if "valid" in df.columns else F.lit(True)
    rows = df.withColumn("reference_power", F.coalesce("reference_power", F.lit(1.0)))
    return rows.withColumn("power_db_rel", F.transform("amplitude", lambda a: F.when(
        valid, F.lit(10.0) * F.log10(
            F.greatest(a.cast("double") * a.cast("double"), F.lit(A.FLOAT32_TINY))
            / F.col("reference_power"))).otherwise(F.lit(0.0)).cast("float")))


def power_db_rel(df: DataFrame, keys: Sequence[str] = RECORDING) -> DataFrame:
    """Power in dB relative to the recording's median valid power; invalid packets are 0.

    The reference is 1 for a recording without valid cells, and stays in the result.
    """
    return relative_power(join_facts(df, reference_power(df, keys), list(keys), F.xxhash64("amplitude")))


def deinterleave_iq(df: DataFrame, column: str) -> DataFrame:
    """Split ``[I, R, I, R, ...]``; an odd number of values is an error."""
    rows = flagged(df, column, F.size(column) % 2 == 0, "an interleaved I/R vector needs an even number of values")
    return (rows.withColumn("csi_imag", A.as_floats(A.interleaved_imag(F.col(column))))
            .withColumn("csi_real", A.as_floats(A.interleaved_real(F.col(column)))))


def training_field_indices(include_ht: bool = False) -> list[int]:
    return [*L_LTF_INDICES, *(HT_LTF_INDICES if include_ht else [])]


def select_subcarriers(df: DataFrame, indices: Sequence[int],
                       signals: Sequence[str] = ("csi_real", "csi_imag")) -> DataFrame:
    """Keep listed subcarriers; indices beyond the packet are ignored, kept ones are recorded."""
    idx = A.index_array(indices)
    rows = df.withColumn("subcarrier_index", A.kept_indices(signals[0], idx))
    for s in signals:
        rows = rows.withColumn(s, A.take(s, F.col("subcarrier_index")))
    return rows


def drop_null_carriers(df: DataFrame, rules: DataFrame, on: Sequence[str],
                       signals: Sequence[str] = ("csi_real", "csi_imag")) -> DataFrame:
    """Remove the carriers a rule table lists for ``on``; a row without a rule is an error."""
    joined = df.join(rules.select(*on, F.col("remove").alias("_remove")), list(on), "left")
    joined = flagged(joined, "_remove", F.col("_remove").isNotNull(), F.concat_ws(
        " ", F.lit("no null-carrier rule for"), *[F.col(c).cast("string") for c in on]))
    rows = joined.withColumn("subcarrier_index", F.filter(
        F.sequence(F.lit(0), F.size(signals[0]) - 1),
        lambda i: ~F.array_contains(F.col("_remove"), i)))
    for s in signals:
        rows = rows.withColumn(s, A.take(s, F.col("subcarrier_index")))
    return rows.drop("_remove")


def fftshift(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, A.fft_shift(column))


def stride_bins(df: DataFrame, column: str, k: int) -> DataFrame:
    return df.withColumn(column, A.every(column, k))


def affine_companion(df: DataFrame, column: str, mean: float, std: float, out: str) -> DataFrame:
    """A published normalisation, kept beside the raw signal."""
    return df.withColumn(out, A.affine(column, mean, std))


def normalize_packet(df: DataFrame) -> DataFrame:
    """Divide a packet by its mean amplitude."""
    amp = A.amplitude("csi_real", "csi_imag")
    rows = df.withColumn("_amp", amp)
    for s in ("csi_real", "csi_imag"):
        rows = rows.withColumn(s, A.divide_by_mean(s, "_amp"))
    return rows.drop("_amp")


def repair_nonfinite(df: DataFrame, column: str = "amplitude") -> DataFrame:
    return df.withColumn(column, A.repair_nonfinite(column))


def drop_zero_packets(df: DataFrame, signals: Sequence[str] = ("csi_real", "csi_imag")) -> DataFrame:
    keep = F.lit(False)
    for s in signals:
        keep = keep | A.any_nonzero(s)
    return df.where(keep)


def link_stack(df: DataFrame, column: str, shape: tuple, order: str = "tx") -> DataFrame:
    """One row per link plane of ``S x Tx x Rx``, numbered Tx-major or Rx-major, with its name."""
    s, tx, rx = shape
    if order not in ("tx", "rx"):
        raise ValueError("order must be tx or rx")
    axes = (1, 2, 0) if order == "tx" else (2, 1, 0)
    links = tx * rx
    rows = df.withColumn("_stack", A.permute(column, (s, tx, rx), axes))
    rows = rows.withColumn("link", F.explode(F.sequence(F.lit(0), F.lit(links - 1))))
    major, minor = ("T", "R") if order == "tx" else ("R", "T")
    inner = rx if order == "tx" else tx
    name = F.concat(F.lit(major), (F.floor(F.col("link") / inner) + 1).cast("string"),
                    F.lit(minor), (F.col("link") % inner + 1).cast("string"))
    return (rows.withColumn("link_name", name)
            .withColumn(column, F.slice("_stack", F.col("link") * s + 1, s)).drop("_stack"))


def flattened_links(recordings: DataFrame) -> DataFrame:
    """The source's un-factorised ``1 x L`` links: same values, other shape."""
    tail = F.slice("shape", F.size("shape") - 1, 2)
    merged = F.get(tail, F.lit(0)) * F.get(tail, F.lit(1))
    return recordings.withColumn("shape", F.concat(
        F.slice("shape", F.lit(1), F.size("shape") - 2), F.array(F.lit(1), merged)))


def marginal(df: DataFrame, column: str, shape: tuple, axis: int, out: str) -> DataFrame:
    """Sum one axis of a per-row tensor away (for instance the y velocity of a profile)."""
    outer = inner = 1
    for n in shape[:axis]:
        outer *= n
    for n in shape[axis + 1:]:
        inner *= n
    return df.withColumn(out, A.axis_reduce(column, outer, shape[axis], inner, "sum"))


def decode_labels(df: DataFrame, column: str, vocabulary: Mapping | DataFrame, out: str,
                  on_unknown: str = "keep") -> DataFrame:
    """Codes to names.  Unknown codes stay (``keep``), become NULL (``null``) or fail (``error``).

    A mapping is folded into the plan as literals; a table ``(code, name)`` is joined.
    """
    if on_unknown not in ("keep", "null", "error"):
        raise ValueError("on_unknown must be keep, null or error")
    code = F.col(column).cast("string")
    if isinstance(vocabulary, DataFrame):
        names = vocabulary.select(F.col("code").cast("string").alias("_code"),
                                  F.col("name").alias("_name"))
        rows = df.withColumn("_key", code).join(
            names, F.col("_key") == F.col("_code"), "left").drop("_code", "_key")
    else:
        pairs = [x for k, v in vocabulary.items() for x in (F.lit(str(k)), F.lit(v))]
        rows = df.withColumn("_name", F.try_element_at(F.create_map(*pairs), code))
    if on_unknown == "keep":
        value: Column = F.coalesce("_name", code)
    elif on_unknown == "null":
        value = F.col("_name")
    else:
        rows = flagged(rows, "_name", F.col("_name").isNotNull() | code.isNull(), F.concat(F.lit(f"unknown {column}: "), code))
        value = F.col("_name")
    return rows.withColumn(out, value).drop("_name")
