"""Decoded array tables, alias resolution and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The names under which sources store their arrays, best first.
DATA_KEYS = ("csi", "CSI", "amp", "amplitude", "data", "x", "input")
REAL_KEYS = ("csi_real", "real", "real_csi")
IMAG_KEYS = ("csi_imag", "imag", "imag_csi")
LABEL_KEYS = ("label", "labels", "y", "activity_label", "target")
METADATA_KEYS = {
    "subject": ("subject", "subject_id", "person", "person_id", "user", "user_id", "participant"),
    "environment": ("environment", "environment_id", "env", "room", "scene"),
    "device": ("device", "device_id", "receiver", "receiver_id", "rx"),
    "location": ("location", "location_id", "position", "position_id"),
    "orientation": ("orientation", "orientation_id", "angle"),
    "day": ("day", "date", "session"),
    "trial": ("trial", "trial_id", "repetition", "repeat", "rep"),
    "occupancy": ("occupancy", "people_count", "person_count"),
    "experiment": ("experiment", "experiment_id", "exp"),
    "band": ("band", "frequency_band"),
}


def choose_alias(columns: Sequence[str], candidates: Sequence[str], ignore_case: bool = False
                 ) -> str | None:
    """The first candidate that exists as a column."""
    have = {c.lower(): c for c in columns} if ignore_case else {c: c for c in columns}
    for name in candidates:
        found = have.get(name.lower() if ignore_case else name)
        if found is not None:
            return found
    return None


def resolve_aliases(df: DataFrame, spec: Mapping[str, Sequence[str]] | None = None,
                    ignore_case: bool = False, keep: Sequence[str] = ("recording_id",)) -> DataFrame:
    """Rename source columns to standard names; the first existing alias counts, even if NULL.

    Without any data alias the widest numeric array column is the data.
    """
    spec = dict(spec) if spec is not None else {
        "csi_real": REAL_KEYS, "csi_imag": IMAG_KEYS, "data": DATA_KEYS, "source_label": LABEL_KEYS,
        **METADATA_KEYS}
    taken = {}
    for name, aliases in spec.items():
        hit = choose_alias([c for c in df.columns if c not in keep], aliases, ignore_case)
        if hit is not None:
            taken[name] = hit
    complex_pair = {"csi_real", "csi_imag"} <= set(taken)
    if "data" in spec and "data" not in taken and not complex_pair:
        arrays = [f.name for f in df.schema if f.dataType.typeName() == "array"
                  and f.dataType.elementType.typeName() in ("byte", "short", "integer", "long",
                                                            "float", "double")]
        if not arrays:
            raise ValueError(f"could not find a data array; columns: {sorted(df.columns)}")
        if len(arrays) > 1:
            sizes = df.agg(*[F.sum(F.size(a)).alias(a) for a in arrays]).first()
            arrays.sort(key=lambda a: -(sizes[a] or 0))
        taken["data"] = arrays[0]
    return df.select(*[c for c in keep if c in df.columns],
                     *[F.col(src).alias(name) for name, src in taken.items()])


def read_array_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A table of decoded tensors: one row per sample or packet with array columns."""
    return spark.read.parquet(path) if isinstance(path, str) else spark.read.parquet(*path)


def samples_to_packets(df: DataFrame, column: str, keys: Sequence[str] = ("recording_id",),
                       out: str = "amplitude") -> DataFrame:
    """Rows holding ``packet x channel`` arrays to one row per packet."""
    others = [c for c in df.columns if c not in (*keys, column)]
    return df.select(*keys, *others, F.posexplode(column).alias("packet_index", out))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("dataset_id",),
                fmt: str = "parquet", sort_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Write a result; rows may be sorted inside each file so that row groups can be skipped.

    Overwriting replaces the partitions that ``df`` has rows of and leaves the others alone.
    """
    if fmt not in ("parquet", "json", "orc"):
        raise ValueError("fmt must be parquet, json or orc")
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    writer = out.write.mode(mode).format(fmt)
    keep = [c for c in partition_by if c in df.columns]
    if keep:
        writer = writer.partitionBy(*keep).option("partitionOverwriteMode", "dynamic")
    writer.save(path)
