"""How the sources of each data set become packets: one contract for all 25.

``Release.packets(spark, root, sources)`` takes the sources as a table and gives packets whose
``recording_id`` is the source and whose ``error`` names what is wrong with it.  Text releases are read from
their files.  Binary releases are read from decoded array tables: ``<root>/decoded/arrays`` has a ``path``
column and what the adapter of the data set asks for, its companions lie beside it under their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.operators import timeline as TL
from packetloom.operators.errors import ERROR, open_channel, set_aside
from packetloom.operators.ordered import with_position
from packetloom.plans import adapters as AD
from packetloom.sources import text as ST
from packetloom.sources.text import Chosen, full_path

ID = "recording_id"
RAW = ("time", "link", "subcarrier")
CANONICAL = ("time", "subcarrier", "tx_link", "rx_link")
LABELS = ("source_label", "task", "subject", "environment", "device", "room", "location", "activity", "activity_label", "gesture", "split", "release_split", "trial_id")


@dataclass(frozen=True)
class Release:
    """``read`` is an adapter over files (``text``) or over decoded arrays; the rest describes its packets.

    ``axes`` are those of the adapter's result, with ``links`` or ``tx`` and ``rx`` as numbers or as the column that
    holds them; ``sniff`` is a word that the first characters of a source must hold, ``folders`` takes
    matching folders as sources, ``companions`` are tables that the adapter takes by name.
    """

    read: Callable[..., DataFrame]
    axes: tuple[str, ...] = CANONICAL
    links: int | str | None = None
    tx: int | str | None = None
    rx: int | str | None = None
    rate_hz: float | None = None
    text: bool = False
    folders: bool = False
    sniff: str | None = None
    companions: tuple[str, ...] = ()
    arguments: tuple[tuple[str, int], ...] = ()

    def packets(self, spark: SparkSession, root: str, sources: DataFrame) -> DataFrame:
        if self.text:
            return open_channel(self.read(spark, Chosen(root, sources)))
        wanted = sources.select(full_path(F.col("path")).alias("_source"))
        rows = decoded(spark, root, "arrays").withColumn("_source", full_path(F.col("path")))
        rows = rows.join(wanted, "_source", "left_semi").withColumn(ID, F.col("_source")).drop("_source")
        beside = {n: decoded(spark, root, n) for n in self.companions}
        out = self.read(open_channel(rows), **{n: t for n, t in beside.items() if t is not None}, **dict(self.arguments))
        out = out[0] if isinstance(out, tuple) else out
        return open_channel(out)


def decoded(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A decoded table below ``root``; companions may be missing."""
    from pyspark.errors import AnalysisException
    try:
        table = spark.read.parquet(f"{root.rstrip('/')}/decoded/{name}")
    except AnalysisException as gone:
        if name == "arrays" or "PATH_NOT_FOUND" not in str(gone.getCondition()):
            raise
        return None
    if name != "arrays" and "path" in table.columns and ID not in table.columns:
        table = table.withColumn(ID, full_path(F.col("path"))).drop("path")
    return table


def _nist(spark: SparkSession, chosen: Chosen) -> DataFrame:
    """The imaginary log lies beside each real one, under its name with ``imag`` for ``real``."""
    def of(kind: str) -> DataFrame:
        named = chosen.sources.select(F.regexp_replace("path", "_csi_real_log[.]csv$", f"_csi_{kind}_log.csv").alias("path"))
        rows = ST.read_numeric_csv(spark, Chosen(chosen.root, named))
        return rows.withColumn(ID, F.regexp_replace(ID, f"_csi_{kind}_log[.]csv$", "_csi_real_log.csv"))
    real, imag = of("real"), of("imag")
    return AD._with_empty(spark, chosen, AD.nist_breathesmart(real, imag))


def _presence(spark: SparkSession, chosen: Chosen) -> DataFrame:
    """Packets in the order of their times; equal times in any fixed order."""
    def number(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_bucket", F.floor(F.col("timestamp_s") / TL.SECONDS_PER_BUCKET)).withColumn("_tie", F.xxhash64("csi_real", "csi_imag"))
        return with_position(rows, [ID], ["timestamp_s", "_tie"], "_bucket").drop("_bucket", "_tie")
    return set_aside(AD.wifi_presence_movement(spark, chosen), number)


def _figshare(spark: SparkSession, chosen: Chosen) -> DataFrame:
    names = chosen.sources.select(F.regexp_replace("path", "data[.]csv$", "label.csv").alias("path"))
    return AD.figshare_csi_har(spark, chosen, Chosen(chosen.root, names))


RELEASES = {
    "aril": Release(AD.aril, tx=1, rx=1),
    "csi-bench": Release(AD.csi_bench, ("time", "feature"), companions=("shapes",)),
    "csida": Release(AD.csida, tx=1, rx=3, folders=True, companions=("phase", "labels")),
    "ehunam": Release(AD.ehunam, tx=1, rx=1),
    "exposing-csi": Release(AD.exposing_csi, tx=1, rx=4),
    "figshare-csi-har": Release(_figshare, tx=1, rx="links", text=True),
    "glasgow-activity-localization": Release(AD.glasgow_activity_localization, RAW, links=1, text=True),
    "glasgow-multiuser": Release(AD.glasgow_multiuser, RAW, links=1, text=True),
    "mm-fi": Release(AD.mm_fi, tx=1, rx=3, folders=True),
    "nist-breathesmart": Release(_nist, tx=2, rx=3, text=True),
    "ntu-fi": Release(AD.ntu_fi, tx=1, rx=3),
    "operanet": Release(AD.operanet, tx=3, rx=3),
    "signfi": Release(AD.signfi, tx=1, rx=3, arguments=(("samples", 1),)),
    "ut-har": Release(AD.ut_har, tx=1, rx=3, companions=("labels",)),
    "wallhack18k": Release(AD.wallhack18k, RAW, links=1, rate_hz=100.0, text=True, sniff="data"),
    "wiar": Release(AD.wiar, tx=1, rx=3, arguments=(("tx", 1), ("rx", 3))),
    "widar3": Release(AD.widar3, ("time_bin", "velocity_x_bin", "velocity_y_bin"), text=True),
    "wifi-80mhz": Release(AD.wifi_80mhz, tx=1, rx=4, arguments=(("bins", 242),)),
    "wifi-presence-movement": Release(_presence, RAW, links="links", text=True),
    "wifi-tad": Release(AD.wifi_tad, ("time", "feature"), companions=("annotations", "info")),
    "wimans": Release(AD.wimans, tx=3, rx=3, companions=("annotations",)),
    "wipe-fall": Release(AD.wipe_fall, RAW, links=1, text=True),
    "wireless-har-wifi-uwb": Release(AD.wireless_har, tx=1, rx=3),
    "xrf-v2": Release(AD.xrf_v2, tx=3, rx=3, companions=("intervals",)),
    "xrf55": Release(AD.xrf55, tx=1, rx=9),
}


def describe(packets: DataFrame, dataset_id: str, release: Release) -> DataFrame:
    """One row per recording of ``packets``: its first error or its axes, links, rate and labels.

    One partial aggregate settles the error channel.
    """
    def count(value: int | str | None) -> F.Column:
        if isinstance(value, str):
            return F.max(F.col(value)).cast("int") if value in packets.columns else F.lit(None).cast("int")
        return F.lit(value).cast("int")

    rate = F.max("sample_rate_hz") if "sample_rate_hz" in packets.columns else F.lit(release.rate_hz).cast("double")
    pairs = [x for c in LABELS if c in packets.columns for x in (F.lit(c), F.min(F.col(c).cast("string")))]
    labels = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    rows = packets.groupBy(ID).agg(
        F.min(ERROR).alias(ERROR), rate.cast("double").alias("sample_rate_hz"), count(release.links).alias("links"),
        count(release.tx).alias("tx_links"), count(release.rx).alias("rx_links"),
        F.map_filter(labels, lambda k, v: v.isNotNull()).alias("labels"))
    return rows.withColumn("dataset_id", F.lit(dataset_id)).withColumn("axis_order", F.array(*map(F.lit, release.axes)))


__all__ = ["RELEASES", "Release", "decoded", "describe"]
