"""Tensor layouts: links, axes, interleaved rows and unused slots.

A packet's channels are one flat row-major array, so most layout work is an index permutation
inside a row; only operators that merge or split packets shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions import arrays as A
from packetloom.functions import vocabularies as V
from packetloom.operators.errors import ERROR, flagged, set_aside
from packetloom.operators.ordered import index_bucket, join_facts, with_position
from packetloom.operators.timeline import RECORDING

CANONICAL_AXES = ("subcarrier", "tx_link", "rx_link")


def link_layouts(recordings: DataFrame, layouts: DataFrame | None = None) -> DataFrame:
    """Choose Tx x Rx per recording: declared, then the data set's, then ``1 x L``.

    ``recordings`` has ``dataset_id``, ``axis_order``, ``links`` and the declared ``tx_links`` and
    ``rx_links`` (NULL or 0 when not declared).  A factorisation that does not multiply to the
    link count falls back to ``1 x L`` with the reason.
    """
    if layouts is None:
        pairs = [x for k, (t, r) in V.ANTENNA_LAYOUTS.items()
                 for x in (F.lit(k), F.struct(F.lit(t).alias("tx"), F.lit(r).alias("rx")))]
        rows = recordings.withColumn(
            "_known", F.try_element_at(F.create_map(*pairs), F.col("dataset_id")))
    else:
        known = layouts.select("dataset_id", F.struct(
            F.col("tx_links").alias("tx"), F.col("rx_links").alias("rx")).alias("_known"))
        rows = recordings.join(known, "dataset_id", "left")
    axes = F.col("axis_order")
    done = F.forall(F.array(*map(F.lit, CANONICAL_AXES)), lambda a: F.array_contains(axes, a))
    raw = F.array_contains(axes, "link") & F.array_contains(axes, "subcarrier")
    declared = (F.coalesce("tx_links", F.lit(0)) > 0) & (F.coalesce("rx_links", F.lit(0)) > 0)
    tx = F.when(declared, F.col("tx_links")).otherwise(F.coalesce(F.col("_known.tx"), F.lit(1)))
    rx = F.when(declared, F.col("rx_links")).otherwise(F.coalesce(F.col("_known.rx"), F.col("links")))
    fits = tx * rx == F.col("links")
    return (rows.withColumn("_tx", F.when(fits, tx).otherwise(1))
            .withColumn("_rx", F.when(fits, rx).otherwise(F.col("links")))
            .withColumn("antenna_mapping_evidence", F.when(~done & raw, F.when(
                fits, F.lit("released antenna layout")).otherwise(
                F.lit("preserved flattened streams; source factorization unavailable"))))
            .withColumn("tensor_exception", ~done & ~raw)
            .withColumn("needs_layout", ~done & raw)
            .withColumn("tx_links", F.when(~done & raw, F.col("_tx")).otherwise(F.col("tx_links")))
            .withColumn("rx_links", F.when(~done & raw, F.col("_rx")).otherwise(F.col("rx_links")))
            .drop("_tx", "_rx", "_known"))


def canonicalize_links(packets: DataFrame, recordings: DataFrame, layouts: DataFrame | None = None,
                       signals: Sequence[str] = ("amplitude",)) -> tuple[DataFrame, DataFrame]:
    """``link x subcarrier`` arrays to ``subcarrier x tx x rx`` and the rewritten recordings."""
    chosen = link_layouts(recordings, layouts)
    facts = chosen.where("needs_layout").select("recording_id", F.col("links").alias("_links"))
    rows = join_facts(packets, facts, ["recording_id"], F.col("packet_index"))
    for s in signals:
        links = F.coalesce(F.col("_links"), F.lit(1))
        carriers = F.call_function("div", F.size(s), links).cast("int")
        rows = rows.withColumn(s, F.when(
            F.col("_links").isNull(), F.col(s)).otherwise(A.permute(s, (links, carriers), (1, 0))))
    lead = F.filter("axis_order", lambda a: a == "sample")
    axes = F.concat(lead, F.array(*map(F.lit, ("time", *CANONICAL_AXES))))
    described = chosen.withColumn("axis_order", F.when(F.col("needs_layout"), axes).otherwise(
        F.col("axis_order")))
    for axis, count in (("tx_link", "tx_links"), ("rx_link", "rx_links")):
        described = described.withColumn(f"{axis}_index", F.when(
            F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)))
    return rows.drop("_links"), described.drop("needs_layout")


def infer_axes(recordings: DataFrame) -> DataFrame:
    """Axis names from the rank of ``shape``; an unsupported rank is an error text."""
    rank = F.size("shape")
    base = F.array(*map(F.lit, ("time", "link", "subcarrier")))
    one = F.lit(1)
    return (recordings.withColumn("axis_order", F.when(rank.between(1, 3), base).when(
                rank == 4, F.concat(F.array(F.lit("sample")), base)))
            .withColumn("error", F.when(~rank.between(1, 4), F.concat(
                F.lit("1-D to 4-D arrays are supported, got "), rank.cast("string"), F.lit("-D"))))
            .withColumn("shape", F.when(rank == 1, F.concat("shape", F.array(one, one))).when(
                rank == 2, F.array(F.get("shape", F.lit(0)), one, F.get("shape", F.lit(1)))
            ).otherwise(F.col("shape"))))


def infer_bench_axes(recordings: DataFrame) -> DataFrame:
    """Source axes of a benchmark tensor from its shape, first matching rule wins."""
    d = [F.get("shape", F.lit(i)) for i in range(4)]
    rank = F.size("shape")
    last = F.element_at("shape", -1)

    def axes(*names: str) -> Column:
        return F.array(*[F.lit(n) for n in names])

    rule = (F.when((rank == 4) & (last.isin(*V.CSI_BENCH_LAST_AXIS_CARRIERS) | (d[1] > d[0])),
                   axes("sample", "time", "link", "subcarrier"))
            .when((rank == 3) & (d[0] <= 32) & (d[1] > d[0]), axes("sample", "time", "subcarrier"))
            .when((rank == 3) & (d[2] <= 16) & (d[1] >= 32) & (d[0] >= 16) & (d[0] != d[1]),
                  axes("subcarrier", "time", "link"))
            .when((rank == 3) & d[0].isin(*V.CSI_BENCH_CARRIERS) & (d[1] >= d[0]),
                  axes("subcarrier", "time", "link"))
            .when((rank == 3) & last.isin(*V.CSI_BENCH_LAST_AXIS_CARRIERS) & (d[1] >= d[0]),
                  axes("time", "link", "subcarrier")))
    return recordings.withColumn("source_axis_order", rule).withColumn("error", F.when(
        rule.isNull(), F.concat(F.lit("tensor layout is not recognized: "),
                                F.array_join(F.transform("shape", lambda x: x.cast("string")), "x"))))


def permute_axes(df: DataFrame, column: str, source: Sequence[str], target: Sequence[str],
                 sizes: dict[str, int]) -> DataFrame:
    """Reorder named axes of a per-row tensor whose element count must match ``sizes``."""
    if sorted(source) != sorted(target):
        raise ValueError("source and target must name the same axes")
    count = 1
    for a in source:
        count *= sizes[a]
    rows = flagged(df, column, F.size(column) == count, F.concat(
        F.lit(f"expected {'x'.join(str(sizes[a]) for a in source)} values, got "),
        F.size(column).cast("string")))
    return rows.withColumn(column, A.permute(F.col(column), [sizes[a] for a in source],
                                             [list(source).index(a) for a in target]))


def columns_to_vector(df: DataFrame, pattern: str, count: int, out: str,
                      expected: Sequence[str] | None = None) -> DataFrame:
    """Named columns such as ``tx1rx2_sub7`` as one array in the order of their numbers."""
    names = [c for c in df.columns if re.fullmatch(pattern, c)]
    missing = [c for c in (expected or []) if c not in names]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing[:5])}")
    names = list(expected) if expected else sorted(
        names, key=lambda n: [int(x) for x in re.findall(r"\d+", n)])
    if len(names) != count:
        raise ValueError(f"expected {count} columns matching {pattern}, found {len(names)}")
    return df.withColumn(out, F.array(*[F.col(c) for c in names])).drop(*names)


def group_rows(df: DataFrame, k: int, signals: Sequence[str], keys: Sequence[str] = RECORDING,
               index: str = "row_index", drop_empty: bool = True) -> DataFrame:
    """k consecutive rows are the k antennas of one packet; an incomplete tail is left out.

    Groups that are zero throughout go away afterwards, so no antenna ever shifts.
    """
    if ERROR in df.columns:
        return set_aside(df, lambda good: group_rows(good, k, signals, keys, index, drop_empty), keys)
    packet = F.call_function("div", F.col(index).cast("long"), F.lit(k).cast("long"))
    row = F.struct(F.pmod(F.col(index), F.lit(k)).alias("slot"), *signals)
    grouped = (df.groupBy(*keys, packet.alias("packet_index"))
               .agg(F.array_sort(F.collect_list(row)).alias("_rows"))
               .where(F.size("_rows") == k))
    for s in signals:
        grouped = grouped.withColumn(s, F.flatten(F.transform("_rows", lambda r: r[s])))
    grouped = grouped.drop("_rows")
    if drop_empty:
        keep = F.lit(False)
        for s in signals:
            keep = keep | A.any_nonzero(s)
        grouped = grouped.where(keep)
    return grouped


def deinterleave_streams(df: DataFrame, k: int, signals: Sequence[str],
                         keys: Sequence[str] = RECORDING, index: str = "row_index") -> DataFrame:
    """k interleaved streams, counted after empty rows are gone, cut to the shortest stream."""
    if ERROR in df.columns:
        return set_aside(df, lambda good: deinterleave_streams(good, k, signals, keys, index), keys)
    keep = F.lit(False)
    for s in signals:
        keep = keep | A.any_nonzero(s)
    rows = df.where(keep).withColumn("_bucket", index_bucket(index))
    rows = with_position(rows, keys, [index], "_bucket", "_dense").drop("_bucket")
    return group_rows(rows, k, signals, keys, "_dense", drop_empty=False)


def unfold_frames(df: DataFrame, column: str, packets: int, frame: str = "frame_index",
                  width: int | None = None) -> DataFrame:
    """A frame row holds ``channel x packet`` values: one row per packet, in order."""
    size = F.size(column)
    wrong = size % packets != 0
    if width is not None:
        wrong = size != width * packets
    df = flagged(df, column, ~wrong, F.concat(F.lit("unexpected frame size "), size.cast("string")))
    channels = F.call_function("div", size, F.lit(packets)).cast("int")
    spread = A.permute(F.col(column), (channels, F.lit(packets)), (1, 0))
    cut = A.bind(spread, lambda flat: F.transform(
        F.sequence(F.lit(0), F.lit(packets - 1)),
        lambda p: F.slice(flat, p * channels + 1, channels)))
    others = [c for c in df.columns if c not in (column, frame)]
    cut = F.when(F.col(column).isNotNull(), cut)
    # a frame with an error stays as one row
    apart = F.posexplode_outer if ERROR in df.columns else F.posexplode
    return (df.select(*others, frame, apart(cut).alias("_pos", column))
            .withColumn("packet_index", F.col(frame).cast("long") * packets + F.col("_pos"))
            .drop("_pos", frame))


def stride_packets(df: DataFrame, k: int, index: str = "packet_index") -> DataFrame:
    """Every k-th packet, renumbered."""
    return df.where(F.col(index) % k == 0).withColumn(
        index, F.call_function("div", F.col(index).cast("long"), F.lit(k).cast("long")))


def active_slots(df: DataFrame, signals: Sequence[str], keys: Sequence[str], axis_of: Column,
                 out: str) -> DataFrame:
    """Per recording, which positions of one axis ever hold a non-zero value.

    ``axis_of`` maps the cell position ``_cell`` to the axis.  Zero tests are reduced inside each
    packet first, so the shuffle carries at most one row per axis position and task.
    """
    nonzero = F.array_distinct(F.flatten(F.array(*[
        F.filter(F.transform(s, lambda x, i: F.when(x != 0, i)), lambda i: i.isNotNull())
        for s in signals])))
    cells = df.select(*keys, F.explode(nonzero).alias("_cell"))
    return (cells.select(*keys, axis_of.cast("int").alias("_slot")).distinct()
            .groupBy(*keys).agg(F.sort_array(F.collect_set("_slot")).alias(out)))


def drop_zero_slots(df: DataFrame, links: int, carriers: int,
                    signals: Sequence[str] = ("csi_real", "csi_imag"),
                    keys: Sequence[str] = RECORDING,
                    patterns: Sequence[Sequence[int]] | None = None,
                    active_carriers: int | None = None) -> DataFrame:
    """Remove ``link x carrier`` slots that are zero in the whole recording.

    ``patterns`` are the allowed sets of active links, ``active_carriers`` the required number
    of active carriers; anything else is an error.  Slot lists are bounded by the packet width.
    """
    cell = F.col("_cell")
    used_carriers = active_slots(df, signals, keys, cell % carriers, "subcarrier_index")
    used_links = active_slots(df, signals, keys, F.floor(cell / carriers), "link_index")
    facts = used_carriers.join(used_links, list(keys))
    wrong = F.lit(None).cast("string")
    if active_carriers is not None:
        wrong = F.when(F.size("subcarrier_index") != active_carriers, F.concat(
            F.lit(f"expected {active_carriers} active carriers, found "), F.size("subcarrier_index").cast("string")))
    if patterns is not None:
        known = F.lit(False)
        for p in patterns:
            known = known | (F.col("link_index") == A.index_array(p))
        wrong = F.coalesce(F.when(~known, F.concat(F.lit("active link slots match no documented layout: "),
                                                   F.to_json("link_index"))), wrong)
    facts = facts.withColumn("_wrong", wrong)
    is_open = ERROR in df.columns
    rows = join_facts(df, facts, list(keys), F.xxhash64(*signals), how="left" if is_open else "inner")
    wrong = F.coalesce("_wrong", F.when(F.col("link_index").isNull(), F.lit("no active slots"))) if is_open else F.col("_wrong")
    rows = flagged(rows, signals, wrong.isNull(), wrong).drop("_wrong")
    for s in signals:
        rows = rows.withColumn(s, F.filter(s, lambda x, i: F.array_contains(
            F.col("subcarrier_index"), (i % carriers).cast("int")) & F.array_contains(
            F.col("link_index"), F.floor(i / carriers).cast("int"))))
    return rows


def slice_blocks(df: DataFrame, column: str, carriers: Sequence[int] = (114, 56),
                 links: Sequence[int] = (4, 3, 1)) -> DataFrame:
    """Amplitude and phase blocks behind the first block, by the first layout that fits the width."""
    width = F.size(column)
    fits = F.lit(None)
    for s in reversed(carriers):
        for n in reversed(links):
            fits = F.when(width >= s * (1 + 2 * n),
                          F.struct(F.lit(s).alias("s"), F.lit(n).alias("n"))).otherwise(fits)
    rows = flagged(df.withColumn("_fit", fits), "_fit", F.col("_fit").isNotNull(),
                   F.concat(F.lit("unsupported width "), width.cast("string")))
    s, n = F.col("_fit.s"), F.col("_fit.n")
    return (rows.withColumn("amplitude", A.as_floats(F.slice(column, s + 1, s * n)))
            .withColumn("phase_rad", A.as_floats(F.slice(column, s * (n + 1) + 1, s * n)))
            .withColumn("links", n).withColumn("subcarriers", s).drop("_fit"))


def orient_time_first(df: DataFrame, column: str, known: Sequence[int],
                      keys: Sequence[str] = RECORDING, index: str = "row_index") -> DataFrame:
    """Turn recordings stored with one carrier per row into one packet per row.

    A recording is turned when its row count is a known carrier count and its rows are longer.
    Values travel one by one and a packet regroups at most ``max(known)`` of them.
    """
    if ERROR in df.columns:
        return set_aside(df, lambda good: orient_time_first(good, column, known, keys, index), keys)
    facts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"),
                                  F.max(F.size(column)).alias("_cols"))
    facts = facts.select(*keys, (F.col("_rows").isin(*known) & (
        F.col("_cols") > F.col("_rows"))).alias("_turn"))
    rows = join_facts(df.select(*keys, index, column), facts, list(keys), F.col(index))
    kept = rows.where(~F.col("_turn")).select(
        *keys, F.col(index).cast("long").alias("packet_index"), column)
    cells = rows.where("_turn").select(*keys, index, F.posexplode(column).alias("_t", "_v"))
    turned = cells.groupBy(*keys, F.col("_t").cast("long").alias("packet_index")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(index, "_v"))),
                    lambda x: x["_v"]).alias(column))
    return kept.unionByName(turned)


def select_receivers(df: DataFrame, column: str, keep: Sequence[int], receivers: int = 3,
                     inner: int = 90) -> DataFrame:
    """Keep receivers of ``receiver x inner`` arrays."""
    if not keep or any(r not in range(receivers) for r in keep):
        raise ValueError(f"receivers must be indices from 0 to {receivers - 1}")
    return df.withColumn(column, F.concat(*[
        F.slice(column, r * inner + 1, inner) for r in keep]))
