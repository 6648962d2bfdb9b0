"""Per-data-set compositions: source rows in, canonical packets out.

Text releases start from their readers; binary releases start from decoded array tables with the
columns named in each function.  Every result has ``recording_id``, ``packet_index``, its signal
arrays in ``subcarrier x tx x rx`` order (or the release's own feature axes) and labels.
``path`` is the source path; where it is the recording's identity, ``recording_id`` is that path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.functions import arrays as A
from packetloom.functions import paths as P
from packetloom.functions import text as T
from packetloom.functions import vocabularies as V
from packetloom.operators import joins as J
from packetloom.operators import layout as L
from packetloom.operators import segments as D
from packetloom.operators import signal as S
from packetloom.operators import timeline as TL
from packetloom.operators.errors import ERROR, flagged, open_channel, set_aside, uniform
from packetloom.operators.ordered import join_facts, with_position
from packetloom.session import cut_lineage
from packetloom.sources import text as ST
from packetloom.sources.tables import resolve_aliases

ID = "recording_id"
IQ = ("csi_real", "csi_imag")


def _polar(df: DataFrame) -> DataFrame:
    return S.add_phase(S.add_amplitude(df))


def _split(df: DataFrame, columns: Sequence[str], width: int, out: str = "packet_index") -> DataFrame:
    """Rows holding many packets to one row per packet of ``width`` values."""
    def cut(c: str) -> Column:
        return A.bind(F.col(c), lambda flat: F.transform(
            F.sequence(F.lit(0), F.call_function("div", F.size(flat), F.lit(width)).cast("int") - 1),
            lambda i: F.slice(flat, i * width + 1, width)))

    others = [c for c in df.columns if c not in columns]
    apart = F.posexplode_outer if ERROR in others else F.posexplode     # a row with an error stays as one
    rows = df.select(*others, apart(F.arrays_zip(*[cut(c).alias(c) for c in columns])).alias(out, "_z"))
    return rows.select(*others, F.col(out).cast("long").alias(out),
                       *[F.col("_z")[c].alias(c) for c in columns])


def _expect(df: DataFrame, column: str, sizes: Sequence[int], what: str) -> DataFrame:
    return flagged(df, column, F.size(column).isin(*sizes), F.concat(
        F.lit(f"{what}, got "), F.size(column).cast("string"), F.lit(" values")))


def _named(column: Column, names: Sequence[str]) -> Column:
    return F.coalesce(F.get(F.array(*map(F.lit, names)), column.try_cast("int")),
                      column.cast("string"))


def aril(df: DataFrame) -> DataFrame:
    """``data``: 52 x 192 (or, with ``packets_first``, 192 x 52) per sample; ``activity``, ``location``."""
    df = _expect(df, "data", [52 * 192], "expected samples of 52 x 192")
    first = F.col("packets_first") if "packets_first" in df.columns else F.lit(False)
    data = F.when(first, F.col("data")).otherwise(A.permute("data", (52, 192), (1, 0)))
    rows = _split(df.withColumn("amplitude", A.as_floats(data)).drop("data"), ["amplitude"], 52)
    return rows.withColumn("source_label", _named(F.col("activity"), V.ARIL_GESTURES))


def csi_bench(df: DataFrame, shapes: DataFrame) -> DataFrame:
    """``row_index``, ``data`` (what lies behind the first axis) and per recording its ``shape``."""
    rows = join_facts(df, L.infer_bench_axes(shapes).select(
        ID, F.col("source_axis_order").alias("_axes"), F.col("shape").alias("_shape"), F.col("error").alias("_wrong")),
        [ID], F.col("row_index"), how="inner")
    rows = flagged(rows, "_axes", F.col("_wrong").isNull(), F.col("_wrong")).drop("_wrong")
    return set_aside(rows, _bench_packets)


def _bench_packets(rows: DataFrame) -> DataFrame:
    first = F.get("_axes", F.lit(0))
    d = [F.get("_shape", F.lit(i)) for i in range(4)]
    whole = rows.where(first == "time").withColumn(
        "amplitude", A.permute("data", (d[1], d[2]), (1, 0))).withColumn(
        "packet_index", F.col("row_index").cast("long")).withColumn("sample_index", F.lit(0))
    clips = rows.where(first == "sample").withColumn("_n", d[1])
    width = F.call_function("div", F.size("data"), F.col("_n")).cast("int")
    cut = A.bind(F.col("data"), lambda flat: F.transform(
        F.sequence(F.lit(0), F.col("_n") - 1), lambda t: F.slice(flat, t * width + 1, width)))
    clips = clips.select(ID, F.col("row_index").cast("int").alias("sample_index"), "_shape",
                         F.posexplode(cut).alias("packet_index", "amplitude"))
    four = F.size("_shape") == 4
    clips = clips.withColumn("amplitude", F.when(four, A.permute(
        "amplitude", (F.get("_shape", F.lit(2)), F.get("_shape", F.lit(3))), (1, 0))).otherwise(
        F.col("amplitude")))
    turned = rows.where(first == "subcarrier")
    cells = turned.select(ID, "row_index", d[2].alias("_links"), F.posexplode("data").alias("_i", "_v"))
    t = F.call_function("div", F.col("_i"), F.col("_links")).cast("long")
    # one packet gathers carriers x links values
    turned = cells.groupBy(ID, t.alias("packet_index")).agg(F.transform(F.array_sort(F.collect_list(
        F.struct("row_index", (F.col("_i") % F.col("_links")).alias("l"), "_v"))),
        lambda x: x["_v"]).alias("amplitude")).withColumn("sample_index", F.lit(0))
    keep = [ID, "sample_index", "packet_index", "amplitude"]
    out = whole.select(*keep).unionByName(clips.select(*keep)).unionByName(turned.select(*keep))
    return out.withColumn("packet_index", F.col("packet_index").cast("long")).withColumn(
        "amplitude", A.as_floats("amplitude"))


def csida(amplitude: DataFrame, phase: DataFrame | None = None, labels: DataFrame | None = None
          ) -> DataFrame:
    """``sample_index`` and ``amplitude`` (time x 3 x 114) with optional ``phase_rad`` and labels."""
    columns = ["amplitude"] if phase is None else ["amplitude", "phase_rad"]

    def packets(rows: DataFrame) -> DataFrame:
        if labels is not None:
            rows = rows.join(labels, [ID, "sample_index"], "left")
        rows = _split(rows, columns, 3 * 114)
        for c in columns:
            rows = L.permute_axes(rows, c, ["rx", "sub"], ["sub", "rx"], {"rx": 3, "sub": 114})
        return S.from_polar(rows) if phase is not None else rows
    if phase is None:
        return packets(amplitude)
    return set_aside(J.pair_join(amplitude, phase, [ID, "sample_index"], ("amplitude", "phase_rad")), packets)


def ehunam(df: DataFrame, path: str = "path") -> DataFrame:
    """``packet_index``, real and imaginary carriers, ``bandwidth``, ``environment``, ``timestamp_s``."""
    industrial = F.contains(F.lower("environment"), F.lit("industrial"))
    rule = F.when(F.size("csi_real") == 56, "none").when(F.col("bandwidth") == 20, "20").when(
        (F.col("bandwidth") == 80) & industrial, "80i").when(F.col("bandwidth") == 80, "80").otherwise("?")
    rules = df.sparkSession.createDataFrame(
        [("none", []), ("20", V.NULL_20MHZ), ("80i", V.NULL_80MHZ_INDUSTRIAL), ("80", V.NULL_80MHZ)],
        "rule string, remove array<int>")
    rows = S.drop_null_carriers(df.withColumn("rule", rule), F.broadcast(rules), ["rule"])
    return P.extract_campaign(_polar(rows).drop("rule"), path)


def exposing_csi(df: DataFrame, path: str = "path") -> DataFrame:
    """``row_index`` and 2048 or more carriers per row; rows interleave four streams."""
    rows = df
    for s in IQ:
        rows = rows.withColumn(s, A.fft_shift(F.slice(s, 1, 2048)))
    rows = S.drop_zero_packets(rows)
    for s in IQ:
        rows = rows.withColumn(s, A.drop_indices(s, A.index_array(V.NULL_2048_BINS)))
    rows = S.normalize_packet(rows)
    labels = P.extract_activity_letter(rows.select(ID, path).distinct(), path)
    rows = L.deinterleave_streams(rows, 4, IQ)
    carriers = 2048 - len(V.NULL_2048_BINS)
    for s in IQ:
        rows = L.permute_axes(rows, s, ["rx", "sub"], ["sub", "rx"], {"rx": 4, "sub": carriers})
    return join_facts(_polar(rows), labels, [ID], F.col("packet_index"))


def figshare_csi_har(spark: SparkSession, data: str | list[str], labels: str | list[str] | None = None
                     ) -> DataFrame:
    """``data.csv`` with amplitude and phase blocks and ``label.csv`` beside it."""
    matrix = open_channel(ST.read_numeric_csv(spark, data, strict=False, keep_empty=True))
    folder = F.regexp_replace(ID, "/[^/]*$", "")
    rows = L.slice_blocks(matrix, "values").withColumn("_folder", folder).drop("values")
    if labels is not None:
        raw = ST.lines_of(spark, labels).where(F.trim("value") != "").select(
            F.regexp_replace(ID, "/[^/]*$", "").alias("_folder"), "_start", "_id",
            F.trim(F.get(ST.csv_cells(F.col("value")), F.lit(1))).alias("source_label"))
        raw = with_position(raw.withColumn("_b", F.struct("_start", F.shiftright("_id", 12).alias("p"))),
                            ["_folder"], ["_start", "_id"], "_b", "row_index").drop("_b", "_start", "_id")
        labelled = raw.select("_folder").distinct().withColumn("_has", F.lit(True))
        rows = join_facts(rows, labelled, ["_folder"], F.col("row_index"))
        rows = J.positional_join(rows.withColumnRenamed(ERROR, "_own"), raw.withColumn("_found", F.lit(True)), ["_folder"], truncate=True)
        short = F.when(F.col("_has") & F.col("_found").isNull(), F.lit("fewer labels than data rows"))
        rows = rows.withColumn(ERROR, F.coalesce("_own", short)).drop("_own", "_found", "_has")
    for c in ("amplitude", "phase_rad"):
        rows = rows.withColumn(c, A.permute(c, (F.col("links"), F.col("subcarriers")), (1, 0)))
    return rows.withColumnRenamed("row_index", "packet_index").drop("_folder")


def _usrp(spark: SparkSession, path: str | list[str]) -> DataFrame:
    def packets(matrix: DataFrame) -> DataFrame:
        rows = L.orient_time_first(matrix, "values", [51, 52])
        return rows.withColumn("amplitude", A.as_floats("values")).drop("values")
    return _with_empty(spark, path, set_aside(ST.read_numeric_csv(spark, path), packets))


def _with_empty(spark: SparkSession, path: str | list[str], rows: DataFrame) -> DataFrame:
    """Files that gave no row, as failed recordings."""
    return rows.unionByName(ST.without_rows(spark, path, rows), allowMissingColumns=True)


def glasgow_activity_localization(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return P.extract_activity_location(_usrp(spark, path), ID).withColumn(
        "source_label", F.lower("activity_label"))


def glasgow_multiuser(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return P.extract_occupancy_scenario(_usrp(spark, path), ID).withColumn(
        "source_label", F.lower("activity_label"))


def wipe_fall(spark: SparkSession, path: str | list[str]) -> DataFrame:
    rows = _expect(_usrp(spark, path), "amplitude", [51], "expected the documented 51 subcarriers")
    return P.extract_risk_folder(rows, ID).withColumn("source_label", F.col("activity_label"))


def wireless_har(df: DataFrame, path: str = "path") -> DataFrame:
    """Named columns ``tx1rx{1..3}_sub{1..30}``, real as named and imaginary with ``_imag`` behind."""
    names = [f"tx1rx{r}_sub{s}" for r in range(1, 4) for s in range(1, 31)]
    rows = L.columns_to_vector(df, r"tx\d+rx\d+_sub\d+", 90, "csi_real", names)
    rows = L.columns_to_vector(rows, r"tx\d+rx\d+_sub\d+_imag", 90, "csi_imag",
                               [f"{n}_imag" for n in names])
    rows = rows.where(F.exists(T.path_parts(path), lambda p: F.lower(p) == "wifi_csi"))
    for s in IQ:
        rows = L.permute_axes(rows, s, ["rx", "sub"], ["sub", "rx"], {"rx": 3, "sub": 30})
    return P.extract_room_activity(_polar(rows), path)


def mm_fi(df: DataFrame, path: str = "path", packets: int = 10) -> DataFrame:
    """``frame_index`` and ``amplitude`` (3 x 114 x packets) per frame."""
    rows = L.unfold_frames(df, "amplitude", packets, width=3 * 114)
    rows = S.repair_nonfinite(rows)
    rows = L.permute_axes(rows, "amplitude", ["rx", "sub"], ["sub", "rx"], {"rx": 3, "sub": 114})
    rows = rows.withColumn("_code", P.fallback_label(path, "mm-fi"))
    return S.decode_labels(rows, "_code", V.MM_FI_ACTIVITIES, "source_label").drop("_code")


def nist_breathesmart(real: DataFrame, imag: DataFrame, links: int = 9, carriers: int = 114,
                      config: DataFrame | None = None) -> DataFrame:
    """``row_index`` and ``values`` of the real and the imaginary log of each recording."""
    both = J.pair_join(real.withColumnsRenamed({"values": "csi_real", ERROR: "_real_error"}),
                       imag.withColumnsRenamed({"values": "csi_imag", ERROR: "_imag_error"}), [ID, "row_index"], IQ)
    own = [F.col(c) for c in ("_real_error", "_imag_error") if c in both.columns]
    wrong = F.coalesce(*own, F.col("error"))
    both = both.withColumn("_wrong", wrong).drop("error", "_real_error", "_imag_error")
    rows = flagged(open_channel(both) if own else both, list(IQ), F.col("_wrong").isNull(), F.col("_wrong")).drop("_wrong")
    return set_aside(rows, lambda good: _nist_packets(good, links, carriers, config, bool(own)))


def _nist_packets(rows: DataFrame, links: int, carriers: int, config: DataFrame | None, is_open: bool) -> DataFrame:
    rows = open_channel(rows) if is_open else rows
    patterns = [[0, 1, 3, 4, 6, 7]] if links == 9 else [list(range(6))]
    rows = L.drop_zero_slots(rows, links, carriers, IQ, patterns=patterns, active_carriers=56)
    for s in IQ:  # stored as receiver, then transmitter, then carrier
        rows = rows.withColumn(s, A.as_floats(A.permute(s, (3, 2, 56), (2, 1, 0))))
    rows = S.add_amplitude(rows).withColumnRenamed("row_index", "packet_index")
    facts = rows.select(ID).distinct()
    if config is not None:
        facts = J.attach_config(facts, config)
    else:
        facts = facts.withColumn("config", F.create_map().cast("map<string,string>"))
    facts = facts.select(
        ID, TL.rate_from_config(F.try_element_at("config", F.lit("msgfreq")), F.col(ID)).alias(
            "sample_rate_hz"),
        F.coalesce(F.try_element_at("config", F.lit("pattern")), F.when(
            F.col(ID).rlike(r"(?i)BreathingPattern\d+"),
            F.regexp_extract(ID, r"(?i)BreathingPattern\d+", 0))).alias("source_label"))
    rows = join_facts(rows, facts, [ID], F.col("packet_index"))
    return TL.synth_time(rows, F.col("sample_rate_hz"))


def ntu_fi(df: DataFrame, path: str = "path") -> DataFrame:
    """``row_index`` (342 antenna-major carriers) and ``data`` over time."""
    paths = df.select(ID, path).distinct()
    rows = L.orient_time_first(df.select(ID, "row_index", "data"), "data", [342])
    rows = L.stride_packets(_expect(rows, "data", [342], "expected 3 x 114 carriers"), 4)
    rows = L.permute_axes(rows, "data", ["rx", "sub"], ["sub", "rx"], {"rx": 3, "sub": 114})
    rows = rows.withColumn("amplitude", A.as_floats("data")).drop("data")
    mean, std = V.NTU_FI_NORMALIZATION
    rows = S.affine_companion(rows, "amplitude", mean, std, "official_normalized_amplitude")
    return join_facts(rows, paths, [ID], F.col("packet_index")).withColumn(
        "source_label", T.parent_name(path))


def operanet(df: DataFrame) -> DataFrame:
    """Columns ``tx#rx#_sub#`` and ``..._imag``, ``packet_index``, ``timestamp_ms``, labels."""
    rows = L.columns_to_vector(df, r"tx\d+rx\d+_sub\d+", 270, "csi_real")
    rows = L.columns_to_vector(rows, r"tx\d+rx\d+_sub\d+_imag", 270, "csi_imag")
    for s in IQ:
        rows = L.permute_axes(rows, s, ["tx", "rx", "sub"], ["sub", "tx", "rx"],
                              {"tx": 3, "rx": 3, "sub": 30})
    rows = _polar(rows)
    if "timestamp_ms" not in rows.columns:
        return TL.synth_time(rows, F.lit(1600.0)).withColumn("sample_rate_hz", F.lit(1600.0))
    rows = rows.withColumn("timestamp_s", F.col("timestamp_ms") / 1000.0)
    facts = TL.span_rate(rows, 1600.0).select(ID, F.col("rate_hz").alias("sample_rate_hz"))
    first = rows.groupBy(ID).agg(F.min_by("timestamp_s", "packet_index").alias("_t0"))
    rows = join_facts(rows, facts.join(first, ID), [ID], F.col("packet_index"))
    return rows.withColumn("timestamp_s", F.col("timestamp_s") - F.col("_t0")).drop("_t0", "timestamp_ms")


def signfi(df: DataFrame, samples: int) -> DataFrame:
    """``packet_index`` and ``csi_real``/``csi_imag`` of 30 x 3 x samples values per time step."""
    rows = df
    zipped = F.arrays_zip(*[A.bind(A.permute(s, (90, samples), (1, 0)), lambda flat: F.transform(
        F.sequence(F.lit(0), F.lit(samples - 1)), lambda n: F.slice(flat, n * 90 + 1, 90))).alias(s)
        for s in IQ])
    rows = rows.select(ID, "packet_index", F.posexplode(zipped).alias("sample_index", "_z"))
    return _polar(rows.select(ID, "packet_index", "sample_index", *[F.col("_z")[s].alias(s) for s in IQ]))


def ut_har(df: DataFrame, labels: DataFrame) -> DataFrame:
    """``row_index`` and ``data`` of 250 x 90 values per clip; one label per clip."""
    sized = _expect(df, "data", [250 * 90], "expected clips of 250 x 90").withColumnsRenamed({ERROR: "_own"})
    joined = J.positional_join(sized, labels).withColumnRenamed(ERROR, "_wrong")
    joined = joined.withColumnsRenamed({"_own": ERROR})
    rows = flagged(joined, "data", F.col("_wrong").isNull(), F.col("_wrong")).drop("_wrong").withColumnRenamed("row_index", "sample_index")
    rows = _split(rows, ["data"], 90)
    rows = L.permute_axes(rows, "data", ["rx", "sub"], ["sub", "rx"], {"rx": 3, "sub": 30})
    return rows.withColumn("amplitude", A.as_floats("data")).drop("data").withColumn(
        "source_label", _named(F.col("label"), V.UT_HAR_CLASSES))


def wallhack18k(spark: SparkSession, path: str | list[str], include_ht: bool = False) -> DataFrame:
    """Literal cells; a bad cell, a vector of another length or a file without rows fails its recording."""
    def packets(rows: DataFrame) -> DataFrame:
        rows = S.select_subcarriers(rows.drop("values"), S.training_field_indices(include_ht), IQ)
        rows = S.add_amplitude(rows)
        rows = S.decode_labels(rows, "source_label", V.WALLHACK_CLASSES, "source_label")
        return TL.synth_time(S.power_db_rel(rows), F.lit(100.0))
    cells = ST.read_array_cell_csv(spark, path, strict=False)
    # several passes follow: which recordings fail, the median power, the packets
    cells = cut_lineage(uniform(S.deinterleave_iq(cells, "values"), F.size("values"), "vector lengths", F.col("packet_index")), "checked_cells")
    return P.extract_antenna_setting(_with_empty(spark, path, set_aside(cells, packets)), ID)


def wiar(df: DataFrame, tx: int, rx: int, path: str = "path") -> DataFrame:
    """Decoded records: ``packet_index``, ``timestamp_low`` (microseconds), tx x rx x 30 values."""
    rows = df
    for s in IQ:
        rows = L.permute_axes(rows, s, ["tx", "rx", "sub"], ["sub", "tx", "rx"],
                              {"tx": tx, "rx": rx, "sub": 30})
    first = rows.groupBy(ID).agg(F.min_by("timestamp_low", "packet_index").alias("_t0"))
    rows = join_facts(rows, first, [ID], F.col("packet_index"))
    rows = rows.withColumn("timestamp_s", (F.col("timestamp_low") - F.col("_t0")) / 1e6).drop("_t0")
    return P.extract_action_trial(_polar(rows), path).withColumn("source_label", F.col("activity_label"))


def widar3(spark: SparkSession, path: str | list[str]) -> DataFrame:
    def packets(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("bvp", A.as_floats("values")).drop("values")
        mean, std = V.WIDAR_NORMALIZATION
        return S.affine_companion(rows, "bvp", mean, std, "official_normalized_bvp").withColumnRenamed("row_index", "packet_index")
    cells = ST.read_numeric_csv(spark, path)
    sized = cells.withColumn("error", F.coalesce("error", F.when(F.size("values") != 400, F.lit("expected 400 velocity bins"))))
    return P.extract_gesture(_with_empty(spark, path, set_aside(sized, packets)), ID).withColumn("source_label", F.col("gesture"))


def wifi_80mhz(df: DataFrame, bins: int, path: str = "path") -> DataFrame:
    """``row_index`` and 242, 256 or 1024 carriers; four rows are the antennas of one packet."""
    if bins not in (242, 256, 1024):
        raise ValueError(f"expected 242, 256 or 1024 frequency bins, got {bins}")
    rows = df
    for s in IQ:
        value = F.col(s)
        if bins == 1024:
            value = A.every(A.fft_shift(value), 4)
        elif bins == 256:
            value = A.fft_shift(value)
        if bins != 242:
            value = A.drop_indices(value, A.index_array(V.NULL_256_BINS))
        rows = rows.withColumn(s, value)
    paths = rows.select(ID, path).distinct()
    rows = L.group_rows(rows, 4, IQ)
    for s in IQ:
        rows = L.permute_axes(rows, s, ["rx", "sub"], ["sub", "rx"], {"rx": 4, "sub": 242})
    rows = join_facts(_polar(rows), paths, [ID], F.col("packet_index"))
    return P.extract_monitor_codes(rows, path)


def wifi_presence_movement(spark: SparkSession, path: str | list[str], partitions: int | None = None
                           ) -> DataFrame:
    """Link x subcarrier packets with time from the first one.  A ragged packet, packets of different shape
    or an empty file fail their recording."""
    rows = ST.read_packet_jsonl(spark, path, partitions).withColumnRenamed("packet_error", ERROR)
    rows = cut_lineage(uniform(rows, F.struct("links", "subcarriers"), "packet shapes", F.hash("timestamp_s")), "checked_packets")

    def packets(good: DataFrame) -> DataFrame:
        first = good.groupBy(ID).agg(F.min("timestamp_s").alias("_t0"))
        good = join_facts(good, first, [ID], F.hash("timestamp_s"))
        return S.add_amplitude(good.withColumn("timestamp_s", F.col("timestamp_s") - F.col("_t0")).drop("_t0"))
    return _with_empty(spark, path, set_aside(rows, packets))


def wifi_tad(df: DataFrame, annotations: DataFrame | None = None, info: DataFrame | None = None
             ) -> tuple[DataFrame, DataFrame | None]:
    """``row_index`` and ``data`` of 30-feature rows (or 30 rows over time), and its segments."""
    rows = L.orient_time_first(df, "data", [30])
    rows = _expect(rows, "data", [30], "expected one 30-feature axis")
    rows = rows.withColumn("amplitude", A.as_floats("data")).drop("data")
    rows = S.affine_companion(rows, "amplitude", 0.0, V.WIFI_TAD_SCALE, "official_normalized_amplitude")
    if annotations is None:
        return rows, None
    if info is None:
        info = df.sparkSession.createDataFrame(
            [], "name string, row_index long, count string, sample_count string")
    return rows, D.rescale_annotations(annotations, info, V.WIFI_TAD_CLASSES)


def wimans(df: DataFrame, annotations: DataFrame | None = None, path: str = "path") -> DataFrame:
    """``packet_index`` and ``amplitude`` of 3 x 3 x 30 values; clips last three seconds."""
    rows = L.permute_axes(df, "amplitude", ["tx", "rx", "sub"], ["sub", "tx", "rx"],
                          {"tx": 3, "rx": 3, "sub": 30})
    facts = df.groupBy(ID, path).agg(TL.fixed_clip_rate(F.count(F.lit(1)), 3.0).alias("sample_rate_hz"))
    if annotations is not None:
        facts = J.annotation_join(facts, annotations, path)
        users = [c for c in annotations.columns if c.startswith("user_")]
        acts = T.distinct_filled([c for c in users if c.endswith("_activity")])
        places = T.distinct_filled([c for c in users if c.endswith("_location")])
        count = F.col("number_of_users").cast("int")
        facts = (facts.withColumn("source_label", T.joined(acts)).withColumn("locations", places)
                 .withColumn("occupancy", T.people(count))
                 .withColumn("band", F.concat(F.col("wifi_band").cast("string"), F.lit(" GHz")))
                 .drop(*users))
    else:
        facts = facts.withColumn("source_label", F.lit(None).cast("string"))
    facts = facts.withColumn("source_label", F.coalesce("source_label", T.file_stem(path))).drop(path)
    rows = join_facts(rows, facts, [ID], F.col("packet_index"))
    return TL.synth_time(rows, F.col("sample_rate_hz"))


def xrf_v2(df: DataFrame, intervals: DataFrame, receivers: Sequence[int] = (0, 1, 2),
           path: str = "path") -> DataFrame:
    """``packet_index``, ``amplitude`` and ``phase_rad`` of 3 x 3 x 30 values, and label intervals
    ``interval_order``, ``label_id``, ``start_index``, ``end_index``."""
    rows, signals = df, ("amplitude", "phase_rad")
    for s in signals:
        rows = L.select_receivers(rows, s, receivers)
        rows = L.permute_axes(rows, s, ["rx", "tx", "sub"], ["sub", "tx", "rx"],
                              {"rx": len(receivers), "tx": 3, "sub": 30})
    lengths = df.groupBy(ID).agg(F.count(F.lit(1)).alias("source_length"))
    named = S.decode_labels(intervals, "label_id", V.XRF_V2_ACTIONS, "label", "null")
    checked = D.checked_intervals(named, lengths)
    if ERROR not in rows.columns:
        checked = flagged(checked.withColumnRenamed(ERROR, "_wrong"), "start_index", F.col("_wrong").isNull(), F.col("_wrong")).drop("_wrong")
        return P.extract_sequence(D.paint_labels(rows, checked), path)
    wrong = checked.groupBy(ID).agg(F.min(ERROR).alias("_wrong")).where("_wrong is not null")
    rows = join_facts(rows, wrong, [ID], F.col("packet_index"))
    rows = rows.withColumn(ERROR, F.coalesce(ERROR, "_wrong")).drop("_wrong")
    return P.extract_sequence(set_aside(rows, lambda good: D.paint_labels(good, checked.where(F.col(ERROR).isNull()).drop(ERROR))), path)


def xrf55(df: DataFrame, path: str = "path") -> DataFrame:
    """``row_index`` (270 flattened channels) and ``data`` of 1000 time samples."""
    paths = df.select(ID, path).distinct()
    rows = L.orient_time_first(df.select(ID, "row_index", "data"), "data", [270])
    rows = L.permute_axes(rows, "data", ["rx", "sub"], ["sub", "rx"], {"rx": 9, "sub": 30})
    rows = rows.withColumn("amplitude", A.as_floats("data")).drop("data")
    rows = join_facts(rows, paths, [ID], F.col("packet_index"))
    return P.extract_clip_id(rows, path).withColumn("source_label", F.col("activity_label"))


def generic(df: DataFrame, keep: Sequence[str] = (ID, "packet_index")) -> DataFrame:
    """Any table: arrays and metadata by their known names; amplitude from the complex parts."""
    rows = resolve_aliases(df, keep=keep)
    if set(IQ) <= set(rows.columns):
        for s in IQ:
            rows = rows.withColumn(s, A.as_floats(s))
        return S.add_amplitude(rows.drop("data"))
    return rows.withColumn("amplitude", A.as_floats("data")).drop("data")


ADAPTERS = {
    "aril": aril, "csi-bench": csi_bench, "csida": csida, "ehunam": ehunam,
    "exposing-csi": exposing_csi, "figshare-csi-har": figshare_csi_har,
    "glasgow-activity-localization": glasgow_activity_localization,
    "glasgow-multiuser": glasgow_multiuser, "mm-fi": mm_fi, "nist-breathesmart": nist_breathesmart,
    "ntu-fi": ntu_fi, "operanet": operanet, "signfi": signfi, "ut-har": ut_har,
    "wallhack18k": wallhack18k, "wiar": wiar, "widar3": widar3, "wifi-80mhz": wifi_80mhz,
    "wifi-presence-movement": wifi_presence_movement, "wifi-tad": wifi_tad, "wimans": wimans,
    "wipe-fall": wipe_fall, "wireless-har-wifi-uwb": wireless_har, "xrf-v2": xrf_v2, "xrf55": xrf55,
}


def adapter_for(dataset_id: str):
    """The data set's function, for use with ``df.transform``; an unknown id is an error."""
    if dataset_id not in ADAPTERS:
        raise ValueError(f"no adapter for {dataset_id}; known: {', '.join(sorted(ADAPTERS))}")
    return ADAPTERS[dataset_id]


__all__ = ["ADAPTERS", "adapter_for", "generic"]
