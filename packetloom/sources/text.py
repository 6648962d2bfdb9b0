"""Text sources as packet rows.

File order matters in CSV matrices: rows are ordered by file, split offset and position in the
split, which Spark keeps when it reads a file in pieces.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from packetloom.functions import arrays as A
from packetloom.functions import text as T
from packetloom.operators.ordered import join_facts, with_position
from packetloom.session import cut_lineage

CHANNEL_COLUMN = r"^(real|imag|amplitude)_l(\d+)_s(\d+)$"  # fixed value: channel header
FEW_SPLITS = 100_000   # pieces of files whose places go to every task
CSV_CELL = r',("(?:[^"]|"")*"|[^,]*)'   # one cell and the comma before it


def recording_of(path: Column | None = None) -> Column:
    return F.col("_metadata.file_path") if path is None else path


@dataclass(frozen=True)
class Chosen:
    """Files below ``root`` that a sources table (``path``) names; no reader needs them as a list."""

    root: str
    sources: DataFrame


def full_path(path: Column) -> Column:
    """One form for the paths of listings."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def of_chosen(rows: DataFrame, path: str | list[str] | Chosen, spread: Column) -> DataFrame:
    """Rows of the chosen files; their ``recording_id``, percent-encoded by readers, becomes the listed path."""
    if not isinstance(path, Chosen):
        return rows
    plain = F.url_decode(F.replace(F.col("recording_id"), F.lit("+"), F.lit("%2B")))
    rows = rows.withColumn("recording_id", full_path(plain))
    names = path.sources.select(full_path(F.col("path")).alias("recording_id")).distinct()
    return join_facts(rows, names, ["recording_id"], spread, how="inner")


def lines_of(spark: SparkSession, path: str | list[str] | Chosen) -> DataFrame:
    """``recording_id, _start, _id, value`` of every line; ``_id`` ascends inside a split."""
    chosen = isinstance(path, Chosen)
    reader = spark.read.option("recursiveFileLookup", "true") if chosen else spark.read
    rows = reader.text(path.root if chosen else path).select(
        recording_of().alias("recording_id"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"), "value")
    return of_chosen(rows, path, F.col("_id"))


def wide_channels(names: Sequence[str]) -> tuple[int, int, dict[tuple[str, int, int], str]]:
    """Links, subcarriers and the column of every (component, link, subcarrier)."""
    cells = {}
    for name in names:
        match = re.match(CHANNEL_COLUMN, name)
        if match:
            cells[match[1], int(match[2]), int(match[3])] = name
    if not cells:
        raise ValueError("CSV needs real/imag pairs or amplitude columns")
    return (max(k[1] for k in cells) + 1, max(k[2] for k in cells) + 1, cells)


def wide_to_packets(df: DataFrame, keys: Sequence[str] = ("recording_id",)) -> DataFrame:
    """Wide channel columns to ``csi_real``/``csi_imag`` arrays, missing cells 0.

    Complex only when some real and some imaginary column exists; otherwise the amplitude goes
    to the real part and the representation says so.
    """
    if "timestamp_s" not in df.columns:
        raise ValueError("CSV must contain a timestamp_s column")
    links, carriers, cells = wide_channels(df.columns)
    kinds = {k[0] for k in cells}
    is_complex = {"real", "imag"} <= kinds
    if not is_complex and "amplitude" not in kinds:
        raise ValueError("CSV needs real/imag pairs or amplitude columns")

    def vector(kind: str) -> Column:
        return F.array(*[
            F.coalesce(F.col(cells[kind, l, s]).cast("float"), F.lit(0).cast("float"))
            if (kind, l, s) in cells else F.lit(0).cast("float")
            for l in range(links) for s in range(carriers)])

    real = vector("real" if is_complex else "amplitude")
    imag = vector("imag") if is_complex else F.array_repeat(F.lit(0).cast("float"), links * carriers)
    extra = [c for c in ("source_order",) if c in df.columns]
    return df.select(
        *keys, *extra, F.col("timestamp_s").cast("double").alias("timestamp_s"),
        real.alias("csi_real"), imag.alias("csi_imag"),
        F.lit("complex_csi" if is_complex else "amplitude_only").alias("source_representation"),
        F.lit(links).alias("links"), F.lit(carriers).alias("subcarriers"))


def csv_cells(line: Column) -> Column:
    """The cells of a CSV line; quoted cells may hold commas and doubled quotes, no line breaks."""
    quoted = F.transform(
        F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(CSV_CELL), F.lit(1)),
        lambda c: F.when(F.startswith(c, F.lit('"')), F.replace(
            F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(c))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ","))


def csv_lines(spark: SparkSession, path: str | list[str] | Chosen) -> tuple[DataFrame, DataFrame]:
    """Lines of CSV files, and the header of each file with its ``names``.

    Files of one call may have different headers.  The header is a file's first line that is not
    blank; headers are written once, so the text is read twice in all.
    """
    lines = lines_of(spark, path).where(F.trim("value") != "")
    headers = lines.where("_start = 0").groupBy("recording_id").agg(
        F.min_by("value", "_id").alias("_header"))
    names = F.transform(csv_cells(F.col("_header")), lambda n: F.trim(n))
    return lines, cut_lineage(headers.withColumn("names", names), "headers")


def csv_rows(lines: DataFrame, facts: DataFrame) -> DataFrame:
    """Data lines as ``cells`` with the facts of their file; lines that repeat the header go."""
    rows = join_facts(lines.withColumn("cells", csv_cells(F.col("value"))), facts,
                      ["recording_id"], F.col("_id"), how="inner")
    return rows.where(F.col("value") != F.col("_header")).drop("value", "_header")


def reject_bad(facts: DataFrame) -> None:
    """Raise for a file whose header cannot be used."""
    bad = facts.where(F.col("error").isNotNull()).select("recording_id", "error").first()
    if bad:
        raise ValueError(f"{bad['recording_id']}: {bad['error']}")


def wide_layouts(headers: DataFrame) -> DataFrame:
    """Where a file keeps its channels: positions of the real and imaginary parts, link by link."""
    def group(i: int) -> Column:
        return F.regexp_extract("_name", CHANNEL_COLUMN, i)

    named = headers.select("recording_id", "_header", F.posexplode("names").alias("_at", "_name"))
    cells = named.select(
        "recording_id", "_header", "_at",
        F.when(F.col("_name") == "timestamp_s", F.lit("time")).otherwise(group(1)).alias("_kind"),
        group(2).try_cast("int").alias("_l"), group(3).try_cast("int").alias("_s"))
    # a name that comes twice counts once, at its last place
    cells = cells.groupBy("recording_id", "_header", "_kind", "_l", "_s").agg(F.max("_at").alias("_at"))
    files = cells.groupBy("recording_id", "_header").agg(
        F.max(F.when(F.col("_kind") == "time", F.col("_at"))).alias("_time"),
        (F.max("_l") + 1).alias("links"), (F.max("_s") + 1).alias("subcarriers"),
        *[F.collect_list(F.when(F.col("_kind") == k, F.struct("_l", "_s", "_at"))).alias(f"_{k}")
          for k in ("real", "imag", "amplitude")])
    is_complex = (F.size("_real") > 0) & (F.size("_imag") > 0)

    def places(entries: Column) -> Column:
        by_cell = F.map_from_entries(F.transform(entries, lambda e: F.struct(
            e["_l"] * F.col("subcarriers") + e["_s"], e["_at"])))
        every = F.sequence(F.lit(0), F.col("links") * F.col("subcarriers") - 1)
        return A.bind(by_cell, lambda m: F.transform(every, lambda p: F.try_element_at(m, p)))

    return files.select(
        "recording_id", "_header", "_time", "links", "subcarriers",
        places(F.when(is_complex, F.col("_real")).otherwise(F.col("_amplitude"))).alias("_first"),
        places(F.filter("_imag", lambda e: is_complex)).alias("_second"),
        F.when(is_complex, F.lit("complex_csi")).otherwise(F.lit("amplitude_only")).alias("source_representation"),
        F.when(F.col("_time").isNull(), F.lit("CSV must contain a timestamp_s column")).when(
            ~is_complex & (F.size("_amplitude") == 0),
            F.lit("CSV needs real/imag pairs or amplitude columns")).alias("error"))


def read_wide_csv(spark: SparkSession, path: str | list[str] | Chosen, strict: bool = True) -> DataFrame:
    """Packets of wide CSV files; one file is one recording, read by its own header.

    Missing cells are 0.  With ``strict`` an unusable header or cell is an error of the call;
    without, ``packet_error`` names it and the packet's arrays are NULL.  Files without any data
    line are what ``without_rows`` gives.
    """
    lines, headers = csv_lines(spark, path)
    layouts = wide_layouts(headers)
    if strict:
        reject_bad(layouts)
    rows = csv_rows(lines, layouts)

    def filled(at: Column) -> Column:
        return F.nullif(F.trim(F.get("cells", at)), F.lit(""))

    def vector(places: str) -> Column:
        return F.transform(places, lambda i: F.when(filled(i).isNull(), F.lit(0).cast("float")).otherwise(
            filled(i).try_cast("float")))

    rows = rows.withColumns({
        "timestamp_s": filled(F.col("_time")).try_cast("double"),
        "csi_real": vector("_first"), "csi_imag": vector("_second")})
    odd = (F.col("timestamp_s").isNull() & filled(F.col("_time")).isNotNull()) | F.exists(
        "csi_real", lambda x: x.isNull()) | F.exists("csi_imag", lambda x: x.isNull())
    error = F.coalesce("error", F.when(odd, F.lit("a cell is not a number")))
    rows = rows.withColumn("packet_error", error)
    otherwise = F.raise_error(F.col("packet_error")) if strict else F.lit(None)
    arrays = [F.when(F.col("packet_error").isNull(), F.col(c)).otherwise(otherwise).alias(c)
              for c in ("csi_real", "csi_imag")]
    return rows.select("recording_id", F.struct("_start", "_id").alias("source_order"), "timestamp_s", *arrays,
                       "source_representation", "links", "subcarriers", *([] if strict else ["packet_error"]))


def without_rows(spark: SparkSession, path: str | list[str] | Chosen, rows: DataFrame) -> DataFrame:
    """``recording_id, error`` of the files below ``path`` that gave no row.

    Readers skip files of no bytes, so the names come from the listing that the driver holds anyway.
    """
    def plain(c: Column) -> Column:
        return F.regexp_replace(c, "^file:/+", "file:/")

    if isinstance(path, Chosen):
        listed = path.sources.select(full_path(F.col("path")).alias("recording_id")).distinct()
        seen = rows.select("recording_id").distinct()
        return listed.join(seen, "recording_id", "left_anti").withColumn("error", F.lit("source has no rows"))
    listed = spark.createDataFrame([(p,) for p in spark.read.text(path).inputFiles()], "recording_id string")
    seen = rows.select(plain(F.col("recording_id")).alias("recording_id")).distinct()
    return listed.select(plain(F.col("recording_id")).alias("recording_id")).join(
        seen, "recording_id", "left_anti").withColumn("error", F.lit("source has no rows"))


PACKET_SCHEMA = ST.StructType([
    ST.StructField("t", ST.DoubleType()),
    ST.StructField("csi", ST.ArrayType(ST.ArrayType(ST.StructType([
        ST.StructField("r", ST.DoubleType()), ST.StructField("i", ST.DoubleType())])))),
])


def json_packets(df: DataFrame, keys: Sequence[str] = ("recording_id",)) -> DataFrame:
    """``t`` and ``csi[subcarrier][link]{r,i}`` to ``link x subcarrier`` arrays.

    ``packet_error`` marks packets that lack a key or are ragged; uniformity across a recording
    is ``quality.assert_uniform``.
    """
    carriers, links = F.size("csi"), F.size(F.get("csi", F.lit(0)))
    ragged = F.exists("csi", lambda row: F.size(row) != links)

    def part(name: str) -> Column:
        flat = F.flatten(F.transform("csi", lambda row: F.transform(row, lambda v: v[name].cast("float"))))
        return A.permute(flat, (carriers, links), (1, 0))

    return (df.withColumn("packet_error", F.when(
                F.col("t").isNull() | F.col("csi").isNull(), F.lit("records need t and csi")).when(
                ragged, F.lit("inconsistent packet shape")))
            .withColumn("timestamp_s", F.col("t"))
            .withColumn("csi_real", F.when(F.col("packet_error").isNull(), part("r")))
            .withColumn("csi_imag", F.when(F.col("packet_error").isNull(), part("i")))
            .withColumn("links", links).withColumn("subcarriers", carriers)
            .select(*keys, "timestamp_s", "csi_real", "csi_imag", "links", "subcarriers",
                    "packet_error"))


def read_packet_jsonl(spark: SparkSession, path: str | list[str] | Chosen, partitions: int | None = None
                      ) -> DataFrame:
    """Packets of (gzip) JSON Lines files, labelled by their folder unless it is ``original``.

    A gzip file is read by one task; the rows are then spread evenly, not by recording.
    """
    chosen = isinstance(path, Chosen)
    reader = spark.read.option("recursiveFileLookup", "true") if chosen else spark.read
    raw = reader.schema(PACKET_SCHEMA).json(path.root if chosen else path).select("*", recording_of().alias("recording_id"))
    raw = of_chosen(raw, path, F.xxhash64("t"))
    if partitions:
        raw = raw.repartition(partitions)
    folder = T.parent_name("recording_id")
    return json_packets(raw).withColumn("source_label", F.when(
        folder != "original", F.initcap(F.translate(folder, "_", " "))))


def read_numeric_csv(spark: SparkSession, path: str | list[str] | Chosen, strict: bool = True, keep_empty: bool = False) -> DataFrame:
    """CSV matrices of any width: one row per line with ``row_index`` and ``values``.

    Header lines (nothing numeric) and columns without any number go away per recording; with
    ``strict`` a cell that is missing or still not a number gives the row an ``error``.
    ``keep_empty`` keeps both in their places instead, with NaN for what is no number; only blank lines go.
    """
    values = F.transform(F.split("value", ","), lambda x: x.try_cast("double"))
    if keep_empty:
        parsed = F.transform(values, lambda x: F.coalesce(x, F.lit(float("nan"))))
        return _placed(spark, cut_lineage(_kept_lines(spark, path, parsed, F.trim("value") != ""), "matrix"))
    parsed = F.transform(values, lambda x: F.when(~F.isnan(x), x))
    # text is parsed once: finding the used columns and numbering the rows read the parsed table
    rows = cut_lineage(_kept_lines(spark, path, parsed, F.exists("values", lambda x: x.isNotNull())), "matrix")
    return numeric_matrix(rows, strict, numbered=_placed)


def _kept_lines(spark: SparkSession, path: str | list[str] | Chosen, values: Column, keep: Column) -> DataFrame:
    """``recording_id, _start, _id, values`` of the lines to keep; ``_id`` ascends by one inside a split."""
    chosen = isinstance(path, Chosen)
    reader = spark.read.option("recursiveFileLookup", "true") if chosen else spark.read
    # the first number only stands here so that the filter is not moved below it, which would parse twice
    rows = reader.text(path.root if chosen else path).select(
        recording_of().alias("recording_id"), F.col("_metadata.file_block_start").alias("_start"), "value",
        values.alias("values"), F.monotonically_increasing_id().alias("_id"))
    rows = rows.where(keep).select("recording_id", "_start", F.monotonically_increasing_id().alias("_id"), "values")
    return of_chosen(rows, path, F.col("_id"))


def _placed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``row_index`` of written ``_kept_lines``: no row moves, a split adds what the splits before it hold."""
    splits = rows.groupBy("recording_id", "_start").agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("recording_id").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = cut_lineage(splits.select("recording_id", "_start", (
        F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_least")).alias("_add")), "splits")
    few = splits.count() <= FEW_SPLITS
    return rows.join(F.broadcast(splits) if few else splits, ["recording_id", "_start"]).withColumn(
        "row_index", F.col("_id") + F.col("_add")).drop("_start", "_id", "_add")


def numeric_matrix(rows: DataFrame, strict: bool = True,
                   keys: Sequence[str] = ("recording_id",),
                   order: Sequence[str] = ("_start", "_id"), numbered=None) -> DataFrame:
    """Clean parsed matrix rows and number them in file order.

    ``numbered`` (session, rows) numbers rows that are clean already.
    """
    filled = rows
    if numbered is None:
        rows = rows.withColumn("values", F.transform(
            "values", lambda x: F.when(~F.isnan(x), x)))
        filled = rows.where(F.exists("values", lambda x: x.isNotNull()))
    used = (filled.select(*keys, F.explode(F.filter(F.transform(
                "values", lambda x, i: F.when(x.isNotNull(), i)), lambda i: i.isNotNull())).alias("_c"))
            .distinct().groupBy(*keys).agg(F.sort_array(F.collect_set("_c")).alias("_keep")))
    def packed(rows: DataFrame, spread: str) -> DataFrame:
        return join_facts(rows, used, list(keys), F.col(spread), how="inner").withColumn(
            "values", F.transform("_keep", lambda i: F.get(F.col("values"), i))).drop("_keep")

    if numbered is None:
        out = _numbered(packed(filled, order[-1]), keys, order)
    else:
        out = packed(numbered(rows.sparkSession, filled), "row_index")
    if strict:
        out = out.withColumn("error", F.when(F.exists("values", lambda x: x.isNull()), F.lit(
            "not a rectangular numeric CSV")))
    return out


def _numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``row_index`` in file order; one bucket per 4096 lines of a split, so that they grow with the file."""
    rows = rows.withColumn("_bucket", F.struct(
        *[F.col(c) for c in order[:-1]], F.shiftright(order[-1], 12).alias("part")))
    return with_position(rows, keys, list(order), "_bucket", "row_index").drop("_bucket", *order)


def parse_array_cell(c: str) -> Column:
    """``[1, 2, ...]`` as an array; NULL where the text is no such list."""
    return F.from_json(F.col(c), ST.ArrayType(ST.FloatType()), {"mode": "PERMISSIVE"})


def read_array_cell_csv(spark: SparkSession, path: str | list[str] | Chosen, data_col: str = "data",
                        label_col: str | None = "class", strict: bool = True) -> DataFrame:
    """CSV whose data cells hold a written list; the label column is optional.

    Each file is read by its own header.  ``error`` marks a cell that is no list of numbers and, unless
    ``strict`` makes that an error of the call, the rows of a file without the column.
    """
    lines, headers = csv_lines(spark, path)

    def place(name: str | None) -> Column:
        return F.nullif(F.array_position("names", F.lit(name)), F.lit(0)).cast("int") - 1

    layouts = headers.select(
        "recording_id", "_header", place(data_col).alias("_data"),
        place(label_col).alias("_label")).withColumn("error", F.when(
            F.col("_data").isNull(), F.lit(f"CSV must contain a {data_col} column")))
    if strict:
        reject_bad(layouts)
    rows = csv_rows(lines, layouts).withColumns({
        "source_label": F.nullif(F.get("cells", F.col("_label")), F.lit("")),
        "_cell": F.get("cells", F.col("_data"))}).withColumn("values", parse_array_cell("_cell"))
    bad = F.col("values").isNull() | F.exists("values", lambda x: x.isNull())
    rows = rows.select("recording_id", "_start", "_id", "source_label", "values",
                       F.coalesce("error", F.when(bad, F.lit("not a list of numbers"))).alias("error"))
    rows = cut_lineage(rows, "cells")
    rows = rows.withColumn(
        "_bucket", F.struct("_start", F.shiftright("_id", 12).alias("part")))
    return with_position(rows, ["recording_id"], ["_start", "_id"], "_bucket", "packet_index"
                         ).drop("_bucket", "_start", "_id")


def read_json_arrays(spark: SparkSession, path: str | list[str] | Chosen, schema: ST.StructType,
                     multi_line: bool = False) -> DataFrame:
    """JSON objects or records with a declared schema, one row each, ready for ``resolve_aliases``."""
    reader = spark.read.schema(schema)
    return reader.json(path, multiLine=multi_line).withColumn("recording_id", recording_of())


__all__ = [
    "PACKET_SCHEMA", "json_packets", "numeric_matrix", "parse_array_cell",
    "read_array_cell_csv", "read_json_arrays", "read_numeric_csv", "read_packet_jsonl",
    "read_wide_csv", "wide_channels", "wide_to_packets", "without_rows",
]
