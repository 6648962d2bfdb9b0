"""Finding sources, their overrides, official split lists and integrity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from packetloom.functions import text as T
from packetloom.functions.paths import predefined_split
from packetloom.operators.joins import ancestors
from packetloom.session import cut_lineage

SPLIT_ALIASES = {  # fixed values: names of the partitions in official lists
    "train": ("train", "training"), "val": ("val", "valid", "validation"),
    "test": ("test", "testing")}
ID_FIELDS = ("ids", "samples", "files", "data")  # fixed values: where an object keeps its ids
SNIFF_LENGTH = 2048                              # fixed value: characters looked at
LARGEST_CONTENT = (1 << 31) - (1 << 20)          # bytes that one binary value can hold, with room for its row


def list_files(spark: SparkSession, root: str, content: bool = False, empty: bool = False) -> DataFrame:
    """Files below a folder with path, relative path, size and time; content only on demand.

    A file that one value cannot hold has NULL content.  Readers skip files of no bytes; ``empty`` adds
    them, without time, from the listing that the driver holds anyway.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    columns = ["path", "length", "modificationTime"]
    if content:   # the reader skips what the length filter excludes before it opens the file
        large = raw.where(F.col("length") > LARGEST_CONTENT).select(*columns, F.lit(None).cast("binary").alias("content"))
        found = raw.where(F.col("length") <= LARGEST_CONTENT).select(*columns, "content").unionByName(large)
    else:
        found = raw.select(*columns)
    if empty:
        names = spark.createDataFrame([(p,) for p in raw.inputFiles()], "path string")
        names = names.select(F.regexp_replace(F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/").alias("path"))
        seen = raw.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"))
        gone = names.join(seen, "path", "left_anti").withColumn("length", F.lit(0).cast("bigint"))
        found = found.unionByName(gone, allowMissingColumns=True)
    plain = F.regexp_replace(F.col("path"), r"^file:/+", "/")
    base = root.rstrip("/") + "/"
    return found.withColumn("relative_path", F.when(
        F.startswith(plain, F.lit(base)), F.substr(plain, F.lit(len(base) + 1))).otherwise(plain))


def matching_patterns(files: DataFrame, patterns: Sequence[str], path: str = "relative_path"
                      ) -> DataFrame:
    """Files that match at least one glob."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.col(path).rlike(T.glob_to_regex(p))
    return files.where(hit)


def folder_sources(files: DataFrame, patterns: Sequence[str], path: str = "relative_path") -> DataFrame:
    """Folders that match a glob, as sources: made from the listing by grouping the files below them.

    ``length`` is the sum, ``modificationTime`` the latest and ``files`` the number of the files; a folder
    inside a matching folder is no source of its own.
    """
    above = files.select("length", "modificationTime", F.col(path).alias("_file"), F.explode(ancestors(F.col(path))).alias("_a"))
    found = matching_patterns(above.select("length", "modificationTime", "_file", F.col("_a.depth").alias("_depth"),
                                           F.col("_a.folder").alias(path)), patterns, path)
    first = found.groupBy("_file").agg(F.min_by(path, "_depth").alias(path), F.first("length").alias("length"),
                                       F.first("modificationTime").alias("modificationTime"))
    return first.groupBy(path).agg(F.sum("length").alias("length"), F.max("modificationTime").alias("modificationTime"),
                                   F.count(F.lit(1)).alias("files"))


def first_characters(spark: SparkSession, path: str | list[str], length: int = SNIFF_LENGTH) -> DataFrame:
    """``path``, ``head``: the first characters of each text file, without its whole content in one value.

    Of each file at most ``length`` lines of at most ``length`` characters leave the task that reads them.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"), F.substring("value", 1, length).alias("_line")).where("_start = 0")
    place = F.row_number().over(Window.partitionBy("path").orderBy("_id"))
    few = lines.withColumn("_n", place).where(F.col("_n") <= length)
    heads = few.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("_n", "_line"))).alias("_all"))
    return heads.select("path", F.substring(F.array_join(F.transform("_all", lambda x: x["_line"]), "\n"), 1, length).alias("head"))


def leading_text(content: Column, length: int = SNIFF_LENGTH) -> Column:
    """The first characters of UTF-8 bytes; bytes that are no UTF-8 are left out, as is a character cut in two.

    A few bytes a character are looked at first, and the whole content only where those hold too many odd ones.
    """
    spared, odd = "\uffff", "\ufffd"   # a replacement sign that the text itself holds stays

    def characters(raw: Column) -> Column:
        text = F.replace(raw.cast("string"), F.lit(odd), F.lit(spared))
        return F.translate(F.replace(F.make_valid_utf8(text), F.lit(odd), F.lit("")), spared, odd)

    few = characters(F.substring(content, 1, length * 4))
    enough = (F.char_length(few) >= length) | (F.octet_length(content) <= length * 4)
    return F.substring(F.when(enough, few).otherwise(characters(content)), 1, length)


def discover_sources(files: DataFrame, patterns: Sequence[str], limit: int | None = None,
                     sniff: str | None = None, path: str = "relative_path") -> DataFrame:
    """Distinct matching files in path order; ``limit`` takes the first ones of that order.

    ``sniff`` keeps files whose first 2048 characters contain a word (needs ``content``).
    """
    found = matching_patterns(files, patterns, path)
    if sniff is not None:
        found = found.where(F.contains(leading_text(F.col("content")), F.lit(sniff)))
    found = found.dropDuplicates([path])
    return found.orderBy(path).limit(limit) if limit is not None else found


def override_rows(rows: DataFrame) -> DataFrame:
    """``(key, metadata)``: key is sample_id else source_file with ``/``, empty values dropped."""
    def filled(c: str) -> Column:
        return F.when(F.col(c).cast("string") != "", F.col(c).cast("string")) \
            if c in rows.columns else F.lit(None).cast("string")

    names = [c for c in rows.columns if c != "row_index"]
    pairs = [x for c in names for x in (F.lit(c), F.col(c).cast("string"))]
    keyed = rows.withColumn("key", T.unix_path(F.coalesce(filled("sample_id"), filled("source_file")))
                            ).where(F.col("key").isNotNull())
    return keyed.withColumn("metadata", F.map_filter(
        F.create_map(*pairs), lambda k, v: v.isNotNull() & (v != "")))


def read_overrides(spark: SparkSession, csv_path: str | None = None, jsonl_path: str | None = None,
                   ) -> DataFrame:
    """User metadata from a CSV, else from JSON Lines; the last row of a repeated key counts."""
    if csv_path:
        rows = spark.read.csv(csv_path, header=True)
    elif jsonl_path:
        # one wide string column per key seen; values keep their written form
        rows = spark.read.option("primitivesAsString", "true").json(jsonl_path)
    else:
        return spark.createDataFrame([], "key string, metadata map<string,string>")
    rows = rows.withColumn("row_index", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id")))
    keyed = override_rows(rows).select("key", "metadata", "row_index")
    return keyed.groupBy("key").agg(F.max_by("metadata", "row_index").alias("metadata"))


def _ids(node: Column) -> Column:
    """The ids in a JSON node: a scalar, a list of those, or an object holding a list.

    An object without an id field holds none; text that only looks like a list is an id.
    """
    field = F.coalesce(*[F.get_json_object(node, f"$.{f}") for f in ID_FIELDS])
    is_object = F.startswith(F.ltrim(node), F.lit("{"))
    listed = F.when(is_object, field).otherwise(node)
    as_list = F.from_json(listed, ST.ArrayType(ST.StringType()))
    return F.when(listed.isNull(), F.array().cast("array<string>")).when(
        F.startswith(F.ltrim(listed), F.lit("[")), F.coalesce(as_list, F.array(listed))).otherwise(F.array(listed))


def flatten_ids(node: Column, depth: int = 16) -> Column:
    """All ids at most ``depth`` levels below a JSON node, in order; deeper lists stay as text.

    An odd item costs itself only.
    """
    out = _ids(node)
    for _ in range(depth - 1):
        out = F.flatten(F.transform(out, lambda x: F.when(F.ltrim(x).rlike(r"^[\[{]"), _ids(x)).otherwise(F.array(x))))
    return F.filter(out, lambda x: x.isNotNull())


def unnested(rows: DataFrame, keys: Sequence[str], depth: int = 16) -> DataFrame:
    """``rows`` (``keys``, ``position``, ``member``) without nested lists, whatever their depth.

    Each round opens ``depth`` more levels of the members that are still lists, until none is.  Their
    items take the place of the list; text that only looks like a list is an id.
    """
    def is_list() -> Column:
        return F.ltrim("member").rlike(r"^[\[{]") & F.try_parse_json("member").isNotNull()

    rows = cut_lineage(rows.withColumn("_at", F.array("position")), "split_members")
    if rows.where(is_list()).isEmpty():
        return rows.drop("_at")
    while True:
        opened = rows.withColumn("_in", F.when(is_list(), flatten_ids(F.col("member"), depth)).otherwise(F.array("member")))
        opened = opened.select(*keys, "_at", F.col("member").alias("_was"), F.posexplode("_in").alias("_i", "member"))
        rows = cut_lineage(opened.select(*keys, F.concat("_at", F.array("_i")).alias("_at"), "member",
                                         (is_list() & (F.col("member") != F.col("_was"))).alias("_more")), "split_members")
        if rows.where("_more").isEmpty():
            break
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_at")) - 1     # one list, which was one value before
    return rows.select(*keys, place.alias("position"), "member")


def split_members(payloads: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """``(path, partition, position, member)`` of split lists given as JSON text.

    An object names its partitions; anything else belongs to the partition its file name says.
    """
    is_object = F.startswith(F.ltrim(text), F.lit("{"))
    nodes = []
    for part, aliases in SPLIT_ALIASES.items():
        node = F.coalesce(*[F.get_json_object(F.col(text), f"$.{a}") for a in aliases])
        nodes.append(F.struct(F.lit(part).alias("partition"), F.when(is_object, node).alias("node")))
    named = F.filter(F.array(*nodes), lambda n: n["node"].isNotNull())
    whole = F.array(F.struct(predefined_split(T.file_name(path)).alias("partition"),
                             F.col(text).alias("node")))
    chosen = F.when(F.size(named) > 0, named).otherwise(
        F.filter(whole, lambda n: n["partition"].isNotNull()))
    rows = payloads.select(path, F.explode(chosen).alias("_n"))
    found = rows.select(path, F.col("_n.partition").alias("partition"),
                        F.posexplode(flatten_ids(F.col("_n.node"))).alias("position", "member"))
    return unnested(found, [path, "partition"])


def read_external_split(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Official split lists from JSON files; each file is one list of ids."""
    raw = spark.read.text(paths, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    return split_members(raw.withColumnRenamed("value", "text"))


def checksum(algorithm: Column, content: Column) -> Column:
    return F.when(algorithm == "md5", F.md5(content)).when(
        algorithm == "sha1", F.sha1(content)).when(
        algorithm == "sha256", F.sha2(content, 256)).when(
        algorithm == "sha512", F.sha2(content, 512))


def audit_sources(files: DataFrame, expected: DataFrame, name: str = "name") -> DataFrame:
    """Files against a manifest ``(name, bytes, checksum 'algorithm:hex')``.

    ``files``: ``name``, ``length``, ``content``.  Every expected file gets a row; ``error`` is NULL
    when it passed.  A checksum of NULL content (a file too large for one value) is not verified,
    and the error says so.
    """
    want = expected.select(name, F.col("bytes").alias("_bytes"), F.col("checksum").alias("_sum"))
    rows = want.join(files, name, "left")
    algorithm = F.substring_index("_sum", ":", 1)
    digest = F.substr("_sum", F.length(algorithm) + 2)
    wrong = F.col("_sum").isNotNull() & F.col("content").isNotNull() & (
        checksum(algorithm, F.col("content")) != digest)
    return rows.select(
        name, "length", F.sha2("content", 256).alias("sha256"),
        F.when(F.col("length").isNull(), F.lit("missing file")).when(
            F.col("_bytes").isNotNull() & (F.col("_bytes") != F.col("length")),
            F.lit("size mismatch")).when(wrong, F.lit("checksum mismatch")).when(
            F.col("_sum").isNotNull() & F.col("content").isNull(), F.lit("checksum not verified")).alias("error"))
