"""Substring dedup: words covered by a window that a document of smaller id also holds are removed.

Every 50-word window has one anchor, its least hash of 25 words; equal windows have equal anchors, so a
window never occurs more often than its anchor does.  Each partition counts the anchors of its documents in
a count-min sketch, merging adds the counters, and the merged sketch overestimates every window's
count.  A second pass groups exactly those windows whose estimate is two or more, by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import (
    SPACE, Hasher, _powers, as_signed, byte_set, extended, fits, flat, mapped, mix, ragged, seeded, ship, slices, spare, words)
from packetloom.session import cut_lineage

SPAN, GRAM = 50, 25
DEPTH = 2                    # rows of the sketch
CELLS_PER_ANCHOR = 8         # cells of each row per expected anchor: about 1.4 % of the anchors that occur once pass
WORD_BYTES = 6               # how many bytes a word takes; only sets the width of the sketch
SKETCH_BYTES = 64 << 20      # a larger bitmap of repeated cells is joined instead of broadcast
HELD = 1 << 21               # anchors a task gathers before it emits their counters
INSIDE = byte_set(SPACE)
SEEDS = seeded(DEPTH, 77)
OTHER = seeded(256, 12)      # the second word hash
NO_ID = -(1 << 63)


def runs_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of ``k`` words by its first word, from one running sum."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    power, unpower = _powers(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * unpower[: len(hashes)], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * power[k: len(hashes) + 1])


def least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    have = 1
    while have < width and len(x):
        step = min(have, width - have)
        x, have = np.minimum(x[:-step], x[step:]), have + step
    return x


class Windows:
    """The windows of one slice: first word, row and anchor of each."""

    def __init__(self, column: pa.Array, span: int):
        self.buf, offsets = flat(column)
        self.start, self.end, self.row = words(self.buf, offsets, INSIDE)
        hashes = Hasher(self.buf).ranges(self.start, self.end)
        gram = (span + 1) // 2
        anchor = least(runs_of(hashes, gram), span - gram + 1)
        self.at = np.flatnonzero(self.row[: len(anchor)] == self.row[span - 1:]) if len(anchor) else np.zeros(0, np.int64)
        self.anchor, self.own = anchor[self.at], self.row[self.at]
        self.hashes, self.span = hashes, span
        counts = np.bincount(self.row, minlength=len(column))
        self.first = np.cumsum(counts) - counts      # of each row, its first word

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows and anchor of each run of windows with one anchor."""
        if not len(self.at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        new = np.ones(len(self.at), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.own[1:] != self.own[:-1])
        begin = np.flatnonzero(new)
        return begin, np.diff(np.append(begin, len(self.at))), self.anchor[begin]

    def keys(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows ``which``."""
        at = self.at[which]
        second = Hasher(self.buf, OTHER).ranges(self.start, self.end)
        return runs_of(self.hashes, self.span)[at], runs_of(second, self.span)[at]


def cells(anchors: np.ndarray, row: int, width: int) -> np.ndarray:
    """The counters of the anchors in one row of the sketch; the rows follow each other."""
    return as_signed((mix(anchors + SEEDS[row]) & np.uint64(width - 1)) + np.uint64(row * width))


def partition_sketch(batches: Iterator[pa.RecordBatch], text: str, width: int, span: int) -> Iterator[pa.RecordBatch]:
    """The counters above zero of one partition.  A document counts each of its anchors once."""
    def counters() -> pa.RecordBatch:
        every = np.concatenate(held)
        found, n = zip(*(np.unique(cells(every, r, width), return_counts=True) for r in range(DEPTH)), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(n).astype(np.int64))], names=["cell", "n"])

    held: list[np.ndarray] = []
    for part in slices(batches, text):
        seen = Windows(part.column(text), span)
        begin, _, anchor = seen.anchors()
        order = np.lexsort((seen.own[begin], anchor))
        own, anchor = seen.own[begin][order], anchor[order]
        once = np.ones(len(order), bool)
        once[1:] = (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])
        held.append(anchor[once])
        if sum(map(len, held)) > HELD:
            yield counters()
            held = []
    if held:
        yield counters()


def merged_sketch(texts: DataFrame, text: str, width: int, span: int) -> DataFrame:
    """The cells whose counters, added over all partitions, are two or more."""
    ship(texts.sparkSession)
    parts = texts.select(text).mapInArrow(lambda batches: partition_sketch(batches, text, width, span), "cell bigint, n bigint")
    return parts.groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1").select("cell")


WINDOWS = "w1 bigint, w2 bigint, doc bigint, own bigint, start int"


def window_rows(batch: pa.RecordBatch, seen: Windows, which: np.ndarray) -> pa.RecordBatch:
    w1, w2 = seen.keys(which) if len(which) else (np.zeros(0, np.uint64),) * 2
    own = seen.own[which]
    start = seen.at[which] - seen.first[own]
    take = pa.array(own)
    return pa.RecordBatch.from_arrays([pa.array(as_signed(w1)), pa.array(as_signed(w2)), batch.column("doc").take(take), batch.column("own").take(take),
                                       pa.array(start, pa.int32())], names=["w1", "w2", "doc", "own", "start"])


def _by_bitmap(texts: DataFrame, hot: DataFrame, width: int, span: int) -> DataFrame:
    """Windows of repeated anchors; the bitmap of the sketch (``DEPTH * width`` bits, checked) goes to the tasks."""
    place = F.col("cell") + 1
    packed = hot.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros((DEPTH * width >> 15) + 1 << 12, np.uint8)
    for b, part in packed.toLocalIterator():
        bits[(b - 1) << 12: b << 12] = np.frombuffer(part, np.uint8)
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        known, seen = shared.value, Windows(batch.column("text"), span)
        begin, n, anchor = seen.anchors()
        on = np.ones(len(begin), bool)
        for r in range(DEPTH):
            c = cells(anchor, r, width)
            on &= (known[c >> 3] >> (c & 7).astype(np.uint8) & 1).astype(bool)
        return window_rows(batch, seen, ragged(begin[on], n[on]))
    return mapped(texts, work, WINDOWS)


def _by_join(texts: DataFrame, hot: DataFrame, width: int, span: int) -> DataFrame:
    """The same where the bitmap is too large: anchors are joined with the repeated cells, row by row."""
    def anchors(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen = Windows(batch.column("text"), span)
        begin, n, anchor = seen.anchors()
        take = pa.array(seen.own[begin])
        columns = [batch.column("doc").take(take), batch.column("own").take(take), pa.array(begin - np.searchsorted(seen.own, seen.own[begin])), pa.array(n)]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array(cells(anchor, r, width)) for r in range(DEPTH))],
                                          names=["doc", "own", "low", "n", *(f"c{r}" for r in range(DEPTH))])
    found = mapped(texts, anchors, "doc bigint, own bigint, low bigint, n bigint, " + ", ".join(f"c{r} bigint" for r in range(DEPTH)))
    for r in range(DEPTH):
        found = found.join(hot, F.col(f"c{r}") == F.col("cell"), "left_semi")
    parts = found.groupBy(F.col("doc").alias("of"), F.col("own").alias("of_own")).agg(F.collect_set(F.struct("low", "n")).alias("parts"))
    joined = texts.join(parts, (F.col("doc") == F.col("of")) & (F.col("own") == F.col("of_own"))).select("doc", "own", "text", "parts")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen, column = Windows(batch.column("text"), span), batch.column("parts")
        each = column.flatten()
        row = np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))
        begin = each.field("low").to_numpy() + np.searchsorted(seen.own, row)
        return window_rows(batch, seen, ragged(begin, each.field("n").to_numpy()))
    return mapped(joined, work, WINDOWS)


def repeated_starts(texts: DataFrame, span: int = SPAN, sketch_bytes: int = SKETCH_BYTES) -> DataFrame:
    """``doc, own, start``: the windows of ``texts`` (``doc, own, text``) that also start in a smaller ``doc``."""
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    expected = 2 * size // WORD_BYTES // (span // 2 + 2) + 1024
    width = 1 << max(15, (CELLS_PER_ANCHOR * expected - 1).bit_length())
    hot = merged_sketch(texts, "text", width, span)
    if DEPTH * width >> 3 <= sketch_bytes:
        found = _by_bitmap(texts, hot, width, span)
    else:
        found = _by_join(texts, cut_lineage(hot, "repeated_cells"), width, span)
    found = cut_lineage(found, "windows")
    oldest = (found.groupBy("w1", "w2").agg(F.min("doc").alias("oldest"), F.max("doc").alias("latest")).where("oldest < latest")
              .select(F.col("w1").alias("x1"), F.col("w2").alias("x2"), "oldest"))
    later = found.join(oldest, (F.col("w1") == F.col("x1")) & (F.col("w2") == F.col("x2"))).where("doc > oldest")
    return later.select("doc", "own", "start")


def _remove(batch: pa.RecordBatch, text: str, starts: str, whole: str, span: int, columns: list[str]) -> pa.RecordBatch:
    """Cut the covered words; bytes.split() parts words at exactly [\\x20\\x09-\\x0D]."""
    buf, offsets = flat(batch.column(text))
    raw, covered, full = buf.tobytes(), batch.column(starts), batch.column(whole).to_pylist()
    n_words, removed, kept = [], [], []
    for r in range(batch.num_rows):
        own = raw[offsets[r]: offsets[r + 1]].split()
        n_words.append(len(own))
        if full[r] and len(own) >= span:
            left = []
        elif covered[r].is_valid:
            on = np.ones(len(own), bool)
            at = np.unique(covered[r].values.to_numpy())
            on[(at[:, None] + np.arange(span)).ravel()] = False
            left = [own[i] for i in np.flatnonzero(on).tolist()]
        else:
            left = own
        removed.append(len(own) - len(left)), kept.append(b" ".join(left))
    out = {n: batch.column(n) for n in columns}
    out |= {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())}
    return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def drop_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", span: int = SPAN, sketch_bytes: int = SKETCH_BYTES) -> DataFrame:
    """``docs`` with ``n_words, n_removed`` and ``kept_text`` (words joined by one space) added or replaced.

    A word goes if a window of ``span`` words over it has the same words as a window of a document with a
    smaller id; repeats inside one document, or between rows of one id, remove nothing.  Null and
    empty texts have no words and become ''; a null id is smaller than any, ids must be integers.
    Repeated rows are treated alike, an empty table stays empty, other columns pass through whatever
    their names.  A text is held in one task, as its row is.

    Documents with equal text are found first by a digest: all but the smallest id are covered whole
    and leave the window passes.  The rest is read twice, once for the sketch.  A bitmap of
    at most ``sketch_bytes`` is broadcast; beyond it the anchors (1 of 13 windows) are joined with the
    repeated cells.  What is shuffled besides is windows that are estimated repeated.
    """
    docs = docs.drop("n_words", "n_removed", "kept_text")
    doc, own, body, starts, whole, of, of_own = spare(docs, "doc", "own", "body", "starts", "whole", "of", "of_own")
    filled = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumn(doc, F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))).withColumn(own, F.xxhash64(filled)).withColumn(body, filled)
    texts = keyed.select(F.col(doc).alias("doc"), F.col(own).alias("own"), F.col(body).alias("text"))
    digests = texts.select("doc", "own", F.md5("text").alias("digest"))
    oldest = digests.groupBy("digest").agg(F.min("doc").alias("oldest"), F.max("doc").alias("latest")).where("oldest < latest").withColumnRenamed("digest", "same")
    copies = digests.join(oldest, F.col("digest") == F.col("same")).where("doc > oldest").select(F.col("doc").alias("of"), F.col("own").alias("of_own")).distinct()
    copies = cut_lineage(copies, "whole_copies")
    on = (F.col("doc") == F.col("of")) & (F.col("own") == F.col("of_own"))
    if fits(copies, 64):
        rest = texts.join(F.broadcast(copies), on, "left_anti")
    else:
        rest = cut_lineage(texts.join(copies, on, "left_anti"), "first_copies")
    found = repeated_starts(rest, span, sketch_bytes).groupBy(F.col("doc").alias(of), F.col("own").alias(of_own)).agg(F.collect_list("start").alias(starts))
    marked = found.withColumn(whole, F.lit(False)).unionByName(
        copies.select(F.col("of").alias(of), F.col("of_own").alias(of_own), F.lit(None).cast("array<int>").alias(starts), F.lit(True).alias(whole)))
    joined = keyed.join(marked, (F.col(doc) == F.col(of)) & (F.col(own) == F.col(of_own)), "left").select(*docs.columns, body, starts, whole)
    schema = extended(docs, n_words="bigint", n_removed="bigint", kept_text="string")
    columns = docs.columns
    return mapped(joined, lambda b: _remove(b, body, starts, whole, span, columns), schema, body)


def op11_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_windows(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int | None, str | None]], span: int = SPAN) -> list[tuple[int, int, str]]:
    """Words, removed words and digest of what is left, for rows of id and text; for tests."""
    split = [(NO_ID if i is None else i, (t or "").encode().split()) for i, t in rows]
    oldest: dict[tuple, int] = {}
    for i, w in split:
        for k in range(len(w) - span + 1):
            key = tuple(w[k: k + span])
            oldest[key] = min(oldest.get(key, i), i)
    out = []
    for i, w in split:
        gone = {j for k in range(len(w) - span + 1) if oldest[tuple(w[k: k + span])] < i for j in range(k, k + span)}
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()))
    return out


SQL = {"op11_substring_dedup": r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS k FROM doc, range(1, len(w) - 48) t(i) WHERE len(w) >= 50),
old AS (SELECT k, min(doc_id) AS oldest FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, j FROM win JOIN old USING (k), range(i, i + 50) t(j) WHERE doc_id > oldest),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM doc),
marked AS (SELECT word.*, gone.j IS NOT NULL AS cut FROM word LEFT JOIN gone USING (doc_id, j)),
done AS (SELECT doc_id, count(*) FILTER (cut) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (NOT cut) AS kept FROM marked GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN done USING (doc_id)"""}
QUERIES = {"op11_substring_dedup": op11_substring_dedup}
