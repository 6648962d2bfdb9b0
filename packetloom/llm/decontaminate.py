"""Benchmark decontamination by winnowing.

Both sides keep the smallest hash of ``GRAM`` words in each window of ``SPAN - GRAM + 1`` grams, so
any ``SPAN`` words that a document shares with an item leave the same fingerprint on both sides.
Fingerprints are joined, and every hit is extended word by word; only whole windows count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import FOLDED, Hasher, append, byte_set, extended, flat, grams, mapped, words
from packetloom.session import cut_lineage

SPAN, GRAM = 10, 5
BLOCK_BYTES = 16 << 20   # benchmark text that one pass over the documents carries to the tasks
# fixed values: a word is a run of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after A-Z became a-z
WORD_BYTES = byte_set(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the row of each word."""
    buf, offsets = flat(column)
    start, end, row = words(buf, offsets, WORD_BYTES)
    return Hasher(buf, FOLDED).ranges(start, end), row


def winnow(hashes: np.ndarray, row: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Position and hash of the fingerprints: the rightmost smallest gram of each window."""
    if len(hashes) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = grams(hashes, gram)
    n = len(hashes) - span + 1
    best, at = g[:n].copy(), np.arange(n)
    for i in range(1, span - gram + 1):
        take = g[i: i + n] <= best
        best = np.where(take, g[i: i + n], best)
        at = np.where(take, np.arange(i, i + n), at)
    at = np.unique(at[row[:n] == row[span - 1:]])
    return at, g[at]


class Index:
    """The fingerprints and words of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, str | None]]):
        self.ids = sorted({str(i) for i, _ in items if i is not None})
        place = {x: k for k, x in enumerate(self.ids)}
        items = [(place[str(i)], t) for i, t in items if i is not None]
        self.owner = np.array([i for i, _ in items], np.int64)
        self.words, self.row = word_hashes(pa.array([t for _, t in items], pa.large_string()))
        self.fp = np.unique(winnow(self.words, self.row)[1])
        counts = np.bincount(self.row, minlength=len(items))
        first = np.cumsum(counts) - counts
        whole = np.flatnonzero(self.row[: len(self.row) - SPAN + 1] == self.row[SPAN - 1:]) if len(self.row) >= SPAN else np.zeros(0, np.int64)
        self.windows = {SPAN: self._distinct(whole, SPAN)}     # of items with fewer words, the one window of n words
        self.windows |= {n: self._distinct(first[counts == n], n) for n in range(1, SPAN) if (counts == n).any()}

    def _distinct(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hash, item and one place of each distinct window of an item."""
        g, item = grams(self.words, n)[at], self.owner[self.row[at]]
        order = np.lexsort((item, g))
        g, item, at = g[order], item[order], at[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (item[1:] != item[:-1])
        return g[new], item[new], at[new]

    def _found(self, hashes: np.ndarray, row: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the document windows of ``n`` words at ``at`` those that items have, once by place and once by distinct window and item."""
        known, item, place = self.windows[n]
        g = grams(hashes, n)[at]
        p, q = probe(g, known, all_of=False)
        same = np.ones(len(p), bool)
        for i in range(n):
            same &= hashes[at[p] + i] == self.words[place[q] + i]
        p, q = p[same], q[same]
        one = np.lexsort((g[p], row[at[p]]))
        new = np.ones(len(one), bool)
        new[1:] = (g[p[one[1:]]] != g[p[one[:-1]]]) | (row[at[p[one[1:]]]] != row[at[p[one[:-1]]]])
        one = one[new]
        once = at[p[one]]
        x, y = probe(g[p[one]], known)
        start = np.concatenate([at[p], once[x]])
        return start, start + n, np.concatenate([item[q], item[y]])

    def hits(self, hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, end and item of the document's windows that items have.

        A fingerprint hit is extended to every window that can hold it; repeats on either side are
        looked up, never paired with each other.
        """
        found = [(np.zeros(0, np.int64),) * 3]
        at, fp = winnow(hashes, row)
        p, _ = probe(fp, self.fp, all_of=False)
        near = np.unique((at[p][:, None] - np.arange(SPAN - GRAM + 1)).ravel())
        near = near[(near >= 0) & (near <= len(hashes) - SPAN)]
        near = near[row[near] == row[near + SPAN - 1]]
        for n in self.windows:
            if n == SPAN:
                places = near
            else:
                last = len(hashes) - n + 1
                places = np.flatnonzero(row[:last] == row[n - 1:]) if last > 0 else near[:0]
            if len(places):
                found.append(self._found(hashes, row, places, n))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def probe(keys: np.ndarray, known: np.ndarray, all_of: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of equal values (``all_of`` false: the first only); ``known`` is sorted."""
    low, high = np.searchsorted(known, keys, "left"), np.searchsorted(known, keys, "right")
    count = high - low if all_of else np.minimum(high - low, 1)
    a = np.repeat(np.arange(len(keys)), count)
    b = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    return a, b


def merged(start: np.ndarray, end: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered runs of 0 .. n."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, end, -1)
    on = np.concatenate([[False], np.cumsum(step)[:n] > 0, [False]])
    return np.flatnonzero(on[1:] & ~on[:-1]), np.flatnonzero(~on[1:] & on[:-1])


RUNS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def mark(batch: pa.RecordBatch, text: str, index: Index, again: bool) -> pa.RecordBatch:
    hashes, row = word_hashes(batch.column(text))
    start, end, item = index.hits(hashes, row)
    counts = np.bincount(row, minlength=batch.num_rows)
    first = np.cumsum(counts) - counts
    spans: list[list] = [[] for _ in range(batch.num_rows)]
    items: list[list] = [[] for _ in range(batch.num_rows)]
    owner = row[start]
    for r in np.unique(owner):
        own = owner == r
        a, b = merged(start[own] - first[r], end[own] - first[r], int(counts[r]))
        spans[r] = [{"start": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)]
        items[r] = [index.ids[i] for i in np.unique(item[own])]
    if again:   # a later block: add to what is there
        for r, (s, i) in enumerate(zip(batch.column("hit_spans").to_pylist(), batch.column("hit_items").to_pylist(), strict=True)):
            if s:
                both = s + spans[r]
                a, b = merged(np.array([x["start"] for x in both]), np.array([x["end"] for x in both]), int(counts[r]))
                spans[r] = [{"start": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)]
                items[r] = sorted({*i, *items[r]})
    return append(batch, n_words=pa.array(counts, pa.int64()), hit_spans=pa.array(spans, RUNS), hit_items=pa.array(items, pa.list_(pa.string())))


def mark_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                       item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (runs of words) and ``hit_items`` added or replaced.

    A window is ``SPAN`` words of an item; an item with fewer, but some, is one window.  Null and
    empty texts have no words; items without words or id match nothing; items that share an id
    count as one.  Repeated documents are marked alike, empty tables give no rows or no hits.
    Other columns pass through whatever their names.  Work and memory follow the words, however
    often a document and an item repeat one window.

    The benchmark goes to the tasks in blocks of at most ``block_bytes`` (and one item): a larger
    benchmark takes more passes over the documents, each written before the next.  No shuffle.
    """
    size = benchmark.agg(F.sum(F.octet_length(item_text)).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size * 2 // block_bytes)) if size > block_bytes else 1
    rows = benchmark.select(F.col(item).cast("string"), F.col(item_text))
    out = docs
    for k in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64(item), F.lit(blocks)) == k)
        index = docs.sparkSession.sparkContext.broadcast(Index([tuple(r) for r in part.collect()]))
        schema = extended(out, n_words="bigint", hit_spans="array<struct<start:int,end:int>>", hit_items="array<string>")
        out = mapped(out, lambda b, index=index, again=k > 0: mark(b, text, index.value, again), schema, text)
        if k < blocks - 1:
            out = cut_lineage(out, "decontaminate")
    return out


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = mark_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return done.select(
        "doc_id", "n_words", hit_words(F.col("hit_spans")).alias("n_hit"), F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"), (F.size("hit_spans") > 0).alias("contaminated"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = {"op10_decontamination": rf"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id::VARCHAR AS item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g, least(len(w), 10) AS n
        FROM item, range(1, len(w) - least(len(w), 10) + 2) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM doc, sizes, range(1, len(w) - n + 2) t(i)),
hits AS (SELECT doc_id, i, n, item_id FROM grams JOIN win USING (g, n)),
per_item AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY doc_id),
per_word AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM hits), range(i, i + n) t(j) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN per_word USING (doc_id) LEFT JOIN per_item USING (doc_id)"""}
QUERIES = {"op10_decontamination": op10_decontamination}
