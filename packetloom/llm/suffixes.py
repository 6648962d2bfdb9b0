"""Suffix-array dedup: bytes inside a long string that also starts earlier are removed.

Strings of ``SPAN`` bytes (windows) are compared through suffix arrays, built where equal windows
can meet.  Each window names an anchor, its leftmost smallest ``GRAM``-byte hash, so equal windows
name equal anchors at equal offsets.  The windows of one anchor form its *context*.  Contexts whose
anchor hash occurs once hold nothing repeated.  Of equal contexts only the earliest can hold first
occurrences, so one representative of each goes on; representatives under one anchor hash meet in
one block of text.  Its suffix array is built in two stages: suffixes smaller than their successors
are sorted directly, the rest is induced by scanning the buckets in order; neighbours in the array
with a common prefix of ``SPAN`` bytes are equal windows, and all but the earliest are marked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import Hasher, as_signed, extended, flat, mapped, mix, ragged, ship, spare
from packetloom.llm.decontaminate import merged
from packetloom.session import cut_lineage

SPAN, GRAM = 100, 24
BLOCK_BYTES = 1 << 20     # text of one suffix array, whole anchors
SLICE = 1 << 20           # text whose windows a task hashes at once
HOT_CONTEXTS = 8192       # anchors with more distinct contexts have each window compared by itself
_LOW = (1 << 31) - 1


def contexts(buf: np.ndarray, offsets: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, ...]:
    """Row, first window, number of windows, anchor hash and context hash of every anchor."""
    size = np.diff(offsets)
    long = np.flatnonzero(size >= span)
    none = np.zeros(0, np.int64)
    if not len(long):
        return none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    hasher = Hasher(buf)
    n = len(buf) - GRAM + 1
    at = np.arange(n)
    grams = hasher.ranges(at, at + GRAM)
    best = (grams & ~np.uint64(_LOW)) | at.astype(np.uint64)
    width, reach = span - GRAM + 1, 1
    while reach * 2 <= width:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    if reach < width:
        best = np.minimum(best[: len(best) - (width - reach)], best[width - reach:])
    start = ragged(offsets[long], size[long] - span + 1)
    anchor = (best[start] & np.uint64(_LOW)).astype(np.int64)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(start)))
    low, a = start[first], anchor[first]
    whole = mix(hasher.ranges(low, low + count - 1 + span) + (a - low).astype(np.uint64))
    row = np.searchsorted(offsets, low, "right") - 1
    return row, low - offsets[row], count, grams[a], whole


def suffix_array(text: np.ndarray, depth: int = SPAN) -> np.ndarray:
    """All suffixes of ``text`` (bytes), ordered by their first ``depth`` bytes at least."""
    n = len(text)
    step = np.full(n, -1, np.int16)
    step[:-1] = text[1:].astype(np.int16) - text[:-1]
    known = np.where(step != 0, np.arange(n), n - 1)
    smaller = step[np.minimum.accumulate(known[::-1])[::-1]] > 0    # suffixes smaller than their successors
    direct = _sorted(text, np.flatnonzero(smaller), depth)
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    pending[text[-1]].append(np.array([n - 1]))
    ends = np.searchsorted(text[direct], np.arange(257))
    out = []
    for c in range(256):
        bucket = []
        front = np.concatenate(pending[c]) if pending[c] else np.zeros(0, np.int64)
        while len(front):
            bucket.append(front)
            before = front[front > 0] - 1
            front = before[text[before] == c]
        bucket.append(direct[ends[c]: ends[c + 1]])
        whole = np.concatenate(bucket)
        out.append(whole)
        before = whole[whole > 0] - 1
        letter = text[before]
        before, letter = before[letter > c], letter[letter > c]
        order = np.argsort(letter, kind="stable")
        before, letter = before[order], letter[order]
        cut = np.flatnonzero(np.diff(letter)) + 1
        for part, name in zip(np.split(before, cut), letter[np.concatenate([[0], cut])] if len(letter) else [], strict=False):
            pending[name].append(part)
    return np.concatenate(out)


def _eights(text: np.ndarray, extra: int) -> np.ndarray:
    """The eight bytes from each position as one big-endian number; zeros beyond the end."""
    padded = np.concatenate([text, np.zeros(extra + 8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text) + extra, np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i: i + len(out)]
    return out


def _sorted(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions by the ``depth`` bytes that follow, eight at a time and only where still tied."""
    eights = _eights(text, depth + 8)
    order = at[np.argsort(eights[at], kind="stable")]
    group = np.zeros(len(order), np.int64)
    key = eights[order]
    group[1:] = np.cumsum(key[1:] != key[:-1])
    for shift in range(8, depth, 8):
        tied = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(tied):
            break
        key, own = eights[order[tied] + shift], group[tied]
        again = np.lexsort((key, own))
        order[tied], key = order[tied][again], key[again]
        fresh = np.zeros(len(tied), bool)
        fresh[1:] = (key[1:] != key[:-1]) & (own[1:] == own[:-1])
        jump = np.zeros(len(order), np.int64)
        jump[tied] = fresh
        jump[1:] += group[1:] != group[:-1]
        group = np.cumsum(jump)
    return order


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int = SPAN) -> np.ndarray:
    """Bytes that the suffixes at ``a`` and ``b`` have in common, counted up to ``most``."""
    out = np.zeros(len(a), np.int64)
    on = np.arange(len(a))
    padded = np.concatenate([text, np.zeros(most, np.uint8)])
    for k in range(most):
        on = on[(padded[a[on] + k] == padded[b[on] + k]) & (a[on] + k < len(text)) & (b[on] + k < len(text))]
        if not len(on):
            break
        out[on] = k + 1
    return out


def repeated_windows(texts: list[bytes], counts: np.ndarray, rank: np.ndarray, span: int = SPAN) -> np.ndarray:
    """For the first ``counts`` windows of each text, whether an equal one belongs to a text of lower
    rank or starts earlier in the same one."""
    text = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size) - size
    at = ragged(begin, counts)
    place = np.full(len(text), -1, np.int64)
    place[at] = np.arange(len(at))
    order = suffix_array(text, span)
    order = order[place[order] >= 0]
    same = common_prefix(text, order[:-1], order[1:], span) >= span
    group = np.concatenate([[0], np.cumsum(~same)])
    windows = place[order]
    age = np.argsort(np.lexsort((at, np.repeat(rank, counts))))[windows]
    oldest = np.minimum.reduceat(age, np.flatnonzero(np.concatenate([[True], ~same])))
    out = np.zeros(len(at), bool)
    out[windows] = age != oldest[group]
    return out


ANCHOR = "doc bigint, nth int, low int, n int, anchor bigint, whole bigint"


def _anchors(batch: pa.RecordBatch, light: bool, span: int) -> pa.RecordBatch:
    row, low, count, anchor, whole = contexts(*flat(batch.column("text")), span)
    if light:
        return pa.RecordBatch.from_arrays([pa.array(as_signed(anchor))], names=["anchor"])
    own = pa.array(row)
    return pa.RecordBatch.from_arrays([batch.column("doc").take(own), batch.column("nth").take(own), pa.array(low, pa.int32()), pa.array(count, pa.int32()),
                                       pa.array(as_signed(anchor)), pa.array(as_signed(whole))], names=["doc", "nth", "low", "n", "anchor", "whole"])


SPANS = "doc bigint, nth int, start int, end int"


def _mark_blocks(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Suffix arrays over sorted rows (anchor, doc, nth, low, n, text): blocks of whole anchors."""
    def flush(rows: pa.Table) -> pa.RecordBatch:
        doc, nth, low, n = (rows[c].to_numpy() for c in ("doc", "nth", "low", "n"))
        # only windows of the same anchor hash are compared, and equal windows have equal anchors
        age = np.argsort(np.lexsort((low, nth, doc)))
        hit = repeated_windows(rows["text"].to_pylist(), n.astype(np.int64), age, span)
        own = np.repeat(np.arange(len(n)), n)
        start = np.repeat(low, n) + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
        own, start = own[hit], start[hit]
        head = np.ones(len(own), bool)
        head[1:] = (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(head)
        last = np.append(first[1:], len(own)) - 1 if len(first) else first
        return pa.RecordBatch.from_arrays([pa.array(doc[own[first]], pa.int64()), pa.array(nth[own[first]], pa.int32()), pa.array(start[first], pa.int32()),
                                           pa.array(start[last] + span, pa.int32())], names=["doc", "nth", "start", "end"])
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        anchors = held["anchor"].to_numpy()
        if held["text"].nbytes >= BLOCK_BYTES and anchors[0] != anchors[-1]:
            cut = int(np.searchsorted(anchors, anchors[-1]))    # the last anchor may go on
            yield flush(held.slice(0, cut))
            held = held.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield flush(held)


def _window_rows(batch: pa.RecordBatch, span: int) -> pa.RecordBatch:
    """Every window of the contexts by itself, as two hashes."""
    buf, offsets = flat(batch.column("text"))
    n = batch.column("n").to_numpy().astype(np.int64)
    at = ragged(offsets[:-1], n)
    hasher = Hasher(buf)
    own = pa.array(np.repeat(np.arange(len(n)), n))
    start = np.repeat(batch.column("low").to_numpy(), n) + (at - np.repeat(offsets[:-1], n))
    half = span // 2
    other = mix(hasher.ranges(at, at + half) + hasher.ranges(at + half, at + span) * np.uint64(3))
    return pa.RecordBatch.from_arrays([batch.column("doc").take(own), batch.column("nth").take(own), pa.array(start, pa.int32()),
                                       pa.array(as_signed(hasher.ranges(at, at + span))), pa.array(as_signed(other))], names=["doc", "nth", "start", "w1", "w2"])


def repeated_spans(texts: DataFrame, span: int = SPAN, hot: int = HOT_CONTEXTS) -> DataFrame:
    """Byte ranges (``doc, nth, start, end``, may overlap) covered by windows that start earlier, for texts
    keyed by (``doc, nth``) in that order."""
    session = texts.sparkSession
    ship(session)
    twice = (mapped(texts, lambda b: _anchors(b, True, span), "anchor bigint", limit=SLICE).groupBy("anchor").agg(F.count(F.lit(1)).alias("c"))
             .where("c > 1").select(F.col("anchor").alias("again")))
    found = cut_lineage(mapped(texts, lambda b: _anchors(b, False, span), ANCHOR, limit=SLICE).join(twice, F.col("anchor") == F.col("again")).drop("again"), "anchors")
    first = found.groupBy("anchor", "whole").agg(F.min(F.struct("doc", "nth", "low")).alias("first"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    first = cut_lineage(first, "contexts")
    copied = first.where("copies > 1").select(F.col("anchor").alias("a"), F.col("whole").alias("w"), "first")
    copies = (found.join(copied, (F.col("anchor") == F.col("a")) & (F.col("whole") == F.col("w")))
              .where(F.struct("doc", "nth", "low") != F.col("first")).select("doc", "nth", F.col("low").alias("start"), (F.col("low") + F.col("n") - 1 + span).alias("end")))
    mixed = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1").select(F.col("anchor").alias("a"), (F.col("contexts") > hot).alias("hot"))
    wanted = (first.join(mixed, F.col("anchor") == F.col("a")).select(F.col("first.doc").alias("of"), F.col("first.nth").alias("of_nth"),
                                                                      F.struct("anchor", F.col("first.low").alias("low"), "n", "hot").alias("one"))
              .groupBy("of", "of_nth").agg(F.collect_list("one").alias("all")))
    wanted = cut_lineage(wanted, "wanted_contexts")
    joined = texts.join(wanted, (F.col("doc") == F.col("of")) & (F.col("nth") == F.col("of_nth"))).select("doc", "nth", "text", "all")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        buf, offsets = flat(batch.column("text"))
        column = batch.column("all")
        ones = column.flatten()
        own = np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))
        low, n = ones.field("low").to_numpy().astype(np.int64), ones.field("n").to_numpy()
        begin = offsets[own] + low
        raw = buf.tobytes()
        pieces = [raw[b: b + k - 1 + span] for b, k in zip(begin.tolist(), n.tolist(), strict=True)]
        at = pa.array(own)
        return pa.RecordBatch.from_arrays([ones.field("anchor"), ones.field("hot"), batch.column("doc").take(at), batch.column("nth").take(at),
                                           ones.field("low"), ones.field("n"), pa.array(pieces, pa.binary())], names=["anchor", "hot", "doc", "nth", "low", "n", "text"])
    pieces = cut_lineage(mapped(joined, cut, "anchor bigint, hot boolean, doc bigint, nth int, low int, n int, text binary"), "context_bytes")
    blocks = pieces.where("not hot").repartition("anchor").sortWithinPartitions("anchor", "doc", "nth", "low").select("anchor", "doc", "nth", "low", "n", "text")
    marked = blocks.mapInArrow(lambda batches: _mark_blocks(batches, span), SPANS)
    spans = copies.unionByName(marked)
    crowded = pieces.where("hot")
    if not crowded.isEmpty():
        each = cut_lineage(mapped(crowded, lambda b: _window_rows(b, span), "doc bigint, nth int, start int, w1 bigint, w2 bigint"), "windows")
        oldest = (each.groupBy("w1", "w2").agg(F.min(F.struct("doc", "nth", "start")).alias("oldest"), F.count(F.lit(1)).alias("c")).where("c > 1")
                  .select(F.col("w1").alias("x1"), F.col("w2").alias("x2"), "oldest"))
        later = each.join(oldest, (F.col("w1") == F.col("x1")) & (F.col("w2") == F.col("x2"))).where(F.struct("doc", "nth", "start") != F.col("oldest"))
        spans = spans.unionByName(later.select("doc", "nth", "start", (F.col("start") + span).alias("end")))
    return spans


def _remove(batch: pa.RecordBatch, text: str, spans: str, columns: list[str]) -> pa.RecordBatch:
    buf, offsets = flat(batch.column(text))
    raw = buf.tobytes()
    size, removed, n_spans, kept = np.diff(offsets), [], [], []
    column = batch.column(spans)
    for r in range(batch.num_rows):
        own = raw[offsets[r]: offsets[r + 1]]
        if not column[r].is_valid:
            removed.append(0), n_spans.append(0), kept.append(own)
            continue
        values = column[r].values
        a, b = merged(values.field("start").to_numpy(), values.field("end").to_numpy(), int(size[r]))
        removed.append(int((b - a).sum())), n_spans.append(len(a))
        kept.append(b"".join(own[x: y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(own)], strict=True)))
    out = {n: batch.column(n) for n in columns}
    out |= {"n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_bytes": pa.array(kept, pa.binary())}
    return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans`` and ``kept_bytes`` (what is left) added or replaced.

    A byte goes if a ``span``-byte string over it also starts in a document of smaller id, or
    earlier in the same one.  Null texts are empty, a null id is smaller than any.  Rows that repeat
    an id are ordered by their text; of equal rows either may be the later.  Ids must be integers.
    An empty table stays empty; other columns pass through whatever their names.
    """
    docs = docs.drop(*[c for c in ("n_bytes", "n_removed", "n_spans", "kept_bytes") if c in docs.columns])
    doc, nth, body, runs, of, of_nth = spare(docs, "__doc", "__nth", "__text", "__spans", "__of", "__of_nth")
    keyed = docs.withColumn(doc, F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63)))).withColumn(body, F.coalesce(F.col(text), F.lit("")))
    if keyed.groupBy(doc).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        keyed = keyed.withColumn(nth, F.lit(0))
    else:
        keyed = cut_lineage(keyed.withColumn(nth, F.row_number().over(Window.partitionBy(doc).orderBy(body))), "numbered")
    texts = keyed.select(F.col(doc).alias("doc"), F.col(nth).alias("nth"), F.col(body).alias("text"))
    spans = repeated_spans(texts, span).groupBy("doc", "nth").agg(F.collect_list(F.struct("start", "end")).alias(runs))
    spans = cut_lineage(spans.select(F.col("doc").alias(of), F.col("nth").alias(of_nth), runs), "spans")
    joined = keyed.join(spans, (F.col(doc) == F.col(of)) & (F.col(nth) == F.col(of_nth)), "left").select(*docs.columns, body, runs)
    schema = extended(docs, n_bytes="bigint", n_removed="bigint", n_spans="bigint", kept_bytes="binary")
    columns = docs.columns
    return mapped(joined, lambda b: _remove(b, body, runs, columns), schema, body)


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def brute_force(texts: list[bytes], span: int = SPAN) -> list[tuple[int, int, str]]:
    """Removed bytes, runs and digest of what is left, for texts in order; for tests."""
    seen: set[bytes] = set()
    out = []
    for t in texts:
        on = bytearray(len(t))
        for i in range(len(t) - span + 1):
            w = t[i: i + span]
            if w in seen:
                on[i: i + span] = b"\1" * span
            seen.add(w)
        runs = sum(1 for i in range(len(on)) if on[i] and not (i and on[i - 1]))
        out.append((sum(on), runs, hashlib.sha256(bytes(c for c, d in zip(t, on, strict=True) if not d)).hexdigest()))
    return out


SQL: dict[str, str] = {}
QUERIES = {"op4_suffix_dedup": op4_suffix_dedup}
