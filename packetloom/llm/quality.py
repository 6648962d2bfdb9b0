"""Quality rules: counts of a text, and a chain model that labels its lines.

A linear-chain conditional random field over the lines that hold a word marks each as content or
boilerplate (Viterbi decoding); a text stays when content lines hold enough of its words.  The
field is trained here, on lines of labelled documents that take the label of their document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import EXACT, SPACE, Hasher, append, byte_set, extended, flat, grams, lists, mapped, mix, reduce_rows, words
from packetloom.session import cut_lineage

MIN_WORDS, MAX_REPEAT = 50, 50      # fixed values: fewer words, or more percent of repeated words, fail
MIN_CONTENT = 0.5                   # share of words that content lines must hold
SYMBOLS = b"#*$%&|<>"               # fixed values
NOT_SPACE = byte_set(SPACE)
TRAIN_ROWS = 300                    # documents of each label, by smallest id hash
TRAIN_BYTES, TRAIN_LINES = 32 << 10, 40   # of each: longest text, most lines
FEATURES = 11


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(members)] = 1
    return out


_IS_SYMBOL, _IS_UPPER, _IS_DIGIT = _table(SYMBOLS), _table(bytes(range(65, 91))), _table(bytes(range(48, 58)))
_IS_LETTER = _table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_IS_MARK = _table(b"!?=@_~^{}[]\\/+")
_IS_POINT = _table(bytes([*range(0x80)]) + bytes(range(0xC0, 0x100)))   # first byte of a code point


class Lines:
    """Words, lines and their features for one slice of texts."""

    def __init__(self, column: pa.Array):
        buf, offsets = flat(column)
        rows = len(offsets) - 1
        self.rows = rows
        hasher = Hasher(buf)
        start, end, row = words(buf, offsets, NOT_SPACE)
        self.n_words = np.bincount(row, minlength=rows)

        def sums(flags: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
            run = np.zeros(len(buf) + 1, np.int64)
            np.cumsum(flags, out=run[1:])
            return run[b] - run[a]
        first, last = offsets[:-1], offsets[1:]
        inside = NOT_SPACE[buf]
        self.word_chars = sums(_IS_POINT[buf] * inside, first, last)
        self.n_symbols = sums(_IS_SYMBOL[buf], first, last)

        breaks = np.flatnonzero(buf == 10)
        breaks_of = np.searchsorted(offsets, breaks, "right") - 1
        count = np.bincount(breaks_of, minlength=rows) + 1
        a, b = np.zeros(count.sum(), np.int64), np.zeros(count.sum(), np.int64)
        head = np.zeros(len(a), bool)
        head[np.cumsum(count) - count] = True
        a[head], a[~head] = first, breaks + 1
        tail = np.roll(head, -1) if len(head) else head
        b[tail], b[~tail] = last, breaks
        line_row = np.repeat(np.arange(rows), count)
        in_line = np.searchsorted(start, b) - np.searchsorted(start, a)
        keep = in_line > 0
        a, b, line_row, in_line = a[keep], b[keep], line_row[keep], in_line[keep]
        key = mix(hasher.ranges(a, b) ^ mix(line_row.astype(np.uint64) + EXACT[1]))
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(key), bool)
        again[order[1:]] = key[order[1:]] == key[order[:-1]]
        self.n_dup_lines = np.bincount(line_row, again, rows).astype(np.int64)
        self.n_repeat_words = self._repeats(hasher.ranges(start, end), row)

        size = (b - a).astype(float)
        letters = np.maximum(sums(_IS_LETTER[buf], a, b), 1)
        closing = np.isin(buf[end[np.searchsorted(start, b) - 1] - 1], np.frombuffer(b".?!:;\"')", np.uint8)) if len(a) else again
        last_byte = buf[end[np.searchsorted(start, b) - 1] - 1] if len(a) else np.zeros(0, np.uint8)
        self.line_row, self.line_words = line_row, in_line
        self.features = np.stack([
            np.ones(len(a)), np.minimum(in_line, 20) / 20, (in_line <= 2) * 1.0,
            np.minimum(8 * sums(_IS_SYMBOL[buf], a, b) / size, 1), np.minimum(8 * sums(_IS_MARK[buf], a, b) / size, 1),
            sums(_IS_UPPER[buf], a, b) / letters, np.minimum(4 * sums(_IS_DIGIT[buf], a, b) / size, 1), again * 1.0,
            closing * 1.0, (last_byte == 33) * 1.0, np.minimum(size / in_line, 20) / 20], 1)

    def _repeats(self, h: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Words in windows of three that the text holds twice or more."""
        g = grams(h, 3)
        n = len(g)
        covered = np.zeros(len(h), bool)
        whole = np.flatnonzero(row[:n] == row[2:]) if n else np.zeros(0, np.int64)
        key = mix(g[whole] ^ mix(row[whole].astype(np.uint64) + EXACT[2]))
        order = np.argsort(key)
        same = np.zeros(len(key) + 1, bool)
        same[1:-1] = key[order[1:]] == key[order[:-1]]
        twice = whole[order[same[1:] | same[:-1]]] if len(key) else whole
        for i in range(3):
            covered[twice + i] = True
        return np.bincount(row, covered, self.rows).astype(np.int64)


def viterbi(emit: np.ndarray, counts: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The best label of each line: sequences advance together, the longest first."""
    order = np.argsort(-counts, kind="stable")
    begin = (np.cumsum(counts) - counts)[order]
    length = counts[order]
    back = np.zeros((len(emit), 2), np.int8)
    label = np.zeros(len(emit), np.int8)
    score = np.zeros((len(order), 2))
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(steps), "left")   # sequences longer than t
    for t in range(steps):
        at = begin[: active[t]] + t
        if t == 0:
            score[: active[t]] = emit[at]
            continue
        ways = score[: active[t], :, None] + trans
        best = ways.argmax(1)
        back[at] = best
        score[: active[t]] = np.take_along_axis(ways, best[:, None], 1)[:, 0] + emit[at]
    last = score.argmax(1).astype(np.int8)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        ends = length[:k] == t + 1
        here = np.where(ends, last[:k], label[np.minimum(at + 1, len(label) - 1)])
        if t + 1 < steps:
            inner = ~ends
            here[inner] = back[at[inner] + 1, label[at[inner] + 1]]
        label[at] = here
    return label


def fit(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 80, pull: float = 2e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions by gradient ascent on the conditional likelihood.

    ``labels`` is 0 or 1 for each line; all sequences run forward and backward together.
    """
    n, longest = len(counts), int(counts.max()) if len(counts) else 0
    w, trans = np.zeros((FEATURES, 2)), np.zeros((2, 2))
    if not n or labels.min() == labels.max():
        w[0, 1] = 1.0    # nothing to learn from: all lines are content
        return w, trans
    at = np.repeat(np.arange(n), counts), np.arange(len(features)) - np.repeat(np.cumsum(counts) - counts, counts)
    x = np.zeros((n, longest, FEATURES))
    x[at] = features
    y = np.zeros((n, longest), int)
    y[at] = labels
    mask = np.arange(longest) < counts[:, None]
    target = np.eye(2)[y] * mask[..., None]
    pairs = (target[:, :-1, :, None] * target[:, 1:, None, :]).sum((0, 1))
    weight = 1.0 / len(features)
    moment = [np.zeros_like(w), np.zeros_like(trans)], [np.zeros_like(w), np.zeros_like(trans)]
    for k in range(1, rounds + 1):
        emit = x @ w
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = emit[:, 0]
        for t in range(1, longest):
            step = np.logaddexp(*(forward[:, t - 1, :, None] + trans).transpose(1, 0, 2)) + emit[:, t]
            forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp(*(trans + (emit[:, t + 1] + backward[:, t + 1])[:, None, :]).transpose(2, 0, 1))
            backward[:, t] = np.where(mask[:, t + 1, None], step, 0)
        whole = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        each = np.exp(forward + backward - whole[:, None, None]) * mask[..., None]
        joint = (forward[:, :-1, :, None] + trans + (emit + backward)[:, 1:, None, :]) - whole[:, None, None, None]
        joint = (np.exp(np.minimum(joint, 0)) * mask[:, 1:, None, None]).sum((0, 1))
        grads = (np.einsum("ntf,ntc->fc", x, target - each) * weight - pull * w, (pairs - joint) * weight - pull * trans)
        for i, (value, grad) in enumerate(zip((w, trans), grads, strict=True)):
            moment[0][i][:] = 0.9 * moment[0][i] + 0.1 * grad
            moment[1][i][:] = 0.99 * moment[1][i] + 0.01 * grad ** 2
            value += 0.1 * (moment[0][i] / (1 - 0.9 ** k)) / (np.sqrt(moment[1][i] / (1 - 0.99 ** k)) + 1e-8)
    return w, trans


def train(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Fit the field on at most ``TRAIN_ROWS`` documents of each label and ``TRAIN_LINES`` of their lines."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id"))
             .agg(F.min(label).cast("int").alias("y")))
    drawn = cut_lineage(known.where("y = 0").orderBy(F.xxhash64("__id"), "__id").limit(TRAIN_ROWS).unionByName(
        known.where("y = 1").orderBy(F.xxhash64("__id"), "__id").limit(TRAIN_ROWS)), "quality_sample")
    rows = (docs.select(F.col(id_col).alias("__id"), F.col(text).alias("text")).where(F.octet_length("text") <= TRAIN_BYTES)
            .join(F.broadcast(drawn), "__id").groupBy("__id").agg(F.min("text").alias("text"), F.first("y").alias("y")).orderBy("__id").collect())
    seen = Lines(pa.array([r["text"] for r in rows], pa.large_string()))
    counts = np.bincount(seen.line_row, minlength=len(rows))
    place = np.arange(len(seen.line_row)) - np.repeat(np.cumsum(counts) - counts, counts)
    keep = place < TRAIN_LINES
    y = np.array([r["y"] for r in rows], int)[seen.line_row[keep]] if rows else np.zeros(0, int)
    counts = np.minimum(counts, TRAIN_LINES)
    return fit(seen.features[keep], counts[counts > 0], y)


def judge(batch: pa.RecordBatch, text: str, w: np.ndarray, trans: np.ndarray) -> pa.RecordBatch:
    seen = Lines(batch.column(text))
    counts = np.bincount(seen.line_row, minlength=seen.rows)
    label = viterbi(seen.features @ w, counts, trans)
    content = reduce_rows(np.add, label * seen.line_words, counts)
    failed = (seen.n_words < MIN_WORDS) | (100 * seen.n_repeat_words > MAX_REPEAT * seen.n_words)
    share = content / np.maximum(seen.n_words, 1)
    return append(batch, n_words=pa.array(seen.n_words, pa.int64()), word_chars=pa.array(seen.word_chars, pa.int64()),
                  n_symbols=pa.array(seen.n_symbols, pa.int64()), n_dup_lines=pa.array(seen.n_dup_lines, pa.int64()),
                  n_repeat_words=pa.array(seen.n_repeat_words, pa.int64()), base_failed=pa.array(failed),
                  kept=pa.array(~failed & (share >= MIN_CONTENT)), content_share=pa.array(share), line_labels=lists(label, counts, pa.int8()))


ADDED = {"n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint",
         "base_failed": "boolean", "kept": "boolean", "content_share": "double", "line_labels": "array<tinyint>"}


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """``docs`` with the columns of ``ADDED`` added or replaced; ``line_labels`` has a 1 (content) or
    0 for each line that holds a word.

    Null and empty texts have no words and fail.  An id labelled both ways counts as poor; null
    labels and ids are not learned from; without labels of both kinds every line is content.
    Repeated rows are judged alike; an empty table stays empty.  The only thing sent to the tasks is the fitted field, a few dozen numbers.
    """
    w, trans = train(docs, labels, id_col, text, label)
    return mapped(docs, lambda b: judge(b, text, w, trans), extended(docs, **ADDED), text)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return apply_rules(docs, labels).drop("text", "line_labels")


SQL: dict[str, str] = {}
QUERIES = {"op7_quality_rules": op7_quality_rules}
