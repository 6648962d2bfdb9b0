"""Toxicity from class-conditional Kneser-Ney models of words and bigrams.

Word level: each class has its continuation counts N(w), the number of distinct words seen before
w.  As the smaller class has seen fewer contexts twice, a count is set against what it would be if
the same documents had been labelled by chance in the classes' shares.  Bigram level: the documents
of each class that hold w after v, against all that follows v in that class, so that a word which
always follows the same word counts too.  At both levels a count gives up ``DISCOUNT``, and what is
given up goes to one backoff distribution that the classes share, that of all rows; a context which
only one class has seen tells nothing.

A log ratio counts by what exceeds ``SIGMAS`` standard errors of its own; nothing else holds rare
words back.  A word takes the ratio of its bigram or, if that is the smaller, backs off to its own.
The score of a text is the sum over its length.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import append, as_signed, extended, join_small, mapped, mix
from packetloom.llm.decontaminate import word_hashes
from packetloom.session import cut_lineage

DISCOUNT = 0.75
SIGMAS = 4.0
PRIOR_WORDS = 20      # added to the length that normalises a score
FIT_ROWS = 20_000     # labelled rows that the last two parameters are fitted on
BLOCK_WORDS = 2_000_000   # words and bigrams of the model that one pass over the texts carries


def _with_left(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of each word, that of the word before it (32 bits, 0 at the beginning), and its row."""
    h, row = word_hashes(column)
    left = np.zeros(len(h), np.uint64)
    left[1:] = np.where(row[1:] == row[:-1], mix(h[:-1]) >> np.uint64(32), np.uint64(0))
    return h, left, row


def _pair(word: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(word ^ mix(before + np.uint64(1)))


def _bigrams(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The bigrams of a slice with the number of its documents of either class that hold them."""
    h, left, row = _with_left(batch.column("text"))
    y = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
    pair = _pair(h, left)
    _, once = np.unique(mix(pair) + row.astype(np.uint64), return_index=True)
    _, at, which = np.unique(pair[once], return_index=True, return_inverse=True)
    bad = np.bincount(which, y[row[once]], len(at)).astype(np.int32)
    at, both = once[at], np.bincount(which, minlength=len(at)).astype(np.int32)
    return pa.RecordBatch.from_arrays([
        pa.array(as_signed(h[at])), pa.array(left[at].astype(np.uint32).view(np.int32)), pa.array(both - bad), pa.array(bad)],
        names=["word", "before", "d0", "d1"])


def _beyond_error(raw: Column, counts: list[tuple[Column, Column]]) -> Column:
    """What a log ratio exceeds its error by, from (count, expected count) of each class."""
    error = F.sqrt(sum((1 / F.greatest(n, expected, F.lit(0.5)) for n, expected in counts), F.lit(0.0)))
    return F.signum(raw) * F.greatest(F.abs(raw) - SIGMAS * error, F.lit(0.0))


def count_bigrams(labelled: DataFrame) -> DataFrame:
    """``word, before, d0, d1, ratio, k`` from all rows of (text, toxic): the bigrams whose ratio
    differs from 0 beyond its error, one by one; of all others the number ``k`` of left neighbours
    of a word that came with it in ``d0`` and ``d1`` documents (``before`` null, ratio 0).  Grows with
    the input and is never collected."""
    found = mapped(labelled.select("text", F.col("toxic").cast("int").alias("toxic")), _bigrams, "word bigint, before int, d0 int, d1 int")
    # one exchange by the left word serves the counts and the totals of what follows it
    pairs = found.repartition("before").groupBy("before", "word").agg(F.sum("d0").alias("d0"), F.sum("d1").alias("d1"))
    after = Window.partitionBy("before")
    total = [F.sum(d).over(after) for d in ("d0", "d1")]
    kinds = [F.sum((F.col(d) > 0).cast("int")).over(after) for d in ("d0", "d1")]
    known = pairs.select("*", *[t.alias(f"t{c}") for c, t in enumerate(total)], *[k.alias(f"k{c}") for c, k in enumerate(kinds)])
    both, seen = F.col("d0") + F.col("d1"), F.col("t0") + F.col("t1")
    backoff = DISCOUNT * F.least(F.col("k0") / F.col("t0"), F.col("k1") / F.col("t1"))
    like = [F.greatest(F.col(f"d{c}") - DISCOUNT, F.lit(0.0)) / F.col(f"t{c}") * (1 - backoff) + both / seen * backoff for c in (0, 1)]
    ratio = _beyond_error(F.log(like[1] / like[0]), [(F.col(f"d{c}"), both * F.col(f"t{c}") / seen) for c in (0, 1)])
    ratio = F.when((F.col("t0") > 0) & (F.col("t1") > 0), ratio).otherwise(0.0)
    return (known.select("word", "before", "d0", "d1", ratio.alias("ratio"))
            .withColumn("before", F.when(F.col("ratio") != 0, F.col("before")))
            .groupBy("word", "before", "d0", "d1").agg(F.max("ratio").alias("ratio"), F.count(F.lit(1)).alias("k")))


def log_ratios(bigrams: DataFrame) -> DataFrame:
    """``word, before, ratio`` of the bigrams, and with a null ``before`` of the words, whose log
    ratio differs from 0 beyond its error."""
    total = bigrams.agg(*[F.sum(F.col(d) * F.col("k")).alias(d) for d in ("d0", "d1")]).first()
    if not total["d0"] or not total["d1"]:
        return bigrams.select("word", "before", "ratio").limit(0)
    docs = F.col("d0") + F.col("d1")
    other = [total[d] / (total["d0"] + total["d1"]) for d in ("d1", "d0")]   # the share of the other class
    words = cut_lineage(bigrams.groupBy("word").agg(
        *[F.sum(F.when(F.col(f"d{c}") > 0, F.col("k")).otherwise(0)).alias(f"n{c}") for c in (0, 1)],
        *[F.sum(F.col("k") * (1 - F.pow(F.lit(other[c]), docs))).alias(f"x{c}") for c in (0, 1)]), "word_counts")
    given = words.agg(*[F.sum(f"n{c}").alias(f"n{c}") for c in (0, 1)], *[F.count(F.when(F.col(f"n{c}") > 0, 1)).alias(f"k{c}") for c in (0, 1)]).first()
    backoff = DISCOUNT * min(given[f"k{c}"] / given[f"n{c}"] for c in (0, 1))
    like = [F.greatest(F.col(f"n{c}") - DISCOUNT, F.lit(0.0)) / F.col(f"x{c}") * (1 - backoff) + backoff for c in (0, 1)]
    ratio = _beyond_error(F.log(like[1] / like[0]), [(F.col(f"n{c}"), F.col(f"x{c}")) for c in (0, 1)])
    own = words.select("word", F.lit(None).cast("int").alias("before"), ratio.alias("ratio")).where("ratio <> 0")
    return own.unionByName(bigrams.where("before is not null").select("word", "before", "ratio"))


def _looked_up(keys: np.ndarray, known: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    if not len(known) or not len(keys):
        return np.zeros(len(keys))
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, ratio[at], 0.0)


def _scored(batch: pa.RecordBatch, text: str, own: tuple, pairs: tuple, first: bool) -> pa.RecordBatch:
    h, left, row = _with_left(batch.column(text))
    value, pair = _looked_up(h, *own), _looked_up(_pair(h, left), *pairs)
    total = np.bincount(row, np.where(np.abs(pair) > np.abs(value), pair, value), batch.num_rows)
    count = np.bincount(row, minlength=batch.num_rows)
    part = total / (count + PRIOR_WORDS)
    if not first:
        part = part + batch.column("llr").to_numpy(zero_copy_only=False)
    return append(batch, llr=pa.array(part, pa.float64()))


def _by_key(keys: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    return keys[order], ratio[order]


def log_likelihood_ratio(docs: DataFrame, ratios: DataFrame, text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``llr``.  The model reaches the tasks in blocks of about ``block_words`` words
    and bigrams, each bigram in the block of its word; sums over blocks are exact, a larger model takes more passes."""
    blocks = max(1, math.ceil(ratios.count() / block_words))
    out = docs
    for k in range(blocks):
        part = ratios if blocks == 1 else ratios.where(F.pmod("word", F.lit(blocks)) == k)
        table = part.toArrow()
        word, ratio = table["word"].to_numpy().view(np.uint64), table["ratio"].to_numpy()
        single = table["before"].is_null().to_numpy()
        before = table["before"].fill_null(0).to_numpy().astype(np.int32).view(np.uint32).astype(np.uint64)
        model = docs.sparkSession.sparkContext.broadcast((
            _by_key(word[single], ratio[single]), _by_key(_pair(word, before)[~single], ratio[~single])))
        out = mapped(out, lambda b, m=model, k=k: _scored(b, text, *m.value, k == 0), extended(out, llr="double"), text)
        if k < blocks - 1:
            out = cut_lineage(out, "toxicity")
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps; a slight pull keeps separable data finite."""
    if not len(x) or y.min() == y.max():
        return 0.0, -1.0 if not len(y) or y.max() == 0 else 1.0
    scale = max(float(np.abs(x).max()), 1e-9)
    design = np.stack([x / scale, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + 1e-2 * w * [1, 0]
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0] / scale), float(w[1])


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``.

    Learned from rows with a label of 0 or 1 whose crc32(id) mod 5 is not 0: counts
    from all of them, slope and intercept of the score from at most ``FIT_ROWS`` (smallest id
    hashes).  Repeated labels of an id count as toxic if one is.  Without labels of both classes
    every score is below 0.5, or above if all labels are 1.  Null and empty texts have a ratio of 0;
    a null id is scored and never learned from.  Other columns pass through.
    """
    held = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0
    known = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id"))
             .agg(F.max(label).cast("int").alias("toxic")).where(F.pmod(F.crc32(F.col("__id").cast("string").cast("binary")), F.lit(5)) != 0))
    known = cut_lineage(known, "labels")
    texts = docs.select(F.col(id_col).alias("__doc"), F.col(text).alias("text"))
    labelled = join_small(texts, known, F.col("__doc") == F.col("__id"), "inner", 32)
    ratios = cut_lineage(log_ratios(cut_lineage(count_bigrams(labelled), "bigram_counts")), "word_ratios")
    part = known.orderBy(F.xxhash64("__id"), "__id").limit(FIT_ROWS)
    sample = texts.join(F.broadcast(part), F.col("__doc") == F.col("__id")).select("text", "toxic")
    fitted = log_likelihood_ratio(sample, ratios).select("llr", "toxic").toArrow()
    slope, base = _logistic(fitted["llr"].to_numpy(), fitted["toxic"].to_numpy().astype(float))
    score = 1 / (1 + F.exp(-(F.col("llr") * F.lit(slope) + F.lit(base))))
    return (log_likelihood_ratio(docs, ratios, text).withColumn("score", score)
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumn("held_out", F.coalesce(held, F.lit(False))).drop("llr"))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return score_toxicity(docs, labels).select("doc_id", "held_out", "score", "predicted")


def in_fold(doc_id, n: int, k: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % n == k


SQL: dict[str, str] = {}
QUERIES = {"op6_toxicity": op6_toxicity}
