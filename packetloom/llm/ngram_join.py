"""N-gram Jaccard join by parity sketches.

A document is the set of its five-word shingles.  Two sketches are XOR-hashed from a set:

* a *word sketch* of ``P`` words: each shingle XORs its hash into one of them.  Every shingle that
  only one of two sets holds changes one word at most, so the number of words that differ is at
  most the size of the symmetric difference, and sets of similarity 0.8 differ in at most a
  quarter of the smaller size.  Documents that share one of their first ``size / 4 + 1`` non-empty
  words, in any fixed order of words, are all candidates there can be (pigeonhole);
* a *bit sketch*: each shingle flips one bit, so the Hamming distance bounds the symmetric
  difference from below and discards most false candidates before any set is read.

Sketches are made per size band (powers of two); a document near the end of its band is also
sketched as a small member of the next.  Words that a sample of documents shares often come last in
the order, which keeps widely shared passages out of the keys.  The order changes the work, not the result.

The members of a group of documents under one key meet one pivot per round, whatever is linked becomes
one component, and only members of different components meet again.  After ``PIVOT_ROUNDS`` rounds what
is left of a group is expanded into all pairs of different components, whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import (FOLDED, SPACE, Hasher, append, as_signed, byte_set, extended, fits, flat, grams, join_small, lists, mapped, mix,
                                   reduce_rows, ship, slices, words)
from packetloom.session import cut_lineage

SHINGLE = 5
SHARE = 64             # one of so many documents goes into the sample that orders the words
HOT_COUNT = 3          # words in at least so many documents of the sample come last
HOT_WORDS = 200_000    # most words that are put last; which ones changes the work only
SMALL_GROUP = 32       # no further pivot round when all groups left are of this size; bounds no group
PIVOT_ROUNDS = 2
NOT_SPACE = byte_set(SPACE)
_U = np.uint64


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in ascending order for each row, and their number per row.

    A text of fewer words is one shingle; a text without words has none.
    """
    buf, offsets = flat(column)
    rows = len(offsets) - 1
    start, end, row = words(buf, offsets, NOT_SPACE)
    h = Hasher(buf, FOLDED).ranges(start, end)
    g = grams(h, SHINGLE)
    n = len(g)
    whole = np.flatnonzero(row[:n] == row[SHINGLE - 1:]) if n else np.zeros(0, np.int64)
    value, owner = [g[whole]], [row[whole]]
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    for k in range(1, SHINGLE):
        own = np.flatnonzero(count == k)
        if len(own):
            value.append(grams(h, k)[first[own]])
            owner.append(own)
    value, owner = np.concatenate(value), np.concatenate(owner)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[fresh], np.bincount(owner[fresh], minlength=rows)


def band(sizes: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(sizes, 1))).astype(np.int64)


def sketch_words(level: np.ndarray) -> np.ndarray:
    return np.maximum(64, (2 << level) // 3)


def word_sketch(values: np.ndarray, counts: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-empty words of each set's sketch as keys, in the order of their place."""
    size = sketch_words(level)
    base = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(counts)), counts)
    spread = mix(values ^ _U(0x5851F42D4C957F2D))
    place = ((spread >> _U(32)) * size[owner].astype(np.uint64) >> _U(32)).astype(np.int64)
    words_ = np.zeros(int(size.sum()), np.uint64)
    np.bitwise_xor.at(words_, base[owner] + place, mix(values + _U(0x2545F4914F6CDD1D)))
    some = np.flatnonzero(words_)
    of = np.searchsorted(base, some, "right") - 1
    keys = mix(words_[some] + mix((some - base[of]).astype(np.uint64) * _U(64) + level[of].astype(np.uint64)))
    return keys, np.bincount(of, minlength=len(counts))


def bit_sketch(values: np.ndarray, counts: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity bits of each set, four for each shingle a set of the band may start with, as 64-bit numbers."""
    size = np.maximum(1, (4 << level) // 64)
    base = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(counts)), counts)
    bit = (mix(values ^ _U(0x9E6C63D0676A9A99)) % (size[owner] * 64).astype(np.uint64)).astype(np.int64)
    out = np.zeros(int(size.sum()), np.uint64)
    np.bitwise_xor.at(out, base[owner] + (bit >> 6), _U(1) << (bit & 63).astype(np.uint64))
    return out, size


def prefixes(keys: np.ndarray, counts: np.ndarray, need: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first ``need`` keys of each row, those in ``hot`` (sorted) after all others."""
    if len(hot) and len(keys):
        at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
        late = hot[at] == keys
    else:
        late = np.zeros(len(keys), bool)
    owner = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    run = np.cumsum(~late)
    before = np.concatenate([[0], run])[begin]
    early_rank = run - 1 - before[owner]
    early = reduce_rows(np.add, (~late).astype(np.int64), counts)
    late_rank = np.arange(len(keys)) - begin[owner] - (run - before[owner]) + early[owner]
    keep = np.where(late, late_rank, early_rank) < need[owner]
    return keys[keep], np.bincount(owner[keep], minlength=len(counts))


def _leveled(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sets repeated for the bands they are sketched in: row, level, values, counts."""
    own = band(counts)
    some = counts > 0
    upper = some & (counts * 5 >= (2 << own) * 4)
    row = np.concatenate([np.flatnonzero(some), np.flatnonzero(upper)])
    level = np.concatenate([own[some], own[upper] + 1])
    begin = np.cumsum(counts) - counts
    at = np.repeat(begin[row], counts[row]) + np.arange(counts[row].sum()) - np.repeat(np.cumsum(counts[row]) - counts[row], counts[row])
    return row, level, values[at], counts[row]


SKETCH = "doc bigint, level int, n bigint, set_a bigint, set_b bigint, keys array<bigint>, bits array<bigint>"


def _sketch(batch: pa.RecordBatch, hot: np.ndarray) -> pa.RecordBatch:
    values, counts = shingle_sets(batch.column("text"))
    ids = batch.column("doc").to_numpy(zero_copy_only=False)
    set_a, set_b = reduce_rows(np.add, mix(values), counts), reduce_rows(np.bitwise_xor, mix(values + _U(77)), counts)
    row, level, values, counts = _leveled(values, counts)
    keys, n_keys = word_sketch(values, counts, level)
    need = counts // 4 + 1
    keys, kept = prefixes(keys, n_keys, need, hot)
    weak = np.flatnonzero(n_keys < need)     # too few non-empty words: one more key that all such sets of a band share
    if len(weak):
        at = np.cumsum(kept)[weak]
        keys = np.insert(keys, at, mix(level[weak].astype(np.uint64) + _U(1 << 40)))
        kept[weak] += 1
    bits, n_bits = bit_sketch(values, counts, level)
    return pa.RecordBatch.from_arrays([
        pa.array(ids[row], pa.int64()), pa.array(level, pa.int32()), pa.array(counts, pa.int64()), pa.array(as_signed(set_a[row])),
        pa.array(as_signed(set_b[row])), lists(as_signed(keys), kept, pa.int64()), lists(as_signed(bits), n_bits, pa.int64())],
        names=["doc", "level", "n", "set_a", "set_b", "keys", "bits"])


def _sample_keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    values, counts = shingle_sets(batch.column("text"))
    _, level, values, counts = _leveled(values, counts)
    keys, _ = word_sketch(values, counts, level)
    return pa.RecordBatch.from_arrays([pa.array(as_signed(keys))], names=["key"])


def frequent_words(texts: DataFrame, share: int = SHARE) -> np.ndarray:
    """Sketch words that many documents of a hash sample hold: at most ``HOT_WORDS``, sorted."""
    sample = mapped(texts.where(F.pmod(F.xxhash64("doc"), F.lit(share)) == 0), _sample_keys, "key bigint")
    top = sample.groupBy("key").count().where(F.col("count") >= HOT_COUNT).orderBy(F.desc("count"), "key").limit(HOT_WORDS)
    return np.sort(top.select("key").toArrow()["key"].to_numpy().view(np.uint64))


def _distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("bigint")), F.lit(0).cast("bigint"), lambda s, x: s + x)


def _plausible(left: str, right: str, percent: int) -> Column:
    """Sizes that allow the similarity, and bit sketches no further apart than it allows."""
    def c(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")
    a, b = c(left, "n"), c(right, "n")
    near = _distance(c(left, "bits"), c(right, "bits")) * (100 + percent) <= (a + b) * (100 - percent)
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent) & near


def components(links: DataFrame) -> DataFrame:
    """``doc, component`` (the smallest doc reachable) for the docs of ``links`` (``a``, ``b``).

    Every doc points to the smallest it has seen; in each round all pointers of a doc are moved to
    its smallest, until nothing changes.  Edges stay as many as they were.
    """
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        # large star: greater neighbours of a doc go to its smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("hub"), F.least("u", "low").alias("low"))
        large = both.where("v > u").join(low, F.col("u") == F.col("hub")).select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # small star: smaller neighbours of a doc go to its smallest
        least = large.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("hub"), "low")
        moved = large.join(least, F.col("u") == F.col("hub")).select(
            F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("low").alias("v")).distinct()
        moved = cut_lineage(moved, "edges")
        state = moved.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("docs"),
                          F.sum(F.hash("u", "v").cast("bigint")).alias("h")).first()
        before = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("u", "v").cast("bigint")).alias("h")).first()
        edges = moved
        if state["n"] == state["docs"] and state["n"] == before["n"] and state["h"] == before["h"]:
            break
    return edges.select(F.col("u").alias("doc"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("doc"), F.col("v").alias("component")).distinct())


def merge_components(part: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of earlier links and new ones: only the components that new links join are looked at."""
    if part is None:
        return cut_lineage(components(links), "components")
    names = part.select(F.col("doc").alias("of"), F.col("component").alias("name"))
    lifted = (links.join(names, F.col("a") == F.col("of"), "left").select(F.coalesce("name", "a").alias("a"), "b")
              .join(names, F.col("b") == F.col("of"), "left").select("a", F.coalesce("name", "b").alias("b")))
    moved = cut_lineage(components(lifted), "components").select(F.col("doc").alias("was"), F.col("component").alias("now"))
    old = part.join(moved, F.col("component") == F.col("was"), "left").select("doc", F.coalesce("now", "component").alias("component"))
    fresh = moved.join(part, F.col("was") == F.col("doc"), "left_anti").select(F.col("was").alias("doc"), F.col("now").alias("component"))
    return cut_lineage(old.unionByName(fresh), "components")


def _set_rows(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The shingle sets of the wanted docs."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, counts = shingle_sets(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc"), lists(as_signed(values), counts, pa.int64())], names=["doc", "shingles"])
    kept = join_small(texts, wanted, F.col("doc") == F.col("wanted"), "left_semi", 16)
    return mapped(kept, work, "doc bigint, shingles array<bigint>")


class Join:
    """The tables of one join, and the rounds over them."""

    def __init__(self, texts: DataFrame, percent: int):
        self.texts, self.percent = texts, percent
        hot = texts.sparkSession.sparkContext.broadcast(frequent_words(texts))
        self.sketches = cut_lineage(mapped(texts, lambda b: _sketch(b, hot.value), SKETCH), "sketches")
        self.sets: DataFrame | None = None

    def classes(self) -> tuple[DataFrame, DataFrame]:
        """Representatives (one doc of each distinct set), and copies with theirs."""
        own = self.sketches.groupBy("doc").agg(F.min("set_a").alias("set_a"), F.min("set_b").alias("set_b"), F.max("n").alias("n"))
        groups = own.groupBy("set_a", "set_b", "n").agg(F.min("doc").alias("a"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
        copies = own.join(groups.select(*[F.col(c).alias("_" + c) for c in ("set_a", "set_b", "n")], "a"),
                          (F.col("set_a") == F.col("_set_a")) & (F.col("set_b") == F.col("_set_b")) & (F.col("n") == F.col("_n"))).where("doc <> a")
        return copies.select("a", F.col("doc").alias("b"))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Those of the plausible pairs (``a``, ``b``) whose sets are similar."""
        pairs = cut_lineage(pairs, "candidates")
        wanted = cut_lineage(pairs.select(F.col("a").alias("wanted")).union(pairs.select("b")).distinct(), "wanted")
        sets = cut_lineage(_set_rows(self.texts, wanted), "sets")
        a = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("sa"))
        b = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - both
        return pairs.join(b, "b").join(a, "a").where(both * 100 >= union * self.percent).select("a", "b")

    def parts(self) -> DataFrame:
        """The component of every linked doc; every link was verified on the sets."""
        copies = cut_lineage(self.classes(), "copies")
        keyed = self.sketches.select("doc", "level", F.explode("keys").alias("key"))
        shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("shared"))
        grouped = keyed.join(shared, F.col("key") == F.col("shared")).select("key", "doc", "level")
        gone = copies.select(F.col("b").alias("copy"))
        grouped = cut_lineage(join_small(grouped, gone, F.col("doc") == F.col("copy"), "left_anti", 16), "groups")
        found, part = copies, None
        first = grouped.groupBy("key").agg(F.min("doc").alias("low")).select(F.col("key").alias("of"), "low")
        pairs = (grouped.join(first, F.col("key") == F.col("of")).where("doc <> low")
                 .select("level", F.col("low").alias("a"), F.col("doc").alias("b")).distinct())
        for k in range(PIVOT_ROUNDS):
            fresh = cut_lineage(self.verified(self.plausible(pairs)), "links")
            if k and fresh.isEmpty():
                break     # groups of documents that are not alike: further pivots would find no more
            found = found.unionByName(fresh)
            part = merge_components(part, fresh if k else found)
            named = (join_small(grouped, part.withColumnRenamed("doc", "member"), F.col("doc") == F.col("member"), "left", 32)
                     .select("key", "doc", "level", F.coalesce("component", "doc").alias("component")))
            mixed = named.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count(F.lit(1)).alias("members")).where("c0 <> c1")
            # a group of two has met already
            open_ = cut_lineage(named.join(mixed.where("members > 2").select(F.col("key").alias("open"), "members"), F.col("key") == F.col("open"))
                                .select("key", "doc", "level", "component", "members"), "open_groups")
            top = open_.agg(F.max("members")).first()[0] or 0
            if top <= SMALL_GROUP or k == PIVOT_ROUNDS - 1:
                break
            pivot = open_.groupBy("key").agg(F.min_by(F.struct("doc", "component"), F.xxhash64("doc", F.lit(k))).alias("pivot")).select(F.col("key").alias("of"), "pivot")
            pairs = (open_.join(pivot, F.col("key") == F.col("of")).where(F.col("component") != F.col("pivot.component"))
                     .select("level", F.least("doc", "pivot.doc").alias("a"), F.greatest("doc", "pivot.doc").alias("b")).distinct())
        if not top:
            return part
        # what is left meets within its group, if in different components, behind the bit sketches
        bits = self.sketches.select(F.col("doc").alias("of"), F.col("level").alias("of_level"), "n", "bits")
        rest = cut_lineage(open_.join(bits, (F.col("doc") == F.col("of")) & (F.col("level") == F.col("of_level"))).select("key", "doc", "component", "n", "bits"), "rest")
        x, y = rest.alias("x"), rest.alias("y")
        pairs = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.doc") < F.col("y.doc")) & (F.col("x.component") != F.col("y.component"))
                        & _plausible("x", "y", self.percent)).select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b")).distinct())
        fresh = cut_lineage(self.verified(pairs), "links")
        return part if fresh.isEmpty() else merge_components(part, fresh)

    def plausible(self, pairs: DataFrame) -> DataFrame:
        """Pairs (``level``, ``a``, ``b``) that the bit sketches do not rule out."""
        s = self.sketches.select("doc", "level", "n", "bits")
        x, y, p = s.alias("x"), s.alias("y"), pairs.alias("p")
        both = (p.join(x, (F.col("p.a") == F.col("x.doc")) & (F.col("p.level") == F.col("x.level")))
                .join(y, (F.col("p.b") == F.col("y.doc")) & (F.col("p.level") == F.col("y.level"))))
        return both.where(_plausible("x", "y", self.percent)).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per id.

    Texts are folded (A-Z), words are parted by white space.  Two documents link when
    ``100 * intersection >= percent * union``; ``percent`` must be 80 or more, as the sketches
    count on it.  Null and empty texts, and texts without words, have no shingles and link with nothing.
    Rows that repeat an id count once, by their greatest text; a null id gives a row of its own with
    a null component.  An empty table gives none.  Ids must be integers.
    """
    if percent < 80:
        raise ValueError("the sketches are made for similarities of 0.8 and more")
    ids = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    twice = cut_lineage(ids.select("doc").groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc is not null").select(F.col("doc").alias("again")), "repeated")
    if twice.isEmpty():
        texts = ids.where("doc is not null")
    else:
        again = join_small(ids, twice, F.col("doc") == F.col("again"), "left_semi", 16).groupBy("doc").agg(F.max("text").alias("text"))
        texts = join_small(ids.where("doc is not null"), twice, F.col("doc") == F.col("again"), "left_anti", 16).unionByName(again)
    join = Join(texts, percent)
    part = join.parts().withColumnRenamed("doc", "member")
    sized = join.sketches.groupBy("doc").agg(F.max("n").alias("n"))
    every = ids.select("doc").distinct()
    out = (every.join(sized.withColumnRenamed("doc", "sized"), F.col("doc") == F.col("sized"), "left")
           .join(part, F.col("doc") == F.col("member"), "left"))
    return out.select(F.col("doc").alias("doc_id"), F.coalesce("n", F.lit(0)).alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))


def op9_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL: dict[str, str] = {}
QUERIES = {"op9_ngram_jaccard": op9_ngram_jaccard}
