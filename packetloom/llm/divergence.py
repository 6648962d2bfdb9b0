"""Source divergence audit: how far the word shares of a language's sources lie from each other.

The comparison of all sources of a language is a cube of (source block, source block, term block) cells.
Each cell is a task's own: it gets the slices of both source blocks over its term block, replicated
from the counts, sums its part of every pair's divergence, and the parts are added along the term axis.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import FOLD_BYTES, FOLDED, LOWER, UPPER, Hasher, byte_set, flat, join_small, mapped, mix, ragged, reduce_rows, seeded, ship, words
from packetloom.session import cut_lineage

SCALE = 1_000_000_000
MIN_DOCS, TOP_TERMS = 3, 200
BLOCK = 32                 # sources of a block
CELL_ROWS = 1 << 14        # about how many counts of one language a term block holds
SLICE = 4 << 20
LETTERS = byte_set(bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def tally(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Occurrences and documents of each term of each source in one slice."""
    buf, offsets = flat(batch.column("text"))
    start, end, row = words(buf, offsets, LETTERS)
    codes = [pc.dictionary_encode(batch.column(c)).indices.to_numpy().astype(np.uint64) for c in ("lang", "source")]
    group = codes[0] * np.uint64(batch.num_rows) + codes[1]
    key = mix(Hasher(buf, FOLDED).ranges(start, end) + mix(group + seeded(1, 5)[0])[row])
    order = np.argsort(key, kind="stable")
    key, row, start, end = key[order], row[order], start[order], end[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(key)))
    other = new.copy()
    other[1:] |= row[1:] != row[:-1]     # in a run of equal terms the rows ascend
    docs = reduce_rows(np.add, other.astype(np.int64), count)
    size = (end - start)[first]
    at = np.zeros(len(first) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    text = FOLD_BYTES[buf[ragged(start[first], size)]] if len(first) else np.zeros(0, np.uint8)
    terms = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(text))).cast(pa.string())
    take = pa.array(row[first])
    return pa.RecordBatch.from_arrays([batch.column("lang").take(take), batch.column("source").take(take), terms, pa.array(count), pa.array(docs)],
                                      names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` of ``docs`` (``text, lang, source``, null: '')."""
    filled = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = mapped(filled, tally, "lang string, source string, term string, n bigint, docs bigint", limit=SLICE)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, size: str) -> Column:
    """1 + floor(``SCALE`` (count + 1) / (total + size)), in decimals."""
    return F.expr(f"1 + (({count} + 1) * cast({SCALE} as decimal(20, 0))) div cast({total} + {size} as decimal(20, 0))").cast("bigint")


def shares(count: np.ndarray, total: int, size: int) -> np.ndarray:
    """The same in 64-bit steps of 1000, exact while total + size stays below 9e15."""
    rest, out = count + 1, np.zeros(len(count), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // (total + size)
        rest %= total + size
    return out + 1


def cell(key: tuple, table: pa.Table) -> pa.Table:
    """Partial divergences of one cell: both directions of each pair of its source blocks."""
    lang, a, b = (k.as_py() for k in key[:3])
    rows = {n: table.column(n).to_numpy(zero_copy_only=False) for n in ("x", "place", "nth", "n", "size", "kept")}
    names = table.column("source").to_pylist()
    head = rows["nth"] < 0
    width, size = int(rows["size"].max()), int(rows["kept"].max())
    sides = {}
    for x in {a, b}:
        own = np.flatnonzero(head & (rows["x"] == x))
        own = own[np.argsort(rows["place"][own])]
        place = {int(p): i for i, p in enumerate(rows["place"][own])}
        counts = np.zeros((len(own), width), np.int64)
        body = np.flatnonzero(~head & (rows["x"] == x))
        counts[[place[int(p)] for p in rows["place"][body]], rows["nth"][body]] = rows["n"][body]
        share_of = [shares(c, int(t), size) if width else c for c, t in zip(counts, rows["n"][own], strict=True)]
        sides[x] = [names[i] for i in own], np.array(share_of, np.int64).reshape(len(own), width)
    out: list[tuple[str, str, int]] = []
    (left, p), (right, q) = sides[a], sides[b]
    for i, name in enumerate(left):
        squares = (p[i] - q) ** 2
        for item, there, back in zip(right, (squares // np.maximum(q, 1)).sum(1).tolist(), (squares // np.maximum(p[i], 1)).sum(1).tolist(), strict=True):
            if a != b:
                out += [(name, item, there), (item, name, back)]
            elif item != name:
                out.append((name, item, there))
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "source": pa.array([o[0] for o in out], pa.string()),
                     "item": pa.array([o[1] for o in out], pa.string()), "value": pa.array([o[2] for o in out], pa.int64())})


def divergence_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, block: int = BLOCK, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``lang, source, part, item, value, rank`` for ``docs`` (``text, lang, source``).

    Part ``pair`` has every other source of the language, with the sum over all kept terms of
    (p - q)^2 / q, each floored; part ``term`` the kept terms that the source has more often than
    its language, the ``top`` largest.  A kept term is in at least ``min_docs`` rows of the language; p and q
    are shares with one added to every count, in billionths, floored.  Everything is integers.

    Null text, lang and source count as ''.  Repeated rows count each time, an empty text makes its source
    a group without terms, ties rank by the item's bytes; an empty table gives no rows.  Other columns
    are not read, whatever their names.

    Terms are counted per source before any shuffle.  A term block holds about ``cell_rows`` counts of a
    language, so a hot source or language spreads over its term blocks; a cell reads the counts of
    two blocks of ``block`` sources.  Counts are replicated once per source block.
    """
    ship(docs.sparkSession)
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    counts = cut_lineage(term_counts(docs), "term_counts")
    terms = (counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("holders"))
             .where(F.col("docs") >= min_docs))
    terms = cut_lineage(terms.select("lang", "term", "total", "holders"), "kept_terms")
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_n"), F.sum("holders").alias("rows"))
    langs = cut_lineage(langs.select(F.col("lang").alias("l"), "kept", "lang_n", F.ceil(F.col("rows") / cell_rows).cast("int").alias("blocks")), "languages")
    dealt = join_small(terms, langs, F.col("lang") == F.col("l"), "inner", 64).select(
        "lang", "term", "total", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("k"))
    dealt = dealt.withColumn("nth", F.row_number().over(Window.partitionBy("lang", "k").orderBy("term")) - 1)
    dealt = dealt.select(F.col("lang").alias("l"), F.col("term").alias("t"), "total", "k", "nth")
    kept = counts.join(dealt, (F.col("lang") == F.col("l")) & (F.col("term") == F.col("t"))).select("lang", "source", "term", "n", "total", "k", "nth")
    kept = cut_lineage(kept, "kept_counts")

    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = (groups.join(sums, ["lang", "source"], "left").join(langs, F.col("lang") == F.col("l"), "left")
              .select("lang", "source", F.coalesce("group_n", F.lit(0)).alias("group_n"), F.coalesce("kept", F.lit(0)).alias("kept"),
                      F.coalesce("lang_n", F.lit(0)).alias("lang_n"), place.alias("place"), F.count(F.lit(1)).over(Window.partitionBy("lang")).alias("sources")))
    groups = groups.withColumn("x", F.expr(f"place div {block}").cast("int")).withColumn("bands", F.expr(f"(sources + {block - 1}) div {block}").cast("int"))
    groups = cut_lineage(groups.withColumn("place", F.expr(f"place % {block}").cast("int")).drop("sources"), "sources")

    sizes = cut_lineage(kept.groupBy("lang", "k").agg((F.max("nth") + 1).alias("size")), "term_blocks")   # its terms are numbered from 0
    known = groups.select(F.col("lang").alias("l"), F.col("source").alias("s"), "group_n", "kept", "lang_n", "place", "x", "bands")
    facts = join_small(kept, known, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s")), "inner", 160).drop("l", "s")
    pairs = _pairs(facts, groups, sizes)
    marked = facts.withColumn("p", share("n", "group_n", "kept")).withColumn("q", share("total", "lang_n", "kept")).where("p > q")
    marked = marked.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (pairs.withColumn("rank", F.row_number().over(order)).unionByName(marked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)))


def _pairs(facts: DataFrame, groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """``facts`` has the counts with their places, ``groups`` the sources, ``sizes`` the terms of each term block."""
    columns = ["lang", "k", "x", "place", "source", "nth", "n", "size", "kept", "bands"]
    # a source has one row, of nth -1 and its total, in each term block, so that its zero counts are known there
    heads = groups.join(sizes.withColumnRenamed("lang", "l"), F.col("lang") == F.col("l"), "left").select(
        "lang", F.coalesce("k", F.lit(0)).alias("k"), "x", "place", "source", F.lit(-1).alias("nth"), F.col("group_n").alias("n"),
        F.coalesce("size", F.lit(0)).alias("size"), "kept", "bands")
    body = facts.select("lang", "k", "x", "place", F.lit(None).cast("string").alias("source"), "nth", "n", F.lit(0).alias("size"), "kept", "bands")
    slices = heads.unionByName(body).select(*columns, F.explode(F.sequence(F.lit(0), F.col("bands") - 1)).alias("y"))
    cube = slices.withColumn("a", F.least("x", "y")).withColumn("b", F.greatest("x", "y")).drop("bands", "y")
    parts = cube.groupBy("lang", "a", "b", "k").applyInArrow(cell, "lang string, source string, item string, value bigint")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select("lang", "source", F.lit("pair").alias("part"), "item", "value")


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence_audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source"))


def brute_force(rows: list[tuple[str | None, str | None, str | None]], min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> list[tuple]:
    """The rows of ``divergence_audit`` for (text, lang, source), with dictionaries; for tests."""
    import re
    from collections import Counter
    docs: Counter = Counter()
    count: dict[tuple, Counter] = {}
    for text, lang, source in rows:
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(str.maketrans(UPPER, LOWER)))
        count.setdefault((lang or "", source or ""), Counter()).update(found)
        docs.update((lang or "", w) for w in set(found))
    out = []
    for lang in {g for g, _ in count}:
        own = {s: c for (g, s), c in count.items() if g == lang}
        kept = [w for (g, w), n in docs.items() if g == lang and n >= min_docs]

        def p(c: Counter, kept=kept) -> dict:
            total = sum(c[w] for w in kept)
            return {w: 1 + SCALE * (c[w] + 1) // (total + len(kept)) for w in kept}
        q = p(sum(own.values(), Counter()))
        share_of = {s: p(c) for s, c in own.items()}
        for s, c in own.items():
            pairs = [(-sum((share_of[s][w] - x[w]) ** 2 // x[w] for w in kept), o.encode()) for o, x in share_of.items() if o != s]
            terms = [(-((share_of[s][w] - q[w]) ** 2 // q[w]), w.encode()) for w in kept if c[w] and share_of[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(found)]
    return out


SQL = {"op13_source_divergence": rf"""
WITH doc AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
word AS (SELECT i, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term, count(*)::HUGEINT AS c FROM word GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
lang AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
cnt AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT lang, source, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM doc) LEFT JOIN (SELECT lang, source, sum(c) AS n FROM cnt GROUP BY ALL) USING (lang, source)),
p AS (SELECT g.lang, g.source, k.term, coalesce(cnt.c, 0) AS c, 1 + (1000000000 * (coalesce(cnt.c, 0) + 1)) // (g.n + lang.v) AS p,
    1 + (1000000000 * (k.c + 1)) // (lang.n + lang.v) AS q
  FROM grp g JOIN lang USING (lang) JOIN kept k USING (lang) LEFT JOIN cnt ON cnt.lang = g.lang AND cnt.source = g.source AND cnt.term = k.term),
summed AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (FROM pair UNION ALL FROM term))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200"""}
QUERIES = {"op13_source_divergence": op13_source_divergence}
