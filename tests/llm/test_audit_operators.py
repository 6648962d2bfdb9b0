"""Substring dedup, Merkle manifest and divergence audit against brute force; hashes of patterned bytes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.llm import common, decontaminate, divergence, merkle, ngram_join, quality, substrings

LANGS = ["en", "de", None, "", "zß", "Ω"]


def words(rnd, n, vocabulary=300):
    return " ".join(f"{rnd.choice('abÄé')}{rnd.randrange(vocabulary)}" for _ in range(n))


def thue_morse(n, letters="ab"):
    """Two different strings of 2^n letters whose plain polynomial sums modulo 2^64 are equal."""
    s = [0]
    for _ in range(n):
        s += [1 - x for x in s]
    return "".join(letters[x] for x in s), "".join(letters[1 - x] for x in s)


def windows_fixture():
    rnd = random.Random(5)
    passage, other = words(rnd, 70), words(rnd, 120)
    texts = [words(rnd, rnd.randint(0, 130)) for _ in range(25)]
    texts += [texts[7], words(rnd, 30) + " " + passage + "\n" + words(rnd, 20), passage.replace(" ", "\t\t", 9), other + " x " + passage + " " + other,
              other[3:], words(rnd, 60) + " " + other[:400] + "\x0b" + passage, "", None, " \n ", "same " * 49, "same " * 50, "same " * 80, passage[:200], "\xa0".join(["ab"] * 70),
              words(rnd, 20000, 10**6) + " " + passage]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    rows += [(6, passage), (6, passage + " y"), (6, passage), (None, other), (None, "same " * 60), (10**12, texts[3]), (-5, words(rnd, 60) + " " + passage)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("sketch_bytes", [substrings.SKETCH_BYTES, 0])
def test_repeated_windows_against_brute_force(spark, sketch_bytes):
    rows = windows_fixture()
    want = substrings.brute_force(rows)
    own = ["doc", "own", "body", "starts", "whole", "of", "of_own", "cell", "w1", "n_words", "KEPT_text", "_doc"]
    docs = spark.createDataFrame([(k, i, t, *own) for k, (i, t) in enumerate(rows)], "k int, doc_id bigint, text string, " + ", ".join(f"{c} string" for c in own)).repartition(5)
    out = substrings.drop_repeated_windows(docs, sketch_bytes=sketch_bytes)
    got = {r.k: r for r in out.withColumn("sha", F.sha2("kept_text", 256)).collect()}
    assert [(got[k].n_words, got[k].n_removed, got[k].sha) for k in range(len(rows))] == want
    assert all(r.text == rows[k][1] and [r[c] for c in own if c not in ("n_words", "KEPT_text")] == [c for c in own if c not in ("n_words", "KEPT_text")] for k, r in got.items())
    assert sum(w[1] > 0 for w in want) > 8


def test_no_window_is_lost_in_a_narrow_sketch(spark):
    """All cells full: every window is estimated repeated, and the exact grouping decides alone."""
    rows = [(i, t) for i, t in windows_fixture() if i is not None]
    texts = spark.createDataFrame(rows, "doc bigint, text string").select("doc", F.xxhash64("text").alias("own"), F.coalesce("text", F.lit("")).alias("text"))
    wide = substrings.repeated_starts(texts)
    full = spark.range(2 << 15).select(F.col("id").alias("cell"))
    narrow = substrings._by_bitmap(texts, full, 1 << 15, 50)
    assert narrow.count() == sum(max(0, len((t or "").encode().split()) - 49) for _, t in rows)
    hot = substrings.merged_sketch(texts, "text", 1 << 15, 50)
    pairs = {(r.doc, r.start) for r in substrings._by_join(texts, hot, 1 << 15, 50).collect()}
    assert {(r.doc, r.start) for r in wide.collect()} <= pairs


def test_windows_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert substrings.drop_repeated_windows(docs).collect() == []


def leaf_rows():
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["s", None, "Ü:1"]), rnd.choice(LANGS), rnd.choice([None, 3, 12345678901]), rnd.choice([None, "", "a:b", "é" * 5, "-"])) for i in range(150)]
    rows += [(10**15 + i, "s", "en", i, "t") for i in range(37)] + [(7, "s", "en", 1, "again"), (7, "s", "en", 1, "again"), (7, "s", "en", 2, "again"), (None, "s", "en", 2, None),
                                                               (None, None, None, None, None), (4, "s", "solo", 9, "x" * 200000)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("depth", [1, 3, 10])
def test_manifest_against_brute_force(spark, depth):
    rows = leaf_rows()
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string, pos string, tree string, id int, digest int, leaf int, proof int"
    docs = spark.createDataFrame([(*r, "p", "t", 1, 2, 3, 4) for r in rows], schema).repartition(6)
    touched = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    out = merkle.manifest(docs, observed={"n_chars": F.when(touched, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}, depth=depth)
    got = out.select("doc_id", "leaf", "subroot", "root", merkle.siblings(F.col("proof")).alias("s"), "folded_root", "verified").collect()
    def by(r):
        return [str(x) for x in r]
    assert sorted(map(tuple, got), key=by) == sorted(merkle.brute_force(rows), key=by)
    assert {r.verified for r in got} == {True, False}


def test_manifest_with_runs_of_three(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"))
    out = merkle.manifest(docs, fields=("doc_id", "n_chars"), arity=3, depth=2).collect()
    assert all(r.verified and r.folded_root == r.root for r in out) and len({r.root for r in out}) == 1
    assert sorted(r.pos for r in out) == list(range(50)) and {len(r.proof) for r in out} == {4}
    nodes = [r.leaf for r in sorted(out, key=lambda r: r.doc_id)]
    while len(nodes) > 1:
        nodes = [merkle.digest("".join(nodes[i: i + 3])) for i in range(0, len(nodes), 3)]
    assert {r.root for r in out} == {r.subroot for r in out} == set(nodes)


def test_manifest_of_few_rows(spark):
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    assert merkle.manifest(spark.createDataFrame([], schema)).collect() == []
    one = merkle.manifest(spark.createDataFrame([(1, None, None, None, None)], schema)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof == [] and one.lang is None


@pytest.mark.parametrize("block,cell_rows", [(32, 1 << 14), (2, 5)])
def test_divergence_against_brute_force(spark, block, cell_rows):
    rnd = random.Random(9)
    rows = [(words(rnd, rnd.randint(0, 40), rnd.choice([3, 30])) + " The THE Éa éa x1y2", rnd.choice(LANGS), rnd.choice(["a", "b", "c", "dé", "e", None])) for _ in range(120)]
    rows += [(None, "only", "nothing"), ("", "only", "blank"), ("12 34", "only", None), ("few", "pair", "a"), ("few", "pair", "b"), ("w " * 30000, "en", "long"), *[("dup dup", "en", "a")] * 5,
             (thue_morse(10)[0], "tm", "a"), (thue_morse(10)[1], "tm", "b"), (thue_morse(10)[0], "tm", "b")]
    docs = spark.createDataFrame([(*r, 1, "z", 2, 3) for r in rows], "text string, lang string, source string, n int, term string, k int, p int").repartition(4)
    got = divergence.divergence_audit(docs, block=block, cell_rows=cell_rows, top=7)
    assert [f.dataType.simpleString() for f in got.schema] == ["string"] * 4 + ["bigint", "int"]
    assert sorted(map(tuple, got.collect())) == sorted(divergence.brute_force(rows, top=7))
    assert divergence.divergence_audit(docs.limit(0)).collect() == []


def test_shares_are_exact():
    rnd = np.random.default_rng(1)
    count = rnd.integers(0, 10**12, 500)
    total, size = int(count.sum()) + 10**14, 12345
    assert divergence.shares(count, total, size).tolist() == [1 + 10**9 * (int(c) + 1) // (total + size) for c in count]


@pytest.mark.parametrize("n", [10, 11, 13])
def test_patterned_bytes_do_not_collide(n):
    a, b = thue_morse(n)
    buf = np.frombuffer((a + b + a + a.upper()).encode(), np.uint8)
    at = np.arange(4) * len(a)
    h = common.Hasher(buf).ranges(at, at + len(a))
    low = common.Hasher(buf, common.FOLDED).ranges(at, at + len(a))
    assert h[0] == h[2] != h[1] and h[3] != h[0] and low[0] == low[2] == low[3] != low[1]


def test_patterned_words_in_the_operators(spark):
    a, b = thue_morse(11)
    docs = spark.createDataFrame([(1, a), (2, b), (3, a), (4, f"{a}\n{b}")], "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs, "doc_id").select("doc_id", "component_id").collect()}
    assert found == {1: 1, 2: 2, 3: 1, 4: 4}
    marked = decontaminate.mark_contamination(docs, spark.createDataFrame([("i", a)], "item_id string, text string"))
    assert {r.doc_id: len(r.hit_spans) for r in marked.collect()} == {1: 1, 2: 0, 3: 1, 4: 1}
    rules = quality.apply_rules(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert {r.doc_id: r.n_dup_lines for r in rules.collect()} == {1: 0, 2: 0, 3: 0, 4: 0}


def test_one_word_repeated_on_both_sides_stays_linear():
    """20,000 equal words meet 20,000 equal words: no pairs of places are made."""
    import tracemalloc

    import pyarrow as pa
    batch = pa.record_batch({"text": ["same " * 20000, "other " * 9 + "same " * 12, "same " * 9]})
    tracemalloc.start()
    index = decontaminate.Index([("a", "same " * 20000), ("b", "x " + "same " * 11), ("c", "lone"), ("d", None)])
    out = decontaminate.mark(batch, "text", index, False).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r["n_words"], [tuple(x.values()) for x in r["hit_spans"]], r["hit_items"]) for r in out] == [
        (20000, [(0, 20000)], ["a", "b"]), (21, [(9, 21)], ["a", "b"]), (9, [], [])]
    assert peak < 300 << 20


@pytest.mark.parametrize("names", [["__gone", "__id", "__own", "__at", "__line", "__key", "__keeper", "__docs", "gone", "gone_id", "gone_own", "_gone"]])
def test_line_dedup_keeps_columns_of_any_name(spark, names):
    from packetloom.llm import lines
    shared = "a line of more than twenty letters"
    docs = spark.createDataFrame([(i, f"{shared}\nown {i}", *names) for i in range(4)], "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names))
    got = lines.drop_shared_lines(docs).collect()
    assert all([r[n] for n in names] == names for r in got)
    assert {r.doc_id: r.text for r in got} == {0: "own 0", 1: "own 1", 2: "own 2", 3: f"{shared}\nown 3"}


def test_decontamination_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "one two", "p"), (2, "three", "q")], "doc_id bigint, text string, __pass string")
    bench = spark.createDataFrame([("i", "two"), ("j", "three")], "item_id string, text string")
    got = {r.doc_id: r for r in decontaminate.mark_contamination(docs, bench, block_bytes=4).collect()}
    assert [(got[i]["__pass"], got[i].hit_items) for i in (1, 2)] == [("p", ["i"]), ("q", ["j"])]


def test_pieces_are_forgotten_at_the_end_of_a_task():
    import public_tokenizers

    import pyarrow as pa
    from packetloom.llm import pieces
    path = public_tokenizers.path("piece_bpe_32k.model")
    own = pieces.codec(path)
    first = own.encode(pa.array(["some words again and again"]))[0].tolist()
    assert own.cache and own.held > 0
    pieces.release(path, "bpe")
    assert not own.cache and own.held == 0 and own.encode(pa.array(["some words again and again"]))[0].tolist() == first
    pieces.release(path, "bpe")


def test_suffix_dedup_keeps_columns_of_any_name(spark):
    from packetloom.llm import suffixes
    names = ["__x", "__doc", "__nth", "__text", "__spans", "__of", "__of_nth", "doc", "nth"]
    text = "".join(f"part {i} of a long passage; " for i in range(10))
    docs = spark.createDataFrame([(i, text, *names) for i in range(3)], "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names))
    got = suffixes.drop_repeats(docs).collect()
    assert all([r[n] for n in names] == names for r in got)
    assert {r.doc_id: r.n_removed for r in got} == {0: 0, 1: len(text), 2: len(text)}
