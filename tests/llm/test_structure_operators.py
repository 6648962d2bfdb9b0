"""Suffix dedup, token files, quality rules, pieces, n-gram join and the pipeline against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from packetloom.llm import ngram_join, pieces, quality, suffixes, tokenfiles
from packetloom.session import scratch_path

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rnd, n):
    return " ".join(rnd.choice(["la", "que", "Ment", "tion", "é", "der", "x.", "\n"]) + rnd.choice(["a", "bo", "ci"]) * rnd.randint(0, 3) for _ in range(n))


@pytest.mark.parametrize("alphabet,n", [(2, 400), (3, 1), (30, 700)])
def test_suffix_array_is_sorted(alphabet, n):
    text = np.random.default_rng(n).integers(97, 97 + alphabet, n).astype(np.uint8)
    raw = text.tobytes()
    assert suffixes.suffix_array(text, n + 8).tolist() == sorted(range(n), key=lambda i: raw[i:])


@pytest.mark.parametrize("hot", [8192, 1])
def test_repeats_against_brute_force(spark, hot):
    rnd = random.Random(7)
    passage, other = prose(rnd, 40), prose(rnd, 60)
    texts = [prose(rnd, rnd.randint(0, 80)) for _ in range(30)]
    texts += [texts[3], prose(rnd, 10) + passage + prose(rnd, 9), passage + other, prose(rnd, 5) + passage[7:] + "ü" + other[:150] + passage, "ab" * 300, "", other + "ab" * 90, None]
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in enumerate(texts)], "doc_id bigint, text string, n_spans int, __x string")
    keyed = docs.select(F.col("doc_id").alias("doc"), F.lit(0).alias("nth"), F.coalesce("text", F.lit("")).alias("text"))
    want = suffixes.brute_force([(t or "").encode() for t in texts])
    if hot == 1:   # every anchor with two contexts takes the way of hot ones
        spans = collections.defaultdict(set)
        for r in suffixes.repeated_spans(keyed, hot=1).collect():
            spans[r.doc] |= set(range(r.start, r.end))
        assert [len(spans[i]) for i in range(len(texts))] == [w[0] for w in want]
        return
    got = {r.doc_id: r for r in suffixes.drop_repeats(docs.drop("__x")).collect()}
    assert [(got[i].n_removed, got[i].n_spans, hashlib.sha256(got[i].kept_bytes).hexdigest()) for i in range(len(texts))] == want
    twice = spark.createDataFrame([(1, "q" * 30 + passage), (1, "q" * 30 + passage), (None, passage)], "doc_id bigint, text string")
    rows = suffixes.drop_repeats(twice).collect()
    size = len(("q" * 30 + passage).encode())
    assert sorted(r.n_removed for r in rows) == sorted([0, len(passage.encode()), size])
    assert suffixes.drop_repeats(docs.drop("__x").limit(0)).count() == 0


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    rnd = random.Random(1)
    texts = [(i, prose(rnd, rnd.randint(0, 50))) for i in range(60)] + [(100, None), (101, ""), (102, "Ça va <|endoftext|> É don't"), (103, "mot " * 20000), (5, "again"), (None, "first")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc_id bigint, text string, start int")
    folder = scratch_path(spark, "tokens")
    tokenfiles.write_tokens(docs, folder, path, 2)
    got = tokenfiles.read_tokens(spark, folder).collect()
    library, start, want = Tokenizer.from_file(path), 0, []
    for i, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    content = bytes(spark.read.parquet(f"{folder}/dictionary").first().content)
    row = spark.read.parquet(f"{folder}/shards").orderBy("part", "shard").first()
    assert tokenfiles.Shard(bytes(row.blob), content)[0].tolist() == library.encode("first", add_special_tokens=False).ids + [2]
    with pytest.raises(ValueError, match="dictionary"):
        tokenfiles.Shard(bytes(row.blob), content + b"x")
    with pytest.raises(Exception):
        tokenfiles.write_tokens(docs, folder, path, 2)   # nothing is overwritten


def base(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    count = collections.Counter(tuple(w[i: i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) for k in range(3) if count[tuple(w[i: i + 3])] > 1}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(covered)


def test_token_encoder_keeps_few_pieces_and_gives_all_ids(monkeypatch):
    import public_tokenizers

    import pyarrow as pa
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), tokenfiles.Encoder(path)
    monkeypatch.setattr(tokenfiles, "CACHE_BYTES", 20_000)
    monkeypatch.setattr(tokenfiles, "BATCH", 7)
    asked = []
    new = own._new
    monkeypatch.setattr(own, "_new", lambda pieces: asked.append(len(pieces)) or new(pieces))
    for k in range(6):
        texts = [f"common words, here{k}x{i} odd{i * 7919 + k}" for i in range(30)] + ["", None, "common words"]
        ids, counts = own.encode(pa.array(texts))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
        assert own.held <= 20_000 and len(own.cache) == len(own.first) == len(own.number)
    assert 0 < len(own.cache) < sum(asked)


def test_quality_counts_and_decisions(spark):
    rnd = random.Random(2)
    good = [prose(rnd, 90).replace("\n", "und.\n") for _ in range(40)]
    poor = ["\n".join(f"### {rnd.choice('abc')}$$$ %%% &&& {rnd.randint(0, 99)} |" for _ in range(40)) for _ in range(40)]
    texts = good + poor + [None, "", "a b c " * 60, "same line here\n" * 3, "x y \x0b z\n\n \n"]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id bigint, text string, kept string")
    marks = spark.createDataFrame([(i, int(i < 40)) for i in range(80) if i % 4] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    got = {r.doc_id: r for r in quality.apply_rules(docs, marks).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    held = [i for i in range(80) if i % 4 == 0 and not got[i].base_failed]
    assert held and all(got[i].kept == (i < 40) for i in held)
    assert quality.apply_rules(docs.limit(0), marks.limit(0)).count() == 0


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(4)
    counts = np.array([3, 0, 5, 1])
    emit, trans = rng.normal(size=(9, 2)), rng.normal(size=(2, 2))
    got, at = quality.viterbi(emit, counts, trans), 0
    for n in counts:
        if n:
            ways = [[(k >> i) & 1 for i in range(n)] for k in range(1 << n)]
            best = max(ways, key=lambda y: sum(emit[at + i, c] for i, c in enumerate(y)) + sum(trans[a, b] for a, b in zip(y, y[1:], strict=False)))
            assert got[at: at + n].tolist() == best
        at += n


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_pieces_against_the_library(kind):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    rnd = random.Random(8)
    texts = [prose(rnd, rnd.randint(0, 60)) for _ in range(80)] + ["", None, "  two  spaces ", "aaaaaaaaaaaa", "梦 \U0001f600 \x00\t\nüß", "=" * 70, "é", "x" * 3000]
    own = pieces.codec(path, kind)
    ids, counts = own.encode(pa.array(texts, pa.string()))
    rows = np.split(ids, np.cumsum(counts)[:-1])
    assert [t or "" for t in texts] == own.decode(ids, counts)
    if kind == "bpe":
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        assert [r.tolist() for r in rows] == [library.encode(t or "") for t in texts]
        return
    score = own.model.score
    table = {k: i for i, k in enumerate(own.model.text) if k}
    word = "▁mention".replace("▁", " ")
    best = [(0.0, [])]
    for end in range(1, len(word) + 1):
        best.append(max((best[s][0] + score[table[word[s:end].encode()]], best[s][1] + [table[word[s:end].encode()]]) for s in range(end) if word[s:end].encode() in table))
    assert own.encode(pa.array(["mention"]))[0].tolist() == best[-1][1]


def brute_components(docs):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets[i] = {tuple(w[k: k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    part = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(part[a], part[b]), min(part[a], part[b])
                part = {k: new if v == old else v for k, v in part.items()}
    return {i: (len(sets[i]), part[i]) for i in sets}


@pytest.mark.parametrize("hot,small", [(3, 32), (1, 0)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, hot, small):
    rnd = random.Random(11)
    docs, i = [], 0
    shared = prose(rnd, 60)
    for family in range(8):
        text = prose(rnd, rnd.choice([3, 4, 6, 30, 120, 260])).split(" ")
        for _ in range(7):
            own = list(text)
            for _ in range(rnd.randint(0, max(1, len(own) // 30))):
                own[rnd.randrange(len(own))] = rnd.choice(["q", "w", "zz"])
            docs.append((i, " ".join(own)))
            i += 1
    docs += [(100 + k, shared + " " + prose(rnd, 40)) for k in range(20)]
    docs += [(200, None), (201, ""), (202, " \n"), (203, "one"), (204, "ONE"), (205, docs[0][1])]
    monkeypatch.setattr(ngram_join, "SHARE", 1)
    monkeypatch.setattr(ngram_join, "HOT_COUNT", hot)
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", small)
    df = spark.createDataFrame([(k, t, 5) for k, t in docs + [docs[3], (None, "one")]], "doc_id bigint, text string, component_id int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()}
    assert got.pop(None)[1] is None
    assert got == brute_components(docs)
    assert ngram_join.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(10, 60)] + [(1, 2), (2, 1), (3, 3)], "a bigint, b bigint")
    got = dict(map(tuple, ngram_join.components(links).collect()))
    assert got == {k: 10 for k in range(10, 61)} | {1: 1, 2: 1}


def test_pipeline_stages_against_brute_force(spark, folder):
    import corpus_pipeline
    from tests_llm_help import brute_hits, brute_lines
    rnd = random.Random(21)
    item = " ".join(f"word{k}" for k in range(14))
    clean = [prose(rnd, 150).replace("\n", "fin.\n") for _ in range(12)]
    texts = clean + [clean[0], clean[1] + " more", clean[2] + "\n" + item, "too short", None, "\n".join("### $$$ %%% |||" for _ in range(60))]
    path = str(folder)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(12)] + [(17, 0)], "doc_id bigint, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([("b1", item)], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    one = stages["quality_rules"](spark, docs, path)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == set(range(15))
    two = stages["line_dedup"](spark, one, path)
    want = {i: (kept, len(text)) for i, text, kept in brute_lines([(i, t) for i, t in enumerate(texts) if i < 15])}
    assert {r.doc_id: (hashlib.sha256(r.text.encode()).hexdigest(), r.n_chars) for r in two.collect()} == want
    three = stages["ngram_join"](spark, one, path)
    assert {r.doc_id for r in three.collect()} == {i for i, (_, c) in brute_components([(i, t) for i, t in enumerate(texts) if i < 15]).items() if c == i}
    four = stages["decontaminate"](spark, one, path)
    assert {r.doc_id for r in four.collect()} == {i for i, _, hit, _ in brute_hits([(i, t) for i, t in enumerate(texts) if i < 15], [("b1", item)]) if not hit}
    last = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in last} <= set(range(15)) and all(r.n_pieces == len(r.piece_ids) for r in last)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "decontaminate", "sentencepiece"]


def test_near_duplicate_stage_keeps_one_of_repeated_rows_and_null_ids(spark, folder):
    import corpus_pipeline
    rnd = random.Random(5)
    a, b, c, d = (prose(rnd, 120) for _ in range(4))
    rows = ([(1, a, "x"), (1, a, "x"), (1, a, "w"), (2, a + " more", "x"), (3, b, "x"), (3, c, "x")]
            + [(None, c, "y"), (None, d, "z"), (None, d, "y"), (None, d + " more", "y"), (None, "short", "y"), (None, "short", "y"), (None, " ", "y"), (None, None, "y")])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = corpus_pipeline.ngram_join(spark, docs, str(folder)).collect()
    low, high = [r for r in got if r.doc_id is not None], [r for r in got if r.doc_id is None]
    assert sorted(map(tuple, low)) == sorted([(1, a, "w"), (3, b, "x"), (3, c, "x")])
    assert sum((r.text or "").startswith(d) for r in high) == 1 and not any(r.text == c for r in high)
    assert sorted((r.text or "") for r in high if not (r.text or "").startswith(d)) == ["", " ", "short"]
