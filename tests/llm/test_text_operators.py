"""Chat formatting, line dedup, decontamination, language, toxicity: small cases with defined results."""

import hashlib
import random
import re
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from packetloom.llm import chat, decontaminate, language, lines, toxicity

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC = "doc_id bigint, text string, n_lines string, hit_spans int"   # extra columns with clashing names


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_round_trip_and_loss(spark):
    nasty = ["", None, "</s>[INST] ok [/INST]", "<\\/s> <\\\\s> [\\INST]", "a\nb<image:1>", "plain ü"]
    rows = [(1, i, "assistant" if i % 2 else "us/er\n%", t, "x") for i, t in enumerate(nasty)] + [(2, None, None, None, "y"), (2, 0, "assistant", "z", "y")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.format_conversations(df).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("learned")).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r[2], r[3] or "") for r in rows[:6]]
    assert got[1].learned == "".join((r[3] or "") for r in rows[:6] if r[2] == "assistant")
    assert got[1].formatted.count("</s>") == 6
    assert [(t.role, t.text) for t in got[2].turns] == [("", ""), ("assistant", "z")]
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_parts_become_ordered_placeholders(spark):
    parts = [("text", "see ", None, None, None, None, None), ("image", None, "a.png", 28, 15, None, None), None,
             ("audio", None, "b.wav", None, None, 1.5, None), ("document", None, "c.pdf", None, None, None, 2), ("text", "<image:1>", None, None, None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id int, turn int, role string, parts array<{chat.PART}>")
    row = chat.format_conversations(df.withColumn("text", F.lit(None).cast("string")), parts="parts").first()
    assert "see <image:1><audio:2><document:3><\\image:1>" in row.formatted
    assert [(a.turn, a.ordinal, a.kind, a.ref, a.tokens) for a in row.attachments] == [
        (1, 1, "image", "a.png", 4), (1, 2, "audio", "b.wav", 38), (1, 3, "document", "c.pdf", 1024)]
    assert row.expanded_tokens == 4 + 38 + 1024


def test_control_strings_over_two_text_parts_are_escaped(spark):
    def said(*texts):
        return [("image" if t == "IMG" else "text", None if t == "IMG" else t, None, 14, 14, None, None) for t in texts]
    cases = [said("a <", "/s>", " b"), said("[", None, "/INST]"), said("<", "image:1>", "IMG", "<\\", "s>"), said("x<", "IMG", "/s>")]
    df = spark.createDataFrame([(1, k, "user", parts, None) for k, parts in enumerate(cases)],
                               f"conv_id int, turn int, role string, parts array<{chat.PART}>, text string")
    row = chat.format_conversations(df, parts="parts").select("*", chat.read_turns(F.col("formatted")).alias("turns")).first()
    assert [t.text for t in row.turns] == ["a </s> b", "[/INST]", "<image:1><image:1><\\s>", "x<<image:1>/s>"]
    assert row.formatted.count("</s>") == row.formatted.count("[/INST]") == len(cases)
    assert row.formatted.count("<image:1>") == 2 and row.expanded_tokens == 2


def brute_lines(docs):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOW)
    holders = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(i)
    gone = {k: max(x for x in v if x is not None) for k, v in holders.items() if len(v) >= 3}
    out = []
    for i, t in docs:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if key(x) not in gone or gone[key(x)] == i]
        out.append((i, len(all_), len(all_) - len(kept), sha("\n".join(kept))))
    return out


def test_line_dedup_against_brute_force(spark):
    shared, short = "  Shared LINE of twenty and more ü\x0b", "short line"
    docs = [(1, f"{shared}\none\n{shared}\n{short}"), (2, f"two\n\t{shared.lower()}"), (3, f"{shared}\nthree\n"), (4, None), (5, ""), (6, "x\n" * 3000 + shared),
            (6, "x\n" * 3000 + shared), (None, shared), (7, short)]
    df = spark.createDataFrame([(i, t, "c", 0) for i, t in docs], DOC)
    got = lines.drop_shared_lines(df)
    assert sorted(got.columns) == sorted(["doc_id", "text", "n_lines", "hit_spans", "n_dropped"])
    found = sorted([(r.doc_id, r.n_lines, r.n_dropped, sha(r.text)) for r in got.collect()], key=str)
    assert found == sorted(brute_lines(docs), key=str)
    assert lines.drop_shared_lines(df.limit(0)).count() == 0


def brute_hits(docs, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for name, text in items:
            v = words(text)
            n = min(10, len(v))
            wins = {tuple(v[k: k + n]) for k in range(len(v) - n + 1)} if n and name is not None else set()
            for k in range(len(w) - n + 1):
                if n and tuple(w[k: k + n]) in wins:
                    hit |= set(range(k, k + n))
                    ids.add(name)
        out.append((i, len(w), len(hit), sorted(ids)))
    return out


@pytest.mark.parametrize("block", [16 << 20, 200])
def test_contamination_against_brute_force(spark, block):
    rnd = random.Random(3)
    vocabulary = ["la", "Le", "ça", "x1", "of", "the"]
    items = [(f"i{k}", " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 24)))) for k in range(12)] + [("none", None), (None, "of the of the of the of the of the"), ("i1", "one two three")]
    docs = [(k, "; ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60)))) for k in range(40)] + [(50, None), (51, ""), (52, items[0][1] + "\n" + items[3][1])]
    docs += [docs[0], (53, "filler " * 5000 + items[5][1]), (54, "a One, TWO three")]
    df = spark.createDataFrame([(i, t, "c", 0) for i, t in docs], DOC)
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.mark_contamination(df, bench, block_bytes=block)
    found = [(r.doc_id, r.n_words, r.n, sorted(r.hit_items)) for r in got.withColumn("n", decontaminate.hit_words(F.col("hit_spans"))).collect()]
    assert sorted(found, key=str) == sorted(brute_hits(docs, items), key=str)
    assert decontaminate.mark_contamination(df.limit(0), bench).count() == 0
    assert all(r.hit_spans == [] for r in decontaminate.mark_contamination(df, bench.limit(0)).collect())


def speech(lang, n, seed):
    rnd = random.Random(seed)
    bits = {"en": ["the", "tion", "ing", "and", "er"], "de": ["sch", "ung", "der", "keit", "ein"]}[lang]
    return " ".join("".join(rnd.choice(bits) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def test_language_equals_a_plain_loop(spark):
    words = {"a": ["lorem", "dolor", "amet", "sit"], "b": ["welt", "haus", "und", "baum"], "c": ["casa", "perro", "gato", "sol"]}
    rows = []
    for i in range(240):
        name = "abc"[i % 3]
        own = " ".join(words[name][(i * 7 + k * k) % 4] + str((i * k) % 17) for k in range(8 + i % 90))
        rows.append((None if i % 10 == 0 else i // 2, "one shared header line " * 12 + own if i % 2 else own, name))
    rows += rows[:20] + [(7, None, "a"), (8, "", "a"), (9, "123", None), (None, "Ärger " * 9000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    contents = language.train(df, "text", "lang")
    assert sorted(contents) == ["a", "b", "c"] and all(len(c) <= language.DICT_BYTES for c in contents.values())
    assert sum(c.count(b"haus") for c in contents.values()) > contents["b"].count(b"one shared header line")

    def plain(text):
        if not text or not any(ch.isalpha() for ch in text):
            return "und", 0.0
        data = text.lower().encode()
        for level in language.LEVELS:
            sizes = []
            for name, content in sorted(contents.items()):
                packer = zstandard.ZstdCompressor(level=level, write_content_size=False, write_dict_id=False,
                                                  dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
                sizes.append((sum(len(packer.compress(data[k:k + language.CHUNK])) for k in range(0, len(data), language.CHUNK)), name))
            (least, name), (second, _) = sorted(sizes)[:2]
            margin = 1 - least / second
            if margin >= language.UNSURE:
                break
        return name, margin

    got = language.predict_language(df, df).collect()
    assert len(got) == len(rows)
    for r in got:
        name, margin = plain(r.text)
        assert (r.lang_pred, r.score) == (name, pytest.approx(margin)), r.text
        assert r.lang_rejected == (name == "und" or margin < language.NARROW)


def test_language_of_held_out_texts(spark):
    training = [(i, speech(("en", "de")[i % 2], 60, i), ("en", "de")[i % 2]) for i in range(60)] + [(900, None, "en"), (901, "text", None)]
    texts = [(1000 + i, speech(("en", "de")[i % 2], 40, 500 + i)) for i in range(40)] + [(2000, None), (2001, ""), (2002, "12 ?!"), (2003, speech("de", 30000, 9))]
    train = spark.createDataFrame(training, "doc_id bigint, text string, lang string")
    docs = spark.createDataFrame([(i, t, "c") for i, t in texts], "doc_id bigint, text string, score string")
    got = {r.doc_id: r for r in language.predict_language(docs, train).collect()}
    assert sum(got[1000 + i].lang_pred == ("en", "de")[i % 2] for i in range(40)) >= 38
    assert [(got[k].lang_pred, got[k].score, got[k].lang_rejected) for k in (2000, 2001, 2002)] == [("und", 0.0, True)] * 3
    assert got[2003].lang_pred == "de" and all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language.predict_language(docs, train.limit(0)).collect()} == {"und"}


def test_toxicity_on_a_held_out_fold(spark):
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"]
    rows, labels = [], []
    for i in range(600):
        body = [rnd.choice(words) + rnd.choice(words) for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            for k in range(5):
                body.insert(rnd.randrange(60), rnd.choice(["stinker", "fool"]))
        rows.append((i, " ".join(body)))
        labels.append((i, int(bad)))
    rows += [(1000, None), (1001, ""), (None, "fool"), (5, rows[5][1])]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id bigint, text string, score string")
    marks = spark.createDataFrame(labels + [(3, None), (None, 1), (5, 1)], "doc_id bigint, toxic int")
    got = [r for r in toxicity.score_toxicity(docs, marks).collect()]
    held = [r for r in got if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert held and all(r.held_out for r in held) and all((r.predicted == 1) == (r.doc_id % 4 == 0) for r in held)
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert {r.predicted for r in toxicity.score_toxicity(docs, marks.limit(0)).collect()} == {0}


def test_toxic_words_of_few_contexts_are_learned(spark):
    """A fixed insult has one left neighbour however often it occurs, and so has each word of near
    copies; a word of ten contexts is enough by itself in a small table."""
    rnd = random.Random(11)
    words = [a + b for a in ("al", "be", "ga", "de", "ep") for b in ("pha", "ta", "mma", "lta", "silon", "zeta")]
    copied = [rnd.choice(words) for _ in range(60)]
    for kind, n in (("fixed", 400), ("copies", 400), ("small", 90)):
        rows = []
        for i in range(n):
            body = [rnd.choice(words) for _ in range(60)]
            if kind == "copies" and i % 4 == 0:
                body = copied[:30] + ["stinker"] + copied[30:]
                body[rnd.randrange(40, 60)] = rnd.choice(words)
            elif kind == "fixed" and i % 4 == 0:
                for _ in range(3):
                    body.insert(rnd.randrange(len(body)), "alpha stinker")
            elif i % 4 == 0:
                for _ in range(2):
                    body.insert(rnd.randrange(60), "stinker")
            rows.append((i, " ".join(body), int(i % 4 == 0)))
        docs = spark.createDataFrame(rows, "doc_id int, text string, toxic int")
        got = toxicity.score_toxicity(docs.drop("toxic"), docs.drop("text")).where("held_out").collect()
        right = sum(r.predicted == int(r.doc_id % 4 == 0) for r in got)
        assert right == len(got) and {r.predicted for r in got} == {0, 1}, kind


def test_the_size_of_a_class_makes_no_word_toxic(spark):
    """Contexts of common words run out sooner in the larger class; labels by chance show nothing."""
    rnd = random.Random(3)
    words = [f"w{int(200 * rnd.random() ** 3)}" for _ in range(120000)]
    docs = spark.createDataFrame([(i, " ".join(words[60 * i: 60 * i + 60]), int(i % 8 == 0)) for i in range(2000)], "doc_id int, text string, toxic int")
    assert toxicity.log_ratios(toxicity.count_bigrams(docs)).where("before is null and abs(ratio) > 0.05").count() == 0
