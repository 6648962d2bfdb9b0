"""SentencePiece encoding and decoding by batched Viterbi.

Words of equal length advance together: at each end position the substrings that may be pieces are
hashed and looked up among the sorted piece keys, and the best way there is stored as a
backpointer.  In a unigram model the best way has the largest sum of scores.  In a byte-pair model
a way is valid only if merging would leave its last two pieces apart, and each prefix has exactly
one valid last piece; the same recurrence then gives what the library gives.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import append, extended, flat, lists, mapped, mix, ragged

META = "▁"             # stands for a space
UNKNOWN = -1                # a code point that is no piece
CACHE_BYTES = 32 << 20      # of words and their pieces that a task keeps; it drops them at its end
ENTRY_BYTES = 150           # of a word in the cache besides its letters and ids
MET_BITS = 20               # piece pairs whose answer a task keeps, as a power of two
SLICE = 1 << 20             # text whose distinct words advance together
_STEP = np.uint64(0x9FB21C651E98DF25)
_PAIR = np.uint64(0xD1342543DE82EF95)
_HIGH = np.uint64(43)       # the top 21 bits of a key tell most misses without a search


def _spelled(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _key(points: np.ndarray) -> np.uint64:
    h = np.zeros(1, np.uint64)
    for c in points:
        h = h * _STEP + np.uint64(c) + np.uint64(1)
    return mix(h)[0]


def _marked(keys: np.ndarray) -> np.ndarray:
    """Which top bits some key has."""
    out = np.zeros(1 << 21, bool)
    out[keys >> _HIGH] = True
    return out


class Model:
    """The pieces of a model file as arrays: keys, scores, merges, and the last merge of each piece."""

    def __init__(self, path: str, kind: str = "bpe"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.kind, self.unk = kind, sp.unk_id()
        self.bytes = np.full(256, self.unk, np.int64)
        self.text: list[bytes] = []
        pieces: dict[str, int] = {}
        for i in range(n):
            name = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(name[3:5], 16)] = i
                self.text.append(bytes([int(name[3:5], 16)]))
            elif sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i):
                self.text.append(" ⁇ ".encode() if sp.is_unknown(i) else b"")
            else:
                pieces[name] = i
                self.text.append(name.replace(META, " ").encode())
        self.longest = max(map(len, pieces))
        self.score = np.array([sp.get_score(i) for i in range(n)])
        order = sorted((p for p in pieces if len(p) > 1), key=lambda p: (-self.score[pieces[p]], pieces[p]))
        self.rank = np.full(n, -1, np.int64)
        self.rank[[pieces[p] for p in order]] = np.arange(len(order))
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        merges, usable = {}, dict(pieces)
        for p in order:
            for k in range(1, len(p)):
                if p[:k] in pieces and p[k:] in pieces:
                    merges[pieces[p[:k]] * n + pieces[p[k:]]] = self.rank[pieces[p]]
        if kind == "bpe":
            for p in order:
                last = self._last_merge(p, pieces)
                if last is None:
                    del usable[p]
                else:
                    self.left[pieces[p]], self.right[pieces[p]] = last
        keys = np.array([_key(_spelled(p)) for p in usable], np.uint64)
        sort = np.argsort(keys)
        self.keys, self.ids = keys[sort], np.array(list(usable.values()), np.int64)[sort]
        pairs = np.array(sorted(merges), np.int64)
        self.seen, self.pair_seen = _marked(self.keys), _marked(pairs.astype(np.uint64) * _PAIR)
        self.met = np.full(1 << MET_BITS, np.iinfo(np.int64).min, np.int64)
        self.pairs, self.pair_rank = pairs, np.array([merges[p] for p in pairs.tolist()], np.int64)
        self.n = n
        inside = {c for p in pieces if len(p) > 1 for c in p}
        self.single = np.array([chr(c) not in inside for c in range(128)])    # ASCII that no longer piece holds
        self.crossing = any(META in p.lstrip(META) for p in pieces)

    def _last_merge(self, piece: str, pieces: dict[str, int]) -> tuple[int, int] | None:
        parts = list(piece)
        while len(parts) > 2:
            ranks = [self.rank[pieces[a + b]] if a + b in pieces else len(self.rank) for a, b in zip(parts, parts[1:], strict=False)]
            k = int(np.argmin(ranks))
            if ranks[k] == len(self.rank):
                return None
            parts[k: k + 2] = [parts[k] + parts[k + 1]]
        found = [pieces.get(p) for p in parts]
        return None if None in found else (found[0], found[1])

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_stay_apart``, with a table of pairs met before (each slot keeps its latest pair)."""
        key = ((a + 1) * (self.n + 1) + b + 1) * 2
        slot = ((key.astype(np.uint64) * _PAIR) >> np.uint64(64 - MET_BITS)).astype(np.int64)
        held = self.met[slot]
        new = np.flatnonzero(held & ~1 != key)
        if len(new):
            found = key[new] | self._stay_apart(a[new], b[new])
            self.met[slot[new]] = held[new] = found
        return (held & 1).astype(bool)

    def _stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves these two pieces side by side.

        Takes the later of the two back to its own last merge, again and again: a merge across the
        border that comes before that moment would have been made instead.
        """
        out = np.ones(len(a), bool)
        live = np.flatnonzero((a != UNKNOWN) & (b != UNKNOWN))
        a, b = a[live], b[live]
        limit = np.full(len(live), np.iinfo(np.int64).max)
        while len(live):
            key = a * self.n + b
            maybe = np.flatnonzero(self.pair_seen[(key.astype(np.uint64) * _PAIR) >> _HIGH])
            at = np.minimum(np.searchsorted(self.pairs, key[maybe]), len(self.pairs) - 1)
            joined = np.zeros(len(key), bool)
            joined[maybe] = (self.pairs[at] == key[maybe]) & (self.pair_rank[at] < limit[maybe])
            out[live[joined]] = False
            ra, rb = self.rank[a], self.rank[b]
            more = ~joined & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[more], a[more], b[more], ra[more], rb[more]
            first = ra > rb
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return out

    def segment(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of equally long words (a matrix of code points): start and piece by end position."""
        count, size = points.shape
        piece = np.full((count, size + 1), UNKNOWN, np.int64)
        begin = np.zeros((count, size + 1), np.int64)
        total = np.full((count, size + 1), -np.inf)
        total[:, 0] = 0
        hashes = np.zeros((count, size), np.uint64)   # of the substring from each start, grown by one a step
        lowest = self.score.min() - 10
        for end in range(1, size + 1):
            low = max(0, end - self.longest)
            c = points[:, end - 1].astype(np.uint64) + np.uint64(1)
            hashes[:, low: end] = hashes[:, low: end] * _STEP + c[:, None]
            key = mix(hashes[:, low: end]).T.ravel()
            maybe = np.flatnonzero(self.seen[key >> _HIGH])
            at = np.minimum(np.searchsorted(self.keys, key[maybe]), len(self.keys) - 1)
            found = np.full(len(key), UNKNOWN, np.int64)
            found[maybe] = np.where(self.keys[at] == key[maybe], self.ids[at], UNKNOWN)
            found = found.reshape(end - low, count)
            for start in range(low, end):       # the longest first
                t = found[start - low]
                some = np.flatnonzero(t != UNKNOWN)
                if start == end - 1:
                    some = np.flatnonzero((t != UNKNOWN) | np.isneginf(total[:, end]))
                if self.kind == "bpe":
                    some = some[np.isneginf(total[some, end])]
                    if start and len(some):
                        some = some[self.apart(piece[some, start], t[some])]
                    value = np.zeros(len(some))
                else:
                    value = total[some, start] + np.where(t[some] == UNKNOWN, lowest, self.score[t[some]])
                    better = value > total[some, end]
                    some, value = some[better], value[better]
                total[some, end], begin[some, end], piece[some, end] = value, start, t[some]
        return begin, piece

    def spelled_out(self, begin: np.ndarray, piece: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words of ``segment``, followed back from their ends together, and how many each has."""
        count, size = points.shape
        row, at = np.arange(count), np.full(count, size)
        steps = []
        while len(row):
            start = begin[row, at]
            steps.append((row, piece[row, at], start))
            row, at = row[start > 0], start[start > 0]
        back = np.repeat(np.arange(len(steps)), [len(r) for r, _, _ in steps])
        row, piece_of, start = (np.concatenate(x) for x in zip(*steps, strict=True))
        lengths = np.bincount(row, minlength=count)
        place = np.cumsum(lengths)[row] - 1 - back
        ids = np.empty(len(row), np.int64)
        ids[place] = piece_of
        odd = np.flatnonzero(piece_of == UNKNOWN)
        if len(odd):
            raw = [self.bytes[list(chr(c).encode())] for c in points[row[odd], start[odd]]]
            raw = [np.array([self.unk]) if (r == self.unk).any() else r for r in raw]
            counts = np.ones(len(ids), np.int64)
            counts[place[odd]] = [len(r) for r in raw]
            first = (np.cumsum(counts) - counts)[place[odd]]
            ids = np.repeat(ids, counts)
            ids[ragged(first, np.array([len(r) for r in raw]))] = np.concatenate(raw)
            lengths = np.bincount(row, counts[place], count).astype(np.int64)
        return ids.astype(np.int32), lengths

    def encode_words(self, wordlist: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words (spaces already written as META): all ids, each word's first place and number."""
        sizes = np.array([len(w) for w in wordlist], np.int64)
        begin_of, lengths = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        out, seen = [np.zeros(0, np.int32)], 0
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            step = max(1, 400_000 // int(size) // min(int(size), self.longest))
            for k in range(0, len(own), step):
                some = own[k: k + step]
                points = _spelled("".join([wordlist[i] for i in some])).reshape(len(some), size)
                ids, number = self.spelled_out(*self.segment(points), points)
                lengths[some], begin_of[some] = number, seen + np.cumsum(number) - number
                seen += len(ids)
                out.append(ids)
        return np.concatenate(out), begin_of, lengths


class Codec:
    """Encodes and decodes text columns, each distinct word of a slice once."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()
        sizes = np.array([len(t) for t in model.text], np.int64)
        self.size, self.start = sizes, np.cumsum(sizes) - sizes
        self.bytes = np.frombuffer(b"".join(model.text), np.uint8)

    def forget(self) -> None:
        """Drop the words kept so far; the model stays with the worker."""
        self.cache: dict[bytes, int] = {}      # place of a word in the three arrays below
        self.ids, self.first, self.number = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held = 0

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each row has."""
        buf, offsets = flat(column)
        rows = len(offsets) - 1
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(rows, np.int64)
        # a word is spaces and what follows them; ASCII that no longer piece holds stands alone
        space = buf == 32
        meta = np.flatnonzero((buf[:-2] == 0xE2) & (buf[1:-1] == 0x96) & (buf[2:] == 0x81)) if len(buf) > 2 else np.zeros(0, int)
        blank = space.copy()
        for i in range(3):
            blank[meta + i] = True
        cut = np.zeros(len(buf) + 1, bool)
        cut[1:-1] = blank[1:] & ~blank[:-1]
        alone = np.zeros(256, bool)
        alone[:128] = self.model.single
        alone[32] = False
        lone = alone[buf]
        cut[:-1] |= lone
        cut[1:] |= lone
        cut[offsets] = True
        if self.model.crossing:
            cut[:] = False
            cut[offsets] = True
        bounds = np.flatnonzero(cut)
        row = np.searchsorted(offsets, bounds[:-1], "right") - 1
        head = np.zeros(len(bounds) - 1, bool)
        head[np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))] = True
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(buf))])
        coded = column.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        index = coded.indices.to_numpy().astype(np.int64)
        # the first word of a text has one more space in front
        heads, place = np.unique(index[head], return_inverse=True)
        index = index.copy()
        index[head] = len(distinct) + place
        distinct = distinct + [b" " + distinct[k] for k in heads]
        get = self.cache.get
        place = np.array([get(d, -1) for d in distinct], np.int64)
        missing = np.flatnonzero((place < 0) & (np.bincount(index, minlength=len(distinct)) > 0))
        fresh = [distinct[k] for k in missing]
        new, at, number = self.model.encode_words([d.decode().replace(" ", META) for d in fresh])
        place[missing] = len(self.first) + np.arange(len(missing))
        ids, first, numbers = np.concatenate([self.ids, new]), np.concatenate([self.first, len(self.ids) + at]), np.concatenate([self.number, number])
        more = sum(map(len, fresh)) + 4 * len(new) + ENTRY_BYTES * len(fresh)
        if self.held + more <= CACHE_BYTES:
            self.held += more
            self.cache.update(zip(fresh, place[missing].tolist(), strict=True))
            self.ids, self.first, self.number = ids, first, numbers
        place = place[index]
        counts = numbers[place]
        return ids[ragged(first[place], counts)], np.bincount(row, counts, rows).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of rows of ids: pieces joined, META as a space, without the first space."""
        size = self.size[ids]
        body = self.bytes[ragged(self.start[ids], size)].tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
        return [body[a: b].removeprefix(b" ").decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, kind: str = "bpe") -> Codec:
    if (path, kind) not in _codecs:
        _codecs[path, kind] = Codec(Model(path, kind))
    return _codecs[path, kind]


def release(path: str, kind: str) -> None:
    """What a task does at its end: workers are used again, by other operators too."""
    codec(path, kind).forget()


def encode_pieces(docs: DataFrame, model: str, kind: str = "bpe", text: str = "text") -> DataFrame:
    """``docs`` with ``piece_ids`` and ``decoded`` (what the ids spell) added or replaced.

    Null and empty texts have no ids and decode to ''.  A META sign in a text decodes to a space,
    as in the library; every other text comes back as it was.  ``model`` is a path that each
    machine has; a task keeps at most ``CACHE_BYTES`` of words, a worker the model.
    """
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(model, kind)
        ids, counts = own.encode(batch.column(text))
        return append(batch, piece_ids=lists(ids, counts, pa.int32()), decoded=pa.array(own.decode(ids, counts), pa.string()))
    return mapped(docs, work, extended(docs, piece_ids="array<int>", decoded="string"), text, SLICE, lambda: release(model, kind))


def digests(docs: DataFrame, model: str, kind: str = "bpe", text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id, n_pieces, ids_crc32, decoded_sha256, round_trip`` of each text, encoded and decoded."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(model, kind)
        ids, counts = own.encode(batch.column("text"))
        cut = np.cumsum(counts)
        sums = [zlib.crc32(ids[b - n: b].astype("<i4").tobytes()) for b, n in zip(cut, counts, strict=True)]
        return append(batch, n_pieces=pa.array(counts), ids_crc32=pa.array(sums, pa.int64()), decoded=pa.array(own.decode(ids, counts), pa.string()))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    done = mapped(rows, work, extended(rows, n_pieces="bigint", ids_crc32="bigint", decoded="string"), limit=SLICE, after=lambda: release(model, kind))
    return done.select("doc_id", "n_pieces", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"),
                       (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("round_trip"))


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


SQL: dict[str, str] = {}
QUERIES = {"op8_sentencepiece": op8_sentencepiece}
