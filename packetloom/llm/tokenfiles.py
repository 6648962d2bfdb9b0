"""Token ids as shards of separately compressed documents with a shared dictionary.

A shard is one binary value: a header (magic, version, number of documents, the first 16 bytes of
the dictionary's SHA-256), the offset index, and one zstandard frame per document, whose ids are
little-endian unsigned 32-bit integers.  Any document can be read from its offsets alone.  Shards
are rows of a Parquet table in document order, so every store that Spark reaches will do.
"""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.llm.common import SPACE, byte_set, flat, ragged, ship, slices, trim, words
from packetloom.session import cut_lineage, scratch_path

MAGIC = b"TOKSHRD1"
HEAD = struct.Struct("<8sII16s")
SHARD_BYTES = 8 << 20      # of text that one shard holds, or one longer document
SAMPLE_ROWS, SAMPLE_BYTES = 500, 32 << 10   # rows that the dictionary is trained on, and their longest
DICT_BYTES = 32 << 10
LEVEL = 1
SLICE = 1 << 20            # text that is encoded at once, or one longer document
BATCH = 4096               # pieces that the tokenizer gets at once: each of its results takes far more than the ids
CACHE_BYTES = 64 << 20     # of pieces and their ids that a worker keeps
ENTRY_BYTES = 200          # of a piece in the cache besides its letters and ids
NOT_SPACE = byte_set(SPACE)


class Encoder:
    """Ids of whole texts by a tokenizer that drops white space.

    Such a tokenizer treats the stretches between white space one by one, so each distinct stretch
    of a slice is given to the library once.  A stretch is also cut between an ASCII letter and a
    mark that the tokenizer keeps apart from letters, unless an added token holds such a pair.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[bytes, int] = {}      # place of a piece in the two arrays after the ids
        self.ids, self.first, self.number = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held = 0
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        joined = {b for t in added for a, b in zip(t, t[1:], strict=False) if a.isalpha()}

        def ids(text: str) -> list[int]:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        self.cut_before = np.zeros(256, bool)
        for mark in ".,;:!?|*#$%&)":
            if mark not in joined and all(ids(x + mark + y) == ids(x) + ids(mark + y) for x in ("a", "Thing") for y in ("", "b", mark, "'s")):
                self.cut_before[ord(mark)] = True

    def _new(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, and how many each has."""
        ids, number = [np.zeros(0, np.uint32)], []
        for k in range(0, len(pieces), BATCH):
            for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces[k: k + BATCH]], add_special_tokens=False):
                ids.append(np.array(e.ids, np.uint32))
                number.append(len(ids[-1]))
        return np.concatenate(ids), np.array(number, np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each row has."""
        buf, offsets = flat(column)
        start, end, row = words(buf, offsets, NOT_SPACE)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        letter = buf | 32
        cut = np.flatnonzero(self.cut_before[buf[1:]] & (letter[:-1] >= 97) & (letter[:-1] <= 122) & (buf[:-1] < 128)) + 1
        cut = cut[~np.isin(cut, offsets)]     # never between rows: there words end anyway
        start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
        row = np.searchsorted(offsets, start, "right") - 1
        size = end - start
        bounds = np.zeros(len(start) + 1, np.int64)
        np.cumsum(size, out=bounds[1:])
        inside = np.ascontiguousarray(buf[NOT_SPACE[buf]])
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(inside)]).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        get = self.cache.get
        place = np.array([get(p, -1) for p in distinct], np.int64)
        missing = np.flatnonzero(place < 0)
        fresh = [distinct[k] for k in missing]
        new, number = self._new(fresh)
        place[missing] = len(self.first) + np.arange(len(missing))
        ids, numbers = np.concatenate([self.ids, new]), np.concatenate([self.number, number])
        first = np.concatenate([self.first, len(self.ids) + np.cumsum(number) - number])
        more = sum(map(len, fresh)) + 4 * len(new) + ENTRY_BYTES * len(fresh)
        if self.held + more <= CACHE_BYTES:
            self.held += more
            self.cache.update(zip(fresh, place[missing].tolist(), strict=True))
            self.ids, self.first, self.number = ids, first, numbers
        place = place[pieces.indices.to_numpy()]
        counts = numbers[place]
        return ids[ragged(first[place], counts)], np.bincount(row, counts, len(offsets) - 1).astype(np.int64)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> list[bytes]:
    """Each row's ids and the end id, serialized."""
    cut = np.cumsum(counts)
    tail = np.uint32(end_id).astype("<u4").tobytes()
    return [ids[b - n: b].astype("<u4").tobytes() + tail for b, n in zip(cut, counts, strict=True)]


def train_dictionary(docs: DataFrame, text: str, path: str, end_id: int, seed_col: str) -> bytes:
    """A zstandard dictionary from the ids of at most ``SAMPLE_ROWS`` rows (smallest hashes of
    ``seed_col``); too few rows give a raw-content dictionary or, without rows, none."""
    short = docs.where(F.octet_length(text) <= SAMPLE_BYTES).select(F.col(text).alias("text"), F.xxhash64(seed_col).alias("at"))
    # the hashes alone meet on the driver first: tasks must not send it their texts
    last = short.select("at").orderBy("at").limit(SAMPLE_ROWS).agg(F.max("at").alias("at")).first()["at"]
    if last is None:
        return b""
    rows = sorted(short.where(F.col("at") <= last).limit(2 * SAMPLE_ROWS).collect(), key=lambda r: (r["at"], r["text"]))[:SAMPLE_ROWS]
    texts = pa.record_batch({"text": pa.array([r["text"] for r in rows], pa.large_string())})
    samples = [d for part in slices(iter([texts]), "text", SLICE) for d in with_end(*encoder(path).encode(part.column("text")), end_id)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def _dictionary(content: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(content)} if len(content) >= 8 else {}


def pack(documents: list[bytes], content: bytes) -> bytes:
    packer = zstandard.ZstdCompressor(level=LEVEL, **_dictionary(content))
    frames = [packer.compress(d) for d in documents]
    offsets = np.zeros(len(frames) + 1, "<u8")
    np.cumsum([len(f) for f in frames], out=offsets[1:])
    return HEAD.pack(MAGIC, 1, len(frames), hashlib.sha256(content).digest()[:16]) + offsets.tobytes() + b"".join(frames)


class Shard:
    """Random access to the documents of a shard."""

    def __init__(self, blob: bytes, content: bytes):
        magic, version, self.n, digest = HEAD.unpack_from(blob)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token shard")
        if digest != hashlib.sha256(content).digest()[:16]:
            raise ValueError("the shard was written with another dictionary")
        self.offsets = np.frombuffer(blob, "<u8", self.n + 1, HEAD.size)
        self.body = memoryview(blob)[HEAD.size + self.offsets.nbytes:]
        self.reader = zstandard.ZstdDecompressor(**_dictionary(content))

    def __getitem__(self, k: int) -> np.ndarray:
        return np.frombuffer(self.reader.decompress(self.body[int(self.offsets[k]): int(self.offsets[k + 1])]), "<u4")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text") -> None:
    """Write ``folder/shards`` and ``folder/dictionary`` in ascending order of ``id_col``.

    A null id comes first, equal ids go by text; null and empty texts hold the end id alone.  Other
    columns are not written.  An empty table writes no shard.  Each task sorts a range of ids and
    holds one shard of ``SHARD_BYTES`` and encodes ``SLICE`` of it at once; a rerun task writes the same bytes.
    """
    spark = docs.sparkSession
    ship(spark)
    content = train_dictionary(docs, text, tokenizer, end_id, id_col)
    spark.createDataFrame([(bytearray(content),)], "content binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    known = spark.sparkContext.broadcast(content)
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        try:
            for k, rows in enumerate(slices(batches, "text", SHARD_BYTES)):
                documents = [d for some in slices(iter([rows]), "text", SLICE) for d in with_end(*encoder(tokenizer).encode(some.column("text")), end_id)]
                tokens = sum(map(len, documents)) // 4
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([k], pa.int32()), pa.array([tokens], pa.int64()),
                                                  pa.array([rows.column("id").to_pylist()], pa.list_(rows.schema.field("id").type)), pa.array([pack(documents, known.value)], pa.binary())],
                                                 names=["part", "shard", "tokens", "ids", "blob"])
        finally:
            trim()
    ordered = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).repartitionByRange("id").sortWithinPartitions("id", "text")
    ordered.mapInArrow(work, f"part int, shard int, tokens bigint, ids array<{kind}>, blob binary").write.parquet(f"{folder}/shards")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of every document, decoded from the files.

    ``start`` adds up the shards before: sums of a part's shards by a window over its few rows, and
    one total per part on the driver (as many rows as the writer had tasks).
    """
    shards = spark.read.parquet(f"{folder}/shards")
    content = spark.sparkContext.broadcast(bytes(spark.read.parquet(f"{folder}/dictionary").first()["content"]))
    light = shards.select("part", "shard", "tokens")
    totals = sorted((r["part"], r["n"]) for r in light.groupBy("part").agg(F.sum("tokens").alias("n")).collect())
    before, seen = [], 0
    for part, n in totals:
        before.append((part, seen))
        seen += n
    sums = light.selectExpr("part", "shard", "sum(tokens) OVER (PARTITION BY part ORDER BY shard) - tokens AS within")
    starts = cut_lineage(sums.join(F.broadcast(spark.createDataFrame(before, "part int, before bigint")), "part")
                         .select("part", "shard", (F.col("before") + F.col("within")).alias("start")), "shard_starts")
    placed = shards.join(F.broadcast(starts) if starts.count() < 500_000 else starts, ["part", "shard"]).select("ids", "blob", "start")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                shard = Shard(batch.column("blob")[r].as_buffer().to_pybytes(), content.value)
                docs = [shard[k] for k in range(shard.n)]
                counts = np.array([len(d) for d in docs], np.int64)
                begin = batch.column("start")[r].as_py() + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays([batch.column("ids")[r].values, pa.array(begin), pa.array(counts),
                                                  pa.array([zlib.crc32(d.tobytes()) for d in docs], pa.int64())], names=["id", "start", "n_tokens", "ids_crc32"])
    kind = shards.schema["ids"].dataType.elementType.simpleString()
    return placed.mapInArrow(work, f"id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def op5_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    folder = scratch_path(spark, "tokens")
    write_tokens(docs, folder, public_tokenizers.path("word_bpe_49k.json"), 2)
    return read_tokens(spark, folder).withColumnRenamed("id", "doc_id")


SQL: dict[str, str] = {}
QUERIES = {"op5_token_files": op5_token_files}
