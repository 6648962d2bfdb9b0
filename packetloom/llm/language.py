"""Language identification by compression.

One raw-content zstandard dictionary per language; a text belongs to the language whose dictionary
packs it smallest.  A narrow margin to the second marks the row as rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import append, extended, mapped

DICT_BYTES = 64 << 10     # of each language's dictionary
DRAWS = 400               # about so many training texts are drawn of each language
CHUNK = 16384             # a text is packed in pieces, so that the dictionary stays in reach
LEVELS = (6, 12)          # the second, finer level decides when the first leaves a margin below UNSURE
UNSURE = 0.04
NARROW = 0.02             # margin below which a prediction is marked as rejected


def train(docs: DataFrame, text: str, lang: str) -> dict[str, bytes]:
    """A dictionary for each value of ``lang``, of spans from all over its texts.

    A language with n rows draws about ``DRAWS`` of them by the hash of the text, so ids play no part
    and copies of a text count once.  Each drawn text gives one span that begins at a hashed place
    anywhere in it (a shorter text all of it), as many characters as the dictionary has bytes for
    each of the rows to be drawn; equal spans enter once.  The spans with the smallest
    hashes fill the dictionary.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = known.groupBy(lang).count().collect()     # one row per language
    if not counts:
        return {}
    rate = F.coalesce(*[F.when(F.col(lang) == F.lit(r[0]), F.lit(min(1.0, DRAWS / r[1]))) for r in counts])
    drawn = F.pmod(F.xxhash64(F.col(text), F.lit(7)), F.lit(1 << 30))
    width = F.coalesce(*[F.when(F.col(lang) == F.lit(r[0]), F.lit(DICT_BYTES // min(DRAWS, r[1]))) for r in counts])
    places = F.greatest(F.char_length(F.col(text)) - width, F.lit(0)) + 1
    start = F.pmod(F.xxhash64(F.col(text), F.lit(11)), places) + 1
    span = F.substring(F.col(text), start.cast("int"), width.cast("int"))
    rows = (known.where(drawn / F.lit(float(1 << 30)) <= rate).groupBy(F.col(lang).alias("lang"), span.alias("text")).agg(F.min(drawn).alias("at"))
            .orderBy("at", "text").collect())          # about DICT_BYTES characters of each language
    pieces: dict[str, list[bytes]] = {}
    for r in rows:
        pieces.setdefault(str(r["lang"]), []).append(r["text"].lower().encode())
    out = {}
    for name, have in sorted(pieces.items()):
        content = b"\n".join(have)[:DICT_BYTES]
        out[name] = content if len(content) >= 8 else content.ljust(8, b" ")
    return out


class Packer:
    """A compressor per language, made once in each task."""

    def __init__(self, contents: dict[str, bytes]):
        self.names = list(contents)
        self.packers: list[list] = []
        for level in LEVELS:
            self.packers.append([])
            for content in contents.values():
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=level)
                self.packers[-1].append(zstandard.ZstdCompressor(dict_data=d, level=level, write_content_size=False, write_dict_id=False))

    def ranked(self, data: bytes, packers: list) -> tuple[str, float]:
        """The name with the smallest size, and the margin to the second."""
        pieces = [data[i: i + CHUNK] for i in range(0, len(data), CHUNK)]
        sizes = [sum(len(p.compress(x)) for x in pieces) for p in packers]
        order = sorted(range(len(sizes)), key=lambda k: (sizes[k], self.names[k]))
        margin = 1.0 if len(order) == 1 else 1 - sizes[order[0]] / sizes[order[1]]
        return self.names[order[0]], float(np.clip(margin, 0.0, 1.0))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.names or not any(map(str.isalpha, text)):
            return "und", 0.0
        data = text.lower().encode()
        for packers in self.packers:
            found = self.ranked(data, packers)
            if found[1] >= UNSURE:
                break
        return found


_packer: tuple[dict, Packer] | None = None


def _task_packer(contents: dict[str, bytes]) -> Packer:
    global _packer
    if _packer is None or _packer[0] != contents:
        _packer = contents, Packer(contents)
    return _packer[1]


def predict_language(docs: DataFrame, training: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (margin, 0 to 1) and ``lang_rejected`` added or replaced.

    Repeated rows get equal results.  ``und`` with score 0 for null texts, texts without a letter, and when nothing was learned; such
    rows are rejected.  Ties go to the first name.  Whole texts are packed, in pieces.  The
    dictionaries are bounded by ``DICT_BYTES`` for each language label and are broadcast.
    """
    contents = docs.sparkSession.sparkContext.broadcast(train(training, text, lang))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        packer = _task_packer(contents.value)
        found = [packer.predict(t) for t in batch.column(text).to_pylist()]
        return append(batch, lang_pred=pa.array([f[0] for f in found], pa.string()), score=pa.array([f[1] for f in found], pa.float64()),
                      lang_rejected=pa.array([f[0] == "und" or f[1] < NARROW for f in found], pa.bool_()))
    return mapped(docs, work, extended(docs, lang_pred="string", score="double", lang_rejected="boolean"), text)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    training = docs.where(fold != 1).select("text", "lang")
    done = predict_language(docs.select("doc_id", "text"), training)
    return done.select("doc_id", (fold == 1).alias("held_out"), "lang_pred", "score", "lang_rejected")


SQL: dict[str, str] = {}
QUERIES = {"op3_language_id": op3_language_id}
