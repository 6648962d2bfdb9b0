"""The corpus pipeline: quality rules, line dedup, n-gram Jaccard join, decontamination, encoding.

Each stage works on all its predecessor kept.  Stages 1, 3 and 4 drop documents, stage 2 rewrites
their text, stage 5 turns it into piece ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetloom.llm.common import join_small
from packetloom.llm.decontaminate import mark_contamination
from packetloom.llm.lines import drop_shared_lines
from packetloom.llm.ngram_join import near_duplicates
from packetloom.llm.pieces import encode_pieces
from packetloom.llm.quality import apply_rules
from packetloom.session import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose words are mostly in boilerplate lines, go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return apply_rules(docs, labels).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents share stay in one of them; ``n_chars`` follows the text."""
    done = drop_shared_lines(docs)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def with_row_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row_id``, of which no value but null is repeated.

    Rows that repeat an id and its text count once, by the least of their other columns.  Of an id
    with several texts the greatest keeps the id.  The others, and the texts of rows without an id
    (equal ones once), get ids above all others.  A row without an id whose text has no words links
    with nothing and gets none.
    """
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    count = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc_id is not null")
    twice = cut_lineage(count.select(F.col("doc_id").alias("again")), "repeated_ids")
    lost = docs.where("doc_id is null")
    if twice.isEmpty() and lost.isEmpty():
        return docs.withColumn("row_id", F.col("doc_id").cast("bigint"))
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    plain = join_small(docs.where("doc_id is not null"), twice, F.col("doc_id") == F.col("again"), "left_anti", 16)
    again = join_small(docs, twice, F.col("doc_id") == F.col("again"), "left_semi", 16)
    # partial aggregates: copies of one row may be any share of the table
    odd = cut_lineage(again.unionByName(lost.where(worded)).groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("__first"), *others)).alias("__rest"))
                      .select("doc_id", "text", *[F.col("__rest")[c].alias(c) for c in docs.columns if c not in ("doc_id", "text")]), "odd_rows")
    top = odd.where("doc_id is not null").groupBy(F.col("doc_id").alias("top_id")).agg(F.max("text").alias("top_text"))
    on = (F.col("doc_id") == F.col("top_id")) & F.col("text").eqNullSafe(F.col("top_text"))
    marked = odd.join(top, on, "left").withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(4096)))
    fresh = cut_lineage(marked.where("top_id is null").drop("top_id", "top_text"), "fresh_rows")
    base = docs.agg(F.coalesce(F.max(F.col("doc_id").cast("bigint")), F.lit(0))).first()[0]
    sizes = fresh.groupBy(F.col("__bucket").alias("b")).agg(F.count(F.lit(1)).alias("n"))    # 4096 rows at most
    starts = sizes.select("b", (F.sum("n").over(Window.orderBy("b")) - F.col("n")).alias("start"))
    place = F.row_number().over(Window.partitionBy("__bucket").orderBy("doc_id", "text"))
    named = (fresh.withColumn("__place", place).join(F.broadcast(starts), F.col("__bucket") == F.col("b"))
             .withColumn("row_id", (F.lit(base) + F.col("start") + F.col("__place")).cast("bigint")))
    own = F.col("doc_id").cast("bigint").alias("row_id")
    kept = [plain.select(*docs.columns, own), marked.where("top_id is not null").select(*docs.columns, own), named.select(*docs.columns, "row_id"),
            lost.where(~worded).select(*docs.columns, own)]
    return cut_lineage(reduce(DataFrame.unionByName, kept), "row_ids")


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Repeated rows of one id count once; other texts of a repeated id and rows without an id take
    part as documents of their own, behind all that have an id (``with_row_ids``).
    """
    rows = with_row_ids(docs)
    found = near_duplicates(rows.select("row_id", "text"), "row_id")
    gone = cut_lineage(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")), "near_copies")
    return join_small(rows, gone, F.col("row_id") == F.col("gone"), "left_anti", 16).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return mark_contamination(docs, benchmark).where(F.size("hit_spans") == 0).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_pieces, piece_ids`` and the digest of what the ids decode to."""
    import public_tokenizers
    done = encode_pieces(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return done.select("doc_id", "lang", "source", F.size("piece_ids").cast("bigint").alias("n_pieces"), "piece_ids",
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("ngram_join", ngram_join),
          ("decontaminate", decontaminate), ("sentencepiece", sentencepiece)]
ORACLE_SQL = None   # SQL cannot decode the chain model or the pieces; tests/llm has the brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
