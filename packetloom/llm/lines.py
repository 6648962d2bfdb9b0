"""Line dedup: lines that many documents share are dropped everywhere but in one document.

Built-in functions only: explode normalised lines, hash, count distinct documents per hash, drop,
and reassemble by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions.arrays import bind
from packetloom.llm.common import BROADCAST_BYTES, LOWER, SPACE, UPPER, folded, spare
from packetloom.session import cut_lineage


def line_key(line: Column) -> Column:
    """A line without outer white space, A-Z in lower case."""
    return folded(F.btrim(line, F.lit(SPACE.decode())))


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def drop_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                      min_docs: int = 3) -> DataFrame:
    """``docs`` with ``text`` rewritten and ``n_lines``, ``n_dropped`` added (or replaced).

    A key of at least ``min_chars`` code points in at least ``min_docs`` distinct ids loses its lines
    except in the largest id that holds it (all its lines there stay).  A null or empty text is one
    empty line and becomes ''.  Rows that repeat an id count once as a holder and are treated alike; a null id is a
    holder of its own and never the one that keeps.  An empty table stays empty; other columns pass through
    whatever their names.

    A line shared by a third of all documents meets a map-side count, then a join that AQE splits.
    Keys are MD5 sums.  What comes back to a document is its dropped positions.
    """
    own = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__own"),
                      F.posexplode(_split(F.col(text_col))).alias("__at", "__line"))
    keyed = own.withColumn("__key", line_key(F.col("__line"))).where(F.char_length("__key") >= min_chars).select(
        "__id", "__own", "__at", F.md5("__key").alias("__key"))
    shared = (keyed.select("__key", "__id").distinct().groupBy("__key")
              .agg(F.count(F.lit(1)).alias("__docs"), F.max("__id").alias("__keeper"))
              .where(F.col("__docs") >= min_docs).drop("__docs"))
    gone = (keyed.join(shared, "__key").where(~F.col("__id").eqNullSafe(F.col("__keeper")))
            .groupBy("__id", "__own").agg(F.collect_set("__at").alias("__gone")))
    of, of_own, places = spare(docs, "gone_id", "gone_own", "gone")
    gone = cut_lineage(gone.withColumnsRenamed({"__id": of, "__own": of_own, "__gone": places}), "dropped_lines")
    on = F.col(id_col).eqNullSafe(F.col(of)) & (F.xxhash64(text_col) == F.col(of_own))
    size = gone.agg(F.sum(F.size(places) * 4 + 64).alias("n")).first()["n"] or 0      # measured: a long text may lose many lines
    joined = docs.join(F.broadcast(gone) if size <= BROADCAST_BYTES else gone, on, "left")
    lines = _split(F.col(text_col))
    left = bind(F.struct(lines.alias("l"), F.col(places).alias("g")), lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x["l"]) - 1), x["g"]), lambda i: F.get(x["l"], i)), "\n"))
    count = F.size(lines).cast("bigint")
    kept = F.when(F.col(places).isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(left)
    return (joined.withColumn("n_lines", count)
            .withColumn("n_dropped", F.coalesce(F.size(places), F.lit(0)).cast("bigint"))
            .withColumn(text_col, kept).drop(of, of_own, places))


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_shared_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = {"op2_line_dedup": f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
rows AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k FROM rows),
shared AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT r.*, s.k IS NOT NULL AND r.doc_id <> s.keeper AS gone FROM keyed r LEFT JOIN shared s USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""}
QUERIES = {"op2_line_dedup": op2_line_dedup}
