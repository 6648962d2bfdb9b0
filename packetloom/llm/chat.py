"""Chat formatting: typed content parts, a template that can be read back, and a loss mask.

Built-in functions only.  A message is an array of parts; a visitor turns each into text: text
parts as they are, with control strings escaped, the other kinds as ordered placeholders whose
references and expanded token counts are recorded beside the text.

A turn reads ``<s>role\\nbody</s>``; the body of all but assistants stands in ``[INST] .. [/INST]``.
A control string inside a text gets one more backslash after its first character, so ``</s>`` is
written ``<\\/s>`` and ``<\\/s>`` is written ``<\\\\/s>``: no raw control string is left, and taking
one backslash away restores the text.  Roles are percent-encoded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
KINDS = ("image", "audio", "document")
PATCH = 14            # pixels along a side of an image patch
AUDIO_TOKENS = 25     # per second, begun seconds count in part
PAGE_TOKENS = 512
TAG = r"/?s>|(?:image|audio|document):[0-9]+>"
WORD = r"/?INST\]"


def escape(text: Column) -> Column:
    once = F.regexp_replace(text, rf"<(\\*)({TAG})", r"<\\$1$2")
    return F.regexp_replace(once, rf"\[(\\*)({WORD})", r"[\\$1$2")


def unescape(text: Column) -> Column:
    once = F.regexp_replace(text, rf"<\\(\\*)({TAG})", r"<$1$2")
    return F.regexp_replace(once, rf"\[\\(\\*)({WORD})", r"[$1$2")


def text_parts(text: Column) -> Column:
    """A plain text as an array of one part (null: empty)."""
    empty = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            *[F.lit(None).cast(t).alias(n) for n, t in empty.items()]))


def expanded_tokens(part: Column) -> Column:
    """Tokens a placeholder stands for: image patches, audio steps, document pages."""
    def tiles(side: str) -> Column:
        return F.ceil(F.greatest(F.coalesce(part[side], F.lit(0)), F.lit(0)) / F.lit(PATCH))
    return (F.when(part["kind"] == "image", tiles("width") * tiles("height"))
            .when(part["kind"] == "audio", F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(0.0)), F.lit(0.0))
                                                  * F.lit(AUDIO_TOKENS)))
            .when(part["kind"] == "document", F.greatest(F.coalesce(part["pages"], F.lit(0)), F.lit(0)) * F.lit(PAGE_TOKENS))
            .otherwise(F.lit(0)).cast("bigint"))


def visit(parts: Column) -> tuple[Column, Column]:
    """``(text, attachments)`` of a message; a null array is an empty one, a null part is skipped,
    an unknown kind counts as text, text parts side by side as one text.  Attachments are numbered within the message."""
    known = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    attached = F.filter(known, lambda p: p["kind"].isin(*KINDS))
    # ordinals by position among the attachments: text parts carry the number of none
    numbered = F.transform(attached, lambda p, i: F.struct(
        (i + 1).alias("ordinal"), p["kind"].alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")))
    # a run of text parts is escaped as one text: a control string may lie across two of them
    start = F.struct(F.lit("").alias("text"), F.lit("").alias("run"), F.lit(0).alias("seen"))
    flat = F.aggregate(known, start, lambda acc, p: F.when(
        p["kind"].isin(*KINDS),
        F.struct(F.concat(acc["text"], escape(acc["run"]), F.lit("<"), p["kind"], F.lit(":"), (acc["seen"] + 1).cast("string"), F.lit(">")).alias("text"),
                 F.lit("").alias("run"), (acc["seen"] + 1).alias("seen"))).otherwise(
        F.struct(acc["text"].alias("text"), F.concat(acc["run"], F.coalesce(p["text"], F.lit(""))).alias("run"), acc["seen"].alias("seen"))),
        lambda acc: F.concat(acc["text"], escape(acc["run"])))
    single = (F.size(known) == 1) & ~F.get(known, F.lit(0))["kind"].isin(*KINDS)
    return F.when(single, escape(F.coalesce(F.get(known, F.lit(0))["text"], F.lit("")))).otherwise(flat), numbered


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", parts: str | None = None) -> DataFrame:
    """One row per conversation: ``formatted``, ``loss_spans`` (start, length in code points of the
    assistant bodies), ``attachments`` (turn number first), ``expanded_tokens``.

    Turns go by ``turn``, then role, then text; a null turn comes first, repeated rows are kept, a
    null role is the empty role, a null text the empty text, null ids form one conversation.
    Columns other than those named are ignored.  An empty table gives no rows.  One conversation is
    one string, so its turns meet in one row; nothing else does.
    """
    body, attached = visit(F.col(parts) if parts else text_parts(F.col(text)))
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"), body.alias("body"), attached.alias("attached"))
    learned = F.col("role") == "assistant"
    opened = F.concat(F.lit("<s>"), F.url_encode("role"), F.lit("\n"), F.when(learned, F.lit("")).otherwise(F.lit("[INST] ")))
    piece = F.concat(opened, F.col("body"), F.when(learned, F.lit("</s>")).otherwise(F.lit(" [/INST]</s>")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    placed = (rows.withColumn("piece", piece).withColumn("opened", F.char_length(opened))
              .withColumn("at", F.row_number().over(order))
              .withColumn("before", F.coalesce(F.sum(F.char_length("piece")).over(
                  order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    span = F.when(F.col("role") == "assistant", F.struct(
        "at", (F.col("before") + F.col("opened")).alias("start"), F.char_length("body").cast("bigint").alias("length")))
    grouped = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(span)).alias("spans"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "attached"))), lambda x: F.transform(
            x["attached"], lambda a: F.struct(x["at"].alias("turn"), a["ordinal"].alias("ordinal"), a["kind"].alias("kind"),
                                              a["ref"].alias("ref"), a["tokens"].alias("tokens"))))).alias("attachments"))
    return grouped.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))).alias("loss_spans"),
        "attachments", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped; placeholders stay."""
    pieces = F.filter(F.split(formatted, "<s>"), lambda p, i: i > 0)

    def turn(piece: Column) -> Column:
        role = F.url_decode(F.substring_index(piece, "\n", 1))
        rest = F.substr(piece, F.instr(piece, "\n") + 1, F.char_length(piece))
        shut = F.left(rest, F.char_length(rest) - F.lit(4))
        bare = F.substr(shut, F.lit(8), F.char_length(shut) - F.lit(15))
        return F.struct(role.alias("role"), unescape(F.when(role == "assistant", shut).otherwise(bare)).alias("text"))
    return F.transform(pieces, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(
        formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def op1_chat_formatting(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn int, role string, text string")
    done = format_conversations(turns.unionByName(extra))
    back = done.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                       read_loss(F.col("formatted"), F.col("loss_spans")).alias("learned"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


_ESCAPED = (r"regexp_replace(regexp_replace(text, '<(\\*)(" + TAG + r")', '<\\\1\2', 'g'), "
            r"'\[(\\*)(" + WORD + r")', '[\\\1\2', 'g')")
SQL = {"op1_chat_formatting": rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
framed AS (
  SELECT *, '<s>' || role || chr(10) || CASE WHEN role = 'assistant' THEN '' ELSE '[INST] ' END || {_ESCAPED}
    || CASE WHEN role = 'assistant' THEN '</s>' ELSE ' [/INST]</s>' END AS piece FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(piece))::BIGINT AS formatted_chars
FROM framed GROUP BY conv_id"""}
QUERIES = {"op1_chat_formatting": op1_chat_formatting}
