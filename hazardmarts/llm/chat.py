"""Chat formatting by prefix-target expansion, in DataFrame expressions only.

``format_conversations`` renders each conversation once: every turn becomes
``<s>role<t>text</s>``, with role and text escaped so that no control string can come from data.
``expand`` then makes one example of every assistant turn: its context is everything before the reply
and only the reply is trainable. Contexts are prefixes of the rendered conversation, so an example
holds spans into it, plus its target; ``render`` turns spans into full texts. A conversation of m turns so
takes space in proportion to its length, not to its square.

Escaping puts a backslash after every ``<`` and ``[`` and doubles backslashes. No control string
(``<s>``, ``</s>``, ``<t>``, ``[INST]``, ``[/INST]``) survives it, and ``unescape`` reverses it exactly.

Null texts and roles count as empty. Rows are ordered by turn, then role, then text; null turns come
first, and repeated rows stay as turns of their own. Rows with a null conversation id form one conversation
with a null id. A conversation without an assistant turn is rendered and has no examples. Texts of any
length are kept whole. Only the four named columns are read, so further columns cannot clash. An empty
table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings.
OPEN, HEAD_END, CLOSE = "<s>", "<t>", "</s>"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescape(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("<\\"), F.lit("<")), F.lit("[\\"), F.lit("["))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def format_conversations(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: conv_id, ``formatted``, and ``replies``, the spans of assistant texts.

    Spans count characters from 0: ``start`` is the first of the escaped reply and ``end`` the one after it.
    """
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), clean(role).alias("role"), clean(text).alias("text")).alias("t"),
    )
    packed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    parts = F.transform(
        "t",
        lambda t: F.struct(
            (t["role"] == "assistant").alias("reply"),
            F.concat(F.lit(OPEN), escape(t["role"]), F.lit(HEAD_END)).alias("head"),
            escape(t["text"]).alias("body"),
        ),
    )
    staged = packed.select("conv_id", parts.alias("parts"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, part: Column) -> Column:
        begin = acc["at"] + F.length(part["head"])
        end = begin + F.length(part["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(part["reply"], F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((end + len(CLOSE)).alias("at"), spans.alias("spans"))

    return staged.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.aggregate("parts", start, step, lambda a: a["spans"]).alias("replies"),
    )


def expand(conversations: DataFrame) -> DataFrame:
    """One example per assistant turn: conv_id, example (from 0), ``context_end``, ``loss_start``,
    ``loss_end`` and ``target``, the trainable characters."""
    spans = conversations.select("conv_id", "formatted", F.posexplode("replies").alias("example", "span"))
    return spans.select(
        "conv_id", "example",
        F.col("span.start").alias("context_end"),
        F.col("span.start").alias("loss_start"),
        F.col("span.end").alias("loss_end"),
        F.substr("formatted", F.col("span.start") + 1, F.col("span.end") - F.col("span.start")).alias("target"),
    )


def render(examples: DataFrame, conversations: DataFrame) -> DataFrame:
    """Examples with their whole ``context`` as text. This is as large as all prefixes together."""
    whole = conversations.select(F.col("conv_id").alias("c_id"), "formatted")
    joined = examples.join(whole, F.col("conv_id").eqNullSafe(F.col("c_id")))
    return joined.select(*examples.columns, F.substr("formatted", F.lit(1), F.col("context_end")).alias("context"))


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation as an array of (role, text), unescaped."""
    closed = F.filter(F.split(formatted, CLOSE), lambda s: s != "")
    return F.transform(
        closed,
        lambda s: F.struct(
            unescape(F.substring_index(F.substr(s, F.lit(len(OPEN) + 1)), HEAD_END, 1)).alias("role"),
            unescape(F.substring_index(s, HEAD_END, -1)).alias("text"),
        ),
    )


def digests(conversations: DataFrame, examples: DataFrame) -> DataFrame:
    """What a reader of the output finds per conversation: turns, trainable characters and their hashes."""
    turns = parse(F.col("formatted"))
    read = conversations.select("conv_id", turns.alias("turns"), F.length("formatted").cast("bigint").alias("formatted_chars"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    replies = examples.groupBy(F.col("conv_id").alias("c_id")).agg(
        F.sort_array(F.collect_list(F.struct("example", unescape(F.col("target")).alias("text")))).alias("r")
    )
    trained = F.coalesce(F.array_join(F.transform("r", lambda x: x["text"]), ""), F.lit(""))
    joined = read.join(replies, F.col("conv_id").eqNullSafe(F.col("c_id")), "left")
    return joined.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(trained).cast("bigint").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        "formatted_chars",
    )
