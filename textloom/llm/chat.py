"""Chat formatting with Spark expressions only: collected turns, sorted, merged by role, concatenated.

A conversation becomes one string of blocks, one per run of adjacent turns of the same role:

    <|start|>role<|text|>first turn<|turn|>second turn<|end|>

Every control string inside a role or a text (those of this template and of other common ones) gets a backslash
after its first character, and one more if it has some already, so the string can be read back exactly.

Defined results.  A null role or text is empty.  Turns are ordered by turn, then role, then text (null turn
first); repeated rows stay repeated turns.  A null conversation id is one conversation.  An empty table gives no
rows.  Other columns are ignored.  The output of one conversation is one row, so its size is bounded by a row's;
the work on long texts (escaping) happens before rows meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, TEXT, TURN, END = "<|start|>", "<|text|>", "<|turn|>", "<|end|>"
CONTROL_STRINGS = (START, TEXT, TURN, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "<SYS>",
                   "</SYS>", "[INST]", "[/INST]")
# What follows the first character, as a pattern that Java and RE2 read alike.
_REST = "|".join(s[1:].replace("|", "\\|").replace("]", "\\]") for s in CONTROL_STRINGS)
ESCAPE_PATTERN = rf"([<\[])(\\*)({_REST})"
UNESCAPE_PATTERN = rf"([<\[])(\\*)\\({_REST})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE_PATTERN, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE_PATTERN, "$1$2$3")


def format_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv``, ``n_turns``, ``formatted``, ``loss_spans``.

    ``loss_spans`` are (start, length) in UTF-8 bytes of ``formatted``: the texts of ``loss_role``, one span each,
    without headers and separators.
    """
    role_col, text_col = (escape(F.coalesce(F.col(f"`{c}`"), F.lit(""))) for c in (role, text))
    turns = df.groupBy(F.col(f"`{conv}`").alias(conv)).agg(
        F.array_sort(F.collect_list(F.struct(F.col(f"`{turn}`").alias("turn"), role_col.alias("role"),
                                             text_col.alias("text")))).alias("turns"))
    turns = turns.withColumn("n_turns", F.size("turns").cast("long"))
    starts = turns.withColumn("starts", F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"])))
    merged = starts.withColumn("blocks", F.transform("starts", lambda s, k: F.struct(
        F.col("turns")[s]["role"].alias("role"),
        F.transform(F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - s),
                    lambda t: t["text"]).alias("texts"))))
    # Byte lengths walk through the blocks once: a block of the loss role leaves a span per text.
    one = F.lit(len(TURN))
    inner = lambda at, texts: F.aggregate(
        texts, F.struct(at.alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, t: F.struct((acc["at"] + F.octet_length(t) + one).alias("at"),
                                F.concat(acc["spans"], F.array(F.struct(
                                    acc["at"].alias("start"), F.octet_length(t).alias("length")))).alias("spans")))
    head = len(START) + len(TEXT)
    size = lambda b: F.octet_length(F.array_join(b["texts"], TURN))
    spans = F.aggregate(
        "blocks", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, b: F.struct(
            (acc["at"] + head + F.octet_length(b["role"]) + size(b) + len(END)).alias("at"),
            F.when(b["role"] == escape(F.lit(loss_role)),
                   F.concat(acc["spans"], inner(acc["at"] + head + F.octet_length(b["role"]), b["texts"])["spans"]))
            .otherwise(acc["spans"]).alias("spans")))
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(
        F.lit(START), b["role"], F.lit(TEXT), F.array_join(b["texts"], TURN), F.lit(END))), "")
    return merged.select(F.col(f"`{conv}`"), "n_turns", formatted.alias("formatted"),
                         spans["spans"].alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) structs of a formatted conversation, in order."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>"), lambda b: b != "")
    parts = F.transform(blocks, lambda b: F.split(F.substring(b, len(START) + 1, 2**31 - 1), r"<\|text\|>"))
    return F.flatten(F.transform(parts, lambda p: F.transform(
        F.split(p[1], r"<\|turn\|>"), lambda t: F.struct(unescape(p[0]).alias("role"), unescape(t).alias("text")))))


def read_digest(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Digests of what the formatted strings and their loss spans say."""
    back = chats.select(
        F.col(f"`{conv}`"), read_turns(F.col("formatted")).alias("turns"), "formatted", "loss_spans",
        F.col("formatted").cast("binary").alias("bytes"))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("bytes"), s["start"] + 1, s["length"]).cast("string"))), "")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    out = back.select(F.col(f"`{conv}`"), F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(told, 256).alias("turns_sha256"), loss.alias("loss"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"),
                      F.octet_length("bytes").cast("long").alias("formatted_bytes"))
    return out.select(F.col(f"`{conv}`"), "n_turns", "turns_sha256",
                      F.char_length("loss").cast("long").alias("loss_chars"),
                      F.sha2(F.col("loss"), 256).alias("loss_sha256"), "formatted_chars", "formatted_bytes")
