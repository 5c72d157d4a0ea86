"""Conversations as training text, with Spark expressions only.

The turns of a conversation are collected as structs, sorted, cut into blocks of
adjacent turns of one role and joined. Control strings open with ``<|``:

    <|turn|>role<|says|>text<|next|>text<|end|>

``<|next|>`` parts the texts of merged turns, so every turn can be read back. Inside
roles and texts a ``<`` before ``|`` or a backslash gets a backslash behind it, so no
text can hold a control string, and taking it away again gives the text back exactly.
The loss mask lists, as runs of code points of the formatted text, what the assistant
says: its texts, each once, without the control strings between.

Formatting and reading back are linear in a conversation's length; a conversation is one
row of text in the end, so its turns meet in one row. The masked text is cut out of pieces
of ``PIECE`` code points, so no turn makes Spark count from the start of the text.

Defined cases: a null text is empty, a null role an empty role; rows with a null turn
come first; rows of equal turn are ordered by role and text, and repeated rows all
count; a null conversation id is a conversation; an empty table gives no rows; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
TURN, SAYS, NEXT, END = "<|turn|>", "<|says|>", "<|next|>", "<|end|>"

# Code points of the pieces a text is cut out of.
PIECE = 4096


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<([|\\])", r"<\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\([|\\])", r"<$1")


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def format_conversations(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, ``formatted`` and ``runs``: lengths of its stretches in and out of the loss."""
    clean = rows.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        escape(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("text"))
    turns = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    starts = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == 0) | (
        F.get("turns", i)["role"] != F.get("turns", F.greatest(i - 1, F.lit(0)))["role"]))
    turns = turns.withColumn("starts", F.concat(starts, F.array(F.size("turns"))))
    merged = F.transform(F.sequence(F.lit(0), F.size("starts") - 2), lambda b: F.slice(
        "turns", F.get("starts", b) + 1, F.get("starts", b + 1) - F.get("starts", b)))
    blocks = turns.select("conv_id", F.transform(merged, lambda turns: F.struct(
        F.get(turns, F.lit(0))["role"].alias("role"), F.transform(turns, lambda t: t["text"]).alias("texts"))).alias("blocks"))

    # Stretches of one block: its head, then texts and what parts them in turn.
    def stretches(block: Column) -> Column:
        head = F.concat(F.lit(TURN), escape(block["role"]), F.lit(SAYS))
        spoken = block["role"] == ASSISTANT
        return F.flatten(F.transform(block["texts"], lambda text, i: F.array(
            F.struct(F.when(i == 0, head).otherwise(F.lit(NEXT)).alias("text"), F.lit(False).alias("loss")),
            F.struct(text.alias("text"), spoken.alias("loss")),
            F.struct(F.when(i == F.size(block["texts"]) - 1, F.lit(END)).otherwise(F.lit("")).alias("text"),
                     F.lit(False).alias("loss")))))

    parts = blocks.select("conv_id", F.flatten(F.transform("blocks", stretches)).alias("parts"))
    return parts.select(
        "conv_id", F.array_join(F.col("parts.text"), "").alias("formatted"),
        F.transform("parts", lambda p: F.struct(F.length(p["text"]).alias("chars"), p["loss"].alias("loss"))).alias("runs"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` (role, text), read from the text alone, and ``loss_text``,
    cut out of the text by the loss mask."""
    blocks = F.filter(F.split("formatted", r"<\|end\|>", -1), lambda b: b.startswith(TURN))

    def turns(block: Column) -> Column:
        role = unescape(F.substring_index(F.substr(block, F.lit(len(TURN) + 1)), SAYS, 1))
        body = F.get(F.split(block, r"<\|says\|>", 2), F.lit(1))
        return _once(role, lambda role: F.transform(
            F.split(body, r"<\|next\|>", -1), lambda text: F.struct(role.alias("role"), unescape(text).alias("text"))))

    # Where the stretches in the loss start, and how long they are.
    def placed(done: Column, run: Column) -> Column:
        place = F.struct(done["place"].alias("place"), run["chars"].alias("chars"))
        return F.struct(
            (done["place"] + run["chars"]).alias("place"),
            F.when(run["loss"], F.array_append(done["places"], place)).otherwise(done["places"]).alias("places"))

    start = F.struct(F.lit(0).alias("place"), F.array().cast("array<struct<place:int,chars:int>>").alias("places"))
    places = F.aggregate("runs", start, placed, lambda done: done["places"])

    def cut(pieces: Column, place: Column) -> Column:
        first = F.floor(place["place"] / PIECE).cast("int")
        last = F.floor((place["place"] + place["chars"] - 1) / PIECE).cast("int")
        held = F.array_join(F.slice(pieces, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
        return unescape(F.substr(held, place["place"] - first * PIECE + 1, place["chars"]))

    pieces = F.regexp_extract_all("formatted", F.lit("(?s).{1,%d}" % PIECE), F.lit(0))
    loss = _once(pieces, lambda pieces: F.array_join(F.transform(places, lambda place: cut(pieces, place)), ""))
    return formatted.withColumn("turns", F.flatten(F.transform(blocks, turns))).withColumn("loss_text", loss)
