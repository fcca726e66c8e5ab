"""Chat formatting from an event log.

A conversation is a log of events ordered by ``seq``: a message starts with a
role, grows by deltas, may be replaced by an edit, or is dropped and streamed
anew after a regeneration.  Folding the log gives the final messages, which
are rendered with turn marks and a mask of the text to learn from.

The fold is an aggregate per message: the last edit or regeneration of a
message is found first, and only what comes after it is joined, in sequence.
Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Marks of the template.  A text never contains "<|" after escaping, so a mark is always a mark.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
#: Code points of one streamed delta when events are made from whole texts.
DELTA_CHARS = 512


def escape(c: Column) -> Column:
    r"""Reversible: ``\`` becomes ``\\``, then ``<|`` becomes ``<\|``."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(c: Column) -> Column:
    r"""As ``escape``, and a line feed becomes ``<\N>``, so a role is one line."""
    return F.replace(escape(c), F.lit("\n"), F.lit("<\\N>"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("<\\N>"), F.lit("\n")))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def message_events(messages: DataFrame) -> DataFrame:
    """conv_id, seq, message, kind, role, text: the log in which each row
    (conv_id, turn, role, text) was started and then streamed in deltas.

    Rows of a conversation are numbered by turn; equal turns by role, then
    text.  A null text streams nothing."""
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    deltas = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length(text) / DELTA_CHARS).cast("int") - 1, F.lit(0))),
                         lambda i: F.substring(text, i * DELTA_CHARS + 1, F.lit(DELTA_CHARS)))
    events = F.concat(F.array(F.struct(F.lit("start").alias("kind"), F.lit("").alias("text"))),
                      F.transform(deltas, lambda d: F.struct(F.lit("delta").alias("kind"), d.alias("text"))))
    numbered = messages.withColumn("message", number.cast("long"))
    return (numbered.select("conv_id", "message", "role", F.posexplode(events).alias("step", "event"))
            .select("conv_id", "message", (F.col("message") * (1 << 32) + F.col("step")).alias("seq"), "event.kind", "role", "event.text"))


def reconstruct(events: DataFrame) -> DataFrame:
    """conv_id, message, role, text: the final messages of every log.

    kind is start, delta, edit (its text replaces all before), or regenerate
    (all before is dropped); other kinds are ignored.  The role is that of the
    first event that has one; a null text adds nothing; events of equal seq
    count in the order of their text.  A message that only has a start is
    empty, not missing."""
    known = events.where(F.col("kind").isin("start", "delta", "edit", "regenerate"))
    by = Window.partitionBy("conv_id", "message")
    reset = F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq"))).over(by)
    piece = F.when(F.col("kind").isin("delta", "edit") & (F.coalesce("seq", F.lit(0)) >= F.coalesce("reset", F.col("seq"), F.lit(0))),
                   F.struct("seq", "text"))
    return (known.withColumn("reset", reset).groupBy("conv_id", "message")
            .agg(F.min(F.when(F.col("role").isNotNull(), F.struct("seq", "role")))["role"].alias("role"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["text"]), "").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, n_turns, formatted, loss (array of start and length, in code
    points of ``formatted``, of every assistant text as escaped there).

    Messages follow one another by number.  A null role is an empty one."""
    ordered = F.array_sort(F.collect_list(F.struct("message", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))
    head = lambda m: F.concat(F.lit(TURN_START), escape_role(m["role"]), F.lit("\n"))
    turns = F.transform(ordered, lambda m: F.struct(
        (m["role"] == LOSS_ROLE).alias("learn"), head(m).alias("head"), escape(m["text"]).alias("body")))
    grouped = messages.groupBy("conv_id").agg(turns.alias("turns"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(TURN_END))), "")
    start = F.lit(0).cast("long")
    spans = F.aggregate("turns", F.struct(start.alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")), lambda a, t: F.struct(
        (a["at"] + F.length(t["head"]) + F.length(t["body"]) + len(TURN_END)).cast("long").alias("at"),
        F.when(t["learn"], F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(t["head"])).cast("long").alias("start"), F.length(t["body"]).cast("long").alias("length")))))
        .otherwise(a["spans"]).alias("spans")))["spans"]
    return grouped.select("conv_id", F.size("turns").cast("long").alias("n_turns"), whole.alias("formatted"), spans.alias("loss"))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    ends = F.split(formatted, "\\Q" + TURN_END + "\\E", -1)
    turns = F.slice(ends, F.lit(1), F.greatest(F.size(ends) - 1, F.lit(0)))
    body = lambda t: F.substring(t, F.lit(len(TURN_START) + 1), F.length(t))
    return F.transform(turns, lambda t: F.struct(
        unescape_role(F.substring_index(body(t), "\n", 1)).alias("role"),
        unescape(F.substring(body(t), F.length(F.substring_index(body(t), "\n", 1)) + 2, F.length(t))).alias("text")))


def chat_digest(rendered: DataFrame) -> DataFrame:
    """What is read back from the formatted conversations: hashes of their turns and of the text under the loss mask."""
    turns = F.array_join(F.transform(parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss", lambda s: unescape(F.substring(
        F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return (rendered.withColumn("learned", learned)
            .select("conv_id", F.size(parse(F.col("formatted"))).cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                    F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


def format_conversations(messages: DataFrame) -> DataFrame:
    """Formatted conversations (see ``render``) of a table of messages
    (conv_id, turn, role, text), by way of their event log.

    Null texts are empty, null roles too; a null conv_id is a conversation of
    its own; rows that repeat are turns of their own.  Extra columns are
    ignored; an empty table gives an empty result.  A conversation is one row
    of the result, so its text has to fit in one."""
    rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return render(reconstruct(message_events(rows)))
