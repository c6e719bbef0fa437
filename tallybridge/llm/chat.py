"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own,
with all preceding turns as context and only that reply trainable. DataFrame operations only.

A turn is written ``<turn ROLE>``, a new line, TEXT, ``</turn>`` and a new line. Inside roles and texts the three
signs that markers are made of are escaped, so no text can open or close a turn, and all is
read back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, MIDDLE, CLOSE = "<turn ", ">\n", "</turn>\n"
# What a sign becomes. The first is replaced first and put back last: what follows a backslash in
# escaped text is always one of these letters, and no letter is the sign of another.
ESCAPES = {"\\": "\\s", "<": "\\l", ">": "\\g"}
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    for sign, mark in ESCAPES.items():
        text = F.replace(text, F.lit(sign), F.lit(mark))
    return text


def unescaped(text: Column) -> Column:
    for sign, mark in reversed(ESCAPES.items()):
        text = F.replace(text, F.lit(mark), F.lit(sign))
    return text


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, is_last, text, loss_start, loss_end): an example per assistant turn.

    ``text`` holds all turns up to the reply and the reply; code points from ``loss_start`` to before
    ``loss_end`` are the reply's own text, the only part to train on. Turns after the last reply, and those of a
    conversation without one, come as a last example with nothing under its mask, so no turn
    is lost. Turns follow ``turn``, nulls first; those of equal ``turn`` follow role and text,
    and repeated rows are repeated turns. A null role or text is empty. Rows without a ``conv_id`` are one
    conversation. An empty table gives no examples; extra columns are not read.

    The rows of a conversation meet in one task, since a training example holds them side by side: a
    conversation and each of its examples must fit a value (2 GB). Examples are unfolded and
    written one after the other, so what a task holds grows with the conversation, not with its square.
    """
    turns = conversations.select(
        "conv_id", F.col("turn").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    gathered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    written = gathered.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == ASSISTANT).alias("trained"),
        F.transform("turns", lambda t: F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(MIDDLE))).alias("heads"),
        F.transform("turns", lambda t: escaped(t["text"])).alias("bodies"),
    ).withColumn("pieces", F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b, F.lit(CLOSE))))
    size = F.size("pieces")
    numbers = F.sequence(F.lit(1), size)
    ends = F.filter(numbers, lambda k: F.get("trained", k - 1) | (k == size))
    unfolded = written.select("*", F.posexplode(ends).alias("example", "end"))
    reply = F.when(F.get("trained", F.col("end") - 1), F.length(F.get("bodies", F.col("end") - 1)))
    unfolded = unfolded.select(
        "conv_id",
        (F.col("example") + 1).alias("example"),
        (F.col("end") == size).alias("is_last"),
        F.array_join(F.slice("pieces", F.lit(1), F.col("end")), "").alias("text"),
        reply.alias("reply"),
    )
    close = F.when(F.col("reply").isNull(), F.lit(0)).otherwise(F.lit(len(CLOSE)))
    stop = (F.length("text") - close).cast("long")
    return unfolded.select(
        "conv_id", "example", "is_last", "text",
        (stop - F.coalesce("reply", F.lit(0))).alias("loss_start"), stop.alias("loss_end"),
    )


def turns_of(text: Column) -> Column:
    """The turns (role, text) of an example, as they were before they were written."""
    pieces = F.split(text, CLOSE, -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescaped(F.substring(F.substring_index(p, MIDDLE, 1), F.lit(len(OPEN) + 1), F.length(p))).alias("role"),
            unescaped(F.substring_index(p, MIDDLE, -1)).alias("text"),
        ),
    )


def trained_text(text: Column, loss_start: Column, loss_end: Column) -> Column:
    """What is under the loss mask of an example, as it was before it was written."""
    return unescaped(F.substring(text, (loss_start + 1).cast("int"), (loss_end - loss_start).cast("int")))


def read_back(found: DataFrame) -> DataFrame:
    """Per conversation what its examples say: turns, trained text and characters.

    The last example holds every turn. Each example is read where it is; only its reply and, of the
    last one, a digest are brought together by conversation.
    """
    said = F.array_join(F.transform(turns_of(F.col("text")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = found.select(
        "conv_id",
        "example",
        F.when(F.col("is_last"), F.size(turns_of(F.col("text")))).alias("n_turns"),
        F.when(F.col("is_last"), F.sha2(said.cast("binary"), 256)).alias("turns_sha256"),
        trained_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("trained"),
        F.length("text").cast("long").alias("chars"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.max("n_turns").cast("long").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.array_sort(F.collect_list(F.struct("example", "trained"))).alias("replies"),
        F.sum("chars").alias("formatted_chars"),
    )
    trained = F.array_join(F.transform("replies", lambda r: r["trained"]), "")
    return whole.select(
        "conv_id", "n_turns", "turns_sha256", F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained.cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
