"""Chat formatting by prefix-target expansion, and reading the formatted text back.

Every assistant turn becomes an example of its own: all turns before it are context, only its
reply is trainable. Turns are marked by control strings; control strings inside a text are
escaped by one reversible rule, so a text can never end or open a turn. Everything here is made
of built-in functions; the only shuffle gathers the turns of a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: the template. A turn is <|turn|>role<|text|>text<|end|>; the last turn of a
# conversation without a reply is followed by nothing else. Inside a role or text, "\" is written
# "\\" and "<|" is written "<\|".
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Undo ``escape``: a run of backslashes is either of pairs, each one backslash of the text, or the
    single one between "<" and "|", so cutting at pairs leaves only single ones."""
    parts = F.split(text, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("<\\|"), F.lit("<|"))), "\\")


def gather_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id`` and its turns ``(turn, role, text)`` in order."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return (
        turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    )


def expand(turns: DataFrame) -> DataFrame:
    """One row per example of each conversation in ``(conv_id, turn, role, text)``.

    Returns ``conv_id``, ``example`` (from 0), ``formatted``, and the loss mask as ``loss_start``
    and ``loss_end``: code-point offsets of the trainable reply in ``formatted``, its end mark left
    out, and ``last``, true for the longest example. Where a conversation does not end with a reply, a last example without a trainable part
    (``loss_start = loss_end``) holds all turns, so that the output loses nothing.

    Rows are ordered by turn, then role and text; a null turn comes first. Null roles and texts are
    empty, a null ``conv_id`` is one conversation, repeated rows are repeated turns, an empty table
    gives no rows, other columns are ignored. An example is as long as its prefix: the output of
    one conversation grows with the square of its turns, as the format demands; each example is a
    row of its own, so no task holds more than one of them at a time besides the conversation.
    """
    marked = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT), escape(t["text"]), F.lit(END))
    n = F.size("turns")
    last = F.col("turns")[n - 1]["role"]
    targets = F.filter(F.sequence(F.lit(1), n), lambda i: F.col("turns")[i - 1]["role"] == "assistant")
    whole = F.when(last != "assistant", F.array(n)).otherwise(F.array().cast("array<int>"))
    pieces = gather_turns(turns).select(
        "conv_id", "turns", F.transform("turns", marked).alias("pieces"), F.concat(targets, whole).alias("stops")
    )
    n_stops = F.size("stops")
    each = pieces.select("conv_id", "turns", "pieces", n_stops.alias("n"), F.posexplode("stops").alias("example", "stop"))
    context = F.array_join(F.slice("pieces", 1, F.col("stop") - 1), "")
    piece = F.col("pieces")[F.col("stop") - 1]
    target = F.col("turns")[F.col("stop") - 1]
    each = each.select(
        "conv_id",
        "example",
        context.alias("context"),
        piece.alias("piece"),
        (target["role"] == "assistant").alias("trainable"),
        F.length(escape(target["role"])).alias("role_chars"),
        (F.col("example") == F.col("n") - 1).alias("last"),
    )
    end = F.length("context") + F.length("piece") - len(END)
    start = F.length("context") + F.col("role_chars") + len(TURN) + len(TEXT)
    return each.select(
        "conv_id",
        "example",
        F.concat("context", "piece").alias("formatted"),
        F.when(F.col("trainable"), start).otherwise(end).alias("loss_start"),
        end.alias("loss_end"),
        "last",
    )


def parse(formatted: Column) -> Column:
    """The turns ``(role, text)`` that a formatted text holds."""
    marked = F.filter(F.split(formatted, r"<\|turn\|>", -1), lambda p: p != "")

    def turn(piece: Column) -> Column:
        halves = F.split(F.substring(piece, F.lit(1), F.length(piece) - len(END)), r"<\|text\|>", 2)
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    return F.transform(marked, turn)


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples alone.

    ``turns_sha256`` covers role and text of every turn of the longest example, each followed by a
    line feed; ``loss_sha256`` and ``loss_chars`` cover the unescaped text under the loss masks of
    all examples in order.
    """
    loss = unescape(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    read = examples.select(
        "conv_id",
        "example",
        loss.alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("last"), F.col("formatted")).alias("whole"),
    )
    gathered = read.groupBy("conv_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), ""
        ).alias("loss"),
        F.sum("chars").alias("formatted_chars"),
        F.max("whole").alias("whole"),
    ).withColumn("turns", parse(F.col("whole")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return gathered.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )

