"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the
context, its reply alone is trainable.  Contexts of one conversation are
prefixes of one formatted text, so that text is stored once and an example is a
row of offsets into it; ``expand`` gives whole examples.  Copying each prefix
would cost the square of a conversation's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OPEN, MID, CLOSE = "<|", "|>\n", "</s>\n"
#: Every control string begins with one of these; the first marks escapes.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"), ("|", "\\p"))


def escape(col: Column) -> Column:
    """No control string is left: backslash, <, [ and | become two-character codes."""
    for plain, code in ESCAPES:
        col = F.replace(col, F.lit(plain), F.lit(code))
    return col


def unescape(col: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        col = F.replace(col, F.lit(code), F.lit(plain))
    return col


def format_chats(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts, examples) of rows ``conv_id, turn, role, text``.

    texts: conv_id, formatted.  examples: conv_id, example (the reply's number
    among the turns, from 1), context_chars (all before the reply's turn),
    loss_start, loss_chars (the trainable stretch, in characters from 0), end.

    Turns stand in the order of (turn, role, text), nulls first; repeated rows
    stay; a null role or text is empty; rows without conv_id are one
    conversation of their own.  A conversation without an assistant has a text
    and no example.  Extra columns are left out.
    """
    t = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                             F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MID))
    t = t.select("conv_id", "turn", "role", "text", F.length(head).alias("head_chars"),
                 F.concat(head, escape(F.col("text")), F.lit(CLOSE)).alias("segment"))
    w = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    t = t.select("conv_id", "role", "head_chars", "segment", F.row_number().over(w).alias("pos"),
                 F.sum(F.length("segment").cast("long")).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("end"))
    texts = t.groupBy("conv_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("pos", "segment"))), lambda x: x["segment"]), "").alias("formatted"))
    context = F.col("end") - F.length("segment")
    examples = t.where(F.col("role") == "assistant").select(
        "conv_id", F.col("pos").alias("example"), context.alias("context_chars"),
        (context + F.col("head_chars")).alias("loss_start"),
        (F.length("segment") - F.col("head_chars") - len(CLOSE)).cast("long").alias("loss_chars"), "end")
    return texts, examples


def expand(texts: DataFrame, examples: DataFrame) -> DataFrame:
    """Whole examples: conv_id, example, text, loss_start, loss_chars."""
    t = texts.select(F.col("conv_id").alias("__conv"), "formatted")
    return examples.join(t, examples["conv_id"].eqNullSafe(t["__conv"])).select(
        "conv_id", "example", F.expr("left(formatted, cast(end as int))").alias("text"), "loss_start", "loss_chars")


def read_back(texts: DataFrame, examples: DataFrame) -> DataFrame:
    """conv_id, turns (array of role and text), loss (array of trainable texts,
    in order) and formatted_chars, parsed from what ``format_chats`` wrote."""
    parts = F.split("formatted", CLOSE)
    turn = lambda s: F.struct(
        unescape(F.substring_index(F.substring(s, len(OPEN) + 1, 2**31 - 1), MID, 1)).alias("role"),
        unescape(F.substring_index(s, MID, -1)).alias("text"))
    masks = examples.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("example", "loss_start", "loss_chars"))).alias("masks")).select(F.col("conv_id").alias("__conv"), "masks")
    cut = lambda m: unescape(F.substring(F.col("formatted"), (m["loss_start"] + 1).cast("int"), m["loss_chars"].cast("int")))
    return texts.join(masks, texts["conv_id"].eqNullSafe(masks["__conv"]), "left").select(
        "conv_id", F.transform(F.slice(parts, 1, F.size(parts) - 1), turn).alias("turns"),
        F.coalesce(F.transform("masks", cut), F.array().cast("array<string>")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"))
