"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A turn is written ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``. Inside roles and texts a backslash is doubled and ``<|`` becomes
``<\\|`` (in roles also a line feed gets a backslash), so that no text can hold a control string and removing the
backslashes gives it back. Every assistant turn makes an example: all turns before it as context, and its text alone
under the loss mask. Turns after the last assistant turn (or a conversation without one) make a last example without
a target, so that examples hold every turn.

Cases: null roles and texts are empty; turns go by number, ties by role and text, a missing number first; repeated
rows are turns of their own; a null ``conv_id`` is one conversation; an empty table has no examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, TARGET = "<|im_start|>", "<|im_end|>\n", "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)\\\\(.)", "$1")


def examples(turns: DataFrame) -> DataFrame:
    """``conv_id, example, last, text, loss_start, loss_chars`` from ``conv_id, turn, role, text`` (others are ignored).

    ``text`` is the formatted example; the mask covers ``loss_chars`` code points from ``loss_start`` on (counted from 1).
    One shuffle by conversation; an example is a prefix of its conversation's formatted text, cut when it is read.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    head = F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), head.alias("head"), escape(text).alias("body"))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    length = F.char_length("head") + F.char_length("body") + len(END)
    rows = rows.select(
        "conv_id", F.row_number().over(in_order).alias("n"), (F.col("role") == TARGET).alias("target"), F.concat("head", "body", F.lit(END)).alias("piece"),
        F.sum(length.cast("long")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("end"), F.char_length("body").alias("chars"),
    )
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "target", "end", "chars", "piece"))).alias("turns"))
    convs = convs.select("conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("full"), F.size("turns").alias("size"), F.transform("turns", lambda t: t.dropFields("piece")).alias("turns"))
    ends = F.filter("turns", lambda t: t["target"] | (t["n"] == F.col("size")))
    each = convs.select("conv_id", "full", "size", F.posexplode(ends).alias("example", "t"))
    return each.select(
        "conv_id", "example", (F.col("t.n") == F.col("size")).alias("last"), F.substring("full", F.lit(1), F.col("t.end").cast("int")).alias("text"),
        F.when(F.col("t.target"), F.col("t.end").cast("int") - len(END) - F.col("t.chars") + 1).alias("loss_start"), F.when(F.col("t.target"), F.col("t.chars")).otherwise(0).alias("loss_chars"),
    )


def parsed(text: Column) -> Column:
    """The turns in a formatted text: an array of ``role, text``."""
    parts = F.split(text, "<\\|im_end\\|>\n", -1)
    parts = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    cut = "(?s)^<\\|im_start\\|>((?:[^\\\\\n]|\\\\.)*+)\n(.*)$"
    return F.transform(parts, lambda p: F.struct(unescape(F.regexp_extract(p, cut, 1)).alias("role"), unescape(F.regexp_extract(p, cut, 2)).alias("text")))


def digest(formatted: DataFrame) -> DataFrame:
    """What reading back the examples gives for each conversation: ``conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars``."""
    loss = F.when(F.col("loss_start").isNotNull(), unescape(F.substring("text", F.col("loss_start"), F.col("loss_chars"))))
    rows = formatted.select("conv_id", "example", F.char_length("text").cast("long").alias("chars"), loss.alias("loss"), F.when(F.col("last"), F.col("text")).alias("whole"))
    each = rows.groupBy("conv_id").agg(F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"), F.max("whole").alias("whole"))
    each = each.select("conv_id", "formatted_chars", F.array_join(F.transform("losses", lambda x: F.coalesce(x["loss"], F.lit(""))), "").alias("loss"), parsed(F.col("whole")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return each.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
