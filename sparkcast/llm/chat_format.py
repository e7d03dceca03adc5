"""Chat formatting with relational operations and Spark expressions only.

A conversation's turns are collected as structs and sorted; runs of turns with one role are merged; messages are written as
`<|im_start|>role`, a line break, the texts with `<|im_sep|>` between merged ones, `<|im_end|>` and a line break. Control
strings inside texts and roles are escaped, so the output can be read back turn by turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.llm.sqltext import positions

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def _read_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def format_chats(turns: DataFrame) -> DataFrame:
    """Returns (conv_id, formatted, mask): `mask` has the spans (start, end) of `formatted` that count for the loss, in code
    points from 0.

    turns has conv_id, turn, role, text. Turns are ordered by turn, then role, then text, nulls first; repeated rows are turns
    of their own. A null text or role counts as empty, a null conv_id as a conversation of its own. The loss mask covers the
    texts of LOSS_ROLE, escaped as they are, and nothing else. Texts may be of any length. Extra columns are ignored; an empty
    table gives an empty result. Where a text starts comes from running sums over the turns, so the work is in proportion to a
    conversation's length.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    last = F.lag("role").over(w)
    head = F.length(_role(F.col("role"))) + len(START) + 1
    before = F.when(last.isNull(), head).when(last == F.col("role"), len(SEP)).otherwise(len(END) + head)
    rows = rows.withColumns({"before": before, "length": F.length(escape(F.col("text")))})
    rows = rows.withColumn("end", F.sum(F.col("before") + F.col("length")).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    turn = F.struct("turn", "role", "text", (F.col("end") - F.col("length")).alias("start"), "end")
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    first = F.filter(positions(F.size("turns")), lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]))
    chats = chats.withColumn("first", first)
    stop = lambda k: F.coalesce(F.get(F.col("first"), k + 1), F.size("turns"))
    messages = F.transform("first", lambda i, k: F.struct(F.get("turns", i)["role"].alias("role"), F.slice("turns", i + 1, stop(k) - i).alias("turns")))
    chats = chats.select("conv_id", messages.alias("messages"))
    body = lambda m: F.array_join(F.transform(m["turns"], lambda t: escape(t["text"])), SEP)
    written = F.transform("messages", lambda m: F.concat(F.lit(START), _role(m["role"]), F.lit("\n"), body(m), F.lit(END)))
    spans = F.flatten(F.transform(F.filter("messages", lambda m: m["role"] == LOSS_ROLE), lambda m: F.transform(m["turns"], lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))))
    return chats.select("conv_id", F.array_join(written, "").alias("formatted"), spans.alias("mask"))


def masked_texts(formatted: Column, mask: Column) -> Column:
    """The texts under the mask, unescaped, as an array.

    They are cut out of code points of four bytes each, whose places need no search. The array around them has them encoded
    once, not once a span.
    """
    cut = lambda points, m: F.decode(F.substr(points, 4 * m["start"] + 1, 4 * (m["end"] - m["start"])), "UTF-32")
    return F.flatten(F.transform(F.array(F.encode(formatted, "UTF-32")), lambda points: F.transform(mask, lambda m: unescape(cut(points, m)))))


def read_chats(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text), merged ones apart again."""
    blocks = F.split(formatted, r"<\|im_end\|>\n")
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role, rest = F.substr(head, F.lit(len(START) + 1)), F.substr(block, F.length(head) + 2)
        return F.transform(F.split(rest, r"<\|im_sep\|>"), lambda t: F.struct(_read_role(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))
