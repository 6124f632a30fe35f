"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: all turns before it as context, the reply as target, and only the
reply trainable. Turns that no reply follows make one last example without a target, so nothing is lost.
A turn is written as ``### role: text</turn>`` and a line end. Inside roles and texts ``\\`` becomes ``\\s``,
``###`` becomes ``\\h`` and ``</turn>`` becomes ``\\e`` (in roles also ``:`` becomes ``\\c``), so that no text can
forge a mark; every backslash of the result starts one of these pairs, which makes the way back unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------------------
OPEN, SEPARATOR, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = [("\\", "\\s"), ("###", "\\h"), ("</turn>", "\\e")]
ROLE_ESCAPES = [*ESCAPES, (":", "\\c")]
# -----------------------------------------------------------------------------------------


def escape(c: Column, pairs=ESCAPES) -> Column:
    for plain, code in pairs:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column, pairs=ESCAPES) -> Column:
    for plain, code in reversed(pairs):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    trainable: str = "assistant",
) -> DataFrame:
    """``conv_id, example, n_turns, text, target_start, target_chars, is_last``: one row per example.

    The target is the span of ``target_chars`` code points from ``target_start`` (from 0) of ``text``; it holds
    the escaped reply alone. ``is_last`` marks the example with all turns of its conversation. Order: turn, then
    role and text; rows that repeat are turns of their own. Null text and null role are empty; a null
    conversation id is an id. An empty table gives no rows. Whole conversations meet in one row, as each
    example is such a row itself; nothing else is gathered.
    """
    head = F.concat(F.lit(OPEN), escape(F.coalesce(F.col(role), F.lit("")), ROLE_ESCAPES), F.lit(SEPARATOR))
    body = escape(F.coalesce(F.col(text), F.lit("")))
    one = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), body.alias("body"), head.alias("head")
    )
    chats = turns.groupBy(F.col(conv_id).alias("conv_id")).agg(F.array_sort(F.collect_list(one)).alias("t"))
    count = F.size("t")
    ends = F.filter(
        F.sequence(F.lit(1), count), lambda i: (F.element_at("t", i)["role"] == trainable) | (i == count)
    )
    examples = chats.select("conv_id", count.alias("all"), "t", F.posexplode(ends).alias("example", "n_turns"))
    prefix = F.array_join(
        F.transform(F.slice("t", 1, F.col("n_turns")), lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), ""
    )
    last = F.element_at("t", F.col("n_turns"))
    has_target = last["role"] == trainable
    return examples.select(
        "conv_id", F.col("example").cast("long").alias("example"), F.col("n_turns").cast("long").alias("n_turns"),
        prefix.alias("text"), F.when(has_target, F.length(last["body"])).otherwise(0).cast("long").alias("target_chars"),
        (F.col("n_turns") == F.col("all")).alias("is_last"), has_target.alias("has_target"),
    ).select(
        "conv_id", "example", "n_turns", "text",
        F.when(F.col("has_target"), F.length("text") - len(CLOSE) - F.col("target_chars")).cast("long").alias("target_start"),
        "target_chars", "is_last",
    )


def parse_turns(text: Column) -> Column:
    """The turns of a formatted text as an array of (role, text), unescaped."""
    parts = F.split(text, CLOSE, -1)
    whole = F.slice(parts, 1, F.size(parts) - 1)

    def turn(x):
        cut = F.locate(SEPARATOR, x)
        role = F.substring(x, F.lit(len(OPEN) + 1), cut - len(OPEN) - 1)
        body = F.substring(x, cut + len(SEPARATOR), F.length(x))
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(body).alias("text"))

    return F.transform(whole, turn)


def target_text(text: Column, start: Column, chars: Column) -> Column:
    """The trainable reply of an example, unescaped."""
    return unescape(F.substring(text, (start + 1).cast("int"), chars.cast("int")))
