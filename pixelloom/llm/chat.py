"""Chat formatting with Spark expressions only (operator 10).

A conversation's turns are collected as structs and sorted, adjacent turns of one role are merged by array
functions that compare neighbours, and the blocks are concatenated:

    ### role: text<part/>text</turn>

with a line break after each ``</turn>``.  ``<part/>`` stands between merged turns, so merging loses nothing.  Inside roles and texts
a backslash is doubled and one is put into every control string, so no control string occurs there and
taking backslashes away again restores the text.  ``loss_spans`` are the (start, length) in characters of the escaped texts
of the loss role, zero-based.

Grouping by conversation is the only shuffle; a conversation is one row of the result by definition.
The main path has no Python.

Work is in proportion to the text, and to the turns but for runs of ``RUN`` turns.

Defined cases: a null text or role is the empty string, and both may have any length; turns of equal number are ordered by role, then text,
and repeated rows stay; null turn numbers come first; null conversation ids form one conversation; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, COLON, PART, CLOSE = "### ", ": ", "<part/>", "</turn>\n"
#: Possessive, so that Java's matcher neither recurses nor goes back, however long the role.
_HEADER = r"(?s)^### ((?:[^\\:]++|\\.)*+): "
#: Turns that are measured at once.
RUN = 256


def escape(c: Column) -> Column:
    """The text with no control string in it."""
    for old, new in (("\\", "\\\\"), ("##", "#\\#"), ("</turn>", "<\\/turn>"), ("<part/>", "<\\part/>"), (":", "\\:")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, also where ``body`` has it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pieces(turns: Column, loss_role: str) -> Column:
    """Array of (lead, body, tail, loss), one for each turn; a turn is merged with its neighbours of the same role."""

    def of(turn: Column, i: Column) -> Column:
        role = turn["role"]
        goes_on = lambda j: F.coalesce(F.get(turns, j)["role"] == role, F.lit(False))
        return F.struct(
            F.when(goes_on(i - 1), F.lit(PART)).otherwise(F.concat(F.lit(OPEN), escape(role), F.lit(COLON))).alias("lead"),
            escape(turn["text"]).alias("body"),
            F.when(goes_on(i + 1), F.lit("")).otherwise(F.lit(CLOSE)).alias("tail"),
            (role == loss_role).alias("loss"),
        )

    return F.transform(turns, of)


def _spans(pieces: Column) -> Column:
    """(start, length) of the bodies under the loss.

    Pieces are measured in runs of ``RUN``, since every step of an aggregate copies the array that it grows; runs are then moved to their places."""
    start = F.expr("named_struct('at', 0L, 'spans', cast(array() as array<struct<start:bigint,length:bigint>>))")

    def add(state: Column, p: Column) -> Column:
        begin = state["at"] + F.length(p["lead"])
        size = F.length(p["body"]).cast("long")
        span = F.struct(begin.alias("start"), size.alias("length"))
        spans = F.when(p["loss"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((begin + size + F.length(p["tail"])).alias("at"), spans.alias("spans"))

    def moved(runs: Column) -> Column:
        ends = F.aggregate(runs, F.expr("array(0L)"), lambda found, r: F.concat(found, F.array(F.element_at(found, -1) + r["at"])))
        shift = lambda r, by: F.transform(r["spans"], lambda s: F.struct((s["start"] + by).alias("start"), s["length"].alias("length")))
        return F.flatten(F.zip_with(runs, F.slice(ends, F.lit(1), F.size(runs)), shift))

    firsts = F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1)), F.lit(RUN))
    return let(F.transform(firsts, lambda i: F.aggregate(F.slice(pieces, i, F.lit(RUN)), start, add)), moved)


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """(conversation, formatted, loss_spans)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    grouped = df.select(F.col(conv_col), turn.alias("t")).groupBy(conv_col).agg(F.array_sort(F.collect_list("t")).alias("turns"))
    pieces = grouped.select(conv_col, _pieces(F.col("turns"), loss_role).alias("pieces"))
    joined = F.array_join(F.transform("pieces", lambda p: F.concat(p["lead"], p["body"], p["tail"])), "")
    return pieces.select(conv_col, joined.alias("formatted"), _spans(F.col("pieces")).alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """Array of (role, text): the turns of a formatted conversation."""
    blocks = F.split(formatted, "</turn>\n", -1)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def of(block: Column) -> Column:
        role = unescape(F.regexp_extract(block, _HEADER, 1))
        texts = F.split(F.regexp_replace(block, _HEADER, ""), PART, -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, of))


def under_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
