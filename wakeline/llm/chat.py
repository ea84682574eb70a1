"""Chat formatting as a relational job, in native expressions.

Turns are collected by conversation, sorted, merged where neighbours have one role, and concatenated:

    <|start|>role LF text <|sep|> text ... <|end|> LF

Roles and texts are escaped, so no control string (of this template or another that begins with < or [)
is left in them, and the output can be read back to the very turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|start|>", "<|sep|>", "<|end|>\n"

#: Escapes, undone from the last to the first.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))
LINE_FEED = ("\n", "&nl;")
#: Turns folded at once. A fold appends to an array, so its work is the square of its turns; blocks keep it linear.
BLOCK = 256


def escape(text: Column, *more: tuple[str, str]) -> Column:
    for plain, code in (*ESCAPES, *more):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, *more: tuple[str, str]) -> Column:
    for plain, code in reversed((*ESCAPES, *more)):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_chat(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv, formatted, loss) for each conversation of ``rows``.

    loss: array of (start, chars), the code points of ``formatted`` under the loss mask, one span for each
    turn of a role in ``loss_roles``, in order. Turns are ordered by turn, then role, then text; NULL turns
    come first. NULL roles and texts count as empty. Rows with a NULL conversation are one conversation.
    Repeated rows are repeated turns. Other columns are not read. An empty table gives no rows. The work is
    linear in the turns; one conversation is one row of output, however long.
    """
    turns = rows.select(F.col(conv).alias("conv"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).alias("t")).groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    blocks = turns.withColumn("blocks", F.transform(F.sequence(F.lit(0), F.floor((F.size("turns") - 1) / BLOCK).cast("int")), _merged))
    at = blocks.withColumn("starts", F.aggregate(
        "blocks", F.struct(F.lit(0).cast("bigint").alias("chars"), F.array().cast("array<bigint>").alias("starts")),
        lambda acc, b: F.struct((acc["chars"] + b["chars"]).alias("chars"), F.array_append(acc["starts"], acc["chars"]).alias("starts")),
        lambda acc: acc["starts"]))
    joined = F.concat(F.array_join(F.transform("blocks", lambda b: F.array_join(F.transform(
        b["pieces"], lambda p: F.concat(p["mark"], p["shown"])), "")), ""), F.lit(END))
    spans = F.flatten(F.zip_with("blocks", "starts", lambda b, start: F.transform(
        F.filter(b["pieces"], lambda p: p["role"].isin(*loss_roles)),
        lambda p: F.struct((start + p["start"]).alias("start"), F.char_length(p["shown"]).cast("bigint").alias("chars")))))
    return at.select(F.col("conv").alias(conv), joined.alias("formatted"), spans.alias("loss"))


def _merged(k: Column) -> Column:
    """The k-th block of ``turns`` folded into struct<role, chars, pieces>: a turn with the role of the one before goes
    on with its message, any other ends that and starts its own. ``start``: where a piece's text starts in the block."""
    first = k * BLOCK
    shown = F.transform(F.slice("turns", first + 1, F.lit(BLOCK)), lambda t: F.struct(
        t["role"].alias("role"), escape(t["text"]).alias("shown")))
    # The role before the block is NULL before the first turn.
    zero = F.struct(F.get("turns", first - 1)["role"].alias("role"), F.lit(0).cast("bigint").alias("chars"),
                    F.array().cast("array<struct<role: string, mark: string, shown: string, start: bigint>>").alias("pieces"))

    def add(acc: Column, t: Column) -> Column:
        mark = F.when(acc["role"] == t["role"], F.lit(SEP)).otherwise(F.concat(
            F.when(acc["role"].isNull(), F.lit("")).otherwise(F.lit(END)), F.lit(START), escape(t["role"], LINE_FEED), F.lit("\n")))
        start = acc["chars"] + F.char_length(mark)
        piece = F.struct(t["role"].alias("role"), mark.alias("mark"), t["shown"].alias("shown"), start.alias("start"))
        return F.struct(t["role"].alias("role"), (start + F.char_length(t["shown"])).alias("chars"),
                        F.array_append(acc["pieces"], piece).alias("pieces"))

    return F.aggregate(shown, zero, add)


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation: the turns it was made of."""

    def block(b: Column) -> Column:
        head_end = F.instr(b, "\n")
        role = unescape(F.substring(b, F.lit(len(START) + 1), head_end - F.lit(len(START) + 1)), LINE_FEED)
        body = F.substring(b, head_end + 1, F.char_length(b))
        return F.transform(F.split(body, r"<\|sep\|>", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    blocks = F.split(formatted, r"<\|end\|>\n", -1)
    return F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), block))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(
        formatted, (s["start"] + 1).cast("int"), s["chars"].cast("int")))), "")
