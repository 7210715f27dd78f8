"""Chat formatting with Spark expressions only.

Turns are escaped row by row, collected as structs, sorted, merged where neighbours have one role, and joined:

    <s>role, line feed, text [+] next text of the same role </s>

(without the blanks). `<s>`, `</s>` and `[+]` inside a text get a backslash after their first character, and one more if they have some
already, so a text can neither open nor close a turn, and `parsed` gives back every text exactly. Roles are URL-encoded.

The loss mask has for each turn the characters of template before its text and the characters of text to train on, which
are those of assistant turns. All array steps are linear in a conversation's turns. The result has one row per conversation, so
a conversation must fit a row; its turns are escaped before they meet.

Cases: a null text is empty, a null role the empty role. Turns of one number are ordered by role, then text; a null number
comes first; repeated rows are turns each. Rows without conversation id are one conversation. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE, JOIN = "<s>", "</s>", "[+]"
_CLOSE, _JOIN = "</s>", r"\[\+\]"
_CONTROL = r"(/?s>|\+\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(<|\[)(\\*)" + _CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(<|\[)\\(\\*)" + _CONTROL, "$1$2$3")


def formatted(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    trained: str = "assistant",
) -> DataFrame:
    """One row per conversation: id, formatted, loss_mask (array of skip, take; one for each turn)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(F.col(conv_col).alias("conv"), F.struct(
        F.col(turn_col).alias("turn"), F.url_encode(role).alias("role"), escaped(text).alias("text"),
        (role == trained).alias("trained")).alias("turn"))
    sorted_turns = rows.groupBy("conv").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    heads = sorted_turns.withColumn("heads", F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", F.greatest(i - 1, F.lit(0)))["role"])))
    blocks = heads.withColumn("blocks", F.transform("heads", lambda head, k: F.struct(
        F.get("turns", head)["role"].alias("role"),
        F.transform(
            F.slice("turns", head + 1, F.coalesce(F.get("heads", k + 1), F.size("turns")) - head),
            lambda t: t["text"]).alias("texts"))))
    text = F.array_join(F.transform("blocks", lambda b: F.concat(
        F.lit(OPEN), b["role"], F.lit("\n"), F.array_join(b["texts"], JOIN), F.lit(CLOSE))), "")
    mask = F.transform("turns", lambda t, i: F.struct(
        F.when((i == 0) | (t["role"] != F.get("turns", F.greatest(i - 1, F.lit(0)))["role"]),
               F.length(t["role"]) + len(OPEN) + 1).otherwise(0).alias("skip"),
        F.when(t["trained"], F.length(t["text"])).otherwise(0).alias("take")))
    return blocks.select(F.col("conv").alias(conv_col), text.alias("formatted"), mask.alias("loss_mask"))


def _blocks(text: Column) -> Column:
    parts = F.split(text, _CLOSE, -1)
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def parsed(text: Column) -> Column:
    """Array of (role, text): the turns of a formatted conversation."""
    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role = F.url_decode(head.substr(F.lit(len(OPEN) + 1), F.length(head)))
        body = block.substr(F.length(head) + 2, F.length(block))
        return F.transform(F.split(body, _JOIN, -1), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(_blocks(text), turns))


def loss_text(text: Column, mask: Column) -> Column:
    """All characters of a formatted conversation that the mask trains on, unescaped."""
    pieces = F.flatten(F.transform(_blocks(text), lambda b: F.split(b, _JOIN, -1)))
    return F.array_join(F.zip_with(pieces, mask, lambda p, m: unescaped(p.substr(m["skip"] + 1, m["take"]))), "")
