"""Relational chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted by turn, adjacent
turns of one role are merged into one block by array aggregation, and the
blocks are concatenated:

    <|im_start|>role\\ntext[<|im_sep|>text ...]<|im_end|>\\n

Inside texts ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``; inside roles
``%``, line ends and ``<`` become ``%25``, ``%0A`` and ``%3C``.  So no control
string can stand inside a text or a role, and reading back is exact.

Defined results: a null text or role counts as empty; turns that share a
number are ordered by role, then text; a null turn number sorts first; a null
conversation id is a conversation of its own; repeated rows are turns of their
own; an empty table gives an empty table; other columns are not read.  A
conversation is one training example and becomes one output string, so its
turns meet in one row by design.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def escape_role(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv id, formatted)``: one formatted string for each conversation."""
    rows = turns.select(
        F.col(id_col).alias("conv"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    whole = rows.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    # numbered so that each turn can be compared with the one before it
    numbered = F.zip_with("turns", F.concat(F.array(F.lit(None).cast("string")), F.transform("turns", lambda t: t["role"])), lambda t, last: F.struct(t["role"].alias("role"), t["text"].alias("text"), last.alias("last")))
    said = F.filter(numbered, lambda t: t["role"].isNotNull())

    def opened(t: Column) -> Column:
        same = t["last"].isNotNull() & (t["last"] == t["role"])
        start = F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))
        return F.concat(F.when(same, F.lit(SEP)).when(t["last"].isNull(), start).otherwise(F.concat(F.lit(END), start)), escape(t["text"]))

    body = F.array_join(F.transform(said, opened), "")
    return whole.select(F.col("conv").alias(id_col), F.concat(body, F.lit(END)).alias("formatted"))


def _regex(control: str) -> str:
    return control.replace("|", r"\|")


def read_back(formatted: Column) -> Column:
    """The turns ``array<struct<role, text>>`` read from a formatted string."""
    blocks = F.filter(F.split(formatted, _regex(START), -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role = unescape_role(head)
        body = F.substr(block, F.length(head) + 2, F.length(block) - F.length(head) - 1 - F.lit(len(END)))
        return F.transform(F.split(body, _regex(SEP), -1), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_spans(formatted: Column, role: str = "assistant") -> Column:
    """The text under the loss mask, unescaped: every text of ``role``, once and in order."""
    return F.transform(F.filter(read_back(formatted), lambda t: t["role"] == role), lambda t: t["text"])


def digests(chats: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digest columns, all computed from the formatted strings alone."""
    read = chats.select(id_col, "formatted", read_back(F.col("formatted")).alias("turns"))
    loss = read.select("*", F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "").alias("loss"))
    return loss.select(
        id_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
