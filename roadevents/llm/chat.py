r"""Chat formatting that is checked by parsing its own output.

A user turn is ``<s>[INST]text[/INST]``, an assistant turn ``<s>text</s>`` and a turn of
any other role ``<s>[ROLE]role[/ROLE]text</s>``. A conversation is first rendered with
its texts as they are. A parser reads the result back; where its turns differ from the
source, texts and roles are escaped: a backslash goes after the first character of a
control string, and of one that already has backslashes there. The parser takes one
away again, so an escaped conversation always comes back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

USER, ASSISTANT = "user", "assistant"
CONTROL = r"(/?(?:s>|INST\]|ROLE\]))"
TURNS = "array<struct<role:string,text:string>>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){CONTROL}", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){CONTROL}", "$1$2$3")


def _read(part: Column) -> Column:
    return F.when(~part.rlike(rf"[<\[]{CONTROL}"), unescaped(part))


def _turn(role: Column, text: Column) -> Column:
    return (
        F.when(role == USER, F.concat(F.lit("<s>[INST]"), text, F.lit("[/INST]")))
        .when(role == ASSISTANT, F.concat(F.lit("<s>"), text, F.lit("</s>")))
        .otherwise(F.concat(F.lit("<s>[ROLE]"), role, F.lit("[/ROLE]"), text, F.lit("</s>")))
    )


def render(turns: Column, escape: bool) -> Column:
    """The conversation as one text."""

    def one(turn: Column) -> Column:
        if not escape:
            return _turn(turn["role"], turn["text"])
        # The roles that have a form of their own hold no control string.
        return _turn(escaped(turn["role"]), escaped(turn["text"]))

    return F.array_join(F.transform(turns, one), "")


def pieces(formatted: Column) -> Column:
    """The parts of a rendered conversation, one per turn, without the opening mark."""
    found = F.split(formatted, "<s>")
    return F.slice(found, F.lit(2), F.greatest(F.size(found) - 1, F.lit(0)))


def _cut(piece: Column, left: int | Column, right: int) -> Column:
    left = F.lit(left) if isinstance(left, int) else left
    return piece.substr(left + 1, F.length(piece) - left - right)


def _head(piece: Column) -> Column:
    """Characters of a third kind of turn before its text."""
    return F.instr(piece, "[/ROLE]") + F.lit(len("[/ROLE]") - 1)


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation, texts and roles unescaped.

    A control string inside one of them is against the grammar: it comes back null.
    """

    def one(piece: Column) -> Column:
        role = _cut(piece, 6, 0).substr(F.lit(1), _head(piece) - 13)
        user = F.startswith(piece, F.lit("[INST]"))
        other = F.startswith(piece, F.lit("[ROLE]"))
        name = F.when(user, USER).when(other, role).otherwise(ASSISTANT)
        text = (
            F.when(user, _cut(piece, 6, 7))
            .when(other, _cut(piece, _head(piece), 4))
            .otherwise(_cut(piece, 0, 4))
        )
        return F.struct(_read(name).alias("role"), _read(text).alias("text"))

    return F.transform(pieces(formatted), one)


def loss_spans(formatted: Column) -> Column:
    """Start and end (code points) of every assistant text in the rendered conversation."""
    zero = F.struct(
        F.lit(0).alias("at"), F.lit([]).cast("array<struct<start:int,end:int>>").alias("spans")
    )

    def add(state: Column, piece: Column) -> Column:
        start = state["at"] + 3
        after = start + F.length(piece)
        own = F.struct(start.alias("start"), (after - 4).alias("end"))
        marked = F.startswith(piece, F.lit("[INST]")) | F.startswith(piece, F.lit("[ROLE]"))
        spans = F.when(marked, state["spans"]).otherwise(
            F.concat(state["spans"], F.array(own))
        )
        return F.struct(after.alias("at"), spans.alias("spans"))

    return F.aggregate(pieces(formatted), zero, add, lambda state: state["spans"])


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted``, whether it is escaped, and loss spans.

    ``turns`` has conv_id, turn, role and text; other columns are left out. Turns stand
    in their number's order, null first, equal numbers by role and text; repeated rows
    are repeated turns. Null role and text count as empty, rows of null conv_id as one
    conversation. A conversation is one row of output, so its turns meet in one task.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("row"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    source = F.transform(
        "rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))
    )
    tried = grouped.select("conv_id", source.alias("source"))
    tried = tried.withColumn("plain", render(F.col("source"), escape=False))
    same = F.coalesce(parse(F.col("plain")) == F.col("source"), F.lit(False))
    tried = tried.withColumn("escaped", ~same)
    formatted = F.when(F.col("escaped"), render(F.col("source"), escape=True)).otherwise(
        F.col("plain")
    )
    tried = tried.withColumn("formatted", formatted)
    identical = ~F.col("escaped") | (parse(F.col("formatted")) == F.col("source"))
    failed = F.raise_error(F.concat(F.lit("cannot be parsed back: "), F.col("conv_id"))).cast("string")
    return tried.select(
        "conv_id",
        "escaped",
        F.when(identical, F.col("formatted")).otherwise(failed).alias("formatted"),
        loss_spans(F.col("formatted")).alias("loss_spans"),
    )


def digests(chats: DataFrame) -> DataFrame:
    """What each conversation's turns and loss texts are, read back from ``formatted``."""
    read = chats.select(
        "conv_id",
        parse(F.col("formatted")).alias("turns"),
        F.transform(
            "loss_spans",
            lambda s: unescaped(F.col("formatted").substr(s["start"] + 1, s["end"] - s["start"])),
        ).alias("losses"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("losses", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
