r"""Chat formatting with a grammar round trip, in built-in functions only.

A conversation is rendered as ``<|im_start|>role\ntext<|im_end|>\n`` per turn. A deterministic parser reads the
rendering back: it cuts at every control string, so a turn whose text holds one does not come back as it was.
Conversations that differ from their source are rendered again with escaped content, parsed again, and have to
be identical then; a rendering that is not raises an error.

Escaping puts one backslash more between ``<`` and ``|``: ``<|`` becomes ``<\|`` and ``<\|`` becomes ``<\\|``.
Parsing always takes one away, so text that looks escaped counts as conflicting content too. In roles a
backslash, a line feed and ``|`` are written as ``\\``, ``\n`` and ``\p``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import pick

START, END = "<|im_start|>", "<|im_end|>"
_OPEN = rf"<(\\*)\|"
_SHUT = rf"<\\(\\*)\|"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_OPEN), F.lit(r"<\\$1|"))


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_SHUT), F.lit("<$1|"))


def escape_role(role: Column) -> Column:
    for plain, code in (("\\", "\\\\"), ("\n", "\\n"), ("|", "\\p")):
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    # a pair of backslashes is one: what stands between pairs has only the two other codes
    def between(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\p"), F.lit("|"))

    return F.array_join(F.transform(F.split(role, r"\\\\", -1), between), "\\")


def render(turns: Column) -> Column:
    """The text of an array of ``(role, text)``."""

    def one(turn: Column) -> Column:
        return F.concat(F.lit(START), turn["role"], F.lit("\n"), turn["text"], F.lit(END + "\n"))

    return F.array_join(F.transform(turns, one), "")


def escaped(turns: Column) -> Column:
    return F.transform(
        turns, lambda t: F.struct(escape_role(t["role"]).alias("role"), escape_text(t["text"]).alias("text"))
    )


def segments(formatted: Column) -> Column:
    """``formatted`` cut by the grammar: an array of ``(role, text)`` as written, still escaped."""
    pieces = F.split(formatted, r"<\|im_start\|>", -1)

    def one(piece: Column) -> Column:
        body = F.substring_index(piece, END, 1)
        role = F.substring_index(body, "\n", 1)
        return F.struct(role.alias("role"), F.substr(body, F.length(role) + 2).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), one)


def parsed(cut: Column) -> Column:
    """The turns that segments stand for."""
    return F.transform(
        cut, lambda t: F.struct(unescape_role(t["role"]).alias("role"), unescape_text(t["text"]).alias("text"))
    )


def format_chats(rows: DataFrame) -> DataFrame:
    """``(conv_id, formatted, segments, turns, loss, was_escaped)``: one row per conversation.

    ``turns`` and ``loss`` (the assistant's texts, unescaped, in order) are read back from ``formatted``. Rows are
    ordered by turn, a null turn first, equal turns by role and text; repeated rows are turns of their own. Null
    roles and texts count as empty; rows without conv_id are one conversation. An empty table has no rows. A
    conversation becomes one text, so its rows meet in one task; conversations are spread over all."""
    row = rows.select(
        pick(rows, "conv_id", "long"),
        F.struct(
            pick(rows, "turn", "long"),
            F.coalesce(pick(rows, "role", "string"), F.lit("")).alias("role"),
            F.coalesce(pick(rows, "text", "string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    ordered = row.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("all"))
    source = ordered.select(
        "conv_id", F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source")
    )
    first = source.withColumn("plain", render(F.col("source")))
    first = first.withColumn("back", parsed(segments(F.col("plain"))))
    first = first.withColumn("was_escaped", F.col("back") != F.col("source"))
    second = first.withColumn(
        "formatted", F.when(F.col("was_escaped"), render(escaped(F.col("source")))).otherwise(F.col("plain"))
    ).drop("plain", "back")
    second = second.withColumn("segments", segments(F.col("formatted")))
    second = second.withColumn("turns", parsed(F.col("segments")))
    checked = F.when(F.col("turns") == F.col("source"), F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("no round trip for conversation "), F.col("conv_id").cast("string")))
    )
    loss = F.transform(
        F.filter("segments", lambda t: unescape_role(t["role"]) == "assistant"), lambda t: unescape_text(t["text"])
    )
    return second.select(
        "conv_id", checked.alias("formatted"), "segments", "turns", loss.alias("loss"), "was_escaped"
    )
