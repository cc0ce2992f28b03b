"""Chat formatting with Spark expressions only: turns to one marked text with a loss mask, and back.

Adjacent turns of one role form one block: ``<s>`` role ``[INST]`` text ``[AND]`` text ... ``[/INST]``; ``</s>`` ends the
conversation. The mask is a list of runs (chars, loss) in code points, one run per mark, role and text, and covers the
formatted text from its first to its last character; runs without characters are left out.

Marks inside roles and texts are broken by a backslash after their first character, and backslashes are doubled, so a
formatted text holds a mark only where the format has put one, and reading gives back every role and text as it was.

NULL roles and texts are empty. Turns are ordered by ``turn``, NULL first, equal ones by role and text; repeated rows are
turns of their own. Rows without a conversation id form one conversation without id. An empty table gives no rows. Only
named columns are read. A formatted conversation is one row, so its turns meet in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import let

# Every mark opens with a character that it does not hold again, so no mark can begin in a text and end in a mark.
BEGIN, SAYS, MORE, END, CLOSE = "<s>", "[INST]", "[AND]", "[/INST]", "</s>"
MARKS = [BEGIN, SAYS, MORE, END, CLOSE]
ROLE_UNDER_LOSS = "assistant"


def escaped(text: Column) -> Column:
    """The text without marks: backslashes doubled, one more after the first character of every mark."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in MARKS:
        text = F.replace(text, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return text


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``; few texts hold a backslash."""
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


def format_chats(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, formatted, mask): one row per conversation; the loss is on the texts of the assistant."""
    kept = F.struct(
        F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )
    turns = F.sort_array(F.collect_list(kept))
    chats = df.groupBy(F.col(conv).alias("conv_id")).agg(turns.alias("turns"))
    return chats.select("conv_id", _blocks(F.col("turns")).alias("blocks")).select(
        "conv_id", F.flatten(F.transform("blocks", _segments)).alias("segments")
    ).select(
        "conv_id",
        F.concat(F.array_join(F.col("segments.text"), ""), F.lit(CLOSE)).alias("formatted"),
        F.filter(
            F.concat(
                F.transform("segments", lambda s: _run(F.length(s["text"]), s["loss"])),
                F.array(_run(F.lit(len(CLOSE)), F.lit(False))),
            ),
            lambda run: run["chars"] > 0,
        ).alias("mask"),
    )


def read_chats(df: DataFrame, formatted: str, mask: str) -> DataFrame:
    """The rows with ``turns``, the (role, text) of every turn, and ``learned``, all text under the loss mask.

    A mask whose runs do not meet the marks of its text is an error.
    """
    whole = F.col(formatted)
    blocks = F.split(F.left(whole, F.length(whole) - len(CLOSE)), r"\[/INST\]")
    turns = F.flatten(F.transform(F.filter(blocks, lambda b: b != ""), _turns_of_block))
    return df.withColumns({"turns": turns, "learned": let(_cut_at_marks(whole), lambda s: _learned(s, F.col(mask)))})


def _cut_at_marks(formatted: Column) -> Column:
    """The marks and the texts between them, in order. ``CLOSE`` stands only at the end, so it can part the others."""
    body = F.left(formatted, F.length(formatted) - len(CLOSE))
    for mark in MARKS[:-1]:
        body = F.replace(body, F.lit(mark), F.lit(CLOSE + mark + CLOSE))
    return F.concat(F.filter(F.split(body, CLOSE), lambda s: s != ""), F.array(F.lit(CLOSE)))


def _learned(segments: Column, runs: Column) -> Column:
    fits = F.transform(segments, F.length) == F.transform(runs, lambda r: r["chars"])
    masked = F.filter(F.zip_with(segments, runs, _masked_segment), lambda s: s.isNotNull())
    joined = F.array_join(F.transform(masked, unescaped), "")
    return F.when(fits, joined).otherwise(F.raise_error(F.lit("the mask does not fit the text")))


def _masked_segment(segment: Column, run: Column) -> Column:
    return F.when(run["loss"], segment)


def _blocks(turns: Column) -> Column:
    """Adjacent turns of one role as one struct (role, texts)."""
    last = F.size(turns) - 1
    begins = F.filter(
        F.sequence(F.lit(0), last), lambda i: (i == 0) | (turns[i]["role"] != F.get(turns, i - 1)["role"])
    )
    ends = F.concat(F.slice(begins, 2, F.size(begins)), F.array(last + 1))
    return F.zip_with(
        begins,
        ends,
        lambda begin, end: F.struct(
            turns[begin]["role"].alias("role"),
            F.transform(F.slice(turns, begin + 1, end - begin), lambda t: t["text"]).alias("texts"),
        ),
    )


def _segments(block: Column) -> Column:
    """The segments (text, loss) of a block."""
    loss = block["role"] == ROLE_UNDER_LOSS
    said = F.transform(
        block["texts"],
        lambda text, i: F.array(
            _segment(F.when(i == 0, SAYS).otherwise(MORE), F.lit(False)), _segment(escaped(text), loss)
        ),
    )
    opened = F.array(_segment(F.lit(BEGIN), F.lit(False)), _segment(escaped(block["role"]), F.lit(False)))
    return F.concat(opened, F.flatten(said), F.array(_segment(F.lit(END), F.lit(False))))


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _run(chars: Column, loss: Column) -> Column:
    return F.struct(chars.alias("chars"), loss.alias("loss"))


def _turns_of_block(block: Column) -> Column:
    parts = F.split(block, r"\[INST\]")
    role = unescaped(F.substr(parts[0], F.lit(len(BEGIN) + 1)))
    return F.transform(
        F.split(parts[1], r"\[AND\]"), lambda text: F.struct(role.alias("role"), unescaped(text).alias("text"))
    )
