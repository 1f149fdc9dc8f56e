"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of the output::

    conversation := turn*
    turn         := "[INST]" body "[/INST]"            role user
                  | "<s>" body "</s>"                  role assistant
                  | "<<SYS>>" body "<</SYS>>"          role system
                  | "<|role:" name "|>" body "<|/role|>"   any other role

A body runs to the first closing mark of its own turn. The parser undoes four escapes in every
body and name: ``\\1`` for ``<``, ``\\2`` for ``[``, ``\\3`` for ``|`` and ``\\0`` for a backslash.
Text is rendered as it is; a turn whose own rendering does not parse back to its source is
escaped, and if the whole conversation still differs, all of its turns are. An escaped body holds
neither ``<`` nor ``[``, so the last form always parses back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.llm.common import whole_text

MARKS = {
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
    "system": ("<<SYS>>", "<</SYS>>"),
}
OTHER = ("<|role:", "|>", "<|/role|>")
TURN = (
    r"(?s)\[INST\].*?\[/INST\]|<s>.*?</s>|<<SYS>>.*?<</SYS>>|<\|role:[^|]*\|>.*?<\|/role\|>"
)
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"), ("|", "\\3"))
TURN_TYPE = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape`; a backslash of escaped text always opens an escape."""
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _framed(role: Column, body: Column) -> Column:
    name = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]))
    out = F.concat(name, body, F.lit(OTHER[2]))
    for known, (start, end) in MARKS.items():
        out = F.when(role == known, F.concat(F.lit(start), body, F.lit(end))).otherwise(out)
    return out


def _render(turns: Column, escaped) -> Column:
    """All turns as one string; ``escaped(turn)`` says which bodies are escaped."""
    def one(turn: Column) -> Column:
        body = F.when(escaped(turn), escape(turn["text"])).otherwise(turn["text"])
        return _framed(turn["role"], body)

    return F.array_join(F.transform(turns, one), "")


def _pieces(formatted: Column) -> Column:
    """The rendered turns of a formatted string, in order."""
    return F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))


def _opening(piece: Column) -> Column:
    """Code points before the body of a rendered turn."""
    size = F.locate(OTHER[1], piece) + len(OTHER[1]) - 1
    for start, _ in MARKS.values():
        size = F.when(piece.startswith(start), F.lit(len(start))).otherwise(size)
    return size


def _closing(piece: Column) -> Column:
    size = F.lit(len(OTHER[2]))
    for start, end in MARKS.values():
        size = F.when(piece.startswith(start), F.lit(len(end))).otherwise(size)
    return size


def _role(piece: Column) -> Column:
    named = F.substring(piece, F.lit(len(OTHER[0]) + 1),
                        F.locate(OTHER[1], piece) - len(OTHER[0]) - 1)
    role = unescape(named)
    for known, (start, _) in MARKS.items():
        role = F.when(piece.startswith(start), F.lit(known)).otherwise(role)
    return role


def parse(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted string.

    Null if the string is not a sequence of turns from its first to its last character.
    """
    pieces = _pieces(formatted)
    turns = F.transform(pieces, lambda p: F.struct(
        _role(p).alias("role"),
        unescape(F.substring(p, _opening(p) + 1,
                             F.char_length(p) - _opening(p) - _closing(p))).alias("text"),
    ))
    return F.when(F.array_join(pieces, "") == formatted, turns)


def loss_spans(formatted: Column) -> Column:
    """Array of (start, end) code points, end exclusive: the bodies of assistant turns."""
    start = F.struct(F.lit(0).alias("at"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        end = state["at"] + F.char_length(p)
        span = F.struct((state["at"] + _opening(p)).alias("start"),
                        (end - _closing(p)).alias("end"))
        spans = F.when(_role(p) == "assistant",
                       F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(_pieces(formatted), start, step, lambda state: state["spans"])


def format_chats(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: id, formatted, loss_spans, escape_level, round_trip.

    Turns are ordered by turn number (null first), then role and text; repeated rows are repeated
    turns. Null role and null text count as empty, an empty text keeps its turn, and a role other
    than user, assistant and system is written by name. A row without a conversation id is a
    conversation of its own. Other columns are ignored. ``escape_level`` is 0 for plain text, 1
    where single turns are escaped, 2 where all are; ``round_trip`` says that the formatted text
    parses back to the source. Without rows the result is empty.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        whole_text(text_col).alias("text"),
    )
    rows = turns.select(F.col(id_col).alias("id"), turn.alias("row"))
    gathered = (
        rows.where(F.col("id").isNotNull()).groupBy("id")
        .agg(F.array_sort(F.collect_list("row")).alias("rows"))
        .union(rows.where(F.col("id").isNull()).select("id", F.array("row").alias("rows")))
    )
    source = gathered.select(
        "id",
        F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
        .cast(TURN_TYPE).alias("turns"),
    )

    def conflicts(t: Column) -> Column:
        """Does this turn alone, unescaped, parse to something else?"""
        alone = parse(_framed(t["role"], t["text"]))
        return ~F.coalesce(alone == F.array(t), F.lit(False))

    marked = source.select(
        "id", "turns",
        F.transform("turns", lambda t: F.struct(
            t["role"].alias("role"), t["text"].alias("text"), conflicts(t).alias("conflict")
        )).alias("marked"),
    )
    first = marked.select(
        "id", "turns", F.exists("marked", lambda t: t["conflict"]).alias("some"),
        _render(F.col("marked"), lambda t: t["conflict"]).alias("formatted"),
    )
    same = F.coalesce(parse(F.col("formatted")) == F.col("turns"), F.lit(False))
    second = first.withColumn("same", same)
    whole = second.select(
        "id", "turns",
        F.when(F.col("same"), F.col("formatted"))
        .otherwise(_render(F.col("turns"), lambda t: F.lit(True))).alias("formatted"),
        F.when(~F.col("same"), 2).when(F.col("some"), 1).otherwise(0).alias("escape_level"),
    )
    return whole.select(
        F.col("id").alias(id_col),
        "formatted",
        loss_spans(F.col("formatted")).alias("loss_spans"),
        "escape_level",
        F.coalesce(parse(F.col("formatted")) == F.col("turns"), F.lit(False)).alias("round_trip"),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text below the loss mask, unescaped, in order."""
    return F.array_join(F.transform(
        spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))
    ), "")
