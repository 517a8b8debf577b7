"""Chat formatting by a grammar round trip, in DataFrame functions only.

A turn is written as a line feed, `### `, its role, `: `, its text and `</turn>`. The reader
splits at `</turn>`, cuts the role at the first `: `, and undoes the
escapes `\\l`, `\\h`, `\\c` and `\\b` (for `<`, `#`, `:` and `\\`). Texts are first written as they
are. What the reader does not give back exactly is written again with these four escaped,
which leaves no control string in it, and read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, MIDDLE, TAIL = "\n### ", ": ", "</turn>"
LEARNED_ROLE = "assistant"
# In writing order; reading undoes them from the last to the first.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def written(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(MIDDLE), text, F.lit(TAIL))


def pieces(formatted: Column) -> Column:
    """Turns of a formatted text between their ends; what follows the last end is left out."""
    parts = F.split(formatted, TAIL, -1)
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def middle_of(piece: Column) -> Column:
    """Place of the first role end of a piece, counted from 1; 0 where it has none."""
    return F.instr(piece, MIDDLE)


def role_of(piece: Column) -> Column:
    return unescaped(F.substring(piece, F.lit(len(HEAD) + 1), middle_of(piece) - F.lit(len(HEAD) + 1)))


def text_of(piece: Column) -> Column:
    return unescaped(F.substring(piece, middle_of(piece) + F.lit(len(MIDDLE)), F.length(piece)))


def returns(line: Column, role: Column, text: Column) -> Column:
    """Whether the reader gives exactly this one turn back from its line."""
    found = pieces(line)
    first = F.element_at(found, 1)
    return (F.size(found) == 1) & F.endswith(line, F.lit(TAIL)) & (role_of(first) == role) & (text_of(first) == text)


def turn_lines(turns: DataFrame, columns: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text")) -> DataFrame:
    """(conv_id, turn, role, text, line, tries): each turn as it is written, and after how many tries.

    Role and text are each escaped only where the line doesn't come back without it. Null
    roles and texts are empty. Other columns are not read.
    """
    conv, turn, role, text = (F.col(f"`{c}`") for c in columns)
    rows = turns.select(
        conv.alias("conv_id"), turn.alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )
    role, text = F.col("role"), F.col("text")
    plain = written(role, text)
    half = written(role, escaped(text))
    full = written(escaped(role), escaped(text))
    tries = F.when(returns(plain, role, text), 1).when(returns(half, role, text), 2).otherwise(3)
    rows = rows.withColumn("tries", tries)
    return rows.withColumn("line", F.when(F.col("tries") == 1, plain).when(F.col("tries") == 2, half).otherwise(full))


def format_conversations(turns: DataFrame, columns: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text")) -> DataFrame:
    """(conv_id, formatted, loss): whole conversations, and the spans that are learned from.

    Turns are ordered by turn, then role and text; null turns come first; repeated rows stay.
    A null conv_id is a conversation of its own. `loss` holds (start, length) in code points
    of each assistant text as written, in order. Writing, reading back and escaping are done
    row by row; only the finished lines of a conversation meet, since its text is one value.
    """
    lines = turn_lines(turns, columns)
    lead = F.when(F.col("tries") == 3, F.length(escaped(F.col("role")))).otherwise(F.length("role")) + F.lit(len(HEAD + MIDDLE))
    inside = F.length("line") - lead - F.lit(len(TAIL))
    item = F.struct(
        "turn", "role", "text", "line", lead.alias("lead"), inside.alias("inside"), (F.col("role") == LEARNED_ROLE).alias("learned")
    )
    whole = lines.groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    start = F.struct(F.lit(0).cast("int").alias("place"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        span = F.array(F.struct((state["place"] + turn["lead"]).alias("start"), turn["inside"].alias("length")))
        return F.struct(
            (state["place"] + F.length(turn["line"])).alias("place"),
            F.when(turn["learned"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return whole.select(
        "conv_id",
        F.concat_ws("", F.transform("items", lambda t: t["line"])).alias("formatted"),
        F.aggregate("items", start, step, lambda s: s["spans"]).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text): the turns and the learned texts that the output itself holds."""
    turn = lambda p: F.struct(role_of(p).alias("role"), text_of(p).alias("text"))
    span = lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))
    return formatted.select(
        "conv_id",
        "formatted",
        F.transform(pieces(F.col("formatted")), turn).alias("turns"),
        F.concat_ws("", F.transform("loss", span)).alias("loss_text"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), all read back."""
    listed = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
