"""Chat formatting that survives a round trip through its own parser, in DataFrame functions only.

Grammar of a rendered conversation::

    chat   := turn*
    turn   := "### " role level ": " text "</turn>" newline
    level  := "" | "\\" | "%"

A role's % : \\ < # and newline are written as % and two hex digits, so a header ends at its first
": ". Text is rendered at the first level that the parser reads back unchanged and that leaves no
control string ("</turn>" or "### ") inside it: as it is; with one more backslash after the first
character of each control string; or with its % < # as % and two hex digits. The parser is a split
at the turns' ends and needs nothing but the rendered text.

Turns are ordered by turn, then role, then text. Null text and role are empty, a null turn comes
first, rows of a null conv_id are one conversation; repeated rows are repeated turns. A
conversation is one value of a row in the result, as its text is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

END, OPEN = "</turn>\n", "### "
LEARNED_ROLE = "assistant"
_CONTROL = "</turn>|### "


def _chain(value: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        value = F.replace(value, F.lit(old), F.lit(new))
    return value


_ROLE = (("%", "%25"), (":", "%3A"), ("\\", "%5C"), ("<", "%3C"), ("#", "%23"), ("\n", "%0A"))
_TEXT = (("%", "%25"), ("<", "%3C"), ("#", "%23"))


def _back(pairs):
    return tuple((new, old) for old, new in reversed(pairs))


def escape(text: Column, level: int) -> Column:
    if level == 0:
        return text
    if level == 1:
        return F.regexp_replace(F.regexp_replace(text, r"<(\\*)/turn>", r"<$1\\/turn>"), r"#(\\*)## ", r"#$1\\## ")
    return _chain(text, *_TEXT)


def unescape(text: Column, level: Column) -> Column:
    """The text behind its rendered form; level is the header's mark."""
    fewer = F.regexp_replace(F.regexp_replace(text, r"#(\\*)\\## ", r"#$1## "), r"<(\\*)\\/turn>", r"<$1/turn>")
    return F.when(level == "\\", fewer).when(level == "%", _chain(text, *_back(_TEXT))).otherwise(text)


def _piece(role: Column, text: Column, level: int) -> Column:
    return F.concat(F.lit(OPEN), _chain(role, *_ROLE), F.lit(("", "\\", "%")[level] + ": "), escape(text, level))


def _read(piece: Column) -> Column:
    """(role, level, text) of a turn without its end."""
    colon = F.instr(piece, ": ")
    mark = F.substr(piece, colon - 1, F.lit(1))
    marked = mark.isin("\\", "%")
    role = F.substr(piece, F.lit(len(OPEN) + 1), colon - len(OPEN) - 1 - marked.cast("int"))
    return F.struct(
        _chain(role, *_back(_ROLE)).alias("role"),
        F.when(marked, mark).otherwise("").alias("level"),
        unescape(F.substr(piece, colon + 2), F.when(marked, mark).otherwise("")).alias("text"),
    )


def parse(chat: Column) -> Column:
    """The turns of a rendered conversation: array of (role, level, text)."""
    pieces = F.split(chat, END)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), _read)


def format_chats(rows: DataFrame, learned: str = LEARNED_ROLE) -> DataFrame:
    """conv_id, formatted, mask (start, length, level of the learned texts; from 0) and identical.

    `rows` has conv_id, turn, role and text. `mask` marks the texts of the role `learned` inside
    `formatted`, in code points. Each turn takes the first level that the parser reads back
    unchanged, the last level included, and the whole conversation is parsed again: a turn or a
    conversation that is not identical to its source fails the query, so `identical` is true wherever
    there is a result. A conversation is one row, so it must stay below the 2 GB of a Spark string;
    rows without conv_id are one conversation.
    """
    turns = rows.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    piece = F.raise_error(F.concat(F.lit("no level keeps a turn of conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))).cast("string")
    for level in (2, 1, 0):
        made = _piece(F.col("role"), F.col("text"), level)
        read = _read(made)
        holds = (read["role"] == F.col("role")) & (read["text"] == F.col("text"))
        holds &= ~escape(F.col("text"), level).rlike(_CONTROL)
        piece = F.when(holds, made).otherwise(piece)
    turns = turns.withColumn("piece", piece)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(F.length("piece") + len(END)).over(order), F.lit(0)))
    head = F.instr("piece", ": ") + 1
    mark = F.substr("piece", head - 2, F.lit(1))
    span = F.struct(
        (F.col("at") + head).alias("start"), (F.length("piece") - head).alias("length"),
        F.when(mark.isin("\\", "%"), mark).otherwise("").alias("level"),
    )
    gathered = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "piece", "role", "text", span.alias("span")))).alias("turns")
    )
    formatted = F.concat(F.array_join(F.transform("turns", lambda t: F.concat(t["piece"], F.lit(END))), ""), F.lit(""))
    gathered = gathered.withColumn("formatted", formatted)
    read = F.transform(parse(F.col("formatted")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    broken = F.raise_error(F.concat(F.lit("the parser does not give back conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    return gathered.select(
        "conv_id", "formatted",
        F.transform(F.filter("turns", lambda t: t["role"] == learned), lambda t: t["span"]).alias("mask"),
        F.when(read == source, F.lit(True)).otherwise(broken.cast("boolean")).alias("identical"),
    )


def digests(chats: DataFrame) -> DataFrame:
    """What the formatted text and its mask give back: turns, learned text, lengths."""
    turns = parse(F.col("formatted"))
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join(
        F.transform("mask", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")), s["level"])), ""
    )
    return chats.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


CHAT_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), turns AS (
  SELECT *, CASE
      WHEN NOT regexp_matches(text, '</turn>|### ') THEN length(text)
      ELSE 1 + length(regexp_replace(regexp_replace(text, '<(\\*)/turn>', '<\1\\/turn>', 'g'), '#(\\*)## ', '#\1\\## ', 'g')) END
    + 4 + length(replace(replace(replace(replace(replace(replace(role, '%', '%25'), ':', '%3A'), '\', '%5C'), '<', '%3C'), '#', '%23'), chr(10), '%0A'))
    + 2 + 8 AS chars
  FROM given
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
