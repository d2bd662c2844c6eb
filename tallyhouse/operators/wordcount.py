"""Token counts over text lines (split on single blanks)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_lines(text: Column) -> Column:
    """Array of the lines of a whole text, as a line-oriented file reader
    yields them (they end in CRLF, CR or LF): no line after a final terminator,
    no line for an empty text.

    Terminators become LF first, so that the split is by one plain character,
    which needs no regular expression.
    """
    unix = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    body = F.when(F.endswith(unix, F.lit("\n")), F.substring(unix, F.lit(1), F.char_length(unix) - 1)).otherwise(unix)
    return F.when(text.isNull() | (text == ""), F.array().cast("array<string>")).otherwise(F.split(body, "\n"))


def line_tokens(line: Column) -> Column:
    """Tokens of one line split on single blanks.

    Inner and leading empty tokens are kept, trailing ones dropped; an empty
    line is one empty token and an all-blank line has none.
    """
    stripped = F.rtrim(line)  # blanks only
    return F.when((stripped == "") & (line != ""), F.array().cast("array<string>")).otherwise(F.split(stripped, " "))


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(word, count)`` over a frame with one text line per row.

    Tokens are generated in the map stage and counted with partial
    aggregation, so a very frequent token is combined before the shuffle.
    """
    words = lines.select(F.explode(line_tokens(F.col(column))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def document_word_count(docs: DataFrame, column: str = "text") -> DataFrame:
    """Word count over whole documents (each document read as one text file)."""
    lines = docs.select(F.explode(text_lines(F.col(column))).alias("value"))
    return word_count(lines)
