"""Column expressions on the words and lines of a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
_BLANK = r"[\x20\x09-\x0D]+"


def word_array(text: Column) -> Column:
    """Runs of characters other than blank, tab, line feed, vertical tab, form feed and
    carriage return; none for NULL."""
    return F.coalesce(F.filter(F.split(text, _BLANK), lambda w: w != ""), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def char_count(text: Column, characters: str, keep: bool = False) -> Column:
    """How many of the characters a text has; with ``keep``, how many others."""
    others = F.length(F.translate(text, characters, ""))
    return F.coalesce(others if keep else F.length(text) - others, F.lit(0)).cast("long")


def lines_with_words(text: Column) -> Column:
    """The lines (between line feeds) that have a word."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return F.coalesce(lines, F.array().cast("array<string>"))


def normal_line(line: Column) -> Column:
    """Lower case, words one blank apart."""
    return F.lower(F.trim(F.regexp_replace(line, _BLANK, " ")))
