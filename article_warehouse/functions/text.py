"""Text measures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unicode white space. Java's \s knows ASCII blanks only and would count "a<NBSP>b" as a single word.
BLANKS = r"\t-\r\x{1c}-\x{20}\x{85}\p{Z}"


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of pieces between runs of Unicode white space; 0 for blank or missing text."""
    # One character for each word with the blanks behind it: no array of all words is made.
    marks = F.regexp_replace(F.regexp_replace(text, f"^[{BLANKS}]+", ""), f"[^{BLANKS}]+[{BLANKS}]*", "w")
    return F.coalesce(F.length(marks), F.lit(0)).cast("bigint")


def char_count(text: Column) -> Column:
    """Number of code points, not bytes."""
    return F.coalesce(F.length(text), F.lit(0)).cast("bigint")
