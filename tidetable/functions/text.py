"""Text columns: token lists, ranked reports and pair encoding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The whitespace class, the report's rule and its line layout.
WHITESPACE = " \t\n\u000b\f\r"
REPORT_RULE = "--------------------------------------"
REPORT_LINE = "No%d:  商品ID=%s  浏览量=%d"


def tokens(value: str | Column) -> Column:
    """Words cut at every single whitespace character.

    Leading and inner empty words stay, trailing ones go; an empty line is one empty word and a line of
    nothing but whitespace has none.
    """
    text = F.col(value) if isinstance(value, str) else value
    kept = F.rtrim(text, F.lit(WHITESPACE))
    blank = (kept == "") & (text != "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(kept, r"\s"))


def pair_text(first: str | Column, second: str | Column) -> Column:
    """``(word,total)`` payload of an outgoing message."""
    return F.format_string("(%s,%d)", first, second)


def ranked_report(ranked: Column) -> Column:
    """One text block from an array of ``(rank, item, count)`` structs sorted by rank."""
    lines = F.transform(ranked, lambda r: F.format_string(REPORT_LINE + "\n", r["rank"], r["item"].cast("string"), r["n"]))
    return F.concat(F.lit(REPORT_RULE + "\n"), F.array_join(lines, ""), F.lit(REPORT_RULE + "\n\n"))
