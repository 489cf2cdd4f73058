"""Code blocks: which text blocks are code, and their lines as code."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspan.functions.text import strip
from inkspan.operators.relational import ordered_concat

# How comments begin.
COMMENT = r"^(//|#|'|--|/\*|'''|\"\"\"|--\[\[|<!--|%|%\{|\(\*)"
WORD = r"[\p{L}\p{N}_]"


def is_comment(line: Column) -> Column:
    return line.rlike(COMMENT)


def word_characters(line: Column) -> Column:
    return F.length(F.regexp_replace(line, WORD.replace("[", "[^"), ""))


def has_short_lines(characters: Column, lines: Column, most: int = 80) -> Column:
    """From a block's word characters and lines: fewer than `most` a line break; false without any."""
    return (characters > 0) & (characters / F.greatest(lines - 1, F.lit(1)) < most)


def code_blocks(lines: DataFrame, block: Sequence[str], doc_id: str = "doc_id") -> DataFrame:
    """(block's keys, lines, is_code) of text lines (block's keys, text, x0, y0, y1, sizes: font sizes of the line's
    spans). Code has more than three lines, short ones, most of them indented or comments, in type and line
    height of at most 0.8 of the document's mean and median. Both are aggregates; the document's are joined."""
    height = F.col("y1") - F.col("y0")
    total = F.aggregate("sizes", F.lit(0.0), lambda a, x: a + x.cast("double"))
    of_doc = lines.groupBy(doc_id).agg(F.try_divide(F.sum(total), F.sum(F.size("sizes"))).alias("_size"), F.median(height).alias("_height"))
    left = F.min("x0").over(Window.partitionBy(*block))
    per = lines.withColumn("_in", ((F.col("x0") > left) | is_comment(F.col("text"))).cast("int") + ((F.col("x0") > left) & is_comment(F.col("text"))).cast("int"))
    per = per.groupBy(doc_id, *[c for c in block if c != doc_id]).agg(
        F.count("*").alias("lines"), F.sum(word_characters(F.col("text"))).alias("_chars"), F.sum("_in").alias("_in"), F.try_divide(F.sum(total), F.sum(F.size("sizes"))).alias("_mean"), F.avg(height).alias("_high")
    )
    small = (F.col("_mean") <= 0.8 * F.col("_size")) & (F.col("_high") < 0.8 * F.col("_height"))
    code = (F.col("lines") > 3) & has_short_lines(F.col("_chars"), F.col("lines")) & (F.col("_in") > F.lit(Decimal("0.7")) * F.col("lines")) & small
    return per.join(of_doc, doc_id).select(*block, "lines", F.coalesce(code, F.lit(False)).alias("is_code"))


def indented_blocks(lines: DataFrame, block: Sequence[str], order: str) -> DataFrame:
    """(block's keys, text) of a code block's lines (text, x0, first_text, first_x0, first_x1: its first span): each
    with the spaces that its distance from the left edge stands for, by the width of a character of the
    block's first span that has one; of blank lines in a row the first stays."""
    w = Window.partitionBy(*block).orderBy(order)
    whole = Window.partitionBy(*block)
    width = F.when(F.length("first_text") > 0, (F.col("first_x1") - F.col("first_x0")) / F.length("first_text"))
    blank = F.length(strip(F.col("text"))) == 0
    df = lines.select("*", F.least(F.lit(1000.0), F.min("x0").over(whole)).alias("_left"), F.first(F.when(width != 0, width), True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_width"))
    df = df.withColumns({"_blank": blank, "_before": F.coalesce(F.lag(blank).over(w), F.lit(False))}).filter(~(F.col("_blank") & F.col("_before")))
    spaces = F.when(F.col("_width").isNull(), 0).otherwise(F.greatest(F.lit(0), ((F.col("x0") - F.col("_left")) / F.col("_width")).cast("int")))
    return df.withColumn("_line", F.concat(F.repeat(F.lit(" "), spaces), "text", F.lit("\n"))).groupBy(*block).agg(ordered_concat([order], "_line").alias("text"))
