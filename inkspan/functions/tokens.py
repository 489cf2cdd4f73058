"""Token strings of table decoders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def html_tokens(c: Column) -> Column:
    """Tokens up to the end mark."""
    return F.filter(F.split(F.regexp_replace(c, r"<eos>.*$", ""), " "), lambda x: F.length(x) > 0)


def box_quads(c: Column) -> Column:
    """Numbers of `bbox-N` tokens in fours; a remainder is dropped."""
    n = F.transform(F.filter(F.split(F.regexp_replace(c, r"<eos>.*$", ""), " "), lambda x: x.startswith("bbox-")), lambda x: F.substring(x, 6, 9).cast("int"))
    k = F.floor(F.size(n) / 4).cast("int")
    return F.when(k == 0, F.array().cast("array<array<int>>")).otherwise(F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.slice(n, i * 4 + 1, F.lit(4))))


def cell_texts(c: Column) -> Column:
    """Texts of cell sequences, one per separator, without the end mark."""
    return F.transform(F.split(F.regexp_replace(c, r"<eos>.*$", ""), r"<sep>"), lambda x: F.trim(x))
