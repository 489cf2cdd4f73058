"""Joins and windows that document rules are made of.

Spatial rules pair the boxes of one page. `with_page_items` brings a page's items to each row as an array:
both sides are shuffled once on the page key, and arg-max, threshold and nearest rules become array
expressions in one stage. No pair is a row, so nothing is shuffled again to pick one of them. A page's
items are bounded by what fits on a page."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

PAGE = ("doc_id", "page_id")


def with_page_items(left: DataFrame, right: DataFrame, columns: Sequence[str], keys: Sequence[str] = PAGE, name: str = "items") -> DataFrame:
    """left with an array of right's rows of the same keys, in the order of their columns; empty if none."""
    items = right.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))
    out = left.join(items, list(keys), "left")
    kind = items.schema[name].dataType
    return out.withColumn(name, F.coalesce(name, F.array().cast(kind)))


def best(items: Column, score: Callable[[Column], Column], keep: Callable[[Column], Column] | None = None) -> Column:
    """The item of the highest score, the first of equal ones; null if none."""
    scored = F.transform(items, lambda x, i: F.struct(score(x).alias("score"), (-i).alias("turn"), x.alias("item")))
    if keep:
        scored = F.filter(scored, lambda s: keep(s["score"]))
    return F.array_max(scored)


def cell_texts(cells: DataFrame, glyphs: DataFrame, page: Column, image: Column, least: float = 0.3) -> DataFrame:
    """(doc_id, page_id, table_id, cell_id, text): what lies in each cell by at least `least` of its own area, in order.

    cells (doc_id, page_id, table_id, cell_id, box: in the table's picture; turned: degrees by which that was turned,
    w, h: its size so turned; x, y: where the table is in the page's picture). glyphs (doc_id, page_id, table_id, pos,
    text, is_char, box: in page points); page and image are the page's box in points and pixels. Where a cell has
    characters, spans that came without theirs are left out."""
    from inkspan.functions import geometry as G

    own = F.when(F.col("turned") == 0, F.col("box")).otherwise(G.rotate(F.col("box"), F.col("turned"), F.col("w"), F.col("h")))
    placed = cells.withColumn("_own", own).withColumn("_cell", G.box(F.col("_own.x0") + F.col("x"), F.col("_own.y0") + F.col("y"), F.col("_own.x1") + F.col("x"), F.col("_own.y1") + F.col("y")))
    scaled = glyphs.withColumn("_glyph", G.rescale(F.col("box"), page, image)).select("doc_id", "page_id", "table_id", "pos", "text", "is_char", "_glyph")
    df = with_page_items(placed, scaled, ("pos", "text", "is_char", "_glyph"), ("doc_id", "page_id", "table_id"))
    inside = F.filter("items", lambda x: G.overlap_share(x["_glyph"], F.col("_cell")) >= least)
    df = df.select("doc_id", "page_id", "table_id", "cell_id", inside.alias("g"))
    chars = F.filter("g", lambda x: x["is_char"])
    taken = F.when(F.size(chars) > 0, chars).otherwise(F.col("g"))
    return df.select("doc_id", "page_id", "table_id", "cell_id", F.array_join(F.transform(taken, lambda x: x["text"]), "").alias("text"))


def insert_points(regions: DataFrame, lines: DataFrame, share: Callable[[Column, Column], Column], least: float = 0.7) -> DataFrame:
    """regions (doc_id, page_id, x0..y1) with `line_id`, where what replaces them goes: their first line, of those that
    lie in them by more than `least` (share(region's box, line)); without one, the line whose corner is nearest, or
    0 on a page without lines; and with their lines' text."""
    box = F.struct("x0", "y0", "x1", "y1")
    df = with_page_items(regions.withColumn("_box", box), lines, ("line_id", "line", "x0", "y0", "x1", "y1"))
    inside = F.filter("items", lambda x: share(F.col("_box"), x) > least)
    near = best(F.col("items"), lambda x: -((x["x0"] - F.col("x0")) ** 2 + (x["y0"] - F.col("y0")) ** 2))
    df = df.withColumns({"_in": inside, "_near": near["item"]["line_id"]})
    at = F.coalesce(F.try_element_at("_in", F.lit(1))["line_id"], "_near", F.lit(0))
    return df.withColumns({"line_id": at, "text": F.array_join(F.transform("_in", lambda x: x["line"]), " ")}).drop("items", "_in", "_near", "_box")


def islands(keys: Sequence[str], order: Sequence[str], start: Column) -> Column:
    """Number of the run that a row is in; a row with `start` begins one."""
    return F.sum(start.cast("int")).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)).cast("long")


def last_preceding(keys: Sequence[str], order: Sequence[str], cond: Column, value: Column) -> Column:
    """value of the nearest earlier row where cond holds."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(F.when(cond, value), ignorenulls=True).over(w)


def ordered_concat(order: Sequence[str], text: str, separator: str = "") -> Column:
    """Texts of a group in order; groups are documents, pages or blocks."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, text))), lambda x: x[text]), separator)


def band_join(left: DataFrame, right: DataFrame, keys: Sequence[str], band: str, width: int, residual: Column) -> DataFrame:
    """Rows of left and right with equal keys and bands at most `width` apart, by equality on each of
    the bands within reach: a hash join, never a nested loop."""
    near = left.withColumn("_band", F.explode(F.sequence(F.col(band) - width, F.col(band) + width)))
    return near.join(right.withColumn("_band", F.col(band)).drop(band).withColumnRenamed("_band", "_right"), [*[near[k] == right[k] for k in keys], near["_band"] == F.col("_right")]).filter(residual)


def each_row(f: Callable, made: T.DataType, step: int = 256) -> Callable[..., Column]:
    """f over the values of each row (arrays as lists, structs as dicts; null where the first one is null), for groups that
    are an array of a row. `step` rows at a time are Python's objects, however large a batch, and no frame is made."""

    @F.arrow_udf(made)
    def run(*columns: pa.Array) -> pa.Array:
        kind = to_arrow_type(made)
        parts = [pa.array([None if r[0] is None else f(*r) for r in zip(*[c.slice(a, step).to_pylist() for c in columns], strict=True)], kind) for a in range(0, len(columns[0]), step)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return run
