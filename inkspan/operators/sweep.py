"""Areas of unions of boxes, and of what lies under two or more of them, by a plane sweep.

Edges cut the plane into strips; within a strip the boxes that cross it are intervals, and one pass over them in order
measures what they cover once and twice. Work and memory go with boxes (a page's), never with pixels. For whole
numbers the areas are those of pixel sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspan.operators.relational import PAGE, with_page_items

BOX = ("x0", "y0", "x1", "y1")


def covered_areas(boxes: Column) -> Column:
    """Struct (once, twice): the area under at least one, and at least two, of an array of boxes (x0..y1). Boxes without
    an inside count for nothing."""
    solid = F.filter(boxes, lambda b: (b["x1"] > b["x0"]) & (b["y1"] > b["y0"]))

    def of_strip(items: Column, left: Column, right: Column) -> Column:
        crossing = F.filter(items, lambda b: (b["x0"] <= left) & (b["x1"] >= right))
        # In the order of their beginnings; `far` is the furthest end so far, `near` the furthest that two have reached.
        zero = F.lit(0.0)
        start = F.struct(F.lit(None).cast("double").alias("far"), F.lit(None).cast("double").alias("near"), zero.alias("once"), zero.alias("twice"))

        def add(s: Column, b: Column) -> Column:
            low, high = b["y0"], b["y1"]
            once = F.greatest(zero, high - F.greatest(low, s["far"]))  # greatest and least pass over nulls
            twice = F.when(s["far"].isNull(), zero).otherwise(F.greatest(zero, F.least(high, s["far"]) - F.greatest(low, s["near"])))
            near = F.when(s["far"].isNull(), s["near"]).otherwise(F.greatest(s["near"], F.least(high, s["far"])))
            return F.struct(F.greatest(s["far"], high).alias("far"), near.alias("near"), (s["once"] + once).alias("once"), (s["twice"] + twice).alias("twice"))

        return F.aggregate(crossing, start, add, lambda s: F.struct(((right - left) * s["once"]).alias("once"), ((right - left) * s["twice"]).alias("twice")))

    def swept(items: Column) -> Column:
        edges = F.array_sort(F.array_distinct(F.concat(F.transform(items, lambda b: b["x0"]), F.transform(items, lambda b: b["x1"]))))
        strips = lambda e: F.transform(F.slice(e, 2, F.greatest(F.size(e) - 1, F.lit(0))), lambda right, i: of_strip(items, F.get(e, i), right))
        areas = F.transform(F.array(edges), strips)[0]
        total = F.struct(F.lit(0.0).alias("once"), F.lit(0.0).alias("twice"))
        return F.aggregate(areas, total, lambda s, a: F.struct((s["once"] + a["once"]).alias("once"), (s["twice"] + a["twice"]).alias("twice")))

    ordered = F.array_sort(F.transform(solid, lambda b: F.struct(*[b[c].cast("double").alias(c) for c in ("y0", "x0", "x1", "y1")])))
    return F.transform(F.array(ordered), swept)[0]


def clipped(box: Column, others: Column, whole: bool = True) -> Column:
    """What others have in common with a box; with `whole`, edges cut to whole numbers (towards zero), as pixels are."""
    edge = (lambda v: v.cast("long").cast("double")) if whole else (lambda v: v.cast("double"))
    high, low = F.greatest, F.least
    meets = lambda o: (low(box["x1"], o["x1"]) >= high(box["x0"], o["x0"])) & (low(box["y1"], o["y1"]) >= high(box["y0"], o["y0"]))
    common = lambda o: F.struct(*[edge(pick(box[c], o[c])).alias(c) for c, pick in (("x0", high), ("y0", high), ("x1", low), ("y1", low))])
    return F.transform(F.filter(others, meets), common)


def exact_coverage(boxes: DataFrame, others: DataFrame, penalty: bool = False) -> DataFrame:
    """boxes with `covered` and `twice` (pixels under one, and two, of the page's other boxes) and `cover`, the covered share of
    its area, not bounded by 1 where edges are no whole numbers. With a penalty, as many pixels as there are other
    boxes are taken off what is covered, wherever they lie. A box without area has a share of 0."""
    own = F.struct(*BOX)
    df = with_page_items(boxes, others, BOX, name="_others")
    df = df.withColumn("_a", covered_areas(clipped(own, F.col("_others"))))
    off = F.size("_others") if penalty else F.lit(0)
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    cover = F.when(area == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.col("_a.once") - off) / F.when(area != 0, area))
    return df.select(*boxes.columns, F.col("_a.once").alias("covered"), F.col("_a.twice").alias("twice"), cover.alias("cover"))


def exact_precision_recall(predictions: DataFrame, references: DataFrame, threshold: float = 0.5, penalty: bool = True) -> DataFrame:
    """(doc_id, page_id, precision, recall) of the pages that have boxes of either kind: the shares of predictions, and of
    references, that the other kind covers by more than the threshold. A penalty is for predictions alone. A
    page without references has 1 for both, one without predictions 0."""
    share = lambda df, other, off, name: exact_coverage(df.select(*PAGE, *BOX), other, off).groupBy(*PAGE).agg(F.avg((F.col("cover") > threshold).cast("double")).alias(name))
    both = share(predictions, references, penalty, "precision").join(share(references, predictions, False, "recall"), list(PAGE), "full")
    none = F.when(F.col("recall").isNull(), 1.0).when(F.col("precision").isNull(), 0.0)
    return both.select(*PAGE, F.coalesce(none, "precision").alias("precision"), F.coalesce(none, "recall").alias("recall"))


def page_areas(boxes: DataFrame) -> DataFrame:
    """(doc_id, page_id, covered, twice): pixels that a page's boxes cover, and that two of them do. Edges are cut to whole
    numbers."""
    whole = [F.col(c).cast("long").cast("double").alias(c) for c in BOX]
    areas = boxes.groupBy(*PAGE).agg(covered_areas(F.collect_list(F.struct(*whole))).alias("a"))
    return areas.select(*PAGE, F.col("a.once").alias("covered"), F.col("a.twice").alias("twice"))
