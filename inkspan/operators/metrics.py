"""Layout metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkspan.functions import geometry as G
from inkspan.operators.relational import with_page_items

BOX = ("x0", "y0", "x1", "y1")


def coverage(boxes: DataFrame, others: DataFrame, penalty: bool = False) -> DataFrame:
    """boxes with `cover`: the share of each box's area that others of its page cover, 1 at most. With a
    penalty, the number of further overlapping boxes is taken off the covered area."""
    b = G.box(*BOX)
    areas = F.transform("_others", lambda o: G.intersection_area(b, G.box(o["x0"], o["y0"], o["x1"], o["y1"])))
    total = F.aggregate(areas, F.lit(0.0), lambda a, v: a + v)
    if penalty:
        total = F.greatest(F.lit(0.0), total - F.greatest(F.size(F.filter(areas, lambda a: a > 0)) - 1, F.lit(0)))
    out = with_page_items(boxes, others, BOX, name="_others")
    return out.withColumn("cover", F.when(G.area(b) == 0, 0.0).otherwise(F.least(F.lit(1.0), F.try_divide(total, G.area(b))))).drop("_others")


def share_covered(covered: DataFrame, name: str, threshold: float = 0.5) -> DataFrame:
    """Precision of predictions, or recall of references, by page."""
    return covered.groupBy("doc_id", "page_id").agg(F.avg(F.when(F.col("cover") > threshold, 1.0).otherwise(0.0)).alias(name))


def rank_accuracy(ranks: DataFrame) -> DataFrame:
    """(doc_id, page_id, accuracy): the share of ordered pairs of a page's items (item, predicted,
    reference) on whose order both ranks agree. A page's items are one array; no pair is a row."""
    items = ranks.groupBy("doc_id", "page_id").agg(F.collect_list(F.struct("item", "predicted", "reference")).alias("v"))
    agree = F.flatten(F.transform("v", lambda a: F.transform(F.filter("v", lambda b: b["item"] != a["item"]), lambda b: ((a["predicted"] < b["predicted"]) == (a["reference"] < b["reference"])).cast("int"))))
    return items.filter(F.size("v") > 1).select("doc_id", "page_id", (F.aggregate(agree, F.lit(0), lambda a, v: a + v) / F.size(agree)).alias("accuracy"))


def dynamic_threshold(values: DataFrame, share: float = 0.1, scale: float = 0.6, low: float = 0.1, high: float = 1.0) -> DataFrame:
    """(doc_id, threshold) from (doc_id, value, pos): the mean of the top share of values, scaled and clipped."""
    w = Window.partitionBy("doc_id")
    top = values.withColumns({"r": F.row_number().over(w.orderBy(F.desc("value"), "pos")), "n": F.count("*").over(w)}).filter(F.col("r") <= F.greatest(F.lit(1), F.ceil(F.col("n") * share)))
    return top.groupBy("doc_id").agg(F.round(F.least(F.lit(high), F.greatest(F.lit(low), F.avg("value") * scale)), 6).alias("threshold"))
