"""Queries of the geometry functions, over lines paired with the page's second region."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from inkspan.functions import geometry as G
from inkspan.plans.registry import query

KEYS = ("doc_id", "line_no")


def LINE():  # noqa: N802
    return G.box("x0", "y0", "x1", "y1")


def OTHER():  # noqa: N802
    return G.box("u0", "v0", "u1", "v1")


def SECOND():  # noqa: N802
    """The second band of the line's page, by formula."""
    return {"u0": F.lit(75.0), "v0": F.lit(74.0) + F.col("doc_id") % 5, "u1": F.lit(500.0), "v1": F.lit(119.0) + F.col("doc_id") % 5}
FROM = "from (select *, 75.0::double u0, 74.0::double + doc_id % 5 v0, 500.0::double u1, 119.0::double + doc_id % 5 v1 from layout_lines)"


def lines(t):
    return t.layout_lines().withColumns(SECOND())


def spread(b, names=("a", "b", "c", "d"), digits=None):
    cut = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return [cut(b[k]).alias(n) for k, n in zip(("x0", "y0", "x1", "y1"), names, strict=True)]


@query("g01_box_shape", f"select doc_id, line_no, line_no % 3 <> 0 as is_box, line_no % 2 = 0 as is_polygon {FROM}")
def _(t):
    values = F.when(F.col("line_no") % 3 == 0, F.array("x0", "y0", "x1")).otherwise(F.array("x0", "y0", "x1", "y1"))
    corner = F.array("x0", "y0")
    corners = F.when(F.col("line_no") % 2 == 0, F.array(corner, corner, corner, corner)).otherwise(F.array(corner, corner, F.array("x0"), corner))
    return lines(t).select(*KEYS, G.is_box(values).alias("is_box"), G.is_polygon(corners).alias("is_polygon"))


@query("g02_box_measures", f"select doc_id, line_no, y1 - y0 as height, x1 - x0 as width, x0 as x_start, y0 as y_start, (x1 - x0) * (y1 - y0) as area {FROM}")
def _(t):
    return lines(t).select(*KEYS, G.height(LINE()).alias("height"), G.width(LINE()).alias("width"), F.col("x0").alias("x_start"), F.col("y0").alias("y_start"), G.area(LINE()).alias("area"))


@query("g03_merge_boxes", f"select doc_id, line_no, least(x0, u0) a, least(y0, v0) b, greatest(x1, u1) c, greatest(y1, v1) d {FROM}")
def _(t):
    return lines(t).select(*KEYS, *spread(G.envelope(LINE(), OTHER())))


@query("g04_boxes_intersect", f"select doc_id, line_no, x0 < u1 and x1 > u0 and y0 < v1 and y1 > v0 as hit, (x0 < u1 and x1 > u0 and y0 < v1 and y1 > v0) or (x0 < 90 and x1 > 0 and y0 < 50 and y1 > 0) as any_hit {FROM}")
def _(t):
    corner = G.box(0.0, 0.0, 90.0, 50.0)
    return lines(t).select(*KEYS, G.intersects(LINE(), OTHER()).alias("hit"), G.intersects_any(LINE(), F.array(OTHER(), corner)).alias("any_hit"))


SHARE = "case when least(x1, u1) < greatest(x0, u0) or least(y1, v1) < greatest(y0, v0) then 0.0 when x1 = x0 then {none} else (least(x1, u1) - greatest(x0, u0)) * (least(y1, v1) - greatest(y0, v0)) / nullif((x1 - x0) * (y1 - y0), 0) end"


@query("g05_intersection_share", f"select doc_id, line_no, round({SHARE.format(none='1.0')}, 9) as share, round({SHARE.format(none='0.0')}, 9) as element_share {FROM}")
def _(t):
    return lines(t).select(*KEYS, F.round(G.overlap_share(LINE(), OTHER()), 9).alias("share"), F.round(G.element_overlap_share(LINE(), OTHER()), 9).alias("element_share"))


@query(
    "g06_intersection_margin",
    f"select doc_id, line_no, ia as area, case when x1 = x0 then 0.0 else round(greatest(0, least(x1, u1 - m) - greatest(x0, u0 + m)) * greatest(0, least(y1, v1 - m) - greatest(y0, v0 + m)) / nullif((x1 - x0) * (y1 - y0), 0), 9) end as share "
    f"from (select *, floor(least(x1 - x0, u1 - u0) * 0.1) m, greatest(0, least(x1, u1) - greatest(x0, u0)) * greatest(0, least(y1, v1) - greatest(y0, v0)) ia {FROM})",
)
def _(t):
    return lines(t).select(*KEYS, G.intersection_area(LINE(), OTHER()).alias("area"), F.round(G.intersection_share(LINE(), OTHER(), 0.1), 9).alias("share"))


@query(
    "g07_should_merge_blocks",
    "select doc_id, page_id, line_id, coalesce(x0 > px0 and abs(y0 - py0) < 15 and abs(y1 - py1) < 15 and abs(x0 - px1) < 15, false) as merged from (select *, lag(x0) over w px0, lag(y0) over w py0, lag(x1) over w px1, lag(y1) over w py1 from (select doc_id, page_id, line_id, x0 + line_id as x0, y0, x0 + line_id + (x1 - x0) / 100 as x1, y1 from layout_lines) window w as (partition by doc_id, page_id order by line_id))",
)
def _(t):
    w = Window.partitionBy("doc_id", "page_id").orderBy("line_id")
    x0 = F.col("x0") + F.col("line_id")
    df = t.layout_lines().select("doc_id", "page_id", "line_id", x0.alias("x0"), "y0", (x0 + (F.col("x1") - F.col("x0")) / 100).alias("x1"), "y1").withColumn("b", LINE())
    df = df.withColumn("p", F.lag("b").over(w))
    return df.select("doc_id", "page_id", "line_id", F.coalesce(G.should_merge(F.col("p"), F.col("b"), 15), F.lit(False)).alias("merged"))


@query("g08_rescale_box", f"select doc_id, line_no, round(x0 / (200.0 / 100), 6) a, round(y0 / (100.0 / 150), 6) b, round(x1 / (200.0 / 100), 6) c, round(y1 / (100.0 / 150), 6) d {FROM}")
def _(t):
    return lines(t).select(*KEYS, *spread(G.rescale(LINE(), G.box(0, 0, 200, 100), G.box(0, 0, 100, 150)), digits=6))


@query(
    "g09_rescale_pixels",
    f"select doc_id, line_no, trunc(x0 * (1000.0 / 768))::int::double a, trunc(y0 * (800.0 / 768))::int::double b, trunc(x1 * (1000.0 / 768))::int::double c, trunc(y1 * (800.0 / 768))::int::double d, round_even(x1 * (1000.0 / 768), 0)::int::double rounded {FROM}",
)
def _(t):
    b = G.rescale_pixels(LINE(), (768, 768), (1000, 800))
    return lines(t).select(*KEYS, *spread(b), G.rescale_pixels(LINE(), (768, 768), (1000, 800), True)["x1"].alias("rounded"))


@query("g10_unnormalize", f"select doc_id, line_no, round(612.0 * (x0 / 1000), 6) a, round(792.0 * (y0 / 1000), 6) b, round_even(x1 / 1000 * 612.0, 1) c, round_even(y1 / 1000 * 792.0, 1) d {FROM}")
def _(t):
    k, u = G.from_thousandths(LINE(), 612, 792), G.from_unit(G.box(F.col("x0") / 1000, F.col("y0") / 1000, F.col("x1") / 1000, F.col("y1") / 1000), 612, 792)
    return lines(t).select(*KEYS, F.round(k["x0"], 6).alias("a"), F.round(k["y0"], 6).alias("b"), u["x1"].alias("c"), u["y1"].alias("d"))


@query("g11_polygon", f"select doc_id, line_no, least(x1, x0) a, least(y1, y0) b, greatest(x1, x0) c, greatest(y1, y0) d, x1 as corner_x, y1 as corner_y {FROM}")
def _(t):
    turned = F.array(F.array("x1", "y1"), F.array("x0", "y1"), F.array("x0", "y0"), F.array("x1", "y0"))
    return lines(t).select(*KEYS, *spread(G.from_polygon(turned)), G.to_polygon(LINE())[2][0].alias("corner_x"), G.to_polygon(LINE())[2][1].alias("corner_y"))


@query("g12_fit_and_round", f"select doc_id, line_no, greatest(least(x0, 300), 75) a, greatest(least(y0, 100), 50) b, greatest(least(x1, 300), 75) c, greatest(least(y1, 100), 50) d, floor(x1 / 8) * 8 as rx, floor(y1 / 8) * 8 as ry {FROM}")
def _(t):
    r = G.floor_to(LINE(), 8.0)
    return lines(t).select(*KEYS, *spread(G.fit(LINE(), G.box(75, 50, 300, 100))), r["x1"].alias("rx"), r["y1"].alias("ry"))


@query(
    "g13_rotate_box",
    f"select doc_id, line_no, case k when 1 then 800 - y1 when 2 then 600 - x1 when 3 then y0 else x0 end a, case k when 1 then x0 when 2 then 800 - y1 when 3 then 600 - x1 else y0 end b, case k when 1 then 800 - y0 when 2 then 600 - x0 when 3 then y1 else x1 end c, case k when 1 then x1 when 2 then 800 - y0 when 3 then 600 - x0 else y1 end d from (select *, line_no % 4 k {FROM})",
)
def _(t):
    return lines(t).select(*KEYS, *spread(G.rotate(LINE(), 90 * (F.col("line_no") % 4), 600, 800)))


@query("g14_line_angle", f"select doc_id, line_no, round(degrees(atan((v1 - y0) / nullif(u1 - x0, 0))), 6) as angle {FROM}")
def _(t):
    c = F.col
    return lines(t).select(*KEYS, F.round(G.line_angle(c("x0"), c("y0"), c("u1"), c("v1")), 6).alias("angle"))


@query(
    "g15_interval_ratios",
    f"select doc_id, line_no, round((least(y1, v1) - greatest(y0, v0)) / least(y1 - y0, v1 - v0), 9) a, round((least(y1, v1) - greatest(y0, v0)) / (greatest(y1 - y0, v1 - v0) + 0.0001), 9) b, round(abs((v1 + v0) / 2 - (y1 + y0) / 2) / greatest(y1 - y0, v1 - v0), 9) c, round((greatest(y1 - y0, v1 - v0) - least(y1 - y0, v1 - v0)) / greatest(y1 - y0, v1 - v0), 9) d {FROM}",
)
def _(t):
    p = [F.col(c) for c in ("y0", "y1", "v0", "v1")]
    return lines(t).select(*KEYS, *[F.round(f(*p), 9).alias(n) for f, n in ((G.line_intersection, "a"), (G.overlap_ratio, "b"), (G.center_offset, "c"), (G.height_difference, "d"))])


@query("g16_envelope_of_lines", "select doc_id, page_id, min(x0) a, min(y0) b, max(x1) c, max(y1) d from layout_lines group by 1, 2")
def _(t):
    return t.layout_lines().groupBy("doc_id", "page_id").agg(F.min("x0").alias("a"), F.min("y0").alias("b"), F.max("x1").alias("c"), F.max("y1").alias("d"))


@query("g17_rank_elements", "select doc_id, page_id, line_id, (row_number() over (partition by doc_id, page_id order by length(line), line_id) - 1)::int as rank from layout_lines")
def _(t):
    w = Window.partitionBy("doc_id", "page_id").orderBy(F.length("line"), "line_id")
    return t.layout_lines().select("doc_id", "page_id", "line_id", (F.row_number().over(w) - 1).alias("rank"))


@query("g18_group_by_aspect", "select doc_id, (x1 - x0) / (y1 - y0) as ratio, string_agg(line_no::varchar, ',' order by line_no) as members from layout_lines group by 1, 2")
def _(t):
    df = t.layout_lines().select("doc_id", ((F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))).alias("ratio"), "line_no")
    return df.groupBy("doc_id", "ratio").agg(F.array_join(F.transform(F.sort_array(F.collect_list("line_no")), lambda x: x.cast("string")), ",").alias("members"))
