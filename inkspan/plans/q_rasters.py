"""Queries of what is found in rasters of pages: text boxes in heatmaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkspan.operators import heatmaps as H
from inkspan.plans.registry import query

PAGE = ("doc_id", "page_id")
WIDTH, HEIGHT = 60, 40


def page_heat(t):
    """A raster a page: two rows of pixels a line, as long as it; every third gap between lines has a bridge."""
    lines = t.spread(t.layout_lines().select(*PAGE, "line_id", F.length("line").alias("n")), *PAGE).groupBy(*PAGE).agg(F.sort_array(F.collect_list(F.struct("line_id", "n"))).alias("l"))

    first = (2 + F.col("doc_id") % 3).cast("int")
    # A row of pixels is one literal, not an expression a pixel.
    row = lambda heat: F.split(F.lit(",".join(repr(heat(x)) for x in range(WIDTH))), ",").cast("array<double>")
    blank = row(lambda x: 0.05)
    upto = lambda row, n: F.slice(row, F.lit(1), n)
    beyond = lambda row, n: F.slice(row, n + 1, F.lit(WIDTH))

    # A line's rows of pixels are equal, as are its gap's; each is put together of stretches of constant rows.
    def rows(k):
        n = F.get("l", F.lit(k))["n"]
        bright = row(lambda x: 0.9 - 0.1 * ((x + k) % 4))
        end = F.least(F.lit(58), F.lit(3) + F.floor(n / 8).cast("int"))
        text = F.when(n.isNotNull() & (end > first), F.concat(upto(blank, first), F.slice(bright, first + 1, F.greatest(end - first, F.lit(0))), beyond(blank, end))).otherwise(blank)
        bridged = row(lambda x: 0.5 if x == 12 + k else 0.05)
        gap = F.when((F.col("doc_id") + F.col("page_id") + k) % 3 == 0, bridged).otherwise(blank)
        return F.array(gap, text)

    raster = F.flatten(F.transform(F.array(*[rows(k) for k in range(HEIGHT // 5)]), lambda p: F.array(p[0], p[1], p[1], p[0], p[0])))
    return lines.select(*PAGE, raster.alias("heat"))


COMPONENTS = f""",
px as materialized (
  select p.doc_id, p.page_id, x::int as x, y::int as y,
    case when l.line is not null and y % 5 in (1, 2) and x >= 2 + p.doc_id % 3 and x <= least(57, 2 + length(l.line) // 8) then 0.9::double - 0.1::double * ((x + y // 5) % 4)
      when y % 5 in (0, 3, 4) and x = 12 + y // 5 and (p.doc_id + p.page_id + y // 5) % 3 = 0 then 0.5::double else 0.05::double end as v
  from (select distinct doc_id, page_id from layout_lines) p cross join range({WIDTH}) a(x) cross join range({HEIGHT}) b(y)
    left join layout_lines l on l.doc_id = p.doc_id and l.page_id = p.page_id and l.line_id = y // 5),
th as (
  select doc_id, page_id, least(greatest({H.BLANK}::double * sqrt(least(avg(v) / {H.TYPICAL}::double, 1)), {H.BLANK_BOUNDS[0]}), {H.BLANK_BOUNDS[1]}) as blank
  from (select *, row_number() over (partition by doc_id, page_id order by v desc) as k from px) where k <= {WIDTH * HEIGHT // 10} group by all),
hot as (
  select doc_id, page_id, x, y, v, x - row_number() over (partition by doc_id, page_id, y order by x) as island
  from px join th using (doc_id, page_id) where v > blank),
runs as materialized (
  select *, (row_number() over (partition by doc_id, page_id order by y, x0) - 1)::int as run
  from (select doc_id, page_id, y, min(x) as x0, max(x) as x1, count(*) as n, max(v) as peak, sum(v) as total from hot group by doc_id, page_id, y, island)),
near as materialized (
  select a.doc_id, a.page_id, a.run as one, b.run as two from runs a join runs b using (doc_id, page_id)
  where b.y in (a.y - 1, a.y + 1) and a.x0 <= b.x1 and b.x0 <= a.x1),
reach as (
  with recursive r as (
    select doc_id, page_id, run, run as other from runs
    union
    select r.doc_id, r.page_id, r.run, n.two from r join near n on n.doc_id = r.doc_id and n.page_id = r.page_id and n.one = r.other)
  select * from r),
parts as (select doc_id, page_id, run, min(other) as component from reach group by all)
select doc_id, page_id, component, sum(n)::bigint as size, min(x0) as x, min(y) as y, max(x1) - min(x0) + 1 as w, max(y) - min(y) + 1 as h,
  round(max(peak), 6) as peak, round(sum(total) / sum(n), 6) as mean
from runs join parts using (doc_id, page_id, run) group by doc_id, page_id, component
"""


@query("m01_heatmap_components", COMPONENTS)
def _(t):
    return H.components(page_heat(t)).withColumns({"peak": F.round("peak", 6), "mean": F.round("mean", 6)})


@query("m01_detected_boxes")
def _(t):
    """Boxes of every page's raster at page size; held against flood fill pixel by pixel in the tests."""
    boxes = H.placed_boxes(H.detected_boxes(page_heat(t)), (WIDTH, HEIGHT), (600, 800))
    return boxes.select(*PAGE, "box_no", "box.*", F.round("confidence", 6).alias("confidence"))
