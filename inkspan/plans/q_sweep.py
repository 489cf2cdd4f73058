"""Queries of exact areas: what boxes cover once and twice."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkspan.operators import sweep as W
from inkspan.plans.registry import query

PAGE = ("doc_id", "page_id")


def small(df, shift):
    """Boxes at an eighth of their size, some edges between whole numbers."""
    cut = lambda c: F.floor(F.col(c) / 8) + F.when(F.col("doc_id") % 4 == shift, 0.5).otherwise(0.0)
    return df.select(*PAGE, *[x for x in ("region_id", "line_id") if x in df.columns], *[cut(c).alias(c) for c in W.BOX])


def regions(t):
    return small(t.regions(), 1)


def lines(t):
    """Lines of text, a page's width at most, and each again further down, so that some lie on others."""
    df = t.layout_lines().withColumn("x1", F.least("x1", F.lit(520.0)))
    return small(df.unionByName(df.withColumns({"y0": F.col("y0") + 5, "y1": F.col("y1") + 9})), 2)


#: Boxes as pixel sets.
PIXELS = """,
r as (
  select doc_id, page_id, region_id, floor(x0 / 8) + o as x0, floor(y0 / 8) + o as y0, floor(x1 / 8) + o as x1, floor(y1 / 8) + o as y1
  from (select *, case when doc_id % 4 = 1 then 0.5::double else 0.0::double end as o from regions)),
l as (
  select doc_id, page_id, line_id, floor(x0 / 8) + o as x0, floor(y0 / 8) + o as y0, floor(x1 / 8) + o as x1, floor(y1 / 8) + o as y1
  from (
    select doc_id, page_id, line_id, x0, y0 + 5 * k as y0, least(x1, 520) as x1, y1 + 9 * k as y1, case when doc_id % 4 = 2 then 0.5::double else 0.0::double end as o
    from layout_lines cross join range(2) t(k))),
meets as (
  select r.doc_id, r.page_id, r.region_id, trunc(greatest(r.x0, l.x0))::int as a, trunc(least(r.x1, l.x1))::int as b,
    trunc(greatest(r.y0, l.y0))::int as c, trunc(least(r.y1, l.y1))::int as d
  from r join l using (doc_id, page_id) where least(r.x1, l.x1) >= greatest(r.x0, l.x0) and least(r.y1, l.y1) >= greatest(r.y0, l.y0)),
px as (select doc_id, page_id, region_id, x, unnest(range(c, d)) as y from (select *, unnest(range(a, b)) as x from meets)),
sets as (
  select doc_id, page_id, region_id, count(*)::double as covered, count(*) filter (where n > 1)::double as twice
  from (select doc_id, page_id, region_id, x, y, count(*) as n from px group by all) group by all),
others as (select doc_id, page_id, count(*) as n from l group by all),
cover as (
  select r.doc_id, r.page_id, r.region_id, coalesce(covered, 0) as covered, coalesce(twice, 0) as twice,
    greatest(0, coalesce(covered, 0) - coalesce(n, 0)) / ((x1 - x0) * (y1 - y0)) as cover
  from r left join sets using (doc_id, page_id, region_id) left join others using (doc_id, page_id))
"""


@query("b01_exact_coverage", PIXELS + "select doc_id, page_id, region_id, covered, twice, round(cover, 9) as cover from cover")
def _(t):
    df = W.exact_coverage(regions(t), lines(t).select(*PAGE, *W.BOX), penalty=True)
    return df.select(*PAGE, "region_id", "covered", "twice", F.round("cover", 9).alias("cover"))


@query(
    "b02_exact_precision_recall",
    PIXELS
    + """,
back as (
  select l.doc_id, l.page_id, l.k, trunc(greatest(r.x0, l.x0))::int as a, trunc(least(r.x1, l.x1))::int as b, trunc(greatest(r.y0, l.y0))::int as c, trunc(least(r.y1, l.y1))::int as d
  from (select *, row_number() over () as k from l) l join r using (doc_id, page_id) where least(r.x1, l.x1) >= greatest(r.x0, l.x0) and least(r.y1, l.y1) >= greatest(r.y0, l.y0)),
backs as (select k, count(distinct x * 10000 + y)::double as n from (select k, x, unnest(range(c, d)) as y from (select *, unnest(range(a, b)) as x from back)) group by all),
recall as (
  select doc_id, page_id, avg((case when (x1 - x0) * (y1 - y0) = 0 then 0 else coalesce(n, 0) / ((x1 - x0) * (y1 - y0)) end > 0.5)::int) as recall
  from (select *, row_number() over () as k from l) left join backs using (k) group by all)
select doc_id, page_id, round(avg((cover > 0.5)::int), 9) as precision, round(any_value(recall), 9) as recall from cover join recall using (doc_id, page_id) group by all
""",
)
def _(t):
    df = W.exact_precision_recall(regions(t), lines(t))
    return df.select(*PAGE, F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@query(
    "u03_page_areas",
    PIXELS
    + """,
whole as (
  select doc_id, page_id, trunc(x0)::int as a, trunc(y0)::int as b, trunc(x1)::int as c, trunc(y1)::int as d from r
  union all select doc_id, page_id, trunc(x0)::int, trunc(y0)::int, trunc(x1)::int, trunc(y1)::int from l),
each as (select doc_id, page_id, x, unnest(range(b, d)) as y from (select *, unnest(range(a, c)) as x from whole))
select doc_id, page_id, count(*)::double as covered, count(*) filter (where n > 1)::double as twice
from (select doc_id, page_id, x, y, count(*) as n from each group by all) group by all
""",
)
def _(t):
    return W.page_areas(regions(t).select(*PAGE, *W.BOX).unionByName(lines(t).select(*PAGE, *W.BOX)))
