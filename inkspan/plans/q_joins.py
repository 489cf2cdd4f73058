"""Queries of the join rules, between lines and regions of pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from inkspan.functions import geometry as G
from inkspan.operators import relational as R
from inkspan.plans.registry import query

BOX = ("x0", "y0", "x1", "y1")


def LINE():  # noqa: N802
    return G.box(*BOX)


KEYS = ("doc_id", "page_id", "line_id")
SHARE = "(case when least(l.x1, r.x1) < greatest(l.x0, r.x0) or least(l.y1, r.y1) < greatest(l.y0, r.y0) then 0.0 when l.x1 = l.x0 then 1.0 else (least(l.x1, r.x1) - greatest(l.x0, r.x0)) * (least(l.y1, r.y1) - greatest(l.y0, r.y0)) / ((l.x1 - l.x0) * (l.y1 - l.y0)) end)"
PAIRS = f"pairs as (select l.*, r.region_id, r.label, {SHARE} as share from layout_lines l join regions r using (doc_id, page_id))"


def item_box(x):
    return G.box(x["x0"], x["y0"], x["x1"], x["y1"])


def lines_with_regions(t, lines=None):
    return R.with_page_items(lines if lines is not None else t.layout_lines(), t.regions(), ("region_id", "label", *BOX))


def share(x):
    return G.overlap_share(LINE(), item_box(x))


@query("j01_line_region_argmax", f", {PAIRS} select doc_id, page_id, line_id, region_id, round(share, 9) share from pairs where share > 0 qualify row_number() over (partition by doc_id, page_id, line_id order by share desc, region_id) = 1")
def _(t):
    df = lines_with_regions(t).withColumn("b", R.best(F.col("items"), share, lambda s: s > 0)).filter("b is not null")
    return df.select(*KEYS, F.col("b.item.region_id").alias("region_id"), F.round("b.score", 9).alias("share"))


@query("j01_overlap_by_document", f", {PAIRS} select doc_id, round(avg(share), 9) as share from (select * from pairs where share > 0 qualify row_number() over (partition by doc_id, page_id, line_id order by share desc, region_id) = 1) group by 1")
def _(t):
    df = lines_with_regions(t).withColumn("b", R.best(F.col("items"), share, lambda s: s > 0)).filter("b is not null")
    return df.groupBy("doc_id").agg(F.round(F.avg("b.score"), 9).alias("share"))


@query("j02_line_region_threshold", f", {PAIRS} select doc_id, page_id, line_id, region_id from pairs where share > 0.5")
def _(t):
    hit = F.filter("items", lambda x: share(x) > 0.5)
    return lines_with_regions(t).select(*KEYS, F.explode(hit).alias("r")).select(*KEYS, "r.region_id")


@query("j03_block_label", f", {PAIRS}, b as (select doc_id, page_id, line_id, label from pairs where share > 0 qualify row_number() over (partition by doc_id, page_id, line_id order by share desc, region_id) = 1) select doc_id, page_id, line_id, coalesce(b.label, 'text') as label from layout_lines left join b using (doc_id, page_id, line_id)")
def _(t):
    b = R.best(F.col("items"), share, lambda s: s > 0)
    return lines_with_regions(t).select(*KEYS, F.coalesce(b["item"]["label"], F.lit("text")).alias("label"))


@query(
    "j04_order_boxes",
    f", {PAIRS}, b as (select doc_id, page_id, line_id, 2 - region_id as pos from pairs where share > 0 and region_id <> 1 qualify row_number() over (partition by doc_id, page_id, line_id order by share desc, region_id) = 1) select doc_id, page_id, line_id, coalesce(pos, coalesce(max(pos) over (partition by doc_id, page_id), -1) + row_number() over (partition by doc_id, page_id, pos is null order by line_id))::bigint as position from layout_lines left join b using (doc_id, page_id, line_id)",
)
def _(t):
    order = t.regions().filter("region_id <> 1")
    df = R.with_page_items(t.layout_lines(), order, ("region_id", *BOX)).withColumn("pos", 2 - R.best(F.col("items"), share, lambda s: s > 0)["item"]["region_id"])
    page = Window.partitionBy("doc_id", "page_id")
    rest = F.coalesce(F.max("pos").over(page), F.lit(-1)) + F.row_number().over(Window.partitionBy("doc_id", "page_id", F.col("pos").isNull()).orderBy("line_id"))
    return df.select(*KEYS, F.coalesce("pos", rest).cast("long").alias("position"))


@query("j05_positional_zip", "select l.doc_id, l.page_id, l.line_id, r.label from layout_lines l join regions r on l.doc_id = r.doc_id and l.page_id = r.page_id and l.line_id = r.region_id where l.line_id < 255")
def _(t):
    r = t.regions().select("doc_id", "page_id", F.col("region_id").alias("line_id"), "label")
    return t.layout_lines().filter("line_id < 255").select(*KEYS).join(r, list(KEYS))


@query("j06_cell_text", f", {PAIRS} select doc_id, page_id, region_id, string_agg(line, ' ' order by line_id) as text from pairs where share >= 0.3 group by 1, 2, 3")
def _(t):
    hit = F.filter("items", lambda x: share(x) >= 0.3)
    df = lines_with_regions(t).select(*KEYS, "line", F.explode(hit).alias("r")).select(*KEYS, "line", "r.region_id")
    return df.groupBy("doc_id", "page_id", "region_id").agg(R.ordered_concat(["line_id"], "line", " ").alias("text"))


#: Lines and regions once each; a cell takes its glyphs where it has one, else all that lies in it.
TABLE_CELLS = """,
ll as materialized (select doc_id, page_id, line_id, line, x0, y0, x1, y1 from layout_lines),
rr as materialized (select doc_id, page_id, region_id, x0, y0, x1, y1 from regions),
hit as (
  select r.doc_id, r.page_id, r.region_id, line_id, line, r.doc_id % 3 = 0 or line_id % 2 = 0 as is_char
  from rr r join ll l using (doc_id, page_id)
  where case when least(l.x1, r.x1) < greatest(l.x0, r.x0) or least(l.y1, r.y1) < greatest(l.y0, r.y0) then 0.0 when l.x1 = l.x0 then 1.0
    else (least(l.x1, r.x1) - greatest(l.x0, r.x0)) * (least(l.y1, r.y1) - greatest(l.y0, r.y0)) / ((l.x1 - l.x0) * (l.y1 - l.y0)) end >= 0.3),
t as (
  select doc_id, page_id, region_id, string_agg(line, '' order by line_id) filter (where is_char) as chars, string_agg(line, '' order by line_id) as whole
  from hit group by 1, 2, 3)
select doc_id, page_id, region_id as cell_id, coalesce(chars, whole, '') as text from rr left join t using (doc_id, page_id, region_id)
"""


@query("j06_table_cells", TABLE_CELLS)
def _(t):
    """Regions as cells of a table whose picture begins 20 pixels in and is turned by a quarter, at two pixels a point."""
    quarter = G.box(2 * F.col("y0") - 20, 1200 - (2 * F.col("x1") - 20), 2 * F.col("y1") - 20, 1200 - (2 * F.col("x0") - 20))
    cells = t.regions().select("doc_id", "page_id", F.lit(0).alias("table_id"), F.col("region_id").alias("cell_id"), quarter.alias("box"), F.lit(90).alias("turned"), F.lit(900.0).alias("w"), F.lit(1200.0).alias("h"), F.lit(20.0).alias("x"), F.lit(20.0).alias("y"))
    glyphs = t.layout_lines().select("doc_id", "page_id", F.lit(0).alias("table_id"), F.col("line_id").alias("pos"), F.col("line").alias("text"), ((F.col("doc_id") % 3 == 0) | (F.col("line_id") % 2 == 0)).alias("is_char"), LINE().alias("box"))
    return R.cell_texts(cells, glyphs, G.box(0, 0, 600, 800), G.box(0, 0, 1200, 1600)).drop("table_id")


FORMULAS = "f as (select * from regions where label in ('formula', 'figure'))"


@query("j07_formula_regions", f", {FORMULAS}, hit as (select distinct l.doc_id, l.page_id, l.line_id from layout_lines l join f r using (doc_id, page_id) where {SHARE} > 0.7) select l.doc_id, l.page_id, l.line_id from layout_lines l anti join hit h using (doc_id, page_id, line_id)")
def _(t):
    df = R.with_page_items(t.layout_lines(), t.regions().filter(F.col("label").isin("formula", "figure")), BOX)
    return df.filter(~F.exists("items", lambda x: share(x) > 0.7)).select(*KEYS)


NEAREST = "select r.doc_id, r.page_id, r.region_id, l.line_id from f r join layout_lines l using (doc_id, page_id) qualify row_number() over (partition by r.doc_id, r.page_id, r.region_id order by (l.x0 - r.x0) * (l.x0 - r.x0) + (l.y0 - r.y0) * (l.y0 - r.y0), l.line_id) = 1"


@query("j07_insert_points", f", {FORMULAS}, hit as (select l.doc_id, l.page_id, r.region_id, min(l.line_id) as line_id, string_agg(l.line, ' ' order by l.line_id) as text from layout_lines l join f r using (doc_id, page_id) where {SHARE} > 0.7 group by 1, 2, 3), near as ({NEAREST}) select n.doc_id, n.page_id, n.region_id, coalesce(h.line_id, n.line_id) as line_id, coalesce(h.text, '') as text from near n left join hit h using (doc_id, page_id, region_id)")
def _(t):
    found = t.regions().filter(F.col("label").isin("formula", "figure"))
    return R.insert_points(found, t.layout_lines(), lambda region, x: G.overlap_share(item_box(x), region)).select("doc_id", "page_id", "region_id", "line_id", "text")


TITLES = "t as (select * from regions where label in ('doc_title', 'text_title'))"


@query(
    "j08_heading_split",
    f", {TITLES}, h as (select l.doc_id, l.page_id, l.line_id, bool_or(r.region_id is not null and {SHARE} > 0.7) as heading from layout_lines l left join t r using (doc_id, page_id) group by 1, 2, 3), s as (select *, heading or lag(heading, 1, true) over (partition by doc_id, page_id order by line_id) as start from h) select doc_id, page_id, line_id, heading, sum(start::int) over (partition by doc_id, page_id order by line_id)::bigint as block_id from s",
)
def _(t):
    df = R.with_page_items(t.layout_lines(), t.regions().filter(F.col("label").isin("doc_title", "text_title")), BOX)
    df = df.select(*KEYS, F.exists("items", lambda x: share(x) > 0.7).alias("heading"))
    df = df.withColumn("start", F.col("heading") | F.lag("heading", 1, True).over(Window.partitionBy("doc_id", "page_id").orderBy("line_id")))
    return df.select(*KEYS, "heading", R.islands(("doc_id", "page_id"), ("line_id",), F.col("start")).alias("block_id"))


@query("j09_nearest_block", "select r.doc_id, r.page_id, r.region_id, l.line_id from regions r join layout_lines l using (doc_id, page_id) qualify row_number() over (partition by r.doc_id, r.page_id, r.region_id order by (l.x0 - r.x0) * (l.x0 - r.x0) + (l.y0 - r.y0) * (l.y0 - r.y0), l.line_id) = 1")
def _(t):
    df = R.with_page_items(t.regions(), t.layout_lines(), ("line_id", *BOX))
    near = R.best(F.col("items"), lambda x: -((x["x0"] - F.col("x0")) ** 2 + (x["y0"] - F.col("y0")) ** 2))
    return df.select("doc_id", "page_id", "region_id", F.coalesce(near["item"]["line_id"], F.lit(0)).alias("line_id"))


@query(
    "j10_line_coverage",
    f"select doc_id, page_id, count(*) as total, sum((s > 0.5)::int)::bigint as found, sum((s > 0.5)::int) / count(*) > 0.4 as covered from (select r.doc_id, r.page_id, r.region_id, sum({SHARE.replace('l.', 'q.').replace('r.', 'l.').replace('q.', 'r.')}) s from regions r join layout_lines l using (doc_id, page_id) group by 1, 2, 3) group by 1, 2",
)
def _(t):
    df = R.with_page_items(t.regions(), t.layout_lines(), BOX)
    found = F.count_if(G.covered_over(LINE(), F.col("items"), 0.5))
    return df.groupBy("doc_id", "page_id").agg(F.count("*").alias("total"), found.alias("found"), (found / F.count("*") > 0.4).alias("covered"))


@query("j11_anti_by_id", "select doc_id, page_id, line_id from layout_lines where (doc_id, line) not in (select doc_id, line from layout_lines group by 1, 2 having count(*) > 1)")
def _(t):
    bad = t.layout_lines().groupBy("doc_id", "line").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", "line")
    return t.layout_lines().join(bad, ["doc_id", "line"], "left_anti").select(*KEYS)


@query("j12_filter_labels", "select doc_id, page_id, region_id, label from regions where label not in ('header', 'footer', 'figure')")
def _(t):
    return t.regions().filter(~F.col("label").isin("header", "footer", "figure")).select("doc_id", "page_id", "region_id", "label")


@query("j13_fuzzy_titles")
def _(t):
    from inkspan.operators.phrases import common_titles

    return common_titles(t.spread(t.doc_lines(), "doc_id").select("doc_id", "line_no", F.col("line").alias("title")))


TABLES = "tb as (select doc_id, page_id, line_id, string_split(line, ' ')[1] as id from layout_lines where line_id = 0 and length(string_split(line, ' ')[1]) > 2)"


@query("j16_table_references", f", {TABLES} select t.doc_id, t.page_id as table_page, p.page_id, p.line_id, instr(p.line, t.id) - 1 as start from tb t join layout_lines p on p.doc_id = t.doc_id and abs(p.page_id - t.page_id) <= 1 and contains(p.line, t.id)")
def _(t):
    tables = t.layout_lines().filter("line_id = 0").select("doc_id", F.col("page_id").alias("table_page"), F.split("line", " ").getItem(0).alias("id")).filter("length(id) > 2")
    near = tables.withColumn("page_id", F.explode(F.sequence(F.col("table_page") - 1, F.col("table_page") + 1)))
    df = near.join(t.layout_lines().select("doc_id", "page_id", "line_id", "line"), ["doc_id", "page_id"]).filter(F.contains("line", "id"))
    return df.select("doc_id", "table_page", "page_id", "line_id", (F.instr("line", F.col("id")) - 1).cast("long").alias("start"))


@query("j17_contained_boxes", "select doc_id, page_id, line_id from layout_lines l where not exists (select 1 from layout_lines o where o.doc_id = l.doc_id and o.page_id = l.page_id and o.line_id <> l.line_id and o.x0 <= l.x0 and o.y0 - 20 <= l.y0 and o.x1 >= l.x1 and o.y1 + 20 >= l.y1 and o.x1 > l.x1)")
def _(t):
    df = R.with_page_items(t.layout_lines(), t.layout_lines(), ("line_id", *BOX))
    c = F.col
    inside = lambda o: (o["line_id"] != c("line_id")) & (o["x0"] <= c("x0")) & (o["y0"] - 20 <= c("y0")) & (o["x1"] >= c("x1")) & (o["y1"] + 20 >= c("y1")) & (o["x1"] > c("x1"))
    return df.filter(~F.exists("items", inside)).select(*KEYS)


@query(
    "j18_join_lines",
    "select l.doc_id, l.page_id, l.line_id, min(least(l.x0, o.x0)) x0, min(least(l.y0, o.y0)) y0, max(greatest(l.x1, o.x1)) x1, max(greatest(l.y1, o.y1)) y1 from layout_lines l join layout_lines o on o.doc_id = l.doc_id and o.page_id = l.page_id and (o.line_id = l.line_id or (o.x0 >= l.x0 and o.x1 <= l.x1 and abs(o.y0 - l.y1) <= 5)) group by 1, 2, 3",
)
def _(t):
    df = R.with_page_items(t.layout_lines(), t.layout_lines(), ("line_id", *BOX))
    c = F.col
    joined = F.filter("items", lambda o: (o["line_id"] == c("line_id")) | ((o["x0"] >= c("x0")) & (o["x1"] <= c("x1")) & (F.abs(o["y0"] - c("y1")) <= 5)))
    edge = lambda f, n: f(F.transform(joined, lambda o: o[n])).alias(n)
    return df.select(*KEYS, edge(F.array_min, "x0"), edge(F.array_min, "y0"), edge(F.array_max, "x1"), edge(F.array_max, "y1"))


@query("j21_dictionary_phrases", ", g as (select doc_id, line_no, unnest(range(1, len(ws) + 1)) i, ws from (select doc_id, line_no, string_split(lower(line), ' ') ws from doc_lines)), n as (select doc_id, line_no, i - 1 as pos, unnest([ws[i], ws[i] || ' ' || ws[i + 1]]) as phrase from g), d as (select * from (values ('of the', 'phrase'), ('the', 'article'), ('der', 'article'), ('de la', 'phrase'), ('license', 'legal')) v(phrase, tag)) select doc_id, line_no, pos::int as pos, phrase, tag from n join d using (phrase)")
def _(t):
    from inkspan.operators.phrases import phrase_join

    d = t.spark.createDataFrame([("of the", "phrase"), ("the", "article"), ("der", "article"), ("de la", "phrase"), ("license", "legal")], "phrase string, tag string")
    return phrase_join(t.doc_lines(), d, ("doc_id", "line_no"), "line", 2)


@query("u01_union_of_ids", "select doc_id, page_id, line_id, count(*) as times from (select doc_id, page_id, line_id from layout_lines where line_id < 2 union all select doc_id, page_id, line_id from layout_lines where line_id % 3 = 0) group by 1, 2, 3")
def _(t):
    a, b = t.layout_lines().filter("line_id < 2").select(*KEYS), t.layout_lines().filter("line_id % 3 = 0").select(*KEYS)
    return a.unionAll(b).groupBy(*KEYS).agg(F.count("*").alias("times"))


@query("u02_unique_languages", "select source, string_agg(lang, ',' order by lang) as langs from (select distinct source, lang from documents where lang is not null) group by 1")
def _(t):
    return t.read("documents").groupBy("source").agg(F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("langs"))


@query("u03_pixel_sets", "select l.doc_id, l.page_id, l.line_id, r.region_id, greatest(0, least(floor(l.x1), floor(r.x1)) - greatest(floor(l.x0), floor(r.x0)))::bigint * greatest(0, least(floor(l.y1), floor(r.y1)) - greatest(floor(l.y0), floor(r.y0)))::bigint as common from layout_lines l join regions r using (doc_id, page_id)")
def _(t):
    low = lambda b: G.box(F.floor(b["x0"]), F.floor(b["y0"]), F.floor(b["x1"]), F.floor(b["y1"]))
    df = lines_with_regions(t).select(*KEYS, LINE().alias("b"), F.explode("items").alias("r"))
    return df.select(*KEYS, "r.region_id", G.intersection_area(low(F.col("b")), low(item_box(F.col("r")))).cast("long").alias("common"))


@query("u04_line_except", f", {PAIRS} select doc_id, page_id, line_id from layout_lines except select doc_id, page_id, line_id from pairs where share > 0.7")
def _(t):
    return lines_with_regions(t).filter(~F.exists("items", lambda x: share(x) > 0.7)).select(*KEYS)


