"""Queries of the rules that run as folds over small groups; they have no SQL twin, tests hold them
against hand-worked cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkspan.operators import folds
from inkspan.operators.structure import markdown
from inkspan.plans.derive import _pick
from inkspan.plans.registry import query


@query("t23_truncate_repetitions")
def _(t):
    text = F.concat(F.col("line"), F.when(F.col("line_no") % 3 == 0, F.lit(" again and again, over" * 3)).otherwise(""))
    return t.doc_lines().select("doc_id", "line_no", folds.truncate_repetitions(text).alias("line"))


@query("j14_contents_match")
def _(t):
    lines = t.layout_lines()
    toc = lines.filter("line_id = 0").select("doc_id", "page_id", F.lit(0).alias("ord"), F.lit(1).alias("level"), F.upper("line").alias("title"))
    return folds.match_contents(toc, lines.select("doc_id", "page_id", F.col("line_no").alias("global_index"), F.col("line").alias("text")))


@query("j15_table_titles")
def _(t):
    attr = _pick(("table", "table_title", "text"), F.col("line_id") % 3)
    return folds.match_table_titles(t.layout_lines().select("doc_id", "page_id", F.col("line_no").cast("long").alias("global_index"), attr.alias("attr"), "x0", "y0", "x1", "y1"))


@query("w16_markdown_tree")
def _(t):
    e = t.doc_lines().filter("length(line) > 0").select("doc_id", F.col("line_no").alias("global_index"), F.col("line").alias("text"), (F.col("line_no") % 4 - 1).alias("title_level"))
    return folds.markdown_trees(markdown(e))


@query(
    "w17_table_grid",
    "select doc_id, r0::int as r0, c0::int as c0, r1::int as r1, c1::int as c1, text from (select doc_id, 0 r0, 0 c0, 1 + doc_id % 2 r1, 1 c1, lang as text from documents where lang is not null and source is not null union all select doc_id, 0, 1, 1, 2, 'b' from documents where lang is not null and source is not null union all select doc_id, 1, doc_id % 2, 2, doc_id % 2 + 1, source from documents where lang is not null and source is not null)",
)
def _(t):
    cell = F.concat(F.lit("<td rowspan="), (1 + F.col("doc_id") % 2).cast("string"), F.lit(">"), F.col("lang"), F.lit("</td>"))
    html = F.concat(F.lit("<table><tr>"), cell, F.lit("<td>b</td></tr><tr><td>"), F.col("source"), F.lit("</td></tr></table>"))
    return t.read("documents").select("doc_id", F.explode(folds.table_cells(html)).alias("c")).select("doc_id", "c.*")


def converted(t):
    from inkspan.plans.document import convert

    return convert(t.layout_lines().drop("line_no"), t.regions())


@query("l01_document_pipeline")
def _(t):
    return converted(t).elements


@query("l01_document_markdown")
def _(t):
    return converted(t).markdown


@query("l01_document_tree")
def _(t):
    return converted(t).tree


@query("w12_title_levels")
def _(t):
    from inkspan.operators.title_levels import title_levels

    attr = _pick(("text", "doc_title", "text_title"), (F.col("doc_id") + F.col("line_no")) % 3)
    e = t.decorated_lines().select("doc_id", F.col("line_no").alias("global_index"), F.floor(F.col("line_no") / 8).cast("int").alias("page_id"), F.col("line").alias("text"), attr.alias("attr"), F.lit(None).cast("string").alias("meta_name"))
    return title_levels(e, F.when(F.col("doc_id") % 2 == 0, "book").otherwise("guideline"))


def levels(t, finished=False):
    from inkspan.operators.title_levels import title_levels

    attr = _pick(("text", "doc_title", "text_title", "header"), (F.col("doc_id") + F.col("line_no")) % 4)
    e = t.decorated_lines().select("doc_id", F.col("line_no").alias("global_index"), F.floor(F.col("line_no") / 8).cast("int").alias("page_id"), F.col("line").alias("text"), attr.alias("attr"), F.lit(None).cast("string").alias("meta_name"))
    return title_levels(e, F.when(F.col("doc_id") % 2 == 0, "book").otherwise("guideline"), finished)


@query("w10_chapter_names")
def _(t):
    return levels(t).select("doc_id", "global_index", "text", "joined")


@query("w11_repeated_chapters")
def _(t):
    return levels(t).filter("slot in (0, 1)").select("doc_id", "global_index", "repeated", "informative")


@query("w13_finished_titles")
def _(t):
    return levels(t, True).select("doc_id", "global_index", "text", "title_level", "leaf")


@query("w06_script_lines")
def _(t):
    """Lines whose seventh and eighth characters of eleven are small and raised, or small and lowered."""
    small = lambda i: (i % 11).isin(6, 7)
    up = F.col("line_no") % 2 == 0
    char = lambda c, i: F.struct(c.alias("char"), F.when(small(i), F.when(up, 40.0).otherwise(49.0)).otherwise(42.0).alias("y0"), F.when(small(i), F.when(up, 44.0).otherwise(55.0)).otherwise(52.0).alias("y1"))
    return t.doc_lines().filter("length(line) > 0").select("doc_id", "line_no", folds.with_scripts(F.transform(F.split("line", ""), char)).alias("line"))


@query("w18_cell_alignment")
def _(t):
    """A table of two columns a page from its lines' boxes, some of them out of place."""
    k = F.col("line_id")
    x = F.when(k % 2 == 0, 0.0).otherwise(200.0) + F.when(F.col("doc_id") % 7 == k, 150.0).otherwise(0.0)
    y = 20.0 * F.floor(k / 2) + F.when(F.col("doc_id") % 5 == k, 20.0).otherwise(0.0)
    cell = F.struct("line_id", F.col("line").alias("text"), x.alias("x0"), y.alias("y0"), (x + 180).alias("x1"), (y + 16).alias("y1"))
    tables = t.layout_lines().groupBy("doc_id", "page_id").agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    html = F.concat(F.lit("<table>"), F.repeat(F.lit("<tr><td>[]</td><td>[]</td></tr>"), F.ceil(F.size("cells") / 2).cast("int")), F.lit("</table>"))
    return tables.select("doc_id", "page_id", folds.filled_tables(html, F.col("cells")).alias("f")).select("doc_id", "page_id", "f.trusted", F.explode("f.cells").alias("c")).select("doc_id", "page_id", "trusted", "c.*")


@query("j19_separator_lines")
def _(t):
    k = F.col("line_id")
    return folds.separator_lines(t.layout_lines().select("doc_id", "page_id", (100 * (k % 3) + 10 * (F.col("doc_id") % 3)).cast("int").alias("x"), F.col("y0").cast("int").alias("y0"), (F.col("y1") + F.length("line") % 40).cast("int").alias("y1")))


@query("j20_table_columns")
def _(t):
    cells = t.spans().select("doc_id", "page_id", F.col("line_id").alias("row_no"), (F.lit(90.0) * F.col("span_id")).alias("x0"), "text")
    return folds.table_columns(cells)


@query(
    "o07_greedy_decode",
    "select doc_id, line_no, ids from doc_lines join (with recursive nx as (select s, c from range(20) a(s), range(3, 20) b(c) where c <> 7 qualify row_number() over (partition by s order by (31 * s + 17 * c) % 97 desc, c) = 1), r as (select k, k::varchar as ids, k as last, 1 as n from range(20) t(k) union all select k, ids || ',' || c, c, n + 1 from r join nx on s = last where n < 12 and (last <> 19 or n = 1)) select k, arg_max(ids, n) as ids from r group by 1) on k = line_no % 20",
)
def _(t):
    """Token ids after each line's number, by a score that depends on the last token alone."""
    from inkspan.operators.models import greedy_decode

    def run(frames):
        for f in frames:
            score = lambda seqs: [[(31 * s[-1] + 17 * c) % 97 for c in range(20)] for s in seqs]
            made = greedy_decode(score, [[int(k) % 20] for k in f["line_no"]], 12, 19, [*range(3, 20)], [7])
            yield f[["doc_id", "line_no"]].assign(ids=[",".join(map(str, x)) for x in made])

    return t.doc_lines().select("doc_id", "line_no").mapInPandas(run, "doc_id long, line_no int, ids string")


@query("w08_stitched_paragraphs")
def _(t):
    """A line is a block: of one line and of its words as spans."""
    label = _pick(("text", "text", "text_title", "text", "table"), (F.col("doc_id") + F.col("line_no")) % 5)
    lines = F.array(F.struct(F.col("x1"), F.lit(0.0).alias("y0"), (F.lit(12.0) + F.col("line_no") % 4).alias("y1")))
    spans = F.transform(F.split("line", " ", -1), lambda w, i: F.struct(w.alias("text"), (400 + 300 * (F.col("line_no") % 6 == 5).cast("int")).alias("weight")))
    text = F.when(F.col("line_no") % 2 == 0, F.regexp_replace("line", r"[.?!]\s*$", "")).otherwise(F.col("line"))
    df = t.layout_lines().select("doc_id", "page_id", F.col("line_no").alias("global_index"), label.alias("label"), F.lit(100.0).alias("y0"), text.alias("text"), lines.alias("lines"), spans.alias("spans"))
    return folds.stitched(df)
