"""Queries of aggregates, sorts, limits and metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from inkspan.functions import geometry as G
from inkspan.operators import metrics as M
from inkspan.operators import pages as P
from inkspan.operators import relational as R
from inkspan.plans.q_joins import SHARE
from inkspan.plans.registry import query

KEYS = ("doc_id", "page_id", "line_id")
BOX = ("x0", "y0", "x1", "y1")
#: Every page of some documents gets the same head.
HEADED = "h as (select doc_id, page_id, line_id, case when line_id = 0 and doc_id % 3 = 0 then 'Running head' else line end as line from layout_lines)"


def headed(t):
    return t.layout_lines().select(*KEYS, F.when((F.col("line_id") == 0) & (F.col("doc_id") % 3 == 0), "Running head").otherwise(F.col("line")).alias("line"))


ENDS = f"{HEADED}, f as (select *, row_number() over (partition by doc_id, page_id order by line_id) a, row_number() over (partition by doc_id, page_id order by line_id desc) b from h where regexp_replace(line, '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g') <> '')"


@query(
    "a01_repeated_lines",
    f", {ENDS}, p as (select doc_id, count(distinct page_id) n from h group by 1), e as (select doc_id, page_id, line_id, line, 'f' as k from f where a <= 2 union all select doc_id, page_id, line_id, line, 'l' from f where b <= 2), o as (select doc_id, k, line from e join p using (doc_id) where length(line) > 4 and n >= 3 group by doc_id, k, line, n having count(*) > 0.6 * n) select distinct doc_id, page_id, line_id from e join o using (doc_id, k, line)",
)
def _(t):
    return P.repeated_lines(headed(t))


@query("w03_first_and_last_lines", f", {ENDS} select doc_id, page_id, line_id, a <= 2 as first, b <= 2 as last from f")
def _(t):
    return P.first_and_last(headed(t)).select(*KEYS, "first", "last")


@query("a02_document_statistics", "select doc_id, round(s, 6) mean_size, h as median_height from (select doc_id, avg(size) s from spans group by 1) join (select doc_id, median(y1 - y0) h from layout_lines group by 1) using (doc_id)")
def _(t):
    return P.document_statistics(t.spans(), t.layout_lines()).withColumn("mean_size", F.round("mean_size", 6))


@query("a03_nonblank_spans", "select doc_id, page_id, line_id, span_id, text from spans where trim(text) <> ''")
def _(t):
    return t.spans().filter("trim(text) <> ''").select(*KEYS, "span_id", "text")


@query("a06_most_common_font", "select doc_id, font from (select doc_id, font, count(*) n, min((page_id, line_id, span_id)) seen from spans group by 1, 2) qualify row_number() over (partition by doc_id order by n desc, seen) = 1")
def _(t):
    return P.most_common_font(t.spans(), ["doc_id"], ["page_id", "line_id", "span_id"])


@query("a07_block_fonts", "select doc_id, page_id, string_agg(line_fonts, ';' order by line_id) as fonts from (select doc_id, page_id, line_id, string_agg(size || '/' || weight || '/' || font, ',' order by span_id) line_fonts from spans group by 1, 2, 3) group by 1, 2")
def _(t):
    one = t.spans().select(*KEYS, "span_id", F.concat_ws("/", F.col("size").cast("string"), F.col("weight").cast("string"), "font").alias("f"))
    lines = one.groupBy(*KEYS).agg(R.ordered_concat(["span_id"], "f", ",").alias("f"))
    return lines.groupBy("doc_id", "page_id").agg(R.ordered_concat(["line_id"], "f", ";").alias("fonts"))


@query("a08_min_line_start", "select doc_id, page_id, min(x0) as start from layout_lines group by 1, 2")
def _(t):
    return t.layout_lines().groupBy("doc_id", "page_id").agg(F.min("x0").alias("start"))


@query("a09_dominant_rotation", "select doc_id, rotation from (select doc_id, rotation, sum(length(text)) n from spans where length(text) > 0 group by 1, 2) qualify row_number() over (partition by doc_id order by n desc, rotation) = 1")
def _(t):
    return P.dominant_rotation(t.spans(), ["doc_id"])


@query("a11_cluster_coordinates", ", v as (select distinct doc_id, x1 as x from layout_lines), s as (select *, case when x - lag(x) over (partition by doc_id order by x) <= 40 then 0 else 1 end as st from v), c as (select *, sum(st) over (partition by doc_id order by x)::bigint as cluster from s) select doc_id, cluster, round(avg(x), 6) as center from c group by 1, 2")
def _(t):
    return P.cluster_coordinates(t.layout_lines().withColumnRenamed("x1", "x"), ["doc_id"], "x", 40).withColumn("center", F.round("center", 6))


@query("a15_recognition_counts", "select doc_id, count(*) filter (where length(line) > 100)::bigint as success, count(*) filter (where length(line) <= 100)::bigint as failed from layout_lines group by 1")
def _(t):
    good = F.length("line") > 100
    return t.layout_lines().groupBy("doc_id").agg(F.count_if(good).alias("success"), F.count_if(~good).alias("failed"))


@query("o01_reading_order", "select doc_id, page_id, line_id, (row_number() over (partition by doc_id, page_id order by round_even((y0 + line_id % 3) / 25, 0), x1, line_id))::int as pos from layout_lines")
def _(t):
    w = Window.partitionBy("doc_id", "page_id").orderBy(F.bround((F.col("y0") + F.col("line_id") % 3) / 25), "x1", "line_id")
    return t.layout_lines().select(*KEYS, F.row_number().over(w).alias("pos"))


@query("o02_sort_by_position", "select doc_id, page_id, string_agg(line_id::varchar, ',' order by (line_id * 5 + doc_id) % 8, line_id) as lines from layout_lines group by 1, 2")
def _(t):
    df = t.layout_lines().select("doc_id", "page_id", ((F.col("line_id") * 5 + F.col("doc_id")) % 8).alias("pos"), "line_id", F.col("line_id").cast("string").alias("s"))
    return df.groupBy("doc_id", "page_id").agg(R.ordered_concat(["pos", "line_id"], "s", ",").alias("lines"))


@query("o03_limits", "select doc_id, page_id, line_id from layout_lines where page_id < 5 qualify row_number() over (partition by doc_id, page_id order by line_id) <= 6")
def _(t):
    w = Window.partitionBy("doc_id", "page_id").orderBy("line_id")
    return t.layout_lines().filter("page_id < 5").select(*KEYS, F.row_number().over(w).alias("n")).filter("n <= 6").drop("n")


@query("o05_width_batches", "select doc_id, page_id, line_id, ((row_number() over (partition by doc_id order by x1 - x0, page_id, line_id) - 1) // 4)::bigint as batch from layout_lines")
def _(t):
    w = Window.partitionBy("doc_id").orderBy(F.col("x1") - F.col("x0"), "page_id", "line_id")
    return t.layout_lines().select(*KEYS, F.floor((F.row_number().over(w) - 1) / 4).cast("long").alias("batch"))


@query("o06_dynamic_thresholds", "select doc_id, round(least(1.0, greatest(0.1, avg(v) * 0.6)), 6) as threshold from (select doc_id, length(line) / 1000.0 v, row_number() over (partition by doc_id order by length(line) desc, page_id, line_id) r, count(*) over (partition by doc_id) n from layout_lines) where r <= greatest(1, ceil(n * 0.1)) group by 1")
def _(t):
    return M.dynamic_threshold(t.layout_lines().select("doc_id", (F.length("line") / 1000.0).alias("value"), F.struct("page_id", "line_id").alias("pos")))


PRED = "r as (select doc_id, page_id, line_id, x0 + doc_id % 5 as x0, y0 + 2 * (doc_id % 5) as y0, x1 + doc_id % 5 as x1, y1 + 2 * (doc_id % 5) as y1 from layout_lines)"
COVER = f"c as (select l.doc_id, l.page_id, l.line_id, case when l.x1 = l.x0 then 0.0 else least(1.0, sum(greatest(0, least(l.x1, r.x1) - greatest(l.x0, r.x0)) * greatest(0, least(l.y1, r.y1) - greatest(l.y0, r.y0))) / ((l.x1 - l.x0) * (l.y1 - l.y0))) end as cover from layout_lines l join r using (doc_id, page_id) group by 1, 2, 3, l.x0, l.x1, l.y0, l.y1)"


def references(t):
    k = F.col("doc_id") % 5
    return t.layout_lines().select(*KEYS, (F.col("x0") + k).alias("x0"), (F.col("y0") + 2 * k).alias("y0"), (F.col("x1") + k).alias("x1"), (F.col("y1") + 2 * k).alias("y1"))


@query("b01_coverage", f", {PRED}, {COVER} select doc_id, page_id, line_id, round(cover, 6) cover from c")
def _(t):
    return M.coverage(t.layout_lines(), references(t)).select(*KEYS, F.round("cover", 6).alias("cover"))


@query("b02_precision", f", {PRED}, {COVER} select doc_id, page_id, round(avg((cover > 0.5)::int), 6) as precision from c group by 1, 2")
def _(t):
    return M.share_covered(M.coverage(t.layout_lines(), references(t)), "precision").withColumn("precision", F.round("precision", 6))


@query("b03_mean_coverage", f", {PRED}, {COVER} select doc_id, round(avg(cover), 6) as cover from c group by 1")
def _(t):
    return M.coverage(t.layout_lines(), references(t)).groupBy("doc_id").agg(F.round(F.avg("cover"), 6).alias("cover"))


@query("b04_rank_accuracy", ", v as (select doc_id, page_id, line_id, line_id as p, length(line) as q from layout_lines) select a.doc_id, a.page_id, round(avg(((a.p < b.p) = (a.q < b.q))::int), 6) as accuracy from v a join v b on a.doc_id = b.doc_id and a.page_id = b.page_id and a.line_id <> b.line_id group by 1, 2")
def _(t):
    return M.rank_accuracy(t.layout_lines().select("doc_id", "page_id", F.col("line_id").alias("item"), F.col("line_id").alias("predicted"), F.length("line").alias("reference"))).withColumn("accuracy", F.round("accuracy", 6))


@query("b05_reference_lines", "select doc_id, page_id, line_id, trunc(x0 * 1.25)::int a, trunc(y0 * 1.5)::int b, trunc(x1 * 1.25)::int c, trunc(y1 * 1.5)::int d from layout_lines")
def _(t):
    b = G.rescale_pixels(G.box(*BOX), (800, 1000), (1000, 1500))
    return t.layout_lines().select(*KEYS, *[b[k].cast("int").alias(n) for k, n in zip(BOX, "abcd", strict=True)])


#: A document's text: lines of a page joined by line breaks, pages by nothing; some pages blank at their ends.
BLANKED = "bl as (select doc_id, page_id, line_id, case when doc_id % 3 = 0 or (doc_id % 3 = 1 and (line_id < 2 or page_id > 0)) then case when line_id % 2 = 0 then '' else '  ' end else line end as line from layout_lines)"
TRIM = "regexp_replace({}, '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g')"


def blanked(t):
    d, k = F.col("doc_id") % 3, F.col("line_id")
    blank = (d == 0) | ((d == 1) & ((k < 2) | (F.col("page_id") > 0)))
    return t.layout_lines().withColumn("line", F.when(blank, F.when(k % 2 == 0, "").otherwise("  ")).otherwise(F.col("line")))


@query("a04_no_text", f", {BLANKED}, p as (select doc_id, page_id, string_agg(line, chr(10) order by line_id) as t from bl group by 1, 2), d as (select doc_id, string_agg(t, '' order by page_id) as t, count(*) n from p group by 1) select doc_id, length({TRIM.format('t')}) / n < 50 as no_text from d")
def _(t):
    return P.has_no_text(blanked(t))


BAD = r"length(t) = 0 or s / nullif(length(regexp_replace(t, '[\s\x0b]+', '', 'g')) + s, 0) > 0.7 or n / nullif(length(regexp_replace(t, '\n+', '', 'g')) + n, 0) > 0.6 or length(regexp_replace(t, '[^\pL\pN]', '', 'g')) / nullif(length(replace(replace(t, ' ', ''), chr(10), '')), 0) < 0.3"


@query("a05_page_text_quality", f", {BLANKED}, p as (select doc_id, page_id, string_agg(line, chr(10) order by line_id) as t from bl group by 1, 2), q as (select *, len(regexp_extract_all(t, '[\\s\\x0b]+')) s, len(regexp_extract_all(t, '\\n+')) n from p) select doc_id, page_id, coalesce({BAD}, false) as bad from q")
def _(t):
    from inkspan.functions import text as X

    df = blanked(t).groupBy("doc_id", "page_id").agg(R.ordered_concat(["line_id"], "line", "\n").alias("text"))
    return df.select("doc_id", "page_id", F.coalesce(X.is_bad_text(F.col("text")), F.lit(False)).alias("bad"))


@query("a16_formula_replacements", "select doc_id, count(*) filter (where tokens < 384 and length(new) > 0.7 * length(line) and length(trim(new)) > 0)::bigint as success, count(*)::bigint as total from (select doc_id, line, len(string_split(line, ' ')) as tokens, case line_no % 3 when 0 then line when 1 then replace(line, ' ', '') else regexp_replace(line, '[aeiou]', '', 'g') end as new from doc_lines) group by 1")
def _(t):
    k = F.col("line_no") % 3
    new = F.when(k == 0, F.col("line")).when(k == 1, F.replace("line", F.lit(" "), F.lit(""))).otherwise(F.regexp_replace("line", "[aeiou]", ""))
    good = P.replacement_is_good(F.size(F.split("line", " ", -1)), new, F.col("line"))
    return t.doc_lines().groupBy("doc_id").agg(F.count_if(good).alias("success"), F.count("*").alias("total"))


FAILED = "case conv_id % 5 when 0 then 'repeated' when 1 then 'file_url' when 2 then 'upload' when 3 then 'scan' end"


@query(
    "a17_file_results",
    f"select conv_id, turn, error_class, case error_class when 'repeated' then '文档解析中，请勿重复提交解析。' when 'file_url' then '下载文件失败，请查看 fileurl 是否有效！' when 'upload' then '抱歉，文档解析结果存储失败，我们正在加急处理，很抱歉影响您的体验！' when 'scan' then 'PDF文件中包含了特殊的加密保护或非标准的对象结构，建议您查看文档后重新上传解析。' else '' end as parse_fail, case error_class when 'repeated' then 1 when 'file_url' then 3 when 'upload' then 3 when 'scan' then 3 else 2 end as parse_status from (select conv_id, turn, {FAILED} as error_class from conversations)",
)
def _(t):
    from inkspan.operators.structure import error_columns

    k = F.col("conv_id") % 5
    e = F.when(k == 0, "repeated").when(k == 1, "file_url").when(k == 2, "upload").when(k == 3, "scan")
    return t.read("conversations").select("conv_id", "turn", *error_columns(e))


SCORES = "sc as (select doc_id, page_id, line_id, c::int as label_id, ((doc_id * 7 + page_id * 3 + line_id * 13 + c * 29) % 101) / 100.0::double as score from layout_lines, range(13) t(c))"


@query("o04_scores_top_k", f", {SCORES} select doc_id, page_id, line_id as idx, label_id, score, rank from (select *, row_number() over (partition by doc_id, page_id order by score desc, line_id, label_id)::int as rank from sc) where rank <= 20 and score > 0.35")
def _(t):
    from inkspan.operators.models import top_scores

    base = F.col("doc_id") * 7 + F.col("page_id") * 3 + F.col("line_id") * 13
    scores = F.transform(F.sequence(F.lit(0), F.lit(12)), lambda c: ((base + c * 29) % 101) / F.lit(100.0))
    boxes = t.layout_lines().select("doc_id", "page_id", F.col("line_id").alias("idx"), scores.alias("scores"))
    return top_scores(boxes, ["doc_id", "page_id"], "scores", 20)


@query(
    "a05_recognition_decision",
    f", {BLANKED}, p as (select doc_id, page_id, string_agg(line, chr(10) order by line_id) as t from bl group by 1, 2), d as (select doc_id, length({TRIM.format("string_agg(t, '' order by page_id)")}) / count(*) < 50 as no_text from p group by 1), q as (select *, len(regexp_extract_all(t, '[\\s\\x0b]+')) s, len(regexp_extract_all(t, '\\n+')) n from p), qb as (select doc_id, page_id, length(t) > 0 and coalesce({BAD}, false) as bad from q), o as (select r.doc_id, r.page_id, r.region_id, sum({SHARE.replace('l.', 'q.').replace('r.', 'l.').replace('q.', 'r.')}) s from regions r join layout_lines l using (doc_id, page_id) group by 1, 2, 3), c as (select doc_id, page_id, sum((s > 0.5)::int) / count(*) > 0.4 as covered from o group by 1, 2) select doc_id, page_id, no_text or bad or not covered as recognize from qb join d using (doc_id) join c using (doc_id, page_id)",
)
def _(t):
    """Detected lines are the page's regions."""
    from inkspan.functions import geometry as G
    from inkspan.plans.q_joins import BOX, LINE

    text = blanked(t).groupBy("doc_id", "page_id").agg(R.ordered_concat(["line_id"], "line", "\n").alias("text"))
    found = R.with_page_items(t.regions(), t.layout_lines(), BOX)
    cover = found.groupBy("doc_id", "page_id").agg(F.count("*").alias("n"), (F.count_if(G.covered_over(LINE(), F.col("items"), 0.5)) / F.count("*") > 0.4).alias("covered"))
    df = text.join(P.has_no_text(blanked(t)), "doc_id").join(cover, ["doc_id", "page_id"])
    return df.select("doc_id", "page_id", P.should_recognize(F.col("no_text"), F.col("text"), F.col("covered"), F.col("n")).alias("recognize"))
