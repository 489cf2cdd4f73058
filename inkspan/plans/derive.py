"""Derived views: document content built by the same formulas in Spark and in SQL.

The driver's tables hold plain texts; these views give them lines, pages, boxes, regions, spans and
decorated lines, so that every operator has input. All are projections and explodes of one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.schemas import LABELS

#: Prefixes by line number modulo 16. One for each kind of rule on line beginnings.
PREFIXES = ("第一章 ", "第一节 ", "一、", "（一）", "【摘要】", "1 ", "1.1 ", "1.1.1 ", "(1) ", "1) ", "①", "• ", "关键词：", "DOI: ", "2.5mg ", "")


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


CTES = f"""
doc_lines as (select doc_id, (i - 1)::int line_no, ls[i] line from (select doc_id, ls, unnest(range(1, len(ls) + 1)) i from (select doc_id, string_split(text, chr(10)) ls from documents))),
layout_lines as (select doc_id, line_no // 8 as page_id, line_no % 8 as line_id, line_no, line, 72.0::double + 10 * (doc_id % 3) as x0, 40.0::double + 14 * (line_no % 8) as y0,
    72.0::double + 10 * (doc_id % 3) + 5.5::double * length(line) as x1, 52.0::double + 14 * (line_no % 8) as y1 from doc_lines),
regions as (select doc_id, page_id, r::int region_id, ({_list(LABELS)})[(doc_id + page_id + r) % 13 + 1] as label, 60.0::double + 15 * (r % 2) as x0, 33.0::double + 41 * r + doc_id % 5 as y0,
    500.0::double as x1, 78.0::double + 41 * r + doc_id % 5 as y1 from (select distinct doc_id, page_id from layout_lines), range(3) t(r)),
decorated_lines as (select doc_id, line_no, ({_list(PREFIXES)})[line_no % 16 + 1] || line as line from doc_lines),
spans as (select doc_id, page_id, line_id, (i - 1)::int span_id, ws[i] as text, 8 + (doc_id + i) % 5 as size, (['Times', 'Helvetica-Bold', 'Arial-Ital', 'SimSun'])[(doc_id + i) % 4 + 1] as font,
    400 + 100 * ((doc_id + i) % 4) as weight, 90 * ((doc_id + i) % 2) as rotation from (select doc_id, page_id, line_id, ws, unnest(range(1, len(ws) + 1)) i from (select doc_id, page_id, line_id, string_split(line, ' ') ws from layout_lines)))
""".strip()


def _pick(values, at):
    return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def span_style(at):
    """Columns of a line's word number `at` (from 0), by its document."""
    k = F.col("doc_id") + at + 1
    fonts = ("Times", "Helvetica-Bold", "Arial-Ital", "SimSun")
    return {"size": 8 + k % 5, "font": _pick(fonts, k % 4), "weight": 400 + 100 * (k % 4), "rotation": 90 * (k % 2)}


class Tables:
    """The driver's tables and derived views of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def doc_lines(self) -> DataFrame:
        return self.read("documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))

    def layout_lines(self) -> DataFrame:
        c = F.col
        lid = c("line_no") % 8
        x0, y0 = F.lit(72.0) + 10 * (c("doc_id") % 3), F.lit(40.0) + 14 * lid
        page = F.floor(c("line_no") / 8).cast("int")
        return self.doc_lines().select("doc_id", page.alias("page_id"), lid.alias("line_id"), "line_no", "line", x0.alias("x0"), y0.alias("y0"), (x0 + 5.5 * F.length("line")).alias("x1"), (y0 + 12).alias("y1"))

    def regions(self) -> DataFrame:
        """Three bands a page; pages are numbered by the text alone, so no distinct and no join is needed."""
        c = F.col
        n = F.size(F.split("text", "\n", -1))
        pages = self.read("documents").select("doc_id", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / 8).cast("int"))).alias("page_id"))
        r = pages.select("doc_id", "page_id", F.explode(F.array(*map(F.lit, range(3)))).alias("region_id"))
        y0 = F.lit(33.0) + 41 * c("region_id") + c("doc_id") % 5
        return r.select(
            "doc_id", "page_id", "region_id", _pick(LABELS, (c("doc_id") + c("page_id") + c("region_id")) % 13).alias("label"), (F.lit(60.0) + 15 * (c("region_id") % 2)).alias("x0"), y0.alias("y0"), F.lit(500.0).alias("x1"), (y0 + 45).alias("y1")
        )

    def decorated_lines(self) -> DataFrame:
        return self.doc_lines().select("doc_id", "line_no", F.concat(_pick(PREFIXES, F.col("line_no") % 16), F.col("line")).alias("line"))

    def spans(self, page_by_page: bool = False) -> DataFrame:
        """Words of lines; if page_by_page, of lines that are shuffled by page, so that groups within pages need no shuffle of words."""
        lines = self.layout_lines().select("doc_id", "page_id", "line_id", "line")
        lines = self.spread(lines, "doc_id", "page_id") if page_by_page else lines
        words = lines.select("doc_id", "page_id", "line_id", F.posexplode(F.split("line", " ", -1)).alias("span_id", "text"))
        return words.withColumns(span_style(F.col("span_id")))

    def page_lines(self) -> DataFrame:
        """A page's lines, (doc_id, page_id, lines: array of line_id, line): what a page's words follow from, a fraction
        of their bytes, so that these need not be shuffled."""
        lines = self.spread(self.layout_lines().select("doc_id", "page_id", "line_id", "line"), "doc_id", "page_id")
        return lines.groupBy("doc_id", "page_id").agg(F.sort_array(F.collect_list(F.struct("line_id", "line"))).alias("lines"))

    def spread(self, df: DataFrame, *keys: str) -> DataFrame:
        """df by keys over as many partitions as the session names, for work that is heavy for its bytes: adaptive
        execution would put a few MB into one task, whatever is then done with them."""
        return df.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), *keys)
