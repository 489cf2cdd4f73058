"""Queries of titles, metadata, document types and trees."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from inkspan.functions import text as X
from inkspan.functions import titles as T
from inkspan.operators import relational as R
from inkspan.operators import structure as S
from inkspan.plans.derive import _pick
from inkspan.plans.registry import query

KEYS = ("doc_id", "line_no")


def L():  # noqa: N802
    return F.col("line")


ATTR = "(['text', 'doc_title', 'text_title'])[(doc_id + line_no) % 3 + 1]"


def attr():
    return _pick(("text", "doc_title", "text_title"), (F.col("doc_id") + F.col("line_no")) % 3)


def q(s: str) -> str:
    return s.replace("'", "''").replace("{", "{").replace("}", "}")


def any_of(patterns, c="line"):
    return " or ".join(f"regexp_matches({c}, '{q(p)}')" for p in patterns)


def plain(p: str) -> str:
    return p.replace("(?!于)", "").replace(r"\s*(?!\s*[\.﹒．]\s*\d+)+", "")


@query("t27_title_labels", ", d as (select doc_id, line_no, lower(line || (['', '指南', ' Study', '专家共识'])[line_no % 4 + 1]) as s from doc_lines) select doc_id, line_no, concat_ws(',', " + ", ".join(f"case when regexp_matches(s, '{p}') then '{n}' end" for n, p in T.TITLE_LABELS.items()) + ") as labels from d")
def _(t):
    df = t.doc_lines().withColumn("line", F.concat(L(), _pick(("", "指南", " Study", "专家共识"), F.col("line_no") % 4)))
    return df.select(*KEYS, F.array_join(T.title_labels(L()), ",").alias("labels"))


@query("t28_field_predicates", "select doc_id, line_no, " + ", ".join(f"regexp_matches(line, '{q(p)}') as {n}" for n, p in T.FIELDS.items()) + " from decorated_lines")
def _(t):
    return t.decorated_lines().select(*KEYS, *[T.is_field(L(), n).alias(n) for n in T.FIELDS])


VETO = "case " + " ".join(f"when regexp_matches(trim(s), '{q(plain(p))}') then {i + 1}" for i, p in enumerate(T.NOT_TITLES)) + " else 0 end"


def slot(i: int) -> str:
    if i in (7, 8, 9, 10):  # no look-ahead in this dialect: as many numbers, and not more
        n = i - 6
        more = "" if i == 10 else rf" and not regexp_matches(s, '^\d{{1,3}}(\s*[\.﹒．]\s*\d{{1,3}}){{{n + 1}}}')"
        return rf"regexp_matches(s, '^\d{{1,3}}(\s*[\.﹒．]\s*\d{{1,3}}){{{n}}}'){more}"
    return f"regexp_matches(s, '{q(T.SLOTS[i])}')"


#: Reference marks and a misread numeral in some lines, so that matching has to put them right.
NOTED = "noted as (select doc_id, line_no, case line_no % 5 when 1 then '<1-2>' || line when 2 then replace(line, '一', '\\equiv') else line end as line from decorated_lines)"


def noted(t):
    k = F.col("line_no") % 5
    line = F.when(k == 1, F.concat(F.lit("<1-2>"), F.col("line"))).when(k == 2, F.replace("line", F.lit("一"), F.lit("\\equiv"))).otherwise(F.col("line"))
    return t.decorated_lines().withColumn("line", line)


SLOT_SQL = f"""{NOTED}, v as (select doc_id, line_no, s, attr, case {" ".join(f"when {slot(i)} then {i}" for i in range(13, 1, -1))} else -1 end as found, case when {slot(0)} then 0 when {slot(1)} then 1 end as early, {VETO} as veto from (select doc_id, line_no, replace(regexp_replace(regexp_replace(line, '^\\s+|\\s+$', '', 'g'), '<[0-9]+-[0-9]+>', '', 'g'), '\\equiv', '三') s, {ATTR} attr from noted)),
sl as (select doc_id, line_no, s, attr, case when early is not null then case when length(regexp_replace(s, '[A-Za-z]+', '', 'g')) < 35 then early else -1 end
when found in (3, 4, 6) then case when veto > 0 then case attr when 'text_title' then 15 when 'doc_title' then 14 else -1 end else found end
when found = 7 then case when veto in (2, 3, 4) then -1 when ({VETO.replace("trim(s)", "regexp_replace(s, '^[0-9]{1,3}[ ]*[.][ ]*', '')")}) > 0 then 6 else 7 end
when found > -1 then found when attr <> 'text' and regexp_matches(s, '{q(T.LOWEST)}') then 16 else case attr when 'doc_title' then 15 when 'text_title' then 14 else -1 end end::int as slot from v)"""


@query("t29_title_slot", f", {SLOT_SQL} select doc_id, line_no, slot from sl")
def _(t):
    return noted(t).select(*KEYS, T.title_slot(L(), attr()).alias("slot"))


@query("t30_title_predicates", f", v as (select doc_id, line_no, line as s, line from decorated_lines) select doc_id, line_no, {any_of([plain(p) for p in T.STARTS])} as starts, ({VETO})::int as veto from v")
def _(t):
    return t.decorated_lines().select(*KEYS, T.starts_level(L()).alias("starts"), T.not_title(L()).alias("veto"))


def _numerals() -> list[str]:
    """Chinese numerals from 0 to 100, by reading numbers aloud."""
    ones = "零一二三四五六七八九"
    say = lambda n: "一百" if n == 100 else ones[n] if n < 10 else (ones[n // 10] if n > 19 else "") + "十" + (ones[n % 10] if n % 10 else "")
    return [say(n) for n in range(101)]


def _order_sql() -> str:
    position = lambda c: f"nullif(list_position([{', '.join(repr(x) for x in _numerals())}], {c}), 0) - 1"
    mark = "regexp_extract(s, '第([○-一二三四五六七八九十\\d]*)(章|篇|部分).*', 1)"
    numeral = "regexp_extract(s, '\\(?\\s*([一二三四五六七八九十][一二三四五六七八九十]?[一二三四五六七八九十]?)\\s*\\)?', 1)"
    book = f"coalesce(case when regexp_matches({mark}, '^[0-9]+$') then try_cast({mark} as int) end, {position(mark)}, case when contains(s, '上篇') then 0 when contains(s, '下篇') then 1 end)"
    return f"case when slot between 0 and 2 then {book} when slot in (3, 5) then {position(numeral)} when slot in (6, 11, 12) then try_cast(regexp_extract(s, '(\\d{{1,9}})', 1) as int) end::int"


@query("t31_title_order", f", {SLOT_SQL} select doc_id, line_no, {_order_sql()} as ord from sl")
def _(t):
    s = T.title_slot(L(), attr())
    df = noted(t).select(*KEYS, "line", s.alias("slot"))
    return df.select(*KEYS, T.title_order(T.title_text(L()), F.col("slot")).alias("ord"))


def _inline_sql() -> str:
    s = "regexp_replace(line, '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g')"
    cases = []
    for i, p in enumerate(T.INLINE):
        head = f"regexp_extract(s, '{q(p)}')"
        shown = f"substr({head}, 1, length({head}) - 1)" if i == T.SPACED else head
        rest = f"substr(s, length({head}) + 1)" if i in T.TAKEN_OUT else "s"
        cases.append(f"when regexp_matches(s, '{q(p)}') then case when length({head}) = length(s) then line else {shown} || chr(10) || chr(10) || {rest} end")
    return f", v as (select doc_id, line_no, line, {s} as s from decorated_lines) select doc_id, line_no, case {' '.join(cases)} else line end as line from v"


@query("t32_inline_title", _inline_sql())
def _(t):
    return t.decorated_lines().select(*KEYS, T.split_inline_title(L()).alias("line"))


@query("t33_document_marks", "select doc_id, " + " + ".join(f"regexp_matches(text, '{p}')::int" for p in T.DRUG_MARKS) + " >= 3 as drug, " + " + ".join(f"regexp_matches(text, '{q(p)}')::int" for p in T.GUIDELINE_MARKS) + " >= 2 as guideline from (select doc_id, (['【药品名称】【成份】【性状】', '指南 DOI: 文章编号', ''])[doc_id % 3 + 1] || text as text from documents)")
def _(t):
    text = F.concat(_pick(("【药品名称】【成份】【性状】", "指南 DOI: 文章编号", ""), F.col("doc_id") % 3), F.col("text"))
    return t.read("documents").select("doc_id", T.is_drug_sheet(text).alias("drug"), T.is_guideline(text).alias("guideline"))


FIRST = "f as (select doc_id, string_agg(line, '' order by page_id, line_id) as text from layout_lines where page_id < 5 group by 1)"


@query("a10_language_and_type", f", {FIRST} select doc_id, case when length(text) = 0 or length(regexp_replace(text, '[^A-Za-z]', '', 'g')) / nullif(length(text), 0) > 0.8 and length(text) > 0 then case when length(text) = 0 then 'chinese' else 'english' end when length(regexp_replace(text, '[^一-龥]', '', 'g')) > 10 then 'chinese' else 'garbage' end as language, case when length(text) = 0 then 'unknown' when {' + '.join(f'regexp_matches(text, {chr(39)}{q(p)}{chr(39)})::int' for p in T.GUIDELINE_MARKS)} >= 2 then 'guideline' else 'book' end as kind from f")
def _(t):
    df = t.layout_lines().filter("page_id < 5").groupBy("doc_id").agg(R.ordered_concat(["page_id", "line_id"], "line").alias("text"))
    return S.language_and_type(df, english=0.8)


FUNNEL = ("chinese_abstract", "english_abstract", "chinese_keyword", "english_keyword", "doi")


@query(
    "a12_metadata",
    ", m as (select doc_id, line_no, line, " + "case " + " ".join(f"when regexp_matches(line, '{q(T.FIELDS[f])}') then '{f}'" for f in (*FUNNEL, "chinese_author", "english_author", "funding")) + " end as field from decorated_lines where line_no < 16) select doc_id, field, case when field in ('chinese_author', 'english_author', 'funding') then string_agg(line, ';' order by line_no) when field in ('english_keyword', 'doi') then arg_max(line, line_no) else arg_min(line, line_no) end as value from m where field is not null group by 1, 2",
)
def _(t):
    return S.metadata(t.decorated_lines().filter("line_no < 16").select("doc_id", F.col("line_no").alias("global_index"), F.col("line").alias("text")))


@query("a13_extra_info", "select doc_id, label, string_agg(line, '|' order by page_id, line_id, region_id) as lines from layout_lines l join regions r using (doc_id, page_id) where page_id = 0 and label in ('header', 'footer', 'footnote') group by 1, 2")
def _(t):
    r = t.regions().filter(F.col("label").isin("header", "footer", "footnote") & (F.col("page_id") == 0)).select("doc_id", "page_id", "region_id", "label")
    df = t.layout_lines().filter("page_id = 0").select("doc_id", "page_id", "line_id", "line").join(r, ["doc_id", "page_id"])
    return df.groupBy("doc_id", "label").agg(R.ordered_concat(["page_id", "line_id", "region_id"], "line", "|").alias("lines"))




@query("a14_markdown_assembly", ", e as (select doc_id, line_no, line, line_no % 7 - 1 as level from doc_lines) select doc_id, string_agg(case when level >= 0 then repeat('#', level::int + 1) else '' end || ' ' || line || chr(10) || chr(10), '' order by line_no) as markdown from e where length(line) > 0 group by 1")
def _(t):
    e = t.doc_lines().filter("length(line) > 0").select("doc_id", F.col("line_no").alias("global_index"), F.col("line").alias("text"), (F.col("line_no") % 7 - 1).alias("title_level"))
    return S.markdown(e)


@query("w14_self_title", f"select doc_id, line_no, case {ATTR} when 'doc_title' then 1 when 'text_title' then 2 else -1 end::int as level from doc_lines")
def _(t):
    return t.doc_lines().select(*KEYS, S.self_title_level(attr()).alias("level"))


@query("w15_tree_edges", ", e as (select doc_id, line_no, case when line_no % 3 = 0 then (line_no * 7 + doc_id) % 4 end as level from doc_lines) select c.doc_id, c.line_no as id, max(p.line_no) as parent from e c left join e p on p.doc_id = c.doc_id and p.line_no < c.line_no and p.level is not null and (c.level is null or p.level < c.level) group by 1, 2 having c.line_no is not null and bool_or(c.level is not null) or max(p.line_no) is not null")
def _(t):
    level = F.when(F.col("line_no") % 3 == 0, (F.col("line_no") * 7 + F.col("doc_id")) % 4)
    return S.tree_edges(t.doc_lines().select("doc_id", F.col("line_no").alias("id"), level.alias("level")))


@query("l02_toc_usable", ", t as (select doc_id, line_no as ord, case when (line_no + doc_id) % 5 = 4 then null else (line_no + doc_id) % 4 end as page from doc_lines) select doc_id, count(*) >= 2 and coalesce(min(case when page > 1 then ord end), 1e9) < coalesce(min(case when page is null then ord end), 1e9) as usable from t group by 1")
def _(t):
    k = F.col("line_no") + F.col("doc_id")
    toc = t.doc_lines().select("doc_id", F.col("line_no").alias("ord"), F.when(k % 5 != 4, k % 4).alias("page_id"))
    return S.toc_usable(toc)


@query(
    "l03_error_codes",
    "select event_id, '[Code:' || (5000 + event_id % 20) || ']' || event_type || case when event_id % 3 = 0 then '' else ', user ' || user_id end as said, event_id % 20 in (0, 3, 6, 7, 8, 9, 11, 15, 17) as retryable from events",
)
def _(t):
    code = 5000 + F.col("event_id") % 20
    cause = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("user "), F.col("user_id").cast("string")))
    return t.read("events").select("event_id", S.error_text(code, F.col("event_type"), cause).alias("said"), S.is_retryable(code).alias("retryable"))


@query("l04_element_order", "select doc_id, line_no, (row_number() over (partition by doc_id order by line_no) - 1)::int as global_index, line_no = max(line_no) over (partition by doc_id) as last from doc_lines")
def _(t):
    w = Window.partitionBy("doc_id").orderBy("line_no")
    return t.doc_lines().select(*KEYS, (F.row_number().over(w) - 1).alias("global_index"), F.lead("line_no").over(w).isNull().alias("last"))
