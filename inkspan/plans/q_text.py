"""Queries of the text rules, over lines with marks that make each rule fire on some of them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from inkspan.functions import text as X
from inkspan.plans.derive import _pick
from inkspan.plans.registry import query

KEYS = ("doc_id", "line_no")
W = r"[\s\x0b]"
#: Marks put before and after lines by number, so that rules meet what test texts lack.
MARKS = ("ﬁn\r\n", "a\xa0b\ufeff", "x\x02\ny z", "ＡＢ！", "\n\n\n\n", "• ", "12", "中文")


def marked(t):
    m = _pick(MARKS, F.col("line_no") % 8)
    return t.doc_lines().select(*KEYS, F.concat(m, F.col("line"), m).alias("line"))


def _sql(s: str) -> str:
    return "".join(f"' || chr({ord(c)}) || '" if ord(c) < 32 or c in "\xa0\ufeff\ufffe\x02" else c for c in s)


MARKED = f"from (select doc_id, line_no, m || line || m as line from (select *, ([{', '.join(chr(39) + _sql(m) + chr(39) for m in MARKS)}])[line_no % 8 + 1] m from doc_lines))"
DECORATED = "from decorated_lines"


def on(t, **columns):
    return t.select(*KEYS, *[v.alias(k) for k, v in columns.items()])




def L():  # noqa: N802
    return F.col("line")


STRIP = "regexp_replace({0}, '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g')"
RSTRIP = "regexp_replace({0}, '[\\s\\x0b]+$', '')"
LSTRIP = "regexp_replace({0}, '^[\\s\\x0b]+', '')"


@query("t01_clean_text", "select doc_id, line_no, replace(replace(replace(replace(replace(replace(line, chr(13)||chr(10), chr(10)), chr(65534), ' '), chr(65279), ' '), chr(160), ' '), chr(13), chr(10)), 'ﬁ', 'fi') as line " + MARKED)
def _(t):
    return on(marked(t), line=X.clean_text(L()))


@query("t02_keep_hyphens", "select doc_id, line_no, replace(line, chr(2), '-' || chr(10)) as kept, replace(line, 'x' || chr(2) || chr(10) || 'y z', 'xy' || chr(10) || 'z') as joined " + MARKED)
def _(t):
    df = marked(t)
    return on(df, kept=X.keep_hyphens(L()), joined=X.join_hyphens(L()))


@query("t03_halfwidth", "select doc_id, line_no, replace(replace(replace(line, 'Ａ', 'A'), 'Ｂ', 'B'), '！', '!') as line " + MARKED)
def _(t):
    return on(marked(t), line=X.to_halfwidth(L()))


@query("t04_cleanup", r"select doc_id, line_no, replace(regexp_replace(regexp_replace(line, '\n{3,}', chr(10)||chr(10), 'g'), '(\n[\s\x0b]){3,}', chr(10)||chr(10), 'g'), chr(160), ' ') as line " + MARKED)
def _(t):
    return on(marked(t), line=X.cleanup(L()))


@query("t05_bullets", r"select doc_id, line_no, regexp_replace(line, '(^|[\n ])[•●○■▪▫–—]( )', '\1-\2', 'g') as line " + MARKED)
def _(t):
    return on(marked(t), line=X.replace_bullets(L()))


RATIO = r"case when length(regexp_replace(line, '[ \n]', '', 'g')) = 0 then 1.0 else length(regexp_replace(regexp_replace(line, '[ \n]', '', 'g'), '[^\pL\pN]', '', 'g')) / length(regexp_replace(line, '[ \n]', '', 'g')) end"


@query("t06_alphanum_ratio", f"select doc_id, line_no, round({RATIO}, 9) as ratio {MARKED}")
def _(t):
    return on(marked(t), ratio=F.round(X.alphanum_ratio(L()), 9))


BAD = rf"length(line) = 0 or s / nullif(length(regexp_replace(line, '{W}+', '', 'g')) + s, 0) > 0.7 or n / nullif(length(regexp_replace(line, '\n+', '', 'g')) + n, 0) > 0.6 or {RATIO} < 0.3 or length(line) - length(replace(line, chr(65533), '')) > greatest(6.0, length(line) * 0.03)"


@query(
    "t07_bad_text",
    rf"select doc_id, line_no, {BAD} as bad from (select *, len(regexp_extract_all(line, '{W}+')) s, len(regexp_extract_all(line, '\n+')) n from (select doc_id, line_no, case line_no % 5 when 1 then replace(line, ' ', chr(10) || chr(10)) when 2 then repeat(' ! ', 9) || line when 3 then line || repeat(chr(65533), 7) else line end as line from doc_lines))",
)
def _(t):
    k = F.col("line_no") % 5
    line = F.when(k == 1, F.replace("line", F.lit(" "), F.lit("\n\n"))).when(k == 2, F.concat(F.lit(" ! " * 9), L())).when(k == 3, F.concat(L(), F.lit("�" * 7))).otherwise(L())
    return on(t.doc_lines().withColumn("line", line), bad=F.coalesce(X.is_bad_text(L()), F.lit(False)))


@query("t08_garbage_share", r"select doc_id, round(length(regexp_replace(text, '[^\x00-\x40]', '', 'g')) / nullif(length(text), 0), 9) as share from documents")
def _(t):
    return t.read("documents").select("doc_id", F.round(X.low_code_share(F.col("text")), 9).alias("share"))


@query("t09_outer_digits", "select doc_id, line_no, regexp_replace(regexp_replace(line, '^[0-9]+', ''), '[0-9]+$', '') as line " + MARKED)
def _(t):
    return on(marked(t), line=X.replace_outer_digits(L()))


@query("t10_scripts", "select doc_id, line_no, regexp_matches(line, '[一-\u9fff]') as has_chinese, regexp_matches(line, '^[一-\u9fff㐀-\u4dbf豈-\ufaff]') as first_chinese, case when regexp_matches(line, '^[一-\u9fa5]') then 'chinese' when regexp_matches(line, '^[A-Za-z]') then 'english' else 'other' end as script from decorated_lines")
def _(t):
    return on(t.decorated_lines(), has_chinese=X.contains_chinese(L()), first_chinese=X.first_is_chinese(L()), script=X.is_chinese_or_english(L()))


@query("t11_counters", "select doc_id, line_no, length(regexp_replace(line, '[^一-\u9fa5]', '', 'g')) as chinese, length(regexp_replace(line, '[^A-Za-z]', '', 'g')) as english, regexp_replace(line, '[^一-\u9fa5a-zA-Z]', '', 'g') as letters from decorated_lines")
def _(t):
    return on(t.decorated_lines(), chinese=X.chinese_count(L()), english=X.english_count(L()), letters=X.letters_only(L()))


PUNCT = r"""regexp_matches(replace(line, ' ', ''), '^[!-/:-@\[-`{-~。？，！：（）【】《》—“”‘’ \t\n\r\f\x0b]+$')"""


BARE = "from (select doc_id, line_no, case when line_no % 3 = 0 then regexp_replace(line, '[\\pL0-9]', '', 'g') else line end as line from decorated_lines)"


def bare(t):
    return t.decorated_lines().withColumn("line", F.when(F.col("line_no") % 3 == 0, F.regexp_replace("line", r"[\p{L}0-9]", "")).otherwise(L()))


@query("t12_only_punctuation", f"select doc_id, line_no, {PUNCT} as punctuation {BARE}")
def _(t):
    return on(bare(t), punctuation=X.is_punctuation(L()))


@query("t13_escape_markdown", r"select doc_id, line_no, replace(line, '#', '\#') as line from (select doc_id, line_no, '#' || line || '#' as line from doc_lines)")
def _(t):
    return on(t.doc_lines().withColumn("line", F.concat(F.lit("#"), L(), F.lit("#"))), line=X.escape_markdown(L()))


SCRIPT = rf"length({STRIP.format('line')}) <= 9 and length(regexp_replace(line, '[^A-Z]', '', 'g')) <= 3 and length(regexp_replace(line, '[^a-z]', '', 'g')) <= 4 and not {PUNCT} and not regexp_matches(line, '[一-龥.]') and not regexp_matches(line, '[&%$#_}}{{~^【】？～、，；：;:,。》><《￥`·()]')"


@query("t14_script_predicate", f"select doc_id, line_no, {SCRIPT} as script {BARE}")
def _(t):
    return on(bare(t), script=X.is_script(L()))


@query("t15_surround", rf"select doc_id, line_no, regexp_extract(line, '^({W}*)', 1) || '**' || {STRIP.format('line')} || '**' || regexp_extract(line, '({W}*)$', 1) as line from (select doc_id, line_no, repeat(' ', line_no % 3) || line || repeat(' ', line_no % 2) as line from doc_lines)")
def _(t):
    line = F.concat(F.repeat(F.lit(" "), F.col("line_no") % 3), L(), F.repeat(F.lit(" "), F.col("line_no") % 2))
    return on(t.doc_lines().withColumn("line", line), line=X.surround(L(), "**"))


KIND = "(['table', 'code', 'text', 'list_item', 'formula', 'figure', 'doc_title'])[line_no % 7 + 1]"


@query(
    "t16_block_markdown",
    rf"select doc_id, line_no, case kind when 'table' then chr(10) || line || chr(10) when 'code' then chr(10) || '```' || chr(10) || line || chr(10) || '```' || chr(10) when 'text' then replace(line, '#', '\#') when 'list_item' then replace(line, '#', '\#') when 'formula' then case when {STRIP.format('line')} like '$$%$$' then chr(10) || {STRIP.format('line')} || chr(10) else line end else line end as line from (select doc_id, line_no, {KIND} kind, case when line_no % 7 = 4 then '$$x$$ ' else '# ' || line end as line from doc_lines)",
)
def _(t):
    kind = _pick(("table", "code", "text", "list_item", "formula", "figure", "doc_title"), F.col("line_no") % 7)
    df = t.doc_lines().withColumn("kind", kind).withColumn("line", F.when(F.col("line_no") % 7 == 4, F.lit("$$x$$ ")).otherwise(F.concat(F.lit("# "), L())))
    return on(df, line=X.block_markdown(L(), F.col("kind")))


S, H = r"\p{Lo}\p{Ll}0-9", "\\-—¬"
SEPARATOR = rf"""case when length(a) > 0 and regexp_matches(a, '[{S}][{H}]{W}?$') and regexp_matches(b, '^{W}?[{S}]') then {RSTRIP.format(f"regexp_replace(a, '[{H}]{W}?$', '')")} || {LSTRIP.format('b')}
when regexp_matches(a, '[一-鿿]$') and regexp_matches(b, '^[一-鿿]') then {RSTRIP.format('a')} || {LSTRIP.format('b')}
when label in ('doc_title', 'text_title') then {RSTRIP.format('a')} || ' ' || {LSTRIP.format('b')}
when regexp_matches(a, '[{S}][,;(—"''*]?{W}?$') and regexp_matches(b, '^{W}?[\pL0-9]') then {RSTRIP.format('a')} || ' ' || {LSTRIP.format('b')}
when label in ('text', 'footnote', 'text_tile', 'table_title', 'figure_title') and regexp_matches(a, '[。ๆ.?!]{W}?$') then a || ' ' || b when label = 'table' then a || chr(10) || chr(10) || b else a || ' ' || b end"""


@query("t17_line_separator", f"select doc_id, line_no, {SEPARATOR} as line from (select doc_id, line_no, line || (['a-', '中', '. ', ''])[line_no % 4 + 1] a, (case when line_no % 8 = 1 then '文' else '' end) || line b, (['text', 'table', 'doc_title'])[line_no % 3 + 1] as label from doc_lines)")
def _(t):
    a = F.concat(L(), _pick(("a-", "中", ". ", ""), F.col("line_no") % 4))
    b = F.concat(F.when(F.col("line_no") % 8 == 1, "文").otherwise(""), L())
    return on(t.doc_lines(), line=X.join_lines(a, b, _pick(("text", "table", "doc_title"), F.col("line_no") % 3)))


@query("t18_sentence_and_list", rf"select doc_id, line_no, regexp_matches(line, '[。ๆ.?!？！]{W}?$') as ends, regexp_matches(line, '^([①②③④⑤⑥⑦⑧⑨⑩]|\([0-9]\)).') as starts from decorated_lines")
def _(t):
    return on(t.decorated_lines(), ends=X.ends_sentence(L()), starts=X.starts_list(L()))


@query("t19_block_separator", "select doc_id, line_no, case when line_no % 2 = 0 then chr(10) || chr(10) else chr(10) end || line as line from doc_lines")
def _(t):
    return on(t.doc_lines(), line=X.block_separator(F.when(F.col("line_no") % 2 == 0, "text").otherwise("table"), L()))


@query("t20_dots_and_newlines", rf"select doc_id, line_no, regexp_replace(line, '({W}*\.{W}*){{4,}}', ' ', 'g') as dots, regexp_replace({STRIP.format('line')}, '[\r\n]+', ' ', 'g') as newlines from (select doc_id, line_no, line || ' . . . . ' || line_no || chr(10) || chr(10) || 'z' as line from doc_lines)")
def _(t):
    df = t.doc_lines().withColumn("line", F.concat(L(), F.lit(" . . . . "), F.col("line_no").cast("string"), F.lit("\n\nz")))
    return on(df, dots=X.replace_dots(L()), newlines=X.replace_newlines(L()))


@query("t21_font_flags", "select doc_id, concat_ws('_', " + ", ".join(f"case when f & {1 << b} > 0 then '{n}' end" for b, n in X.FONT_FLAGS.items()) + ") as flags from (select doc_id, (doc_id * 7919) % 1048576 f from documents)")
def _(t):
    return t.read("documents").select("doc_id", X.font_flags((F.col("doc_id") * 7919) % 1048576).alias("flags"))


@query("t22_unsupported_fonts", "select doc_id, sum(case when bad then length(text) else 0 end)::bigint as n_chars, sum(case when bad then length(text) else 0 end) <= 5 as supported from (select doc_id, text, font || (case when doc_id % 2 = 0 then '宋体' else '' end) like '%宋体%' as bad from spans) group by 1")
def _(t):
    bad = X.is_unsupported_font(F.concat("font", F.when(F.col("doc_id") % 2 == 0, F.lit("宋体")).otherwise("")))
    n = F.sum(F.when(bad, F.length("text")).otherwise(0))
    return t.spans().groupBy("doc_id").agg(n.alias("n_chars"), (n <= 5).alias("supported"))


SCRUBBED = rf"contains(line, '$') or contains(line, '\[') or contains(line, '<math') as math, regexp_replace(line, '\\(label|ref|cite)\{{[^}}]*\}}', '', 'g') as line, regexp_replace(regexp_replace(line, '^\$+', ''), '\$+$', '') as bare"


FORMULA = "from (select doc_id, line_no, case line_no % 4 when 0 then '$' || line || '$ and ' || line when 1 then line || ' \\label{a} $$y$$ \\ref{b} ' || line || ' \\cite{c}' else line end as line from doc_lines)"


def formulas(t):
    k = F.col("line_no") % 4
    return t.doc_lines().withColumn("line", F.when(k == 0, F.concat(F.lit("$"), L(), F.lit("$ and "), L())).when(k == 1, F.concat(L(), F.lit(" \\label{a} $$y$$ \\ref{b} "), L(), F.lit(" \\cite{c}"))).otherwise(L()))


@query("t24_latex_scrub", f"select doc_id, line_no, {SCRUBBED} {FORMULA}")
def _(t):
    return on(formulas(t), math=X.contains_math(L()), line=X.remove_labels(L()), bare=X.strip_fences(L()))


@query("t25_latex_slices", rf"select doc_id, line_no, (i - 1)::int as pos, p[i] as chunk, regexp_matches(p[i], '(?s)^\$.+\$$') as is_formula from (select *, unnest(range(1, len(p) + 1)) i from (select doc_id, line_no, list_filter(regexp_extract_all(line, '(?s)(\$\$.+?\$\$|\$[^$]+\$|[^$]+|\$)', 1), lambda x: length(x) > 0) p {FORMULA}))")
def _(t):
    df = formulas(t).select(*KEYS, F.posexplode(X.latex_chunks(L())).alias("pos", "chunk"))
    return df.withColumn("is_formula", X.is_formula(F.col("chunk")))


@query("t26_language_codes", "select doc_id, case lang when 'en' then 'English' when 'de' then 'German' when 'fr' then 'French' when 'es' then 'Spanish' end as name, case lang when 'en' then 'eng' when 'de' then 'deu' when 'fr' then 'fra' when 'es' then 'spa' end as code3 from documents")
def _(t):
    from inkspan.operators.languages import language_table

    dim = language_table(t.spark)  # a fixed table of known size
    return t.read("documents").join(F.broadcast(dim), F.col("lang") == dim["code"], "left").select("doc_id", "name", "code3")


@query("t35_tokenizers", "select doc_id, line_no, list_aggregate(list_transform(range(1, length(s) + 1), lambda i: unicode(s[i]) + 3), 'string_agg', ',') as ids, least(strlen(s), 1048576) as n from (select doc_id, line_no, line s from doc_lines) where length(s) > 0")
def _(t):
    df = t.doc_lines().filter("length(line) > 0")
    ids = X.utf16_ids(L())
    return df.select(*KEYS, F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").alias("ids"), X.byte_ids(L(), 1 << 20)["length"].cast("long").alias("n"))


@query("t36_token_strings", "select doc_id, line_no, string_agg(q, ';' order by k) as quads from (select doc_id, line_no, k, (4 * k + 1) || ',' || (4 * k + 2) || ',' || (4 * k + 3) || ',' || (4 * k + 4) as q from (select doc_id, line_no, unnest(range(0, (line_no % 9) // 4)) k from doc_lines)) group by 1, 2")
def _(t):
    from inkspan.functions.tokens import box_quads

    seq = F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.col("line_no") % 9, F.lit(1))), lambda i: F.concat(F.lit("bbox-"), i.cast("string"))), " "), F.lit("<eos>"))
    df = t.doc_lines().filter("line_no % 9 >= 4").withColumn("q", box_quads(seq))
    return df.select(*KEYS, F.array_join(F.transform("q", lambda x: F.array_join(F.transform(x, lambda v: v.cast("string")), ",")), ";").alias("quads"))


@query("t37_prelim_text", "select doc_id, page_id, string_agg(line, chr(10) order by line_id) as text from layout_lines group by 1, 2")
def _(t):
    ordered = F.sort_array(F.collect_list(F.struct("line_id", "line")))
    return t.layout_lines().groupBy("doc_id", "page_id").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))


@query("t39_names", "select doc_id, page_id, page_id || '_image_' || row_number() over (partition by doc_id, page_id order by line_id) - 1 || '.png' as name, page_id || '-' || line_id as id from layout_lines where line_id % 3 = 0")
def _(t):
    w = Window.partitionBy("doc_id", "page_id").orderBy("line_id")
    df = t.layout_lines().filter("line_id % 3 = 0")
    return df.select("doc_id", "page_id", F.format_string("%d_image_%d.png", "page_id", F.row_number().over(w) - 1).alias("name"), F.format_string("%d-%d", "page_id", "line_id").alias("id"))


