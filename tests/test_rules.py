"""Hand-worked cases of the rules."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkspan.functions import geometry as G
from inkspan.functions import text as X
from inkspan.functions import titles as T
from inkspan.operators import folds
from inkspan.operators.languages import language_code


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "a, b, share",
    [((0, 0, 10, 10), (5, 5, 15, 15), 0.25), ((0, 0, 10, 10), (10, 0, 20, 10), 0.0), ((5, 5, 5, 5), (0, 0, 10, 10), 1.0)],
)
def test_overlap_share(spark, a, b, share):
    assert value(spark, G.overlap_share(G.box(*a), G.box(*b))) == share
    assert value(spark, G.element_overlap_share(G.box(*a), G.box(*b))) == (0.0 if a[0] == a[2] else share)


def test_boxes(spark):
    assert tuple(value(spark, G.rescale(G.box(20, 20, 40, 40), G.box(0, 0, 200, 100), G.box(0, 0, 100, 100)))) == (10, 20, 20, 40)
    assert tuple(value(spark, G.rotate(G.box(1, 2, 3, 5), F.lit(90), 10, 20))) == (15, 1, 18, 3)
    assert value(spark, G.line_intersection(*map(F.lit, (0.0, 10.0, 5.0, 25.0)))) == 0.5


@pytest.mark.parametrize(
    "f, given_text, expected",
    [
        (X.clean_text, "ﬁn\r\nx", "fin\nx"), (X.replace_outer_digits, "12 Title 3", " Title "), (X.is_punctuation, "。，!", True), (X.is_punctuation, "a!", False),
        (X.is_script, "2+", True), (X.is_script, "H2O.", False), (X.is_bad_text, "", True), (X.alphanum_ratio, "a b!\n", 2 / 3), (X.title_case, "o'neil x", "O'Neil X"),
        (X.join_hyphens, "ab", "ab"), (X.block_markdown, None, None), (X.ends_sentence, "end。", True),
    ],
)
def test_text(spark, f, given_text, expected):
    got = value(spark, f(F.lit(given_text)) if f is not X.block_markdown else X.block_markdown(F.lit("a title"), F.lit("doc_title")))
    assert got == ("# A Title\n" if f is X.block_markdown else pytest.approx(expected) if isinstance(expected, float) else expected)


def test_lines_are_joined(spark):
    join = lambda a, b, label="text": value(spark, X.join_lines(F.lit(a), F.lit(b), F.lit(label)))
    assert join("exam-", "ple") == "example" and join("中", "文") == "中文" and join("Table", "x", "table") == "Table x" and join("A.", "B", "table") == "A.\n\nB"


def test_font_flags_and_tokens(spark):
    assert value(spark, X.font_flags(F.lit(65))) == "fixed_pitch_italic"
    ids = value(spark, X.byte_ids(F.lit("a"), 4))
    assert (ids["ids"], ids["mask"], ids["length"]) == ([100, 0, 0, 0], [1, 0, 0, 0], 1)
    from inkspan.functions.tokens import box_quads, cell_texts, html_tokens

    assert value(spark, box_quads(F.lit("bbox-1 bbox-2 bbox-3 bbox-4 bbox-5<eos>"))) == [[1, 2, 3, 4]]
    assert value(spark, html_tokens(F.lit("<tr> <td> <eos> x"))) == ["<tr>", "<td>"] and value(spark, cell_texts(F.lit("a<sep> b<eos>"))) == ["a", "b"]


@pytest.mark.parametrize("text, slot", [("第一章 绪论", 1), ("1.1 背景", 7), ("1.1.1 x", 8), ("(1) 甲", 11), ("①乙", 13), ("plain", -1), ("2.5mg 每日", -1)])
def test_title_slots(spark, text, slot):
    assert value(spark, T.title_slot(F.lit(text), F.lit("text"))) == slot


@pytest.mark.parametrize("text, attr, slot", [("收稿日期", "doc_title", 15), ("教学内容", "text_title", 14), ("收稿日期教学内容", "doc_title", 16), ("教学要求", "text_title", 16), ("关键词", "text", -1)])
def test_lowest_titles(spark, text, attr, slot):
    """Two words that stand without a bar between them in the fixed pattern count only together."""
    assert value(spark, T.title_slot(F.lit(text), F.lit(attr))) == slot


def test_chinese_numbers(spark):
    want = {"零": 0, "十": 10, "十一": 11, "二十": 20, "九十九": 99, "一百": 100, "x": None}
    got = spark.createDataFrame(list(want.items()), "s string, n int").select("n", T.chinese_number(F.col("s")).alias("v")).collect()
    assert all(r["n"] == r["v"] for r in got)


def test_language_codes(spark):
    assert value(spark, language_code(F.lit("ENGLISH"))) == "en" and value(spark, language_code(F.lit("de"))) == "de"
    with pytest.raises(Exception, match="unknown language"):
        value(spark, language_code(F.lit("klingon")))


def test_repetitions():
    unit = "abcdefghijklmno"
    assert folds.without_repetitions("x" + 3 * unit) == "x" and folds.without_repetitions("short") == "short" and folds.without_repetitions("no repetition in this text at all") == "no repetition in this text at all"


@given(st.text("ab", min_size=0, max_size=90))
@settings(max_examples=200, deadline=None)
def test_repetitions_equal_trial(text):
    n = len(text)
    k = max([k for k in range(15, n // 2) if text[n - k :] == text[n - 2 * k : n - k]], default=0) if n >= 30 else 0
    want = text
    while k and want.endswith(text[n - k :]):
        want = want[:-k]
    assert folds.without_repetitions(text) == want


@given(st.lists(st.lists(st.integers(0, 20), min_size=3, max_size=3), min_size=1, max_size=5))
@settings(max_examples=100, deadline=None)
def test_assignment_is_optimal(cost):
    from itertools import permutations

    pairs = folds.assign(cost)
    n, m = len(cost), 3
    best = min(sum(cost[i][j] for i, j in zip(range(n), p, strict=False)) for p in permutations(range(m), n)) if n <= m else min(sum(cost[i][j] for j, i in enumerate(p)) for p in permutations(range(n), m))
    assert len(pairs) == min(n, m) and sum(cost[i][j] for i, j in pairs) == best


def test_table_titles(spark):
    rows = [(1, 0, 1, "table", 0.0, 0.0, 10.0, 10.0), (1, 0, 2, "table_title", 0.0, 12.0, 10.0, 14.0), (1, 0, 3, "table", 50.0, 0.0, 60.0, 10.0), (1, 0, 4, "table_title", 50.0, 12.0, 60.0, 14.0), (1, 1, 5, "table", 0.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, page_id int, global_index long, attr string, x0 double, y0 double, x1 double, y1 double")
    assert sorted((r["table_index"], r["title_index"]) for r in folds.match_table_titles(df).collect()) == [(1, 2), (3, 4)]


def test_contents(spark):
    toc = spark.createDataFrame([(1, 0, 0, 1, "In tro"), (1, 0, 1, 2, "zzzz")], "doc_id long, page_id int, ord int, level int, title string")
    elements = spark.createDataFrame([(1, 0, 7, "other"), (1, 0, 8, "Intro")], "doc_id long, page_id int, global_index int, text string")
    assert [(r["ord"], r["global_index"], r["level"]) for r in folds.match_contents(toc, elements).collect()] == [(0, 8, 1)]


def test_markdown_tree():
    t = folds.markdown_tree("# Aa\nx\n## Bb\ny", "f")
    assert t["text_length"] == 15 and t["section"][0]["text_span"] == [5, 15] and t["section"][0]["section"][0] == "\nx"
    assert t["section"][0]["section"][1] == {"title": "\n## Bb", "text_span": [13, 15], "text_length": 2, "section": "\ny"}
    assert folds.markdown_tree("# A\nx", "f")["section"] == "\n# A\nx"


def test_table_grid(spark):
    html = "<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>"
    assert [x[:4] for x in folds.table_grid(html)] == [(0, 0, 2, 1), (0, 1, 1, 2), (1, 1, 2, 2)]
    assert len(value(spark, folds.table_cells(F.lit(html)))) == 3
    assert folds.cells_to_columns([[(0, "a"), (50, "b")], [(50, "c")]], [10, 60, 100]) == [["a", "b"], ["c", ""]]


def test_scripts():
    line = [("H", 0, 10), ("2", 8, 13), ("O", 0, 10)]
    assert folds.line_with_scripts(line) == "H$_{2}$O" and folds.line_with_scripts([("x", 0, 10), ("2", -3, 2)]) == "x$^{2}$" and folds.line_with_scripts([]) == ""


def test_inline_titles(spark):
    assert value(spark, T.split_inline_title(F.lit("【摘要】 text"))) == "【摘要】\n\n text" and value(spark, T.split_inline_title(F.lit("【摘要】"))) == "【摘要】"


def test_segments_are_merged():
    assert folds.merge_segments([(100, 0, 50), (100, 60, 90), (120, 10, 40), (300, 0, 10)]) == [(0, 0, 90), (300, 0, 10)] and folds.merge_segments([]) == []


def test_object_registers(spark):
    from inkspan.operators.files import object_register

    want = {"public/undefined/a": 0, "public/kg/x/y.md": 1, "private/doc/z": 2, "public/h5/b": 3, "public/built-in/c": 4, "private/attach/d": 5, "public/built-in/examples/e": 2, "public/built-in/examples": 2, "other/kg": 5, "public": 5, "": 5}
    df = spark.createDataFrame([(k,) for k in want], "n string")
    assert {r["n"]: r["c"] for r in df.select("n", object_register(df["n"]).alias("c")).collect()} == want


def test_requests_meet_the_state_table(spark):
    from inkspan.operators.files import taken

    state = spark.createDataFrame([("b", 3), ("c", 1), ("d", 2), ("e", 1)], "file_id string, parse_status int")
    asked = spark.createDataFrame([("a", None), ("b", 3), ("c", 1), ("d", 2), ("e", 3)], "file_id string, seen int")
    got = {r["file_id"]: (r["outcome"], r["parse_status"]) for r in taken(asked, state).collect()}
    assert got == {"a": ("inserted", 1), "b": ("updated", 1), "c": ("repeated", 1), "d": ("done", 2), "e": ("conflict", 1)}


def test_errors(spark):
    from pyspark.sql import functions as F

    from inkspan.operators.structure import MESSAGES, RETRYABLE, error_columns, error_text, is_retryable

    df = spark.createDataFrame([(5003, "m", None, "file_url"), (5001, "m", "why", None), (None, "m", None, "unheard of")], "code int, message string, cause string, cls string")
    rows = df.select(error_text(F.col("code"), F.col("message"), F.col("cause")).alias("t"), is_retryable(F.col("code")).alias("r"), *error_columns(F.col("cls"))).collect()
    assert [r["t"] for r in rows[:2]] == ["[Code:5003]m", "[Code:5001]m, why"] and [r["r"] for r in rows] == [True, False, False] and 5003 in RETRYABLE
    assert [(r["parse_fail"], r["parse_status"]) for r in rows] == [MESSAGES["file_url"], ("", 2), MESSAGES["parse"]]


@pytest.mark.parametrize("line,comment", [("// x", True), ("# x", True), ("'x", True), ("-- x", True), ("/* x", True), ('"""x', True), ("<!-- x", True), ("% x", True), ("(* x", True), (" # x", False), ("*x", False), ("x // y", False), ("", False)])
def test_comments(spark, line, comment):
    from pyspark.sql import functions as F

    from inkspan.operators.code import is_comment

    assert value(spark, is_comment(F.lit(line))) == comment


def test_code_blocks_and_their_lines(spark):
    from inkspan.operators import code

    def block(d, b, texts, indent, size, height):
        return [(d, b, i, t, 10.0 + indent * (i % 2 or i > 1), 0.0, height, [size]) for i, t in enumerate(texts)]

    body = ["def f():", "x = 1", "", "  ", "return x", "# done"]
    rows = block(1, 0, body, 10.0, 4.0, 4.0) + block(1, 1, body, 0.0, 4.0, 4.0) + block(1, 2, ["plain text of the page"] * 30, 0.0, 10.0, 12.0) + block(1, 3, ["...", "--", "??", "!!", "++"], 10.0, 4.0, 4.0)
    df = spark.createDataFrame(rows, "doc_id long, block_id int, line_id int, text string, x0 double, y0 double, y1 double, sizes array<double>")
    got = {r["block_id"]: (r["lines"], r["is_code"]) for r in code.code_blocks(df, ("doc_id", "block_id")).collect()}
    assert got == {0: (6, True), 1: (6, False), 2: (30, False), 3: (5, False)}  # the last has no word characters
    first = df.filter("block_id = 0").selectExpr("*", "text as first_text", "0.0D as first_x0", "5.0D * length(text) as first_x1")
    assert code.indented_blocks(first, ("doc_id", "block_id"), "line_id").first()["text"] == "def f():\n  x = 1\n  \n  return x\n  # done\n"


def test_text_of_few_characters_a_page(spark):
    from inkspan.operators.pages import has_no_text

    pages = {1: [["  ", "x" * 49], [" "]], 2: [["x" * 50, "y" * 49]], 3: [["a", "", "b" * 47]], 4: [["  a ", ""], ["", "b" * 94, "  "]], 5: [[""]]}
    rows = [(d, p, i, x) for d, ps in pages.items() for p, ls in enumerate(ps) for i, x in enumerate(ls)]
    df = spark.createDataFrame(rows, "doc_id long, page_id int, line_id int, line string")
    want = {d: len("".join("\n".join(ls) for ls in ps).strip()) / len(ps) < 50 for d, ps in pages.items()}
    assert {r["doc_id"]: r["no_text"] for r in has_no_text(df).collect()} == want and set(want.values()) == {True, False}


GRID = [(r, c, r + 1, c + 1) for r in range(3) for c in range(2)]


def cells(*boxes):
    return [(chr(97 + i), b) for i, b in enumerate(boxes)]


def test_cells_are_filled_by_alignment():
    fill = folds.fill_cells
    at = lambda r, c: (100.0 * c, 20.0 * r, 100.0 * c + 80, 20.0 * r + 15)
    assert fill(GRID, cells(*[at(r, c) for r in range(3) for c in range(2)])) == (list("abcdef"), True)
    # Nothing at row 1, column 0: what comes next stands in the other column.
    assert fill(GRID, cells(at(0, 0), at(0, 1), at(1, 1), at(2, 0), at(2, 1))) == (["a", "b", "", "c", "d", "e"], True)
    # A second piece of the cell before.
    assert fill(GRID[:2], cells(at(0, 0), (0.0, 30.0, 80.0, 45.0))) == (["ab", ""], True)
    assert fill(GRID, cells(at(0, 0), at(0, 1), (500.0, 500.0, 600.0, 510.0)))[1] is False
    assert fill([], cells(at(0, 0))) == ([], True) and fill(GRID, []) == ([""] * 6, True)


def test_indel_ratio():
    from inkspan.operators.phrases import indel_similar

    assert indel_similar("", "") and not indel_similar("", "a") and indel_similar("abcdefghij", "abcdefghix") and not indel_similar("abcdefghij", "abcdefghxy")


def test_paragraphs_are_stitched(spark):
    line = lambda x1=50.0, h=10.0: {"x1": x1, "y0": 0.0, "y1": h}
    span = lambda t, w=400: {"text": t, "weight": w}
    two = lambda t, w=400: [span(t, w), span("x", w)]
    rows = [
        (0, 0, "text", 50.0, "begins here", [line()], two("a")),
        (1, 0, "table", 60.0, "t", [line()], two("t")),
        (2, 1, "text", 10.0, "goes on over a table and a page.", [line()], two("b")),
        (3, 1, "text", 5.0, "after a sentence", [line()], two("c")),
        (4, 1, "text", 30.0, "further down", [line()], two("d")),
        (5, 2, "text", 0.0, "bold", [line()], two("e", 700)),
        (6, 3, "text", 0.0, "bold goes on", [line()], two("f", 700)),
        (7, 4, "text", 0.0, "small", [line(h=6.0)], two("g", 700)),
        (8, 5, "text_title", 0.0, "Title", [line()], two("h")),
        (9, 6, "text", 0.0, "after a title", [line(), line(x1=10.0)], two("i")),
        (10, 7, "text", 0.0, "after a short last line", [line()], [span("j")]),
        (11, 8, "text", 0.0, "one span says nothing", [line()], two("k")),
        (12, 9, "text", 0.0, "(1) a list", [line()], two("l")),
    ]
    df = spark.createDataFrame([(1, *r) for r in rows], "doc_id long, global_index int, page_id int, label string, y0 double, text string, lines array<struct<x1:double,y0:double,y1:double>>, spans array<struct<text:string,weight:int>>")
    got = {r["global_index"]: r["text"] for r in folds.stitched(df).collect()}
    assert got == {0: "begins here goes on over a table and a page.", 1: "t", 3: "after a sentence", 4: "further down", 5: "bold bold goes on", 7: "small", 8: "Title", 9: "after a title", 10: "after a short last line", 11: "one span says nothing", 12: "(1) a list"}


def test_share_of_a_replacement_is_exact(spark):
    from inkspan.operators.pages import replacement_is_good

    good = lambda new, old: value(spark, replacement_is_good(F.lit(1), F.repeat(F.lit("x"), F.lit(new)), F.repeat(F.lit("y"), F.lit(old))))
    assert not good(63, 90) and good(64, 90) and not good(7, 10) and good(8, 10)


def test_half_covered_is_not_over_half(spark, tmp_path):
    """Shares 0.23, 0.2533 and 0.0167 of a region make a half; added up in doubles from the first, more than that."""
    from inkspan.plans import registry

    text = "\n".join(["x"] * 16 + ["a" * 69, "b" * 80, "c" * 5])
    spark.createDataFrame([(2812, text)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["page_id"]: r["found"] for r in registry.queries()["j10_line_coverage"](spark, str(tmp_path)).collect()}
    assert found[2] == 0


def test_covered_over(spark):
    over = lambda a, *others: value(spark, G.covered_over(G.box(*a), F.array(*[G.box(*o) for o in others]), 0.5))
    assert not over((0, 0, 10, 10), (0, 0, 5, 4), (0, 0, 5, 6)) and over((0, 0, 10, 10), (0, 0, 5, 4), (0, 0, 5, 6), (9, 9, 20, 20))
    assert over((5, 5, 5, 5), (0, 0, 10, 10)) and not over((5, 5, 5, 5), (6, 0, 10, 10))


def test_long_lines_become_ids_in_one_pass(spark):
    """A million characters, one of them beyond the basic plane; places in the text were sought from its start for each."""
    text = "aé中" * 333_333 + "😀"
    df = spark.createDataFrame([(text,), ("",), (None,)], "t string").select(X.utf16_ids(F.col("t")).alias("ids"), X.byte_ids(F.col("t"), 8)["ids"].alias("b"))
    long, empty, none = df.collect()
    assert long["ids"][:3] == [100, 0xE9 + 3, 0x4E2D + 3] and long["ids"][-2:] == [0xD83D + 3, 0xDE00 + 3] and len(long["ids"]) == 1_000_001
    assert empty["ids"] == [] and none["ids"] is None and long["b"] == [b + 3 for b in text.encode()[:8]] and empty["b"] == [0] * 8


def test_table_columns_equal_the_placed_rows(spark):
    """Cells go right of each other whatever the separators; no row is handed to Python."""
    rows = [[(0.0, "a"), (50.0, " "), (400.0, "b")], [(50.0, "c")], [(0.0, ""), (1.0, "\x1f"), (2.0, "d"), (3.0, "\u3000")]]
    df = spark.createDataFrame([(1, 0, k, x, t) for k, r in enumerate(rows) for x, t in r], "doc_id long, page_id int, row_no int, x0 double, text string")
    out = folds.table_columns(df)
    got = {(r["row_no"], r["column"]): r["text"] for r in out.collect()}
    for separators in ([10, 60, 100], []):
        assert got == {(k, j): x for k, row in enumerate(folds.cells_to_columns(rows, separators)) for j, x in enumerate(row)}
    assert "Pandas" not in out._jdf.queryExecution().executedPlan().toString()


def test_separators_of_many_pages_in_one_batch(spark):
    segments = [(100, 0, 50), (100, 60, 90), (120, 10, 40), (300, 0, 10)]
    out = folds.separator_lines(spark.createDataFrame([(1, p, *s) for p in range(3) for s in segments], "doc_id long, page_id int, x int, y0 int, y1 int"))
    assert sorted(tuple(r) for r in out.collect()) == sorted((1, p, *s) for p in range(3) for s in [(0, 0, 90), (300, 0, 10)])
    assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()


def test_common_titles_are_those_of_all_pairs(spark):
    """Held against every pair by a plain table of common subsequences; pairs are never rows of a join."""
    import random

    from inkspan.operators.phrases import common_titles

    def distance(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return len(a) + len(b) - 2 * row[-1]

    rng, rows = random.Random(7), []
    for doc in range(12):
        seeds = ["".join(rng.choice("abcdefgh \u4e00") for _ in range(rng.choice([0, 1, 9, 20, 60]))) for _ in range(3)]
        for n in range(rng.choice([2, 5, 25])):
            s = list(rng.choice(seeds))
            for _ in range(rng.randint(0, 1 + len(s) // 8)):
                if rng.random() < 0.5 and s:
                    s.pop(rng.randrange(len(s)))
                else:
                    s.insert(rng.randint(0, len(s)), rng.choice("abxy"))
            rows.append((doc, n, None if rng.random() < 0.04 else "".join(s)))
    want = set()
    for doc, n, a in rows:
        mine = [b for d, _, b in rows if d == doc]
        like = [b for b in mine if a is not None and b is not None and distance(a, b) <= 0.1 * (len(a) + len(b)) + 1e-9]
        if len(like) - 1 >= max(3.0, 0.05 * len(mine)):
            want.add((doc, n))
    df = common_titles(spark.createDataFrame(rows, "doc_id long, line_no int, title string"))
    assert want and {(r[0], r[1]) for r in df.collect()} == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "levenshtein" not in plan
