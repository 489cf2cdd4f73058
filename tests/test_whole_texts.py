"""Queries see whole lines: what follows a line's first characters counts."""

import pytest

from inkspan.plans import registry

LONG = "plain words that go on well beyond the fortieth character, and then some more"


@pytest.fixture
def rows(spark, tmp_path):
    def run(name, *lines):
        spark.createDataFrame([(0, "\n".join(lines))], "doc_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        return registry.queries()[name](spark, str(tmp_path)).collect()

    return run


def by_line(rows, column):
    return {r["line_no"]: r[column] for r in rows}


def test_bad_text(rows):
    assert by_line(rows("t07_bad_text", *[LONG * 3] * 5, "fine text" + "\ufffd" * 9), "bad") == {0: False, 1: False, 2: False, 3: False, 4: False, 5: True}
    assert by_line(rows("t07_bad_text", *[LONG] * 4), "bad")[3]  # 7 invalid characters, more than max(6, 3%)


def test_predicates(rows):
    # Lines 31 and 47 have no prefix and keep their letters.
    lines = [LONG] * 31 + ["!!!!!!!! and a word", *[LONG] * 15, "2+      and more than nine characters"]
    assert not by_line(rows("t12_only_punctuation", *lines), "punctuation")[31]
    assert not by_line(rows("t14_script_predicate", *lines), "script")[47]


def test_joins_and_formulas(rows):
    assert by_line(rows("t17_line_separator", *[LONG] * 4), "line")[3].count(LONG) == 2
    assert LONG + " \\label" not in by_line(rows("t24_latex_scrub", *[LONG] * 4), "line")[1]
    assert by_line(rows("t24_latex_scrub", *[LONG] * 4), "line")[1].count(LONG) == 2
    chunks = [r for r in rows("t25_latex_slices", *[LONG] * 4) if r["line_no"] == 0]
    assert [(r["chunk"], r["is_formula"]) for r in sorted(chunks, key=lambda r: r["pos"])] == [(f"${LONG}$", True), (f" and {LONG}", False)]


def test_tokenizers(rows):
    (r,) = rows("t35_tokenizers", LONG + " \u4e2d")
    assert r["ids"] == ",".join(str(ord(c) + 3) for c in LONG + " \u4e2d") and r["n"] == len(LONG) + 4


def test_edits(rows):
    assert by_line(rows("m07_apply_edits", LONG), "line")[0] == LONG.replace(" ", "").replace("e", "e\n")


def test_contents_match(rows):
    long = "A heading that is followed by much more text than a title would hold, so that only its beginning looks like an entry"
    (r,) = rows("j14_contents_match", long, long[:60])  # the second line is like the beginning of the first alone
    assert (r["page_id"], r["global_index"]) == (0, 0)


def test_contents_match_is_the_plain_maximum(spark):
    import difflib
    import random

    from inkspan.operators import folds

    rng = random.Random(3)
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.choice((0, 3, 20, 150, 260)))) for _ in range(40)]
    texts += [t[: len(t) * 3 // 4] + "X" for t in texts] + texts[:5]
    titles = [t.upper() for t in texts[:40]]
    toc = spark.createDataFrame([(1, 0, i, 1, t) for i, t in enumerate(titles)], "doc_id long, page_id int, ord int, level int, title string")
    elements = spark.createDataFrame([(1, 0, i, t) for i, t in enumerate(texts)], "doc_id long, page_id int, global_index int, text string")
    plain, want = lambda s: s.lower().replace(" ", ""), {}
    for i, t in enumerate(titles):
        ratios = [difflib.SequenceMatcher(None, plain(t), plain(x)).ratio() for x in texts]
        if max(ratios) > 0.7:
            want[i] = ratios.index(max(ratios))
    assert {r["ord"]: r["global_index"] for r in folds.match_contents(toc, elements).collect()} == want


def distance(a, b):
    """Insertions and deletions that turn a into b."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before if x == y else min(row[j], row[j - 1]) + 1
    return row[-1]


def test_fuzzy_titles_of_any_length_and_script(rows):
    import random

    rng = random.Random(8)
    lines = ["", "", "", "", "ab", "ab", "ab", "ab", "中文标题一二三四五六", "中文标题一二三四五七", "中文标题一二三四五八", "中文标题一二三四五九", "另外的一个标题在这里呀"]
    for n in (9, 10, 20, 100, 300):
        base = [rng.choice("abcdefg 章节") for _ in range(n)]
        for _ in range(5):
            line = list(base)
            for _ in range(rng.randint(0, n // 12)):
                line[rng.randrange(n)] = rng.choice("xyz")
            lines.append("".join(line)[: rng.choice((n, n - 1, n - n // 20))])
    near = lambda a, b: 10 * distance(a, b) <= len(a) + len(b)
    want = {i for i, a in enumerate(lines) if sum(near(a, b) for j, b in enumerate(lines) if i != j) >= max(3.0, 0.05 * len(lines))}
    assert {4, 8} <= want and any(len(lines[i]) > 80 for i in want) and len(want) < len(lines)
    assert {r["line_no"] for r in rows("j13_fuzzy_titles", *lines)} == want


def test_title_levels(rows):
    # A chapter's beginning with 250 characters after it is no chapter; a short one is.
    got = rows("w12_title_levels", *["x" * 250 if i == 16 else "ab" for i in range(33)])
    at = {r["global_index"]: r for r in got}
    assert at[16]["text"] == "第一章 " + "x" * 250
    assert at[32]["slot"] == 1 and at[16]["slot"] != 1
