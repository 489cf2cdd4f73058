"""Tables read from glyphs, against a plain loop over them."""

import random
import re

from pyspark.sql import functions as F

from inkspan.operators import tables as A

BOX = "x0 double, y0 double, x1 double, y1 double"
LINES = "doc_id long, page_id int, block_id int, block_x0 double, block_y0 double, line_id int, x0 double, y0 double, x1 double, y1 double, glyphs array<struct<char: string, x0: double, y0: double, x1: double, y1: double>>"
WIDTH, TOLERANCE = 600.0, 0.01


def share(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w < 0 or h < 0:
        return 0.0
    return w * h / ((a[2] - a[0]) * (a[3] - a[1]))


def cleaned(s):
    return re.sub(r"(\s*\.\s*){4,}", " ", re.sub(r"[\r\n]+", " ", s.strip()))


def by_loop(table, lines):
    """Rows of (box, text) of one table."""
    order = lambda y, x: (round(y / 5), x)
    lines = sorted(lines, key=lambda r: (*order(r[4], r[3]), r[2], *order(r[7], r[6]), r[5]))
    rows, row, cell = [], [], None
    edge = table[0] + (table[2] - table[0]) * 0.2

    def end_cell():
        if cell and cell[1]:
            row.append((tuple(cell[0]), cleaned(cell[1])))

    for r in lines:
        if share(r[6:10], table) < 0.7:
            continue
        for char, *b in r[10]:
            at = b[0] / WIDTH
            if cell is not None and cell[0][0] / WIDTH - TOLERANCE < at < cell[0][2] / WIDTH + TOLERANCE:
                cell = [[min(cell[0][0], b[0]), min(cell[0][1], b[1]), max(cell[0][2], b[2]), max(cell[0][3], b[3])], cell[1] + char]
                continue
            end_cell()
            if cell is not None and at < cell[0][2] / WIDTH - TOLERANCE and at < edge:
                rows.append(row)
                row = []
            cell = [list(b), char]
    end_cell()
    rows.append(row)
    return [sorted(r, key=lambda c: round(c[0][0] / 4)) for r in rows if r]


def pages():
    rng = random.Random(11)
    tables, lines = [], []
    for doc in range(12):
        tables += [(doc, 0, 0, 50.0, 40.0, 550.0, 200.0), (doc, 0, 1, 300.0, 100.0, 320.0, 110.0)]
        for line in range(rng.randint(0, 9)):
            y = 44.0 + 14 * line + rng.choice([0, 0, 2.5, 12.5])
            glyphs, x = [], 60.0
            for _ in range(rng.randint(0, 25)):
                char = rng.choice(["a", "b", "", " ", ".", " . . . . ", "\n", "字", "x. y"])
                x += rng.choice([5, 5, 6, 6.5, 40, 90, -30, -200]) + rng.choice([0, 0.5])
                glyphs.append((char, x, y, x + 5, y + 10))
            block = rng.randint(0, 2)
            lines.append((doc, 0, block, rng.choice([50.0, 60.0]), 40.0 + 30 * block, line, 60.0, y, 500.0, y + 10, glyphs))
    return tables, lines


def frames(spark, tables, lines):
    return spark.createDataFrame(tables, f"doc_id long, page_id int, table_id int, {BOX}"), spark.createDataFrame(lines, LINES)


def test_rows_equal_a_plain_loop(spark):
    tables, lines = pages()
    made = A.read_tables(*frames(spark, tables, lines), WIDTH).collect()
    assert len(made) == len(tables)
    for r in made:
        mine = [[((c["x0"], c["y0"], c["x1"], c["y1"]), c["text"]) for c in row] for row in r["rows"]]
        want = by_loop((r["x0"], r["y0"], r["x1"], r["y1"]), [x for x in lines if x[0] == r["doc_id"]])
        assert mine == want
    assert any(len(r["rows"]) > 2 for r in made) and any(not r["rows"] for r in made)


def test_grid_and_markdown(spark):
    """Cells close up to the left, as their columns are numbered in order; columns of blanks go."""
    y = lambda k: (10.0 + 14 * k, 20.0 + 14 * k)
    word = lambda s, x, k: [(c, x + 5 * i, y(k)[0], x + 5 * i + 5, y(k)[1]) for i, c in enumerate(s)]
    line = lambda k, *cells: (0, 0, 0, 50.0, 10.0, k, 60.0, y(k)[0], 400.0, y(k)[1], [g for s, x in cells for g in word(s, x, k)])
    tables = [(0, 0, 0, 50.0, 5.0, 420.0, 100.0)]
    lines = [line(0, ("Name", 60.0), ("Size", 200.0), (" ", 300.0)), line(1, ("long name", 60.0), ("7", 200.0)), line(2, ("x", 60.0))]
    df = A.read_tables(*frames(spark, tables, lines), WIDTH)
    got = df.select(A.grid(F.col("rows")).alias("g"), A.grid_markdown(A.grid(F.col("rows"))).alias("m")).first()
    assert got["g"] == [["Name", "Size"], ["long name", "7"], ["x", ""]]
    assert got["m"].split("\n") == ["| Name      | Size   |", "|-----------|--------|", "| long name | 7      |", "| x         |        |"]
    none = A.read_tables(*frames(spark, tables, [line(0)]), WIDTH).select(A.grid(F.col("rows")).alias("g"), A.grid_markdown(A.grid(F.col("rows"))).alias("m")).first()
    assert none["g"] == [] and none["m"] == ""


def test_tables_without_lines_and_one_shuffle_a_side(spark):
    tables, lines = frames(spark, [(1, 0, 0, 0.0, 0.0, 9.0, 9.0)], [])
    df = A.read_tables(tables, lines, WIDTH)
    assert df.first()["rows"] == [] and A.cells_of(df, ("doc_id",)).count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") <= 3


def test_lines_meet_tables_without_their_glyphs(spark):
    """What is shuffled is the column named; rows are made once, whatever is exploded of them."""
    from inkspan.plans import q_tables
    from inkspan.plans.derive import Tables

    df = A.cells_of(q_tables.tables_read(Tables(spark, "/root/testdata/sf0.001")), q_tables.TABLE)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1, plan.count("aggregate(")
    shuffled = [line for line in plan.split("\n") if "collect_list(" in line]
    assert len(shuffled) == 1 and "line, line" in shuffled[0] and "char" not in shuffled[0] and "glyphs" not in shuffled[0]
    old = A.read_tables(Tables(spark, "/root/testdata/sf0.001").regions().withColumnRenamed("region_id", "table_id"), q_tables.glyph_lines(Tables(spark, "/root/testdata/sf0.001")), q_tables.PAGE_WIDTH)
    assert df.exceptAll(A.cells_of(old, q_tables.TABLE)).count() == 0 and df.count() > 0
