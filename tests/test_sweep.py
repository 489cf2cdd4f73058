"""Areas by a plane sweep, against pixel sets."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from inkspan.operators import sweep as W

SCHEMA = "doc_id long, page_id int, x0 double, y0 double, x1 double, y1 double"


def pixels(b):
    return [(x, y) for x in range(int(b[0]), int(b[2])) for y in range(int(b[1]), int(b[3]))]


def common(a, b):
    c = (max(a[0], b[0]), max(a[1], b[1]), min(a[2], b[2]), min(a[3], b[3]))
    return [] if c[2] < c[0] or c[3] < c[1] else pixels(c)


def boxes(rng, n, halves=False, size=24):
    out = []
    for _ in range(n):
        x, y = sorted(rng.choices(range(size), k=2)), sorted(rng.choices(range(size), k=2))
        h = rng.choice([0.0, 0.5]) if halves else 0.0
        out.append((x[0] + h, y[0] + h, x[1] + h, y[1] + h))
    return out


def areas(spark, some):
    df = spark.createDataFrame([(0, 0, *b) for b in some], SCHEMA).agg(F.collect_list(F.struct(*W.BOX)).alias("b"))
    return tuple(df.select(W.covered_areas(F.col("b")).alias("a")).first()["a"])


def test_areas_equal_pixel_sets(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for doc in range(60):
        some = boxes(rng, rng.choice([0, 1, 2, 5, 20, 60])) + [(3.0, 3.0, 3.0, 9.0), (5.0, 7.0, 2.0, 9.0)]  # without an inside
        some += some[:2]  # the same again
        n = Counter(p for b in some for p in pixels(b))
        rows += [(doc, 0, *b) for b in some]
        want[doc] = (len(n), sum(v > 1 for v in n.values()))
    got = {r["doc_id"]: (r["covered"], r["twice"]) for r in W.page_areas(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want
    assert areas(spark, []) == (0.0, 0.0) and areas(spark, [(0.5, 0.0, 2.0, 0.25)]) == (0.375, 0.0)
    assert areas(spark, [(0.0, 0.0, 10.0, 10.0)] * 3) == (100.0, 100.0)


@pytest.mark.parametrize("penalty", [False, True])
def test_coverage_equals_pixel_sets(spark, penalty):
    rng = random.Random(5)
    mine, others, want = [], [], []
    for doc in range(25):
        a, b = boxes(rng, 4, True), boxes(rng, rng.choice([0, 1, 6, 25]), True)
        mine += [(doc, 0, *x) for x in a]
        others += [(doc, 0, *x) for x in b]
        for x in a:
            n = Counter(p for y in b for p in common(x, y))
            area = (x[2] - x[0]) * (x[3] - x[1])
            share = 0.0 if area == 0 else max(0, len(n) - (len(b) if penalty else 0)) / area
            want.append((doc, *x, len(n), sum(v > 1 for v in n.values()), pytest.approx(share)))
    got = W.exact_coverage(spark.createDataFrame(mine, SCHEMA), spark.createDataFrame(others, SCHEMA), penalty).drop("page_id").collect()
    assert sorted(map(tuple, got), key=lambda r: r[:5]) == sorted(want, key=lambda r: r[:5])


def test_precision_and_recall(spark):
    """Hand-worked: an exact hit, a miss; pages of one kind only."""
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    preds = frame([(1, 0, 0.0, 0.0, 10.0, 10.0), (1, 0, 50.0, 50.0, 60.0, 60.0), (3, 0, 0.0, 0.0, 5.0, 5.0)])
    refs = frame([(1, 0, 0.0, 0.0, 10.0, 10.0), (2, 0, 0.0, 0.0, 5.0, 5.0)])
    got = {r["doc_id"]: (r["precision"], r["recall"]) for r in W.exact_precision_recall(preds, refs).collect()}
    assert got == {1: (0.5, 1.0), 2: (0.0, 0.0), 3: (1.0, 1.0)}


def test_one_shuffle_and_no_python(spark):
    plan = W.page_areas(spark.createDataFrame([], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan
