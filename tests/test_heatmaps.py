"""Text boxes of heatmaps, against flood fill and drawn masks."""

import numpy as np
import pytest

from inkspan.operators import heatmaps as H


def flood(hot):
    """Components of a mask by flood fill over sides, in reading order of their first pixel."""
    label = np.full(hot.shape, -1)
    out = []
    for y, x in np.argwhere(hot):
        if label[y, x] >= 0:
            continue
        todo, mine = [(y, x)], []
        label[y, x] = len(out)
        while todo:
            b, a = todo.pop()
            mine.append((b, a))
            for v, u in ((b - 1, a), (b + 1, a), (b, a - 1), (b, a + 1)):
                if 0 <= v < hot.shape[0] and 0 <= u < hot.shape[1] and hot[v, u] and label[v, u] < 0:
                    label[v, u] = len(out)
                    todo.append((v, u))
        out.append(np.array(sorted(mine)))
    return out


def plain_thresholds(heat, text=0.6, blank=0.35):
    flat = np.sort(heat.ravel())
    scale = np.sqrt(np.clip(flat[int(len(flat) * 0.9) :].mean() / 0.7, 0, 1))
    return np.clip(text * scale, 0.15, 0.8), np.clip(blank * scale, 0.1, 0.6)


def plain_boxes(heat):
    """Masks drawn, grown pixel by pixel with a kernel, and the smallest rectangle by trying every pair of their points."""
    text, blank = plain_thresholds(heat)
    out = []
    for part in flood(heat > blank):
        values = heat[part[:, 0], part[:, 1]]
        if len(part) < 10 or values.max() < text:
            continue
        (y, x), (b, r) = part.min(0), part.max(0)
        w, h = r - x + 1, b - y + 1
        grow = int(np.sqrt(len(part) * min(w, h) / (w * h)) * 2)
        k, mask = 1 + grow, np.zeros(heat.shape, bool)
        for v, u in part:
            for dv in range(k):
                for du in range(k):
                    to = v - dv + k // 2, u - du + k // 2
                    if 0 <= to[0] < heat.shape[0] and 0 <= to[1] < heat.shape[1]:
                        mask[to] = True
        points = np.argwhere(mask)[:, ::-1].astype(float)
        out.append((points, values.mean()))
    best = max((m for _, m in out), default=0)
    return [(p, m / best) for p, m in out]


def smallest_area(points):
    """By every direction between two points of the set's border."""
    rows = {}
    for x, y in points:
        a, b = rows.get(y, (x, x))
        rows[y] = min(a, x), max(b, x)
    border = np.array([(x, y) for y, xs in rows.items() for x in xs])
    least = np.inf
    for i in range(len(border)):
        for j in range(i):
            d = border[i] - border[j]
            if np.hypot(*d) == 0:
                continue
            d = d / np.hypot(*d)
            u, v = border @ d, border @ np.array([-d[1], d[0]])
            least = min(least, (u.max() - u.min()) * (v.max() - v.min()))
    return 0.0 if least == np.inf else least


def spiral(n=21):
    """A line that winds inwards, two pixels to a turn."""
    heat = np.full((n, n), 0.02)
    y = x = 0
    dy, dx = 0, 1
    heat[0, 0] = 0.9
    for _ in range(2000):
        v, u = y + dy, x + dx
        over = lambda b, a: 0 <= b < n and 0 <= a < n
        if not over(v, u) or (over(v + dy, u + dx) and heat[v + dy, u + dx] > 0.5):
            dy, dx = dx, -dy
            v, u = y + dy, x + dx
            if not over(v, u) or heat[v, u] > 0.5 or (over(v + dy, u + dx) and heat[v + dy, u + dx] > 0.5):
                break
        y, x = v, u
        heat[y, x] = 0.9
    return heat


def maps():
    rng = np.random.default_rng(5)
    out = [spiral(), np.full((12, 9), 0.02), np.full((7, 7), 0.9)]
    for k in range(6):
        heat = np.where(rng.random((26, 31)) < 0.35 + 0.05 * k, 0.75, 0.05) + 0.1 * rng.random((26, 31))
        out.append(heat)
    for angle in (0.2, 0.6, 1.2):  # bars at an angle
        yy, xx = np.mgrid[0:40, 0:48]
        u = (xx - 24) * np.cos(angle) + (yy - 20) * np.sin(angle)
        v = -(xx - 24) * np.sin(angle) + (yy - 20) * np.cos(angle)
        out.append(np.where((abs(u) < 15) & (abs(v) < 3), 0.8, 0.03))
    comb = np.full((9, 30), 0.03)
    comb[::2, :] = 0.8
    comb[1::4, 29] = comb[3::4, 0] = 0.8
    return [*out, comb, comb[:, ::-1], comb.T]


def frame(spark, heats):
    return spark.createDataFrame([(i, 0, h.tolist()) for i, h in enumerate(heats)], "doc_id long, page_id int, heat array<array<double>>")


def test_components_equal_flood_fill(spark):
    heats = maps()
    got = {}
    for r in H.components(frame(spark, heats)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, heat in enumerate(heats):
        want = []
        for part in flood(heat > plain_thresholds(heat)[1]):
            (y, x), (b, r) = part.min(0), part.max(0)
            v = heat[part[:, 0], part[:, 1]]
            want.append((len(part), x, y, r - x + 1, b - y + 1, pytest.approx(v.max()), pytest.approx(v.mean())))
        mine = sorted(got.get(i, []), key=lambda r: r["component"])
        assert [(r["size"], r["x"], r["y"], r["w"], r["h"], r["peak"], r["mean"]) for r in mine] == want
    assert len(got[0]) == 1 and got[0][0]["size"] > 200  # the spiral hangs together


def test_boxes_equal_drawn_masks(spark):
    heats = maps()
    got = {}
    for r in H.detected_boxes(frame(spark, heats)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    slanted = 0
    for i, heat in enumerate(heats):
        mine, want = sorted(got.get(i, []), key=lambda r: r["box_no"]), plain_boxes(heat)
        assert [r["box_no"] for r in mine] == list(range(len(want)))
        for r, (points, confidence) in zip(mine, want, strict=True):
            box = np.array(r["polygon"])
            assert r["confidence"] == pytest.approx(confidence)
            sides = np.roll(box, -1, axis=0) - box
            w, h = np.hypot(*sides[0]), np.hypot(*sides[1])
            upright = (np.abs(sides).min(1) < 1e-6).all()
            slanted += not upright
            if abs(1 - max(w, h) / (min(w, h) + 1e-5)) > 0.1:
                assert w * h == pytest.approx(smallest_area(points), abs=1e-6)
            else:
                assert upright and (box.min(0) == points.min(0)).all() and (box.max(0) == points.max(0)).all()
            # It holds every pixel, is a rectangle, clockwise, from the corner nearest the top left.
            for s, p in zip(sides, box, strict=True):
                assert (s[0] * (points[:, 1] - p[1]) - s[1] * (points[:, 0] - p[0]) >= -1e-6).all()
            assert abs(sides[0] @ sides[1]) < 1e-6 and box.sum(1)[0] <= box.sum(1).min() + 1e-5
    assert slanted >= 3


def test_boxes_on_the_image(spark):
    boxes = spark.createDataFrame(
        [(1, 0, 0, [[1.0, 1.0], [9.9, 1.0], [9.9, 5.0], [1.0, 5.0]], 1.0), (1, 0, 1, [[2.0, 2.0], [5.0, 2.0], [5.0, 4.0], [2.0, 4.0]], 0.5), (1, 0, 2, [[8.0, 4.0], [30.0, 4.0], [30.0, 9.0], [8.0, 9.0]], 0.5), (2, 0, 0, [[2.0, 2.0], [5.0, 2.0], [5.0, 4.0], [2.0, 4.0]], 0.5)],
        "doc_id long, page_id int, box_no int, polygon array<array<double>>, confidence double",
    )
    got = {(r["doc_id"], r["box_no"]): tuple(r["box"]) for r in H.placed_boxes(boxes, (20, 10), (30, 40)).collect()}
    assert got == {(1, 0): (1, 4, 14, 20), (1, 2): (12, 16, 30, 36), (2, 0): (3, 8, 7, 16)}


def test_small_and_odd_points():
    assert H.smallest_rectangle(np.array([[3, 4]])).tolist() == [[3, 4]] * 4
    line = H.smallest_rectangle(np.array([[0, 0], [2, 2], [1, 1]]))
    assert sorted(map(tuple, np.round(line, 6).tolist())) == [(0, 0), (0, 0), (2, 2), (2, 2)]


def test_runs_travel_not_pixels(spark):
    """Nothing is shuffled before a component's runs are added up."""
    df = H.components(frame(spark, maps()[:1]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("ArrowEvalPython")
    assert H.components(frame(spark, [])).count() == 0
    empty = spark.createDataFrame([(1, 0, [])], "doc_id long, page_id int, heat array<array<double>>")
    assert H.components(empty).count() == 0 and H.detected_boxes(empty).count() == 0


def test_rasters_are_made_once_and_no_pixel_is_an_expression(spark):
    """A join of boxes with themselves made them twice, and each pixel was a call of an expression."""
    from inkspan.plans import registry

    for name in ("m01_heatmap_components", "m01_detected_boxes"):
        plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parquet") == 1 and "zip_with" not in plan and "aggregate(" not in plan


def test_ragged_and_missing_heat(spark):
    heats = [[[0.9, None, 0.9], [], [0.9]], None, [[], [0.9, 0.9]], [[0.9] * 4, [float("nan")] * 2]]
    df = spark.createDataFrame([(i, 0, h) for i, h in enumerate(heats)], "doc_id long, page_id int, heat array<array<double>>")
    got = sorted((r["doc_id"], r["component"], r["size"], r["x"], r["y"], r["w"], r["h"]) for r in H.components(df).collect())
    assert got == [(0, 0, 1, 0, 0, 1, 1), (0, 1, 1, 2, 0, 1, 1), (0, 2, 1, 0, 2, 1, 1), (2, 0, 2, 0, 1, 2, 1), (3, 0, 6, 0, 0, 4, 2)]
