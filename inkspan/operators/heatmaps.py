"""Text boxes from a detector's heatmaps.

A page's heatmap is one row (a model's output for a page) with the heat as an array of rows. Pixels above the blank
threshold are taken as runs, a run for each stretch of a line of pixels; a run is joined to those it touches in
the line above, and components are what is so connected. From there on a component is a handful of runs, and what
is shuffled is runs, never pixels: sizes and peaks are sums and maxima over them, and a component grown by a
rectangle has the same hull as the corners of its grown runs, so no mask is drawn."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspan.functions import geometry as G
from inkspan.operators.relational import PAGE
from inkspan.schemas import data_type

#: What counts as text and as blank, the mean heat of a page's hottest tenth that they are made for,
#: the bounds that scaled ones are kept in, and the least pixels of a box.
TEXT, BLANK, TYPICAL, TEXT_BOUNDS, BLANK_BOUNDS, LEAST_PIXELS = 0.6, 0.35, 0.7, (0.15, 0.8), (0.1, 0.6), 10


class _Maps:
    """A batch's heatmaps as one flat array of pixels with the beginnings of lines and pages; missing heat is below all."""

    def __init__(self, heat: pa.Array):
        lines = heat.flatten()
        per_page, per_line = (a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for a in (heat, lines))
        self.v = lines.flatten().cast(pa.float64()).fill_null(-np.inf).to_numpy(zero_copy_only=False)
        self.line_at = np.concatenate([[0], np.cumsum(per_line)])
        self.page_of_line = np.repeat(np.arange(len(heat)), per_page)
        self.first_line = np.concatenate([[0], np.cumsum(per_page)])[:-1]
        self.at = np.concatenate([[0], np.cumsum(np.bincount(self.page_of_line, per_line, len(heat)).astype(np.int64))])


def thresholds(maps: _Maps, text: float = TEXT, blank: float = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Text and blank of each page: scaled by the square root of the mean of the hottest tenth against a typical one."""
    sizes, scale = np.diff(maps.at), np.zeros(len(maps.at) - 1)
    for n in np.unique(sizes[sizes > 0]):
        for pages in np.array_split(at := np.flatnonzero(sizes == n), -(-len(at) * n // 2**22)):
            k = n - int(n * 0.9)
            top = np.sort(np.partition(maps.v[maps.at[pages][:, None] + np.arange(n)], n - k, axis=1)[:, n - k :], axis=1)[:, ::-1]
            mean = np.cumsum(top, axis=1)[:, -1] / k  # added up from the hottest on
            scale[pages] = np.sqrt(np.fmin(np.maximum(mean / TYPICAL, 0.0), 1.0))
    return tuple(np.clip(v * scale, *bounds) for v, bounds in ((text, TEXT_BOUNDS), (blank, BLANK_BOUNDS)))


def pixel_runs(maps: _Maps, blank: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Pages, and y, x0, x1, n, peak, total, of runs of pixels above `blank`, from top to bottom and left to right."""
    v = maps.v
    hot = np.concatenate([[False], (v > np.repeat(blank, np.diff(maps.at))) | np.isnan(v), [False]])
    # Where a line begins, the pixel before it is another's: a run never goes over such a border.
    border = np.zeros(len(v) + 1, bool)
    border[maps.line_at] = True
    a = np.flatnonzero(hot[1:-1] & (~hot[:-2] | border[:-1]))
    b = np.flatnonzero(hot[1:-1] & (~hot[2:] | border[1:]))
    line = np.searchsorted(maps.line_at, a, "right") - 1
    page, n = maps.page_of_line[line], b - a + 1
    total = np.zeros(len(a))
    for j in range(n.max(initial=0)):  # each run from its left end
        more = np.flatnonzero(n > j)
        total[more] += v[a[more] + j]
    peak = np.maximum.reduceat(np.append(v, -np.inf), np.stack([a, b + 1], axis=1).ravel())[::2] if len(a) else np.zeros(0)
    return page, {"y": line - maps.first_line[page], "x0": a - maps.line_at[line], "x1": b - maps.line_at[line], "n": n, "peak": peak, "total": total}


def run_components(y: list[int], x0: list[int], x1: list[int]) -> list[int]:
    """For each run the first run of its component. Runs come from top to bottom and left to right; two are joined if
    they share a column in neighbouring lines, which a pass over both lines at once finds."""
    root = list(range(len(y)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    above = 0
    for i in range(len(y)):
        while y[above] < y[i] - 1 or (y[above] == y[i] - 1 and x1[above] < x0[i]):
            above += 1
        j = above
        while y[j] == y[i] - 1 and x0[j] <= x1[i]:
            a, b = find(j), find(i)
            root[max(a, b)] = min(a, b)
            j += 1
    return [find(i) for i in range(len(y))]


_RUNS = "array<struct<component: int, y: int, x0: int, x1: int, n: long, peak: double, total: double>>"


@cache
def _runs_of(text: float, blank: float) -> Callable[[Column], Column]:
    @F.arrow_udf(data_type(f"struct<map: struct<w: int, h: int, text: double>, runs: {_RUNS}>"))
    def run(heat: pa.Array) -> pa.Array:
        maps = _Maps(heat)
        warm, cold = thresholds(maps, text, blank)
        page, found = pixel_runs(maps, cold)
        at = np.searchsorted(page, np.arange(len(heat) + 1))
        y, x0, x1 = (found[c].tolist() for c in ("y", "x0", "x1"))
        component = [i for a, b in pairwise(at.tolist()) for i in run_components(y[a:b], x0[a:b], x1[a:b])]
        kinds = {"component": pa.int32(), "y": pa.int32(), "x0": pa.int32(), "x1": pa.int32(), "n": pa.int64(), "peak": pa.float64(), "total": pa.float64()}
        rows = pa.StructArray.from_arrays([pa.array(v, kinds[c]) for c, v in ({"component": component} | found).items()], list(kinds))
        high, lines = heat.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.diff(maps.line_at)
        wide = np.append(lines, 0)[np.where(high > 0, maps.first_line, -1)]  # of the first line
        size = pa.StructArray.from_arrays([pa.array(wide, pa.int32()), pa.array(high, pa.int32()), pa.array(warm)], ["w", "h", "text"])
        return pa.StructArray.from_arrays([size, pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows)], ["map", "runs"])

    return run


def components(heatmaps: DataFrame, text: float = TEXT, blank: float = BLANK, keep: bool = False) -> DataFrame:
    """(doc_id, page_id, component, size, x, y, w, h, peak, mean) of what hangs together (sides, not corners) above the
    blank threshold in heatmaps (doc_id, page_id, heat); `component` is its first run's number in reading order.
    With `keep`, also its runs (line y, columns x0 to x1), the map's size, and the page's text threshold.

    Keys are unique, a row a page; a page without heat has no components."""
    # Heat is named once: an expression that makes it would run again for each further use, a filter's also.
    df = heatmaps.select(*PAGE, _runs_of(text, blank)(F.col("heat")).alias("_f"))
    runs = df.select(*PAGE, "_f.map", F.explode("_f.runs").alias("_r")).select(*PAGE, "map", "_r.*")
    extent = [F.min("x0").alias("x"), F.min("y").alias("y"), (F.max("x1") - F.min("x0") + 1).alias("w"), (F.max("y") - F.min("y") + 1).alias("h")]
    more = [F.first("map").alias("map"), F.collect_list(F.struct("y", "x0", "x1")).alias("runs")] if keep else []
    return runs.groupBy(*PAGE, "component").agg(F.sum("n").alias("size"), *extent, F.max("peak").alias("peak"), (F.sum("total") / F.sum("n")).alias("mean"), *more)


def smallest_rectangle(points: np.ndarray) -> np.ndarray:
    """Corners of the smallest rectangle round points, clockwise as seen on a page (y down). One of its sides lies on
    a side of their hull; of equal rectangles, the first in the hull's order from its leftmost corner."""
    ends: dict = {}
    for x, y in points.tolist():  # the hull is that of each line's ends
        low, high = ends.get(y, (x, x))
        ends[y] = (x if x < low else low, x if x > high else high)
    points = sorted({(float(x), float(y)) for y, pair in ends.items() for x in pair})

    def chain(order: list) -> list:
        out: list = []
        for p in order:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out

    hull = np.array(points if len(points) < 3 else chain(points)[:-1] + chain(points[::-1])[:-1])
    sides = np.roll(hull, -1, axis=0) - hull
    length = np.hypot(*sides.T)
    along = sides[length > 0] / length[length > 0][:, None] if (length > 0).any() else np.array([[1.0, 0.0]])
    across = np.stack([-along[:, 1], along[:, 0]], axis=1)
    u, v = along @ hull.T, across @ hull.T
    area = (u.max(1) - u.min(1)) * (v.max(1) - v.min(1))
    k = int(np.argmin(np.round(area, 9)))
    # Along and across turn from the first to the second clockwise where y points down, so these corners do too.
    return np.array([a * along[k] + b * across[k] for a, b in ((u[k].min(), v[k].min()), (u[k].max(), v[k].min()), (u[k].max(), v[k].max()), (u[k].min(), v[k].max()))])


def box_of(points: np.ndarray) -> np.ndarray:
    """The smallest rectangle from its corner nearest the page's top left; one that is almost a square stands upright."""
    box = smallest_rectangle(points)
    w, h = np.hypot(*(box[0] - box[1])), np.hypot(*(box[1] - box[2]))
    if abs(1 - max(w, h) / (min(w, h) + 1e-5)) <= 0.1:
        (left, top), (right, bottom) = points.min(0), points.max(0)
        box = np.array([[left, top], [right, top], [right, bottom], [left, bottom]], float)
    return np.roll(box, -int(np.argmin(np.round(box.sum(1), 6))), axis=0)


@F.arrow_udf(data_type("array<array<double>>"))
def _boxes(runs: pa.Array, wide: pa.Array, high: pa.Array, before: pa.Array, behind: pa.Array) -> pa.Array:
    """Boxes of components: of the corners of their runs (y, x0, x1), grown by so many pixels before and behind and kept
    within the map."""
    n = runs.value_lengths().to_numpy(zero_copy_only=False)
    flat = runs.flatten()
    y, x0, x1 = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("y", "x0", "x1"))
    w, h, a, b = (np.repeat(v.to_numpy(zero_copy_only=False), n) for v in (wide, high, before, behind))
    left, right, top, low = (np.clip(v, 0, most - 1) for v, most in ((x0 - a, w), (x1 + b, w), (y - a, h), (y + b, h)))
    corners = np.stack([np.stack([x, v], axis=1) for v in (top, low) for x in (left, right)], axis=1).astype(float)
    at = np.concatenate([[0], np.cumsum(n)]).tolist()
    return pa.array([box_of(corners[i:j].reshape(-1, 2)).tolist() for i, j in pairwise(at)], pa.list_(pa.list_(pa.float64())))


def detected_boxes(heatmaps: DataFrame, text: float = TEXT, blank: float = BLANK, least: int = LEAST_PIXELS) -> DataFrame:
    """(doc_id, page_id, box_no, polygon, confidence) of heatmaps (doc_id, page_id, heat): components of at least `least`
    pixels whose peak reaches the text threshold, grown by about their thickness, as smallest rectangles of four
    corners (x, y), clockwise. Confidence is the component's mean heat, the page's best as 1."""
    c = F.col
    found = components(heatmaps, text, blank, keep=True).filter((c("size") >= least) & (c("peak") >= c("map.text")))
    grow = F.floor(F.sqrt(c("size") * F.least("w", "h") / (c("w") * c("h"))) * 2).cast("int")
    # A kernel of 1 + grow pixels whose middle is its (1 + grow) // 2-th: how far it reaches before and behind a pixel.
    behind = F.floor((grow + 1) / 2).cast("int")
    before = grow - behind
    page = Window.partitionBy(*PAGE)
    boxes = found.select(*PAGE, "component", "mean", _boxes("runs", "map.w", "map.h", before, behind).alias("polygon"))
    best = F.max("mean").over(page)
    return boxes.select(*PAGE, (F.row_number().over(page.orderBy("component")) - 1).alias("box_no"), "polygon", F.when(best > 0, c("mean") / best).otherwise(c("mean")).alias("confidence"))


def placed_boxes(boxes: DataFrame, raster: tuple[float, float], image: tuple[float, float]) -> DataFrame:
    """detected_boxes on the image's scale (whole pixels, cut towards zero), fitted to it, without those that lie within
    another of the page; `box` is the polygon's upright box."""
    wide, high = image[0] / raster[0], image[1] / raster[1]
    fit = lambda v, most: F.greatest(F.least(v.cast("long"), F.lit(int(most))), F.lit(0)).cast("double")
    scaled = boxes.withColumn("polygon", F.transform("polygon", lambda p: F.array(fit(p[0] * wide, image[0]), fit(p[1] * high, image[1]))))
    scaled = scaled.withColumn("box", G.from_polygon(F.col("polygon")))
    # A window, not a join of the boxes with themselves: what they come from is made once.
    df = scaled.withColumn("_others", F.collect_list(F.struct("box_no", "polygon", "box")).over(Window.partitionBy(*PAGE)))

    def holds(o: Column) -> Column:
        a, b = o["box"], F.col("box")
        return (o["polygon"] != F.col("polygon")) & (a != b) & (a["x0"] <= b["x0"]) & (a["y0"] <= b["y0"]) & (a["x1"] >= b["x1"]) & (a["y1"] >= b["y1"])

    return df.filter(~F.exists("_others", holds)).drop("_others")
