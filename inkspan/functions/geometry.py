"""Geometry of boxes: struct columns (x0, y0, x1, y1), every function an expression for code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0, y0, x1, y1) -> Column:
    as_column = lambda c: c if isinstance(c, Column) else F.col(c) if isinstance(c, str) else F.lit(float(c))
    return F.struct(*[as_column(c).cast("double").alias(n) for c, n in zip((x0, y0, x1, y1), ("x0", "y0", "x1", "y1"), strict=True)])


def is_box(values: Column) -> Column:
    """An array of exactly four numbers."""
    return F.coalesce((F.size(values) == 4) & ~F.exists(values, lambda v: v.isNull()), F.lit(False))


def is_polygon(corners: Column) -> Column:
    return F.coalesce((F.size(corners) == 4) & F.forall(corners, lambda c: F.size(c) == 2), F.lit(False))


def width(b: Column) -> Column:
    return b["x1"] - b["x0"]


def height(b: Column) -> Column:
    return b["y1"] - b["y0"]


def area(b: Column) -> Column:
    return width(b) * height(b)


def envelope(a: Column, b: Column) -> Column:
    return box(F.least(a["x0"], b["x0"]), F.least(a["y0"], b["y0"]), F.greatest(a["x1"], b["x1"]), F.greatest(a["y1"], b["y1"]))


def intersects(a: Column, b: Column) -> Column:
    """Strictly, on both axes."""
    return (a["x0"] < b["x1"]) & (a["x1"] > b["x0"]) & (a["y0"] < b["y1"]) & (a["y1"] > b["y0"])


def intersects_any(a: Column, others: Column) -> Column:
    return F.exists(others, lambda o: intersects(a, o))


def overlap_share(a: Column, b: Column) -> Column:
    """Of a's area, the part within b. A box without area that b touches has share 1."""
    w, h = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.when((w < 0) | (h < 0), 0.0).when(area(a) == 0, 1.0).otherwise(F.try_divide(w * h, area(a)))


def element_overlap_share(a: Column, b: Column) -> Column:
    """overlap_share, but 0 for a box without area."""
    return F.when(area(a) == 0, 0.0).otherwise(overlap_share(a, b))


def intersection_area(a: Column, b: Column, margin=0) -> Column:
    """Of a with b shrunk by margin."""
    m = margin if isinstance(margin, Column) else F.lit(float(margin))
    w = F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"] - m) - F.greatest(a["x0"], b["x0"] + m))
    return w * F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"] - m) - F.greatest(a["y0"], b["y0"] + m))


def intersection_share(a: Column, b: Column, margin: float = 0) -> Column:
    """margin is a share of the smaller width, rounded down."""
    m = F.floor(F.least(width(a), width(b)) * margin) if margin else 0
    return F.when(area(a) == 0, 0.0).otherwise(F.try_divide(intersection_area(a, b, m), area(a)))


def covered_over(a: Column, others: Column, share: float) -> Column:
    """Whether the areas that others (an array of boxes) have in common with a are over that share of its own. Areas are
    added up, not shares: their sum is exact for coordinates in halves and does not hang on the order. A box without
    area that one of them touches is covered."""
    common = F.aggregate(F.transform(others, lambda o: intersection_area(a, o)), F.lit(0.0), lambda s, v: s + v)
    touches = lambda o: (a["x0"] <= o["x1"]) & (a["x1"] >= o["x0"]) & (a["y0"] <= o["y1"]) & (a["y1"] >= o["y0"])
    return F.when(area(a) == 0, F.exists(others, touches)).otherwise(common > share * area(a))


def should_merge(a: Column, b: Column, tolerance: float = 5) -> Column:
    """b goes on to the right of a on the same line."""
    near = lambda x, y: F.abs(x - y) < tolerance
    return (b["x0"] > a["x0"]) & near(b["y0"], a["y0"]) & near(b["y1"], a["y1"]) & near(b["x0"], a["x1"])


def rescale(b: Column, old: Column, new: Column) -> Column:
    """b from the frame `old` to the frame `new`, both boxes."""
    sx, sy = F.try_divide(width(old), width(new)), F.try_divide(height(old), height(new))
    return box(F.try_divide(b["x0"], sx), F.try_divide(b["y0"], sy), F.try_divide(b["x1"], sx), F.try_divide(b["y1"], sy))


def rescale_pixels(b: Column, old: tuple[float, float], new: tuple[float, float], rounded: bool = False) -> Column:
    """b between image sizes, in whole pixels: toward zero, or to the nearest (half to even)."""
    sx, sy = new[0] / old[0], new[1] / old[1]
    whole = (lambda x: F.bround(x).cast("int")) if rounded else (lambda x: x.cast("int"))
    return box(whole(b["x0"] * sx), whole(b["y0"] * sy), whole(b["x1"] * sx), whole(b["y1"] * sy))


def from_thousandths(b: Column, w, h) -> Column:
    w, h = (x if isinstance(x, Column) else F.lit(float(x)) for x in (w, h))
    return box(w * (b["x0"] / 1000), h * (b["y0"] / 1000), w * (b["x1"] / 1000), h * (b["y1"] / 1000))


def from_unit(b: Column, w, h) -> Column:
    """To one decimal, half to even."""
    w, h = (x if isinstance(x, Column) else F.lit(float(x)) for x in (w, h))
    return box(F.bround(b["x0"] * w, 1), F.bround(b["y0"] * h, 1), F.bround(b["x1"] * w, 1), F.bround(b["y1"] * h, 1))


def to_polygon(b: Column) -> Column:
    """Corners clockwise from the top left."""
    return F.array(F.array(b["x0"], b["y0"]), F.array(b["x1"], b["y0"]), F.array(b["x1"], b["y1"]), F.array(b["x0"], b["y1"]))


def from_polygon(p: Column) -> Column:
    """From the first three corners, put in order."""
    x, y, u, v = p[0][0], p[0][1], p[1][0], p[2][1]
    return box(F.least(x, u), F.least(y, v), F.greatest(x, u), F.greatest(y, v))


def fit(b: Column, bounds: Column) -> Column:
    x, y = (lambda v: F.greatest(F.least(v, bounds["x1"]), bounds["x0"])), (lambda v: F.greatest(F.least(v, bounds["y1"]), bounds["y0"]))
    return box(x(b["x0"]), y(b["y0"]), x(b["x1"]), y(b["y1"]))


def floor_to(b: Column, divisor: float) -> Column:
    down = lambda v: F.floor(v / divisor) * divisor
    return box(down(b["x0"]), down(b["y0"]), down(b["x1"]), down(b["y1"]))


def rotate(b: Column, angle: Column, w, h) -> Column:
    """By 90, 180 or 270 degrees within an image of size (w, h)."""
    w, h = (x if isinstance(x, Column) else F.lit(float(x)) for x in (w, h))
    return (
        F.when(angle == 90, box(h - b["y1"], b["x0"], h - b["y0"], b["x1"]))
        .when(angle == 180, box(w - b["x1"], h - b["y1"], w - b["x0"], h - b["y0"]))
        .when(angle == 270, box(b["y0"], w - b["x1"], b["y1"], w - b["x0"]))
        .otherwise(b)
    )


def to_device(b: Column, rotation: Column, w: Column, h: Column, normalize: bool = False) -> Column:
    """A box in page space (y upward) to device space (y downward), turned by the page's rotation."""
    flipped = box(b["x0"], h - b["y1"], b["x1"], h - b["y0"])
    turned = (
        F.when(rotation == 90, box(h - flipped["y1"], flipped["x0"], h - flipped["y0"], flipped["x1"]))
        .when(rotation == 180, box(w - flipped["x1"], h - flipped["y1"], w - flipped["x0"], h - flipped["y0"]))
        .when(rotation == 270, box(flipped["y0"], w - flipped["x1"], flipped["y1"], w - flipped["x0"]))
        .otherwise(flipped)
    )
    return box(turned["x0"] / w, turned["y0"] / h, turned["x1"] / w, turned["y1"] / h) if normalize else turned


def line_angle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """In degrees; null for a vertical line."""
    return F.degrees(F.atan(F.try_divide(y1 - y0, x1 - x0)))


def line_intersection(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Overlap of two intervals over the shorter; negative for a gap."""
    return F.try_divide(F.least(a1, b1) - F.greatest(a0, b0), F.least(a1 - a0, b1 - b0))


def overlap_ratio(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return (F.least(a1, b1) - F.greatest(a0, b0)) / (F.greatest(a1 - a0, b1 - b0) + 0.0001)


def center_offset(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.try_divide(F.abs((b1 + b0) / 2 - (a1 + a0) / 2), F.greatest(a1 - a0, b1 - b0))


def height_difference(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    tall = F.greatest(a1 - a0, b1 - b0)
    return F.try_divide(tall - F.least(a1 - a0, b1 - b0), tall)


def distance(a: Column, b: Column) -> Column:
    """Of the top left corners."""
    return F.sqrt((a["x0"] - b["x0"]) * (a["x0"] - b["x0"]) + (a["y0"] - b["y0"]) * (a["y0"] - b["y0"]))
