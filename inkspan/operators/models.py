"""Where models plug in: a typed table in, a typed table out, a callable between them.

`load` runs once in each Python worker and `predict` gets the loaded model and a batch of rows, so weights
are never part of a plan. A batch's size is Arrow's (spark.sql.execution.arrow.maxRecordsPerBatch)."""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkspan.schemas import OCR_LINES, ORDER_BOXES, REGIONS, TABLE_TOKENS, TEXT_LINES, schema

_LOADED: dict = {}

#: What each seam gives.
OUTPUTS: dict[str, T.StructType] = {
    "line_detection": TEXT_LINES,
    "layout": REGIONS,
    "reading_order": ORDER_BOXES,
    "recognition": OCR_LINES,
    "table_structure": TABLE_TOKENS,
    "formula": schema("doc_id long, page_id int, region_id int, latex string"),
    "edit_labels": schema("doc_id long, global_index int, labels array<string>"),
}


@dataclass(frozen=True)
class Limits:
    """Fixed values."""

    image_dpi: int = 96
    layout_score: float = 0.35
    line_overlap: float = 0.7
    order_boxes: int = 255
    formula_tokens: int = 384


def run_model(df: DataFrame, seam: str, load: Callable[[], object], predict: Callable[[object, object], object], name: str | None = None) -> DataFrame:
    """Rows of df through a model; `predict(model, pandas frame)` gives a frame of the seam's columns. A reused
    worker keeps a model that has a name; without one, each call loads its own."""
    out, key = OUTPUTS[seam], (seam, name or uuid.uuid4().hex)

    def run(frames: Iterator):
        model = _LOADED.get(key) or _LOADED.setdefault(key, load())
        for f in frames:
            yield predict(model, f)[out.names]

    return df.mapInPandas(run, out)


def apply_formulas(found: DataFrame, regions: DataFrame, limits: Limits | None = None) -> DataFrame:
    """regions (doc_id, page_id, region_id, text, tokens) with the recognised formula where it is good."""
    from inkspan.operators.pages import replacement_is_good

    limits = limits or Limits()
    joined = regions.join(found, ["doc_id", "page_id", "region_id"], "left")
    good = F.coalesce(replacement_is_good(F.col("tokens"), F.col("latex"), F.col("text"), limits.formula_tokens), F.lit(False))
    return joined.withColumns({"text": F.when(good, F.concat(F.lit("$$"), "latex", F.lit("$$"))).otherwise(F.col("text")), "replaced": good}).drop("latex", "tokens")


#: Runs of characters that bytes of one-byte Western encodings stand for.
_WESTERN = re.compile("[\u0080-\u00ff\u0152\u0153\u0160\u0161\u0178\u017d\u017e\u0192\u02c6\u02dc\u2013\u2014\u2018-\u201a\u201c-\u201e\u2020-\u2022\u2026\u2030\u2039\u203a\u20ac\u2122]{2,}")


def mended(text: str) -> str:
    """text with UTF-8 that was read as a one-byte Western encoding read anew, canonically composed."""

    def byte(c: str) -> bytes:
        try:
            return c.encode("cp1252")
        except UnicodeError:  # one of the few bytes that this encoding leaves out
            return c.encode("latin-1")

    def anew(m: re.Match) -> str:
        try:
            return b"".join(map(byte, m[0])).decode("utf-8")
        except UnicodeError:
            return m[0]

    while (again := _WESTERN.sub(anew, text)) != text:  # it may have happened more than once; each time text gets shorter
        text = again
    return unicodedata.normalize("NFC", text)


def repair_unicode(df: DataFrame, text: str, repair: Callable[[str], str] = mended) -> DataFrame:
    """Texts through a repair of wrongly decoded characters."""

    @F.pandas_udf(T.StringType())
    def run(c):
        return c.map(lambda s: None if s is None else repair(s))

    return df.withColumn(text, run(text))


def top_scores(boxes: DataFrame, keys: list[str], scores: str, k: int = 100, least: float = 0.35) -> DataFrame:
    """Detections of each image (keys): of all its boxes' class scores (boxes: keys, idx, an array of scores) the k best,
    ties by box, then class, and of these the ones above `least`."""
    flat = boxes.select(*keys, "idx", F.posexplode(scores).alias("label_id", "score"))
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "idx", "label_id")
    return flat.withColumn("rank", F.row_number().over(w)).filter((F.col("rank") <= k) & (F.col("score") > least))


def greedy_decode(step: Callable[[list[list[int]]], object], prefixes: list[list[int]], most: int, eos: int, allowed: list[int] | None = None, blocked: list[int] = ()) -> list[list[int]]:
    """Token ids after each prefix: `step` gives the scores of all tokens after each of the sequences; the best one that
    is allowed goes on, ties by id, until `eos` or `most` tokens in all. Finished sequences leave the batch."""
    import numpy as np

    out, open_ = [list(p) for p in prefixes], [i for i, p in enumerate(prefixes) if len(p) < most]
    while open_:
        scores = np.array(step([out[i] for i in open_]), float)
        if allowed is not None:
            mask = np.ones(scores.shape[1], bool)
            mask[allowed] = False
            scores[:, mask] = -np.inf
        scores[:, list(blocked)] = -np.inf
        for i, t in zip(open_, scores.argmax(axis=1).tolist(), strict=True):
            out[i].append(t)
        open_ = [i for i in open_ if out[i][-1] != eos and len(out[i]) < most]
    return out
