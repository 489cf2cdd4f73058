"""Dictionary phrases in texts: n-grams joined with a dictionary; titles that are like many others."""

from __future__ import annotations

from collections.abc import Sequence
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A dictionary of at most this many bytes (as Spark estimates its plan) is broadcast.
BROADCAST_BYTES = 64 << 20


def phrase_join(texts: DataFrame, dictionary: DataFrame, keys: Sequence[str], text: str, words: int = 2) -> DataFrame:
    """(keys, pos, phrase, tag): lower-cased runs of up to `words` space-separated words that are in the
    dictionary (phrase, tag). A dictionary of unknown or larger size is joined by shuffle."""
    w = F.split(F.lower(F.col(text)), " ", -1)
    grams = texts.select(*keys, w.alias("_w")).select(*keys, F.posexplode(F.transform("_w", lambda x, i: F.array(*[F.array_join(F.slice("_w", i + 1, F.lit(n)), " ") for n in range(1, words + 1)]))).alias("pos", "_g"), F.size("_w").alias("_n"))
    grams = grams.select(*keys, "pos", "_n", F.posexplode("_g").alias("_k", "phrase")).filter(F.col("pos") + F.col("_k") < F.col("_n"))
    size = int(str(dictionary._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    other = F.broadcast(dictionary) if size <= BROADCAST_BYTES else dictionary
    return grams.join(other, "phrase").select(*keys, "pos", "phrase", "tag")


def indel_similar(a: str, b: str, share: float = 0.9) -> bool:
    """Whether insertions and deletions that turn a into b are at most 1 - share of both lengths together: by the
    longest common subsequence, a row of its table at a time in the bits of an integer."""
    total = len(a) + len(b)
    if a == b or not total:
        return True
    head = len(commonprefix((a, b)))  # what both begin and end with is common anyway
    a, b = a[head:], b[head:]
    tail = len(commonprefix((a[::-1], b[::-1])))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    row = whole = (1 << len(a)) - 1
    for c in b:
        used = row & places.get(c, 0)
        row = ((row + used) | (row - used)) & whole
    return total - 2 * (head + tail + len(a) - row.bit_count()) <= (1 - share) * total + 1e-9


PROFILE = 256


def _profile(title: str) -> np.ndarray:
    """How many of a title's pairs of neighbouring characters fall into each of PROFILE buckets. An insertion or deletion
    changes three of these numbers by one at most, so profiles rule titles out without an edit distance."""
    p = np.frombuffer(title.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.bincount((p[:-1] * 31 + p[1:]) % PROFILE, minlength=PROFILE).astype(np.int32)


def common_in(titles: list[str | None], share: float = 0.9, least: float = 3.0, overlap: float = 0.05) -> list[bool]:
    """Which of a document's titles are like at least `least` others, and `overlap` of all. Equal titles are one entry with
    its count. A title's bound is the count of all those that profiles leave; what cannot reach the limit by it,
    or has reached it, needs no exact comparison."""
    counts: dict[str, int] = {}
    for t in titles:
        if t is not None:
            counts[t] = counts.get(t, 0) + 1
    limit = max(least, len(titles) * overlap)
    each = sorted(counts, key=len)
    lengths, times = np.array([len(t) for t in each]), np.array([counts[t] for t in each])
    hits, bound, near = times - 1, times - 1, []
    if len(titles) - 1 < limit:
        return [False] * len(titles)
    profiles = np.array([_profile(t) for t in each])
    for i in range(len(each) - 1):
        most = (1 - share) * (lengths[i] + lengths[i + 1 :]) + 1e-9
        end = i + 1 + int(np.count_nonzero(lengths[i + 1 :] - lengths[i] <= most))  # lengths rise, what is in reach is at the front
        for a in range(i + 1, end, 4096):
            b = min(end, a + 4096)
            j = a + np.flatnonzero(np.abs(profiles[a:b] - profiles[i]).sum(axis=1) <= 3 * most[a - i - 1 : b - i - 1])
            if len(j):
                near.append((i, j))
                bound[i] += times[j].sum()
                bound[j] += times[i]
    for i, js in near:
        for j in js.tolist():
            if (hits[i] < limit <= bound[i] or hits[j] < limit <= bound[j]) and indel_similar(each[i], each[j], share):
                hits[i] += times[j]
                hits[j] += times[i]
    common = {t for t, h in zip(each, hits.tolist(), strict=True) if h >= limit}
    return [t in common for t in titles]


def common_titles(titles: DataFrame, share: float = 0.9, least: float = 3.0, overlap: float = 0.05) -> DataFrame:
    """(doc_id, line_no) of titles (doc_id, line_no, title) that are like at least `least` others of their document, and
    `overlap` of all its titles: one shuffle on the document, no pair is a row; see `common_in`."""

    @F.arrow_udf(T.ArrayType(T.BooleanType()))
    def common(documents: pa.Array) -> pa.Array:
        return pa.array([common_in(d.values.to_pylist(), share, least, overlap) for d in documents], pa.list_(pa.bool_()))

    docs = titles.filter("doc_id is not null").groupBy("doc_id").agg(F.collect_list(F.struct("line_no", "title")).alias("t"))
    each = docs.select("doc_id", F.col("t.line_no").alias("n"), common("t.title").alias("c"))
    return each.select("doc_id", F.explode(F.arrays_zip("n", "c")).alias("z")).filter("z.c").select("doc_id", F.col("z.n").alias("line_no"))
