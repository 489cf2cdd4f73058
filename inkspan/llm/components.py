"""Distributed union-find: the connected components of a table of links.

Alternating large and small stars: every vertex hands its larger neighbours (then its smaller ones) to the
smallest vertex it sees, until no edge moves. The table never gains rows, the number of rounds grows with
the logarithm of the longest path, and each round is written to the shared scratch folder. Minima are
aggregated before the shuffle; the joins that follow have a plain exchange on both sides, so that a vertex
with very many links can be split. What has at most SMALL links (16 bytes each) is settled by one task instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.llm.common import arrow_map, discard, once_stored, stored

#: Links that one task takes: a few MB.
SMALL = 1 << 19


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    joined = both.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    out = stored(out.filter("a <> b").distinct())
    discard(least, edges)
    return out


def _settled(batches):
    """(id, component) of all links of the batches, which are few."""
    import numpy as np
    import pyarrow as pa

    pairs = [(batch.column("a").to_numpy(), batch.column("b").to_numpy()) for batch in batches if batch.num_rows]
    if not pairs:
        return
    ends = np.concatenate([np.concatenate(x) for x in zip(*pairs, strict=True)])
    ids, at = np.unique(ends, return_inverse=True)
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    half = len(at) // 2
    for x, y in zip(at[:half].tolist(), at[half:].tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:  # numbers follow ids, so the smaller one leads
            root[max(x, y)] = min(x, y)
    yield pa.RecordBatch.from_pydict({"id": pa.array(ids), "component": pa.array(ids[[find(x) for x in range(len(ids))]])})


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60, small: int | None = None) -> DataFrame:
    """(id, component) for every vertex of a link: component is the smallest vertex that it reaches."""
    edges = stored(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct())
    if edges.count() <= (SMALL if small is None else small):
        return once_stored(arrow_map(edges.coalesce(1), _settled, "id long, component long"), edges)
    mark = None
    for _ in range(rounds):
        edges = _star(_star(edges, True), False)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components have not settled")
    return once_stored(edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select(F.col("b"), F.col("b")).distinct()), edges)
