"""Near-duplicates by bottom-k sketches.

Each document's distinct word shingles are hashed once; the k smallest hashes are its sketch. Documents
with equal sets collapse to one (the smallest doc_id) by a digest of the set. Inverted lists of retained
hashes then bring documents together: linked documents share most of their sketches, so it is enough that
each document enters the lists of its rarest retained hashes, as many as leave less than the least possible
overlap outside (a prefix filter). Frequent passages are the commonest hashes and come last. What the
lists bring together is estimated on union sketches and confirmed on full sets (see links.py).

Nulls and texts without words have no shingles and are linked with nothing. A text with fewer words than a
shingle has one, its whole sequence. Equal texts share a component; an empty table gives no rows. Rows of equal
doc_id are one document with the text that comes first (`one_text_each`), and each has its result; rows without a
doc_id have none, and the filter lets them pass. Hashes in a set have 52 bits, digests of sets 128: two of n
distinct shingles of one pair of documents collide with a chance of about n^2 / 2^53.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm.common import LOWER, arrow_map, as_rows, discard, documents, maybe_in, mix, one_text_each, own_columns, repeated, row_sets, row_slices, slice_hashes, stored, utf8, word_bounds
from inkspan.llm.links import SKETCH, classes


def word_shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each row, and where each row's begin."""
    starts, ends, before = word_bounds(data, offsets)
    h = slice_hashes(LOWER[data], starts, ends)
    factor = np.uint64(0x9E3779B97F4A7C15)
    n = np.diff(before)
    counts = np.where(n < words, np.minimum(n, 1), n - words + 1)
    begins = np.concatenate([[0], np.cumsum(counts)])
    m = max(len(h) - words + 1, 0)
    s = h[:m].copy()
    for i in range(1, words):
        s = s * factor + h[i : m + i]
    short = np.flatnonzero((n < words) & (n > 0))
    where = np.arange(int(begins[-1])) + np.repeat(before[:-1] - begins[:-1], counts)
    where[begins[short]] = 0
    out = mix(s)[where] if m else np.zeros(len(where), np.uint64)
    for i in short.tolist():  # the whole sequence; its length keeps it apart from full shingles
        x = int(n[i])
        for w in h[before[i] : before[i + 1]].tolist():
            x = (x * int(factor) + w) & ((1 << 64) - 1)
        out[begins[i]] = x
    out[begins[short]] = mix(out[begins[short]])
    return out, begins


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """Size, digest and sketch of the set of each of docs (item, text)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids = batch.column("item").to_numpy(zero_copy_only=False)
            for a, b in row_slices(offsets, 1 << 19):
                flat, begins = row_sets(*word_shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words))
                yield pa.RecordBatch.from_pydict(_sketch_rows(ids[a:b], flat, begins))

    return arrow_map(docs, run, "item long, n long, d0 long, d1 long, sketch array<long>")


def _sketch_rows(ids, flat, begins):
    import pyarrow as pa

    raw, at = flat.tobytes(), (8 * begins).tolist()
    digests = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(at[:-1], at[1:], strict=True)]
    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    n = np.diff(begins)
    cut = np.minimum(n, SKETCH)
    ends = np.cumsum(cut)
    sketch = flat[np.arange(int(ends[-1])) + np.repeat(begins[:-1] - (ends - cut), cut)]
    lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), sketch)
    return {"item": pa.array(ids), "n": pa.array(n), "d0": pa.array(halves[:, 0]), "d1": pa.array(halves[:, 1]), "sketch": lists}


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): component_id is the smallest doc_id reachable over links."""
    rows = df.select(F.col(doc_id).cast("long").alias("item"), F.col(text).alias("text"))
    again = repeated(rows, "item")
    docs = rows.filter("item is not null") if again is None else one_text_each(rows, "item")
    sketched = stored(_sketches(docs, words))
    full = sketched.filter("n > 0")
    # One of each group of equal sets goes on.
    groups = stored(full.groupBy("d0", "d1", "n").agg(F.min("item").alias("first"), F.count("*").alias("c")))
    several = groups.filter("c > 1").select("d0", "d1", "n", "first")
    copies = full.select("item", "d0", "d1", "n").join(several, ["d0", "d1", "n"]).select("item", "first")
    copies = stored(copies)
    first = stored(full.join(copies.filter("item <> first").select("item"), "item", "left_anti").select("item", "n", "sketch"))

    # Rarest retained hashes; those of one document alone lead nowhere but count as the rarest.
    retained = first.select("item", F.size("sketch").alias("k"), F.explode("sketch").alias("bucket"))
    often = stored(retained.groupBy("bucket").agg(F.count("*").alias("f")).filter("f > 1"))
    ranked = maybe_in(retained, "bucket", often.select("bucket")).join(often, "bucket").groupBy("item", "k").agg(F.sort_array(F.collect_list(F.struct("f", "bucket"))).alias("s"))
    k = F.col("k")
    p = percent / 100
    o = F.when(100 * k <= percent * SKETCH, F.ceil(percent * k / 100)).otherwise(F.floor(p * k - 4.5 * F.sqrt(p * (1 - p) * k)))
    entries = F.greatest(F.lit(0), (k - o + 1) - (k - F.size("s"))).cast("int")
    members = ranked.select("item", F.explode(F.slice("s", F.lit(1), entries)).alias("e")).select(F.col("e.bucket").alias("bucket"), "item")
    members = stored(members)
    discard(often)
    involved = stored(members.select("item").distinct())
    sketches = stored(maybe_in(first, "item", involved).join(involved, "item", "left_semi"))

    def texts_of(items: DataFrame) -> DataFrame:
        return maybe_in(docs, "item", items).join(items, "item", "left_semi")

    parts = classes(members, sketches, texts_of, lambda data, offsets: word_shingles(data, offsets, words), percent)
    discard(members, first, involved, sketches)
    roots = copies.join(parts.withColumnRenamed("id", "first"), "first", "left").select("item", F.coalesce("component", "first").alias("component"))
    singles = parts.join(copies.select(F.col("item").alias("id")), "id", "left_anti").select(F.col("id").alias("item"), "component")
    out = sketched.select("item", "n").join(roots.union(singles), "item", "left")
    if again is not None:
        out = rows.select("item").join(out, "item")
    component = F.coalesce("component", "item")
    return out.select(F.col("item").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), (component == F.col("item")).alias("kept"))


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Rows of df without those that another of their component stands for; rows of equal doc_id stay or go together."""
    gone = near_duplicates(df, doc_id, text, **how).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return as_rows(df).join(gone, F.col("_row").getField(doc_id) == F.col("_gone"), "left_anti").select(*own_columns(df))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents over 4-word shingles at a Jaccard similarity of 0.8."""
    return near_duplicates(documents(spark, sf_dir), words=4)
