"""Substring deduplication by content-defined chunks.

A gear hash rolls over a text's UTF-8 bytes, h = (h << 2) + T[byte] in 32 bits, so it depends on the last 16
bytes alone; a text is cut where its leading bits are zero, at least MIN bytes after the last cut. An
insertion moves the cuts near it and no others. Chunks are compared by 64-bit digests. A digest that occurs
again, in the same or another document, marks its chunks, and a maximal run of marked chunks in a
document, of min_run bytes and min_chunks chunks at least, is a repeated passage. The first occurrence of
each digest (the smallest doc_id, then position) stays; later ones may be cut out.

A null or empty text has no chunks; a text without a cut is one chunk, cut again every MAX bytes; equal
texts repeat as a whole where they are long enough for a run; an empty table gives no rows. Rows of equal doc_id
are one document with the text that comes first (`one_text_each`); rows without a doc_id have no passages, and the
filter lets them pass. Digests are counted before the shuffle that gathers them, and a frequent digest meets its
chunks in a join that Spark can split. Only positions and digests are moved, never texts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm.common import arrow_map, documents, join_found, one_text_each, own_columns, row_slices, slice_hashes, stored, utf8

MIN, MAX = 16, 1024
#: One position in 2 ** BITS is a candidate: chunks have MIN + 2 ** BITS bytes on average.
BITS = 4
#: A passage's least bytes and chunks, unless asked otherwise.
MIN_RUN, MIN_CHUNKS = 96, 3

_rng = np.random.Generator(np.random.PCG64(20240607))
GEAR = _rng.integers(0, 1 << 32, 256, dtype=np.uint32)


def candidates(data: np.ndarray) -> np.ndarray:
    """Positions after which a chunk may end: the gear hash of 16 bytes by doubling."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        nxt = h.copy()
        nxt[step:] += h[:-step] << np.uint32(2 * step)
        h = nxt
    hit = h >> np.uint32(32 - BITS) == 0
    hit[:-1] &= (data[1:] & 0xC0) != 0x80  # never inside a character
    return np.flatnonzero(hit) + 1


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all chunks of all rows, and the number of chunks before each row."""
    found = candidates(data)
    first = np.searchsorted(found, offsets[:-1] + MIN)
    last = np.searchsorted(found, offsets[1:])
    found = found.tolist()
    out, counts = [], [0]
    for a, b, i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), first.tolist(), last.tolist(), strict=True):
        at = a
        for c in (*found[i:j], b):
            if c - at < MIN and c != b:
                continue
            while c - at > MAX:
                at += MAX
                while at > a and data[at] & 0xC0 == 0x80:
                    at -= 1
                out.append(at)
            if c > at:
                out.append(c)
                at = c
        counts.append(len(out))
    return np.array(out, np.int64), np.array(counts, np.int64)


def _chunk_rows(batches):
    import pyarrow as pa

    for batch in batches:
        all_data, all_offsets = utf8(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for a, b in row_slices(all_offsets):
            data, offsets = all_data[all_offsets[a] : all_offsets[b]], all_offsets[a : b + 1] - all_offsets[a]
            if not len(data):
                continue
            ends, counts = chunk_ends(data, offsets)
            rows = np.repeat(np.arange(b - a), np.diff(counts))
            starts = np.where(np.arange(len(ends)) == counts[rows], offsets[rows], np.concatenate([[0], ends[:-1]]))
            digests = slice_hashes(data, starts, ends).view(np.int64)
            order = np.lexsort((digests, rows))  # stable: of a row's equal digests, the first comes first
            firsts = np.ones(len(digests), bool)
            firsts[order[1:]] = (digests[order[1:]] != digests[order[:-1]]) | (rows[order[1:]] != rows[order[:-1]])
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            lists = lambda v, t: pa.ListArray.from_arrays(counts.astype(np.int32), pa.array(v, t))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[a:b]), lists(digests, pa.int64()), lists((chars[ends] - chars[offsets[rows]]).astype(np.int32), pa.int32()), lists((ends - starts).astype(np.int32), pa.int32()), lists(firsts, pa.bool_())], names=["doc_id", "digests", "ends", "sizes", "firsts"]
            )


def _run_rows(batches, min_run: int, min_chunks: int):
    import pyarrow as pa

    for batch in batches:
        out = {k: [] for k in ("doc_id", "start", "end", "n_bytes", "n_chunks", "n_repeated", "first_doc_id", "cuts")}
        for r in batch.to_pylist():
            marks = sorted((m["k"], m["f"]) for m in r["marks"])
            ks = np.array([m[0] for m in marks])
            edges = np.flatnonzero(np.diff(ks) != 1) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(ks)], strict=True):
                a, b = int(ks[lo]), int(ks[hi - 1])
                n_bytes = sum(r["sizes"][a : b + 1])
                if n_bytes < min_run or b - a + 1 < min_chunks:
                    continue
                begin = lambda k: r["ends"][k - 1] if k else 0
                later = [k for k, f in marks[lo:hi] if f != r["doc_id"] or not r["firsts"][k]]
                cuts: list[list[int]] = []  # [start, end) of what repeats something earlier
                for k in later:
                    if cuts and cuts[-1][1] == begin(k):
                        cuts[-1][1] = r["ends"][k]
                    else:
                        cuts.append([begin(k), r["ends"][k]])
                for k, v in zip(out, (r["doc_id"], begin(a), r["ends"][b], n_bytes, b - a + 1, len(later), min(f for _, f in marks[lo:hi]), cuts), strict=True):
                    out[k].append(v)
        kinds = {"start": pa.int32(), "end": pa.int32(), "n_chunks": pa.int32(), "n_repeated": pa.int32(), "cuts": pa.list_(pa.list_(pa.int32()))}
        yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()})


def repeated_passages(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_run: int = MIN_RUN, min_chunks: int = MIN_CHUNKS) -> DataFrame:
    """One row for each repeated passage: doc_id, start and end (code points), n_bytes, n_chunks, n_repeated
    (chunks that occurred earlier), first_doc_id (the earliest document that shares a chunk) and cuts (the
    ranges that occurred earlier). With min_run and min_chunks of 1, every repeated chunk is in a passage."""
    docs = one_text_each(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id")
    chunked = stored(arrow_map(docs, _chunk_rows, "doc_id long, digests array<long>, ends array<int>, sizes array<int>, firsts array<boolean>"))
    chunks = chunked.select("doc_id", F.posexplode("digests").alias("k", "digest"))
    often = stored(chunks.groupBy("digest").agg(F.min("doc_id").alias("f"), F.count("*").alias("c")).filter("c > 1").select("digest", "f"))
    marks = chunks.join(often, "digest").groupBy("doc_id").agg(F.collect_list(F.struct("k", "f")).alias("marks"))
    fewer = marks.filter(F.size("marks") >= min_chunks)
    schema = "doc_id long, start int, end int, n_bytes long, n_chunks int, n_repeated int, first_doc_id long, cuts array<array<int>>"
    return arrow_map(fewer.join(chunked.select("doc_id", "ends", "sizes", "firsts"), "doc_id"), lambda b: _run_rows(b, min_run, min_chunks), schema)


def drop_repeated_passages(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """df with what repeats an earlier passage cut out of its texts. Of rows of equal doc_id, those with the text
    that stands for them are cut."""
    cuts = repeated_passages(df, doc_id, text, **how).groupBy("doc_id").agg(F.sort_array(F.flatten(F.collect_list("cuts"))).alias("_cuts")).select(F.col("doc_id").alias("_doc"), "_cuts")
    starts = F.concat(F.array(F.lit(0)), F.transform("_cuts", lambda c: c[1]))
    t = F.col("_row").getField(text)
    ends = F.concat(F.transform("_cuts", lambda c: c[0]), F.array(F.length(t)))
    kept = F.array_join(F.zip_with(starts, ends, lambda a, b: F.substring(t, a + 1, b - a)), "")
    return join_found(df, cuts, doc_id, text).select(*own_columns(df, {text: F.when(F.col("_cuts").isNull(), t).otherwise(kept)}))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of all documents."""
    return repeated_passages(documents(spark, sf_dir)).withColumn("cuts", F.array_join(F.transform("cuts", lambda c: F.concat_ws(":", c[0], c[1])), ","))
