"""Best-fit packing of token sequences by sums of squares.

A document longer than the capacity is cut into full pieces and a last, shorter one; nothing else is cut.
Pieces are dealt over shards by a hash of their key, so no source or document decides how many rows a
shard has. Each shard places its pieces, longest first, by the sum-of-squares rule: of all gaps of open
bins (and a new bin) that take the piece, it picks the one after which the sum over gaps g of N(g)^2 is
smallest, where N(g) counts the open bins with gap g. Moving a bin from gap g to g - s changes that sum by
2 (N(g-s) - N(g)) + 2, so a placement is one vector operation over gaps. Full bins close.
Shards are few and large, so what is left open at their ends is small against the whole.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm.common import arrow_map, documents, stored
from inkspan.llm.tokens import END, VOCABULARY, encoded, encoder

CAPACITY = 4096
#: Pieces a shard has about; one shard is packed by one task in memory that grows with this alone.
SHARD_PIECES = 20_000


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (1 to capacity), placed in the order given."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    counts = np.zeros(capacity + 1, np.int64)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    far, made = np.int64(1 << 60), 0
    for i, s in enumerate(lengths.tolist()):
        if s == capacity:
            bins[i], offsets[i], made = made, 0, made + 1
            continue
        # Gaps s..capacity-1 of open bins; what they change the sum by. A full bin closes and counts for nothing.
        n = counts[s:capacity]
        change = 2 * (counts[0 : capacity - s] - n) + 2
        change[0] = 1 - 2 * n[0]
        change[n == 0] = far
        k = int(change.argmin())
        # A new bin only where nothing open takes the piece: sequences are to be few.
        if change[k] == far:
            bins[i], offsets[i], gap = made, 0, capacity - s
            b, made = made, made + 1
        else:
            gap = s + k
            b = open_bins[gap].pop()
            counts[gap] -= 1
            bins[i], offsets[i] = b, capacity - gap
            gap -= s
        if gap:
            open_bins[gap].append(b)
            counts[gap] += 1
    return bins, offsets


def pieces(df: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end: int = END, forget: bool = False) -> DataFrame:
    """doc_id, piece, start, length and the CRC of the ids of each piece; a null text is empty. With `forget`,
    a worker's table of known chunks goes at the end of each task, for the sake of what it does next."""

    def cut(rows):
        import pyarrow as pa

        encode = encoder(vocabulary)
        for batch in rows:
            parts = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for keys, ids, bounds in encoded(batch, encode, end):
                n = np.diff(bounds)
                pieces = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                at = (bounds[row] + start).tolist()
                crcs = [zlib.crc32(ids[a : a + k]) for a, k in zip(at, length.tolist(), strict=True)]
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                for k, v, kind in zip(parts, (keys.take(pa.array(row)), piece, start, length, crcs), kinds, strict=True):
                    parts[k].append(v if isinstance(v, pa.Array) else pa.array(v, kind))
            if parts["piece"]:
                yield pa.RecordBatch.from_pydict({k: pa.concat_arrays(v) for k, v in parts.items()})
        if forget:
            encode.forget()

    return arrow_map(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_pieces(cut: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces (a stored table: it is counted, then dealt)."""
    shards = max(1, round(cut.count() / shard_pieces))

    def place(table):
        import pyarrow as pa

        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets = sum_of_squares(table["length"].to_numpy(), capacity)
        shard = table["shard"][0].as_py() if len(table) else 0
        return table.drop_columns(["shard"]).append_column("sequence_id", pa.array(shard * (1 << 40) + bins)).append_column("offset", pa.array(offsets))

    # All that a piece is, and a number of the row for what is equal in that: rows without a doc_id spread like others.
    key = F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32", F.monotonically_increasing_id())
    dealt = cut.withColumn("shard", F.pmod(key, F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(df: DataFrame, **how) -> DataFrame:
    return pack_pieces(stored(pieces(df, **how)), how.get("capacity", CAPACITY))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens, one row per piece.

    A document without text is the end id alone; equal documents, rows of equal doc_id and rows without one are
    packed like others, each by itself; an empty table gives no rows."""
    return pack_documents(documents(spark, sf_dir))
