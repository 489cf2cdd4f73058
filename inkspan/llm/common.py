"""Helpers that several operators share: tables, scratch folders, batches of text as byte vectors."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Word separators of every contract: space and the five ASCII controls.
WS = "\t\n\x0b\x0c\r "
MASK64 = (1 << 64) - 1


#: Rows of an Arrow batch: texts of some KB each make it a few MB, on either side of the pipe.
BATCH_ROWS = 2000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    set_up(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def set_up(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def arrow_map(df: DataFrame, run, schema: str) -> DataFrame:
    """df.mapInArrow, whose Python worker gives freed memory back to the system after each task."""

    def task(batches):
        import ctypes

        import pyarrow as pa

        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return df.mapInArrow(task, schema)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; where that is unset, a folder of this machine, which
    only a local master may use."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return os.path.join(tempfile.gettempdir(), "checkpoints")


#: Spark's own switch: an execution's shuffle files go as it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OPEN: list[list[DataFrame]] = []


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def scratch_folder(spark: SparkSession, kind: str = "table") -> str:
    """A new path in the shared scratch folder."""
    return f"{scratch_root(spark)}/inkspan-{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Writes df as Parquet in the shared scratch folder and reads it back: a cut in the lineage that outlives
    executors. What was shuffled to make it goes as soon as it is written. The folder is deleted by `discard`
    or with its `scope`; a table that a returned DataFrame has yet to read stays to the application's end."""
    spark = df.sparkSession
    path = scratch_folder(spark)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    discard(*df.__dict__.pop("_inkspan_reads", ()))
    return owned(spark.read.schema(df.schema).parquet(path), path)


def owned(df: DataFrame, path: str) -> DataFrame:
    """df, which reads a scratch folder that goes with it, or else when the application ends."""
    fs, p = _file_system(df.sparkSession, path)
    fs.deleteOnExit(p)
    df._inkspan_path = path
    if _OPEN:
        _OPEN[-1].append(df)
    return df


def once_stored(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """df, which reads stored tables that go as soon as df itself is stored."""
    df._inkspan_reads = tables
    return df


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing yet to run reads."""
    for df in tables:
        path = df.__dict__.pop("_inkspan_path", None)
        if path:
            fs, p = _file_system(df.sparkSession, path)
            fs.delete(p, True)
            fs.cancelDeleteOnExit(p)


def keep(df: DataFrame) -> DataFrame:
    """Takes a stored table out of the scope that would delete it."""
    for tables in _OPEN:
        tables[:] = [x for x in tables if x is not df]
    return df


@contextlib.contextmanager
def scope():
    """Deletes, at its end, every table stored meanwhile: for what has been written elsewhere by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        discard(*_OPEN.pop())


#: Bits of the filter below, 1 MB.
FILTER_BITS = 1 << 23


def flag_in(df: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """df with a boolean column: true where the key is in keys (one column), and by chance elsewhere. Put before
    a join that shuffles df, it leaves most of df where it is while keys are few against FILTER_BITS; beyond
    that it says true throughout. The filter is a bitmap of hashes: what is broadcast never exceeds 1 MB."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)) + 1
    p = place(F.col(keys.columns[0]))
    bitmaps = keys.select(F.bitmap_bucket_number(p).alias("_bucket"), F.bitmap_bit_position(p).alias("_bit")).groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))
    p = place(F.col(key))
    at = F.bitmap_bit_position(p)
    byte = F.conv(F.hex(F.substring("_bitmap", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    out = df.withColumn("_bucket", F.bitmap_bucket_number(p)).join(F.broadcast(bitmaps), "_bucket", "left")
    return out.select(*df.columns, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)).alias(name))


def maybe_in(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of df whose key is in keys, and others by chance (see flag_in)."""
    return flag_in(df, key, keys, "_maybe").filter("_maybe").drop("_maybe")


def repeated(df: DataFrame, key: str) -> DataFrame | None:
    """The keys (stored) that several rows have, if there are any; only keys are shuffled."""
    again = stored(df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows")).filter("_rows > 1").select(key))
    if again.isEmpty():
        discard(again)
        return None
    return again


def one_text_each(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs (key, text) without rows whose key is null; of rows with equal keys, one with the text that comes
    first in byte order (a null only where there is no other)."""
    docs, again = docs.filter(F.col(key).isNotNull()), repeated(docs, key)
    if again is None:
        return docs
    first = maybe_in(docs, key, again).join(again, key, "left_semi").groupBy(key).agg(F.min(text).alias(text))
    return docs.join(again, key, "left_anti").unionByName(first.select(*docs.columns))


def as_rows(df: DataFrame) -> DataFrame:
    """df with all its columns in one, `_row`: whatever they are called, they meet no other name in a join."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def own_columns(df: DataFrame, new: dict[str, Column] | None = None) -> list[Column]:
    """What `as_rows` packed, with new values for some of df's columns."""
    return [((new or {}).get(c, F.col("_row").getField(c))).alias(c) for c in df.columns]


def join_found(df: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """`as_rows` of df, left-joined with what was found in the texts that `one_text_each` takes: found has `_doc`,
    the key, and columns of its own. Of rows with equal keys, those with that text get them."""
    keyed = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    again = repeated(keyed, "_key")
    mine = F.col("_row").getField(key), F.col("_row").getField(text)
    on = mine[0] == F.col("_doc")
    if again is not None:
        taken = one_text_each(keyed.join(again, "_key", "left_semi"), "_key", "_text")
        found = found.join(taken.select(F.col("_key").alias("_doc"), F.xxhash64("_text").alias("_taken")), "_doc", "left")
        on &= F.coalesce(F.xxhash64(mine[1]) == F.col("_taken"), F.lit(True))
    return as_rows(df).join(found, on, "left")


def fields(schema: str) -> T.StructType:
    return T._parse_datatype_string(schema)


def n_words(text: Column) -> Column:
    """Words of the contract in a text, as an array."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


# ---- sets of hashes ---------------------------------------------------------------------------

#: Bits of a hash in a set; the others number a row among ROWS while sets are sorted together.
HASH_BITS, ROWS = 52, 4096


def _keys(hashes: np.ndarray, begins: np.ndarray, a: int, b: int) -> np.ndarray:
    """The sorted distinct (row, hash) of rows a to b, as single integers."""
    flat = hashes[begins[a] : begins[b]] >> np.uint64(64 - HASH_BITS)
    keys = flat | np.repeat(np.arange(b - a, dtype=np.uint64) << np.uint64(HASH_BITS), np.diff(begins[a : b + 1]))
    keys.sort()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new]


def row_sets(hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes (their HASH_BITS highest bits) of each range, and where each row's begin."""
    flat, sizes = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
    for a in range(0, len(begins) - 1, ROWS):
        b = min(a + ROWS, len(begins) - 1)
        keys = _keys(hashes, begins, a, b)
        flat.append((keys & np.uint64((1 << HASH_BITS) - 1)).view(np.int64))
        sizes.append(np.bincount((keys >> np.uint64(HASH_BITS)).view(np.int64), minlength=b - a))
    return np.concatenate(flat), np.cumsum(np.concatenate(sizes))


def pair_sizes(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the intersection, and of both sets together, of the i-th ranges of two lists of hashes."""
    n = len(one[1]) - 1
    common, both = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for a in range(0, n, ROWS):
        b = min(a + ROWS, n)
        keys = np.concatenate([_keys(*one, a, b), _keys(*two, a, b)])
        keys.sort()
        row = (keys >> np.uint64(HASH_BITS)).view(np.int64)
        both[a:b] = np.bincount(row, minlength=b - a)
        common[a:b] = np.bincount(row[1:][keys[1:] == keys[:-1]], minlength=b - a)
    return common, both


# ---- batches of texts as numpy vectors -------------------------------------------------------


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow string column's bytes and row offsets, without copies; null is empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = 1 << 20):
    """Ranges of rows of about `limit` bytes, one row at least: bounds the vectors below."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield start, min(stop, n)
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser of 64-bit hashes (in place)."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE, _INVERSE = np.uint64(0x5851F42D4C957F2D), np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        _POWERS[:] = [powers(_BASE, 2 * n), powers(_INVERSE, 2 * n)]
    return _POWERS[0], _POWERS[1]


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range: a difference of prefix sums, shifted to the origin."""
    up, down = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64))


_OTHER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def double_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each byte range."""
    up, down = _tables(len(data) + 1)
    out = []
    for table in (_BYTES, _OTHER):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[: len(data)], out=sums[1:])
        out.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
    return out[0], out[1]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words of all rows, and the number of words before each row."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True  # a row's first byte
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)
