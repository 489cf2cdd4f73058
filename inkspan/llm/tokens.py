"""Token ids of whole texts, and files of them.

A vocabulary whose pre-tokeniser never joins text across ASCII white space gives a text the ids of its
white-space-separated chunks, one after another. `Encoder` uses that where a vocabulary's file says so: it
keeps the ids of chunks it has met (a bounded table, emptied when full) and sends only new ones to
the tokenizers library. Any other vocabulary gets whole texts.

Files: a folder of Parquet parts, each row a block of whole documents in ascending order:
    shard, block, first_token (long, within the shard), doc_ids, ends (tokens of the block up to and
    with each document), payload (ids packed at `bits` bits each, little-endian bit order).
`bits` is the least number that holds the vocabulary's largest id. `ends` gives random access: an id at
position p of a block stands at bit p * bits, so any range is unpacked with numpy on its own. Parquet's
statistics of first_doc and last_doc lead a reader of one document to its block. Spark's writers commit
the parts, so lost or repeated tasks leave no partial files.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm.common import arrow_map, documents, double_hashes, fields, owned, row_slices, scratch_folder, utf8, word_bounds

VOCABULARY = "word_bpe_49k.json"
END = 1
#: Words an Encoder knows at most; at some 60 bytes each.
KEEP = 1 << 20
BLOCK_TOKENS = 1 << 16


#: Letters that are their own canonical composition and have a one-to-one lower case, and chunks of
#: them with ASCII digits and marks, one to a line. The apostrophe is left out: the pre-tokeniser cuts at some endings.
_PLAIN = re.compile(r"[\n!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
#: Of their lower-case Latin-1 bytes: line ends 0, letters 1, digits 2, marks 3.
_KIND = np.full(256, 3, np.uint8)
_KIND[10] = 0
_KIND[[*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = 1
_KIND[48:58] = 2
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The letter that stands for each byte in byte-level vocabularies; white space stays as it is.
_LETTERS = np.arange(256, dtype="<u4")
_LETTERS[[b for b in range(256) if b not in _KEPT]] = 256 + np.arange(256 - len(_KEPT))
_LETTERS[[10, 32]] = 10, 32


def cut_plain(text: str) -> bytes:
    """Lower-cased plain chunks, a space between the parts of each."""
    t = np.frombuffer(text.lower().encode("latin-1"), np.uint8)
    kind = _KIND[t]
    one, two = kind[:-1], kind[1:]
    at = np.flatnonzero(((one != two) | (one == 2)) & (one > 0) & (two > 0)) + 1
    return np.insert(t, at, 32).tobytes().decode("latin-1").encode()


#: What `plain` chunks take for granted of a vocabulary: how it normalises and cuts (fixed values of its file).
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_CUTTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class Table:
    """What is known of words: a table of their 128-bit hashes with open addressing, read and filled by vectors,
    and the ids of each. It doubles up to `most` words; beyond that it starts anew."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self._room(1 << 12)
        self.n, self.starts, self.pool = 0, np.zeros((1 << 11) + 1, np.int64), np.zeros(1 << 14, "<u4")

    def _room(self, slots: int) -> None:
        self.mask = np.int64(slots - 1)
        self.keys, self.checks, self.numbers = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64), np.full(slots, -1, np.int32)

    def find(self, h: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Number of each word, or -1."""
        slot, out = h.view(np.int64) & self.mask, np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        while len(left):
            number = self.numbers[slot]
            same = (self.keys[slot] == h) & (self.checks[slot] == c) & (number >= 0)
            out[left[same]] = number[same]
            on = ~same & (number >= 0)
            left, slot, h, c = left[on], (slot[on] + 1) & self.mask, h[on], c[on]
        return out

    def _place(self, h: np.ndarray, c: np.ndarray, numbers: np.ndarray) -> None:
        slot = h.view(np.int64) & self.mask
        while len(h):
            free = self.numbers[slot] < 0
            self.numbers[slot[free]] = numbers[free]  # of several for one slot, the last stays
            won = free & (self.numbers[slot] == numbers)
            self.keys[slot[won]], self.checks[slot[won]] = h[won], c[won]
            slot, h, c, numbers = (slot[~won] + 1) & self.mask, h[~won], c[~won], numbers[~won]

    def add(self, h: np.ndarray, c: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """New words and the ids of each, one after another; each word once."""
        n = self.n + len(h)
        while 2 * n > len(self.keys):
            used = np.flatnonzero(self.numbers >= 0)
            old = self.keys[used], self.checks[used], self.numbers[used]
            self._room(2 * len(self.keys))
            self._place(*old)
        if n >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(max(n, len(self.starts)), np.int64)])
        base = self.starts[self.n]
        self.starts[self.n + 1 : n + 1] = base + np.cumsum(counts)
        if base + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(ids), len(self.pool)), "<u4")])
        self.pool[base : base + len(ids)] = ids
        self._place(h, c, np.arange(self.n, n, dtype=np.int32))
        self.n = n

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after another, and how many each has."""
        first = self.starts[numbers]
        counts = self.starts[numbers + 1] - first
        return self.pool[np.arange(int(counts.sum())) + np.repeat(first - (np.cumsum(counts) - counts), counts)], counts


class Encoder:
    """Ids of texts as unsigned 32-bit integers."""

    def __init__(self, vocabulary: str = VOCABULARY, keep: int = KEEP):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary) if "/" not in vocabulary else vocabulary)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.known = Table(keep)
        said = json.loads(self.tokenizer.to_str())
        #: Whether texts may be cut at white space, and plain chunks further; else the library gets whole texts.
        self.cuts = (said["normalizer"], said["pre_tokenizer"], said["model"].get("end_of_word_suffix")) == (_NORMALIZER, _CUTTER, "</w>")
        # The same model behind a plainer splitter, for chunks whose pieces are certain.
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = WhitespaceSplit()
        self.last = np.zeros(self.size, bool)
        self.last[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]] = True
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)")

    def forget(self) -> None:
        self.known.clear()

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [np.array(g.ids, "<u4") for g in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, "<u4"), *got]), np.array([len(g) for g in got], np.int64)

    def _words(self, data: np.ndarray, offsets: np.ndarray, learn) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words of the rows, how many each word has, and words before each row; learn(words, h, c) adds
        words that are not known, each given once."""
        starts, ends, before = word_bounds(data, offsets)
        h, c = double_hashes(data, starts, ends)
        numbers = self.known.find(h, c)
        miss = np.flatnonzero(numbers < 0)
        if len(miss):
            _, first = np.unique(h[miss], return_index=True)
            if learn == self._learn and self.known.n and self.known.n + 2 * len(first) > self.known.most:
                self.known.clear()
                return self._words(data, offsets, learn)
            new = miss[first]
            raw = data.tobytes()
            learn([raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)], h[new], c[new])
            numbers[miss] = self.known.find(h[miss], c[miss])
        ids, counts = self.known.ids(numbers)
        return ids, counts, before

    def _learn(self, new: list[bytes], h: np.ndarray, c: np.ndarray) -> None:
        """Adds new chunks. A plain chunk is cut into runs of letters, digits and runs of marks, each of which
        is encoded once, whatever chunks it stands in; others go through the whole tokenizer."""
        text = b"\n".join(new).decode()
        if not _PLAIN(text) or self.special.search(text):
            texts = text.split("\n")
            plain = np.array([bool(_PLAIN(x)) and not self.special.search(x) for x in texts])
            self.known.add(h[~plain], c[~plain], *self._library(list(compress(texts, ~plain))))
            text, h, c = "\n".join(compress(texts, plain)), h[plain], c[plain]
        if not len(h):
            return
        cut = np.frombuffer(cut_plain(text), np.uint8)
        lines = np.concatenate([[0], np.flatnonzero(cut == 10) + 1, [len(cut)]])
        ids, counts, before = self._words(cut, lines, self._learn_parts)
        sums = np.concatenate([[0], np.cumsum(counts)])[before]
        fresh = self.known.find(h, c) < 0  # a chunk that is its own part is known by now
        self.known.add(h[fresh], c[fresh], ids[np.repeat(fresh, np.diff(sums))], np.diff(sums)[fresh])

    def _learn_parts(self, new: list[bytes], h: np.ndarray, c: np.ndarray) -> None:
        """Each part is a word to the model; its last token has a word's end."""
        words = b" ".join(new)
        words = (words.decode() if words.isascii() else _LETTERS[np.frombuffer(words, np.uint8)].tobytes().decode("utf-32-le")).split(" ")
        got = self.pieces.encode_batch_fast([" ".join(words[k : k + 50]) for k in range(0, len(words), 50)], add_special_tokens=False)
        ids = np.concatenate([np.array(g.ids, "<u4") for g in got])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(new):
            raise ValueError("the vocabulary does not mark each word's end")
        self.known.add(h, c, ids, np.diff(ends, prepend=0))

    def __call__(self, data: np.ndarray, offsets: np.ndarray, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of UTF-8 bytes, each with `end` after it, and where each row's begin."""
        if self.cuts:
            ids, counts, before = self._words(data, offsets, self._learn)
            bounds = np.concatenate([[0], np.cumsum(counts)])[before]
        else:
            ids, counts = self._library([data[a:b].tobytes().decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
            bounds = np.concatenate([[0], np.cumsum(counts)])
        if end is None:
            return ids, bounds
        n = len(offsets) - 1
        out = np.full(len(ids) + n, end, "<u4")
        out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(bounds))] = ids
        return out, bounds + np.arange(n + 1)


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(vocabulary: str = VOCABULARY, keep: int = KEEP) -> Encoder:
    """One for each Python worker, which outlives its tasks."""
    if (vocabulary, keep) not in _ENCODERS:
        _ENCODERS[vocabulary, keep] = Encoder(vocabulary, keep)
    return _ENCODERS[vocabulary, keep]


def encoded(batch, encode: Encoder, end: int | None, limit: int = 1 << 18) -> Iterator[tuple]:
    """doc_ids (an Arrow array: they may be null), ids and bounds of an Arrow batch's rows, as much at a time as a
    CPU's cache holds; a null text is empty."""
    keys = batch.column("doc_id")
    data, offsets = utf8(batch.column("text"))
    for a, b in row_slices(offsets, limit):
        yield keys.slice(a, b - a), *encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], end)


def bits_of(vocabulary_size: int) -> int:
    return max(1, int(vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Fixed-width packing; at 8, 16 or 32 bits the plain integers."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(wide.reshape(-1), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids start to stop of a block, from the bytes that hold them alone."""
    if bits in (8, 16, 32):
        w = bits // 8
        return np.frombuffer(payload, f"<u{w}", stop - start, start * w).astype("<u4")
    a, b = start * bits, stop * bits
    raw = np.unpackbits(np.frombuffer(payload, np.uint8, (b + 7) // 8 - a // 8, a // 8), bitorder="little")
    wide = np.zeros((stop - start, 32), np.uint8)
    wide[:, :bits] = raw[a % 8 : a % 8 + b - a].reshape(-1, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


FILE_SCHEMA = "shard int, block int, first_token long, first_doc long, last_doc long, bits int, n_tokens long, doc_ids array<long>, ends array<long>, payload binary"


def write_tokens(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, end: int | None = END) -> None:
    """Writes the ids of all rows, in ascending order of doc_id (shard by shard, block by block)."""
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def blocks(rows):
        import pyarrow as pa
        from pyspark import TaskContext

        encode, shard = encoder(vocabulary), TaskContext.get().partitionId()
        bits = bits_of(encode.size)
        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first_token", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("bits", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("payload", pa.binary())])
        block = done = size = 0
        held: list[tuple] = []

        def flush():
            nonlocal block, done, size
            keys = pa.concat_arrays([k for k, _, _ in held])
            lengths, ids = (np.concatenate(x) for x in list(zip(*held, strict=True))[1:])
            row = [shard, block, done, keys[0].as_py(), keys[-1].as_py(), bits, len(ids), keys.to_pylist(), np.cumsum(lengths), pack(ids, bits)]
            out = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, schema.types, strict=True)], schema=schema)
            block, done, size = block + 1, done + len(ids), 0
            held.clear()
            return out

        for batch in rows:
            for keys, ids, bounds in encoded(batch, encode, end):
                at = 0  # rows up to the one that fills a block
                while at < len(keys):
                    stop = min(len(keys), int(np.searchsorted(bounds, bounds[at] + BLOCK_TOKENS - size, "left")))
                    stop = max(stop, at + 1)
                    held.append((keys.slice(at, stop - at), np.diff(bounds[at : stop + 1]), ids[bounds[at] : bounds[stop]]))
                    size, at = size + int(bounds[stop] - bounds[at]), stop
                    if size >= BLOCK_TOKENS:
                        yield flush()
        if held:
            yield flush()

    ordered = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    arrow_map(ordered, blocks, FILE_SCHEMA).write.option("compression", "uncompressed").mode("overwrite").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of the files, and each shard's first token over all shards as `shard_start`.

    Only shards' totals are gathered for that: a row for each part of the files."""
    blocks = spark.read.schema(fields(FILE_SCHEMA)).parquet(path)
    totals = sorted((r["shard"], r["n"]) for r in blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    rows, start = [], 0
    for shard, n in totals:
        rows.append((shard, start))
        start += n
    starts = spark.createDataFrame(rows, "shard int, shard_start long")
    return blocks.join(F.broadcast(starts), "shard")


def document_tokens(blocks: DataFrame, ids: bool = False) -> DataFrame:
    """One row per document from the blocks: where it starts, its length, the CRC of its ids, the ids if asked for."""

    def unpacked(rows):
        import pyarrow as pa

        for batch in rows:
            out = {k: [] for k in ("doc_id", "start", "n_tokens", "ids_crc32", "ids")}
            for r in batch.to_pylist():
                all_ids = unpack(r["payload"], r["bits"], 0, r["n_tokens"])
                base, a = r["shard_start"] + r["first_token"], 0
                for d, b in zip(r["doc_ids"], r["ends"], strict=True):
                    out["doc_id"].append(d)
                    out["start"].append(base + a)
                    out["n_tokens"].append(b - a)
                    out["ids_crc32"].append(zlib.crc32(all_ids[a:b]))
                    if ids:
                        out["ids"].append(all_ids[a:b].astype(np.int64))
                    a = b
            if not ids:
                out.pop("ids")
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.list_(pa.int64()) if k == "ids" else pa.int64()) for k, v in out.items()})

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids
    return arrow_map(blocks.select("doc_ids", "ends", "payload", "bits", "n_tokens", "first_token", "shard_start"), unpacked, schema)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token files of all documents, then returns what the files hold of each.

    A null text is empty and has the end id alone; equal doc_ids keep a row each; rows without a doc_id come
    first; an empty table writes no block and returns no row."""
    path = scratch_folder(spark, "tokens")
    write_tokens(documents(spark, sf_dir), path)
    return document_tokens(owned(read_tokens(spark, path), path))
