"""Byte-level BPE: texts to ids and back.

A text is cut at the vocabulary's added tokens, then by its pattern into words. A short word (most are) is merged
in a contiguous array of its parts' ids and of the ranks of adjacent parts: scan for the least rank (the leftmost
of equal ones), delete the boundary between the two parts, look up the ranks on either side of the new part,
and again until no rank is left. A part's id names its bytes, and so its boundaries. Words of similar length
are rows of one matrix, so that each scan and each deletion is a vector operation over all of them. A long word
has its ranks in a queue and its parts in a linked list instead: a scan for each merge would be quadratic.
Words met before keep their ids in a table of bounded size, emptied when full.

Decoding joins the bytes of ids; bytes that are no UTF-8 become replacement characters.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkspan.llm.common import arrow_map, documents

VOCABULARY = "byte_bpe_50k.json"
#: Bytes of a short word, and classes by which short words share a matrix.
SHORT, CLASSES = 64, (4, 6, 8, 12, 16, 24, 32, 64)
#: Words a table knows at most, and the longest of them in code points.
KEEP, KEPT_CHARS = 1 << 17, 64
#: Code points of a text that are cut into words at a time; eight times the words looked up together.
SLICE = 1 << 19
NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 letters for themselves,
    the others, in order, for the code points from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    far = iter(range(256, 512))
    return [chr(b if b in kept else next(far)) for b in range(256)]


def joined(pool: np.ndarray, starts: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The items of a pool's ranges, one range after another, and how many each has."""
    first = starts[numbers]
    counts = starts[numbers + 1] - first
    return pool[np.arange(int(counts.sum())) + np.repeat(first - (np.cumsum(counts) - counts), counts)], counts


class Ranks:
    """Rank by pair of ids: a hash table with open addressing, read by vectors."""

    def __init__(self, pairs: np.ndarray):
        self.bits = max(4, int(4 * len(pairs)).bit_length())
        self.keys, self.ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE)
        left, slot = np.arange(len(pairs)), self._slot(pairs)
        while len(left):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = pairs[left[free]]
            won = self.keys[slot] == pairs[left]
            self.ranks[slot[won]] = left[won]
            left, slot = left[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def __call__(self, pairs: np.ndarray) -> np.ndarray:
        slot = self._slot(pairs)
        found = self.keys[slot]
        out = np.where(found == pairs, self.ranks[slot], NONE)
        left = np.flatnonzero((found != pairs) & (found >= 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot]
            same = found == pairs[left]
            out[left[same]] = self.ranks[slot[same]]
            on = ~same & (found >= 0)
            left, slot = left[on], slot[on]
        return out


class Bpe:
    """A byte-level vocabulary file of the tokenizers library."""

    def __init__(self, vocabulary: str = VOCABULARY, keep: int = KEEP):
        import public_tokenizers
        import regex

        with open(public_tokenizers.path(vocabulary) if "/" not in vocabulary else vocabulary, encoding="utf-8") as f:
            said = json.load(f)
        model, cutter = said["model"], said["pre_tokenizer"] or {}
        plain = {k: model.get(k) or None for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")}
        added = said["added_tokens"]
        if said["normalizer"] or cutter.get("type") != "ByteLevel" or cutter["add_prefix_space"] or not cutter["use_regex"] or any(plain.values()) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("not a plain byte-level vocabulary")
        self.cut = regex.compile(public_tokenizers.PATTERN)
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in added}
        longest = sorted(self.special, key=len, reverse=True)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        letters = byte_letters()
        self.byte_ids = np.array([vocab[c] for c in letters], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.rank = Ranks(np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64))
        two = np.repeat(self.byte_ids, 256).astype(np.int64) * self.size + np.tile(self.byte_ids, 256)
        self.byte_ranks = self.rank(two)
        number = {c: b for b, c in enumerate(letters)}
        texts = [b""] * self.size
        for token, i in vocab.items():
            texts[i] = bytes(number[c] for c in token)
        for token, i in self.special.items():
            texts[i] = token.encode()
        self.pool, self.starts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        self.keep = keep
        self.forget()

    def forget(self) -> None:
        self.known = {t: n for n, t in enumerate(self.special)}
        self.ids, self.begins = np.zeros(1 << 12, np.int32), np.zeros(1 << 10, np.int64)
        self.ids[: len(self.known)] = list(self.special.values())
        self.begins[: len(self.known) + 1] = range(len(self.known) + 1)

    # ---- words to ids

    def merge_short(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of bytes (a row's first `lengths` count) to rows of ids, and how many each has."""
        n, width = words.shape
        cols = np.arange(width)
        out, counts = self.byte_ids[words], lengths.astype(np.int64)
        if width < 2:
            return out, counts
        ranks = self.byte_ranks[words[:, :-1].astype(np.int64) * 256 + words[:, 1:]]
        ranks[cols[1:] >= lengths[:, None]] = NONE
        rows, parts = np.arange(n), out.copy()
        while len(rows):
            at = ranks.argmin(1)
            row = np.arange(len(rows))
            least = ranks[row, at]
            done = least == NONE
            if done.any():
                out[rows[done]] = parts[done]
                keep = ~done
                rows, parts, ranks, at, least = rows[keep], parts[keep], ranks[keep], at[keep], least[keep]
                row = np.arange(len(rows))
                if not len(rows):
                    break
            right = cols[None, :] > at[:, None]
            parts[:, :-1] = np.where(right[:, :-1], parts[:, 1:], parts[:, :-1])
            ranks[:, :-1] = np.where(right[:, : width - 2], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NONE
            counts[rows] -= 1
            parts[row, at] = self.merged[least]
            here = parts[row, at].astype(np.int64)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.rank(parts[left, at[left] - 1].astype(np.int64) * self.size + here[left])
            ranks[row, at] = NONE
            next_ = np.flatnonzero(at + 1 < counts[rows])
            ranks[next_, at[next_]] = self.rank(here[next_] * self.size + parts[next_, at[next_] + 1])
        return out, counts

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one word by a queue of (rank, place)."""
        raw = np.frombuffer(word, np.uint8)
        n = len(raw)
        parts = self.byte_ids[raw].tolist()
        ranks = self.byte_ranks[raw[:-1].astype(np.int64) * 256 + raw[1:]]
        first = np.flatnonzero(ranks != NONE)
        queue = ((ranks[first].astype(np.int64) << 32) | first).tolist()
        heapq.heapify(queue)
        now = ranks.tolist()  # rank of the pair that begins at a place; NONE where it has gone
        ahead, behind = list(range(1, n + 1)), list(range(-1, n - 1))
        none, merged = int(NONE), self.merged
        look = {}

        def rank(a: int, b: int) -> int:
            key = a * self.size + b
            if key not in look:
                look[key] = int(self.rank(np.array([key], np.int64))[0])
            return look[key]

        while queue:
            r, i = divmod(heapq.heappop(queue), 1 << 32)
            if i >= n - 1 or now[i] != r:
                continue
            j = ahead[i]
            parts[i] = int(merged[r])
            k = ahead[i] = ahead[j]
            now[i] = none
            if j < n - 1:
                now[j] = none
            parts[j] = -1
            if k < n:
                behind[k] = i
                now[i] = rank(parts[i], parts[k])
                if now[i] != none:
                    heapq.heappush(queue, (now[i] << 32) | i)
            h = behind[i]
            if h >= 0:
                now[h] = rank(parts[h], parts[i])
                if now[h] != none:
                    heapq.heappush(queue, (now[h] << 32) | h)
        ids = np.array(parts, np.int32)
        return ids[ids >= 0]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        counts, found = np.zeros(len(words), np.int64), []
        low = 0
        for high in CLASSES:
            for some in np.array_split(mine := np.flatnonzero((lengths > low) & (lengths <= high)), max(1, len(mine) * high >> 18)):
                if len(some):
                    within = np.arange(high) < lengths[some, None]
                    block = np.zeros((len(some), high), np.uint8)
                    block[within] = data[(starts[some, None] + np.arange(high))[within]]
                    rows, counts[some] = self.merge_short(block, lengths[some])
                    found.append((some, rows))
            low = high
        for i in np.flatnonzero(lengths > low).tolist():
            row = self.merge_long(words[i])
            counts[i] = len(row)
            found.append((np.array([i]), row[None, :]))
        begins = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int32)
        for some, rows in found:
            within = np.arange(rows.shape[1]) < counts[some, None]
            out[(begins[some, None] + np.arange(rows.shape[1]))[within]] = rows[within]
        return out, counts

    # ---- texts to ids and back

    def _learn(self, new: list[str]) -> None:
        if not new:
            return
        n = len(self.known)
        ids, counts = self.merge([w.encode() for w in new])
        base = int(self.begins[n])
        if n + len(new) >= len(self.begins):
            self.begins = np.concatenate([self.begins, np.zeros(n + len(new), np.int64)])
        if base + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(base + len(ids), np.int32)])
        self.begins[n + 1 : n + len(new) + 1] = base + np.cumsum(counts)
        self.ids[base : base + len(ids)] = ids
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def _look(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after another, and how many each has."""
        new = set(words).difference(self.known)
        long = [w for w in new if len(w) > KEPT_CHARS and w not in self.special]
        if len(self.known) + len(new) > self.keep:
            self.forget()
            new = set(words).difference(self.known)
        self._learn(list(new.difference(long)))
        if not long:
            return joined(self.ids, self.begins, np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
        # Long words are not kept.
        once = {w: self.merge([w.encode()])[0] for w in long}
        runs, done = [], 0
        for i in [*(i for i, w in enumerate(words) if w in once), len(words)]:
            runs.append(self._look(words[done:i]))
            if i < len(words):
                ids = once[words[i]]
                runs.append((ids, np.array([len(ids)])))
            done = i + 1
        return np.concatenate([r for r, _ in runs]), np.concatenate([n for _, n in runs])

    def _runs(self, text: str) -> Iterator[list[str]]:
        """A text's words, added tokens among them, in lists of bounded size."""
        special = self.at_special is not None and any(t in text for t in self.special)
        for part in self.at_special.split(text) if special else (text,):
            if part in self.special:
                yield [part]
            elif len(part) <= SLICE:
                yield self.cut.findall(part)
            else:
                found = (m[0] for m in self.cut.finditer(part))
                while words := list(islice(found, SLICE // 8)):
                    yield words

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; words of many texts are looked up and merged together."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        words: list[str] = []
        whose: list[tuple[int, int]] = []

        def flush():
            ids, counts = self._look(words)
            ends = np.cumsum(counts)
            at = done = 0
            for i, n in whose:
                done += n
                end = int(ends[done - 1]) if done else 0
                out[i].append(ids[at:end])
                at = end
            words.clear()
            whose.clear()

        for i, text in enumerate(texts):
            for run in self._runs(text):
                words += run
                whose.append((i, len(run)))
                if len(words) > SLICE // 8:
                    flush()
        flush()
        return [r[0] if len(r) == 1 else np.concatenate([np.zeros(0, np.int32), *r]) for r in out]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_batch([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        return joined(self.pool, self.starts, np.asarray(ids, np.int64))[0].tobytes().decode("utf-8", "replace")


_MODELS: dict[str, Bpe] = {}


def model(vocabulary: str = VOCABULARY) -> Bpe:
    """One for each Python worker, which outlives its tasks."""
    if vocabulary not in _MODELS:
        _MODELS[vocabulary] = Bpe(vocabulary)
    return _MODELS[vocabulary]


def _with_column(df: DataFrame, source: str, name: str, kind: T.DataType, make) -> DataFrame:
    """df with a column made of another, a batch at a time; one called `name` gives way."""
    at = df.columns.index(source)
    own = [i for i, c in enumerate(df.columns) if c != name]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in own], make(batch.column(at))], names=[f"c{i}" for i in [*own, len(batch.columns)]])

    # Columns go by number meanwhile: any name will do.
    made = [T.StructField(f"c{i}", df.schema.fields[i].dataType) for i in own] + [T.StructField(f"c{len(df.columns)}", kind)]
    return arrow_map(df.toDF(*[f"c{i}" for i in range(len(df.columns))]), run, T.StructType(made)).toDF(*[df.columns[i] for i in own], name)


def with_ids(df: DataFrame, text: str = "text", name: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """df with the ids of each text (array of int; a null text is empty). Each row by itself; an empty table stays empty."""

    def ids(column):
        import pyarrow as pa

        bpe = model(vocabulary)
        rows = bpe.encode_batch([t or "" for t in column.to_pylist()])
        flat = np.concatenate([np.zeros(0, np.int32), *rows])
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), pa.array(flat))

    return _with_column(df, text, name, T.ArrayType(T.IntegerType()), ids)


def with_text(df: DataFrame, ids: str = "ids", name: str = "decoded", vocabulary: str = VOCABULARY) -> DataFrame:
    """df with the text of each row's ids; null ids give an empty text."""

    def text(column):
        import pyarrow as pa

        bpe = model(vocabulary)
        offsets = column.offsets.to_numpy()
        flat = column.values.to_numpy()
        return pa.array([bpe.decode(flat[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.string())

    return _with_column(df, ids, name, T.StringType(), text)


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every text's ids, and the digest of what they decode to.

    Each row by itself, with or without a doc_id; a null text is empty and has no ids; an empty table gives no rows."""
    coded = with_text(with_ids(documents(spark, sf_dir).select("doc_id", "text")).drop("text"))
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
