"""SentencePiece encoding and decoding: Viterbi over an Aho-Corasick automaton of the pieces.

The text is normalised as the model's file says for identity models: a space in front, every space written
as U+2581. One pass of the automaton visits each position once; the pieces that end there, found along
output links, relax the best score of that position. Where no piece is one single character, that
character may stand alone at the lowest piece's score less 10, and is written as its UTF-8 bytes' pieces.
Of equal scores the longer last piece wins. Scores are summed in double precision over a unit.

Units: no piece has U+2581 after another character, and some characters are in no piece at all (the line
feed, mostly), so the best path of a text is made of the best paths of its units: a run of U+2581 with
what follows it, cut at such characters. Each worker keeps the ids of units it has met, up to a bound.

The public vocabulary is of the BPE kind. Its pieces and scores are read here as a unigram model, which is
what Viterbi solves; these are not the ids of its merges. The library's own lattice over the same file,
marked unigram, never finds a better path (it sums in single precision). A null text is empty and has no ids; equal texts have equal ids; decoding returns the text,
but for U+2581 itself, which comes back as a space.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm.common import arrow_map, documents

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
KEEP = 1_500_000


class Codec:
    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int] | None, unknown: int = 0, keep: int = KEEP, normal: list[bool] | None = None):
        """pieces by id; `normal` marks those that text may be cut into; byte_ids by byte."""
        import ahocorasick

        self.pieces, self.byte_ids, self.unknown, self.keep = pieces, byte_ids, unknown, keep
        normal = normal or [True] * len(pieces)
        self.automaton = ahocorasick.Automaton()
        for i, (p, s) in enumerate(pieces):
            if normal[i] and p:
                self.automaton.add_word(p, (len(p), s, i))
        self.automaton.make_automaton()
        used = [p for i, (p, _) in enumerate(pieces) if normal[i] and p]
        self.single = {p for p in used if len(p) == 1}
        self.unknown_score = min((s for i, (_, s) in enumerate(pieces) if normal[i]), default=0.0) - 10
        whole = any(SPACE in p.lstrip(SPACE) for p in used)
        lone = "" if any("\n" in p for p in used) else "\n"
        self.units = re.compile("(?s).+" if whole else f"{lone}|{SPACE}+[^{SPACE}{lone}]*|[^{SPACE}{lone}]+" if lone else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
        self.known: dict[str, bytes] = {}
        self.bytes = [p.replace(SPACE, " ").encode() for p, _ in pieces]
        for b, i in enumerate(byte_ids or []):
            self.bytes[i] = bytes([b])

    @classmethod
    def load(cls, model: str = MODEL, **how) -> Codec:
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model) if "/" not in model else model)
        n = sp.get_piece_size()
        pieces = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(n)]
        normal = [not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
        in_bytes = [i for i in range(n) if sp.is_byte(i)]
        by_name = {pieces[i][0]: i for i in in_bytes}
        byte_ids = [by_name[f"<0x{b:02X}>"] for b in range(256)] if len(in_bytes) == 256 else None
        return cls(pieces, byte_ids, sp.unk_id(), normal=normal, **how)

    def best(self, unit: str) -> list[int]:
        """Ids of the best path through one unit."""
        n, low = len(unit), float("-inf")
        score, back = [0.0] + [low] * n, [(0, 0)] * (n + 1)
        at = 0

        def stand_alone(stop):  # characters that are no piece: each position is final once the pass is beyond it
            nonlocal at
            while at < stop:
                if unit[at] not in self.single and score[at] + self.unknown_score > score[at + 1]:
                    score[at + 1], back[at + 1] = score[at] + self.unknown_score, (1, -1)
                at += 1

        for end, (length, s, i) in self.automaton.iter(unit):
            end += 1
            if at < end - 1:
                stand_alone(end - 1)
            s += score[end - length]
            if s > score[end] or (s == score[end] and length > back[end][0]):
                score[end], back[end] = s, (length, i)
        stand_alone(n)
        out: list[int] = []
        while n:
            length, i = back[n]
            if i >= 0:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in reversed(unit[n - length : n].encode())]
            else:
                out.append(self.unknown)
            n -= length
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit bytes."""
        if not text:
            return b""
        units = self.units(SPACE + text.replace(" ", SPACE))
        known = self.known
        found = list(map(known.get, units))
        if None in found:
            new = {u for u, f in zip(units, found, strict=True) if f is None}
            if len(known) + len(new) > self.keep:
                known.clear()
                new = set(units)
            for u in new:
                known[u] = np.array(self.best(u), "<u4").tobytes()
            found = [known[u] for u in units]
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode()
        return raw[1:] if raw.startswith(" ") else raw


_CODECS: dict[str, Codec] = {}


def codec(model: str = MODEL) -> Codec:
    """One for each Python worker."""
    if model not in _CODECS:
        _CODECS[model] = Codec.load(model)
    return _CODECS[model]


def encode(df: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """(doc_id, ids) of every row, ids as array<int>."""

    def run(batches):
        import pyarrow as pa

        c = codec(model)
        for batch in batches:
            got = [np.frombuffer(c.encode(t or ""), "<i4") for t in batch.column("text").to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(g) for g in got])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(ends, np.concatenate(got) if got else np.zeros(0, np.int32))], names=["doc_id", "ids"])

    return arrow_map(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {df.schema[doc_id].dataType.simpleString()}, ids array<int>")


def decode(df: DataFrame, doc_id: str = "doc_id", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """(doc_id, text) of every row of ids; null ids are an empty text."""

    def run(batches):
        import pyarrow as pa

        c = codec(model)
        for batch in batches:
            texts = [c.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return arrow_map(df.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")), run, f"doc_id {df.schema[doc_id].dataType.simpleString()}, text string")


def op1_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document (their number and CRC as unsigned 32-bit integers), and whether decoding
    them gives the text again."""

    def run(batches):
        import pyarrow as pa

        c = codec()
        for batch in batches:
            out = {k: [] for k in ("n_tokens", "ids_crc32", "round_trip")}
            for t in batch.column("text"):
                t = t.as_py() or ""
                ids = c.encode(t)
                for k, v in zip(out, (len(ids) // 4, zlib.crc32(ids), c.decode(ids) == t.replace(SPACE, " ")), strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(out["n_tokens"], pa.int64()), "ids_crc32": pa.array(out["ids_crc32"], pa.int64()), "round_trip": pa.array(out["round_trip"], pa.bool_())})

    return arrow_map(documents(spark, sf_dir).select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")
