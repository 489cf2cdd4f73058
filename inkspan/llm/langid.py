"""Language identification by hierarchical discrimination.

A first stage predicts the language's family, a second one tells the languages of that family apart; each
stage votes among one-versus-one linear support vector machines over hashed byte trigrams of the
lower-cased text, letters only. Training uses a bounded sample of labelled documents (SAMPLE a language)
in fragments, so that short texts are within what the machines have seen; prediction reads whole texts: a
text's margin is the mean weight of its trigrams, so no feature vector is ever built.

A null text and one without a letter give `und` with score 0, as do all texts when no label can be learned
from. Languages outside FAMILIES form families of their own. Equal texts get equal rows; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm.common import LOWER, arrow_map, documents, row_slices, utf8

#: Families of languages by ISO 639-1 code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "bg", "sr", "mk", "pl", "cs", "sk", "sl", "hr"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he"),
    "indic": ("hi", "ur", "bn", "mr", "ne"),
}
#: Labelled documents a language that training may use at most, their fragments, and a fragment's bytes.
SAMPLE, FRAGMENTS, FRAGMENT = 400, 1200, 160
DIMENSIONS = 1 << 12


def family(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def _letters() -> np.ndarray:
    t = np.full(256, 32, np.uint8)
    for b in (*range(97, 123), *range(128, 256)):
        t[b] = b
    t[65:91] = LOWER[65:91]
    return t


_LETTERS = _letters()


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot of each trigram of all rows, and the first of each row's; every row has one at least."""
    n = len(offsets) - 1
    low = _LETTERS[data]
    if len(low) > 1:  # upper-case Latin-1 letters, two bytes each
        up = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
        low[1:][up] += 0x20
    shift = np.repeat(np.arange(1, n + 1) * 2, np.diff(offsets))
    wide = np.full(len(data) + 2 * (n + 1), 32, np.uint32)
    wide[np.arange(len(data)) + shift] = low
    h = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + wide[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(32 - DIMENSIONS.bit_length() + 1)).astype(np.int32), offsets[:-1] + 2 * np.arange(n)


def _blank_slot() -> int:
    return int(trigrams(np.zeros(0, np.uint8), np.zeros(2, np.int64))[0][0])


def features(texts: list[bytes]) -> np.ndarray:
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    slots, first = trigrams(np.frombuffer(b"".join(texts), np.uint8), offsets)
    rows = np.repeat(np.arange(len(texts)), np.diff(np.append(first, len(slots))))
    x = np.bincount(rows * DIMENSIONS + slots, minlength=len(texts) * DIMENSIONS).reshape(len(texts), DIMENSIONS).astype(np.float32)
    x[:, _blank_slot()] = 0
    return x / np.maximum(x.sum(axis=1, keepdims=True), 1)


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 150) -> tuple[np.ndarray, float]:
    """A linear support vector machine (squared hinge) by accelerated gradients; y is -1 or 1."""
    n, scale = len(x), 1 / max(float(np.sqrt((x * x).sum(axis=1).mean())), 1e-9)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    v, d = w.copy(), 0.0
    weight = np.where(y > 0, n / (2 * max((y > 0).sum(), 1)), n / (2 * max((y < 0).sum(), 1))).astype(np.float32)
    step = 1 / (1 / c + 2 * 2 * float(weight.max()))
    for k in range(rounds):
        gap = np.maximum(0, 1 - y * (scale * (x @ v) + d)) * weight
        g = v / c - 2 * scale * ((y * gap) @ x) / n
        gb = -2 * float((y * gap).mean())
        w_new, b_new = v - step * g, d - step * gb
        m = k / (k + 3)
        v, d = w_new + m * (w_new - w), b_new + m * (b_new - b)
        w, b = w_new, b_new
    return w * scale, b


class Model:
    """Machines by stage: () tells families apart, a family's name its languages."""

    def __init__(self, texts: list[tuple[bytes, str]]):
        self.langs = sorted({lang for _, lang in texts})
        rng = np.random.Generator(np.random.PCG64(7))
        parts: list[bytes] = []
        marks: list[str] = []
        for lang in self.langs:
            cut = [t[i : i + FRAGMENT] for t, x in texts if x == lang for i in range(0, len(t), FRAGMENT)]
            keep = rng.permutation(len(cut))[:FRAGMENTS]
            parts += [cut[i] for i in keep]
            marks += [lang] * len(keep)
        self.stages: dict[str, list[str]] = {"": sorted({family(x) for x in self.langs})}
        for f in self.stages[""]:
            self.stages[f] = [x for x in self.langs if family(x) == f]
        x = features(parts) if parts else np.zeros((0, DIMENSIONS), np.float32)
        self.machines: list[tuple[str, str, str]] = []
        weights, biases = [], []
        for stage, names in self.stages.items():
            for a, b in combinations(names, 2):
                at = np.array([(family(m) if not stage else m) for m in marks])
                use = (at == a) | (at == b)
                w, bias = svm(x[use], np.where(at[use] == a, 1.0, -1.0).astype(np.float32))
                w[_blank_slot()] = 0
                self.machines.append((stage, a, b))
                weights.append(w)
                biases.append(bias)
        self.weights, self.biases = np.array(weights, np.float32).reshape(-1, DIMENSIONS), np.array(biases)

    def _vote(self, stage: str, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and share of the votes' winner among a stage's names."""
        names = self.stages[stage]
        votes = np.zeros((margins.shape[1], len(names)))
        for k, (s, a, b) in enumerate(self.machines):
            if s == stage:
                p = 1 / (1 + np.exp(-3 * np.clip(margins[k], -20, 20)))
                votes[:, names.index(a)] += p
                votes[:, names.index(b)] += 1 - p
        best = votes.argmax(axis=1)
        return best, np.ones(len(best)) if len(names) < 2 else votes[np.arange(len(best)), best] / (len(names) - 1)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each row; rows without letters are the caller's to replace."""
        n = len(offsets) - 1
        slots, first = trigrams(data, offsets)
        count = np.maximum(np.add.reduceat((slots != _blank_slot()).astype(np.int64), first), 1)
        sums = [np.add.reduceat(w[slots].astype(np.float64), first) / count + b for w, b in zip(self.weights, self.biases, strict=True)]
        margins = np.array(sums).reshape(-1, n)
        f, pf = self._vote("", margins)
        langs, scores = np.full(n, "", object), np.zeros(n)
        for i, name in enumerate(self.stages[""]):
            mine = f == i
            best, p = self._vote(name, margins[:, mine])
            langs[mine], scores[mine] = np.array(self.stages[name], object)[best], pf[mine] * p
        return langs, np.clip(scores, 0, 1)


def fit(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """A model from at most `sample` documents of each label (of the least hashes of doc_id)."""
    labelled = df.filter(F.col(lang).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    # Labels are few; a share of hashes for each gives about `sample` rows, and the least hashes are kept.
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    rows: list[tuple[bytes, str]] = []
    chosen = F.lit(False)
    for name, n in counts.items():
        chosen = chosen | ((F.col("lang") == name) & (h < F.lit(int(min(1.0, 1.2 * sample / n) * (1 << 30)))))
    if counts:
        got = labelled.filter(chosen & F.col("text").isNotNull()).select("lang", "text", h.alias("h"), "doc_id").collect()
        for name in sorted(counts):
            mine = sorted((r["h"], r["doc_id"], r["text"]) for r in got if r["lang"] == name)[:sample]
            rows += [(t.encode(), name) for _, _, t in mine]
    return Model(rows)


def identify(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""

    def run(batches):
        import pyarrow as pa

        ascii_letter = np.zeros(256, bool)
        ascii_letter[[*range(65, 91), *range(97, 123)]] = True
        for batch in batches:
            all_data, all_offsets = utf8(batch.column("text"))
            ids = batch.column("doc_id")
            for a, b in row_slices(all_offsets):
                data, offsets = all_data[all_offsets[a] : all_offsets[b]], all_offsets[a : b + 1] - all_offsets[a]
                sums = np.concatenate([[0], np.cumsum(ascii_letter[data])])
                some = sums[offsets[1:]] > sums[offsets[:-1]]
                for i in np.flatnonzero(~some & (np.diff(offsets) > 0)).tolist():
                    some[i] = any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode()))
                langs, scores = model.predict(data, offsets) if model.langs else (np.full(b - a, "und", object), np.zeros(b - a))
                langs[~some], scores[~some] = "und", 0.0
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return arrow_map(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), run, "doc_id long, lang_pred string, score double")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = documents(spark, sf_dir)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    out = identify(docs, fit(docs.filter(~held)))
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
