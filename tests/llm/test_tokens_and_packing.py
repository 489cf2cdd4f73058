import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkspan.llm import packing, tokens
from tests.llm import data


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda s: np.array(t.encode(s, add_special_tokens=False).ids + [1], "<u4")


def rows_of(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_encoder_equals_the_library(library):
    odd = ["It's 123abc, DON'T!! <|endoftext|>x é İ ﬁ ÿ×÷", "\x00\x1f a\x85b\xa0c ß ẞ ''s 's", "...", "", "a1b2c3,d4;e5 a1b2"]
    texts = odd + [t for t in data.texts() if t]
    for keep in (10, 200, 100_000):
        e = tokens.Encoder(keep=keep)
        for _ in range(2):
            for t in texts:
                assert e(*rows_of([t]))[0].tolist() == library(t)[:-1].tolist()
        ids, bounds = e(*rows_of(texts), 1)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [library(t).tolist() for t in texts]


def test_another_vocabulary_goes_through_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    e, t = tokens.Encoder("byte_bpe_50k.json"), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert not e.cuts and tokens.Encoder().cuts
    texts = ["Two  words, it's", "", "naïve\n\nx"]
    ids, bounds = e(*rows_of(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=80), st.data())
@settings(max_examples=60, deadline=None)
def test_packed_ids_are_read_at_any_place(bits, ids, draw):
    ids = np.array(ids, "<u4") & np.uint32((1 << bits) - 1)
    a = draw.draw(st.integers(0, len(ids) - 1))
    b = draw.draw(st.integers(a, len(ids)))
    assert (tokens.unpack(tokens.pack(ids, bits), bits, a, b) == ids[a:b]).all()


def test_token_files(spark, tmp_path, library):
    got = {r["doc_id"]: r for r in tokens.op8_token_files(spark, data.write(spark, tmp_path, data.frame(spark, True))).collect()}
    start = 0
    for d, t, *_ in data.rows():
        ids = library(t or "")
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)
    assert len(got) == len(data.rows())
    assert tokens.op8_token_files(spark, data.write(spark, tmp_path, data.empty(spark))).count() == 0


def test_packing(spark, tmp_path, library):
    df = data.frame(spark, True)
    ids = {d: library(t or "") for d, t, *_ in data.rows()}
    got = packing.op3_best_fit_packing(spark, data.write(spark, tmp_path, df)).toPandas()
    for r in got.itertuples():
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length]) == r.ids_crc32
        assert r.start == 4096 * r.piece and (r.length == 4096 or r.start + r.length == len(ids[r.doc_id]))
    assert got["length"].sum() == sum(map(len, ids.values()))
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == [0, *g["length"].cumsum()[:-1]] and g["length"].sum() <= 4096
    assert packing.op3_best_fit_packing(spark, data.write(spark, tmp_path, data.empty(spark))).count() == 0


def test_sum_of_squares_takes_the_best_gap():
    rng = np.random.Generator(np.random.PCG64(1))
    lengths, cap = rng.integers(1, 20, 300), 20
    bins, offsets = packing.sum_of_squares(lengths, cap)
    fill = {}
    for s, b, o in zip(lengths.tolist(), bins.tolist(), offsets.tolist(), strict=True):
        counts = np.bincount([cap - f for f in fill.values() if f < cap], minlength=cap + 1)
        options = {}
        for g in range(s, cap):
            if counts[g]:
                c = counts.copy()
                c[g] -= 1
                c[g - s] += g > s
                options[g] = int((c * c).sum())
        assert o == fill.get(b, 0)
        if b in fill:
            assert options[cap - fill[b]] == min(options.values())
        else:
            assert not options
        fill[b] = o + s
        assert fill[b] <= cap


def test_repeated_rows_null_and_large_ids(spark, tmp_path, library):
    rows = data.odd_rows()
    path = data.write(spark, tmp_path, spark.createDataFrame(rows, data.SCHEMA).repartition(3))
    want = sorted((d is not None, d or 0, len(library(t or "")), zlib.crc32(library(t or ""))) for d, t, *_ in rows)
    got = [(r["doc_id"], r["n_tokens"], r["ids_crc32"], r["start"]) for r in tokens.op8_token_files(spark, path).collect()]
    assert sorted((d is not None, d or 0, n, c) for d, n, c, _ in got) == want
    start = 0
    for d, n, _, s in sorted(got, key=lambda x: x[3]):
        assert s == start
        start += n
    assert [(d is not None, d or 0) for d, *_ in sorted(got, key=lambda x: x[3])] == [x[:2] for x in want]
    packed = packing.op3_best_fit_packing(spark, path).collect()
    whole = {}
    for r in packed:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
    per = {}
    for known, d, n, _ in want:
        per[d if known else None] = per.get(d if known else None, 0) + n
    assert whole == per
    assert sum(r["piece"] == 0 for r in packed) == len(rows)
