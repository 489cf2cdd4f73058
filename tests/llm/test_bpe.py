import hashlib
import json
import random

import numpy as np
import pytest

from inkspan.llm import bpe
from tests.llm import data


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def odd():
    rng = random.Random(2)
    out = ["x" * 5000, "ab" * 2000, "日本語" * 2000, "".join(rng.choice("abcdefgh") for _ in range(6000)), " " * 500, " \n" * 300 + "x", "it's we'll DON'T 's"]
    out += ["<|endoftext|>", "a<|endoftext|> <|endoftext|><|endof text|>", "\x00\x1f\x85 　", "é" * 40 + " é" * 40, "é‍👩‍👩‍👧", "0123 4５６", "x" * 63 + " " + "y" * 64 + " " + "z" * 65]
    return out + [t for t in data.texts() if t is not None]


def test_ids_equal_the_library(library):
    texts = odd()
    for keep in (5, 300, 1 << 17):
        model = bpe.Bpe(keep=keep)
        for _ in range(2):
            assert [g.tolist() for g in model.encode_batch(texts)] == [ids_of(library, t) for t in texts]
            assert len(model.known) <= max(keep, max(len(set(model.cut.findall(t))) for t in texts) * len(texts))
    assert model.encode_batch([]) == [] and model.encode("").tolist() == []


def test_words_are_cut_as_by_the_library(library):
    """Every code point, between letters, digits and spaces."""
    model = bpe.Bpe()
    points = [c for c in range(0x3500) if not 0xD800 <= c < 0xE000] + list(range(0xA000, 0xD800, 7)) + list(range(0xE000, 0x20000, 5)) + list(range(0x20000, 0x110000, 401))
    for k in range(0, len(points), 20_000):
        text = "".join(f"a{chr(c)}1 {chr(c)}{chr(c)}  {chr(c)} " for c in points[k : k + 20_000])
        assert model.encode(text).tolist() == ids_of(library, text)


def test_a_long_text_is_cut_in_parts(library, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 64)
    text = data.texts()[20] + " <|endoftext|>" + "w" * 300 + " tail  \n"
    assert bpe.Bpe().encode_batch([text, "", text])[2].tolist() == ids_of(library, text)


def test_short_and_long_forms_agree():
    rng = random.Random(5)
    model = bpe.Bpe()
    words = [bytes(rng.choice(b"aeinrst \xc3\xa9the") for _ in range(rng.randint(1, 64))) for _ in range(400)]
    ids, counts = model.merge(words)
    ends = np.cumsum(counts)
    for w, a, b in zip(words, ends - counts, ends, strict=True):
        assert model.merge_long(w).tolist() == ids[a:b].tolist()


def test_decoding_equals_the_library(library):
    rng = random.Random(1)
    model = bpe.Bpe()
    for _ in range(500):
        ids = [rng.randrange(model.size) for _ in range(rng.randrange(12))]
        assert model.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_other_vocabularies_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.Bpe("word_bpe_49k.json")
    with open(public_tokenizers.path("byte_bpe_50k.json")) as f:
        said = json.load(f)
    said["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "v.json").write_text(json.dumps(said))
    with pytest.raises(ValueError):
        bpe.Bpe(str(tmp_path / "v.json"))


def test_op13(spark, tmp_path, library):
    rows = data.odd_rows() + [(500 + i, t, None, None, 0) for i, t in enumerate(odd())]
    df = spark.createDataFrame(rows, data.SCHEMA).selectExpr("*", "1 as ids", "2 as decoded").repartition(3)
    got = bpe.op13_bpe_codec(spark, data.write(spark, tmp_path, df))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, t, *_ in rows:
        ids = ids_of(library, t or "")
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_general_form(spark):
    """Columns are kept, clashing ones give way; null ids decode to nothing; an empty table stays one."""
    df = spark.createDataFrame([(1, "Two  words", 5), (2, None, 6)], "doc_id long, text string, ids int").selectExpr("*", "1 as `a.b`")
    out = bpe.with_ids(df)
    assert out.columns == ["doc_id", "text", "a.b", "ids"]
    again = bpe.with_text(out.selectExpr("doc_id", "case when doc_id = 1 then ids end as ids"), name="t").collect()
    assert [(r["doc_id"], r["t"]) for r in again] == [(1, "Two  words"), (2, "")]
    assert bpe.with_text(bpe.with_ids(data.empty(spark))).collect() == []
