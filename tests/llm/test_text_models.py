import hashlib
import re
import zlib
from collections import Counter
from math import log

import numpy as np
import pytest

from inkspan.llm import langid, pii, quality, sentencepiece_codec, topk
from tests.llm import data


def test_quality_ledger(spark, tmp_path):
    import duckdb

    path = data.write(spark, tmp_path, data.frame(spark, True))
    got = quality.op6_quality_rules(spark, path).toPandas().sort_values("doc_id").reset_index(drop=True)
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{path}/documents.parquet/*.parquet'")
    want = c.sql(quality.SQL).df().sort_values("doc_id").reset_index(drop=True)
    for column in got.columns:
        assert (got[column] == want[column]).all(), column
    for r, (_, t, *_) in zip(got.itertuples(), data.rows(), strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n = Counter(zip(w, w[1:], w[2:]))
        covered = {j for i, x in enumerate(zip(w, w[1:], w[2:])) if n[x] > 1 for j in (i, i + 1, i + 2)}
        assert (r.n_words, r.n_repeat_words) == (len(w), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.base_failed and r.kept)
    assert quality.op6_quality_rules(spark, data.write(spark, tmp_path, data.empty(spark))).count() == 0


def test_policies_and_ablation(spark):
    df = data.frame(spark, True)
    led = quality.ledger(df).collect()
    bits = [r["failed_rules"] for r in led]
    m = quality.mask("v1")
    for r in quality.ablation(quality.ledger(df)).collect():
        b = quality.mask((r["rule"],))
        assert r["rejected"] == sum(x & m != 0 for x in bits) and r["failed"] == sum(x & b != 0 for x in bits) and r["only_this"] == sum(x & m == b for x in bits)
    kept = quality.apply_quality(df)
    assert kept.columns == df.columns and kept.count() == sum(x & m == 0 for x in bits)


@pytest.fixture(scope="module")
def tagger():
    return pii.Tagger().train(*pii.training_windows([t for t in data.texts() if t and re.search(r"[0-9@(\[]", t)] * 30))


RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base(t):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, t):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (16 <= len(d) <= 19 and pii.luhn(d)) or kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_rule_spans_equal_plain_patterns():
    import random

    rng = random.Random(3)
    samples = [t for t in data.texts() if t] + ["".join(rng.choice("0123456789.+-() @ab") for _ in range(60)) for _ in range(3000)]
    for t in samples:
        assert pii._said(pii.rule_spans(t)) == ",".join(base(t)), t
    assert pii.rule_spans("1.2.3." + "0" * 5000 + "4") == [(1, 0, 5007)] and pii.rule_spans("1.2.3." + "9" * 5000) == []


def test_network_finds_held_out_forms(tagger):
    """Items drawn anew, in texts not trained on; the rules know a part of them only."""
    import random

    rng, hosts = np.random.Generator(np.random.PCG64(77)), [data.words(random.Random(i), 60) for i in range(50)]
    wanted = found = right = ruled = 0
    for k in range(400):
        text, spans = pii.set_in(hosts[k % 50], rng)
        got, rules = set(pii.find_spans([text], tagger)[0]), set(pii.rule_spans(text))
        beyond = set(spans) - rules
        wanted, ruled = wanted + len(beyond), ruled + len(set(spans) & rules)
        found, right = found + len(beyond & got), right + len((got - rules) & set(spans))
    made = sum(len(set(pii.find_spans([t], tagger)[0]) - set(pii.rule_spans(t))) for t in hosts)
    assert wanted > 3 * ruled and found / wanted > 0.85 and made == 0
    total = sum(len(set(pii.find_spans([t], tagger)[0]) - set(pii.rule_spans(t))) for t in (pii.set_in(hosts[k % 50], np.random.Generator(np.random.PCG64(1000 + k)))[0] for k in range(300)))
    good = 0
    for k in range(300):
        text, spans = pii.set_in(hosts[k % 50], np.random.Generator(np.random.PCG64(1000 + k)))
        good += len((set(pii.find_spans([text], tagger)[0]) - set(pii.rule_spans(text))) & set(spans))
    assert good / total > 0.85


def test_spans_longer_than_a_window_are_whole(tagger):
    secret = "0a9b8c7d6e5f4a3b" * 12
    for shift in range(0, 64, 7):
        t = f"{'word ' * 20}{'x' * shift} token = \"{secret}\" and more words after it"
        spans = [x for x in pii.find_spans([t], tagger)[0] if x[0] == 4]
        assert len(spans) == 1 and spans[0][2] - spans[0][1] >= len(secret) - 2, (shift, spans)


def test_pii(spark, tmp_path, tagger):
    got = {r["doc_id"]: r for r in pii.op5_pii(spark, data.write(spark, tmp_path, data.frame(spark, True))).collect()}
    assert len(got) == len(data.rows())
    for d, t, *_ in data.rows():
        want = base(t or "")
        assert got[d]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest() and set(want) <= set(got[d]["spans"].split(","))
        assert got[d]["n_email"] == sum(x.startswith("email") for x in want)
    assert pii.op5_pii(spark, data.write(spark, tmp_path, data.empty(spark))).count() == 0
    df = data.frame(spark, True)
    out = {r["doc_id"]: r for r in pii.redact(df, tagger).collect()}
    i = next(d for d, t, *_ in data.rows() if t and "a.b-1@" in t)
    assert "<EMAIL>" in out[i]["text"] and "<CARD>" in out[i]["text"] and "555-9629" not in out[i]["text"] and out[i]["n_chars"] == len(out[i]["text"])
    assert out[0]["text"] == data.rows()[0][1] and out[13]["text"] is None


def test_tagger_learns_and_gradients_hold(tagger):
    x, y = pii.training_windows([t for t in data.texts() if t and re.search("[0-9@]", t)], 200, seed=9)
    tags = tagger.viterbi(tagger.emissions(x)[0])
    assert (tags == y)[y > 0].mean() > 0.8
    t = pii.Tagger(1)
    x, y = x[:12, :3], y[:12, :3].copy()
    y[:] = 0
    y[2:5, 0] = [1, 2, 2]

    def loss():
        e = t.emissions(x)[0].astype(np.float64)
        z = t.marginals(e)[3]
        trans = t.p["t"] + pii._FORBIDDEN
        gold = np.take_along_axis(e, y[:, :, None], 2).sum(axis=(0, 2)) + sum(trans[y[k - 1], y[k]] for k in range(1, len(y)))
        return float((z - gold).mean())

    g = t.gradients(x, y)
    for name in ("xf", "hb", "o", "t"):
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        keep = t.p[name][at]
        t.p[name][at] = keep + 1e-2
        up = loss()
        t.p[name][at] = keep - 1e-2
        down = loss()
        t.p[name][at] = keep
        assert abs((up - down) / 2e-2 - g[name][at]) < 0.02 * abs(g[name][at]) + 1e-3


def test_windows_are_reconciled():
    assert pii.choose([(0.9, 0, 0, 10), (0.95, 1, 8, 12), (0.5, 2, 11, 20), (0.9, 0, 0, 10)]) == [(0, 0, 10), (2, 11, 20)]
    assert pii.choose([]) == []


def test_language_id(spark, tmp_path):
    lexicon = {"en": "the of and water house thing", "de": "der und wasser haus ding nicht", "fr": "le et eau maison chose pas", "es": "el y agua casa cosa niño"}
    import random

    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(lexicon[x].split(), k=30)), x, "s", 0) for i in range(400) for x in [list(lexicon)[i % 4]]]
    rows += [(1000, None, "en", "s", 0), (1001, "123 .. $", "en", "s", 0), (1002, "", None, "s", 0), (1003, "ß", None, "s", 0), (1004, "the and", None, "s", 0)]
    path = data.write(spark, tmp_path, spark.createDataFrame(rows, data.SCHEMA))
    got = {r["doc_id"]: r for r in langid.op4_language_id(spark, path).collect()}
    assert len(got) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for d, r in got.items())
    assert np.mean([got[d]["lang_pred"] == x for d, _, x, *_ in rows[:400]]) > 0.99
    assert [got[d]["lang_pred"] for d in (1000, 1001, 1002)] == ["und"] * 3 and got[1003]["lang_pred"] != "und" and got[1004]["lang_pred"] == "en"
    assert langid.op4_language_id(spark, data.write(spark, tmp_path, data.empty(spark))).count() == 0
    assert langid.identify(data.frame(spark, True), langid.Model([])).filter("lang_pred <> 'und'").count() == 0


def test_sentencepiece_equals_plain_viterbi(spark, tmp_path):
    c = sentencepiece_codec.Codec.load()
    scores = {p: (s, i) for i, (p, s) in enumerate(c.pieces) if not p.startswith("<")}

    def plain(t):
        t = "▁" + t.replace(" ", "▁") if t else ""
        best = [(0.0, [])] + [(-1e18, [])] * len(t)
        for e in range(1, len(t) + 1):
            for s in range(max(0, e - 20), e):
                p = t[s:e]
                if p in scores and best[s][0] + scores[p][0] > best[e][0]:
                    best[e] = (best[s][0] + scores[p][0], best[s][1] + [scores[p][1]])
            if t[e - 1] not in scores and best[e - 1][0] + c.unknown_score > best[e][0]:
                best[e] = (best[e - 1][0] + c.unknown_score, best[e - 1][1] + [c.byte_ids[b] for b in t[e - 1].encode()])
        return best[-1][1]

    for t in [t[:200] for t in data.texts() if t] + ["  two  spaces ", "a\n\nb", "café 😀"]:
        assert np.frombuffer(c.encode(t), "<u4").tolist() == plain(t), t
        assert c.decode(c.encode(t)) == t
    got = {r["doc_id"]: r for r in sentencepiece_codec.op1_sentencepiece_codec(spark, data.write(spark, tmp_path, data.frame(spark, True))).collect()}
    for d, t, *_ in data.rows():
        assert got[d]["round_trip"] and got[d]["ids_crc32"] == zlib.crc32(c.encode(t or ""))
    df = data.frame(spark, True)
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(df))
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {d: t or "" for d, t, *_ in data.rows()}
    assert sentencepiece_codec.op1_sentencepiece_codec(spark, data.write(spark, tmp_path, data.empty(spark))).count() == 0


@pytest.mark.parametrize("sizes", [(8192, 32), (7, 2)])
def test_topk_equals_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(topk, "SHARD", sizes[0])
    monkeypatch.setattr(topk, "BLOCK", sizes[1])
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    docs = {d: Counter((t or "").encode().translate(low).split()) for d, t, *_ in data.rows()}
    n, average = len(docs), sum(sum(c.values()) for c in docs.values()) / len(docs)
    df = Counter(w for c in docs.values() for w in c)
    frame = data.frame(spark, True)
    got = topk.search(frame, frame, k=4, query_id="doc_id", query="text").toPandas()
    for q, words in docs.items():
        score = Counter()
        for d, c in docs.items():
            for w, k in words.items():
                if w in c:
                    score[d] += k * log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / average))
        want = sorted((-round(s, 6), d) for d, s in score.items())[:4]
        mine = got[got["query_id"] == q].sort_values("rank")
        assert mine["doc_id"].tolist() == [d for _, d in want]
        assert np.allclose(mine["score"], [-s for s, _ in want], atol=1e-5)
    assert topk.search(data.empty(spark), frame, query_id="doc_id", query="text").count() == 0


def _index(texts):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    (made,) = topk._index_rows([batch])
    (_, rows, terms, counts, lengths), = topk._batches([batch])
    df = dict(zip(*np.unique(terms, return_counts=True), strict=True))
    queries = topk.Queries(rows, terms, counts, np.array([df[t] for t in terms.tolist()]), len(texts))
    return made, queries, float(lengths.mean())


def test_topk_multiplies_within_kinds_of_documents():
    rng = np.random.default_rng(3)
    kinds = [[f"{c}{i}" for i in range(200)] for c in "abc"]
    texts = [" ".join([k[0], k[0], k[0], *rng.choice(k[1:], 30).tolist()]) for k in kinds for _ in range(320)]
    made, queries, average = _index(rng.permutation(texts).tolist())
    shard = topk.Shard({c: np.frombuffer(made.column(c)[0].as_buffer(), t) for c, t in topk.INDEX.items()}, queries, average)
    assert len(shard.sections) == 3 and len(shard.number) == 600
    assert sum(s.matrix.size for s in shard.sections) <= 960 * 600 / 3  # a query's columns against its own kind alone


def test_topk_tasks_start_from_scores_found_elsewhere(spark, monkeypatch):
    texts = [f"one two {'three ' * (i % 7)} w{i % 11} w{i % 13}" for i in range(80)]
    made, queries, average = _index(texts)
    whole = topk._search_rows(queries, average, 3)
    (rows,) = whole([made])
    found = rows.to_pandas().groupby("query_id").score.min().rename("score").reset_index()
    import pyarrow as pa

    queries.start_from(pa.Table.from_pandas(found))
    queries.floors += 1e-3 * queries.floors  # as if better ones were known
    (fewer,) = whole([made])
    least = dict(zip(found["query_id"], found["score"], strict=True))
    assert 0 < fewer.num_rows < rows.num_rows and all(r["score"] > least[r["query_id"]] for r in fewer.to_pylist())
    # Shards (one a task) searched in two parts give what one search gives.
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    want = topk.search(frame, frame, k=4, query_id="doc_id", query="text").sort("query_id", "rank").collect()
    parts, search = [], topk._search
    monkeypatch.setattr(topk, "AHEAD", 2)
    monkeypatch.setattr(topk, "_search", lambda index, *how: parts.append(index.count()) or search(index, *how))
    assert topk.search(frame, frame, k=4, query_id="doc_id", query="text").sort("query_id", "rank").collect() == want
    assert len(parts) == 2 and sum(parts) == 8 and all(parts)


def test_topk_adds_up_frequencies_in_parts(monkeypatch):
    import pyarrow as pa

    texts = [f"w{i % 3} w{i % 5} v{i} v{i // 2}" for i in range(40)] + [None, ""]
    batches = [pa.RecordBatch.from_pydict({"doc_id": pa.array([i]), "text": pa.array([t], pa.string())}) for i, t in enumerate(texts)]
    want = Counter()
    for batch in batches:
        for _, _, terms, _, _ in topk._batches([batch]):
            want.update(terms.tolist())
    for most in (8, 24, 1 << 20):
        monkeypatch.setattr(topk, "COUNTED", most)
        rows = [r for batch in topk._count_rows(batches) for r in batch.to_pylist()]
        got = Counter()
        for r in rows:
            got[r["term"]] += r["df"]
        assert got.pop(None) == 0 and got == want
        assert (sum(r["docs"] for r in rows), sum(r["words"] for r in rows)) == (42, 160)
    assert len(rows) == len(want) + 1  # each term once, not once for each slice of texts


def test_repeated_rows_null_and_large_ids(spark, tmp_path):
    rows = data.odd_rows()
    df = spark.createDataFrame(rows, data.SCHEMA).repartition(3)
    path = data.write(spark, tmp_path, df)
    ids = sorted((d is not None, d or 0) for d, *_ in rows)
    for f in (sentencepiece_codec.op1_sentencepiece_codec, langid.op4_language_id, pii.op5_pii, quality.op6_quality_rules):
        assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in f(spark, path).collect()) == ids, f
    assert quality.apply_quality(df).count() + quality.ledger(df).filter(~quality.passes("v1")).count() == len(rows)
    got = topk.search(df, df.filter("doc_id = 7"), k=6, query_id="doc_id", query="text").orderBy("rank").collect()
    # The text of 7 also stands under 7 again, under 2^62 + 7 and under the largest id.
    assert [r["doc_id"] for r in got[:4]] == [7, 7, (1 << 62) + 7, (1 << 63) - 1] and len({r["score"] for r in got[:4]}) == 1


def test_whole_texts_are_read(tagger):
    """Forms without a digit, an at sign or a bracket, and every step of texts of any length as by the network on all of it."""
    import random

    rng = random.Random(8)
    for k in range(20):
        secret = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(40))
        before = data.words(rng, rng.randint(3, 300))
        t = f'{before} token = "{secret}" {data.words(rng, 50)}'
        assert (4, len(before) + 10, len(before) + 50) in pii.find_spans([t], tagger)[0], k
    texts = ["", "Straße ÄÖ  x" + "y" * 40 + " Q", "Abc", "aB", "日本 語", "".join(rng.choice("aB1 é.") for _ in range(900))]
    codes, first, begins, at = pii.steps(texts)
    assert begins.tolist()[:2] == [0, 0] and begins[-1] == len(codes) and at[-1] == sum(map(len, texts)) and (codes > 0).all()
    ends = [*first[1:].tolist(), at[-1]]
    shapes = {}  # a number says all classes of its characters
    for c, a, b in zip(codes.tolist(), first.tolist(), ends, strict=True):
        kinds = tuple(pii._CLASS[min(ord(x), 255)] for x in "".join(texts)[a:b])
        assert shapes.setdefault(c, kinds) == kinds


def test_reading_equals_the_network_and_search(tagger):
    x = np.random.Generator(np.random.PCG64(2)).integers(1, pii.CLASSES, (128, 60))
    made = tagger.read(x)
    assert np.abs(made.transpose(0, 2, 1) - tagger.emissions(x)[0]).max() < 1e-4
    rng = np.random.Generator(np.random.PCG64(6))
    for shift in (0, 2, 4, 6, 8):
        e = rng.standard_normal((20, pii.LABELS, 400)).astype(np.float32)
        e[:, 0] += shift
        tagged = tagger.viterbi(np.ascontiguousarray(e.transpose(0, 2, 1))).any(axis=0)
        assert not (tagged & ~tagger.doubtful(e)).any()
    assert not tagger.doubtful(e).all()
