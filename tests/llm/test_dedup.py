import numpy as np
import pyarrow.compute  # noqa: F401
import pytest

from inkspan.llm import chunkdedup, components, linededup, links, neardup
from tests.llm import data


class Sets:
    def __init__(self):
        self.root = {}

    def find(self, x):
        self.root.setdefault(x, x)
        while self.root[x] != x:
            x = self.root[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.root[max(a, b)] = min(a, b)


LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(t, k):
    w = (t or "").encode().translate(LOW).split()
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(items, percent=80):
    sets = Sets()
    keys = list(items)
    for i, a in enumerate(keys):
        sets.find(a)
        for b in keys[:i]:
            n = len(items[a] & items[b])
            if items[a] and items[b] and 100 * n >= percent * (len(items[a]) + len(items[b]) - n):
                sets.join(a, b)
    return {k: sets.find(k) for k in keys}


@pytest.mark.parametrize("block,small", [(links.BLOCK, components.SMALL), (2, 0)])
def test_near_duplicates(spark, tmp_path, monkeypatch, block, small):
    monkeypatch.setattr(links, "BLOCK", block)  # small blocks split every group
    monkeypatch.setattr(components, "SMALL", small)  # and links go through the rounds of stars
    want = brute({d: shingles(t, 4) for d, t, *_ in data.rows()})
    got = neardup.op10_minhash_near_dedup(spark, data.write(spark, tmp_path, data.frame(spark, True))).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(got) == len(want)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {d: len(shingles(t, 4)) for d, t, *_ in data.rows()}


def test_near_duplicates_in_a_hot_group(spark):
    import random

    rng = random.Random(2)
    base = data.words(rng, 100).split()
    rows = []
    for d in range(160):
        w = list(base)
        for _ in range(d % 9):
            w[rng.randrange(len(w))] = data.words(rng, 1)
        rows.append((d, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(df, words=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute({d: shingles(t, 4) for d, t in rows})


def test_kept_documents_keep_their_rows(spark):
    df = data.frame(spark, True)
    out = neardup.drop_near_duplicates(df)
    want = brute({d: shingles(t, 5) for d, t, *_ in data.rows()})
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == sorted(d for d, c in want.items() if d == c)


@pytest.mark.parametrize("small", [0, components.SMALL])
def test_components_of_paths_and_stars(spark, small):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(300, 200), (200, 300), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["component"] for r in components.components(df, small=small).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}, 200: 200, 300: 200}
    assert components.components(df.limit(0), small=small).count() == 0


def lines_of(t):
    return [(i, x) for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\r\x0b\x0c")]


def test_line_classes(spark, tmp_path):
    occurrences = [(d, i, x) for d, t, *_ in data.rows() for i, x in lines_of(t)]
    first = {}
    for d, i, x in occurrences:
        first.setdefault(x, (d, i))
    grams = {first[x]: {x} if len(x) < 8 else {x[k : k + 8] for k in range(len(x) - 7)} for x in first}
    want = brute(grams)
    got = linededup.op7_line_dedup(spark, data.write(spark, tmp_path, data.frame(spark, True))).collect()
    assert {(r["doc_id"], r["line_no"]): (r["first_doc_id"], r["first_line_no"]) for r in got} == {(d, i): want[first[x]] for d, i, x in occurrences}
    assert len(got) == len(occurrences)
    out = linededup.drop_duplicate_lines(data.frame(spark, True))
    assert out.columns == data.frame(spark, True).columns
    kept = {(r["doc_id"], r["line_no"]) for r in got if r["kept"]}
    for r in out.collect():
        t = data.rows()[r["doc_id"]][1]
        if t is None:
            assert r["text"] is None
        else:
            gone = {i for i, _ in lines_of(t)} - {i for d, i in kept if d == r["doc_id"]}
            assert r["text"] == "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone) and r["n_chars"] == len(r["text"])


def test_dedup_of_empty_tables(spark, tmp_path):
    path = data.write(spark, tmp_path, data.empty(spark))
    for f in (neardup.op10_minhash_near_dedup, linededup.op7_line_dedup, chunkdedup.op9_substring_dedup):
        assert f(spark, path).count() == 0


def test_repeated_passages(spark, tmp_path):
    got = chunkdedup.op9_substring_dedup(spark, data.write(spark, tmp_path, data.frame(spark, True))).collect()
    rows = {d: t or "" for d, t, *_ in data.rows()}
    windows = {}
    for d, t in rows.items():
        w = t.split()
        for i in range(len(w) - 49):
            windows.setdefault(tuple(w[i : i + 50]), set()).add(d)
    repeated = set().union(*[s for s in windows.values() if len(s) > 1])
    assert repeated <= {r["doc_id"] for r in got}
    chunks = {}
    for d, t in rows.items():  # every reported chunk run is in an earlier or later text indeed
        chunks[d] = t
    for r in got:
        passage = rows[r["doc_id"]][r["start"] : r["end"]]
        assert len(passage.encode()) == r["n_bytes"] >= chunkdedup.MIN_RUN
        inner = passage[20:60]
        assert sum(t.count(inner) for t in rows.values()) > 1
    cut = chunkdedup.drop_repeated_passages(data.frame(spark, True))
    assert cut.columns == data.frame(spark, True).columns
    out = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert out[0] == rows[0] and len(out[1]) < 50 and out[13] is None and out[21] == rows[21]


def test_chunks_resist_insertions():
    import random

    import numpy as np

    t = data.words(random.Random(1), 600)

    def chunks(s):
        b = np.frombuffer(s.encode(), np.uint8)
        ends, _ = chunkdedup.chunk_ends(b, np.array([0, len(b)]))
        assert ends[-1] == len(b) and (np.diff(ends, prepend=0) <= chunkdedup.MAX).all()
        return {bytes(b[x:y]) for x, y in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)}

    a, b = chunks(t), chunks(t[:700] + "inserted " + t[700:])
    assert len(a - b) <= 4
    assert len(chunks("z" * 5000)) <= 2


def test_short_lines_at_the_threshold_are_linked(spark):
    import random

    rng, rows = random.Random(5), []
    for i in range(600):  # one end character edited: n - 1 of n + 1 shingles are shared
        line = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range((16, 17, 18, 24, 40, 70)[i % 6]))
        rows += [(2 * i, line), (2 * i + 1, line[:-1] + "0")]
    for i, (k, last) in enumerate([(9, ""), (12, "0"), (60, ""), (200, "0")], 600):  # a line that repeats itself
        rows += [(2 * i, f"{'xyz ' * 20}{last}{i}"), (2 * i + 1, f"{'xyz ' * (20 + k)}{last}{i}")]
    want = brute({d: {t[k : k + 8] for k in range(len(t) - 7)} for d, t in rows if d < 1200})
    want |= brute({d: {t[k : k + 8] for k in range(len(t) - 7)} for d, t in rows if d >= 1200})
    got = linededup.line_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["first_doc_id"] for r in got} == want


@pytest.mark.parametrize("n,most", [(9, 4), (10, 4), (18, 4), (27, 4), (45, 4), (64, 4), (72, 20), (81, 20), (117, 20), (198, 20)])
def test_miss_rate_by_length(n, most):
    """Of 8000 pairs of n shingles each at a similarity of 0.8 or just above, those that share no bucket."""
    import numpy as np

    common, pairs = -(-8 * n // 9), 8000
    h = np.random.default_rng(n).integers(0, 1 << 64, (pairs, 2 * n - common), np.uint64)
    begins = np.arange(pairs + 1) * n
    (a, no), (b, _) = [linededup.line_bands(np.ascontiguousarray(x).ravel(), begins) for x in (h[:, :n], h[:, n - common :])]
    assert (~((a == b) & ~no).any(axis=1)).sum() <= most


def test_repeated_rows_null_and_large_ids(spark):
    rows = data.odd_rows()
    df = spark.createDataFrame(rows, data.SCHEMA).repartition(5)
    texts = data.one_each(rows)
    want = brute({d: shingles(t, 4) for d, t in texts.items()})
    got = neardup.near_duplicates(df, words=4).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == sorted((d, want[d], d == want[d]) for d, *_ in rows if d is not None)
    kept = neardup.drop_near_duplicates(df, words=4).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(d for d, *_ in rows if d is not None and d == want[d])
    assert sum(r["doc_id"] is None for r in kept) == 2

    first = {}
    for d, i, x in sorted((d, i, x) for d, t in texts.items() for i, x in lines_of(t)):
        first.setdefault(x, (d, i))
    want = brute({first[x]: {x} if len(x) < 8 else {x[k : k + 8] for k in range(len(x) - 7)} for x in first})
    got = {(r["doc_id"], r["line_no"]): (r["first_doc_id"], r["first_line_no"]) for r in linededup.line_classes(df).collect()}
    assert got == {(d, i): want[first[x]] for d, t in texts.items() for i, x in lines_of(t)}
    out = linededup.drop_duplicate_lines(df).collect()
    assert len(out) == len(rows) and sorted(r["text"] for r in out if r["doc_id"] == 2) == sorted(["", rows[8][1]])  # the text that stands for 2 is a near copy

    got = chunkdedup.repeated_passages(df).collect()
    found = {r["doc_id"] for r in got}
    assert {0, 1, 1 << 62, (1 << 62) + 1, (1 << 63) - 1, -(1 << 63)} <= found and len({(r["doc_id"], r["start"]) for r in got}) == len(got)
    out = chunkdedup.drop_repeated_passages(df).collect()
    assert len(out) == len(rows) and [r["text"] for r in out if r["doc_id"] == 0] == [rows[0][1]] * 3


def chunk_runs(texts, min_run, min_chunks):
    """Passages by plain loops over chunks, each cut by the rolling hash a byte at a time."""
    chunks = {}
    for d, t in texts.items():
        raw, h, at, out = (t or "").encode(), 0, 0, []
        for i, x in enumerate(raw):
            h = ((h << 2) + int(chunkdedup.GEAR[x])) & 0xFFFFFFFF
            inside = i + 1 < len(raw) and raw[i + 1] & 0xC0 == 0x80
            if i + 1 == len(raw) or (i + 1 - at >= chunkdedup.MIN and h >> (32 - chunkdedup.BITS) == 0 and not inside):
                while i + 1 - at > chunkdedup.MAX:
                    cut = at + chunkdedup.MAX
                    while raw[cut] & 0xC0 == 0x80:
                        cut -= 1
                    out.append((at, cut))
                    at = cut
                out.append((at, i + 1))
                at = i + 1
        chunks[d] = [(raw[a:b], a, b) for a, b in out]
    seen = {}
    for d in sorted(chunks):
        for k, (x, _, _) in enumerate(chunks[d]):
            seen.setdefault(x, []).append((d, k))
    out = set()
    for d, parts in chunks.items():
        k = 0
        while k < len(parts):
            e = k
            while e < len(parts) and len(seen[parts[e][0]]) > 1:
                e += 1
            if e > k and e - k >= min_chunks and parts[e - 1][2] - parts[k][1] >= min_run:
                later = sum(seen[parts[j][0]][0] != (d, j) for j in range(k, e))
                out.add((d, len((texts[d].encode()[: parts[k][1]]).decode()), len((texts[d].encode()[: parts[e - 1][2]]).decode()), later, min(seen[parts[j][0]][0][0] for j in range(k, e))))
            k = max(e, k + 1)
    return out


@pytest.mark.parametrize("least", [(96, 3), (1, 1)])
def test_passages_equal_brute_force(spark, least):
    texts = data.one_each(data.odd_rows())
    df = spark.createDataFrame(data.odd_rows(), data.SCHEMA)
    got = {(r["doc_id"], r["start"], r["end"], r["n_repeated"], r["first_doc_id"]) for r in chunkdedup.repeated_passages(df, min_run=least[0], min_chunks=least[1]).collect()}
    assert got == chunk_runs(texts, *least)


SF = "/root/testdata/sf0.001/documents.parquet"


def links_by_lists(sets, percent=80):
    """All pairs of sets at or above the threshold, by inverted lists."""
    from collections import Counter

    lists, out = {}, []
    for k, s in sets.items():
        met = Counter()
        for x in s:
            for other in lists.setdefault(x, []):
                met[other] += 1
            lists[x].append(k)
        out += [(other, k) for other, n in met.items() if 100 * n >= percent * (len(s) + len(sets[other]) - n)]
    return out


@pytest.mark.skipif(not __import__("os").path.exists(SF), reason="no test tables")
def test_recall_of_links_on_documents(spark):
    df = spark.read.parquet(SF.replace("0.001", "0.01"))
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df, words=4).collect()}
    links = links_by_lists({d: shingles(t, 4) for d, t in texts.items()})
    assert len(links) > 20 and sum(found[a] == found[b] for a, b in links) >= 0.99 * len(links)

    df = spark.read.parquet(SF)
    lines = {(r["doc_id"], i): x for r in df.collect() for i, x in lines_of(r["text"])}
    links = links_by_lists({k: {x} if len(x) < 8 else {x[j : j + 8] for j in range(len(x) - 7)} for k, x in lines.items()})
    found = {(r["doc_id"], r["line_no"]): (r["first_doc_id"], r["first_line_no"]) for r in linededup.line_classes(df).collect()}
    assert len(links) > 100 and sum(found[a] == found[b] for a, b in links) >= 0.99 * len(links)


def test_bucket_entries_travel_as_vectors():
    import random

    import pyarrow as pa

    rng = random.Random(5)
    base = [data.words(rng, 30) for _ in range(40)]
    texts = ["\n".join(rng.choice(base) + rng.choice(["", "", " x", data.words(rng, 20)]) for _ in range(30)) for _ in range(60)]
    want: dict[int, set[int]] = {}
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        _, _, starts, ends = linededup.text_lines(raw, np.array([0, len(raw)]))
        items = linededup.slice_hashes(raw, starts, ends).view(np.int64)
        buckets, none = linededup.line_bands(*linededup.char_shingles(linededup.code_points(raw), starts, ends))
        for i, b, no in zip(items.tolist(), buckets, none, strict=True):
            for x in b[~no].tolist():
                want.setdefault(x, set()).add(i)
    made = [list(linededup._line_rows([pa.RecordBatch.from_pydict({"doc_id": pa.array(range(a, a + 20)), "text": pa.array(texts[a : a + 20])})], 80, 6)) for a in (0, 20, 40)]
    rows = pa.Table.from_batches([b for task in made for b in task])
    assert rows.num_rows <= 60 * 30 + 3 * (1 << 6)  # no row for each bucket of a line
    entries = rows.filter(pa.compute.is_valid(rows["part"])).select(["part", "entries"]).sort_by("part").combine_chunks()
    for step in (7, 10_000):  # a part goes over batches
        got = [(b, i) for batch in linededup._member_rows(entries.to_batches(max_chunksize=step)) for b, i in zip(batch["bucket"].to_pylist(), batch["item"].to_pylist(), strict=True)]
        assert sorted(got) == sorted((b, i) for b, items in want.items() if len(items) > 1 for i in items) and got
    for most in (1, 5, 40):  # parts settled bit by bit
        batches = list(linededup._member_rows(entries.to_batches(max_chunksize=11), most))
        rows = [r for batch in batches for r in zip(*(batch[c].to_pylist() for c in ("bucket", "item", "again")), strict=True)]
        sure = [r[:2] for r in rows if not r[2]]
        assert len(sure) == len(set(sure)) and any(r[2] for r in rows)
        assert sorted({r[:2] for r in rows}) == sorted(set(got))


def test_a_task_holds_a_bounded_number_of_entries():
    """However many entries a bucket or a part has: those waiting, and one of each bucket."""
    rng = np.random.default_rng(3)
    hot = np.stack([np.zeros(30_000, np.int64), rng.integers(0, 20_000, 30_000)], axis=1)
    rest = np.stack([rng.integers(1, 400, 9_000), rng.integers(0, 50, 9_000)], axis=1)
    entries = rng.permutation(np.concatenate([hot, rest]))
    part = linededup.PartMembers(most=500)
    out, held = [], 0
    for a in range(0, len(entries), 170):
        out += list(part.add(entries[a : a + 170]))
        held = max(held, part.n)
    out += list(part.end())
    assert held < 1000 and len(part.seen) <= 400
    want = {}
    for b, i in entries.tolist():
        want.setdefault(b, set()).add(i)
    assert {tuple(r) for some in out for r in some.tolist()} == {(b, i) for b, items in want.items() if len(items) > 1 for i in items}


def test_parts_follow_the_lines(spark):
    assert [linededup.part_bits(n) for n in (0, 10**3, 10**6, 10**9, 10**12)] == [12, 12, 12, 17, 27]
    df = data.frame(spark)
    rows = lambda **how: sorted(tuple(r) for r in linededup.line_classes(df, **how).collect())
    assert rows(part=8, most=3) == rows()


def test_rows_without_an_id_spread_over_shards(spark):
    from inkspan.llm import packing

    cut = spark.range(10_000).selectExpr("cast(null as long) as doc_id", "0 as piece", "0L as start", "5L as length", "7L as ids_crc32").repartition(4)
    shards = packing.pack_pieces(cut, shard_pieces=500).selectExpr("sequence_id >> 40 as shard").groupBy("shard").count().collect()
    assert len(shards) == 20 and max(r["count"] for r in shards) < 750


def _ranges_of(sets):
    return np.concatenate([np.zeros(0, np.int64), *[np.sort(s) for s in sets]]).astype(np.int64), np.cumsum([0, *map(len, sets)])


@pytest.mark.parametrize("sketch", [8, 32])
def test_likely_pairs_by_sketches(sketch):
    rng = np.random.default_rng(1)
    one = [np.unique(rng.integers(0, 1 << 52, rng.integers(1, 90)))[:sketch] for _ in range(300)]
    two = [np.unique(np.concatenate([s[rng.random(len(s)) < 0.85], rng.integers(0, 1 << 52, 1 + i % 9)]))[:sketch] for i, s in enumerate(one)]
    want = []
    for a, b in zip(one, two, strict=True):
        common, union = {*a.tolist()} & {*b.tolist()}, sorted({*a.tolist()} | {*b.tolist()})[:sketch]
        least = lambda k: 0.8 * k - 4.5 * (0.8 * (1 - 0.8) * k) ** 0.5
        want.append(len(common) >= np.floor(least(0.8 * min(len(a), len(b)))) and len(common & {*union}) >= least(len(union)))
    got = links.likely(_ranges_of(one), _ranges_of(two), 80, sketch)
    assert got.tolist() == want and (sketch == 8 or 0 < sum(want) < 300)
    assert links.likely(_ranges_of(one * 20), _ranges_of(two * 20), 80, sketch).tolist() == want * 20
    assert not len(links.likely(_ranges_of([]), _ranges_of([]), 80, sketch))


def test_forest_joins_all_with_the_fewest_pairs():
    rng = np.random.default_rng(2)
    for n, m in ((1, 0), (2, 1), (40, 25), (40, 400), (500, 450)):
        a, b = rng.integers(0, n, m) * 7 - 9, rng.integers(0, n, m) * 7 - 9
        picked = links.forest(a, b)

        def classes(rows):
            sets = Sets()
            for i in rows:
                sets.join(int(a[i]), int(b[i]))
            return {x: sets.find(x) for x in {*a.tolist(), *b.tolist()}}

        want = classes(range(m))
        assert classes(picked.tolist()) == want and len(picked) == len(want) - len({*want.values()})


def test_shared_leaves_out_what_one_item_holds(monkeypatch):
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 40, 30)
    others = [np.unique(np.concatenate([rng.choice(common, 20), rng.integers(0, 1 << 50, 200)])) for _ in range(12)]
    sets = [*others[:4], np.unique(np.concatenate([common, rng.integers(0, 1 << 50, 50)]))]
    again = np.array([True] * 4 + [False])
    widths, zeros = [], np.zeros
    monkeypatch.setattr(links.np, "zeros", lambda shape, *how: widths.append(shape) or zeros(shape, *how))
    got = links.shared(sets, others, again)
    for i, s in enumerate(sets):
        for j, t in enumerate(others):
            assert i == j < 4 or got[i, j] == len(np.intersect1d(s, t))
    assert max(w[1] for w in widths if isinstance(w, tuple)) <= 40  # not the 200 of each alone


def test_texts_of_equal_ids_are_cut_once():
    ids, texts = np.array([5, 5, 5, 9, 5, 7, 7]), [b"abcdefghij", b"abcdefghij", b"abcdefghij", "é1234567890".encode(), b"abcdefghij", b"xy", b"xy"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    seen = []
    got = links._sets_of(ids, data, offsets, lambda d, o: seen.append(len(o) - 1) or linededup.line_sets(d, o))
    want = linededup.line_sets(data, offsets)
    assert seen == [4] and (got[0] == want[0]).all() and (got[1] == want[1]).all()
