import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from inkspan.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def label(role, text):
    r, x = role or "", text or ""
    return r, x, hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest()


def brute(rows):
    """Nodes by definition."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn), *label(role, text)))
    convs = {c: [(r, x) for _, r, x, _ in sorted(t, key=lambda y: (y[0][0], y[0][1] or 0, y[1].encode(), y[3]))] for c, t in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rest = abs(c) % 20 * (1 if c > 0 else -1)
        built[c] = tuple(convs.get(c - rest, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, m in members.items():
        cost = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += cost
            leaves[path[:d]] += path not in kids
    out = []
    for path, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if built[c] == path))
        out.append((min(m), len(path), min(members[path[:-1]]) if path else None, len(m), kids[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def conversations():
    rng = random.Random(7)
    texts = ["a b", "c", "", None, "d  e\tf", "x" * 3000, "é ü"]
    rows = []
    for c in [*range(0, 64), -1, -20, -21, -39, (1 << 63) - 1, -(1 << 63), 100, 1005]:
        if c % 9 == 4:
            continue  # absent; bases among them
        rows += [(c, t, ["user", "assistant"][t % 2], rng.choice(texts[: 3 + c % 3])) for t in range(rng.choice([1, 2, 2, 3, 5, 9]))]
    rows += [(7, None, "system", "null turn"), (7, 3, None, "tie"), (7, 3, None, "tie"), (7, 3, "user", "tie"), (40, 1, None, None)]
    rows += [(8, t, "user", f"long {t}") for t in range(300)] + [(28, t, "user", f"long {t}") for t in range(290)]
    rows += [(2000 + c, t, "user", "hot") for c in range(150) for t in range(3)]
    rows += [(None, 0, "user", "no conversation")] * 3
    rng.shuffle(rows)
    return rows


def test_trie_equals_the_definition(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(trie.prefix_trie(df)) == brute(rows)


@pytest.mark.parametrize(("limit", "band", "run", "block"), [(1, 1, 4, 2), (30, 40, 1, 7)])
def test_upper_levels_and_bands(spark, limit, band, run, block):
    """Shards of next to nothing, so that most nodes are upper levels, in many bands or few."""
    rows = [r for r in conversations() if r[0] not in (8, 28)]
    rows += [(8, t, "user", f"long {t}") for t in range(9)] + [(28, t, "user", f"long {t}") for t in range(12)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(trie.prefix_trie(df, limit=limit, band=band, run=run, block=block)) == brute(rows)


def test_empty_extra_columns_and_one_long_conversation(spark):
    assert found(trie.prefix_trie(spark.createDataFrame([], SCHEMA))) == []
    nobody = [(None, 1, "user", "x")]
    assert found(trie.prefix_trie(spark.createDataFrame(nobody, SCHEMA))) == []
    # One conversation over all range partitions, its base on another side; clashing names beside it.
    rows = [(25, t, "user", f"{t % 3}") for t in range(400)] + [(20, t, "user", f"{t % 3}") for t in range(2)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as conv", "2 as p1", "3 as part", "4 as words", "5 as `a.b`").repartition(4)
    assert found(trie.prefix_trie(df)) == brute(rows)


def test_op11(spark, tmp_path):
    rows = [r for r in conversations() if r[0] is not None][:200]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert found(trie.op11_prefix_trie(spark, str(tmp_path))) == brute(rows)


def test_louds():
    """Parents, degrees and children of random forests, and sums over subtrees."""
    rng = random.Random(3)
    for n in (1, 2, 7, 60):
        for _ in range(20):
            parents = [-1] + [rng.randrange(-1, i) for i in range(1, n)]
            level = []
            for p in parents:
                level.append(0 if p < 0 else level[p] + 1)
            names = np.array([rng.randrange(5) for _ in range(n)], np.int64), np.arange(n)
            up = tuple(np.array([c[p] if p >= 0 else 0 for p in parents]) for c in names)
            order, parent, levels = trie.level_order(names, up, np.array(level))
            t = trie.Louds.of(parent)
            assert t.parent.tolist() == parent.tolist() and (np.diff(parent) >= 0).all()
            where = {int(o): k for k, o in enumerate(order)}
            assert [where[parents[o]] if parents[o] >= 0 else -1 for o in order.tolist()] == parent.tolist()
            for i in range(n):
                assert list(t.children(i)) == [j for j in range(n) if parent[j] == i]
            sums = np.ones(n, np.int64)
            for j in range(n - 1, -1, -1):
                if parent[j] >= 0:
                    sums[parent[j]] += sums[j]
            assert t.rollup(np.ones(n, np.int64), levels).tolist() == sums.tolist()


def test_names_that_share_a_half():
    keys = np.array([5, 5, 5, 9]), np.array([1, 2, 3, 1])
    assert trie.places(keys, (np.array([5, 5, 9, 9, 10, 1]), np.array([3, 4, 1, 0, 1, 1]))).tolist() == [2, -1, 3, -1, -1, -1]
