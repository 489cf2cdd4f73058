"""Components of the links between sets that share a bucket.

Input: members (bucket, item), each item's text, and the function that makes texts into sets of 64-bit
hashes. Texts are moved, not sets: a set takes several times its text, and does not compress. Two items link if
100 |A and B| >= percent |A or B|. All pairs within a bucket are judged, but never emitted:

1. Stars. Each bucket's items are compared with one leader; a sketch of the smallest hashes of a union
   estimates the similarity, and full sets then confirm it. This gives at most one row per member, and
   it joins the bulk of a group of copies, however large.
2. The rest. In a bucket whose items are still in several components, those outside the bucket's largest
   component meet all its items, in blocks of bounded size: a product of 0/1 matrices counts what each
   pair's sketches share. Where few pairs remain possible, they are emitted and confirmed on full sets.
3. Dense blocks, where many pairs are near the threshold, get the full sets of their items and confirm
   them by the same product; they emit a forest of the links found, no more rows than items.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.llm.common import HASH_BITS, ROWS, arrow_map, discard, pair_sizes, row_sets, row_slices, stored, utf8
from inkspan.llm.components import components

#: Hashes of each row of a byte vector (repeated ones too), one row after another, and where each row's begin.
SetsFrom = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
SKETCH = 64
#: Items of one side of a block, and elements of their sets.
BLOCK, ELEMENTS = 1024, 1 << 22
#: Pairs per item beyond which a block counts as dense.
FEW = 4


def slack(k, percent: int):
    """Of k smallest hashes of a union, those in both sets at least: 4.5 deviations under the mean."""
    p = percent / 100
    return p * k - 4.5 * (p * (1 - p) * k) ** 0.5


def shared(sets: list[np.ndarray], others: list[np.ndarray], again: np.ndarray, columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections, as a matrix; values in one set alone take no part. again: which of the sets
    stand among the others too; an intersection of one with itself has no meaning."""
    values, counts = np.unique(np.concatenate([*others, *[s for s, no in zip(sets, again.tolist(), strict=True) if not no]]), return_counts=True)
    values = values[counts > 1]
    out = np.zeros((len(sets), len(others)), np.float32)

    def at(side):
        flat = np.concatenate(side)
        rows = np.repeat(np.arange(len(side)), [len(s) for s in side])
        where = np.searchsorted(values, flat)
        hit = where < len(values)
        hit[hit] = values[where[hit]] == flat[hit]
        return rows[hit], where[hit]

    if not len(values):
        return out
    (ra, ca), (rb, cb) = at(sets), at(others)
    for c in range(0, len(values), columns):
        width = min(columns, len(values) - c)
        left, right = np.zeros((len(sets), width), np.float32), np.zeros((len(others), width), np.float32)
        i, j = (ca >= c) & (ca < c + columns), (cb >= c) & (cb < c + columns)
        left[ra[i], ca[i] - c] = 1
        right[rb[j], cb[j] - c] = 1
        out += left @ right.T
    return out


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of pairs (a, b) that join what the others have not joined: each round, the first pair of each group."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    group, left, out = np.arange(len(names)), np.arange(len(a)), [np.zeros(0, np.int64)]
    while True:
        x, y = group[at[left]], group[at[len(a) + left]]
        apart = x != y
        x, y, left = x[apart], y[apart], left[apart]
        if not len(left):
            return np.sort(np.concatenate(out))
        first = np.full(len(names), len(left))
        for side in (x, y):
            np.minimum.at(first, side, np.arange(len(left)))
        picked = np.unique(first[first < len(left)])
        out.append(left[picked])
        root = list(range(len(names)))
        for p, q in zip(x[picked].tolist(), y[picked].tolist(), strict=True):
            while root[p] != p:
                root[p] = p = root[root[p]]
            while root[q] != q:
                root[q] = q = root[root[q]]
            root[max(p, q)] = min(p, q)
        root = np.array(root)
        while (root[root] != root).any():
            root = root[root]
        group = root[group]


def likely(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], percent: int, sketch: int) -> np.ndarray:
    """Whether the sets of which these are the sketches (sorted ranges of two lists) may be linked: few in common
    settles most pairs; the rest are estimated on the union's sketch."""
    n, out = len(one[1]) - 1, []
    for lo in range(0, n, ROWS // 2):  # rows and hashes stay within signed integers
        hi = min(lo + ROWS // 2, n)
        sizes = [np.diff(begins[lo : hi + 1]) for _, begins in (one, two)]
        keys = np.concatenate([flat[begins[lo] : begins[hi]] | np.repeat(np.arange(hi - lo) << HASH_BITS, size) for (flat, begins), size in zip((one, two), sizes, strict=True)])
        keys.sort()
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        both = ~np.append(new[1:], True)[new]
        row = keys[new] >> HASH_BITS
        union = np.bincount(row, minlength=hi - lo)
        first = np.arange(len(row)) - np.repeat(np.cumsum(union) - union, union) < sketch
        common = np.bincount(row[both], minlength=hi - lo)
        out.append((common >= np.floor(slack(percent / 100 * np.minimum(*sizes), percent))) & (np.bincount(row[both & first], minlength=hi - lo) >= slack(np.minimum(union, sketch), percent)))
    return np.concatenate(out) if out else np.zeros(0, bool)


def _likely_rows(percent: int, sketch: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lists = [(np.asarray(c.flatten()), np.asarray(c.offsets) - c.offsets[0].as_py()) for c in (batch.column("_a"), batch.column("_b"))]
            good = pa.array(likely(*lists, percent, sketch))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(good) for c in "ab"], names=["a", "b"])

    return run


def _sets_of(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, sets_from: SetsFrom) -> tuple[np.ndarray, np.ndarray]:
    """sets_from for texts of which those with equal ids are equal, and stand together as a rule."""
    new = np.concatenate([[True], ids[1:] != ids[:-1]])
    if new.all():
        return sets_from(data, offsets)
    kept = np.flatnonzero(new)
    data = data[np.repeat(new, np.diff(offsets))]
    flat, begins = sets_from(data, np.concatenate([[0], np.cumsum(np.diff(offsets)[kept])]))
    which = np.cumsum(new) - 1
    size = np.diff(begins)[which]
    ends = np.cumsum(size)
    return flat[np.arange(int(ends[-1])) + np.repeat(begins[which] - (ends - size), size)], np.concatenate([[0], ends])


def _exact(pairs: DataFrame, texts: DataFrame, sets_from: SetsFrom, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are linked."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            (da, oa), (db, ob) = utf8(batch.column("_a")), utf8(batch.column("_b"))
            for lo, hi in row_slices(oa + ob, 1 << 19):
                one, two = batch.column("a").slice(lo, hi - lo).to_numpy(), batch.column("b").slice(lo, hi - lo).to_numpy()
                common, both = pair_sizes(*[_sets_of(ids, d[o[lo] : o[hi]], o[lo : hi + 1] - o[lo], sets_from) for ids, d, o in ((one, da, oa), (two, db, ob))])
                good = pa.array(100 * common >= percent * (both - common))
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo).filter(good) for c in "ab"], names=["a", "b"])

    one = texts.select(F.col("item").alias("a"), F.col("text").alias("_a"))
    two = texts.select(F.col("item").alias("b"), F.col("text").alias("_b"))
    return arrow_map(pairs.select("a", "b").join(one, "a").join(two, "b"), run, "a long, b long")


def _blocks(batches, names: list[str], work, sets_from: SetsFrom | None):
    """work(key, arrays) for each run of rows of equal (bucket, i, j) in sorted batches, whatever batches
    its rows come in; yields what it returns in record batches of the columns named."""
    import pyarrow as pa

    def columns(batch):
        if sets_from:
            data, offsets = utf8(batch.column("text"))
            sets = []
            for a, b in row_slices(offsets):
                flat, begins = row_sets(*sets_from(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
                sets += np.split(flat, begins[1:-1])
        else:
            h = batch.column("hashes")
            sets = np.split(np.asarray(h.flatten()), (np.asarray(h.offsets) - h.offsets[0].as_py())[1:-1])
        return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "i", "j", "item", "component", "n", "is_row")} | {"hashes": sets}

    def cut(part, lo, hi):
        return {c: v[lo:hi] for c, v in part.items()}

    def join(parts):
        return {c: sum((p[c] for p in parts), []) if c == "hashes" else np.concatenate([p[c] for p in parts]) for c in parts[0]}

    held, out = [], {n: [] for n in names}

    def flush():
        done = pa.RecordBatch.from_pydict({n: pa.array(v, pa.bool_() if n == "dense" else pa.int32() if n in "ij" else pa.int64()) for n, v in out.items()})
        for v in out.values():
            v.clear()
        return done

    def emit(group):
        for row in work((int(group["bucket"][0]), int(group["i"][0]), int(group["j"][0])), group):
            for n, v in zip(names, row, strict=True):
                out[n].append(v)

    for batch in batches:
        if not batch.num_rows:
            continue
        part = columns(batch)
        key = [part[c] for c in ("bucket", "i", "j")]
        edges = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
        edges = [0, *edges.tolist(), batch.num_rows]
        if held and any(held[-1][c][-1] != part[c][0] for c in ("bucket", "i", "j")):
            emit(join(held))
            held = []
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            held.append(cut(part, lo, hi))
            if hi < batch.num_rows:
                emit(join(held) if len(held) > 1 else held[0])
                held = []
        if len(out[names[0]]) > 10_000:
            yield flush()
    if held:
        emit(join(held))
    yield flush()


def _compare(percent: int, full: bool, sketch: int):
    """Pairs of a block that may be linked (sketches) or are linked (full sets)."""

    def block(key, group):
        row = group["is_row"]
        ia, ib = np.flatnonzero(row), np.flatnonzero(~row)
        if not len(ia) or not len(ib):
            return
        item, n, component, sets = group["item"], group["n"], group["component"], group["hashes"]
        na, nb = n[ia][:, None], n[ib][None, :]
        possible = (component[ia][:, None] != component[ib][None, :]) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
        # Two items that are both rows meet twice.
        rows = item[ia]
        again = np.isin(rows, item[ib])
        possible &= ~np.isin(item[ib], rows)[None, :] | (rows[:, None] < item[ib][None, :])
        x, y = np.nonzero(possible)
        if not len(x):
            return
        if len(x) <= 64:
            plain = {p: frozenset(sets[p].tolist()) for p in {*ia[x].tolist(), *ib[y].tolist()}}
            common = np.array([len(plain[p] & plain[q]) for p, q in zip(ia[x].tolist(), ib[y].tolist(), strict=True)])
        else:
            common = shared([sets[p] for p in ia.tolist()], [sets[q] for q in ib.tolist()], again)[x, y]
        na, nb = n[ia[x]], n[ib[y]]
        exact = 100 * common >= percent * (na + nb - common)
        if full:
            good = exact
        else:
            good = np.where(np.maximum(na, nb) <= sketch, exact, common >= retained(np.minimum(np.minimum(na, nb), sketch), percent, sketch))
        x, y = ia[x[good]], ib[y[good]]
        if full:
            keep = forest(component[x], component[y])
            x, y = x[keep], y[keep]
        elif len(x) > FEW * len(item):
            yield (*key, 0, 0, True)
            return
        for p, q in zip(item[x].tolist(), item[y].tolist(), strict=True):
            yield (*key, p, q, False)

    return block


def _in_blocks(rows: DataFrame, percent: int, sketch: int, sets_from: SetsFrom | None = None) -> DataFrame:
    """On full sets where sets_from is given, else on sketches."""
    names, full = ["bucket", "i", "j", "a", "b", "dense"], sets_from is not None
    ordered = rows.select("bucket", "i", "j", "item", "component", "n", "is_row", "text" if full else "hashes").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return arrow_map(ordered, lambda b: _blocks(b, names, _compare(percent, full, sketch), sets_from), "bucket long, i int, j int, a long, b long, dense boolean")


def classes(members: DataFrame, sketches: DataFrame, texts_of: Callable[[DataFrame], DataFrame], sets_from: SetsFrom, percent: int = 80, sketch: int = SKETCH) -> DataFrame:
    """(id, component) of all items that have a link within a bucket.

    members (bucket long, item long); sketches (item, n, sketch array<long>, the `sketch` smallest hashes in
    order), both stored tables; texts_of(items) gives (item, text), one row each, for a table of items, and
    sets_from the hashes of each of the texts in a byte vector."""
    # A leader is an item of the smallest set: in a group of edited copies, one with the fewest edits. (Which of
    # several is settled as the table is written.)
    sized = stored(members.join(sketches.select("item", "n"), "item"))
    heads = stored(sized.groupBy("bucket").agg(F.min_by("item", "n").alias("a"), F.min("n").alias("na"), F.count("*").alias("c")))
    stars = sized.withColumnsRenamed({"item": "b", "n": "nb"}).join(heads, "bucket").filter("a <> b")
    stars = stored(stars.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b").distinct())
    sk = lambda r: sketches.select(F.col("item").alias(r), F.col("sketch").alias(f"_{r}"))
    near = stored(arrow_map(stars.join(sk("b"), "b").join(sk("a"), "a").select("a", "b", "_a", "_b"), _likely_rows(percent, sketch), "a long, b long"))
    discard(stars)
    wanted = stored(near.select(F.col("a").alias("item")).union(near.select("b")).distinct())
    texts = stored(texts_of(wanted))
    links = stored(_exact(near, texts, sets_from, percent))
    discard(near, texts, wanted)
    parts = stored(components(links))

    # Buckets of several components. Leaders have met everyone, so a bucket of two is done.
    more = heads.filter("c > 2").select("bucket", "a")
    placed = sized.join(more, "bucket").filter("item <> a").drop("a").join(parts.withColumnRenamed("id", "item"), "item", "left").withColumn("component", F.coalesce("component", "item"))
    placed = stored(placed)
    discard(sized, heads)
    per = placed.groupBy("bucket", "component").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    top = per.groupBy("bucket").agg(F.max_by("component", "c").alias("top"), F.sum("c").alias("all"), F.sum("s").alias("elements"), F.count("*").alias("parts"), F.max("c").alias("most")).filter("parts > 1")
    open_buckets = stored(top.select("bucket", "top", "all", "elements", (F.col("all") - F.col("most")).alias("outside")))
    rest = placed.join(open_buckets, "bucket").withColumn("out", F.col("component") != F.col("top"))
    # Items outside take a share of the elements at most; blocks hold BLOCK items and about ELEMENTS elements a side.
    rows = F.ceil(F.greatest(F.col("outside") / BLOCK, F.least(F.col("outside"), F.col("elements") / ELEMENTS)))
    cols = F.ceil(F.greatest(F.col("all") / BLOCK, F.col("elements") / ELEMENTS))
    mine, theirs = F.pmod(F.xxhash64("item"), rows).cast("int"), F.pmod(F.xxhash64("item", F.lit(7)), cols).cast("int")
    left = rest.filter("out").select("bucket", "item", "component", "n", mine.alias("i"), F.explode(F.sequence(F.lit(0), (cols - 1).cast("int"))).alias("j"), F.lit(True).alias("is_row"))
    right = rest.select("bucket", "item", "component", "n", F.explode(F.sequence(F.lit(0), (rows - 1).cast("int"))).alias("i"), theirs.alias("j"), F.lit(False).alias("is_row"))
    blocks = stored(left.unionByName(right))
    discard(placed, open_buckets)
    found = stored(_in_blocks(blocks.join(sketches.select("item", F.col("sketch").alias("hashes")), "item"), percent, sketch))
    pairs = found.filter("not dense").select("a", "b").distinct()
    dense = stored(blocks.join(found.filter("dense").select("bucket", "i", "j"), ["bucket", "i", "j"]))
    wanted = stored(pairs.select(F.col("a").alias("item")).union(pairs.select("b")).union(dense.select("item")).distinct())
    texts = stored(texts_of(wanted))
    more = _exact(pairs, texts, sets_from, percent).union(_in_blocks(dense.join(texts, "item"), percent, sketch, sets_from).select("a", "b"))
    # These join components, so they are links of components.
    component = lambda c: F.coalesce(f"_{c}", c).alias(c)
    of = lambda c: parts.select(F.col("id").alias(c), F.col("component").alias(f"_{c}"))
    more = stored(more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(component("a"), component("b")))
    settled = stored(components(more))
    joined = settled.select(F.col("id").alias("component"), F.col("component").alias("_whole"))
    grown = parts.join(joined, "component", "left").select("id", F.coalesce("_whole", "component").alias("component"))
    new = joined.select(F.col("component").alias("id"), F.col("_whole").alias("component")).join(parts, "id", "left_anti")
    out = stored(grown.union(new))
    discard(links, blocks, found, dense, texts, wanted, parts, more, settled)
    return out


def retained(k, percent: int, sketch: int = SKETCH):
    """Hashes that the sketches of two linked sets share at least, k being the smaller sketch's length:
    exact where the larger set fits in a sketch too, else with slack."""
    k = np.asarray(k, float)
    return np.where(k * 100 <= percent * sketch, np.ceil(percent * k / 100 - 1e-9), np.floor(slack(k, percent)))
