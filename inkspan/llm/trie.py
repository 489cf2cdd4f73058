"""Prefix tries of conversations, succinct and in level order.

A node is a sequence of turns that conversations begin with, named by 128 bits: sums of its turns' digests times powers
of odd bases, mod 2^64. Sums go on from where others end, so turns are sorted by range, a long conversation over
as many tasks as it fills, each task sums what it has, and one row a task tells the next where it starts. Shared
first turns are put before a conversation by the same arithmetic; texts never leave the scan.

Equal prefixes meet in one aggregate, combined before the shuffle, that gives a node's members and a bound of its
subtree. Nodes with a large subtree are the heavy upper levels. What hangs below them are shards, each a
whole subtree of bounded size: numpy puts runs of shards in level order, writes the LOUDS bitvector (a one for each
child, a zero after each node) and the label arrays, reads parents and degrees back from it, and rolls up in
reverse level order with add.at. The upper levels take the sums of their shards from one more aggregate and are
rolled up the same way, a band of levels at a time.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm.common import arrow_map, discard, set_up, stored

BASES = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x9E3779B97F4A7C15 | 1))
_BACK = [np.array([pow(int(b), -k, 1 << 64) for k in range(4)], np.uint64) for b in BASES]
#: Turns shared at most, conversations of a family, ids of a block under a digest, nodes of a run of shards.
SHARED, FAMILY, BLOCK, RUN = 4, 20, 1 << 16, 1 << 16
#: Bounds of a shard's turns, least and largest, and the part of all turns in between; nodes of a band of upper levels.
LEAST, MOST, PARTS, BAND = 1 << 10, 1 << 21, 1 << 14, 1 << 20


class Louds:
    """A forest in level order under one root that is not in it: node i's place is i, the root's children come first.

    `bits` is the bitvector; parents and degrees are read from it by rank and select."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        ones = np.flatnonzero(bits)
        #: The parent's place, -1 for the root: zeros before a node's one, less that of the root's own end.
        self.parent = ones - np.arange(len(ones)) - 1
        zeros = np.flatnonzero(~bits)
        self.first_child = zeros[:-1] - np.arange(len(zeros) - 1)
        self.degree = np.diff(zeros) - 1

    @classmethod
    def of(cls, parent: np.ndarray) -> Louds:
        """From the parents' places of nodes in level order (not falling, -1 for the root)."""
        n = len(parent)
        bits = np.zeros(2 * n + 1, bool)
        bits[np.arange(n) + parent + 1] = True
        return cls(bits)

    def children(self, i: int) -> range:
        return range(self.first_child[i], self.first_child[i] + self.degree[i])

    def rollup(self, values: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """Sums over subtrees; `levels` are the places at which levels begin, and the number of nodes."""
        out = values.copy()
        for a, b in zip(levels[-2:0:-1].tolist(), levels[-1:1:-1].tolist(), strict=True):
            np.add.at(out, self.parent[a:b], out[a:b])
        return out


def places(keys: tuple[np.ndarray, np.ndarray], wanted: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The row of keys (distinct pairs) that is each wanted pair, or -1."""
    order = np.lexsort(keys[::-1])
    one, two = keys[0][order], keys[1][order]
    out, left = np.full(len(wanted[0]), -1), np.arange(len(wanted[0]))
    at = np.searchsorted(one, wanted[0], "left")
    while len(left):
        here = at < len(one)
        left, at = left[here], at[here]
        here = one[at] == wanted[0][left]
        left, at = left[here], at[here]
        same = two[at] == wanted[1][left]
        out[left[same]] = order[at[same]]
        left, at = left[~same], at[~same] + 1
    return out


def level_order(p: tuple, q: tuple, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows' order by level (0 for the roots of trees), parent's place and name; parents' places in that order
    (-1 for roots); where levels begin, with the number of rows at the end."""
    parent_row = np.where(level > 0, places(p, q), -1)
    order = np.lexsort((p[1], p[0], level))
    levels = np.concatenate([np.flatnonzero(np.diff(level[order], prepend=-1)), [len(level)]])
    place = np.full(len(level) + 1, -1)
    for a, b in zip(levels[:-1].tolist(), levels[1:].tolist(), strict=True):
        rows = order[a:b]
        rows = rows[np.argsort(place[parent_row[rows]], kind="stable")]
        order[a:b] = rows
        place[rows] = np.arange(a, b)
    return order, place[parent_row[order]], levels


# ---- prefixes ------------------------------------------------------------------------------------


def _power(base: np.uint64, n: np.ndarray) -> np.ndarray:
    out, n, square = np.ones(len(n), np.uint64), n.astype(np.int64), np.array([base], np.uint64)
    while n.any():
        odd = (n & 1).astype(bool)
        out[odd] *= square
        square, n = square * square, n >> 1
    return out


def _u(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _batch(**columns):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({k: pa.array(v.view(np.int64) if isinstance(v, np.ndarray) and v.dtype == np.uint64 else v) for k, v in columns.items()})


def digests(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, t (16 bytes that name role and text) and words of each turn; rows without a conv_id go."""
    r, x = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text))
    label = F.unhex(F.md5(F.concat(F.length(r).cast("string"), F.lit(":"), r, x).cast("binary")))
    return df.filter(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), r.alias("role"), label.alias("t"), F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")).cast("int").alias("words")
    )


_SUMS = "conv long, i long, o1 long, o2 long, t1 long, t2 long, words int"


def _summed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their number within the conversation and the sums up to them, and the stored table it reads."""
    spark = turns.sparkSession

    def sums(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, conv, n, o, first, last = TaskContext.get().partitionId(), None, 0, [np.uint64(0)] * 2, True, None
        for batch in batches:
            if not len(batch):
                continue
            convs = batch.column("conv").to_numpy()
            t = np.frombuffer(b"".join(batch.column("t").to_pylist()), ">u8").reshape(-1, 2).astype(np.uint64)
            rows = np.arange(len(convs))
            new = np.diff(convs, prepend=convs[:1]) != 0
            new[0] = convs[0] != conv
            start = np.maximum.accumulate(np.where(new, rows, 0))
            going = np.cumsum(new) == 0  # the conversation of the batch before
            i = rows - start + 1 + np.where(going, n, 0)
            out = []
            for k, base in enumerate(BASES):
                up = np.cumsum(t[:, k] * _power(base, i))
                before = np.where(start > 0, up[start - 1], np.uint64(0))
                out.append(up - before + np.where(going, o[k], np.uint64(0)))
            conv, n, o = convs[-1], int(i[-1]), [x[-1] for x in out]
            edge = np.zeros(len(convs), np.int32)  # 1: the first row of the task, 2: the last
            edge[0] = first
            first = False
            made = _batch(part=np.full(len(convs), part, np.int32), conv=convs, i=i, o1=out[0], o2=out[1], t1=t[:, 0].copy(), t2=t[:, 1].copy(), words=batch.column("words"), edge=edge)
            if last is not None:
                yield last
            last = made
        if last is not None:
            edge = last.column("edge").to_numpy().copy()
            edge[-1] |= 2
            yield last.set_column(last.schema.get_field_index("edge"), "edge", pa.array(edge))

    keys = ["conv", F.col("turn").asc_nulls_first(), "role", "t"]
    dealt = turns.repartitionByRange(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys).sortWithinPartitions(*keys)
    table = stored(arrow_map(dealt, sums, f"part int, {_SUMS}, edge int"))
    # At most two rows a task: where a conversation goes on in the next one, and the sums to go on from.
    edges = table.filter("edge > 0").select("part", "edge", "conv", "i", "o1", "o2").collect()
    firsts = {r.part: r.conv for r in edges if r.edge & 1}
    lasts = {r.part: (r.conv, r.i, r.o1, r.o2) for r in edges if r.edge & 2}
    carried, open_ = [], None  # conversation, turns, sums
    for p in sorted(lasts):
        conv, i, o1, o2 = lasts[p]
        goes_on = open_ is not None and open_[0] == firsts[p]
        if goes_on:
            carried.append((p, *open_))
        if goes_on and firsts[p] == conv:
            n = open_[1]
            o1, o2 = (_signed(a + pow(int(b), n, 1 << 64) * x) for a, b, x in zip(open_[2:], BASES, (o1, o2), strict=True))
            open_ = (conv, n + i, o1, o2)
        else:
            open_ = (conv, i, o1, o2)
    starts = spark.createDataFrame(carried, "part int, conv long, n long, c1 long, c2 long")

    def shifted(batches):
        for b in batches:
            n = b.column("n").to_numpy()
            far = np.flatnonzero(n)
            o = [_u(b.column(c)).copy() for c in ("o1", "o2")]
            for k, base in enumerate(BASES):
                o[k][far] = _u(b.column(("c1", "c2")[k]))[far] + _power(base, n[far]) * o[k][far]
            yield _batch(conv=b.column("conv"), i=b.column("i").to_numpy() + n, o1=o[0], o2=o[1], t1=b.column("t1"), t2=b.column("t2"), words=b.column("words"))

    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n", "c1", "c2")]
    return arrow_map(table.join(F.broadcast(starts), ["part", "conv"], "left").select(*table.columns, *zero), shifted, _SUMS), table


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def rebuilt_prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stored) a row for each turn of each rebuilt conversation: conv, d (from 1), its name p1, p2, that of the prefix before
    it q1, q2, words, size (turns of the whole); and (stored) conv, size of every conversation."""
    summed, table = _summed(turns)
    at = lambda c, j: F.max(F.when(F.col("i") == j, F.col(c)))
    heads = stored(summed.groupBy("conv").agg(F.max("i").alias("n"), *[at(c, j).alias(f"{c}_{j}") for j in range(1, SHARED) for c in ("o1", "o2", "words")]))
    own = heads.withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED).withColumn("family", F.col("conv") - F.col("conv") % FAMILY)
    base = heads.select(F.col("conv").alias("family"), *[F.col(c).alias(f"b_{c}") for c in heads.columns if c != "conv"])
    zero = F.lit(0).cast("long")
    pick = lambda c, j: F.coalesce(*[F.when(j == k, F.col(f"{c}_{k}")) for k in range(1, SHARED)], zero)
    met = own.join(base, "family", "left").withColumn("k", F.least("h", F.coalesce("b_n", zero)))
    met = met.select(
        "conv", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), zero)).alias("size"),
        *[pick(c, F.least("h", "n")).alias(f"a_{c}") for c in ("o1", "o2")], *[pick(f"b_{c}", F.col("k")).alias(f"e_{c}") for c in ("o1", "o2")],
        F.slice(F.array(*[F.struct(F.lit(j).cast("long").alias("d"), *[(F.col(f"b_{c}_{i}") if i else zero).alias(name) for c, i, name in (("o1", j, "p1"), ("o2", j, "p2"), ("o1", j - 1, "q1"), ("o2", j - 1, "q2"))], F.col(f"b_words_{j}").alias("words")) for j in range(1, SHARED)]), 1, F.col("k").cast("int")).alias("shared"),
    )
    plan = stored(met)
    discard(heads)

    def moved(batches):
        for b in batches:
            h, k, i = (b.column(c).to_numpy() for c in ("h", "k", "i"))
            names = {}
            for j, base in enumerate(BASES, 1):
                back = _BACK[j - 1][h - k]
                p = _u(b.column(f"e_o{j}")) + (_u(b.column(f"o{j}")) - _u(b.column(f"a_o{j}"))) * back
                names |= {f"p{j}": p, f"q{j}": p - _u(b.column(f"t{j}")) * _power(base, i) * back}
            yield _batch(conv=b.column("conv"), d=i - h + k, p1=names["p1"], p2=names["p2"], q1=names["q1"], q2=names["q2"], words=b.column("words"), size=b.column("size"))

    schema = "conv long, d long, p1 long, p2 long, q1 long, q2 long, words int, size long"
    rest = arrow_map(summed.join(plan.drop("shared"), "conv").filter("i > h"), moved, schema)
    shared = plan.select("conv", "size", F.explode("shared").alias("s")).select("conv", "s.*", "size")
    rows = stored(rest.unionByName(shared))
    discard(table)
    sizes = stored(plan.select("conv", "size"))
    discard(plan)
    return rows, sizes


# ---- digests of the conversations that end at a node ------------------------------------------------


def ends_digests(ends: DataFrame, block: int = BLOCK) -> DataFrame:
    """p1, p2 and ends_sha256 of rows (p1, p2, conv). Ids are sorted by range and joined in blocks wherever they
    are; one task passes over the blocks of a node, one at a time, as the digest of a long list has no parts."""
    parts = max(1, int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def blocks(batches):
        for b in batches:
            p1, p2, conv = (b.column(c).to_numpy() for c in ("p1", "p2", "conv"))
            new = np.flatnonzero((np.diff(p1, prepend=p1[:1]) != 0) | (np.diff(p2, prepend=p2[:1]) != 0))
            starts = np.union1d(np.concatenate([[0], new]), np.arange(0, len(conv), block))[: len(conv)]
            ids = conv.tolist()
            joined = [",".join(map(str, ids[a:z])) for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)], strict=True)]
            yield _batch(p1=p1[starts], p2=p2[starts], conv=conv[starts], ids=joined)

    def digest(batches):
        key = sha = None
        out: list[tuple] = []
        for b in batches:
            for p1, p2, ids in zip(*(b.column(c).to_pylist() for c in ("p1", "p2", "ids")), strict=True):
                if (p1, p2) == key:
                    sha.update(b"," + ids.encode())
                    continue
                if key:
                    out.append((*key, sha.hexdigest()))
                key, sha = (p1, p2), hashlib.sha256(ids.encode())
            if len(out) >= 1000:
                yield _batch(**dict(zip(("p1", "p2", "ends_sha256"), map(list, zip(*out, strict=True)), strict=True)))
                out.clear()
        if key:
            out.append((*key, sha.hexdigest()))
            yield _batch(**dict(zip(("p1", "p2", "ends_sha256"), map(list, zip(*out, strict=True)), strict=True)))

    joined = arrow_map(ends.repartitionByRange(parts, "p1", "p2", "conv").sortWithinPartitions("p1", "p2", "conv"), blocks, "p1 long, p2 long, conv long, ids string")
    return arrow_map(joined.repartition(parts, "p1", "p2").sortWithinPartitions("p1", "p2", "conv"), digest, "p1 long, p2 long, ends_sha256 string")


# ---- rollups ---------------------------------------------------------------------------------------

_NODES = "p1 long, p2 long, q1 long, q2 long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, top boolean"
#: What already hangs at a node: children, leaves and saved tokens of their subtrees.
HUNG = ("kids", "leaves", "saved")


def rolled_up(rows: dict[str, np.ndarray]):
    """Nodes of whole trees with their rollups. `level` counts from each tree's root, whose parent's conv_id is
    up_conv; what hangs at nodes is added."""
    order, parent, levels = level_order((rows["p1"], rows["p2"]), (rows["q1"], rows["q2"]), rows["level"])
    rows = {k: v[order] for k, v in rows.items()}
    trie = Louds.of(parent)
    n_children = trie.degree + rows["kids"]
    leaves = trie.rollup(rows["leaves"] + (n_children == 0), levels)
    saved = trie.rollup(rows["saved"] + (rows["n_convs"] - 1) * rows["words"], levels)
    top = trie.parent < 0
    up = np.where(top, rows["up_conv"], rows["conv_id"][trie.parent])
    keep = {k: rows[k] for k in ("p1", "p2", "q1", "q2", "conv_id", "depth")}
    return _batch(**keep, parent_conv_id=up, n_convs=rows["n_convs"], n_children=n_children, n_leaves=leaves, saved_tokens=saved, top=top)


_ROLLED = ("p1", "p2", "q1", "q2", "conv_id", "depth", "n_convs", "words", "level", "up_conv", *HUNG)


def _rollups(tree: DataFrame, shard: tuple[str, str] | None, least: int = RUN) -> DataFrame:
    """Trees of a sorted table rolled up, as many whole shards at a time as have `least` rows (without `shard`: all at once)."""

    def run(batches):
        held: list = []
        size = 0

        def made(tables):
            import pyarrow as pa

            t = pa.Table.from_batches(tables)
            return rolled_up({c: t.column(c).to_numpy() for c in _ROLLED})

        for b in batches:
            if not len(b):
                continue
            if shard and size >= least:
                one, two = (b.column(c).to_numpy() for c in shard)
                old = tuple(held[-1].column(c)[-1].as_py() for c in shard)
                other = np.flatnonzero((one != old[0]) | (two != old[1]))
                if len(other):  # a new shard begins within this batch: what was held is whole up to there
                    held.append(b.slice(0, int(other[0])))
                    yield made(held)
                    held, size, b = [], 0, b.slice(int(other[0]))
            held.append(b)
            size += len(b)
        if held:
            yield made(held)

    return arrow_map(tree, run, _NODES)


def _hung(tops: DataFrame) -> DataFrame:
    """What hangs at the parents of tops."""
    return tops.groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))


def prefix_trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", limit: int | None = None, band: int = BAND, run: int = RUN, block: int = BLOCK) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations (see op11_prefix_trie).

    Turns are taken in the order of `turn`, null first; equal ones by role, then by digest of role and text; a null
    role or text is empty; repeated rows are turns of their own; rows without a conv_id are left out; an empty table
    has no node. `limit` bounds the turns of a shard (default: a part of all turns, within bounds)."""
    spark = turns.sparkSession
    set_up(spark)
    rows, sizes = rebuilt_prefixes(digests(turns, conv_id, turn, role, text))
    zero = F.lit(0).cast("long")
    node = rows.groupBy("p1", "p2").agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.first("d").alias("depth"), F.first("words").cast("long").alias("words"),
        F.first("q1").alias("q1"), F.first("q2").alias("q2"), F.sum(F.col("size") - F.col("d") + 1).alias("turns"),
    )
    nodes = stored(node)
    if limit is None:
        limit = min(MOST, max(LEAST, rows.count() // PARTS))

    # Upper levels: the root, and nodes whose members have more than `limit` turns from there on.
    all_ = sizes.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = all_.select(*[zero.alias(c) for c in ("p1", "p2")], "conv_id", "n_convs", zero.alias("depth"), zero.alias("words"), *[F.lit(None).cast("long").alias(c) for c in ("q1", "q2")])
    upper = stored(nodes.filter(F.col("turns") > limit).drop("turns").unionByName(root))
    few = upper.count() <= 1 << 15  # rows of 64 bytes: 2 MB at most are broadcast
    small = F.broadcast if few else lambda df: df
    above = upper.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("up_conv"))

    # Shards: what hangs below them, each named by its top, which each of its conversations passes once.
    is_upper = upper.select("p1", "p2")
    tops = rows.join(small(above), ["q1", "q2"]).join(small(is_upper), ["p1", "p2"], "left_anti")
    tops = tops.select(F.col("conv").alias("conv_id"), F.col("p1").alias("s1"), F.col("p2").alias("s2"), F.col("d").alias("_d"), "up_conv")
    light = nodes.filter(F.col("turns") <= limit).join(tops, "conv_id").withColumn("level", F.col("depth") - F.col("_d"))
    light = light.select(*[c for c in _ROLLED if c not in HUNG], *[zero.alias(c) for c in HUNG], "s1", "s2")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    done = stored(_rollups(light.repartition(parts, "s1", "s2").sortWithinPartitions("s1", "s2"), ("s1", "s2"), run))

    # Upper levels from below, a band at a time. A level has at most (all turns / limit) nodes, so a band fits a task.
    hung = _hung(done.filter("top"))
    deepest = upper.agg(F.max("depth")).first()[0]
    height = max(1, band // max(1, rows.count() // limit))
    placed = upper.join(small(above), ["q1", "q2"], "left")
    made, high = [], (deepest if deepest is not None else -1) + 1
    while high > 0:
        low = max(0, high - height)
        mine = placed.filter((F.col("depth") >= low) & (F.col("depth") < high)).withColumn("level", F.col("depth") - low)
        mine = mine.join(hung, ["p1", "p2"], "left").select(*[c for c in _ROLLED if c not in HUNG], *[F.coalesce(c, zero).alias(c) for c in HUNG])
        mine = mine.withColumns({c: F.coalesce(c, zero) for c in ("q1", "q2", "up_conv")})
        made.append(stored(_rollups(mine.coalesce(1), None)))
        if low:
            hung = _hung(done.filter("top").unionByName(made[-1].filter("top")))
        high = low
    for m in made:
        done = done.unionByName(m)

    ends = rows.filter("d = size").select("p1", "p2", "conv").unionByName(sizes.filter("size = 0").select(zero.alias("p1"), zero.alias("p2"), "conv"))
    out = done.join(ends_digests(ends, block), ["p1", "p2"], "left")
    return out.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt: the first h turns of conversation c - c % 20, then its own after
    its first h, where h is crc32(decimal c) % 4. Null ids, nulls, ties, repeats and empty tables: see prefix_trie."""
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))


#: Prefixes as strings of digests; a node's subtree is found from the owners of nodes, whose paths pass all that is above.
SQL = r"""
with t as (select conv_id c, turn, coalesce(role, '') r, coalesce(text, '') x, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) m
      from conversations where conv_id is not null),
o as (select c, m, len(regexp_extract_all(x, '[^ 	-
]+')) w, row_number() over (partition by c order by turn nulls first, r, m) i from t),
h as (select c, xor(list_reduce(list_transform(range(1, len(c::varchar) + 1), lambda j: ord(substr(c::varchar, j, 1))::bigint),
        lambda a, b: list_reduce(range(8), lambda v, u: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, xor(a, b)), 4294967295::bigint), 4294967295) % 4 h
      from (select distinct c from t)),
f as (select h.c, o.i d, m, w from h join o on o.c = h.c - h.c % 20 and o.i <= h.h),
k as (select h.c, h.h, count(f.c) k from h left join f using (c) group by all),
b as (select * from f union all select o.c, o.i - h + k, m, w from o join k using (c) where i > h),
p as (select c, d, w, string_agg(m, '') over (partition by c order by d) key, count(*) over (partition by c) size from b),
path as (select c, d, w, key, coalesce(lag(key) over (partition by c order by d), '') up, size from p
         union all select h.c, 0, 0, '', null, count(b.c) from h left join b using (c) group by h.c),
n as (select key, d, any_value(up) up, min(c) c, count(*) n, any_value(w) w, string_agg(c::varchar, ',' order by c) filter (where d = size) ids from path group by key, d),
kids as (select up key, count(*) n_children from n where up is not null group by up),
v as (select n.*, coalesce(n_children, 0) n_children from n left join kids using (key)),
s as (select path.key, sum((v.n - 1) * v.w) saved, count(*) filter (where v.n_children = 0) leaves from v join path on path.c = v.c and path.d <= v.d group by path.key)
select v.c conv_id, v.d::bigint depth, u.c parent_conv_id, v.n n_convs, v.n_children, s.leaves n_leaves, s.saved::bigint saved_tokens, sha256(coalesce(v.ids, '')) ends_sha256
from v join s using (key) left join v u on u.key = v.up
"""
