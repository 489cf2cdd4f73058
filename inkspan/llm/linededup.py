"""Fuzzy line deduplication by MinHash.

Lines are the \\n-split parts of a text that hold a word. Equal lines collapse to their first occurrence
(the smallest doc_id, then line number), so a line that a third of all documents carry is one item. Each
item's character shingles give a signature of minima. In lines of more than SHORT distinct shingles a
shingle's hash picks a bin and competes there (one hash for all bins; an empty bin borrows from the next one
that has a value). Fewer shingles leave neighbouring bins with the same value, so lines of up to SHORT, and
those long enough to be linked with one, get a minimum of each of SHORT_BANDS * ROWS independent orders.
Bands of ROWS minima send items to buckets. A pair at a similarity of 0.8 shares none of the bands with a
chance of about 0.00001 if one of the lines has up to SHORT distinct shingles, else of about 0.0008. What shares a bucket is estimated, then confirmed by the exact Jaccard similarity of shingle sets (see
links.py), and distributed union-find keeps one line of each component: its first occurrence.

A null text has no lines; blank lines are never removed and never linked; a line shorter than a shingle is
one shingle. Equal lines are linked; an empty table gives no rows. Rows of equal doc_id are one document with
the text that comes first (`one_text_each`); rows without a doc_id have no lines here, and filters let them
pass. Items are named by 64-bit hashes of the line's bytes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm.common import WS, arrow_map, discard, documents, flag_in, join_found, maybe_in, mix, one_text_each, own_columns, row_sets, row_slices, slice_hashes, stored, utf8
from inkspan.llm.links import classes

WIDTH = 8
BANDS, ROWS = 10, 3
#: Hashes of a line's sketch: with 32, about as many bytes as a line.
SKETCH = 32
#: Distinct shingles up to which all of a line's links are looked for by independent orders, and their bands.
SHORT, SHORT_BANDS = 64, 16
#: Entries of buckets travel as vectors, in parts by the buckets' highest bits: as many parts as make PART entries each,
#: from the counted lines. A task deals out HELD entries at a time; another takes one part at a time, 16 bytes
#: an entry, and never holds more than MOST entries beside one for each bucket of the part.
PART, HELD, MOST = 1 << 18, 1 << 20, 1 << 21
LINE_SCHEMA = "item long, doc_id long, line_no int, first boolean, part long, entries binary"
LINE_COLUMNS = ["item", "doc_id", "line_no", "first", "part", "entries"]
_FACTOR = 0x9E3779B97F4A7C15
_ORDERS = mix(np.arange(1, SHORT_BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(_FACTOR)) | np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def code_points(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")


def char_shingles(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all ranges (whole ranges where shorter), and where each range's begin."""
    h, have, out, left = points.astype(np.uint64) + np.uint64(1), 1, None, width
    shift = 0
    while left:  # windows of 1, 2, 4, ... points, put together to `width`
        if left & 1:
            part = h[shift:] if shift else h
            out = part.copy() if out is None else out[: len(part)] * np.uint64(pow(_FACTOR, have, 1 << 64)) + part[: len(out)]
            shift += have
        left >>= 1
        if left:
            h = h[:-have] * np.uint64(pow(_FACTOR, have, 1 << 64)) + h[have:] if len(h) > have else h[:0]
            have *= 2
    counts = np.maximum(ends - starts - width + 1, 1)
    begins = np.concatenate([[0], np.cumsum(counts)])
    where = np.arange(begins[-1]) + np.repeat(starts - begins[:-1], counts)
    short = np.flatnonzero(ends - starts < width)
    if not len(short):
        return mix(out[where]), begins
    where[begins[short]] = 0
    got = out[where] if len(out) else np.zeros(len(where), np.uint64)
    for i in short.tolist():
        x = int(ends[i] - starts[i])
        for p in points[starts[i] : ends[i]].tolist():
            x = (x * _FACTOR + p + 1) & ((1 << 64) - 1)
        got[begins[i]] = x
    return mix(got), begins


def bands(hashes: np.ndarray, begins: np.ndarray, n_bands: int = BANDS, n_rows: int = ROWS) -> np.ndarray:
    """Bucket of each range in each band."""
    bins, n = n_bands * n_rows, len(begins) - 1
    place = ((hashes >> np.uint64(40)) * np.uint64(bins) >> np.uint64(24)).astype(np.int64)
    place += np.repeat(np.arange(n) * bins, np.diff(begins))
    low = np.full(n * bins, np.uint64((1 << 64) - 1))
    np.minimum.at(low, place, hashes << np.uint64(24))
    low = low.reshape(n, bins)
    empty = low == np.uint64((1 << 64) - 1)
    near = np.where(empty, 2 * bins, np.arange(bins))  # the next bin with a value, going round
    near = np.concatenate([near, np.where(empty, 4 * bins, np.arange(bins, 2 * bins))], axis=1)
    near = np.minimum.accumulate(near[:, ::-1], axis=1)[:, ::-1][:, :bins]
    low = np.take_along_axis(low, near % bins, axis=1) + (near - np.arange(bins)).astype(np.uint64) * np.uint64(_FACTOR)
    out = np.zeros((n, n_bands), np.uint64)
    for r in range(n_rows):  # a band's bins stand far apart, so that they seldom borrow from one another
        out = out * np.uint64(_FACTOR) + low[:, r * n_bands : (r + 1) * n_bands]
    return mix(out * np.uint64(_FACTOR) + np.arange(n_bands, dtype=np.uint64)).view(np.int64)


def set_sizes(hashes: np.ndarray, begins: np.ndarray, most: int) -> np.ndarray:
    """Number of distinct hashes of each range: exact between SHORT and `most`; at most SHORT, or above
    `most`, wherever the exact number is."""
    counts = np.diff(begins)
    sizes, width = counts.copy(), 2 * most
    many = np.flatnonzero(counts > SHORT)
    for i in range(0, len(many), 4096):
        some = many[i : i + 4096]
        head = np.sort(hashes[begins[some][:, None] + np.minimum(np.arange(width), counts[some][:, None] - 1)], axis=1)
        sizes[some] = 1 + (head[:, 1:] != head[:, :-1]).sum(axis=1)
    for i in many[(counts[many] > width) & (sizes[many] <= most)].tolist():  # lines that repeat themselves
        sizes[i] = len(np.unique(hashes[begins[i] : begins[i + 1]]))
    return sizes


def short_bands(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Bucket of each range in each band of minima of independent orders."""
    out = np.zeros((len(begins) - 1, SHORT_BANDS), np.uint64)
    if len(out):
        for i, order in enumerate(_ORDERS):
            out[:, i // ROWS] = out[:, i // ROWS] * np.uint64(_FACTOR) + np.minimum.reduceat(hashes * order, begins[:-1])
    return mix(out * np.uint64(_FACTOR) + np.arange(BANDS, BANDS + SHORT_BANDS, dtype=np.uint64)).view(np.int64)


def line_bands(hashes: np.ndarray, begins: np.ndarray, percent: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each range, and where there is none. Any two linked ranges have bands of the same kind."""
    most = SHORT * 100 // percent
    sizes = set_sizes(hashes, begins, most)
    out, none = np.zeros((len(sizes), BANDS + SHORT_BANDS), np.int64), np.zeros((len(sizes), BANDS + SHORT_BANDS), bool)
    out[:, :BANDS] = bands(hashes, begins)
    none[:, :BANDS] = (sizes <= SHORT)[:, None]
    few = np.flatnonzero(sizes <= most)
    counts = np.diff(begins)[few]
    starts = np.concatenate([[0], np.cumsum(counts)])
    out[few, BANDS:] = short_bands(hashes[np.arange(starts[-1]) + np.repeat(begins[few] - starts[:-1], counts)], starts)
    none[:, BANDS:] = (sizes > most)[:, None]
    return out, none


def text_lines(data: np.ndarray, offsets: np.ndarray):
    """Row, number, start and end (bytes) of each line that holds a word."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    rows = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    numbers = np.arange(len(rows)) - np.searchsorted(rows, np.arange(len(offsets) - 1))[rows]
    ends = np.concatenate([starts[1:] - 1, [0]])
    last = np.concatenate([rows[1:] != rows[:-1], [True]]) if len(rows) else np.zeros(0, bool)
    ends[: len(last)][last] = offsets[1:][rows[last]]
    words = np.concatenate([[0], np.cumsum(~_BLANK[data])])
    some = words[ends[: len(starts)]] > words[starts]
    return rows[some], numbers[some], starts[some], ends[: len(starts)][some]


def part_bits(lines: int, part: int = PART) -> int:
    """Bits that number the parts: a line has at most BANDS + SHORT_BANDS entries. Never fewer than 12, so that what a task
    deals out to one part at a time stays a few KB."""
    return max(12, min(40, (lines * (BANDS + SHORT_BANDS) // part).bit_length()))


def _distinct(entries: np.ndarray) -> np.ndarray:
    """The distinct rows, sorted by bucket, then item."""
    entries = entries[np.lexsort((entries[:, 1], entries[:, 0]))]
    new = np.ones(len(entries), bool)
    new[1:] = (entries[1:] != entries[:-1]).any(axis=1)
    return entries[new]


def _line_rows(batches, percent: int, bits: int):
    """Rows of lines (item, doc_id, line_no, first), and rows of what goes into buckets (part, entries)."""
    import pyarrow as pa

    held, n = [], 0

    def dealt():
        entries = np.concatenate(held)
        part = (entries[:, 0].view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        starts = np.flatnonzero(np.diff(part[order], prepend=-1))
        ends = (16 * np.append(starts, len(order))).astype(np.int32)
        blobs = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(entries[order]))])
        none = [pa.nulls(len(starts), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.bool_())]
        return pa.RecordBatch.from_arrays([*none, pa.array(part[order][starts]), blobs], names=LINE_COLUMNS)

    for batch in batches:
        all_data, all_offsets = utf8(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for a, b in row_slices(all_offsets, 1 << 18):
            data, offsets = all_data[all_offsets[a] : all_offsets[b]], all_offsets[a : b + 1] - all_offsets[a]
            rows, numbers, starts, ends = text_lines(data, offsets)
            if not len(rows):
                continue
            items = slice_hashes(data, starts, ends).view(np.int64)
            order = np.lexsort((items, rows))  # stable: a document's first of each item comes first
            first = np.ones(len(rows), bool)
            first[order[1:]] = (items[order[1:]] != items[order[:-1]]) | (rows[order[1:]] != rows[order[:-1]])
            lines = [pa.array(np.ascontiguousarray(v)) for v in (items, ids[a:b][rows], numbers.astype(np.int32), first)]
            yield pa.RecordBatch.from_arrays([*lines, pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.binary())], names=LINE_COLUMNS)
            items, one = np.unique(items, return_index=True)  # equal lines go into equal buckets
            starts, ends = starts[one], ends[one]
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # bytes to characters
            buckets, none = line_bands(*char_shingles(code_points(data), chars[starts], chars[ends]), percent)
            some = ~none
            held.append(np.stack([buckets[some], np.repeat(items, some.sum(axis=1))], axis=1))
            n += len(held[-1])
            if n >= HELD:
                yield dealt()
                held, n = [], 0
    if n:
        yield dealt()


def shared_buckets(entries: np.ndarray) -> np.ndarray:
    """The distinct rows (bucket, item) of buckets that several items share."""

    def runs(bucket: np.ndarray) -> np.ndarray:
        again = np.concatenate([[False], bucket[1:] == bucket[:-1], [False]])
        return again[1:] | again[:-1]

    if not len(entries):
        return entries
    order = np.argsort(entries[:, 0])
    some = _distinct(entries[order[runs(entries[order, 0])]])  # few, as a rule
    return some[runs(some[:, 0])] if len(some) else some


class PartMembers:
    """Members of one part's shared buckets, from its entries a vector at a time. Up to `most` entries wait; then
    what is known to share a bucket goes out, and one entry of each bucket stays to meet what follows. Entries
    that went out before may do so again then, which `again` says."""

    def __init__(self, most: int = MOST):
        self.most, self.held, self.n = most, [], 0
        self.seen, self.out = np.zeros((0, 2), np.int64), np.zeros(0, bool)  # an entry a bucket; whether it went out
        self.again = False

    def add(self, entries: np.ndarray):
        for a in range(0, len(entries), max(1, self.most)):
            self.held.append(entries[a : a + self.most])
            self.n += len(self.held[-1])
            if self.n >= self.most:
                yield from self._settle(last=False)

    def end(self):
        if not self.again:
            if self.held:
                yield shared_buckets(np.concatenate(self.held))
        else:
            yield from self._settle(last=True)

    def _settle(self, last: bool):
        self.again = True
        new = _distinct(np.concatenate([np.zeros((0, 2), np.int64), *self.held]))
        self.held, self.n = [], 0
        at = np.searchsorted(self.seen[:, 0], new[:, 0])
        met = at < len(self.seen)
        met[met] = self.seen[at[met], 0] == new[met, 0]
        known = met.copy()
        known[met] = self.seen[at[met], 1] == new[met, 1]
        bucket = new[:, 0]
        near = np.concatenate([[False], bucket[1:] == bucket[:-1], [False]])
        goes = (near[1:] | near[:-1] | met) & ~known
        fresh = np.flatnonzero(goes & met)
        first = np.unique(at[fresh])
        first = first[~self.out[first]]
        yield np.concatenate([new[goes], self.seen[first]])
        self.out[first] = True
        if not last:
            lead = np.flatnonzero(~met & ~near[:-1])  # the first entry of a bucket not seen before
            seen = np.concatenate([self.seen, new[lead]])
            out = np.concatenate([self.out, goes[lead]])
            order = np.argsort(seen[:, 0], kind="stable")
            self.seen, self.out = seen[order], out[order]


def _member_rows(batches, most: int = MOST):
    """(bucket, item, again) of the shared buckets, from rows (part, entries) in order of parts."""
    import pyarrow as pa

    def rows(some: np.ndarray, again: bool):
        for a in range(0, len(some), 1 << 16):
            x = some[a : a + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(x[:, 0].copy()), "item": pa.array(x[:, 1].copy()), "again": pa.array(np.full(len(x), again))})

    held, last = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part").to_numpy()
        column = batch.column("entries")
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        entries = np.frombuffer(column.buffers()[2], np.int64, (ends[-1] - ends[0]) // 8, ends[0]).reshape(-1, 2)
        starts = np.flatnonzero(np.diff(part, prepend=part[:1] - 1))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)], strict=True):
            if held is not None and part[a] != last:
                for some in held.end():
                    yield from rows(some, held.again)
                held = None
            if held is None:
                held, last = PartMembers(most), part[a]
            mine = entries[(ends[a] - ends[0]) // 16 : (ends[b] - ends[0]) // 16]
            if b == len(part):  # may go on in the next batch, whose buffers are others
                mine = mine.copy()
            for some in held.add(mine):
                yield from rows(some, True)
    if held is not None:
        for some in held.end():
            yield from rows(some, held.again)


def line_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each row, and where they begin."""
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    return char_shingles(code_points(data), chars[:-1], chars[1:])


def _sketch_rows(batches):
    import pyarrow as pa

    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        ids = batch.column("item").to_numpy(zero_copy_only=False)
        for a, b in row_slices(offsets, 1 << 18):
            flat, begins = row_sets(*line_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
            n = np.diff(begins)
            cut = np.minimum(n, SKETCH)
            ends = np.cumsum(cut)
            flat = flat[np.arange(int(ends[-1])) + np.repeat(begins[:-1] - (ends - cut), cut)]
            yield pa.RecordBatch.from_pydict({"item": pa.array(ids[a:b]), "n": pa.array(n), "sketch": pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), flat)})


def line_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80, part: int = PART, most: int = MOST) -> DataFrame:
    """One row for each line that holds a word: doc_id, line_no, first_doc_id and first_line_no (the line
    that stands for its class) and kept (it is that line)."""
    docs = one_text_each(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id")
    lines = docs.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    bits = part_bits(lines, part)
    made = stored(arrow_map(docs, lambda batches: _line_rows(batches, percent, bits), LINE_SCHEMA))
    lines = made.filter("part is null").select("item", "doc_id", "line_no", "first")
    # Buckets of one item lead nowhere.
    dealt = made.filter("part is not null").select("part", "entries").repartition("part").sortWithinPartitions("part")
    shared = stored(arrow_map(dealt, lambda batches: _member_rows(batches, most), "bucket long, item long, again boolean"))
    members = shared.filter("not again").select("bucket", "item")
    if not shared.filter("again").isEmpty():  # of parts that were settled bit by bit
        members = stored(members.union(shared.filter("again").select("bucket", "item").distinct()))
    # One row for each text of a line: where it occurs first, how often. min_by sees a doc_id once for each item,
    # so it has no ties.
    once = F.when(F.col("first"), F.col("doc_id"))
    items = stored(lines.groupBy("item").agg(F.min("doc_id").alias("doc_id"), F.min_by("line_no", once).alias("line_no"), F.count("*").alias("c")))
    involved = stored(members.select("item").distinct())
    places = items.select("item", "doc_id", "line_no")
    at = stored(maybe_in(places, "item", involved).join(involved, "item", "left_semi"))
    wanted = at.groupBy("doc_id").agg(F.collect_list(F.struct("line_no", "item")).alias("w"))
    parts = maybe_in(docs, "doc_id", at.select("doc_id")).join(wanted, "doc_id").select("w", F.split("text", "\n", -1).alias("l"))
    texts = stored(parts.select(F.explode(F.expr("transform(w, x -> struct(x.item as item, l[x.line_no] as text))")).alias("x")).select("x.*"))
    sketches = stored(arrow_map(texts, _sketch_rows, "item long, n long, sketch array<long>"))

    found = classes(members, sketches, lambda some: maybe_in(texts, "item", some).join(some, "item", "left_semi"), line_sets, percent, SKETCH)
    discard(at, involved, members, shared, texts, sketches)
    # The first line of each class: of the classes found, and of items that occur again.
    linked = stored(maybe_in(places, "item", found.select("id")).join(found.withColumnRenamed("id", "item"), "item"))
    by_doc = linked.groupBy("component", "doc_id").agg(F.min("line_no").alias("line_no"))
    heads = stored(by_doc.groupBy("component").agg(F.min("doc_id").alias("first_doc_id"), F.min_by("line_no", "doc_id").alias("first_line_no")))
    again = items.filter("c > 1").select("item", F.col("doc_id").alias("first_doc_id"), F.col("line_no").alias("first_line_no")).join(linked.select("item"), "item", "left_anti")
    firsts = stored(linked.select("item", "component").join(heads, "component").select("item", "first_doc_id", "first_line_no").union(again))
    discard(linked, heads, items, found)
    # Lines that nothing repeats stay where they are.
    placed = lines.select("item", "doc_id", "line_no")
    maybe = flag_in(placed, "item", firsts.select("item"), "_maybe")
    joined = maybe.filter("_maybe").join(firsts, "item", "left").select("doc_id", "line_no", F.coalesce("first_doc_id", "doc_id").alias("first_doc_id"), F.coalesce("first_line_no", "line_no").alias("first_line_no"))
    out = joined.union(maybe.filter("not _maybe").select("doc_id", "line_no", "doc_id", "line_no"))
    return out.select("*", ((F.col("doc_id") == F.col("first_doc_id")) & (F.col("line_no") == F.col("first_line_no"))).alias("kept"))


def drop_duplicate_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars", emptied: bool = True, **how) -> DataFrame:
    """df with lines that another stands for taken out of its texts (n_chars, if there, follows). A text
    that loses every line that holds a word is a copy throughout: its row stays, without them, only if
    `emptied`. Of rows of equal doc_id, those with the text that stands for them lose lines."""
    gone = line_classes(df, doc_id, text, **how).filter("not kept").groupBy("doc_id").agg(F.collect_set("line_no").alias("_lines")).select(F.col("doc_id").alias("_doc"), "_lines")
    t, none = F.col("_row").getField(text), F.col("_lines").isNull()
    left = F.array_join(F.filter(F.split(t, "\n", -1), lambda x, i: ~F.array_contains(F.col("_lines"), i)), "\n")
    out = join_found(df, gone, doc_id, text).withColumn("_left", F.when(none, t).otherwise(left))
    if not emptied:
        out = out.filter(none | (F.length(F.translate("_left", WS, "")) > 0))
    new = {text: F.col("_left")}
    if n_chars and n_chars in df.columns:
        new[n_chars] = F.when(none, F.col("_row").getField(n_chars)).otherwise(F.length("_left").cast(df.schema[n_chars].dataType))
    return out.select(*own_columns(df, new))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of all lines of all documents."""
    return line_classes(documents(spark, sf_dir))
