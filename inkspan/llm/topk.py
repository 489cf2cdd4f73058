"""Exact top-k search by BM25 over an inverted index with block-max pruning.

1. Statistics (documents, words, document frequencies) come from all rows: each task counts its batches' terms
   before the shuffle.
2. The index is written once, a row for each shard of at most SHARD documents: its terms (64-bit hashes of
   words), their postings and impacts' parts. A shard's documents are in an order that puts like ones
   together, so that the largest impact of a term in a block of BLOCK documents says much about the block, and so
   that a query meets the columns of its own kind of documents only.
3. Queries go in blocks of at most QUERY_TERMS terms, with the corpus' statistics of their terms, to all tasks.
   A task reads shards and takes queries in batches of like ones. A shard's documents lie in sections of one kind
   (`kinds`; languages, as a rule). Of a section's terms, the frequent ones (MaxScore's non-essential lists) form a
   matrix of impacts, the others stay lists. For each query the lists of its rarer terms are added up by document;
   with the largest impacts of its frequent terms this bounds each section, block and document, and what is under
   the k-th best score so far is passed over: sections, blocks, and documents where none is a pivot. Blocks are
   taken by falling bound; what remains gets its frequent terms by a product of matrices. One shard of AHEAD is
   searched first, by all tasks; the k-th scores found there are where the tasks for the others start from.
4. Bounds and sums are 32-bit with a margin; the documents near the k-th score are scored again in 64 bits, in
   the order of terms. A task keeps its k best of each query from shard to shard, and the merge of all tasks' is
   by score, then doc_id. As every score uses the global statistics, the merge is exact.

Words are those of the contract, ASCII lower-cased. idf is ln(1 + (N - df + 0.5) / (df + 0.5)); a term's weight in
a query grows with its count there. Documents that share no term with a query are not returned, so a null or
empty query has no rows; of equal scores (copies) the smaller doc_id wins; an empty table gives no rows. Each
row of documents ranks by itself, also if its doc_id is repeated; rows of queries with equal query_id are one
query of all their words. Rows without a doc_id (or query_id) are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkspan.llm.common import LOWER, arrow_map, discard, documents, row_slices, slice_hashes, stored, utf8, word_bounds

K1, B = 1.2, 0.75
K = 10
#: Terms of a block of queries, documents and postings of a shard, documents of a block, queries of a batch.
QUERY_TERMS, SHARD, POSTINGS, BLOCK, BATCH = 1 << 20, 4096, 3 << 20, 64, 256
#: A term in more than one document of DENSE counts as frequent; at most so many terms of a shard do.
DENSE, COLUMNS = 48, 2048
#: Blocks that are scored together; the share by which sums of 32 bits may be off.
WAVE, MARGIN = 16, 2e-5
#: Leading words that are looked at for kinds of documents; documents of a section; one shard of so many is searched first.
LEADS, SECTION, AHEAD = 64, 256, 16
#: Postings that are added up at a time; terms whose frequencies a task adds up.
PART, COUNTED = 1 << 20, 1 << 20


def kinds(rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """A number of each of n rows, by their terms: rows that share their most frequent words, as those of one language
    do, have the same. It orders and groups rows, no more."""
    lead = np.zeros(n, np.int64)
    by_count = np.lexsort((terms, counts, rows))
    lead[rows[by_count]] = terms[by_count]  # the last of a row stays
    words, size = np.unique(lead, return_counts=True)
    words = words[np.argsort(-size, kind="stable")[:LEADS]]
    order = np.argsort(words)
    at = np.minimum(np.searchsorted(words[order], terms), len(words) - 1)
    some = words[order][at] == terms if len(words) else np.zeros(len(terms), bool)
    uses = np.zeros((n, len(words)), np.int32)
    uses[rows[some], order[at[some]]] = counts[some]
    heads, kind = [], np.zeros(len(words), np.int64)
    for i, word in enumerate(words.tolist()):  # a word goes with the head that most of the rows it leads hold too
        held = (uses[lead == word][:, heads] > 0).mean(axis=0) if heads else np.zeros(1)
        if heads and held.max() >= 0.5:
            kind[i] = held.argmax()
        else:
            kind[i] = len(heads)
            heads.append(i)
    votes = np.zeros((n, len(heads) + 1), np.int64)
    for i in range(len(words)):
        votes[:, kind[i]] += uses[:, i]
    votes[:, -1] = votes[:, :-1].max(axis=1, initial=0) == 0
    return votes.argmax(axis=1)


def term_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of each distinct term of each row (by row, then term); words of each row."""
    starts, ends, before = word_bounds(data, offsets)
    h = slice_hashes(LOWER[data], starts, ends).view(np.int64)
    lengths = np.diff(before)
    rows, terms, counts = [], [], []
    for i, (a, b) in enumerate(zip(before[:-1].tolist(), before[1:].tolist(), strict=True)):
        if b > a:
            t, c = np.unique(h[a:b], return_counts=True)
            rows.append(np.full(len(t), i))
            terms.append(t)
            counts.append(c)
    none = np.zeros(0, np.int64)
    return (np.concatenate(rows), np.concatenate(terms), np.concatenate(counts), lengths) if rows else (none, none, none, lengths)


def _batches(batches):
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for a, b in row_slices(offsets):
            yield ids[a:b], *term_rows(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def _count_rows(batches):
    """(term, df) of what a task reads, added up while it is at most COUNTED terms; a last row without a term has
    the documents and words."""
    import pyarrow as pa

    held, n, docs, words = [], 0, 0, 0

    def added():
        t, c = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(t)
        t, c = t[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        return t[first], np.add.reduceat(c, first)

    def rows(t, c):
        for a in range(0, len(t), 1 << 16):
            zeros = np.zeros(len(t[a : a + (1 << 16)]), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(t[a : a + (1 << 16)]), pa.array(c[a : a + (1 << 16)]), pa.array(zeros), pa.array(zeros)], names=["term", "df", "docs", "words"])

    for ids, _, terms, _, lengths in _batches(batches):
        docs, words = docs + len(ids), words + int(lengths.sum())
        t, c = np.unique(terms, return_counts=True)
        if not len(t):
            continue
        held.append((t, c))
        n += len(t)
        if n >= COUNTED:
            held = [added()]
            n = len(held[0][0])
            if 2 * n >= COUNTED:
                yield from rows(*held[0])
                held, n = [], 0
    if held:
        yield from rows(*added())
    yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([0]), pa.array([docs]), pa.array([words])], names=["term", "df", "docs", "words"])


def _query_rows(batches):
    import pyarrow as pa

    for ids, rows, terms, counts, _ in _batches(batches):
        yield pa.RecordBatch.from_pydict({"query_id": pa.array(ids[rows] if len(rows) else np.zeros(0, np.int64)), "term": pa.array(terms), "n": pa.array(counts)})


class Queries:
    """A block of queries: their ids, and terms by query with weights, over a sorted vocabulary. Queries of a
    kind stand together."""

    def __init__(self, ids, terms, counts, df, n_docs: int):
        order = np.lexsort((terms, ids))
        ids, terms, counts, df = ids[order], terms[order], counts[order], df[order]
        new = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (terms[1:] != terms[:-1])])) if len(ids) else np.zeros(0, np.int64)
        counts = np.add.reduceat(counts, new) if len(new) else counts
        ids, terms, df = ids[new], terms[new], df[new]
        weights = counts * np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
        self.vocabulary, terms = np.unique(terms, return_inverse=True)
        names, first, number = np.unique(ids, return_index=True, return_inverse=True)
        size = np.diff(np.append(first, len(ids)))
        order = np.lexsort((size, kinds(number, terms, counts, len(names))))
        self.ids = names[order]
        self.bounds = np.concatenate([[0], np.cumsum(size[order])])
        at = np.arange(len(ids)) + np.repeat(first[order] - self.bounds[:-1], size[order])
        self.terms, self.weights = terms[at], weights[at]
        #: What the k-th score of each is at least.
        self.floors = np.zeros(len(names))

    def start_from(self, found) -> None:
        """Takes the k-th scores in a part of the documents, an Arrow table (query_id, score)."""
        order = np.argsort(self.ids)
        at = order[np.searchsorted(self.ids[order], found.column("query_id").to_numpy())]
        self.floors[at] = found.column("score").to_numpy()


class Best:
    """The k best documents of each query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), -np.inf)
        self.docs = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, q: int, docs: np.ndarray, scores: np.ndarray) -> None:
        s, d = np.concatenate([self.scores[q], scores]), np.concatenate([self.docs[q], docs])
        order = np.lexsort((d, -s))[: self.k]
        self.scores[q], self.docs[q] = s[order], d[order]


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after another."""
    return np.arange(int(counts.sum())) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


def build(ids, rows, terms, counts, lengths) -> dict[str, np.ndarray]:
    """A shard's index: ids and lengths of documents in their new order, and where sections of one kind end; terms,
    and where each one's postings begin; documents and counts of postings, by term, then document."""
    kind = kinds(rows, terms, counts, len(ids))
    size = np.bincount(kind)
    kind[size[kind] < SECTION] = len(size)  # small ones together, at the end
    order = np.lexsort((lengths, kind))
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    rows = place[rows]
    by_term = np.lexsort((rows, terms))
    terms = terms[by_term]
    first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, np.int64)
    size = np.bincount(kind)
    made = {"ids": ids[order], "lengths": lengths[order], "sections": np.cumsum(size[size > 0]), "terms": terms[first], "starts": np.append(first, len(terms)), "docs": rows[by_term], "counts": counts[by_term]}
    return {k: v.astype(INDEX[k]) for k, v in made.items()}


INDEX = {"ids": np.int64, "lengths": np.int32, "sections": np.int32, "terms": np.int64, "starts": np.int32, "docs": np.uint16, "counts": np.int32}


def _index_rows(batches):
    import pyarrow as pa

    held, docs, postings = [], 0, 0

    def shard():
        base = np.cumsum([0, *[len(h[0]) for h in held]])
        parts = [np.concatenate(x) for x in zip(*[(h[0], h[1] + o, *h[2:]) for h, o in zip(held, base.tolist(), strict=False)], strict=True)]
        made = build(*parts)
        return pa.RecordBatch.from_pydict({k: pa.array([v.tobytes()], pa.binary()) for k, v in made.items()})

    for ids, rows, terms, counts, lengths in _batches(batches):
        ends = np.searchsorted(rows, np.arange(1, len(ids) + 1))
        a = 0
        while a < len(ids):
            begin = int(ends[a - 1]) if a else 0
            b = min(len(ids), a + SHARD - docs, int(np.searchsorted(ends, begin + POSTINGS - postings, "right")))
            b = max(b, a) if held else max(b, a + 1)
            if b > a:
                end = int(ends[b - 1])
                held.append((ids[a:b], rows[begin:end] - a, terms[begin:end], counts[begin:end], lengths[a:b]))
                docs, postings, a = docs + b - a, postings + end - begin, b
            if a < len(ids):
                yield shard()
                held, docs, postings = [], 0, 0
    if held:
        yield shard()


class Section:
    """Documents of one kind in a shard: a matrix of the impacts of their frequent terms, and its block maxima."""

    def __init__(self, start: int, blocks: int, columns: int):
        self.start, self.blocks = start, blocks
        self.matrix = np.zeros((blocks * BLOCK, columns), np.float32)

    def close(self) -> None:
        self.maxima = self.matrix.reshape(self.blocks, BLOCK, -1).max(axis=1)
        self.peaks = self.maxima.max(axis=0)


class Shard:
    """A shard's index as far as a block of queries needs it. Sections begin with a block, so there are places
    without a document."""

    def __init__(self, index: dict[str, np.ndarray], queries: Queries, average: float):
        at = np.searchsorted(index["terms"], queries.vocabulary)
        at[at == len(index["terms"])] = 0
        hit = index["terms"][at] == queries.vocabulary if len(index["terms"]) else np.zeros(len(at), bool)
        #: Of each query term: its number here, or -1.
        self.number = np.where(hit, np.cumsum(hit) - 1, -1)
        starts = index["starts"].astype(np.int64)
        first, size = starts[at[hit]], np.diff(starts)[at[hit]]
        where = _ranges(first, size)
        docs, counts = index["docs"][where], index["counts"][where]
        norm = K1 * (1 - B + B * index["lengths"] / average)
        impacts = counts * (K1 + 1) / (counts + norm[docs])
        ends = index["sections"].astype(np.int64)
        n_docs = np.diff(ends, prepend=0)
        blocks = -(-n_docs // BLOCK)
        starts = BLOCK * (np.cumsum(blocks) - blocks)
        place = np.arange(len(index["ids"])) + np.repeat(starts - (ends - n_docs), n_docs)
        self.width = int(blocks.sum()) * BLOCK
        self.ids = np.zeros(self.width, np.int64)
        self.ids[place] = index["ids"]
        docs = place[docs]
        # By document, for full scores: terms in the order of the queries' vocabulary.
        order = np.argsort(docs.astype(np.uint16) if self.width <= 1 << 16 else docs, kind="stable")
        term = np.repeat(np.arange(len(size), dtype=np.int32), size)
        self.row_terms, self.row_impacts, row = term[order], impacts[order], docs[order]
        self.row_starts = np.searchsorted(row, np.arange(self.width + 1))
        # Each section's frequent terms make its matrix; the other postings stay lists.
        rare = np.ones(len(docs), bool)
        self.sections, self.columns = [], np.full((len(blocks), len(size)), -1, np.int32)
        for columns, start, b, n in zip(self.columns, starts.tolist(), blocks.tolist(), n_docs.tolist(), strict=True):
            here = slice(self.row_starts[start], self.row_starts[start + b * BLOCK])
            held = np.bincount(self.row_terms[here], minlength=len(size))
            often = np.flatnonzero(held * DENSE > n)
            often = often[np.argsort(-held[often], kind="stable")[:COLUMNS]]
            columns[often] = np.arange(len(often))
            column = columns[self.row_terms[here]]
            some = np.flatnonzero(column >= 0)
            made = Section(start, b, len(often))
            made.matrix[row[here][some] - start, column[some]] = self.row_impacts[here][some]
            made.close()
            self.sections.append(made)
            rare[order[here][some]] = False
        self.docs, self.impacts = docs[rare], impacts[rare]
        self.size = np.bincount(term[rare], minlength=len(size))
        self.starts = np.cumsum(self.size) - self.size

    def search(self, queries: Queries, best: Best) -> None:
        for lo in range(0, len(queries.ids), BATCH):
            self._batch(queries, best, lo, min(lo + BATCH, len(queries.ids)))

    def _batch(self, queries: Queries, best: Best, lo: int, hi: int) -> None:
        n, width = hi - lo, self.width
        a, b = queries.bounds[lo], queries.bounds[hi]
        row = np.repeat(np.arange(n), np.diff(queries.bounds[lo : hi + 1]))
        number = self.number[queries.terms[a:b]]
        here = number >= 0
        if not here.any():
            return
        row, number, weight = row[here], number[here], queries.weights[a:b][here]
        size = self.size[number]
        rare = np.flatnonzero(size)
        size, first, base, w = size[rare], self.starts[number[rare]], row[rare] * width, weight[rare]
        sums, cuts = None, np.searchsorted(np.cumsum(size), np.arange(PART, int(size.sum()) + PART, PART))
        for x, y in zip([0, *(cuts[:-1] + 1).tolist()], [*(cuts[:-1] + 1).tolist(), len(size)], strict=True):  # bounded vectors
            where = _ranges(first[x:y], size[x:y])
            part = np.bincount(np.repeat(base[x:y], size[x:y]) + self.docs[where], np.repeat(w[x:y], size[x:y]) * self.impacts[where], n * width)
            sums = part if sums is None else sums + part
        sums = (np.zeros(n * width, np.float32) if sums is None else sums.astype(np.float32)).reshape(n, width // BLOCK, BLOCK)
        # The k-th best so far, which a document needs at least, and something of it at all.
        floor = np.maximum(np.maximum(best.scores[lo:hi, -1], queries.floors[lo:hi]).astype(np.float32) * np.float32(1 - MARGIN), np.finfo(np.float32).tiny)
        found = []
        for section, columns in zip(self.sections, self.columns, strict=True):
            column = columns[number]
            often = np.flatnonzero(column >= 0)
            column, holder, held = column[often], row[often], weight[often]
            part = sums[:, section.start // BLOCK :][:, : section.blocks]
            tops = part.max(axis=2)
            # The best that any document of the section can have; few queries go on to those of another kind.
            most = np.bincount(holder, held * section.peaks[column], n) + tops.max(axis=1)
            mine = np.flatnonzero(most * (1 + MARGIN) >= floor)
            if not len(mine):
                continue
            place = np.full(n, -1)
            place[mine] = np.arange(len(mine))
            asks = place[holder] >= 0
            weights = np.zeros((len(mine), section.matrix.shape[1]), np.float32)
            weights[place[holder[asks]], column[asks]] = held[asks]
            bounds = weights @ section.maxima.T
            found.append((section, mine, weights, bounds, (bounds + tops[mine]) * np.float32(1 + MARGIN), part))
        kept_q, kept_d, kept_s = [], [], []
        highest = np.full((n, best.k), -np.inf, np.float32)
        for section, mine, weights, bounds, tops, sums in sorted(found, key=lambda x: -len(x[1])):
            order = np.argsort(-tops.max(axis=0), kind="stable")
            for at in range(0, section.blocks, WAVE):
                wave = order[at : at + WAVE]
                open_ = tops[:, wave] >= floor[mine][:, None]
                some = np.flatnonzero(open_.any(axis=1))
                wave = wave[open_.any(axis=0)]
                if not len(some):
                    continue
                asked = mine[some]
                part = sums[asked[:, None], wave]
                pivots = (part + bounds[some[:, None], wave][:, :, None]) * np.float32(1 + MARGIN) >= floor[asked][:, None, None]
                left = np.flatnonzero(pivots.any(axis=0).reshape(-1))
                docs = (wave[:, None] * BLOCK + np.arange(BLOCK)).reshape(-1)[left]
                scores = part.reshape(len(some), -1)[:, left] + weights[some] @ section.matrix[docs].T
                i, j = np.nonzero(scores >= floor[asked][:, None])
                kept_q.append(asked[i])
                kept_d.append(docs[j] + section.start)
                kept_s.append(scores[i, j])
                if len(i) and len(left) > best.k:
                    raised = np.unique(i)
                    high = np.partition(scores[raised], len(left) - best.k, axis=1)[:, -best.k :]
                    raised = asked[raised]
                    highest[raised] = np.partition(np.concatenate([highest[raised], high], axis=1), best.k, axis=1)[:, best.k :]
                    floor[raised] = np.maximum(floor[raised], highest[raised].min(axis=1) * np.float32(1 - MARGIN))
        if not kept_q:
            return
        q, d, s = np.concatenate(kept_q), np.concatenate(kept_d), np.concatenate(kept_s)
        near = s >= floor[q]
        q, d = q[near], d[near]
        order = np.argsort(q, kind="stable")
        q, d = q[order], d[order]
        full = np.zeros(len(self.size) + 1)  # the last is for terms that are not here
        ends = np.searchsorted(q, np.arange(n + 1))
        for k in np.flatnonzero(np.diff(ends)).tolist():
            mine = slice(queries.bounds[lo + k], queries.bounds[lo + k + 1])
            terms = self.number[queries.terms[mine]]
            full[terms] = queries.weights[mine]
            full[-1] = 0
            docs = d[ends[k] : ends[k + 1]]
            begin, size = self.row_starts[docs], self.row_starts[docs + 1] - self.row_starts[docs]
            where = _ranges(begin, size)
            scores = np.add.reduceat(full[self.row_terms[where]] * self.row_impacts[where], np.cumsum(size) - size)
            best.add(lo + k, self.ids[docs], scores)
            full[terms] = 0


def _search_rows(queries: Queries, average: float, k: int):
    def run(batches):
        import pyarrow as pa

        best = Best(len(queries.ids), k)
        for batch in batches:
            for i in range(batch.num_rows):
                index = {c: np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in INDEX.items()}
                Shard(index, queries, average).search(queries, best)
        q, r = np.nonzero(best.scores > -np.inf)
        yield pa.RecordBatch.from_pydict({"query_id": pa.array(queries.ids[q]), "doc_id": pa.array(best.docs[q, r]), "score": pa.array(best.scores[q, r])})

    return run


def _search(index: DataFrame, queries: Queries, average: float, k: int) -> DataFrame:
    sent = index.sparkSession.sparkContext.broadcast(queries)
    rows = stored(arrow_map(index, lambda b: _search_rows(sent.value, average, k)(b), "query_id long, doc_id long, score double"))
    sent.destroy()
    return rows


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(df: DataFrame, queries: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text", query_id: str = "query_id", query: str = "query") -> DataFrame:
    """(query_id, rank, doc_id, score): the k best rows of df for each row of queries."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null")
    asked = queries.select(F.col(query_id).cast("long").alias("doc_id"), F.col(query).alias("text")).filter("doc_id is not null")
    counts = arrow_map(docs, _count_rows, "term long, df long, docs long, words long")
    counts = stored(counts.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("df", "docs", "words")]))
    total = counts.filter("term is null").first()
    n, words = (total["docs"], total["words"]) if total else (0, 0)
    average = max(words, 1) / max(n, 1)
    terms = arrow_map(asked, _query_rows, "query_id long, term long, n long").join(counts.filter("term is not null").select("term", "df"), "term")
    terms = stored(terms)
    discard(counts)
    blocks = max(1, -(-terms.count() // QUERY_TERMS))
    index = stored(arrow_map(docs, _index_rows, ", ".join(f"{c} binary" for c in INDEX)), "zstd")
    some = F.pmod(F.xxhash64("ids"), F.lit(AHEAD)) == 0
    halves = [index.filter(some), index.filter(~some)] if index.count() >= 2 * AHEAD else [index]
    found = None
    for i in range(blocks):
        got = terms.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i).toArrow()
        block = Queries(*[got.column(c).to_numpy() for c in ("query_id", "term", "n", "df")], n)
        del got
        for half in halves:
            rows = _search(half, block, average, k)
            found = rows if found is None else found.union(rows)
            if half is not halves[-1]:
                block.start_from(_ranked(rows, k).filter(F.col("rank") == k).select("query_id", "score").toArrow())
    discard(terms, index)
    return _ranked(found, k).select("query_id", "rank", "doc_id", "score")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for the text of every document whose id is divisible by 100."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return search(docs, docs.filter("doc_id % 100 = 0"), query_id="doc_id", query="text")
