"""Ranked lexical search with hashed max-sketches.

The index holds one row per document with terms: its term hashes with their counts, and a sketch.
The sketch has CELLS coordinates per distinct term, rounded up to a power of two; a term's impact
goes to PROBES hashed coordinates, and each keeps the greatest that falls there. Impacts grow with
the count of a term alone within a document, so the sketch stores the greatest counts, and holds
for any later statistics. The least of a query term's coordinates bounds its impact from above.

A batch of queries reads the narrow sketches first: all bounds of a batch of documents come from
one table lookup. The documents with the greatest bounds of each query are scored exactly; the
worst of the k best so far is a threshold that all final results reach. Then every document whose
bound reaches a threshold is scored exactly, from the greatest bound down, while thresholds rise;
below its threshold no document can enter. Results are exact; the sketch only saves work.

    w = floor(1000 ln((2N + 2) / (2 df + 1)))    m = 25 + (75 n N) div L
    score = sum over the query's terms of w ((10**9 tf) div (1000 tf + 8 m))

N, L: documents with terms, and their terms; n: terms of a document; df: documents with the term.

Null texts have no terms. Documents without an id count in the statistics but are never results;
rows that repeat an id are documents of their own. Every row of the queries is a query of its own;
one without terms has no results. Empty tables give none. Other columns take no part. Terms are
told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm.common import text_steps, tidy
from threadmill.llm.terms import Terms, hash64
from threadmill.llm.vectors import best
from threadmill.session import materialize

CELLS, PROBES, LEAST_CELLS = 8, 4, 64
#: A count that stands for itself and all greater ones.
FULL = 255
#: Queries that are searched in one pass over the index, on average.
QUERY_BLOCK = 2048
#: Table cells that a numpy step over documents and query terms may have.
STEP_CELLS = 1 << 19
#: Documents that are scored before thresholds are looked at again.
SLAB = 64

_INDEX = "doc_id long, n long, sketch binary, terms binary, counts binary"
_ONE = np.uint64(1)


def _cells(h: np.ndarray, probe: int, size: np.ndarray | int) -> np.ndarray:
    """The coordinate of each hash in a sketch of ``size``, a power of two, for one probe."""
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | _ONE
    return ((low + np.uint64(probe) * high) & (np.asarray(size, np.uint64) - _ONE)).astype(np.int64)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Cut bytes into one value per size."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _whole(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column as one array of numbers, and where each value starts there."""
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    body = column.buffers()[2]
    raw = np.frombuffer(body, np.uint8)[ends[0] : ends[-1]] if body is not None else np.zeros(0, np.uint8)
    return raw.view(kind), (ends - ends[0]) // np.dtype(kind).itemsize


def _term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, term hash) with counts, by text; and the terms of each text."""
    terms = Terms(data, offsets)
    h, owner = hash64(terms.data, terms.start, terms.end), terms.owner()
    by = np.lexsort((h, owner))
    h, owner = h[by], owner[by]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], h[at], np.diff(np.append(at, len(h))), np.diff(terms.first)


def index(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index (doc_id, n, sketch, terms, counts) of all rows with terms."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in text_steps(batch.column(1)):
                owner, h, tf, n = _term_counts(data, offsets)
                distinct = np.bincount(owner, minlength=to - at)
                kept = np.flatnonzero(n)
                size = np.maximum(LEAST_CELLS, 1 << np.ceil(np.log2(np.maximum(distinct * CELLS, 1))).astype(np.int64))
                size[n == 0] = 0
                start = np.cumsum(size) - size
                sketch = np.zeros(int(size.sum()), np.uint8)
                # From small counts to great ones: the last one written to a coordinate stays.
                rise = np.argsort(np.minimum(tf, FULL).astype(np.uint8), kind="stable")
                owner, h_up, tf_up = owner[rise], h[rise], np.minimum(tf, FULL).astype(np.uint8)[rise]
                places = [start[owner] + _cells(h_up, p, size[owner]) for p in range(PROBES)]
                for count in np.unique(tf_up):
                    same = slice(*np.searchsorted(tf_up, [count, count + 1 if count < FULL else FULL + 1]).tolist())
                    for p in places:
                        sketch[p[same]] = count
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, to - at).take(pa.array(kept)), pa.array(n[kept]), _binary(sketch, size[kept]),
                    _binary(h.view(np.uint8), 8 * distinct[kept]), _binary(tf.astype("<u4").view(np.uint8), 4 * distinct[kept]),
                ], ["doc_id", "n", "sketch", "terms", "counts"])

    rows = docs.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(tidy(build), _INDEX)
    return materialize(rows, "sketches")


class _Queries:
    """A block of queries against all documents: distinct terms, and which query takes which with what weight."""

    def __init__(self, texts: pa.Array):
        parts, at = [], 0
        for a, b, data, offsets in text_steps(texts):
            owner, h, tf, _ = _term_counts(data, offsets)
            parts.append((owner + a, h, tf))
        query, h, self.times = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        self.size = len(texts)
        self.vocabulary, self.term = np.unique(h.astype(np.uint64), return_inverse=True)
        # Queries without terms take no part: each sum starts at its first entry.
        self.query, self.begin = np.unique(query, return_index=True)
        self.weight = np.zeros(len(query), np.int64)

    def weigh(self, n_docs: int, df: np.ndarray, n_terms: int) -> None:
        w = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()]
        self.weight = np.array(w, np.int64)[self.term] * self.times
        self.n_docs, self.n_terms = n_docs, n_terms

    def sums(self, impacts: np.ndarray) -> np.ndarray:
        """Sums of weighted impacts (documents x vocabulary) per document and query."""
        return np.add.reduceat(impacts[:, self.term] * self.weight, self.begin, axis=1)

    def lengths(self, n: np.ndarray) -> np.ndarray:
        return 25 + (75 * n * self.n_docs) // self.n_terms

    def bounds(self, n: np.ndarray, sketch: np.ndarray, start: np.ndarray, cells: dict) -> np.ndarray:
        """Upper bounds of the scores of documents whose sketches have one size; sums of rounded-up parts only round up."""
        size = int(start[1] - start[0])
        if size not in cells:
            cells[size] = [_cells(self.vocabulary, p, size) for p in range(PROBES)]
        rows = sketch[start[0] : start[0] + size * len(n)].reshape(len(n), size) if len(n) else sketch[:0].reshape(0, 1)
        tf = rows[:, cells[size][0]]
        for place in cells[size][1:]:
            np.minimum(tf, rows[:, place], out=tf)
        count = np.arange(FULL + 1, dtype=float)
        table = 1e9 * count / (1000 * count + 8 * self.lengths(n)[:, None])
        table[:, FULL] = 1e6  # what no count reaches
        return self.sums(np.take_along_axis(table, tf.astype(np.intp), 1))

    def scores(self, n: np.ndarray, terms: np.ndarray, counts: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Exact scores per document and query."""
        at = np.minimum(np.searchsorted(self.vocabulary, terms), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[at] == terms)
        owner = np.searchsorted(start, hit, "right") - 1
        tf = counts[hit].astype(np.int64)
        impacts = np.zeros((len(n), len(self.vocabulary)), np.int64)
        impacts[owner, at[hit]] = (10**9 * tf) // (1000 * tf + 8 * self.lengths(n)[owner])
        return self.sums(impacts)


def _sized(sketches: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of a batch by the size of their sketch: (rows, their bytes, where each starts)."""
    raw, ends = _whole(sketches, "u1")
    sizes = np.diff(ends)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, raw[(ends[rows][:, None] + np.arange(size)).ravel()], np.arange(len(rows) + 1) * size


def _bounds(queries: _Queries, n: np.ndarray, sketches: pa.Array, cells: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, bounds) for all rows of a batch, in steps of bounded size."""
    step = max(1, STEP_CELLS // max(1, len(queries.term)))
    for rows, raw, start in _sized(sketches):
        for a in range(0, len(rows), step):
            part = rows[a : a + step]
            yield part, queries.bounds(n[part], raw, start[a : a + len(part) + 1], cells)


class _Best:
    """The k best results of each query so far, and the score that a new one must reach."""

    def __init__(self, queries: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.row, self.doc, self.score = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, row: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        self.row, self.doc, self.score = best(
            np.append(self.row, row), np.append(self.doc, doc), np.append(self.score, score), self.k
        )
        nth = np.arange(len(self.row)) - np.searchsorted(self.row, self.row)
        full = nth == self.k - 1
        self.least[self.row[full]] = np.maximum(self.least[self.row[full]], self.score[full])


def _greatest_bounds(rows: DataFrame, shared: Broadcast, k: int) -> DataFrame:
    """(q, doc_id): of each query the k documents with the greatest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, cells = shared.value, {}
        top = _Best(len(queries.query), k, np.zeros(len(queries.query)))
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for part, bound in _bounds(queries, batch.column(1).to_numpy(), batch.column(2), cells):
                i, q = np.nonzero(bound > top.least)
                top.add(q, ids[part[i]], bound[i, q])
        yield pa.RecordBatch.from_arrays([pa.array(top.row), pa.array(top.doc), pa.array(top.score, pa.float64())], ["q", "doc_id", "bound"])

    found = rows.where("doc_id IS NOT NULL").select("doc_id", "n", "sketch").mapInArrow(tidy(run), "q long, doc_id long, bound double")
    w = Window.partitionBy("q").orderBy(F.desc("bound"), "doc_id")
    return found.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k).select("q", "doc_id")


def _exact(rows: DataFrame, shared: Broadcast, k: int, least: Broadcast) -> DataFrame:
    """(q, doc_id, score): per task the k best of each query among the documents whose bounds reach the thresholds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, cells = shared.value, {}
        top = _Best(len(queries.query), k, least.value)
        for batch in batches:
            ids, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            kept, bounds = [], []
            for part, bound in _bounds(queries, n, batch.column(2), cells):
                near = np.flatnonzero((bound >= top.least).any(axis=1))
                kept.append(part[near]), bounds.append(bound[near])
            if not kept:
                continue
            kept, bounds = np.concatenate(kept), np.concatenate(bounds)
            (terms, at), (counts, _) = _whole(batch.column(3), "<u8"), _whole(batch.column(4), "<u4")
            down = np.argsort(-(bounds - top.least).max(axis=1), kind="stable")
            slab = min(SLAB, max(1, STEP_CELLS // max(1, len(queries.term))))
            for a in range(0, len(down), slab):
                part = down[a : a + slab]
                part = part[(bounds[part] >= top.least).any(axis=1)]
                if not len(part):
                    continue  # thresholds have risen above all of them
                rows_ = kept[part]
                size = at[rows_ + 1] - at[rows_]
                start = np.cumsum(size) - size
                take = np.arange(int(size.sum())) + np.repeat(at[rows_] - start, size)
                score = queries.scores(n[rows_], terms[take], counts[take], start)
                i, q = np.nonzero((score >= top.least) & (score > 0))
                top.add(q, ids[rows_[i]], score[i, q])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (top.row, top.doc, top.score)], ["q", "doc_id", "score"])

    return rows.select("doc_id", "n", "sketch", "terms", "counts").mapInArrow(tidy(run), "q long, doc_id long, score long")


def _document_counts(rows: DataFrame, vocabulary: Broadcast) -> np.ndarray:
    """How many documents hold each term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            h, _ = _whole(batch.column(0), "<u8")
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            total += np.bincount(at[known[at] == h], minlength=len(known))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "df"])

    got = rows.select("terms").mapInArrow(tidy(run), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(len(vocabulary.value), np.int64)
    out[got["term"].to_numpy()] = got["df"].to_numpy()
    return out


def search(index_: DataFrame, items: DataFrame, k: int, id_: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents, ties to the smaller doc_id."""
    spark = index_.sparkSession
    kind = items.schema[id_].dataType
    items = items.select(F.col(id_).alias("item_id"), F.col(text).alias("text"))
    items = materialize(items.withColumn("nth", F.monotonically_increasing_id()), "items")
    blocks = -(-items.count() // QUERY_BLOCK) or 1
    whole = index_.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    found = []
    for block in range(blocks):
        # Queries are parameters of the search; a block of them is held by the driver and every task.
        asked = items.where(F.pmod(F.xxhash64("nth"), F.lit(blocks)) == block).toArrow()
        texts = asked["text"].combine_chunks() if asked.num_rows else pa.array([], pa.string())
        queries = _Queries(texts)
        if not len(queries.query) or not whole["docs"]:
            continue
        df = _document_counts(index_, spark.sparkContext.broadcast(queries.vocabulary))
        queries.weigh(whole["docs"], df, whole["terms"])
        shared = spark.sparkContext.broadcast(queries)
        near = _greatest_bounds(index_, shared, k).select("doc_id").distinct()  # k rows a query at most
        first = index_.join(F.broadcast(near), "doc_id", "left_semi")
        none = spark.sparkContext.broadcast(np.ones(len(queries.query), np.int64))
        kth = _ranked(_exact(first, shared, k, none), k).where(F.col("rank") == k).select("q", "score").toArrow()
        least = np.ones(len(queries.query), np.int64)
        least[kth["q"].to_numpy()] = kth["score"].to_numpy()
        rows = _exact(index_.where("doc_id IS NOT NULL"), shared, k, spark.sparkContext.broadcast(least))
        names = asked["item_id"].take(pa.array(queries.query))
        table = pa.table({"_q": pa.array(np.arange(len(queries.query))), "item_id": names})
        top = _ranked(rows, k).join(F.broadcast(spark.createDataFrame(table)), F.col("q") == F.col("_q"))
        found.append(top.select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.desc("score"), "doc_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
