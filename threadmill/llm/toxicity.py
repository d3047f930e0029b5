"""Toxicity of a text by a factorization machine over hashed terms.

Terms are the words of a text and the beginnings of words (PREFIXES bytes), which stand for
families of forms; each is hashed to one of BUCKETS. The machine gives every term a weight and a
vector, and every pair of terms in a text the product of their vectors, so that two terms may
mean together what neither means alone:

    logit = b + sum w_i + 1/2 ((sum v_i)^2 - sum v_i^2)

It is trained in numpy on a bounded sample of labelled texts, at most SAMPLE of each label, on
all buckets seen there: no term is left out for what it tells alone, since it may tell in pairs.
Its bias is then moved from the sample's share of labels to the share among all labelled texts.

Null and empty texts score by the bias alone. Texts without a label, or labels without a text,
teach nothing; with labels of one kind only, every score is that kind's share. Repeated rows and
null ids are rows like any other. Only text is looked at to score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import Words, labelled_sample, scored, text_steps, tidy

BUCKETS = 1 << 18
PREFIXES = (4, 5, 6)
SAMPLE = 4000
VECTOR = 8
STEPS = 400
BATCH = 512
RATE = 0.3
#: What draws weights and vectors to zero; pairs of chance grow more slowly than vectors shrink.
SHRINK_WEIGHT = 0.005
SHRINK_VECTOR = 0.03


def text_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of all terms, repeats included."""
    words = Words(data, offsets)
    hashes = [words.hash(), *(words.prefix(k) for k in PREFIXES)]
    buckets = np.concatenate([(h & np.uint64(BUCKETS - 1)).astype(np.int64) for h in hashes])
    return np.tile(words.owner(), len(hashes)), buckets


def _once(owner: np.ndarray, term: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(owner * terms + term)
    return both // terms, both % terms


class Machine:
    def __init__(self, place: np.ndarray, weight: np.ndarray, vector: np.ndarray, bias: float):
        #: Of each bucket its row in ``weight`` and ``vector``, or -1.
        self.place, self.weight, self.vector, self.bias = place, weight, vector, bias

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        owner, bucket = text_terms(data, offsets)
        row = self.place[bucket]
        owner, row = _once(owner[row >= 0], row[row >= 0], len(self.weight) + 1)
        z = self.bias + np.bincount(owner, self.weight[row], n)
        for v in self.vector.T:
            one = v[row]
            z += 0.5 * (np.bincount(owner, one, n) ** 2 - np.bincount(owner, one * one, n))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(owner: np.ndarray, bucket: np.ndarray, y: np.ndarray, share: float, seed: int = 3) -> Machine:
    """From (text, bucket) without repeats and a label per text; ``share`` of all labels are 1."""
    n, ones = len(y), int(y.sum())
    place = np.full(BUCKETS, -1, np.int64)
    base = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    if ones in (0, n):
        return Machine(place, np.zeros(0), np.zeros((0, VECTOR)), base)
    seen = np.bincount(bucket, minlength=BUCKETS)
    chosen = np.flatnonzero(seen)
    terms = len(chosen)
    place[chosen] = np.arange(terms)
    term = place[bucket].astype(np.int32)
    ends = np.searchsorted(owner, np.arange(n + 1))
    # Terms count from their mean here, so that common ones make no pairs with everything; the
    # machine that is returned is the same one in terms that count 0 or 1.
    mean = seen[chosen] / n
    spread = np.sqrt(mean * (1 - mean))

    rng = np.random.default_rng(seed)
    w, v = np.zeros(terms), rng.normal(0, 0.01, (VECTOR, terms))
    bias, sums = np.log(ones / (n - ones)), [np.full(terms, 1e-3), 1e-3, 1e-3]
    for _ in range(STEPS):
        rows = rng.integers(0, n, BATCH)
        length = ends[rows + 1] - ends[rows]
        at = np.repeat(np.arange(BATCH), length)
        c = term[np.arange(len(at)) + np.repeat(ends[rows] - np.cumsum(length) + length, length)]
        square = v * v
        alone = w - 0.5 * square.sum(axis=0) * (1 - 2 * mean)
        xv = np.stack([np.bincount(at, one[c], BATCH) for one in v]) - (v @ mean)[:, None]
        z = bias - w @ mean + np.bincount(at, alone[c], BATCH) + 0.5 * ((xv**2).sum(axis=0) - (square @ mean**2).sum())
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / BATCH
        hit = np.bincount(c, g[at], terms)
        gw = hit - mean * g.sum()
        gv = np.stack([np.bincount(c, one[at], terms) for one in xv * g]) - (xv @ g)[:, None] * mean
        gv += (SHRINK_VECTOR - (1 - 2 * mean) * hit - mean**2 * g.sum()) * v
        sums = [s + d for s, d in zip(sums, (gw**2, (gv**2).sum(), g.sum() ** 2))]
        rate = RATE / np.sqrt(sums[0])
        w -= rate * gw
        w = np.sign(w) * np.maximum(np.abs(w) - rate * SHRINK_WEIGHT * spread, 0)
        v -= gv / np.sqrt(sums[1])
        bias -= 0.1 * g.sum() / np.sqrt(sums[2])
    middle = v @ mean
    bias += 0.5 * ((middle**2).sum() - (v * v @ mean**2).sum()) - w @ mean
    w += mean * (v * v).sum(axis=0) - middle @ v
    # The sample is balanced; the corpus is not.
    bias = float(bias - np.log(ones / (n - ones)) + base)
    return Machine(place, w.astype(np.float32), v.T.astype(np.float32), bias)


def train(docs: DataFrame, labels: DataFrame, learnable: Column, label: str = "toxic") -> Machine:
    """Fit on the texts of ``docs`` whose row in ``labels`` (doc_id, label) is learnable."""
    rows = labels.where(learnable & F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("label")).distinct()
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # two rows at most
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    chosen = labelled_sample(rows, "label", SAMPLE)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in text_steps(batch.column(1)):
                owner, bucket = _once(*text_terms(data, offsets), BUCKETS)
                ends = np.searchsorted(owner, np.arange(to - at + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bucket, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), batch.column(2).slice(at, to - at), lists], ["doc_id", "label", "terms"]
                )

    texts = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    kind = docs.schema["doc_id"].dataType.simpleString()
    table = texts.mapInArrow(tidy(terms), f"doc_id {kind}, label int, terms array<int>").toArrow().sort_by("doc_id").combine_chunks()
    lists = table["terms"].combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, int)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return fit(owner, lists.flatten().to_numpy(), table["label"].to_numpy().astype(float), share)


def score(docs: DataFrame, machine: Machine, text: str = "text", out: str = "score") -> DataFrame:
    """All rows with ``out``, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    value = scored(F.col(text), shared, "value double", lambda model, data, offsets: [pa.array(model(data, offsets))])
    return docs.drop(out).withColumn(out, value["value"])
