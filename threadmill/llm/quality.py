"""Quality of a text by supervised subword embeddings.

Every word and every character n-gram of GRAMS bytes is hashed to a bucket with a learned
vector, and a word that follows itself counts in one more bucket of its own; a text is the average of its vectors, and a softmax layer over it gives the label.
Vectors and layer are trained together by stochastic gradient descent in numpy, on a bounded
sample of labelled texts: at most SAMPLE of each label, and TRAINED bytes of each, spread over
the text in runs. Scoring takes whole texts: both layers are linear up to the softmax, so
a bucket's contribution to the logit is one number.

N-grams stay within a word and its neighbouring white space, so they see where words begin and
end; letter case counts. Null and empty texts score by the labels' shares. Labels without a
text teach nothing; with labels of one kind only, every score is that kind's share. Repeated
rows and null ids are rows like any other. Only text is looked at to score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import _SPACE, Words, labelled_sample, scored, text_steps, tidy

BITS = 17
GRAMS = (3, 4)
#: The bucket of a word that follows itself, whatever the word.
REPEAT = 1 << BITS
VECTOR = 8
SAMPLE = 2500
TRAINED = 4096
EPOCHS = 4


def text_units(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(place, bucket) of the words, of their repeats and of the n-grams of each length, in order of place."""
    words = Words(data, offsets, lower=False)
    hashes, n = words.hash(), len(data)
    out = [(words.start, (hashes >> np.uint64(64 - BITS)).astype(np.int64))]
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[words.first[:-1][words.first[:-1] < len(hashes)]] = False
    place = words.start[same]
    out.append((place, np.full(len(place), REPEAT)))
    solid = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    wide = data.astype(np.uint32)
    for k in GRAMS:
        if n < k:
            continue
        m = n - k + 1
        value = np.zeros(m, np.uint32)
        keep = np.ones(m, bool)
        for j in range(k):
            value |= wide[j : j + m] << np.uint32(8 * j)
            if j:
                keep &= ~edge[j : j + m]
            if 0 < j < k - 1:
                keep &= solid[j : j + m]
        place = np.flatnonzero(keep)
        hashed = value[place] * np.uint32(2654435761) + np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF)
        hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out.append((place, (hashed >> np.uint32(32 - BITS)).astype(np.int64)))
    return out


class Model:
    def __init__(self, logits: np.ndarray, base: float):
        #: What a bucket adds to the mean logit, and the logit of a text without units.
        self.logits, self.base = logits, base

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        total, count = np.zeros(n), np.zeros(n)
        for place, bucket in text_units(data, offsets):
            first = np.searchsorted(place, offsets)
            sums = np.concatenate([[0.0], np.cumsum(self.logits[bucket])])
            total += sums[first[1:]] - sums[first[:-1]]
            count += np.diff(first)
        z = self.base + total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(texts: list[bytes], y: np.ndarray, share: float, seed: int = 5) -> Model:
    n, ones = len(y), int(y.sum())
    base = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    if ones in (0, n):
        return Model(np.zeros(REPEAT + 1), base)
    units = []
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        buckets = np.concatenate([b for _, b in text_units(data, np.array([0, len(data)]))])
        ids, count = np.unique(buckets, return_counts=True)
        units.append((ids, (count / max(1, count.sum())).astype(np.float32)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / VECTOR, 1 / VECTOR, (REPEAT + 1, VECTOR)).astype(np.float32)
    layer = np.zeros((VECTOR, 2), np.float32)
    layer += rng.normal(0, 0.1, layer.shape)
    step, total = 0, EPOCHS * n
    for _ in range(EPOCHS):
        for i in rng.permutation(n):
            rate = 0.5 * (1 - step / total)
            step += 1
            ids, part = units[i]
            if not len(ids):
                continue
            rows = vectors[ids]
            mean = part @ rows
            z = mean @ layer
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(y[i])] -= 1
            back = layer @ p
            layer -= rate * np.outer(mean, p)
            # A unit moves by its share of the text; the common factor is part of the rate.
            vectors[ids] = rows - rate * len(ids) ** 0.5 * part[:, None] * back
    # The sample is balanced as the labels allow; the corpus has its own shares.
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), base - float(np.log(ones / (n - ones))))


def train(docs: DataFrame, labels: DataFrame, learnable: Column, label: str = "quality") -> Model:
    """Fit on the texts of ``docs`` whose row in ``labels`` (doc_id, label) is learnable."""
    rows = labels.where(learnable & F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("label")).distinct()
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # two rows at most
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    chosen = labelled_sample(rows, "label", SAMPLE)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for _, _, data, offsets in text_steps(batch.column(1)):
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    own, size = data[a:b], b - a
                    if size > TRAINED:
                        # Four runs, evenly spread.
                        part = TRAINED // 4
                        own = np.concatenate([own[s : s + part] for s in range(0, size - part + 1, (size - part) // 3)][:4])
                    kept.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(kept, pa.binary())], ["doc_id", "label", "text"])

    texts = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    kind = docs.schema["doc_id"].dataType.simpleString()
    table = texts.mapInArrow(tidy(runs), f"doc_id {kind}, label int, text binary").toArrow().sort_by("doc_id")
    return fit(table["text"].to_pylist(), table["label"].to_numpy().astype(float), share)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """All rows with ``out``, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    value = scored(F.col(text), shared, "value double", lambda m, data, offsets: [pa.array(m(data, offsets))])
    return docs.drop(out).withColumn(out, value["value"])
