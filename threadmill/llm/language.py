"""Language of a text by a convolutional network over bytes.

Texts are cut into windows of WINDOW bytes. Byte vectors pass filters of several widths, each
filter keeps its greatest answer in the window, and a softmax layer gives the languages. A text's
logits are the mean over all its windows, weighted by their bytes, so every byte counts whatever
the length. The network is trained in numpy on windows of a bounded sample of labelled texts: at
most SAMPLE texts of each language, WINDOWS windows of each. More than LANGUAGES languages are an
error, since the sample grows with them.

Null text and text without a letter is ``und`` with score 0; so is every text if there is
nothing to learn from. Rows with null language teach nothing. Repeated rows and null ids are
rows like any other; an empty table gives an empty result. Only text is looked at to predict.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import labelled_sample, scored, text_steps, tidy

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
VECTOR = 12
SAMPLE = 1200
WINDOWS = 2
LANGUAGES = 200
EPOCHS = 5
UNKNOWN = "und"


def windows(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Zero-padded windows of all texts, the text each belongs to, and its bytes of that text."""
    lengths = np.diff(offsets)
    each = np.maximum(1, -(-lengths // window))
    owner = np.repeat(np.arange(len(each)), each)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
    start = offsets[:-1][owner] + nth * window
    used = np.clip(lengths[owner] - nth * window, 0, window)
    padded = np.concatenate([data, np.zeros(window, np.uint8)])
    out = padded[start[:, None] + np.arange(window)]
    out[np.arange(window) >= used[:, None]] = 0
    return out, owner, used


class Network:
    """Byte vectors, filters of each width, pooling by maximum, and one linear layer."""

    def __init__(self, labels: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.p = {"bytes": rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32)}
        for w in WIDTHS:
            self.p[f"filter{w}"] = rng.normal(0, (2 / (w * VECTOR)) ** 0.5, (w, VECTOR, FILTERS)).astype(np.float32)
            self.p[f"bias{w}"] = np.zeros(FILTERS, np.float32)
        self.p["out"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(labels))).astype(np.float32)
        self.p["prior"] = np.zeros(len(labels), np.float32)

    def _tables(self) -> dict[int, list[np.ndarray]]:
        """A filter's answer to a byte at each of its places."""
        return {w: [self.p["bytes"] @ self.p[f"filter{w}"][j] for j in range(w)] for w in WIDTHS}

    def learn(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.01) -> None:
        rng = np.random.default_rng(11)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step, total = 0, epochs * -(-len(x) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at : at + batch]
                step += 1
                for k, g in self._gradients(x[rows], y[rows]).items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    scale = rate * (1 - step / (total + 1)) / (1 - 0.9**step)
                    self.p[k] -= scale * m / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        n = len(x)
        wide = np.concatenate([x, np.zeros((n, max(WIDTHS)), np.uint8)], axis=1)
        tables, places, pooled = self._tables(), {}, []
        for w in WIDTHS:
            answer = self.p[f"bias{w}"] + sum(t[wide[:, j : j + WINDOW]] for j, t in enumerate(tables[w]))
            places[w] = answer.argmax(axis=1)
            pooled.append(np.take_along_axis(answer, places[w][:, None, :], axis=1)[:, 0])
        raw = np.concatenate(pooled, axis=1)
        hidden = np.maximum(raw, 0)
        p = _softmax(hidden @ self.p["out"] + self.p["prior"])
        p[np.arange(n), y] -= 1
        p /= n
        g = {"out": hidden.T @ p, "prior": p.sum(axis=0), "bytes": np.zeros_like(self.p["bytes"])}
        back = (p @ self.p["out"].T) * (raw > 0)
        for k, w in enumerate(WIDTHS):
            gw = back[:, k * FILTERS : (k + 1) * FILTERS]
            g[f"bias{w}"] = gw.sum(axis=0)
            g[f"filter{w}"] = np.zeros_like(self.p[f"filter{w}"])
            for j in range(w):
                seen = wide[np.arange(n)[:, None], places[w] + j]
                cell = seen.astype(np.int64) * FILTERS + np.arange(FILTERS)
                gt = np.bincount(cell.ravel(), gw.ravel(), 256 * FILTERS).reshape(256, FILTERS).astype(np.float32)
                g[f"filter{w}"][j] = self.p["bytes"].T @ gt
                g["bytes"] += gt @ self.p[f"filter{w}"][j].T
        return g

    def compiled(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """A trained network laid out for speed: answers to byte pairs are looked up."""

    def __init__(self, net: Network):
        t = net._tables()
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        bias = np.concatenate([net.p[f"bias{w}"] for w in WIDTHS])
        # Widths 2, 3 and 4 begin with a pair; 3 goes on with a byte and 4 with another pair.
        self.first = np.concatenate([pair(t[2][0], t[2][1]), pair(t[3][0], t[3][1]), pair(t[4][0], t[4][1])], axis=1) + bias
        zero = np.zeros_like(t[3][2])
        self.second = np.concatenate([pair(t[3][2], zero), pair(t[4][2], t[4][3])], axis=1).astype(np.float32)
        self.first = self.first.astype(np.float32)
        self.out, self.prior, self.labels = net.p["out"], net.p["prior"], net.labels

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Of each window."""
        wide = np.concatenate([x, np.zeros((len(x), 4), np.uint8)], axis=1).astype(np.int32)
        pairs = wide[:, :-1] * 256 + wide[:, 1:]
        answer = self.first.take(pairs[:, :WINDOW].ravel(), axis=0)
        answer[:, FILTERS:] += self.second.take(pairs[:, 2 : WINDOW + 2].ravel(), axis=0)
        pooled = answer.reshape(len(x), WINDOW, -1).max(axis=1)
        return np.maximum(pooled, 0) @ self.out + self.prior

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The label number and its probability for each text."""
        # Windows are made and scored in small runs, also those of one long text.
        n = len(offsets) - 1
        total, weight = np.zeros((n, len(self.labels))), np.zeros(n)
        x, owner, used = windows(data, offsets)
        for at in range(0, len(x), 256):
            part = slice(at, at + 256)
            share = np.maximum(used[part], 1).astype(float)
            np.add.at(total, owner[part], self.logits(x[part]) * share[:, None])
            np.add.at(weight, owner[part], share)
        p = _softmax(total / weight[:, None])
        best = p.argmax(axis=1)
        return best, p[np.arange(n), best]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(docs: DataFrame, learnable: Column) -> Scorer | None:
    """Fit on ``doc_id, text, lang`` rows where ``learnable`` holds; None if there is none."""
    rows = docs.where(learnable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "lang")
    if len(rows.select("lang").distinct().limit(LANGUAGES + 1).collect()) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages; raise LANGUAGES to learn them all")
    chosen = labelled_sample(rows, "lang", SAMPLE).distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in text_steps(batch.column(1)):
                x, owner, used = windows(data, offsets)
                first = np.searchsorted(owner, np.arange(to - at))
                count = np.bincount(owner, minlength=to - at)
                # Spread over the whole text.
                pick = np.unique((first[:, None] + count[:, None] * np.arange(WINDOWS) // WINDOWS).ravel())
                pick = pick[used[pick] > 0]
                langs = batch.column(2).take(pa.array(owner[pick] + at))
                yield pa.RecordBatch.from_arrays([langs, pa.array([r.tobytes() for r in x[pick]], pa.binary())], ["lang", "window"])

    texts = docs.join(F.broadcast(chosen), ["doc_id", "lang"]).select("doc_id", "text", "lang")
    table = texts.mapInArrow(tidy(cut), "lang string, window binary").toArrow().sort_by([("lang", "ascending"), ("window", "ascending")])
    if not table.num_rows:
        return None
    labels = sorted(set(table["lang"].to_pylist()))
    x = np.frombuffer(b"".join(table["window"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    y = np.searchsorted(np.array(labels, object), np.array(table["lang"].to_pylist(), object))
    net = Network(labels)
    net.learn(x, y)
    return net.compiled()


def predict(docs: DataFrame, scorer: Scorer | None, text: str = "text") -> DataFrame:
    """All rows with ``lang_pred`` and ``score``; columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score")
    if scorer is None:
        return docs.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    known = F.col(text).rlike(r"\p{L}")
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def pick(model: Scorer, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        best, score = model(data, offsets)
        return [pa.array(model.labels, pa.string()).take(pa.array(best)), pa.array(score)]

    said = scored(F.col(text), shared, "lang string, score double", pick)
    out = docs.withColumn("_said", said)
    return out.select(
        *docs.columns,
        F.when(known, F.col("_said.lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, F.col("_said.score")).otherwise(0.0).alias("score"),
    )
