from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixture import documents, frame
from threadmill.llm import language, quality, toxicity
from threadmill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")


def tables(spark):
    return (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))


@given
def test_language_held_out(spark):
    docs, _ = tables(spark)
    rows = QUERIES["op3_language"](spark, SF_DIR).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95


@given
@pytest.mark.parametrize("query, label", [("op2_toxicity", "toxic"), ("op4_quality", "quality")])
def test_labels_held_out(spark, query, label):
    docs, labels = tables(spark)
    got = QUERIES[query](spark, SF_DIR)
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    least = {"toxic": 0.3, "quality": 0.5}[label]
    assert all(r.predicted == (r.score >= least) for r in rows)
    known = got.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r[label] for r in known]) > 0.85


def test_network_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    net = language.Network(["a", "b", "c"])
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    x, y = rng.integers(0, 256, (6, language.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])

    def loss():
        z = np.log(language._softmax(language.Scorer(net).logits(x).astype(float)))
        return -z[np.arange(6), y].mean()

    g = net._gradients(x, y)
    for name in ("out", "prior", "bias3", "filter2", "filter4"):
        at = tuple(int(i) for i in np.unravel_index(np.abs(g[name]).argmax(), g[name].shape))
        old, step = net.p[name][at], 1e-3
        net.p[name][at] = old + step
        up = loss()
        net.p[name][at] = old - step
        down = loss()
        net.p[name][at] = old
        assert abs((up - down) / (2 * step) - g[name][at]) < 0.1 * abs(g[name][at]) + 1e-4


def test_every_byte_of_a_text_is_in_one_window():
    texts = [b"", b"abc", bytes(range(1, 256)) * 5]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    x, owner, used = language.windows(data, offsets)
    for i, t in enumerate(texts):
        assert b"".join(r[:u].tobytes() for r, u, o in zip(x, used, owner) if o == i) == t
        assert all((r[u:] == 0).all() for r, u in zip(x, used))


def test_pairs_are_learned():
    """Two terms that are harmless alone and toxic together: weights cannot tell, products can."""
    rng = np.random.default_rng(1)
    owner, bucket, y = [], [], []
    for i in range(1200):
        a, b = i % 2, i // 2 % 2
        own = [t for t, on in ((11, a), (22, b)) if on] + rng.integers(100, 140, 6).tolist()
        own = sorted(set(own))
        owner += [i] * len(own)
        bucket += own
        y.append(float(a == b))
    model = toxicity.fit(np.array(owner), np.array(bucket), np.array(y), 0.5)
    w, v = (x[model.place[[11, 22]]] for x in (model.weight, model.vector))
    alone, together = model.bias + w, model.bias + w.sum() + v[0] @ v[1]
    # No weights alone do better than a logit of 0 everywhere here.
    assert together > 1.5 and alone.max() < 0.1 and v[0] @ v[1] > 1


def test_pairs_are_learned_among_many_terms():
    """Terms that tell nothing alone keep a row of their own, whatever else the texts hold."""
    rng = np.random.default_rng(1)
    owner, bucket, y = [], [], []
    for i in range(2000):
        a, b = i % 2, i // 2 % 2
        own = [t for t, on in ((11, a), (22, b)) if on] + rng.integers(100, 30_100, 60).tolist()
        own = sorted(set(own))
        owner += [i] * len(own)
        bucket += own
        y.append(float(a == b))
    model = toxicity.fit(np.array(owner), np.array(bucket), np.array(y), 0.5)
    assert (model.place[np.unique(bucket)] >= 0).all() and (model.place >= 0).sum() == len(np.unique(bucket))
    w, v = (x[model.place[[11, 22]]] for x in (model.weight, model.vector))
    alone, together = model.bias + w, model.bias + w.sum() + v[0] @ v[1]
    assert together > 0.5 and alone.max() < -0.5


def test_units_stay_in_their_text():
    text = "ab c\tdéf".encode()
    data = np.frombuffer(text * 2, np.uint8)
    one = quality.text_units(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    two = quality.text_units(data, np.array([0, len(text), 2 * len(text)]))
    for (p, b), (pp, bb) in zip(one, two):
        assert pp.tolist() == p.tolist() + (p + len(text)).tolist() and bb.tolist() == b.tolist() * 2


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_rows_and_labels(spark, module, label):
    docs = frame(spark, documents(plain=20) + [(1, "again", None, None, 5), (None, None, None, None, None)])
    docs = docs.withColumnRenamed("n_chars", "value").withColumnRenamed("lang", label)
    labels = spark.createDataFrame([(1, 1), (1, 1), (4, 0), (7, None), (None, 1), (10**6, 0)], f"doc_id long, {label} int")
    for some in (labels, labels.where(F.col(label) == 1), labels.limit(0)):
        model = module.train(docs, some, F.lit(True), label)
        rows = module.score(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert module.score(frame(spark, []), model).collect() == []


def test_odd_rows_and_languages(spark):
    docs = frame(spark, documents(plain=20) + [(None, "no id", "xx", None, 5), (3, "12 ?!", "xx", None, 5)])
    docs = docs.withColumnRenamed("n_chars", "lang_pred")
    scorer = language.train(docs, F.lit(True))
    rows = language.predict(docs, scorer).collect()
    assert len(rows) == docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in ("xx", "yy") and 0 < r.score <= 1) if letters else (r.lang_pred, r.score) == ("und", 0)
    assert language.train(docs, F.lit(False)) is None
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}
    assert language.predict(frame(spark, []), scorer).collect() == []


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    rows = spark.createDataFrame([(i, "text", f"l{i}") for i in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 2"):
        language.train(rows, F.lit(True))
