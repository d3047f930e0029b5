"""Documents that the JSON reader refuses, cut at their brackets."""

from __future__ import annotations

import json
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadmill.operators import flatten, progress, structure
from threadmill.session import prepare, written_tables


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


TEXTS = ["plain", 'quote " and \\ back', "br[ack{ets}]", "é\n\t", "", '\\"', 'x":[{"id":1}']


def tree(rng, size):
    """A random tree of ``size`` comments as nested lists: (record, form of replies, replies)."""
    nodes = []
    for i in range(size):
        record = {"id": f"n{i}", "body": rng.choice(TEXTS)}
        if rng.random() < 0.2:
            record["media"] = [{"data": [{"id": "no", "replies": [{"id": "neither"}]}]}, {"k": rng.choice(TEXTS)}]
        if rng.random() < 0.2:
            record["extra"] = {"children": [{"id": f"own{i}", "replies": [{"id": "deep"}]}], "data": [{"x": [1, {"y": 2}]}]}
        nodes.append((record, rng.choice(["list", "envelope", "children", "children envelope"]), []))
    for i in range(1, size):
        near = rng.random() < 0.8
        nodes[i - 1 if near else rng.randrange(i)][2].append(i)
    return nodes


def text_of(nodes, spaces=False):
    """The tree as JSON text, written without recursion."""
    forms = {"list": ('"replies":[', "]"), "envelope": ('"replies":{"data":[', "]}"),
             "children": ('"replies":"","children":[', "]"), "children envelope": ('"replies":[],"children":{"data":[', "]}")}
    out, stack = ['{"data":['], [("open", 0)]
    while stack:
        what, i = stack.pop()
        if what == "text":
            out.append(i)
            continue
        record, form, replies = nodes[i]
        out.append(json.dumps(record)[:-1] + ("" if not replies else "," + (" \n" if spaces else "") + forms[form][0]))
        stack.append(("text", (forms[form][1] if replies else "") + "}"))
        for k, r in enumerate(reversed(replies)):
            stack.append(("open", r))
            if k < len(replies) - 1:
                stack.append(("text", " , " if spaces else ","))
    return "".join(out) + "]}"


def levels(nodes):
    at = {0: 0}
    for i, (_, _, replies) in enumerate(nodes):
        for r in replies:
            at[r] = at[i] + 1
    return sorted((at[i], json.dumps(n[0], sort_keys=True)) for i, n in enumerate(nodes))


def got(rows):
    out = {}
    for r in rows:
        record = json.loads(r.raw)
        for name in ("replies", "children"):
            record.pop(name, None)
        out.setdefault(r.k, []).append((r.level, json.dumps(record, sort_keys=True)))
    return {k: sorted(v) for k, v in out.items()}


def test_pieces_give_what_the_whole_gives(spark, monkeypatch):
    monkeypatch.setattr(structure, "EVERY", 6)
    rng = random.Random(1)
    trees = [tree(rng, rng.randint(1, 60)) for _ in range(40)]
    df = spark.createDataFrame([(i, text_of(t, i % 2 == 0)) for i, t in enumerate(trees)], "k int, tree string")
    whole = got(flatten.flatten_replies(df, "tree", ["k"]).collect())
    assert whole == {i: levels(t) for i, t in enumerate(trees)}
    pieces = flatten._Pieces(df, "tree")
    assert pieces.broken.isEmpty() and pieces.all.count() > 10 * len(trees)
    assert got(flatten._flatten_pieces(pieces, ["k"]).collect()) == whole


def test_thousands_of_levels(spark):
    rng = random.Random(2)
    trees = [tree(rng, n) for n in (400, 1000, 5000)]
    chain = [(n[0], n[1], [i + 1] if i + 1 < 5000 else []) for i, n in enumerate(tree(rng, 5000))]
    texts = [text_of(t) for t in [*trees, chain]]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, tree string")
    assert df.filter(F.try_parse_json("tree").isNull()).count() >= 1
    want = {i: levels(t) for i, t in enumerate([*trees, chain])}
    assert got(flatten.flatten_replies(df, "tree", ["k"]).collect()) == want
    assert want[3][-1][0] == 4999


def test_wide_documents_are_cut_at_their_records(spark):
    text = "[" + ",".join(json.dumps({"id": str(i), "body": "[{" * (i % 200)}) for i in range(3000)) + "]"
    df = spark.createDataFrame([(1, text)], "k int, tree string")
    pieces = flatten._Pieces(df, "tree")
    assert pieces.all.count() == 3001 and pieces.all.agg(F.max(F.length("text"))).first()[0] < len(text)
    assert flatten._flatten_pieces(pieces, ["k"]).where("level = 0").count() == 3000


BROKEN = ["", "{", "[" * 600, '[{"id":"a"}', '[{"id":"a"} {"id":"b"}]', '{"data":[{"id":"a","replies":[{"id":"b" "c"}]}]}', "[{]}", '["', "}{", "word"]


def test_broken_documents_are_listed_and_give_no_rows(spark):
    deep = '{"id":"x","replies":[' * 700
    texts = [*BROKEN, deep, deep + "]}" * 699 + "]", deep + "]}" * 700, "5", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, tree string")
    listed = {r.k: (r.characters, r.reason) for r in flatten.unreadable_documents(df, "tree", ["k"]).collect()}
    n = len(BROKEN)
    assert set(listed) == {*range(n), n, n + 1}
    assert listed[2] == (600, "not JSON") and listed[6] == (4, "too deep or not JSON")
    assert flatten.flatten_replies(df, "tree", ["k"]).count() == 0  # one comment alone is no list
    rows = flatten.flatten_replies(spark.createDataFrame([(1, f"[{texts[n + 2]}]"), *enumerate(BROKEN, 2)], "k int, tree string"), "tree", ["k"])
    assert {r.k: r.n for r in rows.groupBy("k").agg(F.count("*").alias("n")).collect()} == {1: 700}


def test_cutting_a_text_shuffles_nothing(spark):
    """A row per bracket, sorted several times, was more than executors hold; a text is walked in its row."""
    deep = '[{"id":"a","replies":' * 3000 + "[]" + "}]" * 3000
    docs = spark.createDataFrame([(1, deep), (2, deep[:-1])], "doc long, text string")
    pieces = structure.cut_documents(docs, "text", "m")
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    sizes = pieces.groupBy("doc").agg(F.count("*").alias("n"), F.max(F.length("text")).alias("longest")).collect()
    assert {r.doc: r.n > 100 for r in sizes} == {1: True, 2: False} and max(r.longest for r in sizes) < 1000


def test_marks_and_levels_of_a_cut_text():
    text = '[{"id":1,"replies" :\n[{"id":"]\\"[","replies":{"data":[]}}]},{"id":2}]'
    assert structure.cut_text(text, "m", 21) == [
        ("1:1", 0, '{"id":1,"replies" :\n[{"m":"2:1"}]}'.replace('{"m":"2:1"}', '{"id":"]\\"[","replies":{"data":[]}}')),
        ("1:2", 0, '{"id":2}'), ("0:0", 0, '[{"m":"1:1"},{"m":"1:2"}]'),
    ]


def test_deep_documents_take_few_passes(spark):
    """200 levels are less than the reader refuses; 12 a pass made 17 tables of ever smaller rests."""
    text = '[{"id":"a","replies":' * 200 + "[]" + "}]" * 200
    before = len(written_tables())
    rows = flatten.flatten_replies(spark.createDataFrame([(1, text)], "k int, tree string"), "tree", ["k"])
    assert len(written_tables()) - before <= 6
    assert sorted(r.level for r in rows.collect()) == list(range(200))


def cut_at_once(texts, every):
    """State, pieces (level, marks, text) and head of each text, as array steps over runs give them."""
    out = []
    for data, offsets in structure._runs(pa.array(texts)):
        cuts = structure.Cuts(data, offsets, every)
        pieces, of = {}, cuts.cut("m")
        for piece, text in zip(of[0], of[1].to_pylist()):
            pieces.setdefault(int(cuts.text[piece]), []).append((int(cuts.level[piece]), int(cuts.kids[piece]), text))
        heads = cuts.heads("m").to_pylist()
        out += [(int(cuts.state[i]), pieces.get(i, []), heads[i]) for i in range(cuts.count)]
    return out


@pytest.mark.parametrize("every", [1, 6, 21])
def test_runs_of_texts_are_cut_like_each_text(every, monkeypatch):
    rng = random.Random(5)
    good = [text_of(tree(rng, rng.randint(1, 60)), i % 2 == 0) for i in range(100)]
    good += [json.dumps(json.loads(t), indent=i) for i, t in zip([None, 1] * 20, good)]
    signs = [*'{}[]",:\\ \n', '"replies":[', '"data" : [', '{"id":1}', '"children":\t[', '"":[', '"a\\"', "[{", "}]"]
    noise = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    at = [rng.randrange(len(t)) for t in good]
    worn = [t[:i] + rng.choice(signs) + t[i + rng.randint(0, 2) :] for i, t in zip(at, good)]
    texts = [t for three in zip(good, worn, noise) for t in three] + noise + [text_of(tree(rng, 3000)), ""]
    monkeypatch.setattr(structure, "RUN_BYTES", 5000)
    marks, told = re.compile(r'\{"m":"[^"]*"\}'), set()
    for text, (state, pieces, head) in zip(texts, cut_at_once(texts, every), strict=True):
        told.add(state)
        want = structure.cut_text(text, "m", every)
        if state == structure.CUT:
            assert want != structure._UNSOUND
            assert sorted((level if name != "0:0" else -1, marks.sub("M", t)) for name, level, t in want) == sorted(
                (level, marks.sub("M", t)) for level, _, t in pieces)
            assert all(n in (-1, len(marks.findall(t))) for _, n, t in pieces)
            named = {f"1:{i}": t for i, (_, _, t) in enumerate(pieces)}
            whole = pieces[0][2]
            while (more := marks.sub(lambda m: named[m[0][6:-2]], whole)) != whole:
                whole = more
            assert whole == text and len(head) <= len(text) + 9 * text.count("{")
        else:
            assert not pieces and head is None
            assert state == structure.ODD or want == structure._UNSOUND or not structure._BRACKET.match(text)
    assert told == {structure.CUT, structure.UNSOUND, structure.ODD}


def labels(before):
    return {path.rsplit("/", 1)[1] for path in written_tables()[before:]}


DEEP = '[{"id":"a","body":"b","replies":' * 700 + "[]" + "}]" * 700


def test_deep_documents_are_told_without_storing_them(spark):
    before = len(written_tables())
    df = spark.createDataFrame([(1, DEEP), (2, DEEP[:-1]), (3, DEEP.replace('"b"', "b", 1)), (4, "[{"), (5, "[]"), (6, None)], "k int, tree string")
    got = flatten.unreadable_documents(df, "tree", ["k"])
    assert {r.k: r.characters for r in got.collect()} == {2: len(DEEP) - 1, 3: len(DEEP) - 2, 4: 2}
    assert labels(before) == {"unreadable"}


OWN = '{"a":[' * 600 + "1" + "]}" * 600


def last(text, old, new):
    """The innermost place changed: what is put back into own data takes a round a level."""
    return new.join(text.rsplit(old, 1))


# Odd ones: text behind the end, own data too deep; marks in own data, two lists of replies, a name written otherwise.
ODD = [DEEP + " x", f'[{{"id":"a","own":{OWN}}}]', last(DEEP, '"body":"b"', '"own":{"data":[{"id":"no"}]}'),
       DEEP.replace('"replies":', '"replies":[{"id":"lost"}],"replies":', 1),
       last(DEEP, '"replies":[]', '"repl\\u0069es":[{"id":"c","replies":[{"id":"d"}]}]'),
       last(DEEP, '"replies":[]', '"replies":["x"],"children":[{"id":"c"}]')]


def test_odd_documents_are_read_like_pieces(spark):
    texts = [*ODD, DEEP, DEEP[:-1], DEEP.replace('"b"', "b", 1), DEEP.replace('"b"', "null", 1)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, tree string")
    rows = got(flatten.flatten_replies(df, "tree", ["k"]).collect())
    pieces = flatten._Pieces(df, "tree", flatten.EVERY_RECORD)
    assert rows == got(flatten._flatten_pieces(pieces, ["k"]).collect()) and len(rows[len(ODD)]) == 700
    broken = {r.k for r in pieces.rows.join(pieces.broken, "_doc").collect()}
    assert broken == {1, len(ODD) + 1, len(ODD) + 2}
    assert {r.k for r in flatten.unreadable_documents(df, "tree", ["k"]).collect()} == broken


def test_plain_deep_documents_are_read_where_they_are(spark):
    before = len(written_tables())
    rows = flatten.flatten_replies(spark.createDataFrame([(1, DEEP), (2, DEEP[:-1])], "k int, tree string"), "tree", ["k"])
    assert sorted(r.level for r in rows.collect()) == list(range(700))
    assert labels(before) == {"pass=0", "records"}


def test_cursors_of_deep_pages_store_no_pieces(spark):
    page = '{"data":[{"id":"a","created_utc":5},' + DEEP[1:-1] + ',{"id":"z","created_utc":"7.5"},{"created_utc":"soon"}]}'
    texts = [page, page[:-1], '{"data":[]}', page + " x", page.replace('"b"', "b", 1), f'[{{"created_utc":1,"own":{OWN}}}]', None]
    before = len(written_tables())
    got = progress.page_cursors(spark.createDataFrame([(1, page), (2, page[:-1])], "k int, p string"), "p", ["k"])
    assert sorted(map(tuple, got.collect())) == [(1, 4, 7, False, False), (2, None, None, False, True)]
    assert labels(before) == {"cursors", "deep"}
    got = progress.page_cursors(spark.createDataFrame(list(enumerate(texts)), "k int, p string"), "p", ["k"])
    broken = (None, None, False, True)
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == {
        0: (4, 7, False, False), 1: broken, 2: (0, None, True, False), 3: (4, 7, False, False), 4: broken, 5: broken,
        6: (0, None, True, False),
    }
