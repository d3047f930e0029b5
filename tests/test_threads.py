from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from threadmill.operators import flatten, threads
from threadmill.operators.lookup import lookup_left
from threadmill.session import materialize, prepare
from threadmill.sources.sinks import write_nested

SCHEMA = "id string, parent_id string, subreddit string, author string, body string, created_epoch bigint"


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def comments(spark, *rows):
    full = [(i, p, "s", "u", "x", n) for n, (i, p) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def depths(spark, *rows):
    return {r.id: r.depth for r in threads.resolve_forest(comments(spark, *rows)).collect()}


def test_depths_and_roots(spark):
    forest = threads.resolve_forest(
        comments(spark, ("a", "t3_p"), ("b", "t1_a"), ("c", "t1_b"), ("d", "t3_p"), ("e", None), ("f", "zz"))
    )
    assert {r.id: (r.depth, r.root_id) for r in forest.collect()} == {
        "a": (0, "a"), "b": (1, "a"), "c": (2, "a"), "d": (0, "d"), "e": (0, "e"), "f": (0, "f")
    }


def test_orphan_is_a_root_with_its_subtree(spark):
    # Two branches under a comment whose parent was never seen, beside a sound thread.
    rows = [("m", "t1_lost"), ("n", "t1_m"), ("o", "t1_m"), ("q", "t1_o"), ("r", "t3_post"), ("s", "t1_r")]
    assert depths(spark, *rows) == {"m": 0, "n": 1, "o": 1, "q": 2, "r": 0, "s": 1}


def test_cycles_keep_null(spark):
    got = depths(spark, ("a", "t1_b"), ("b", "t1_a"), ("self", "t1_self"), ("under", "t1_self"), ("ok", "t3_p"))
    assert got == {"a": None, "b": None, "self": None, "under": None, "ok": 0}


def test_parents_are_looked_up_within_the_subreddit(spark):
    rows = [("a", "t3_p", "one"), ("b", "t1_a", "two"), ("c", "t1_a", "one")]
    df = spark.createDataFrame(rows, "id string, parent_id string, subreddit string")
    assert {r.id: r.depth for r in threads.resolve_forest(df).collect()} == {"a": 0, "b": 0, "c": 1}


def test_deep_chain_and_cycle(spark):
    df = spark.sql(
        """SELECT concat('k', id) id, CASE WHEN id = 0 THEN 't3_p' ELSE concat('t1_k', id - 1) END parent_id FROM range(1500)
        UNION ALL SELECT concat('z', id), concat('t1_z', (id + 1) % 3) FROM range(3)
        UNION ALL SELECT 'self', 't1_self' UNION ALL SELECT 'under', 't1_self'"""
    ).withColumn("subreddit", F.lit("s"))
    forest = threads.resolve_forest(df)
    row = forest.agg(
        F.max("depth").alias("deepest"), F.count_if(F.col("depth").isNull()).alias("stuck"),
        F.count_if(F.concat(F.lit("k"), F.col("depth")) == F.col("id")).alias("right"),
    ).first()
    assert (row.deepest, row.stuck, row.right) == (1499, 5, 1500)


def test_child_is_one_deeper_than_its_parent(spark):
    df = spark.range(3000).selectExpr(
        "concat('c', id) id", "CASE WHEN id % 7 = 0 THEN 't3_p' ELSE concat('t1_c', cast(id / (1 + id % 5) as int) - 1) END parent_id",
        "'s' subreddit",
    )
    found = threads.resolve_forest(df).join(df, ["subreddit", "id"])
    up = found.select(F.concat(F.lit("t1_"), "id").alias("parent_id"), F.col("depth").alias("up"))
    bad = found.join(up, "parent_id").filter(~(F.col("depth").eqNullSafe(F.col("up") + 1)))
    assert bad.count() == 0


@pytest.mark.parametrize("hot_rows", [1, 50, 10**9])
@pytest.mark.parametrize("left_rows", [None, 400])
def test_lookup_is_the_same_on_every_way(spark, hot_rows, left_rows):
    left = spark.range(400).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id % 40) END k", "'s' s"
    )
    right = spark.range(30).selectExpr("concat('k', id) key", "id v", "'s' t").union(
        spark.sql("SELECT 'hot', 99, 's'")
    )
    got = lookup_left(left, right, ["s", "k"], ["t", "key"], ["v"], left_rows=left_rows, hot_rows=hot_rows)
    want = left.join(right, (F.col("k") == F.col("key")) & (F.col("s") == F.col("t")), "left").select(*got.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("hot", [3, 10**6])
def test_forest_takes_the_large_way_too(spark, monkeypatch, hot):
    monkeypatch.setattr("threadmill.operators.lookup.SMALL_LEFT", 0)
    monkeypatch.setattr("threadmill.operators.threads.SMALL_LEFT", 0)
    monkeypatch.setattr("threadmill.operators.lookup.HOT_ROWS", hot)
    edges = [("r", "t3_p"), ("a", "t1_r"), ("b", "t1_a"), ("x", "t1_y"), ("y", "t1_x"), ("o", "t1_gone"), ("z", None)]
    edges += [(f"k{i}", "t1_b" if i % 2 else "t1_r") for i in range(12)] + [("deep", "t1_k1")]
    want = {"r": 0, "a": 1, "b": 2, "x": None, "y": None, "o": 0, "z": 0, "deep": 4}
    want |= {f"k{i}": 3 if i % 2 else 1 for i in range(12)}
    assert depths(spark, *edges) == want


def test_sample_counts(spark):
    df = comments(spark, ("a", "t3_p"), ("b", "t1_a"), ("c", "t1_zz"), ("d", "t1_c"))
    assert [tuple(threads.sample_counts(df, n).first()) for n in (2, 4)] == [(2, 1), (4, 2)]


def forest_of(rows):
    return sorted((r.subreddit, r.id, r.parent, r.depth, r.root_id) for r in rows.collect())


def grown(spark, batches):
    """The kept forest after all batches, checked after each against all comments so far."""
    forest, all_links = spark.createDataFrame([], "subreddit string, id string, parent string, depth int, root_id string"), {}
    for batch in batches:
        all_links.update({(s, i): p for s, i, p in batch})
        links = spark.createDataFrame(batch, "subreddit string, id string, parent_id string")
        changes = materialize(threads.forest_changes(forest, links), "changes")
        forest = materialize(threads.with_changes(forest, changes), "forest")
        rows = spark.createDataFrame([(s, i, p) for (s, i), p in all_links.items()], links.schema)
        assert forest_of(forest) == forest_of(threads.whole_forest(rows))
    return forest, changes


def test_forest_grows_batch_by_batch(spark):
    rng = random.Random(7)
    for _ in range(3):
        names = [f"c{i}" for i in range(60)]
        where = {n: rng.choice("st") for n in names}
        batches = []
        for b in range(4):
            rows = []
            for n in rng.sample(names, 22):
                kind = rng.random()
                parent = "t3_p" if kind < 0.15 else None if kind < 0.2 else f"t1_{rng.choice(names)}"
                rows.append((where[n], n, parent))
            batches.append(rows)
        grown(spark, batches)


def test_late_parent_takes_over_its_orphans(spark):
    chain = [("s", f"k{i}", f"t1_k{i - 1}") for i in range(1, 300)]
    other = [("s", f"o{i}", "t3_p" if i == 0 else "t1_o0") for i in range(200)]
    forest, changes = grown(spark, [chain + other, [("s", "k0", "t1_o5"), ("s", "o7", "t1_o0")]])
    assert changes.count() == 300 and changes.agg(F.max("depth")).first()[0] == 301
    assert threads.forest_changes(forest, spark.createDataFrame(other, "subreddit string, id string, parent_id string")).count() == 0


def test_batches_that_close_and_open_cycles(spark):
    a = [("s", "a", "t1_b"), ("s", "c", "t1_a"), ("s", "d", "t1_c")]
    grown(spark, [a, [("s", "b", "t1_d")], [("s", "e", "t1_a")], [("s", "c", "t3_p"), ("s", "f", "t1_e")], [("s", "a", "t1_a")]])


# --- preview ---------------------------------------------------------------------------


def test_preview_lines(spark):
    df = spark.createDataFrame(
        [("a", "t3_p", "s", None, "first\nline", 10), ("b", "t1_a", "s", "bob", "y" * 71, 30),
         ("c", "t1_a", "s", "cy", "z" * 70, 20), ("d", "t3_p", "s", "dan", None, 5)], SCHEMA,
    )
    lines = [r.line for r in threads.thread_preview(df).orderBy("line_no").collect()]
    assert lines == ["- (dan) ", "- ([deleted]) first line", "  - (cy) " + "z" * 70, "  - (bob) " + "y" * 67 + "..."]


@pytest.mark.parametrize("n,last", [(39, 39), (40, 41), (60, 41)])
def test_preview_limit(spark, n, last):
    df = comments(spark, *[(f"c{i:02}", "t3_p") for i in range(n)])
    rows = threads.thread_preview(df).orderBy("line_no").collect()
    assert len(rows) == last and (rows[-1].line == "  ...") == (n >= 40)


# --- nested documents ----------------------------------------------------------------------


def nest(rows):
    """The documents built by plain recursion, roots and replies by (time, id)."""
    known = {r["id"] for r in rows}
    below: dict = {}
    roots = []
    for r in sorted(rows, key=lambda r: (r["created_epoch"], r["id"])):
        parent = (r["parent_id"] or "")[3:] if (r["parent_id"] or "").startswith("t1_") else None
        (below.setdefault(parent, []) if parent in known else roots).append(r)

    def build(r):
        return {**r, "replies": [build(k) for k in below.get(r["id"], [])]}

    return [build(r) for r in roots]


def tree_rows(spark):
    edges = [("a", "t3_p"), ("b", "t1_a"), ("c", "t1_b"), ("d", "t1_a"), ("e", "t1_missing"), ("f", "t1_e"), ("g", "t1_missing"),
             ("h", "t3_p"), ("i", "t1_c"), ("j", "t1_d"), ("x", "t1_y"), ("y", "t1_x")]
    return comments(spark, *edges).withColumn("created_epoch", 100 - F.col("created_epoch")).withColumn(
        "body", F.lit('say "hi"\n]}')
    )


def test_nested_documents(spark):
    df = tree_rows(spark)
    fields = ["id", "parent_id", "body", "created_epoch"]
    rows = threads.nested_fragments(df, fields).orderBy(*threads.NESTED_ORDER).collect()
    documents: dict = {}
    for r in rows:
        documents.setdefault(r.root_id, []).append(r.fragment)
    got = [json.loads("".join(parts)) for parts in documents.values()]
    plain = [r.asDict() for r in df.filter(~F.col("id").isin("x", "y")).select(*fields).collect()]
    assert got == nest(plain)


def test_order_of_a_deep_chain_takes_rows_of_one_size(spark):
    n = 20_000
    df = spark.sql(f"SELECT concat('k', id) id, CASE WHEN id = 0 THEN 't3_p' ELSE concat('t1_k', id - 1) END parent_id, id created_epoch FROM range({n})")
    rows = threads.preorder(df.withColumn("subreddit", F.lit("s")))
    assert all(f.dataType.simpleString() in ("string", "int", "bigint", "boolean") for f in rows.schema.fields)
    got = rows.selectExpr("count(*) n", "count_if(id <> concat('k', position) OR depth <> position) bad", "max(closes) closes").first()
    assert tuple(got) == (n, 0, n)


def test_nested_files_read_back_in_order(spark, tmp_path):
    write_nested(tree_rows(spark), str(tmp_path / "nested"))
    files = sorted((tmp_path / "nested" / "subreddit=s").glob("part-*"))
    text = "".join(line for f in files for line in f.read_text().splitlines())
    decoder, at, roots = json.JSONDecoder(), 0, []
    while at < len(text):
        document, at = decoder.raw_decode(text, at)
        roots.append(document["id"])
    assert roots == ["h", "g", "e", "a"]


# --- flatten --------------------------------------------------------------------------------


def flat(nodes):
    out = []
    for node in nodes:
        if isinstance(node, dict):
            rest = {k: v for k, v in node.items() if k != "replies"}
            below = node.get("replies")
            if not below:
                below = rest.pop("children", None)
            if node.get("id") or node.get("body") is not None:
                out.append(rest)
            below = below.get("data") if isinstance(below, dict) else below
            out += flat(below if isinstance(below, list) else [])
    return out


TREES = [
    {"data": [{"id": "a", "replies": [{"id": "b", "children": [{"body": ""}, 5, None, [1]]}]}]},
    [{"id": "c", "replies": {"data": [{"id": "d"}]}}, {"id": "e", "replies": "", "children": {"data": [{"id": "f"}]}}],
    {"data": {"children": [{"id": "no"}]}},
    [{"id": "g", "replies": {"data": {"children": [{"id": "no"}]}}}],
    [{"id": "h", "replies": [{"id": "i"}], "children": [{"id": "kept aside"}]}],
    [{"id": "j", "replies": {}, "children": [{"id": "0"}]}, {"id": 0}, {"id": "", "replies": [{"id": "l"}]}],
    [{"id": "m", "replies": "text", "children": [{"id": "no"}]}],
    5, "x", None, [],
]


def deep(n):
    node = {"id": f"n{n}"}
    for i in reversed(range(n)):
        node = {"id": f"n{i}", "replies": [node]}
    return [node]


def test_flatten(spark):
    cases = [*TREES, deep(40)]
    df = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(cases)] + [(99, "{")], "k int, tree string")
    got: dict = {}
    for r in flatten.flatten_replies(df, "tree", ["k"]).collect():
        got.setdefault(r.k, []).append(json.loads(r.raw))
    order = lambda rows: sorted(json.dumps(r, sort_keys=True) for r in rows)
    for i, t in enumerate(cases):
        start = t.get("data") if isinstance(t, dict) else t
        assert order(got.get(i, [])) == order(flat(start if isinstance(start, list) else [])), t
    assert 99 not in got


def test_nothing_in_nothing_out(spark):
    none = spark.createDataFrame([], SCHEMA)
    gone = comments(spark, ("a", "t3_p")).filter("id = 'zz'")
    for df in (none, gone):
        assert threads.resolve_forest(df).count() == 0
        assert threads.nested_fragments(df, ["id"]).count() == 0
        assert threads.thread_preview(df).count() == 0
        assert tuple(threads.sample_counts(df).first()) == (0, 0)
    trees = spark.createDataFrame([], "tree string")
    assert flatten.flatten_replies(trees, "tree").count() == 0


def test_replies_of_one_second_are_parted(spark, monkeypatch):
    """A third of all comments answer one comment within one second."""
    monkeypatch.setattr(threads, "SIBLINGS", 40)
    monkeypatch.setattr(threads, "PICKED", 30)
    rng = random.Random(6)
    rows = [("hot", "t3_p", 5)] + [(f"r{rng.randrange(10**9)}", "t1_hot", 9) for _ in range(400)]
    rows += [(f"x{i}", f"t1_{rows[rng.randrange(len(rows))][0]}", rng.randrange(3) * 30_000) for i in range(800)]
    df = spark.createDataFrame([(i, p, "s", "u", "x", e) for i, p, e in dict((r[0], r) for r in rows).values()], SCHEMA)
    epochs, kids = {i: e for i, _, e in rows}, {}
    for i, p, _ in rows:
        kids.setdefault(p[3:], []).append(i)
    order, stack = [], ["hot"]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += sorted(kids.get(node, []), key=lambda k: (epochs[k], k), reverse=True)
    got = {r.id: r.position for r in threads.preorder(df).collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda t: t[1])] == order


def test_whole_forest_works_its_comments_out_once(spark):
    rows = [("s", "a", "t3_p"), ("s", "b", "t1_a"), ("s", "c", "t1_b"), ("s", "o", "t1_gone"), ("s", "x", "t1_y"), ("s", "y", "t1_x")]
    seen = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame(rows, "subreddit string, id string, parent_id string")

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    forest = threads.whole_forest(df.mapInArrow(counted, df.schema))
    assert {(r.id, r.parent, r.depth, r.root_id) for r in forest.collect()} == {
        ("a", None, 0, "a"), ("b", "a", 1, "a"), ("c", "b", 2, "a"), ("o", "gone", 0, "o"), ("x", "y", None, None), ("y", "x", None, None),
    }
    assert seen.value == len(rows)
