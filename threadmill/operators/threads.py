"""Comment threads from ``parent_id``: depth, root, order, preview, nested documents.

All of it rests on pointer doubling. Every comment starts with a pointer to its parent;
each round replaces the pointer by the pointer of the comment it leads to, so distances
double and a thread of depth d is done after about log2(d) rounds of one join each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..functions.text import parent_comment_id, preview_line
from ..schemas import PREVIEW_LINES, SAMPLE_COMMENTS
from ..session import fresh_dir, materialize
from .lookup import SMALL_LEFT, lookup_left

KEY = ["subreddit", "id"]
# The order of nested documents: roots by time, then a tree top down.
NESTED_ORDER = ["subreddit", "root_epoch", "root_id", "position"]
# Siblings of so many seconds are sorted together.
SIBLING_SPAN = 6 * 3600
# A span of one comment's replies is sorted as a whole up to so many; larger ones, of which no more
# than BUSY_SPANS are looked at, are parted by about PICKED of their keys.
SIBLINGS, BUSY_SPANS, PICKED = 200_000, 1_000, 1_000


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _order_key() -> Column:
    """Siblings and roots are ordered by time, with the id to settle ties."""
    return F.struct(F.coalesce("created_epoch", F.lit(0)).alias("epoch"), F.col("id").alias("id"))


FOREST = [*KEY, "parent", "depth", "root_id"]


def resolve_forest(comments: DataFrame) -> DataFrame:
    """``subreddit, id, depth, root_id`` of every comment.

    Top-level comments and orphans are roots with depth 0. A comment on or under a cycle
    keeps a null depth. ``comments`` must be unique on (subreddit, id).
    """
    return _double(_start(comments))


def _start(comments: DataFrame) -> DataFrame:
    anc = parent_comment_id(F.col("parent_id"))
    return comments.select(
        *KEY,
        anc.alias("anc"),
        F.when(anc.isNull(), 0).otherwise(1).alias("dist"),
        F.col("id").alias("top"),
    )


def _double(state: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``subreddit, id, depth, root_id`` by pointer doubling, with the columns ``keep`` passed through.

    In the state ``anc`` is the ancestor ``dist`` hops up that is still to be looked up, and
    ``top`` the last one known below it; once ``anc`` is null, ``top`` is the root and ``dist``
    the depth. An ancestor that is not in the state makes ``top`` a root, one hop nearer. A row
    has the same few values whatever the depth.
    """
    spark = state.sparkSession
    folder = fresh_dir(spark, "forest")
    pending = Observation()
    open_rows = F.count_if(F.col("anc").isNotNull()).alias("n")
    state = materialize(state, "round=0", folder, pending, open_rows)
    done = [state.filter(F.col("anc").isNull())]
    active, n_active = state.filter(F.col("anc").isNotNull()), pending.get["n"]

    round_no = 0
    while n_active:
        round_no += 1
        seen = _union([*done, active]).selectExpr(*KEY, "anc AS up_anc", "dist AS up_dist", "top AS up_top")
        values = ["up_anc", "up_dist", "up_top"]
        met = lookup_left(active, seen, ["subreddit", "anc"], KEY, values, left_rows=n_active)
        found = "up_dist IS NOT NULL"
        moved = met.selectExpr(
            *KEY, *keep,
            "up_anc AS anc",
            # An ancestor that is not there makes the comment just under it a root.
            f"CASE WHEN {found} THEN dist + up_dist ELSE dist - 1 END AS dist",
            f"CASE WHEN {found} THEN up_top ELSE top END AS top",
        )
        pending = Observation()
        moved = materialize(
            moved, f"round={round_no}", folder, pending, open_rows, small=n_active <= SMALL_LEFT
        )
        n_left = pending.get["n"]
        done.append(moved.filter(F.col("anc").isNull()))
        active = moved.filter(F.col("anc").isNotNull())
        if n_left == n_active:
            # A round without news: what is left never reaches a root.
            break
        n_active = n_left

    rooted = _union(done).select(*KEY, *keep, F.col("dist").alias("depth"), F.col("top").alias("root_id"))
    if not n_active:
        return rooted
    stuck = active.select(
        *KEY, *keep, F.lit(None).cast("int").alias("depth"), F.lit(None).cast("string").alias("root_id")
    )
    return rooted.unionByName(stuck)


def whole_forest(comments: DataFrame) -> DataFrame:
    """The forest of all comments in the form that :func:`forest_changes` goes on from.

    Parents go along with the pointers, so ``comments`` is worked out once and met by no join.
    """
    state = _start(comments)
    return _double(state.withColumn("parent", F.col("anc")), keep=("parent",)).select(*FOREST)


def forest_changes(forest: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of ``forest`` (``FOREST`` columns) that the comments of a batch add or change.

    ``batch`` has ``subreddit, id, parent_id``, unique on the key. A late parent takes over the
    trees of its orphans as they are: their comments go down by its depth and get its root, found
    by one join on the root. Only a comment whose own parent has changed has its old tree put
    together again. Comments that stay as they are give no row, and pointers are doubled over
    new comments and taken-over roots alone, however large the forest is.
    """
    links = batch.select(*KEY, parent_comment_id(F.col("parent_id")).alias("parent"))
    old = forest.select(*KEY, F.col("parent").alias("had"), F.col("root_id").alias("was_under"), F.lit(True).alias("known"))
    # The batch is the small side; how it meets the forest is left to Spark.
    news = links.join(old, KEY, "left").filter(F.col("known").isNull() | ~F.col("parent").eqNullSafe(F.col("had")))
    news = materialize(news, "news")
    changed = news.filter("known")
    trees = changed.filter("was_under IS NOT NULL").select("subreddit", F.col("was_under").alias("root_id")).distinct()
    some_changed = not changed.isEmpty()
    keys = news.select(*KEY)
    loose = forest.limit(0).select(*KEY, "parent")
    kept = forest
    if some_changed:
        # Trees with a changed comment, and all that hangs on cycles, are taken apart.
        apart = forest.join(trees, ["subreddit", "root_id"], "left_semi").select(*FOREST)
        apart = apart.unionByName(forest.filter("depth IS NULL").select(*FOREST))
        loose = apart.join(keys, KEY, "left_anti").select(*KEY, "parent")
        kept = forest.filter("depth IS NOT NULL").join(trees, ["subreddit", "root_id"], "left_anti")
    else:
        stuck = forest.filter("depth IS NULL")
        if not news.isEmpty() and not stuck.isEmpty():
            loose = stuck.select(*KEY, "parent")
            kept = forest.filter("depth IS NOT NULL")
    nodes = materialize(news.select(*KEY, "parent").unionByName(loose), "loose")
    if nodes.isEmpty():
        return forest.limit(0).select(*FOREST)

    # Orphans whose parent has come.
    own = nodes.select("subreddit", F.col("id").alias("parent"))
    taken = kept.filter("depth = 0 AND parent IS NOT NULL").join(own, ["subreddit", "parent"], "left_semi")
    taken = materialize(taken.select(*KEY, "parent"), "taken")
    # A parent that stays where it is hands on its own root and depth; a root that has been
    # taken over is one more hop.
    wanted = nodes.filter("parent IS NOT NULL").select("subreddit", F.col("parent").alias("id")).distinct()
    above = kept.join(wanted, KEY, "left_semi").select(
        "subreddit", F.col("id").alias("parent"), F.col("depth").alias("up"), F.col("root_id").alias("over")
    )
    gone = taken.select("subreddit", F.col("id").alias("over"), F.lit(True).alias("moves"))
    above = materialize(above.join(gone, ["subreddit", "over"], "left"), "above")
    met = nodes.join(above, ["subreddit", "parent"], "left")
    state = met.select(
        *KEY,
        F.when(F.col("up").isNull(), F.col("parent")).when(F.col("moves"), F.col("over")).alias("anc"),
        F.when(F.col("parent").isNull(), 0).otherwise(1 + F.coalesce("up", F.lit(0))).alias("dist"),
        F.when(F.col("up").isNull() | F.col("moves"), F.col("id")).otherwise(F.col("over")).alias("top"),
    )
    state = state.unionByName(
        taken.select(*KEY, F.col("parent").alias("anc"), F.lit(1).alias("dist"), F.col("id").alias("top"))
    )
    found = materialize(_double(state), "found")
    placed = nodes.join(found, KEY).select(*FOREST)
    roots = found.join(taken.select(*KEY), KEY, "left_semi")
    roots = roots.select("subreddit", F.col("id").alias("root_id"), F.col("depth").alias("down"), F.col("root_id").alias("to"))
    moved = kept.join(roots, ["subreddit", "root_id"]).select(
        *KEY, "parent", (F.col("depth") + F.col("down")).alias("depth"), F.col("to").alias("root_id")
    )
    return placed.unionByName(moved)


def with_changes(forest: DataFrame, changes: DataFrame) -> DataFrame:
    """The forest after :func:`forest_changes`."""
    return forest.join(changes.select(*KEY), KEY, "left_anti").select(*FOREST).unionByName(changes.select(*FOREST))


def preorder(comments: DataFrame) -> DataFrame:
    """Where each comment stands when its tree is read top down, replies by (time, id).

    ``subreddit, id, depth, root_id, root_epoch, position`` (0 is the root), ``closes`` (how
    many levels end behind the comment), ``has_replies`` and ``after_sibling``. Comments on or
    under a cycle have no place and are left out.

    The comment that follows another is its first reply; else its next sibling; else the next
    sibling of the nearest ancestor that has one. Finding that ancestor is a forest in which
    links stop at comments with a next sibling, and the position is the depth in the chain of
    followers: both are :func:`resolve_forest` again, with rows of constant size.
    """
    spark = comments.sparkSession
    placed = resolve_forest(comments).filter(F.col("depth").isNotNull())
    links = comments.select(*KEY, parent_comment_id(F.col("parent_id")).alias("parent"), _order_key().alias("key"))
    nodes = links.join(placed, KEY).withColumns(
        {
            "parent": F.when(F.col("depth") > 0, F.col("parent")),
            "span": F.floor(F.col("key.epoch") / SIBLING_SPAN).cast("bigint"),
        }
    )
    nodes = materialize(nodes, "nodes")
    replies = nodes.filter(F.col("parent").isNotNull())
    family = ["subreddit", "parent"]
    # Siblings are numbered within spans of time, and spans among themselves, so that no task
    # sorts all replies of one comment. A span that holds very many is parted by some of its keys.
    spans = replies.groupBy(*family, "span").agg(F.min("key").alias("first_key"), F.count("*").alias("n"))
    busy = spans.filter(F.col("n") > SIBLINGS).select(*family, F.col("span").alias("full"), "n")
    busy = materialize(busy.orderBy(F.desc("n")).limit(BUSY_SPANS), "busy", small=True)
    replies = replies.withColumn("part", F.lit(0))
    if not busy.isEmpty():
        picked = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / PICKED)) == 0
        met = [replies[c] == busy[c] for c in family] + [F.col("span") == F.col("full")]
        keys = replies.join(F.broadcast(busy), reduce(lambda a, b: a & b, met)).filter(picked)
        keys = keys.groupBy(replies["subreddit"].alias("in"), replies["parent"].alias("of"), "full").agg(
            F.array_sort(F.collect_list("key")).alias("keys"), F.first("n").alias("n")
        )
        # Every so many of the picked keys begins a part of about SIBLINGS replies.
        step = F.greatest(F.ceil(F.size("keys") * SIBLINGS / F.col("n")), F.lit(1)).cast("int")
        borders = F.filter(F.col("keys"), lambda k, i: i % step == 0)
        keys = materialize(keys.select("in", "of", "full", borders.alias("borders")), "borders", small=True)
        there = (F.col("subreddit") == F.col("in")) & (F.col("parent") == F.col("of")) & (F.col("span") == F.col("full"))
        passed = F.size(F.filter("borders", lambda b: b <= F.col("key")))
        replies = replies.join(F.broadcast(keys), there, "left").withColumn(
            "part", F.when(F.col("borders").isNull(), 0).otherwise(passed)
        ).drop("in", "of", "full", "borders")
        spans = replies.groupBy(*family, "span", "part").agg(F.min("key").alias("first_key"))
    else:
        spans = spans.withColumn("part", F.lit(0))
    later = F.lead("first_key").over(Window.partitionBy(*family).orderBy("span", "part"))
    spans = spans.select(*family, "span", "part", later.alias("later_key"))
    after = F.lead("key").over(Window.partitionBy(*family, "span", "part").orderBy("key"))
    nexts = (
        replies.join(spans, [*family, "span", "part"])
        .withColumn("next", F.coalesce(after, F.col("later_key"))["id"])
        .select(*KEY, "next")
    )
    firsts = replies.groupBy(*family).agg(F.min("key")["id"].alias("first_child"))
    firsts = firsts.select("subreddit", F.col("parent").alias("id"), "first_child")
    nodes = materialize(
        nodes.join(nexts, KEY, "left").join(firsts, KEY, "left").select(
            *KEY, "parent", "depth", "root_id", "next", "first_child", F.col("key.epoch").alias("epoch")
        ),
        "siblings",
    )
    climb = F.when(F.col("next").isNull(), F.concat(F.lit("t1_"), F.col("parent")))
    stops = resolve_forest(nodes.select(*KEY, climb.alias("parent_id"))).select(*KEY, F.col("root_id").alias("stop"))
    there = nodes.select(
        *KEY, F.col("next").alias("stop_next"), F.col("depth").alias("stop_depth"), F.lit(True).alias("is_stop")
    )
    known = nodes.join(stops, KEY)
    known = lookup_left(known, there, ["subreddit", "stop"], KEY, ["stop_next", "stop_depth"])
    known = materialize(known.withColumn("follower", F.coalesce("first_child", "stop_next")), "followers")
    before = known.filter(F.col("follower").isNotNull()).select(
        "subreddit", F.col("follower").alias("id"), F.concat(F.lit("t1_"), F.col("id")).alias("parent_id")
    )
    chain = known.select(*KEY).join(before, KEY, "left")
    positions = resolve_forest(chain).select(*KEY, F.col("depth").alias("position"))
    heads = known.filter(F.col("depth") == 0).select(*KEY, F.col("epoch").alias("root_epoch"))
    first_of = known.filter(F.col("first_child").isNotNull()).select(
        "subreddit", F.col("first_child").alias("id"), F.lit(True).alias("leads")
    )
    out = known.join(positions, KEY).join(first_of, KEY, "left")
    out = lookup_left(out, heads, ["subreddit", "root_id"], KEY, ["root_epoch"])
    up = F.when(F.col("stop_next").isNull(), F.col("depth")).otherwise(F.col("depth") - F.col("stop_depth"))
    return out.select(
        *KEY, "depth", "root_id", "root_epoch", "position",
        F.when(F.col("first_child").isNotNull(), 0).otherwise(up + 1).cast("int").alias("closes"),
        F.col("first_child").isNotNull().alias("has_replies"),
        ((F.col("depth") > 0) & F.col("leads").isNull()).alias("after_sibling"),
    )


def with_depth(comments: DataFrame, forest: DataFrame | None = None) -> DataFrame:
    """The comments with ``depth`` filled in (null only on or under a cycle)."""
    found = resolve_forest(comments) if forest is None else forest
    columns = comments.columns if "depth" in comments.columns else [*comments.columns, "depth"]
    return comments.drop("depth").join(found.select(*KEY, "depth"), KEY, "left").select(*columns)


def thread_roots(forest: DataFrame) -> DataFrame:
    """Per root: comments in its tree and deepest level."""
    return (
        forest.filter(F.col("root_id").isNotNull())
        .groupBy("subreddit", "root_id")
        .agg(F.count("*").alias("comments"), F.max("depth").alias("max_depth"))
    )


def orphans(comments: DataFrame) -> DataFrame:
    """Replies whose parent comment is not in the archive."""
    replies = comments.withColumn("_parent", parent_comment_id(F.col("parent_id"))).filter(
        F.col("_parent").isNotNull()
    )
    known = comments.select("subreddit", F.col("id").alias("_parent"))
    return replies.join(known, ["subreddit", "_parent"], "left_anti").drop("_parent")


def child_edges(comments: DataFrame) -> DataFrame:
    """Parent -> child pairs, laid out by parent and sibling order.

    Kept as rows, since a list per parent would put all replies of a huge thread in one row.
    """
    edges = comments.select(
        "subreddit",
        parent_comment_id(F.col("parent_id")).alias("parent"),
        F.coalesce("created_epoch", F.lit(0)).alias("epoch"),
        F.col("id").alias("child"),
    ).filter(F.col("parent").isNotNull())
    order = ["subreddit", "parent", "epoch", "child"]
    return edges.repartitionByRange(*order).sortWithinPartitions(*order)


def children_summary(comments: DataFrame) -> DataFrame:
    """Per parent comment: number of replies, first and last reply."""
    parent = parent_comment_id(F.col("parent_id"))
    return (
        comments.withColumn("parent", parent)
        .filter(F.col("parent").isNotNull())
        .groupBy("subreddit", "parent")
        .agg(
            F.count("*").alias("children"),
            F.min(_order_key())["id"].alias("first_child"),
            F.max(_order_key())["id"].alias("last_child"),
        )
    )


def thread_preview(comments: DataFrame, max_lines: int = PREVIEW_LINES) -> DataFrame:
    """``line_no, line``: the first lines of all threads, indented by depth.

    Read from the top: the first roots, found by one anti join, then their replies level by level.
    A comment stands behind all that are known to come before it, so after each level only the
    first ``max_lines`` known ones matter; no thread is put together as a whole. A last line of dots
    tells that the limit was hit.
    """
    place = F.struct(F.coalesce("created_epoch", F.lit(0)).alias("epoch"), "id", "subreddit")
    links = comments.select(
        *KEY, parent_comment_id(F.col("parent_id")).alias("parent"), place.alias("place"), "author", "body"
    )
    known = comments.select("subreddit", F.col("id").alias("parent"))
    tops = links.filter("parent IS NULL").unionByName(
        links.filter("parent IS NOT NULL").join(known, ["subreddit", "parent"], "left_anti")
    )

    def first(rows: DataFrame) -> DataFrame:
        return materialize(rows.orderBy("path").limit(max_lines), "preview", small=True)

    shown = first(tops.select(*KEY, F.array("place").alias("path"), F.lit(0).alias("depth"), "author", "body"))
    level = 0
    while True:
        above = shown.filter(F.col("depth") == level).select("subreddit", F.col("id").alias("parent"), "path")
        # At most max_lines rows are above.
        below = links.join(F.broadcast(above), ["subreddit", "parent"]).select(
            *KEY, F.array_append("path", F.col("place")).alias("path"), F.lit(level + 1).alias("depth"), "author", "body"
        )
        shown, level = first(shown.unionByName(below)), level + 1
        if shown.filter(F.col("depth") == level).isEmpty():
            break
    lines = shown.select(
        # At most max_lines rows reach this window.
        F.row_number().over(Window.orderBy("path")).alias("line_no"),
        preview_line(F.col("depth"), F.col("author"), F.col("body")).alias("line"),
    )
    dots = lines.agg(F.count("*").alias("n")).filter(F.col("n") >= max_lines).select(
        F.lit(max_lines + 1).alias("line_no"), F.lit("  ...").alias("line")
    )
    return lines.unionByName(dots).orderBy("line_no")


def sample_counts(comments: DataFrame, limit: int = SAMPLE_COMMENTS) -> DataFrame:
    """One row: comments in the sample of the earliest ones, and how many of them are roots
    there. A comment whose parent is not in the sample counts as a root."""
    sample = comments.orderBy(_order_key()).limit(limit).select(*KEY, "parent_id")
    # The sample is small by its limit, so it may be computed twice and broadcast freely.
    parents = sample.select("subreddit", F.col("id").alias("parent"), F.lit(True).alias("known"))
    return (
        sample.withColumn("parent", parent_comment_id(F.col("parent_id")))
        .join(parents, ["subreddit", "parent"], "left")
        .agg(F.count("*").alias("comments"), F.count_if(F.col("known").isNull()).alias("roots"))
    )


def nested_fragments(comments: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nested thread documents, cut into one text fragment per comment.

    Written in the order of ``NESTED_ORDER``, the fragments of a root concatenate to one JSON
    document with its replies, sorted by time, nested under ``replies``. A document is never
    assembled in one row, because one thread may be as large as a third of the archive.
    Comments on or under a cycle belong to no document and are left out.
    """
    fields = columns or [c for c in comments.columns if c != "raw"]
    own = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    fragment = F.concat(
        F.when(F.col("after_sibling"), F.lit(",")).otherwise(F.lit("")),
        F.expr("left(own, length(own) - 1)"),
        F.lit(',"replies":['),
        F.repeat(F.lit("]}"), F.col("closes")),
    )
    return (
        preorder(comments)
        .join(comments.select(*KEY, own.alias("own")), KEY)
        .select(*NESTED_ORDER, "id", "depth", "closes", "after_sibling", fragment.alias("fragment"))
    )
