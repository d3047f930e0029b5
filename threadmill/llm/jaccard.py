"""Exact n-gram Jaccard join with prefix trees.

The set of a text holds its distinct word n-grams as 62-bit hashes. All sets are ordered by one
global order, frequent n-grams first, and form a tree in which sets share the path of their
common beginning. The tree is spread by its rare ends: two sets that reach the threshold share
one of their last ``n - ceil(t n) + 1`` members, so a set is stored under each of those
branches, and only sets of one branch can meet. In a branch

* sets meet the branch's first set; what links forms classes, so that a large group of near
  copies costs one comparison per member and branch at most, not one per pair;
* then sets of different classes meet if their sizes allow the threshold and they share as many
  of their rarest branches as it needs. Pairs inside a class need no look: their component is
  known.

Two sets that may meet are first compared by the parities of their members in buckets, about as
many as members: as many as differ, so many members at least are in one set only. Whole sets are made again from the
texts for those that remain.

A meeting is decided in a tree of the sets that meet one probe: sorted sets are walked depth
first, the overlap of a shared beginning is counted once, and a subtree is left when its
members that remain cannot reach the overlap that is needed.

Order: members found in at least one of FREQUENT sets come first, by falling count; the others
follow by hash. The counts come from all texts; any order gives the same links, they only keep
branches small. A text with fewer words than the n-gram has one member, its whole sequence; one
without words or null has none and links with nothing. Texts with equal sets are one node, so
copies and repeated rows cost nothing beyond their own row. Null ids take part but never name a
component. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm.common import Words, mix, text_steps, tidy
from threadmill.llm.components import components
from threadmill.session import collect_garbage, in_few_tasks, materialize

WIDTH = 5
#: Threshold as (numerator, denominator): overlap / union is at least 3 / 4.
SIMILARITY = (3, 4)
#: A member is frequent if one of so many sets holds it; so at most FREQUENT times the mean set size are.
FREQUENT = 1000
#: Members that are counted together before their counts leave a task.
COUNTED = 4_000_000
#: Parities kept of a set: the next power of two from its size, this many at least.
LEAST_BITS = 256
#: Pairs of whole sets that one task decides.
PAIRS_PER_TASK = 1_000
#: Ids that one task makes distinct.
IDS_PER_TASK = 200_000
#: Rows of a table of ids that may be broadcast, 16 bytes each; a longer one is joined by a shuffle.
BROADCAST_IDS = 1_000_000

_COLD = np.uint64(1 << 62)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def member_sets(words: Words, width: int = WIDTH) -> Iterator[np.ndarray]:
    """Of each text its sorted distinct n-grams."""
    h, first = words.hash(), words.first
    grams = np.zeros(0, np.uint64)
    if len(h) >= width:
        grams = h[: len(h) - width + 1]
        for j in range(1, width):
            grams = grams * _STEP + h[j : len(h) - width + 1 + j]
        grams = mix(grams) >> np.uint64(2)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            yield np.unique(grams[a : b - width + 1])
        elif b > a:
            one = np.full(1, b - a, np.uint64)
            for x in h[a:b]:
                one = one * _STEP + x
            yield mix(one) >> np.uint64(2)
        else:
            yield np.zeros(0, np.uint64)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for at, _, data, offsets in text_steps(batch.column(1)):
        yield from enumerate(member_sets(Words(data, offsets), width), at)


#: Where pairs across classes are more than FEW_PAIRS times the nodes in branches, each node of such
#: branches first meets PIVOTS nodes of one of them, in so many rounds at most.
PIVOT_ROUNDS, PIVOTS, FEW_PAIRS = 2, 8, 32


class Order:
    """The global order: numbers that grow from frequent members to rare ones."""

    def __init__(self, members: np.ndarray, counts: np.ndarray):
        by = np.lexsort((members, -counts))
        place = np.empty(len(members), np.uint64)
        place[by] = np.arange(len(members), dtype=np.uint64)
        at = np.argsort(members)
        self.members, self.places = members[at], place[at]

    def __call__(self, members: np.ndarray) -> np.ndarray:
        out = members + _COLD
        if len(self.members):
            at = np.minimum(np.searchsorted(self.members, members), len(self.members) - 1)
            out = np.where(self.members[at] == members, self.places[at], out)
        return np.sort(out).view(np.int64)


def frequent_order(docs: DataFrame, width: int = WIDTH) -> Order:
    """Counts over all texts; only members frequent in some part of them leave their task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            # In the sorted members those with ``least`` copies equal the one ``least - 1`` places on.
            least, texts = max(2, -(-len(held) // FREQUENT)), len(held)
            every = np.concatenate(held)
            held.clear()
            every.sort()
            far = max(len(every) - least + 1, 0)
            members = np.unique(every[:far][every[:far] == every[len(every) - far :]])
            n = np.searchsorted(every, members, "right") - np.searchsorted(every, members)
            columns = [np.append(members.view(np.int64), -1), np.append(n, texts)]
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["member", "n"])

        for batch in batches:
            for _, members in _sets(batch, width):
                if len(members):
                    held.append(members)
                    size += len(members)
                if size >= COUNTED:
                    yield out()
                    size = 0
        if held:
            yield out()

    counted = docs.select("doc_id", "text").mapInArrow(tidy(count), "member long, n long").groupBy("member").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "counts")
    total = counted.where("member = -1").select("n").collect()  # one row
    least = total[0]["n"] / FREQUENT if total else 0
    # At most FREQUENT times the mean set size.
    rows = counted.where((F.col("member") >= 0) & (F.col("n") >= least)).toArrow()
    return Order(rows["member"].to_numpy().view(np.uint64), rows["n"].to_numpy())


def needed(n: np.ndarray | int, m: np.ndarray | int) -> np.ndarray | int:
    """The least overlap of two sets of these sizes that reaches the threshold."""
    a, b = SIMILARITY
    return -(-a * (n + m) // (a + b))


def branch_members(n: int) -> int:
    """How many rare members a set is stored under."""
    a, b = SIMILARITY
    return n - -(-a * n // b) + 1


def _signatures(docs: DataFrame, order, width: int) -> DataFrame:
    """Of each text: doc_id, n, sig and parities of its set, and the members it is stored under, rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sigs, ends, ids, bits, bit_ends = [], [], [0], [], [], [0]
            for _, members in _sets(batch, width):
                n = len(members)
                sizes.append(n)
                if n:
                    keys = order.value(members)
                    sigs.append(xxhash.xxh3_128_digest(keys.tobytes()))
                    ids.append(keys[: -branch_members(n) - 1 : -1])
                    ends.append(ends[-1] + len(ids[-1]))
                    size = max(LEAST_BITS, 1 << (n - 1).bit_length())
                    odd = np.bincount((members & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
                    bits.append(np.packbits(odd.astype(bool)).view(np.int64))
                    bit_ends.append(bit_ends[-1] + size // 64)
                else:
                    sigs.append(None)
                    ends.append(ends[-1])
                    bit_ends.append(bit_ends[-1])
            members = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(members)),
                 pa.ListArray.from_arrays(pa.array(bit_ends, pa.int32()),
                                          pa.array(np.concatenate(bits) if bits else np.zeros(0, np.int64)))],
                ["doc_id", "n", "sig", "branches", "bits"],
            )

    return docs.select("doc_id", "text").mapInArrow(tidy(run), f"doc_id {_kind(docs)}, n long, sig binary, branches array<long>, bits array<long>")


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _whole_sets(docs: DataFrame, order, width: int) -> DataFrame:
    """Of each text: sig and the whole ordered set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, sets = [], []
            for _, members in _sets(batch, width):
                if len(members):
                    keys = order.value(members)
                    sigs.append(xxhash.xxh3_128_digest(keys.tobytes()))
                    sets.append(keys)
            ends = np.cumsum([0, *map(len, sets)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(sigs, pa.binary()), pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64)))],
                ["sig", "members"],
            )

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "sig binary, members array<long>")


def tree_links(probe: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Whether each ordered set reaches the threshold with ``probe``, by one walk of their tree.

    Sets are visited in tree order. ``shared[d]`` is the overlap of the path's first d members,
    so a set starts where it leaves the path before. Where the members that remain of the set
    or of the probe cannot make up what is missing, the path ends; sets of that subtree start
    at its end and are dismissed there by their own sizes.
    """
    linked = np.zeros(len(sets), bool)
    path = np.zeros(0, np.int64)
    shared = np.zeros(1, np.int64)
    for i in sorted(range(len(sets)), key=lambda k: sets[k].astype(">i8").tobytes()):
        own = sets[i]
        n = len(own)
        want = needed(len(probe), n)
        common = min(n, len(path))
        differ = np.flatnonzero(own[:common] != path[:common])
        at = int(differ[0]) if len(differ) else common
        walked, have = [shared[: at + 1]], int(shared[at])
        while at < n:
            rest = len(probe) - int(np.searchsorted(probe, own[at]))
            if have + min(n - at, rest) < want:
                break
            step = own[at : at + 128]
            place = np.minimum(np.searchsorted(probe, step), len(probe) - 1)
            walked.append(have + np.cumsum(probe[place] == step))
            have, at = int(walked[-1][-1]), at + len(step)
        shared, path = np.concatenate(walked), own[:at]
        linked[i] = at == n and have >= want
    return linked


def _possible(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose parities leave the threshold open, stored."""
    a, b = SIMILARITY
    one = rows.select(F.col("row").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    two = rows.select(F.col("row").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))

    def halved(bits: str) -> Column:
        # Parities of half as many buckets: those that fall together are added.
        half = (F.size(bits) / 2).cast("int")
        return F.zip_with(F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y))

    # Sizes that may reach the threshold differ by less than two.
    left = F.when(F.size("bits_a") > F.size("bits_b"), halved("bits_a")).otherwise(F.col("bits_a"))
    right = F.when(F.size("bits_b") > F.size("bits_a"), halved("bits_b")).otherwise(F.col("bits_b"))
    odd = F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(odd, F.lit(0), lambda total, x: total + x)
    open_ = (a + b) * apart <= (b - a) * (F.col("n_a") + F.col("n_b"))
    return materialize(pairs.join(one, "a").join(two, "b").where(open_).select("a", "b"), "pairs")


def _members(docs: DataFrame, order, width: int, pairs: DataFrame, n_pairs: int, nodes: DataFrame) -> DataFrame:
    """(node, members) of all nodes in ``pairs``, stored."""
    met = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    met = materialize(in_few_tasks(met, 2 * n_pairs, IDS_PER_TASK), "met")
    chosen = nodes.join(met, "node").select("node", "sig", "carrier")
    ids = chosen.select(F.col("carrier").alias("doc_id")).distinct()
    ids = _small(materialize(in_few_tasks(ids, 2 * n_pairs, IDS_PER_TASK), "carriers"))
    texts = docs.alias("d").join(ids.alias("i"), F.expr("d.doc_id <=> i.doc_id"), "left_semi")
    sets = _whole_sets(texts, order, width).join(chosen.select("sig", "node"), "sig").dropDuplicates(["node"])
    return materialize(sets.select("node", "members"), "members")


def _small(table: DataFrame) -> DataFrame:
    """Broadcast a stored table of one or two numbers a row if its rows are counted and few."""
    return F.broadcast(table) if table.count() <= BROADCAST_IDS else table


def _decide(docs: DataFrame, order, width: int, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that link."""
    n_pairs = pairs.count()
    sets = _members(docs, order, width, pairs, n_pairs, nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(k).to_numpy() for k in (0, 1))
            probes, others = batch.column(2), batch.column(3)

            def row(column: pa.ListArray, i: int) -> np.ndarray:
                lo, hi = column.offsets[i].as_py(), column.offsets[i + 1].as_py()
                return column.values.slice(lo, hi - lo).to_numpy()

            by = np.argsort(a, kind="stable")
            keep = np.zeros(len(a), bool)
            cuts = np.flatnonzero(np.diff(a[by])) + 1
            for group in np.split(by, cuts):
                if len(group):
                    keep[group] = tree_links(row(probes, group[0]), [row(others, i) for i in group])
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    one = sets.select(F.col("node").alias("a"), F.col("members").alias("probe"))
    two = sets.select(F.col("node").alias("b"), F.col("members").alias("other"))
    joined = pairs.join(two, "b").join(one, "a").select("a", "b", "probe", "other")
    joined = in_few_tasks(joined, n_pairs, PAIRS_PER_TASK)
    return joined.mapInArrow(tidy(run), "a long, b long")


def _mixed(branches: DataFrame, classes: DataFrame) -> tuple[DataFrame, int, DataFrame]:
    """The branches with nodes of more than one class, each node with its class; the pairs across classes;
    and the branches that hold many of these for their nodes."""
    kept = branches.join(_small(classes), "node", "left").select(
        "branch", "node", "n", "place", F.coalesce("root", "node").alias("class")
    )
    kept = materialize(kept, "classed")
    sizes = kept.groupBy("branch", "class").agg(F.count("*").cast("double").alias("of"))
    sizes = sizes.groupBy("branch").agg(F.count("*").alias("classes"), F.sum("of").alias("all"), F.sum(F.col("of") * F.col("of")).alias("same"))
    mixed = materialize(sizes.where("classes > 1").select("branch", F.col("all").alias("nodes"), ((F.col("all") * F.col("all") - F.col("same")) / 2).alias("across")), "mixed")
    crossing = mixed.agg(F.coalesce(F.sum("across"), F.lit(0.0))).first()[0]
    busy = mixed.where(f"across > {FEW_PAIRS} * nodes").select("branch")
    return kept.join(_small(mixed.select("branch")), "branch", "left_semi"), int(crossing), busy


def similarity_components(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least id it is linked with over any path)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    order = spark.sparkContext.broadcast(frequent_order(docs, width))
    rows = _signatures(docs, order, width).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "sets")

    # One node per distinct set. A node's number is that of one of its rows.
    nodes = rows.where("n > 0").groupBy("sig").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("label"), F.min_by("doc_id", "row").alias("carrier")
    )
    nodes = materialize(nodes, "nodes")
    # Few rows repeat a set, so leaving those out moves less than picking the others.
    again = rows.where("n > 0").select("row", "sig").join(nodes.select("sig", "node"), "sig")
    again = materialize(again.where("row <> node").select("row"), "again")
    stored = rows.where("n > 0").join(_small(again), "row", "left_anti").select(
        F.col("row").alias("node"), F.col("n").cast("int").alias("n"), F.posexplode("branches").alias("place", "branch")
    )
    w = Window.partitionBy("branch").orderBy("node")
    stored = stored.withColumns({"first": F.first("node").over(w), "first_n": F.first("n").over(w),
                                 "next": F.lead("node").over(w)})
    branches = materialize(
        stored.where("node <> first OR next IS NOT NULL").select("branch", "node", "n", "place", "first", "first_n"), "branches"
    )

    def may(n: str, m: str) -> str:
        return f"{b} * least({n}, {m}) >= {a} * greatest({n}, {m})"

    a, b = SIMILARITY
    stars = branches.where("node <> first AND " + may("n", "first_n"))
    stars = stars.select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    star_links = materialize(_decide(docs, order, width, _possible(stars, rows), nodes), "star_links")
    classes = materialize(components(star_links, "a", "b"), "classes")

    # Branches in which more than one class is left.
    kept, crossing, busy = _mixed(branches, classes)
    for turn in range(PIVOT_ROUNDS):
        if crossing <= FEW_PAIRS * kept.count():
            break
        # A large group of near copies is still in several classes: its largest class takes in most
        # of the others once their nodes have met more than the first node of a branch.
        collect_garbage(spark)
        crowd = kept.join(_small(busy), "branch", "left_semi")
        nodes_of = [F.min_by(F.struct("node", "n", "class"), F.xxhash64("node", F.lit(turn * PIVOTS + i))) for i in range(PIVOTS)]
        pivots = crowd.groupBy("branch").agg(F.array_distinct(F.array(*nodes_of)).alias("p"))
        ones = crowd.groupBy("node").agg(F.min_by(F.struct("branch", "n", "class"), F.xxhash64("branch")).alias("b"))
        tried = ones.select("node", "b.*").join(pivots, "branch").select("node", "n", "class", F.explode("p").alias("p"))
        tried = tried.where("class <> p.class AND " + may("n", "p.n"))
        tried = tried.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()
        found = _decide(docs, order, width, _possible(tried, rows), nodes)
        star_links = materialize(star_links.unionByName(found), "star_links")
        classes = materialize(components(star_links, "a", "b"), "classes")
        kept, crossing, busy = _mixed(branches, classes)
        collect_garbage(spark)
    p, q = kept.alias("p"), kept.alias("q")
    # Of an overlap of w members at most k - 1 lie behind the first n - w + k ones of the set that
    # ends first there, in the common order; so two sets that reach w share k branches among
    # those. k may be as large as the stored branches last; a quarter of that keeps the places
    # narrow and still leaves out texts that only share a passage.
    def overlap(n: str, m: str) -> str:
        return f"(({a} * ({n} + {m}) + {a + b - 1}) div {a + b})"

    def behind(n: str) -> str:
        return f"(({a} * {n} + {b - 1}) div {b} - 1)"

    def share(n: str, m: str) -> str:
        return f"(({overlap(n, m)} - greatest({behind(n)}, {behind(m)}) + 3) div 4)"

    w, k = overlap("p.n", "q.n"), share("p.n", "q.n")
    pairs = p.join(q, F.expr(
        "p.branch = q.branch AND p.class < q.class AND " + may("p.n", "q.n")
        + f" AND p.place < p.n - {w} + {k} AND q.place < q.n - {w} + {k}"
    ))
    pairs = pairs.groupBy(F.col("p.node").alias("a"), F.col("q.node").alias("b")).agg(
        F.count("*").alias("shared"), F.first("p.n").alias("n"), F.first("q.n").alias("m")
    )
    pairs = pairs.where(f"shared >= {share('n', 'm')}").select("a", "b")
    links = _decide(docs, order, width, _possible(pairs, rows), nodes).unionByName(star_links)
    roots = components(links, "a", "b")

    named = nodes.join(roots, "node", "left").select("sig", "label", F.coalesce("root", "node").alias("root"))
    named = materialize(named, "named")
    least = named.groupBy("root").agg(F.min("label").alias("component_id"))
    named = named.join(least, "root").select("sig", "component_id")
    out = rows.select("doc_id", "n", "sig").join(named, "sig", "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
