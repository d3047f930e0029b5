"""Importance resampling towards a target distribution, by scores and a threshold found by bisection.

Features are runs of words; each falls into a hashed bucket. How much commoner a bucket is among
the target texts than among all documents is its gain, an array the tasks share; a document's
weight is the sum over its features. A hash of its id turns the weight into a score whose greatest
values are a draw without replacement. Scores are stored once, narrow; the cutoff is found by
repeated exact counts over them, first of scores, then of the ids tied at the cutoff, and the
rows above it are dealt by range to be numbered. No sort of all rows, no approximation.

Null text counts as empty: no features, weight 0. A null id is hashed as an empty one and comes
after all others among equal scores; rows with the same id and score are drawn by weight, then
number of features. Repeated rows are rows of their own. Empty tables give empty results; an empty
target leaves its share to smoothing. Other columns take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import scored, text_steps, tidy
from threadmill.llm.terms import Terms, crc32
from threadmill.session import materialize

#: Thresholds that one counting job tries.
WAYS = 16
#: Drawn rows of a range that are numbered together, on average.
ROWS_PER_RANGE = 100_000


def _features(data: np.ndarray, offsets: np.ndarray, run: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every feature."""
    terms = Terms(data, offsets)
    start, end, owner = terms.runs(run)
    return crc32(terms.data, start, end) % np.uint32(buckets), owner


def bucket_counts(texts: DataFrame, text: str, run: int, buckets: int) -> np.ndarray:
    """Features per bucket over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_steps(batch.column(0)):
                total += np.bincount(_features(data, offsets, run, buckets)[0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    found = texts.select(F.col(text).alias("text")).mapInArrow(tidy(count), "bucket long, n long")
    got = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # one row a bucket at most
    out = np.zeros(buckets, np.int64)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier each bucket is in the target; both sides smoothed by one."""
    buckets = len(source)
    s, t = int(source.sum()) + buckets, int(target.sum()) + buckets
    ratio = (target + 1).astype(float) * s / ((source + 1).astype(float) * t)
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def weighed(docs: DataFrame, text: str, array: np.ndarray, run: int) -> DataFrame:
    """``docs`` with n_features and weight."""
    shared = docs.sparkSession.sparkContext.broadcast(array)  # one number a bucket

    def pick(gain: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        bucket, owner = _features(data, offsets, run, len(gain))
        n = len(offsets) - 1
        # Whole numbers of this size add up exactly in doubles.
        weight = np.bincount(owner, gain[bucket], minlength=n).astype(np.int64)
        return [pa.array(np.bincount(owner, minlength=n)), pa.array(weight)]

    got = scored(F.col(text), shared, "n_features long, weight long", pick)
    return docs.withColumn("_w", got).select(*docs.columns, "_w.n_features", "_w.weight")


def perturbation(id_: str, seed: str) -> Column:
    """floor(1000 x) of a Gumbel variate x that the id decides."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _least(rows: DataFrame, column: str, low: int, high: int, wanted: int) -> int:
    """The least x in low..high with at least ``wanted`` rows whose value is at most x; there must be one.

    Each job counts exactly below several thresholds at once and cuts the interval by WAYS + 1.
    """
    while low < high:
        cuts = sorted({low + (high - low) * k // (WAYS + 1) for k in range(1, WAYS + 1)} | {(low + high) // 2})
        counted = rows.agg(*[F.count_if(F.col(column) <= c).alias(f"n{i}") for i, c in enumerate(cuts)]).first()
        for c, n in zip(cuts, counted):
            if n >= wanted:
                high = c
                break
            low = c + 1
    return low


def cutoff(rows: DataFrame, wanted: int) -> Column:
    """Which rows (doc_id, score) hold the ``wanted`` greatest scores, ties to smaller ids.

    More rows than wanted pass only where score and id are both equal at the cutoff.
    """
    ends = rows.agg(F.min("score").alias("low"), F.max("score").alias("high"), F.count("*").alias("n")).first()
    if wanted <= 0 or not ends["n"]:
        return F.lit(False)
    if wanted >= ends["n"]:
        return F.lit(True)
    # The greatest score counts least: the bisection runs over the negative scores.
    turned = rows.select((-F.col("score")).alias("x"), "doc_id")
    at = -_least(turned, "x", -ends["high"], -ends["low"], wanted)
    tied = rows.where(F.col("score") == at)
    inside = rows.agg(
        F.count_if(F.col("score") > at).alias("above"), F.min(F.when(F.col("score") == at, F.col("doc_id"))).alias("low"),
        F.max(F.when(F.col("score") == at, F.col("doc_id"))).alias("high"),
        F.count(F.when(F.col("score") == at, F.col("doc_id"))).alias("n"),
    ).first()
    above, missing = F.col("score") > at, wanted - inside["above"]
    if missing > inside["n"]:
        return above | (F.col("score") == at)  # rows without an id come last and are cut when numbered
    last = _least(tied.where("doc_id IS NOT NULL"), "doc_id", inside["low"], inside["high"], missing)
    return above | ((F.col("score") == at) & F.coalesce(F.col("doc_id") <= last, F.lit(False)))


def resample(
    docs: DataFrame, target: DataFrame, percent: int, id_: str = "doc_id", text: str = "text", run: int = 1,
    buckets: int = 10_000, least_features: int = 20, seed: str = "2024",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of all rows; rank is null where a row is not drawn.

    Drawn are ``percent`` of a hundred of the rows with ``least_features`` features, those of the
    greatest scores. ``id_`` holds whole numbers.
    """
    gain = gains(bucket_counts(docs, text, run, buckets), bucket_counts(target, text, run, buckets))
    plain = docs.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = weighed(plain, "text", gain, run).drop("text")
    rows = materialize(rows.withColumn("score", F.col("weight") + perturbation("doc_id", seed)), "scores")
    able = F.col("n_features") >= least_features
    eligible = rows.where(able)
    wanted = percent * eligible.count() // 100
    drawn = able & cutoff(eligible.select("score", "doc_id"), wanted)
    # Range partitions hold the drawn rows in order, so a row's place is its partition's start plus its own place.
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features")]
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-wanted // ROWS_PER_RANGE))
    placed = rows.where(drawn).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # This number counts rows within a partition below 2**33 and partitions above it.
    placed = materialize(placed.withColumn("_at", F.monotonically_increasing_id()), "drawn")
    part = F.shiftright("_at", 33)
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    first, starts = 0, []
    for p in sorted(sizes):
        starts.append((p, first))
        first += sizes[p]
    begin = docs.sparkSession.createDataFrame(pa.table({  # one row a partition
        "_part": pa.array([p for p, _ in starts], pa.int64()), "_first": pa.array([f for _, f in starts], pa.int64()),
    }))
    rank = F.col("_first") + F.col("_at") - F.shiftleft("_part", 33) + 1
    ranked = placed.join(F.broadcast(begin), part == F.col("_part")).withColumn("rank", F.when(rank <= wanted, rank))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    rest = rows.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return rest.select(columns).unionByName(ranked.select(columns))
