"""A run cut into slices of time, and the ledger of who serves each slice.

Every walk (a subreddit and a kind, or the like) is asked for in slices of equal width. Sources are
asked in an order; one that fails a slice is passed over for the next, and a slice that all of them
fail stays open. A slice that is served may be empty: only a failure calls for another source. The
ledger keeps one row per slice, so a later run repeats the open slices and nothing else.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

SLICE = ["slice_start", "slice_end"]


def slices(walks: DataFrame, width: int) -> DataFrame:
    """The slices of ``walks`` (any key columns, ``after_epoch``, ``before_epoch``, ``backends``).

    Slices begin at multiples of ``width``, so that walks with other windows share them; the first
    and the last one are cut off at the window.
    """
    first, last = F.floor(F.col("after_epoch") / width), F.floor((F.col("before_epoch") - 1) / width)
    numbered = walks.filter("after_epoch < before_epoch").withColumn("slice", F.explode(F.sequence(first, last)))
    return numbered.withColumns(
        {
            "slice_start": F.greatest(F.col("slice") * width, "after_epoch").cast("bigint"),
            "slice_end": F.least((F.col("slice") + 1) * width, "before_epoch").cast("bigint"),
        }
    )


def assign(planned: DataFrame, failures: DataFrame | None, keys: list[str], width: int) -> DataFrame:
    """``planned`` slices with ``source``, the first of their ``backends`` that did not fail, and ``failed``.

    ``failures`` has the key columns, ``backend`` and the times ``from_epoch`` to ``to_epoch``
    (exclusive) that it could not serve; it fails every slice that it touches. ``source`` is null
    where a slice stays open.
    """
    if failures is None:
        return planned.withColumns({"failed": F.array().cast("array<string>"), "source": F.try_element_at("backends", F.lit(1))})
    first, last = F.floor(F.col("from_epoch") / width), F.floor((F.col("to_epoch") - 1) / width)
    touched = failures.filter("from_epoch < to_epoch").withColumn("slice", F.explode(F.sequence(first, last)))
    # Within a slice that a window cuts off, a failure outside the window does no harm.
    touched = touched.select(*keys, "slice", "backend", F.greatest(F.col("slice") * width, "from_epoch").alias("_from"),
                             F.least((F.col("slice") + 1) * width, "to_epoch").alias("_to"))
    touched = touched.groupBy(*keys, "slice", "backend").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))
    failed = touched.groupBy(*keys, "slice").agg(F.collect_list(F.struct("backend", "_from", "_to")).alias("_failed"))
    hit = F.filter("_failed", lambda f: (f["_from"] < F.col("slice_end")) & (f["_to"] > F.col("slice_start")))
    names = F.transform(hit, lambda f: f["backend"])
    met = planned.join(failed, [*keys, "slice"], "left").withColumn(
        "failed", F.coalesce(F.filter("backends", lambda b: F.array_contains(names, b)), F.array().cast("array<string>"))
    )
    return met.drop("_failed").withColumn("source", F.try_element_at(F.array_except("backends", "failed"), F.lit(1)))


def open_slices(planned: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """The planned slices that the ledger does not know as served."""
    served = ledger.filter("source IS NOT NULL").select(*keys, *SLICE)
    return planned.join(served, [*keys, *SLICE], "left_anti")


def take(sources: dict[str, DataFrame], assigned: DataFrame, keys: list[str], width: int, time: str = "created_epoch") -> DataFrame:
    """The records of every slice from the source that serves it, with ``source``.

    All sources have the same columns, the keys and a time among them. A slice has one row in the
    ledger, so the join neither multiplies records nor gathers those of a hot walk: it is the small
    side, and a shuffled one is split by slice.
    """
    rows = reduce(DataFrame.unionByName, [df.withColumn("source", F.lit(name)) for name, df in sources.items()])
    rows = rows.withColumn("slice", F.floor(F.col(time) / width))
    wanted = assigned.filter("source IS NOT NULL").select(*keys, "slice", "source", *SLICE)
    met = rows.join(wanted, [*keys, "slice", "source"])
    return met.filter((F.col(time) >= F.col("slice_start")) & (F.col(time) < F.col("slice_end"))).drop("slice", *SLICE)


def entries(assigned: DataFrame, taken: DataFrame, keys: list[str], width: int, time: str = "created_epoch") -> DataFrame:
    """Ledger rows: the slice, its ``source``, who ``failed`` it, and the records taken."""
    counts = taken.groupBy(*keys, F.floor(F.col(time) / width).alias("slice")).agg(F.count("*").alias("records"))
    return assigned.join(counts, [*keys, "slice"], "left").select(
        *keys, *SLICE, "source", "failed", F.coalesce("records", F.lit(0)).alias("records")
    )


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The ledger after a run: its rows replace those of the same slices."""
    return old.join(new.select(*keys, *SLICE), [*keys, *SLICE], "left_anti").unionByName(new)


def walk_progress(ledger: DataFrame, keys: list[str]) -> DataFrame:
    """Per walk: the time up to which all is served, whether that is the end, and the records taken."""
    opens = F.min(F.when(F.col("source").isNull(), F.col("slice_start")))
    return ledger.groupBy(*keys).agg(
        F.coalesce(opens, F.max("slice_end")).alias("cursor_epoch"),
        F.when(opens.isNull(), "complete").otherwise("in_progress").alias("status"),
        F.sum("records").alias("items_fetched"),
        F.count_if(F.col("source").isNull()).alias("open_slices"),
    )
