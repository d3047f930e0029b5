"""Walk progress per subreddit, source and kind: summary, resume, fallback, page cursors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.times import epoch_seconds, minute_label
from ..session import materialize
from .flatten import envelope_items, odd_items, read_pages

WALK = ["subreddit", "backend", "kind"]
WINDOW = ["window_start_epoch", "window_end_epoch"]


def checkpoint_summary(
    records: DataFrame, backend: str, after: int, before: int, walks: DataFrame | None = None,
    finished: bool = False,
) -> DataFrame:
    """Progress rows of one run: last time reached and records written per walk.

    ``records`` needs ``subreddit``, ``kind``, ``created_epoch``. Records sent twice count
    twice, as they were written twice. ``walks`` (``subreddit, kind``) are those that were
    asked for: one without records gets a row as well, drained and complete with 0 items.
    ``finished`` says that the run read its window to the end, which completes every walk;
    else a walk with records is in progress, since its last record lies before the end.
    """
    found = records.groupBy("subreddit", "kind").agg(
        F.max("created_epoch").alias("cursor_epoch"), F.count("*").alias("items_fetched")
    )
    if walks is not None:
        found = walks.select("subreddit", "kind").distinct().join(found, ["subreddit", "kind"], "left")
    done = F.lit(finished) | F.col("items_fetched").isNull() | (F.col("cursor_epoch") >= before)
    return (
        found.withColumn("_done", done)
        .select(
            "subreddit", F.lit(backend).alias("backend"), "kind",
            F.lit(after).cast("bigint").alias("window_start_epoch"),
            F.lit(before).cast("bigint").alias("window_end_epoch"),
            F.when(F.col("_done"), F.lit(before)).otherwise(F.col("cursor_epoch")).cast("bigint").alias("cursor_epoch"),
            F.when(F.col("_done"), F.lit("complete")).otherwise(F.lit("in_progress")).alias("status"),
            F.coalesce("items_fetched", F.lit(0)).cast("bigint").alias("items_fetched"),
        )
    )


def fraction_done(cursor: Column, after: Column, before: Column) -> Column:
    """Share of the window walked so far, within 0..1."""
    span = F.greatest(F.lit(1), before - after)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (cursor - after) / span))


def progress_view(progress: DataFrame, elapsed_seconds: Column | float) -> DataFrame:
    """Fraction done, time reached, and seconds left once more than 1 % is done."""
    done = fraction_done(
        F.col("cursor_epoch"), F.col("window_start_epoch"), F.col("window_end_epoch")
    )
    elapsed = elapsed_seconds if isinstance(elapsed_seconds, Column) else F.lit(elapsed_seconds)
    return progress.withColumns(
        {
            "fraction": done,
            "reached": minute_label(F.col("cursor_epoch")),
            "eta_seconds": F.when(done > 0.01, elapsed * (1 - done) / done),
        }
    )


def remaining(records: DataFrame, progress: DataFrame, backend: str, after: int, before: int) -> DataFrame:
    """Records still to process: not of complete walks, and from the cursor of open ones.

    Progress of another window is not progress here, so a changed window is walked anew.
    """
    mine = progress.filter(
        (F.col("backend") == backend)
        & (F.col("window_start_epoch") == after)
        & (F.col("window_end_epoch") == before)
    )
    keys = ["subreddit", "kind"]
    # One join for both questions: Spark broadcasts the walks if they are few, and may split
    # the records of a hot walk if not.
    walks = mine.select(
        *keys, F.col("status").alias("_status"), F.col("cursor_epoch").alias("_cursor")
    )
    start = F.coalesce(F.when(F.col("_cursor") != 0, F.col("_cursor")), F.lit(after))
    return (
        records.filter((F.col("created_epoch") >= after) & (F.col("created_epoch") < before))
        .join(walks, keys, "left")
        .filter(F.coalesce(F.col("_status") != "complete", F.lit(True)))
        .filter(F.col("created_epoch") >= start)
        .drop("_status", "_cursor")
    )


def serve_with_fallback(sources: list[DataFrame], slice_of: list[Column]) -> DataFrame:
    """Each slice from the first source that has it, later sources filling the gaps.

    Slices (such as subreddit, kind, day) are few beside the records. The first source of a
    slice is the least number among the sources that have it, found with map-side reduction;
    one join then picks the rows. n sources are scanned 2n - 1 times: what the last one has
    needs no look, since a slice without an earlier source is its own.
    """
    names, last = [f"_slice{i}" for i in range(len(slice_of))], len(sources) - 1
    numbered = [
        df.withColumns({**dict(zip(names, slice_of)), "_source": F.lit(i)})
        for i, df in enumerate(sources)
    ]
    rows = reduce(DataFrame.unionByName, numbered)
    if not last:
        return rows.drop(*names, "_source")
    earlier = reduce(DataFrame.unionByName, [df.select(*names, "_source") for df in numbered[:-1]])
    first = earlier.groupBy(*names).agg(F.min("_source").alias("_first"))
    same = reduce(lambda a, b: a & b, [rows[n].eqNullSafe(first[n]) for n in names])
    served = rows.join(first, same, "left").filter(F.col("_source") == F.coalesce("_first", F.lit(last)))
    return served.select(*sources[0].columns)


def page_cursors(pages: DataFrame, payload: str, keys: list[str]) -> DataFrame:
    """Per page: number of items, next cursor, and whether the walk is drained.

    The cursor is the time of the last item by position that has a usable one, which need
    not be the latest. ``payload`` is a provider's JSON envelope, however deep its records nest; ``keys``
    tell pages apart. A page that cannot be read
    has no known number of items (null), is ``unreadable`` and never counts as drained.
    """
    read = read_pages(pages, payload, keys)
    items = read.select(
        *keys, (F.col("_sent") & F.col("_page").isNull()).alias("unreadable"), envelope_items(F.col("_page")).alias("_items"), "_state", "_hash"
    )
    epochs = F.transform(
        "_items",
        lambda item: epoch_seconds(F.try_variant_get(item, "$.created_utc", "string")),
    )
    places = F.transform(epochs, lambda e, i: F.struct(i.alias("place"), e.alias("epoch")))
    usable = F.filter(places, lambda p: p["epoch"].isNotNull())
    names = [*keys, "items", "next_cursor", "exhausted", "unreadable"]
    cursors = items.select(
        *keys,
        F.when(~F.col("unreadable"), F.size("_items").cast("bigint")).alias("items"),
        F.explode(F.array(F.try_element_at(usable, F.lit(-1)))).alias("_last"),
        (~F.col("unreadable") & (F.size("_items") == 0)).alias("exhausted"),
        "unreadable", (~F.col("unreadable") & F.col("_state").isNotNull()).alias("_deep"), "_hash",
    )
    cursors = cursors.select(*names[:-3], F.col("_last.epoch").alias("next_cursor"), *names[-2:], F.col("_last.place").alias("_place"), "_deep", "_hash")
    seen = Observation()
    cursors = materialize(
        cursors, "cursors", None, seen, F.count_if("_deep").alias("deep"), F.count("_hash").alias("odd")
    )
    if not (seen.get["deep"] or seen.get["odd"]):
        return cursors.select(names)
    # Pages whose records nest too deep for the reader are told apart by their keys, odd ones are counted by their pieces.
    deep = cursors.filter("_deep").select(*keys, "items", "next_cursor", "_place")
    if seen.get["odd"]:
        found = odd_items(pages, payload, keys, cursors.filter(F.col("_hash").isNotNull()))
        epoch = epoch_seconds(F.try_variant_get("item", "$.created_utc", "string"))
        found = found.select(*keys, F.col("place").isNotNull().cast("bigint").alias("items"), epoch.alias("next_cursor"), "place")
        deep = deep.unionByName(found.withColumnRenamed("place", "_place"))
    place = F.when(F.col("next_cursor").isNotNull(), F.col("_place"))
    counted = deep.groupBy(*keys).agg(F.sum("items").alias("items"), F.max_by("next_cursor", place).alias("next_cursor"))
    counted = materialize(counted.withColumns({"exhausted": F.col("items") == 0, "unreadable": F.lit(False)}), "deep")
    plain = cursors.filter(~F.col("_deep")).select(names)
    return plain.join(counted.select(*keys), keys, "left_anti").unionByName(counted.select(names))


def merge_progress(old: DataFrame, new: DataFrame) -> DataFrame:
    """New rows replace old ones of the same walk and window."""
    keys = [*WALK, *WINDOW]
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)
