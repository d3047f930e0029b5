"""Helpers the operators share: bounded lookup tables, gapless ranks, word hashes over batches of text."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a key that one window of :func:`ranked` sorts, on average.
ROWS_PER_RANGE = 25_000
#: Ranges at least, so that a hot key spreads over the cores on small inputs too.
LEAST_RANGES = 64
#: Bytes of text that one numpy step works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where neither PYTHONPATH nor the working folder does.

    Spark's own file server hands the package to the executors. A package that came by
    ``--py-files`` is no folder and needs nothing.
    """
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, context = os.path.dirname(package), spark.sparkContext
    seen = [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    if root in map(os.path.abspath, seen) or not os.path.isdir(package) or context.applicationId in _shipped:
        return
    place = tempfile.mkdtemp(prefix="threadmill-package-")
    context.addPyFile(shutil.make_archive(f"{place}/threadmill", "zip", root, os.path.basename(package)))
    _shipped.add(context.applicationId)


def local_table(spark: SparkSession, rows: list[dict], schema: pa.Schema) -> DataFrame:
    """A table made from a parameter-sized list; an Arrow table needs no Python on the executors."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


def tokens_of(name: str, columns: list[str]) -> str:
    """A column name that none of ``columns`` has, whatever the letter case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ranges_for(rows: int) -> int:
    return max(LEAST_RANGES, -(-rows // ROWS_PER_RANGE))


def range_offsets(counted: DataFrame, key: str, part: str, count: str) -> DataFrame:
    """Rows of a key in the ranges before each range: (key, part, _before). One row per key and range."""
    w = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(key, part, F.coalesce(F.sum(count).over(w), F.lit(0)).alias("_before"))


def ranked(df: DataFrame, key: str, part: Column, order: list[Column], out: str) -> DataFrame:
    """Give each row its 0-based gapless position ``out`` within ``key``.

    ``part`` must be a deterministic whole number that grows with the order or does not matter
    to it: a key is cut into its ranges, rows are numbered in each range, and the ranges before
    are added. So a key of any size is spread, and only counts meet in one place. Equal keys
    and nulls are keys like any other.
    """
    df = df.withColumn("_part", part)
    before = range_offsets(df.groupBy(key, "_part").agg(F.count("*").alias("_n")), key, "_part", "_n")
    before = before.withColumnRenamed(key, "_key").withColumnRenamed("_part", "_range")
    w = Window.partitionBy(key, "_part").orderBy(*order)
    return (
        df.join(before, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_range")))
        .withColumn(out, (F.row_number().over(w) - 1 + F.col("_before")).cast("long"))
        .drop("_part", "_key", "_range", "_before")
    )


def remainder(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts


def labelled_sample(rows: DataFrame, label: str, per_label: int) -> DataFrame:
    """At most ``per_label`` rows of each label, the same in every run: those whose id hashes lowest.

    The label's count tells below which hash its lowest ones must lie, so that a label of any size
    brings about twice as many rows to the task that ranks them. Should hashes fall so unevenly that
    fewer are left, those are taken.
    """
    hashed = F.xxhash64("doc_id")
    counts = rows.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_of"))
    share = (hashed.cast("double") + 2.0**63) / 2.0**64
    # One row a label; joined by a shuffle, all rows of a label would meet in one task.
    low = rows.join(F.broadcast(counts), F.col(label) == F.col("_label")).where(share * F.col("_of") <= 2 * per_label + 100)
    w = Window.partitionBy(label).orderBy(hashed, "doc_id")
    return low.drop("_label", "_of").withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= per_label).drop("_nth")


# --- word hashes over a batch of texts -------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def _power(n: int, base: int, name: str) -> np.ndarray:
    """The first ``n`` powers; a worker keeps those of one step, a longer text's are made anew."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, STEP_BYTES + 1), np.uint64(base & _MASK))
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= STEP_BYTES + 1:
            _powers[name] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of some texts: ``[^\\x20\\x09-\\x0D]+`` of their UTF-8 bytes, A-Z in lower case.

    ``start`` and ``end`` are byte places in ``data``; words of text i are
    ``first[i]:first[i + 1]``. ``hash()`` gives 64 bits per word, ``prefix(k)`` those of its
    first k bytes; both come from one running polynomial sum, without a loop over words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        self.data, self.offsets = _LOWER[data] if lower else data, offsets
        n = len(data)
        solid = ~_SPACE[self.data]
        begins, ends = solid.copy(), solid.copy()
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        if n:
            begins[1:] &= ~solid[:-1] | edge[1:n]
            ends[:-1] &= ~solid[1:] | edge[1:n]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._sum: np.ndarray | None = None

    def _of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self._sum is None:
            n = len(self.data)
            terms = (self.data.astype(np.uint64) + np.uint64(1)) * _power(n, _BASE, "up")
            self._sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        down = _power(len(self.data) + 1, pow(_BASE, -1, 1 << 64), "down")
        return mix((self._sum[end] - self._sum[start]) * down[start])

    def hash(self) -> np.ndarray:
        return self._of(self.start, self.end)

    def prefix(self, k: int) -> np.ndarray:
        return self._of(self.start, np.minimum(self.start + k, self.end)) + np.uint64(k)

    def owner(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))


def text_steps(texts: pa.Array, step_bytes: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column of texts into runs of about ``step_bytes``: (from, to, bytes, offsets).

    Nulls count as empty. Every text is whole in one run; a longer one is alone in its run.
    """
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    _, off, body = texts.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, 8 * texts.offset) if n else np.zeros(1, np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + step_bytes, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


_resident: dict = {}


def resident(key, make: Callable[[], object]) -> object:
    """The one large object that a worker keeps between tasks; another key's takes its place."""
    if key not in _resident:
        _resident.clear()
        _resident[key] = make()
    return _resident[key]


def _start(keeps: bool) -> None:
    if not keeps:
        _resident.clear()


def _finish() -> None:
    """Give freed memory back, since an idle worker stays beside its executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # no such call in this C library


def tidy(run: Callable[[Iterator], Iterator], keeps: bool = False) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, between which a worker holds no more than it needs.

    ``keeps`` marks runs that use a :func:`resident` object; others free what is held.
    """

    def tidied(batches: Iterator) -> Iterator:
        _start(keeps)
        try:
            yield from run(batches)
        finally:
            _finish()

    return tidied


def over_batches(run: Callable[[Iterator[pa.Array]], Iterator[pa.Array]], kind: str, keeps: bool = False):
    """An Arrow function of one column; ``run`` sees all batches of a task."""
    tidied = tidy(run, keeps)
    tidied.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(tidied, kind)


def scored(text: Column, scorer: Broadcast, kinds: str, pick: Callable[[object, np.ndarray, np.ndarray], list[pa.Array]]) -> Column:
    """A struct column of what ``pick(model, bytes, offsets)`` gives for runs of whole texts."""
    names = [part.split()[0] for part in kinds.split(",")]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [pick(scorer.value, data, offsets) for _, _, data, offsets in text_steps(texts)]
            columns = [pa.concat_arrays(list(c)) for c in zip(*parts)]
            if parts:
                yield pa.StructArray.from_arrays(columns, names)
            else:
                yield pa.array([], pa.struct([(n, pa.null()) for n in names]))

    return over_batches(run, f"struct<{', '.join(p.strip().replace(' ', ':') for p in kinds.split(','))}>")(text)
