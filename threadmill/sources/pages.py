"""A Spark source over a folder of provider pages, with a cursor per walk.

A walk is a subreddit and a kind. Its pages are files ``<root>/<subreddit>/<kind>/<cursor>.json``: one JSON
envelope of records each, named by the time of its last record, so that a listing alone tells how far a
walk reaches and which pages a window can touch. As a batch source, conditions on ``subreddit``, ``kind``
and ``created_epoch`` choose walks and pages before any file is opened. As a stream, the offset is the
cursor of every walk: a restart goes on from there, page by page. Every walk is a partition of its own,
and a long one is parted by the number and the bytes of its pages. The folder can be anywhere that Arrow's file systems reach.

A page that cannot be read stops the task that reads it, like a provider's failure; a record without a
usable time passes every condition on it and is left to the filters behind the source.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, EqualTo, Filter, GreaterThan,
    GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage,
)

FORMAT = "threadmill_pages"
SCHEMA = "subreddit string, kind string, created_epoch bigint, raw string, cursor bigint, file string"
PAGE_SCHEMA = "subreddit string, kind string, cursor bigint, payload string"
#: Pages of a walk that one task reads, and bytes of them, of which a single page may have more.
PAGES_PER_TASK = 200
BYTES_PER_TASK = 4_000_000
#: Rows of an Arrow batch.
BATCH_ROWS = 10_000
_DIGITS = 20


def register(spark: SparkSession) -> None:
    """Make the source known to the session as ``threadmill_pages``, with its conditions pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    # Workers need not have this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PageSource)


def _open(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def _listed(root: str, sizes: dict[str, int] | None = None) -> dict[tuple[str, str], list[tuple[int, str]]]:
    """The pages (cursor, path) of every walk, by cursor; ``sizes`` takes the bytes of each path."""
    from pyarrow import fs

    system, top = _open(root)
    out: dict[tuple[str, str], list[tuple[int, str]]] = {}
    for info in system.get_file_info(fs.FileSelector(top, recursive=True, allow_not_found=True)):
        name, _, kind = info.base_name.rpartition(".")
        if info.type == fs.FileType.File and kind == "json" and name.isdigit():
            subreddit, walk = info.path.rsplit("/", 3)[1:3]
            out.setdefault((subreddit, walk), []).append((int(name), info.path))
            if sizes is not None:
                sizes[info.path] = info.size or 0
    return {walk: sorted(pages) for walk, pages in sorted(out.items())}


@dataclass
class Pages(InputPartition):
    """Some pages of one walk."""

    subreddit: str
    kind: str
    pages: list[tuple[int, str]]


def _parted(walks: dict[tuple[str, str], list[tuple[int, str]]], sizes: dict[str, int] | None = None) -> list[Pages]:
    out = []
    for (subreddit, kind), pages in walks.items():
        part, held = None, 0
        for page in pages:
            size = (sizes or {}).get(page[1], 0)
            if part is None or len(part.pages) >= PAGES_PER_TASK or held + size > BYTES_PER_TASK:
                part, held = Pages(subreddit, kind, []), 0
                out.append(part)
            part.pages.append(page)
            held += size
    return out


def _epoch(record) -> int | None:
    try:
        return int(float(record["created_utc"]))
    except (KeyError, TypeError, ValueError, OverflowError):
        return None


def _records(root: str, part: Pages | None, low: int | None = None, high: int | None = None) -> Iterator:
    """The records as Arrow batches of ``SCHEMA``: rows cost no step of their own on the way to Spark."""
    import pyarrow as pa

    system, _ = _open(root)
    text = json.JSONEncoder(ensure_ascii=False).encode
    schema = pa.schema(
        [(n, pa.int64() if t == "bigint" else pa.string()) for n, t in (c.split() for c in SCHEMA.split(", "))]
    )
    # Without any page Spark reads one partition that is none.
    for cursor, path in part.pages if part else []:
        with system.open_input_stream(path) as stream:
            payload = json.loads(stream.read())
        items = payload.get("data") if isinstance(payload, dict) else payload
        items = items if isinstance(items, list) else []
        for i in range(0, len(items), BATCH_ROWS):
            timed = [(_epoch(record), record) for record in items[i : i + BATCH_ROWS]]
            kept = [
                (at, record) for at, record in timed
                if at is None or ((low is None or at >= low) and (high is None or at < high))
            ]
            if kept:
                n = len(kept)
                columns = [
                    [part.subreddit] * n, [part.kind] * n, [at for at, _ in kept], [text(r) for _, r in kept], [cursor] * n, [path] * n,
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class PageReader(DataSourceReader):
    def __init__(self, root: str):
        self.root = root
        self.wanted: dict[str, set] = {}
        self.low: int | None = None
        self.high: int | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes what chooses walks and pages; conditions on the time are left to Spark as well."""
        for f in filters:
            name = ".".join(getattr(f, "attribute", ()))
            if name in ("subreddit", "kind") and isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted.get(name, values) & values
                continue
            if name == "created_epoch" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                low = f.value + isinstance(f, GreaterThan)
                self.low = low if self.low is None else max(self.low, low)
            if name == "created_epoch" and isinstance(f, (LessThan, LessThanOrEqual)):
                high = f.value + isinstance(f, LessThanOrEqual)
                self.high = high if self.high is None else min(self.high, high)
            yield f

    def partitions(self) -> list[Pages]:
        kept, sizes = {}, {}
        for walk, pages in _listed(self.root, sizes).items():
            if all(value in self.wanted.get(name, {value}) for name, value in zip(("subreddit", "kind"), walk)):
                # A page ends at its cursor and begins behind that of the page before, at the earliest at the same second.
                begins = [None, *[c for c, _ in pages[:-1]]]
                kept[walk] = [
                    page for page, begin in zip(pages, begins)
                    if (self.low is None or page[0] >= self.low) and (self.high is None or begin is None or begin < self.high)
                ]
        return _parted(kept, sizes)

    def read(self, partition: Pages) -> Iterator:
        return _records(self.root, partition, self.low, self.high)


class PageStreamReader(DataSourceStreamReader):
    """Offsets are the last cursor taken of every walk."""

    def __init__(self, root: str):
        self.root = root

    def initialOffset(self) -> dict:
        return {"walks": "{}"}

    def latestOffset(self) -> dict:
        return {"walks": json.dumps({"/".join(walk): pages[-1][0] for walk, pages in _listed(self.root).items()}, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        taken, upto = json.loads(start["walks"]), json.loads(end["walks"])
        walks, sizes = {}, {}
        for walk, pages in _listed(self.root, sizes).items():
            name = "/".join(walk)
            if name in upto:
                walks[walk] = [p for p in pages if taken.get(name, -1) < p[0] <= upto[name]]
        return _parted(walks, sizes)

    def read(self, partition: Pages) -> Iterator:
        return _records(self.root, partition)


@dataclass
class Written(WriterCommitMessage):
    pages: int


class PageWriter(DataSourceWriter):
    """Writes rows of ``PAGE_SCHEMA`` as pages; a page written twice is replaced by itself."""

    def __init__(self, root: str):
        self.root = root

    def write(self, iterator) -> Written:
        system, top = _open(self.root)
        n = 0
        for row in iterator:
            folder = f"{top}/{row.subreddit}/{row.kind}"
            system.create_dir(folder, recursive=True)
            # Readers see whole pages only.
            place = f"{folder}/{row.cursor:0{_DIGITS}d}"
            with system.open_output_stream(f"{place}.part") as out:
                out.write(row.payload.encode())
            system.move(f"{place}.part", f"{place}.json")
            n += 1
        return Written(n)


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options["path"])

    def streamReader(self, schema) -> PageStreamReader:
        return PageStreamReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> PageWriter:
        return PageWriter(self.options["path"])
