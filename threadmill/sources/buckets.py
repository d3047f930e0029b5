"""A table of current rows kept in buckets of its record key, so that upserts leave it where it lies.

Spark's own bucketing: the rows of a key are in one bucket file, sorted. A batch is shuffled into the
same buckets and meets them one by one, while the table itself is read in place. A version is a
folder of its own; the session's catalog only names it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..operators.versions import RECORD_KEY, merge_upsert


def _name(path: str) -> str:
    return f"threadmill_{hashlib.sha256(path.encode()).hexdigest()[:32]}"


def write_buckets(rows: DataFrame, path: str, buckets: int, keys: tuple[str, ...] = RECORD_KEY) -> None:
    """Write ``rows``, unique on the key, as a new table of ``buckets`` buckets at ``path``.

    One task writes one bucket, as one file.
    """
    spread = rows.repartition(buckets, *keys)
    (
        spread.write.mode("errorifexists").format("parquet").option("path", path)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(_name(path))
    )


def read_buckets(
    spark: SparkSession, path: str, schema: str, buckets: int, keys: tuple[str, ...] = RECORD_KEY
) -> DataFrame:
    """The table at ``path``; a session that does not know it yet is told its layout."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        listed = ", ".join(f"`{k}`" for k in keys)
        # Only the layout is registered; the files stay as they are.
        spark.sql(
            f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({listed}) "
            f"SORTED BY ({listed}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def upsert(base: DataFrame, batch: DataFrame, buckets: int, keys: tuple[str, ...] = RECORD_KEY) -> DataFrame:
    """``base``, read by :func:`read_buckets`, with ``batch`` upserted, bucket by bucket.

    Both are unique on the key. The batch alone is shuffled, into as many parts as there are buckets.
    """
    # A batch that Spark could broadcast would lose the buckets; a full outer join never broadcasts.
    return merge_upsert(base, batch.repartition(buckets, *keys), keys)


def forget(spark: SparkSession, path: str) -> None:
    """Take the name of a table out of the session's catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
