"""Shards by jump consistent hashing: the key and the shard count decide, nothing is stored.

Law ``key``: adding a shard moves rows into the new shard only. Copies of one text have ids of
their own and so go where their ids send them. Null keys are one key like any other. Rows of
equal key share a shard. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import ranges_for, ranked
from threadmill.session import materialize


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key, by the published jump consistent hash."""
    key = keys.astype(np.uint64)
    shard = np.full(len(key), -1, np.int64)
    ahead = np.zeros(len(key), np.float64)
    live = np.arange(len(key))
    while len(live):
        shard[live] = ahead[live].astype(np.int64)
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        ahead[live] = (shard[live] + 1.0) * (2.0**31 / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0))
        live = live[ahead[live] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards - 1`` of a column of any type."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def place(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy().view(np.uint64), shards).astype(np.int32))

    return place(F.xxhash64(key))


def assign_shards(df: DataFrame, key: str, shards: int) -> DataFrame:
    """All rows with ``shard``, ``grown_shard`` (with one shard more) and ``slot``.

    ``slot`` numbers the rows of a shard gaplessly from 0, in the order of the hashed key.
    Columns of these names are replaced.
    """
    df = df.drop("shard", "grown_shard", "slot")
    placed = df.select(
        "*", shard_of(F.col(key), shards).alias("shard"), shard_of(F.col(key), shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_arrival"),
    )
    placed = materialize(placed, "shards")
    # The stored arrival keeps repeated keys apart, so even one key with a third of the rows is spread.
    part = F.pmod(F.xxhash64(F.col(key), F.col("_arrival")), F.lit(ranges_for(placed.count())))
    return ranked(placed, "shard", part, [F.xxhash64(F.col(key)), F.col("_arrival")], "slot").drop("_arrival")
