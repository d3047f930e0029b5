"""Mixing sources to target weights by Pfair scheduling of blocks.

A source of share w out of W releases its block k at slot floor(k W / w) and must have it
placed by slot ceil((k + 1) W / w). Earliest deadline first (ties: the source named first)
fills every slot and keeps each source within less than one block of its target at all times.
Such a schedule repeats every W slots, so one cycle, which only the weights decide, places any
number of blocks. When a source runs out, the others go on with their shares from that slot.

Sources without a share of their own (null included) form one pooled source, so the number of
sources is bounded by the weights, not by the data. All rows are kept. Rows of a source come
in the order of md5(doc_id), then doc_id: shuffled, but the same in every run. Null ids come
first, repeated rows stay apart rows. An empty table gives an empty result.

Everything here is DataFrame expressions; plain Python only lays out the cycle of the weights.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm.common import local_table, range_offsets, ranges_for

#: Stands for all sources without a share of their own.
POOL = "*"

_PHASES = pa.schema([("_name", pa.string())] + [(n, pa.int64()) for n in ("_phase", "_k0", "_k1", "_share", "_cycle", "_start")])
_SLOTS = pa.schema([("_in", pa.string())] + [(n, pa.int64()) for n in ("_of", "_turn", "_at")])


def edf_cycle(shares: list[int]) -> list[int]:
    """The source of each slot of one cycle; the cycle is the sum of the shares."""
    total, used, out = sum(shares), [0] * len(shares), []
    for slot in range(total):
        ready = [
            (-(-(used[i] + 1) * total // share), i)
            for i, share in enumerate(shares)
            if used[i] < share and used[i] * total // share <= slot
        ]
        _, i = min(ready)
        used[i] += 1
        out.append(i)
    return out


def lay_out(blocks: dict[str, int], weights: dict[str, int]) -> tuple[list[dict], list[dict], dict[str, int]]:
    """Phases and cycles for so many blocks per source, and the slot of each source's last block."""
    left = {s: n for s, n in blocks.items() if n}
    names = [s for s in weights if s in left]
    done, start, phases, slots, last = dict.fromkeys(names, 0), 0, [], [], {}
    phase = 0
    while names:
        shares = [weights[s] for s in names]
        cycle, total = edf_cycle(shares), sum(shares)
        at: dict[str, list[int]] = {s: [] for s in names}
        for slot, i in enumerate(cycle):
            at[names[i]].append(slot)
        ends = {s: (left[s] - 1) // weights[s] * total + at[s][(left[s] - 1) % weights[s]] + 1 for s in names}
        length = min(ends.values())
        for s in names:
            took = length // total * weights[s] + sum(x < length % total for x in at[s])
            phases.append({"_name": s, "_phase": phase, "_k0": done[s], "_k1": done[s] + took,
                           "_share": weights[s], "_cycle": total, "_start": start})
            slots += [{"_in": s, "_of": phase, "_turn": j, "_at": x} for j, x in enumerate(at[s])]
            done[s] += took
            left[s] -= took
            if not left[s]:
                last[s] = start + ends[s] - 1
        start += length
        phase += 1
        names = [s for s in names if left[s]]
    return phases, slots, last


def _order(key: str) -> tuple[Column, Column]:
    """The shuffled order of rows and its first 32 bits as a number."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return digest, F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def mix(docs: DataFrame, weights: dict[str, int], block_rows: int, key: str = "doc_id", source: str = "source") -> DataFrame:
    """All rows with ``mix_source``, ``block``, ``slot`` and ``position`` (0-based, gapless).

    ``weights`` are whole shares; ``"*"`` is that of the pool, 1 if it is missing. Columns of
    the four names are replaced.
    """
    if block_rows < 1 or any(int(w) != w or w < 1 for w in weights.values()):
        raise ValueError("shares and the block are whole numbers from 1")
    weights = {POOL: 1} | weights
    weights = {s: w for s, w in weights.items() if s != POOL} | {POOL: weights[POOL]}
    spark = docs.sparkSession
    docs = docs.drop("mix_source", "block", "slot", "position")
    named = F.col(source).isin([s for s in weights if s != POOL])
    digest, front = _order(key)
    docs = docs.withColumn("mix_source", F.when(named, F.col(source)).otherwise(F.lit(POOL)))

    sizes = {r["mix_source"]: r["count"] for r in docs.groupBy("mix_source").count().collect()}  # as many as weights
    ranges = ranges_for(sum(sizes.values()))
    blocks = {s: -(-n // block_rows) for s, n in sizes.items()}
    phases, slots, last = lay_out(blocks, weights)

    # The order's own range, so that ranges follow each other and ranks are those of the whole source.
    part = F.floor(front * F.lit(ranges) / F.lit(1 << 32)).cast("long")
    counted = docs.select("mix_source", part.alias("_part")).groupBy("mix_source", "_part").agg(F.count("*").alias("_n"))
    before = range_offsets(counted, "mix_source", "_part", "_n").withColumnsRenamed({"mix_source": "_owner", "_part": "_range"})
    w = Window.partitionBy("mix_source", "_part").orderBy("_digest", key)
    out = docs.withColumns({"_digest": digest, "_part": part})
    out = out.join(before, (F.col("mix_source") == F.col("_owner")) & (F.col("_part") == F.col("_range")))
    out = out.withColumn("_rank", F.row_number().over(w) - 1 + F.col("_before"))
    out = out.withColumn("block", F.floor(F.col("_rank") / F.lit(block_rows)).cast("long"))

    # Both tables are as large as the weights say, whatever the data.
    plan = F.broadcast(local_table(spark, phases, _PHASES))
    turns = F.broadcast(local_table(spark, slots, _SLOTS))
    out = out.join(plan, (F.col("mix_source") == F.col("_name")) & (F.col("block") >= F.col("_k0")) & (F.col("block") < F.col("_k1")))
    turn = F.pmod(F.col("block") - F.col("_k0"), F.col("_share"))
    out = out.join(turns, (F.col("mix_source") == F.col("_in")) & (F.col("_phase") == F.col("_of")) & (turn == F.col("_turn")))
    round_ = F.floor((F.col("block") - F.col("_k0")) / F.col("_share")).cast("long")
    out = out.withColumn("slot", F.col("_start") + round_ * F.col("_cycle") + F.col("_at"))
    # A source's last block may be short; what follows it moves up.
    short = [(at, blocks[s] * block_rows - sizes[s]) for s, at in last.items()]
    missing = sum((F.when(F.col("slot") > at, F.lit(gap)).otherwise(F.lit(0)) for at, gap in short if gap), F.lit(0))
    place = F.col("slot") * block_rows + F.col("_rank") - F.col("block") * block_rows - missing
    return out.withColumn("position", place.cast("long")).select(
        *[c for c in docs.columns if c != "mix_source"], "mix_source", "block", "slot", "position"
    )


def in_mix_order(docs: DataFrame, weights: dict[str, int], block_rows: int, rows_per_file: int = 50_000) -> DataFrame:
    """The rows of ``docs`` in files that follow each other in the mixed order; columns unchanged."""
    mixed = mix(docs, weights, block_rows)
    total = max(1, docs.count())
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // rows_per_file))
    place = F.floor(F.col("position") * parts / total).cast("int")
    return mixed.repartitionById(parts, place).sortWithinPartitions("position").select(*docs.columns)
