"""Sharding over fixed virtual slots.

A record's key hashes it into one of thousands of slots, for good. Bytes are summed per slot, and
a small versioned map says which shard holds a slot. Rebalancing edits the map: slots change
hands until the shards weigh alike, or until a new shard has its share; no record is hashed anew.
A slot that by itself outweighs a tenth of a shard (a key with very many records) is opened into
numbered parts, which the map lists like slots.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cauce.llm.registry import query, table
from cauce.sources.scratch import materialise

SHARDS = 40
#: Virtual slots, fixed for the life of a data set.
SLOTS = 8192
#: Bytes that a record weighs besides its text.
RECORD = 16
#: Opened parts of all slots together: at most this many times the shards.
PARTS = 20


class SlotMap(NamedTuple):
    """One version of the map: ``shard[i]`` holds slot or part ``i``, which has ``weight[i]`` bytes."""

    version: int
    shards: int
    shard: np.ndarray
    weight: np.ndarray

    def loads(self) -> np.ndarray:
        return np.bincount(self.shard, self.weight, self.shards).astype(np.int64)


def first_map(weight: np.ndarray, shards: int) -> SlotMap:
    """Version 1: slots are dealt out in turn, whatever they weigh."""
    return SlotMap(1, shards, np.arange(len(weight)) % shards, np.asarray(weight, np.int64))


def rebalanced(have: SlotMap) -> SlotMap:
    """The next version: slots move from heavy to light shards, or are exchanged, until none of it helps.

    In each edit the heaviest shard gives the lightest one a slot, or a slot for a lighter one, so
    that their difference shrinks most. A shard that no edit can bring nearer to the lightest one
    is left as it is. Every edit lowers the sum of squares, so this ends.
    """
    shard, weight = have.shard.copy(), have.weight
    loads = have.loads()
    held = [np.flatnonzero((shard == s) & (weight > 0)) for s in range(have.shards)]
    open_ = np.ones(have.shards, bool)
    while open_.sum() > 1:
        live = np.flatnonzero(open_)
        heavy, light = live[np.argmax(loads[live])], live[np.argmin(loads[live])]
        gap = loads[heavy] - loads[light]
        mine = held[heavy][np.argsort(weight[held[heavy]], kind="stable")]
        back = np.append(-1, held[light])  # -1: nothing comes back
        returned = np.append(0, weight[held[light]])
        best = None
        if gap > 1 and len(mine):
            want = returned + gap / 2
            at = np.searchsorted(weight[mine], want)
            for near in (np.minimum(at, len(mine) - 1), np.maximum(at - 1, 0)):
                left = np.abs(gap - 2 * (weight[mine[near]] - returned))
                k = int(np.argmin(left))
                if left[k] < gap and (best is None or left[k] < best[0]):
                    best = left[k], mine[near[k]], back[k]
        if best is None:
            open_[heavy] = False
            continue
        _, give, take = best
        for slot, a, b in ((give, heavy, light), (take, light, heavy)):
            if slot >= 0:
                shard[slot] = b
                held[a] = held[a][held[a] != slot]
                held[b] = np.append(held[b], slot)
                loads[a] -= weight[slot]
                loads[b] += weight[slot]
    return SlotMap(have.version + 1, have.shards, shard, weight)


def grown(have: SlotMap) -> SlotMap:
    """The next version with one more shard, which takes its share of bytes; no other slot moves."""
    new, shard = have.shards, have.shard.copy()
    loads = np.append(have.loads(), 0)
    share = loads.sum() / (new + 1)
    order = np.argsort(-have.weight, kind="stable")
    for slot in order[have.weight[order] > 0]:
        s = shard[slot]
        if loads[s] - have.weight[slot] >= share * 0.999 and loads[new] + have.weight[slot] <= share:
            loads[s] -= have.weight[slot]
            loads[new] += have.weight[slot]
            shard[slot] = new
    return SlotMap(have.version + 1, new + 1, shard, have.weight)


def map_table(spark: SparkSession, versions: Iterable[SlotMap], path: str | None = None) -> DataFrame:
    """``version, slot, shard, bytes`` of the versions, written: appended at ``path``, or as an intermediate table.

    A map has ``SLOTS`` slots and a bounded number of parts, however many records there are.
    """
    import pandas as pd

    rows = pd.concat([pd.DataFrame({"version": m.version, "slot": np.arange(len(m.shard)), "shard": m.shard, "bytes": m.weight})
                      for m in versions])
    df = spark.createDataFrame(rows.astype("int64"), "version long, slot long, shard long, bytes long").withColumn("shard", F.col("shard").cast("int"))
    if path is None:
        return materialise(df, "slot-map")
    df.coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key, as a long; NULL keys have the slot of the empty string."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(slots))


def records(docs: DataFrame, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, slot, place`` of every row, written once; ``place`` tells equal rows apart."""
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return materialise(docs.select(
        F.col(key).cast("long").alias("doc_id"), (F.octet_length(raw).cast("long") + RECORD).alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"), slot_of(F.col(key), slots).alias("slot"),
        F.monotonically_increasing_id().alias("place")), "records")


class _Parts(NamedTuple):
    """Opened slots: the number of parts of each, and the number of its second part (the first is the slot itself)."""

    count: dict[int, int]
    start: dict[int, int]


def _opened(weights: dict[int, tuple[int, int]], shards: int, slots: int) -> _Parts:
    """Parts for slots of several records beyond a tenth of a shard, each part of about a twentieth; the shards bound their number."""
    unit = max(1, sum(w for w, _ in weights.values()) // (shards * PARTS))
    count, start, at = {}, {}, slots
    for slot, (weight, n) in sorted(weights.items()):
        if n > 1 and weight > 2 * unit:
            count[slot], start[slot] = -(-weight // unit), at
            at += count[slot] - 1
    return _Parts(count, start)


def _part(parts: _Parts) -> Column:
    """The slot, or one of its parts by a hash of the record, for an opened one."""
    if not parts.count:
        return F.col("slot")
    count, start = (F.create_map(*[F.lit(x).cast("long") for pair in d.items() for x in pair]) for d in parts)
    dealt = F.pmod(F.xxhash64("doc_id", "text_crc32", "place"), count[F.col("slot")])
    opened = F.when(dealt == 0, F.col("slot")).otherwise(start[F.col("slot")] + dealt - 1)
    return F.when(count[F.col("slot")].isNull(), F.col("slot")).otherwise(opened).cast("long")


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, key: str = "doc_id", text: str = "text",
                    path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with their place, and the versions of the map.

    The rows: ``doc_id, size, text_crc32, virtual_slot, shard, slot``; ``slot`` counts the rows of a
    shard from 0, by virtual slot, key and order of reading. The map: ``version, slot, shard,
    bytes``; its first version is dealt out blindly, the second one rebalanced by bytes; rows lie
    where the last says. Shards weigh alike up to what no exchange of two slots can mend: about a
    small slot, or one record if that is larger than a shard.

    NULL texts are empty, NULL keys share a slot; repeated rows are placed each; a key whose
    records outweigh a tenth of a shard is spread over parts; other columns are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    rows = records(docs, slots, key, text)
    # one row a slot comes to the driver, and at most a fixed number of parts
    per_slot = rows.groupBy("slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    weights = {r["slot"]: (r["bytes"], r["n"]) for r in per_slot.collect()}
    parts = _opened(weights, shards, slots)
    rows = rows.withColumn("virtual_slot", _part(parts))
    facts = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    weight = np.zeros(slots + sum(parts.count.values()) - len(parts.count), np.int64)
    count = weight.copy()
    for r in facts:
        weight[r["virtual_slot"]], count[r["virtual_slot"]] = r["bytes"], r["n"]
    first = first_map(weight, shards)
    even = rebalanced(first)
    stored = map_table(spark, [first, even], path)
    return placed(rows, even, count), stored


def placed(rows: DataFrame, using: SlotMap, count: np.ndarray) -> DataFrame:
    """Each row's shard by a version of the map, and its place there; ``count`` are the rows of every slot or part."""
    before = np.zeros(len(count), np.int64)
    for s in range(using.shards):
        mine = np.flatnonzero(using.shard == s)
        before[mine] = np.cumsum(count[mine]) - count[mine]
    import pandas as pd

    held = np.flatnonzero(count)
    facts = pd.DataFrame({"virtual_slot": held, "shard": using.shard[held], "before": before[held]}).astype("int64")
    lookup = rows.sparkSession.createDataFrame(facts, "virtual_slot long, shard long, before long")
    within = Window.partitionBy("virtual_slot").orderBy(F.col("doc_id").asc_nulls_first(), "place")
    return (
        rows.withColumn("_n", F.row_number().over(within))
        .join(F.broadcast(lookup), "virtual_slot")  # slots and parts: a bounded number of rows
        .select("doc_id", "size", "text_crc32", "virtual_slot", F.col("shard").cast("int").alias("shard"),
                (F.col("before") + F.col("_n") - 1).alias("slot"))
    )


@query("op13_sharding")
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = shard_documents(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
