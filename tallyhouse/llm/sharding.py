"""Sharding by Karmarkar-Karp differencing: byte-balanced shards of indivisible
groups, a group being all documents of one text.

A partial partition is a row of shard loads.  Differencing takes the two with
the largest spread (highest load less lowest), lays the heaviest load of one on
the lightest of the other, and so on, and puts the sum back, until one is left.

Distribution.  The heaviest groups, at most ``HEAVY`` (whole classes of size,
four to a doubling), are differenced first, as one; in a small table these are
all groups, in any table all that hold more than about 1 in ``HEAVY`` of the
bytes.  The light groups are dealt by hash to buckets of about
``BUCKET_GROUPS``.  Shards that
heavy groups have filled beyond the level which all bytes would reach stay as
they are; what the others lack to it is the light groups' room.  Each bucket is
differenced on its own together with one more partial partition, its share of
the loads that are there already, so that its groups go where room is left and
no bucket needs to know another.  The buckets' small rests have random signs.

Slots number the documents of a shard without gaps: they are dealt to parts by
hash, counted per shard and part, numbered within a part; a prefix sum over the
bounded table of counts gives where each part begins.

Edge cases: a null text has no bytes and belongs to the group of empty texts;
a null doc_id is carried; repeated rows are rows of their own, in one shard and
with a slot each; an empty table gives no rows; other columns are ignored by
``assign``, whatever they are called, and kept by ``write_shards``.  Ties are
broken by the groups' keys, so reruns agree.  A group larger than a fair share
fills a shard alone.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import join_copies, ship_by_value, stored, text_key

ship_by_value(__name__)

SHARDS = 40
ROW_BYTES = 16           # counted for each document besides its text
HEAVY = 8192
BUCKET_GROUPS = 4096
PART_ROWS, PARTS = 4096, 4096


def difference(weights, shards: int, present=None) -> np.ndarray:
    """The shard of each weight.

    ``present``: loads that the shards have already, a partial partition whose
    positions are the shards themselves.  It is merged like any other, and in
    the end tells which position is which shard.
    """
    if present is None:
        present = [0.0] * shards
    # a partial partition: its loads in falling order and, per load, the members
    # that make it up (a tree of pairs, flattened at the end); -1 - s marks shard s
    order = sorted(range(shards), key=lambda s: (-present[s], s))
    heap = [(present[order[-1]] - present[order[0]], -1, [present[s] for s in order], [-1 - s for s in order])]
    for i, w in enumerate(weights):
        heap.append((-w, i, [w] + [0] * (shards - 1), [i] + [None] * (shards - 1)))
    heapq.heapify(heap)
    count = len(weights)
    while len(heap) > 1:
        _, _, high, of_high = heapq.heappop(heap)
        _, _, low, of_low = heapq.heappop(heap)
        low.reverse()
        of_low.reverse()
        loads = [a + b for a, b in zip(high, low)]
        members = [a if b is None else b if a is None else (a, b) for a, b in zip(of_high, of_low)]
        rank = sorted(range(shards), key=loads.__getitem__, reverse=True)
        loads = [loads[r] for r in rank]
        heapq.heappush(heap, (loads[-1] - loads[0], count, loads, [members[r] for r in rank]))
        count += 1
    shard_of = np.empty(len(weights), dtype=np.int64)
    for tree in heap[0][3]:
        leaves, stack = [], [tree]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += node
            elif node is not None:
                leaves.append(node)
        mark = next(-1 - leaf for leaf in leaves if leaf < 0)
        shard_of[[leaf for leaf in leaves if leaf >= 0]] = mark
    return shard_of


def water_level(loads, more: float) -> float:
    """The level at which ``more`` poured onto ``loads`` comes to rest."""
    loads = sorted(loads)
    filled = 0.0
    for k, load in enumerate(loads, 1):
        filled += load
        level = (filled + more) / k
        if k == len(loads) or level <= loads[k]:
            return level
    return more


def assign_groups(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """key (binary), shard of each row of ``groups`` (key, weight > 0)."""
    spark = groups.sparkSession
    size_class = F.floor(4 * F.log2("weight"))
    taken, cut = 0, 1 << 30
    for c, n in sorted(map(tuple, groups.groupBy(size_class).count().collect()), reverse=True):  # at most 256 classes
        taken += n
        if taken > HEAVY:
            break
        cut = c
    is_heavy = size_class >= cut
    heavy = sorted((-r.weight, bytes(r.key)) for r in groups.filter(is_heavy).collect())
    placed = difference([-w for w, _ in heavy], shards)
    loads = [0] * shards
    for (w, _), s in zip(heavy, placed):
        loads[s] -= w
    first = spark.createDataFrame([(key, int(s)) for (_, key), s in zip(heavy, placed)], "key binary, shard int")

    light = groups.filter(~is_heavy)
    n, room = light.agg(F.count("*"), F.sum("weight")).first()
    room = room or 0
    level = water_level(loads, room)
    there = [min(load, level) / room for load in loads] if room else loads
    buckets = max(1, -(-n // BUCKET_GROUPS))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["weight", "key"], ascending=[False, True], ignore_index=True)
        weights = rows["weight"].tolist()
        rows["shard"] = difference(weights, shards, [t * sum(weights) for t in there])
        return rows[["key", "shard"]]

    rest = light.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).groupBy("bucket").applyInPandas(
        place, "key binary, shard int")
    return first.union(rest)


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, key (of the text), size, text_crc32, shard, slot of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = stored(docs.select("doc_id", text_key().alias("key"),
                              (F.octet_length(text) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
                              F.crc32(text.cast("binary")).alias("text_crc32")), "shard-rows")
    groups = stored(rows.groupBy("key").agg(F.count("*").alias("copies"), F.sum("size").alias("weight")),
                    "shard-groups")
    of_group = stored(assign_groups(groups, shards).join(groups, "key").select("key", "copies", "shard"),
                      "shard-assigned")
    total = rows.count()
    parts = min(PARTS, max(1, -(-total // PART_ROWS)))
    placed = stored(join_copies(rows, of_group, total).drop("copies").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "key"), F.lit(parts)).cast("int")), "shard-placed")
    # at most shards x PARTS rows
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "part").agg(F.count("*").alias("n")).select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "key")
    return placed.withColumn("place", F.row_number().over(within) - 1).join(
        F.broadcast(starts), ["shard", "part"]).select(
        "doc_id", "key", "size", "text_crc32", "shard", (F.col("begin") + F.col("place")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write ``docs``, all columns, as Parquet folders ``_shard=0`` ... under
    ``path`` (more underscores if a column is called so); a document's folder
    is its text's shard."""
    folder = "_shard"
    while folder in docs.columns:
        folder = f"_{folder}"
    of_text = assign(docs, shards).groupBy("key").agg(F.first("shard").alias("shard"), F.count("*").alias("copies"))
    of_text = stored(of_text, "shard-texts")
    rows = docs.select(text_key().alias("key"), F.struct(*docs.columns).alias("row"))
    joined = join_copies(rows, of_text, docs.count())
    joined.select(F.col("shard").alias(folder), "row.*").write.partitionBy(folder).parquet(path)
