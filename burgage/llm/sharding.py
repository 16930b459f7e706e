"""Sharding by Karmarkar-Karp differencing: indivisible groups of equal texts, near equal bytes.

Differencing starts with one partial partition per group, that group in one shard and the others
empty. It takes the two of the largest spread again and again and lays one on the other in opposite
order, largest part on smallest, so that their differences cancel. What is left at the end is one
partition of small spread.

All groups do not fit one task, so it works on levels. A level deals its items into buckets by
hash, differences each bucket into as many parts as there are shards and hands the parts on as items
of the next level, until at most TOP are left, which one task differences. A group much larger than
its bucket's share stays a part of its own, so the last level can still lay small parts beside it.
Only sizes and hashes move; texts are read once.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .runs import key_runs, partitions, unused

SHARDS = 24
HEADER = 8            # bytes that a row takes besides its text
TOP = 1 << 15         # items of the last level, which one task differences
FACTOR = 64           # items that a level makes one of, at most
SLOT_ROWS = 1 << 20   # rows of a shard that one task numbers, at most


def differenced(sizes: Sequence[int], parts: int) -> list[int]:
    """The part, from 0, of each of `sizes`, by differencing into `parts` parts.

    A partial partition keeps its sums from largest to smallest, less the smallest. Of equal
    spreads the earlier goes first, so equal input has an equal result.
    """
    if not len(sizes):
        return []
    sums = [[s] + [0] * (parts - 1) if parts > 1 else [0] for s in sizes]
    heap = [(-s[0], i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    made = []  # (one, other, where the parts of the one have gone to)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        total = [x + y for x, y in zip(sums[a], reversed(sums[b]))]
        order = sorted(range(parts), key=total.__getitem__, reverse=True)
        low = total[order[-1]]
        sums[a] = sums[b] = None
        heapq.heappush(heap, (low - total[order[0]], len(sums)))
        sums.append([total[i] - low for i in order])
        made.append((a, b, order))
    place: list = [None] * len(sums)  # part of the result for each position of a partial one
    place[-1] = range(parts)
    for node, (a, b, order) in zip(range(len(sums) - 1, len(sizes) - 1, -1), reversed(made)):
        one, other = [0] * parts, [0] * parts
        for part, at in zip(place[node], order):
            one[at] = other[parts - 1 - at] = part
        place[a], place[b], place[node] = one, other, None
    return [p[0] for p in place[:len(sizes)]]


def _level(items: DataFrame, buckets: int, shards: int) -> DataFrame:
    """(item, bytes) -> (item, bytes, parent): the part of its bucket that each item belongs to."""
    def run(batches):
        for (bucket,), g in key_runs(batches, ["bucket"]):
            order = np.lexsort((g["item"], -g["bytes"]))
            item, size = g["item"][order], g["bytes"][order]
            part = np.array(differenced(size.tolist(), shards), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), pa.array(size), pa.array(bucket * shards + part)],
                ["item", "bytes", "parent"])

    bucket = F.pmod(F.xxhash64("item"), F.lit(buckets)).alias("bucket")
    dealt = (items.select("item", "bytes", bucket)
             .repartition(min(buckets, partitions(items)), "bucket").sortWithinPartitions("bucket"))
    return written(dealt.mapInArrow(run, "item long, bytes long, parent long"), "shard_level")


def balanced(items: DataFrame, shards: int = SHARDS, top: int = TOP) -> DataFrame:
    """(item, bytes), items distinct longs -> (item, shard)."""
    n = items.count()
    levels = []
    while n > top:
        rounds = max(1, math.ceil(math.log(n / top, FACTOR)))
        factor = max(2, math.ceil((n / top) ** (1 / rounds)))
        levels.append(_level(items, math.ceil(n / (shards * factor)), shards))
        items = levels[-1].groupBy(F.col("parent").alias("item")).agg(F.sum("bytes").alias("bytes"))
        n = min(items.count(), n - 1)
    found = _level(items, 1, shards).select("item", F.col("parent").cast("int").alias("shard"))
    for level in reversed(levels):
        above = found.select(F.col("item").alias("parent"), "shard")
        found = level.join(above, "parent").select("item", "shard")
    return found


def _keys(text_col: str) -> list:
    """Size of a row and two independent hashes of its text: what equal texts have in common."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [(F.octet_length(text) + HEADER).cast("long").alias("_size"),
            F.xxhash64(text).alias("_a"), F.xxhash64(F.lit(1), text).alias("_b")]


KEYS = ["_size", "_a", "_b"]


def group_shards(rows: DataFrame, shards: int = SHARDS, top: int = TOP) -> DataFrame:
    """Rows with KEYS -> (KEYS, n, shard) per group. Copies are counted before they are shuffled."""
    groups = written(rows.groupBy(*KEYS).agg(F.count("*").alias("n"))
                     .withColumn("item", F.monotonically_increasing_id()), "shard_groups")
    found = balanced(groups.select("item", (F.col("_size") * F.col("n")).alias("bytes")), shards, top)
    return written(groups.join(found, "item").select(*KEYS, "n", "shard"), "group_shards")


def _placed(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """`rows` with their group's shard.

    Groups of more than a quarter of a task's share of the rows, of which there are fewer than four
    times the tasks, are looked up where the rows are. Only the others are shuffled by group.
    """
    tasks = partitions(rows)
    total = groups.select(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = groups.where(F.col("n") > total / (4 * tasks)).select(*KEYS, "shard")
    rest = groups.where(F.col("n") <= total / (4 * tasks)).select(*KEYS, "shard")
    return (rows.join(F.broadcast(hot), KEYS).select(*rows.columns, "shard")
            .union(rows.join(F.broadcast(hot), KEYS, "left_anti").join(rest, KEYS)
                   .select(*rows.columns, "shard")))


def _slots(placed: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0 without a task that sees a whole shard.

    Rows fall into cells by a hash of their row number; a running total of the cells' counts gives
    each cell its first slot.
    """
    cells = max(partitions(placed), -(-placed.count() // SLOT_ROWS))
    placed = placed.withColumn("_cell", F.pmod(F.xxhash64("_row"), F.lit(cells)))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    first = (placed.groupBy("shard", "_cell").agg(F.count("*").alias("_n"))
             .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = F.row_number().over(Window.partitionBy("shard", "_cell").orderBy("_row"))
    return (placed.withColumn("_at", inside - 1).join(first, ["shard", "_cell"])
            .withColumn("slot", F.col("_first") + F.col("_at")))


def sharded(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
            top: int = TOP) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of `docs`.

    `size` is the UTF-8 bytes of the text and HEADER; a null text counts as empty. Rows of equal
    texts stay in one shard, whatever their ids, and the shards' sizes are near equal (`law` is
    `bytes`, `grown_shard` null): as near as the largest group allows. Slots of a shard run from 0
    without gaps. Null and repeated ids are rows like others; an empty table has no rows, and
    with fewer groups than shards some shards are empty. Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.crc32(text.cast("binary")).alias("text_crc32"),
                               *_keys(text_col), F.monotonically_increasing_id().alias("_row")),
                   "shard_rows")
    placed = written(_placed(rows, group_shards(rows, shards, top)), "shard_placed")
    return _slots(placed).select(
        "doc_id", F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, text_col: str = "text",
                 top: int = TOP) -> None:
    """Write `docs` as Parquet below `path`, a folder `shard=i` for each shard.

    The table's own columns are kept but for one named `shard`, whose place the new one takes. A
    shard is written by several tasks, so no task holds one.
    """
    docs = docs.drop("shard")
    own = {c: unused(docs.columns, c) for c in docs.columns if c.lower() in KEYS}
    docs = docs.withColumnsRenamed(own)
    rows = docs.select(*docs.columns, *_keys(own.get(text_col, text_col)))
    placed = (_placed(rows, group_shards(rows.select(*KEYS), shards, top)).drop(*KEYS)
              .withColumnsRenamed({new: old for old, new in own.items()}))
    (placed.repartition("shard", F.floor(F.rand(7) * max(1, 4 * partitions(docs) // shards)))
     .write.partitionBy("shard").parquet(path))
