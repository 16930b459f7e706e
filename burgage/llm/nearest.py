"""Nearest neighbours by a block matrix join: int8 tiles with error bounds, then exact distances.

Queries come in blocks of bounded size. A task multiplies a block with a tile of candidate
vectors, both rounded to int8 with a scale per vector. The distance of two rounded vectors differs
from the true one by no more than the two rounding errors together, which are known. Pairs whose
lower bound lies above the k-th smallest upper bound are out; the others are computed in double
precision on the original vectors. A task keeps k of them per query in a heap; one aggregation
merges the tasks' heaps. The result is exact.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

K = 10
QUERY_VALUES = 4 << 20  # numbers in a block of queries: 32 MB as doubles, broadcast
TILE_VALUES = 1 << 20   # entries of a product tile


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the vectors that take part: not null or empty, all finite, not all zero."""
    v = F.col("v")
    return (vectors.select(F.col(id_col).cast("long").alias("id"),
                           F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                   & F.forall(v, lambda x: F.coalesce(
                       ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
                   & F.exists(v, lambda x: x != 0)))


class Rounded:
    """Vectors as int8 with a scale each, and how far each is from its rounded form."""

    def __init__(self, v: np.ndarray):
        self.v = v
        scale = np.abs(v).max(1) / 127
        scale[scale == 0] = 1.0  # of denormal vectors
        self.q = np.rint(v / scale[:, None]).astype(np.int8)
        self.scale = scale
        back = self.q * scale[:, None]
        # The last term is for the floating-point error of all that is computed here. Squares
        # beyond a double's range leave a vector without bounds.
        with np.errstate(over="ignore", invalid="ignore"):
            self.error = np.sqrt(((v - back) ** 2).sum(1)) + 1e-7 * np.sqrt((v ** 2).sum(1))
            self.square = (back ** 2).sum(1)


def tile_distances(a: Rounded, b: Rounded) -> np.ndarray:
    """Distances of the rounded vectors. Products of int8 are summed exactly: float32 holds
    integers to 2^24, which 1,024 of them stay below."""
    product = np.zeros((len(a.q), len(b.q)))
    for at in range(0, a.q.shape[1], 1_024):
        product += a.q[:, at:at + 1_024].astype(np.float32) @ b.q[:, at:at + 1_024].astype(np.float32).T
    with np.errstate(over="ignore", invalid="ignore"):
        square = a.square[:, None] + b.square - 2 * a.scale[:, None] * b.scale * product
        return np.sqrt(np.maximum(square, 0))


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, summed in order of the components.

    Where the squares pass a double's range, differences are first divided by the largest of them.
    """
    def summed(a, b, by):
        total = np.zeros(len(a))
        for i in range(a.shape[1]):
            total += ((a[:, i] - b[:, i]) / by) ** 2
        return np.sqrt(total) * by

    with np.errstate(over="ignore", invalid="ignore"):
        found = summed(a, b, 1.0)
        large = np.flatnonzero(~np.isfinite(found))
        if len(large):
            a, b = a[large] / 2, b[large] / 2  # a difference of two doubles may pass the range as well
            found[large] = summed(a, b, np.abs(a - b).max(1)) * 2
    return found


class Search:
    """k-heaps of one task for a block of queries of one length."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, k: int):
        self.ids, self.rounded, self.k = ids, Rounded(v), k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]  # (-distance, -id), worst first
        self.limit = np.full(len(ids), np.inf)

    def meet(self, ids: np.ndarray, v: np.ndarray) -> None:
        tile = Rounded(v)
        step = max(1, TILE_VALUES // len(ids))
        for at in range(0, len(self.ids), step):
            rows = slice(at, at + step)
            q = Rounded.__new__(Rounded)
            q.__dict__ = {n: x[rows] for n, x in self.rounded.__dict__.items()}
            d = tile_distances(q, tile)
            slack = q.error[:, None] + tile.error
            own = self.ids[rows, None] == ids
            with np.errstate(invalid="ignore"):
                low, high = d - slack, d + slack
            unknown = ~np.isfinite(high) | ~np.isfinite(low)
            low[unknown], high[unknown] = -np.inf, np.inf
            upper = np.where(own, np.inf, high)
            limit = self.limit[rows]
            if len(ids) > self.k:
                limit = np.minimum(limit, np.partition(upper, self.k - 1, axis=1)[:, self.k - 1])
            i, j = np.nonzero(~own & (low <= limit[:, None]))
            for row, number, far in zip((i + at).tolist(), ids[j].tolist(),
                                        exact(q.v[i], tile.v[j]).tolist()):
                heap = self.heaps[row]
                if len(heap) < self.k:
                    heapq.heappush(heap, (-far, -number))
                elif (-far, -number) > heap[0]:
                    heapq.heapreplace(heap, (-far, -number))
            for row in set((i + at).tolist()):
                if len(self.heaps[row]) == self.k:
                    self.limit[row] = -self.heaps[row][0][0]


def query_blocks(queries: DataFrame) -> tuple[DataFrame, int]:
    """The queries with the number of their block, of QUERY_VALUES numbers or so, by a hash of
    their id; and how many blocks there are. Written once, so that each block is read from there."""
    queries = written(queries, "queries")
    total = queries.select(F.coalesce(F.sum(F.size("v")), F.lit(0))).first()[0]
    n = -(-total // QUERY_VALUES)
    return queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, n)))), n


def by_length(block: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a block (id, v), apart by the vectors' length."""
    ids, lists = block.column(0).to_numpy(), block.column(1).combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    out = {}
    for n in sorted(set(size.tolist())):
        at = np.flatnonzero(size == n)
        out[n] = ids[at], lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
    return out


def search(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest of `vectors` for each row of `queries`.

    Nearest first, ties to the smaller id; a query's own id is no candidate. Only vectors of a
    query's length can be near it. A query id that is repeated is searched once, with its smallest
    vector; repeated candidates count as often as they occur. Rows with a null id or vector, and
    vectors that are zero, empty or not finite take no part; a query without candidates has no row.

    Every candidate meets every query: one pass over the vectors for each block of queries. A block
    is broadcast and let go before the next, so neither driver nor task ever holds more than one.
    Nothing but k rows per task and query is shuffled, and each block's result is written.
    """
    candidates = usable(vectors, id_col, vector_col)
    asked, blocks = query_blocks(usable(queries, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v")))
    spark, outs = vectors.sparkSession, []
    for number in range(blocks):
        block = asked.where(F.col("block") == number).select("id", "v").toArrow()
        if not block.num_rows:
            continue
        shared = spark.sparkContext.broadcast(by_length(block))

        def run(batches, shared=shared):
            searches = {n: Search(*q, k) for n, q in shared.value.items()}
            for b in batches:
                ids, lists = b.column(0).to_numpy(), b.column(1)
                lengths = np.diff(lists.offsets.to_numpy())
                for n in set(lengths.tolist()) & set(searches):
                    at = np.flatnonzero(lengths == n)
                    for part in np.array_split(at, -(-len(at) // 2_048)):
                        v = lists.take(pa.array(part)).flatten().to_numpy().reshape(-1, n)
                        searches[n].meet(ids[part], v)
            rows = [(int(q), -number, -far) for s in searches.values()
                    for q, heap in zip(s.ids, s.heaps) for far, number in heap]
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.float64())], ["query_id", "vec_id", "score"])

        found = candidates.mapInArrow(run, "query_id long, vec_id long, score double")
        outs.append(written(_merged(found, k), "nearest"))
        shared.destroy()
    if not outs:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.union, outs)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of the tasks' heaps; a query has k rows from each task at most."""
    nearest = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(
        F.struct("score", "vec_id"))), 1, k).alias("near"))
    return nearest.select("query_id", F.posexplode("near").alias("at", "n")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"),
        F.col("n.score").alias("score"))
