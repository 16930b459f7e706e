"""Hard-negative mining: bounds along a spanning tree of the anchors save most scores.

A score is the integer inner product of two quantised vectors. Anchors come in blocks of bounded
size. The anchors of a block form a minimum spanning tree by their distances. A task scores its tile
of candidates against the root, then goes down the tree level by level: a candidate's score at an
anchor differs from that at the parent anchor by the length of the edge times the candidate's norm at
most, so the parent's score, or the bounds on it, give bounds on the child's. Only candidates whose
bounds overlap what is wanted there are scored; bounds of the others are handed on.

The first pass wants the best rows of the anchor's own label. Their scores set the windows of the
second pass, which wants rows of other labels. Results are exact: bounds decide what is scored,
never what is found.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

POSITIVES = 5
NEGATIVES = 5
LOWEST, HIGHEST = 80, 100  # percent of the positive's score that a negative's may have
QUANTUM = 256
ANCHOR_VALUES = 1 << 19    # numbers in a block of anchors: 4 MB as doubles, broadcast
TILE_ROWS = 1 << 10        # candidates that go down the tree together

EXACT = float(1 << 53)     # integers up to here are exact as doubles
_SMALL, _LARGE = -(1 << 63), (1 << 63) - 1
NO_SCORE = _SMALL


def quantised(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, v): rows that take part, each component x as floor(QUANTUM x)."""
    v = F.col("v")
    return (rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                        F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull()
                   & F.forall(v, lambda x: F.coalesce(
                       ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
            .select("id", "label", F.transform(v, lambda x: x * float(QUANTUM)).alias("v")))


def whole(v: np.ndarray) -> np.ndarray:
    """floor, after QUANTUM times a component; beyond a double's range its largest number."""
    return np.floor(np.nan_to_num(v, posinf=np.finfo(float).max, neginf=np.finfo(float).min))


def greatest_product(a: np.ndarray, b: np.ndarray) -> float:
    """No inner product of a row of `a` and one of `b` is larger, nor any sum on the way."""
    return float(np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1]))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of `a` with all of `b` as longs, exact.

    Where doubles could round, Python's integers are used; results beyond a long become the
    largest or smallest one.
    """
    if greatest_product(a, b) < EXACT:
        return (a @ b.T).astype(np.int64)
    big = np.array([[int(x) for x in r] for r in a], object).reshape(a.shape)
    other = np.array([[int(x) for x in r] for r in b], object).reshape(b.shape)
    return np.clip(big.dot(other.T), _SMALL, _LARGE).astype(np.int64)


def spanning_tree(v: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels (children, their parents, edge lengths) of a minimum spanning tree with root 0."""
    n = len(v)
    depth, parent = np.zeros(n, np.int64), np.zeros(n, np.int64)
    near, edge = np.full(n, np.inf), np.zeros(n)
    outside = np.ones(n, bool)
    at = 0
    for _ in range(n - 1):
        outside[at] = False
        far = np.sqrt(((v - v[at]) ** 2).sum(1))
        better = outside & (far < near)
        near[better], parent[better] = far[better], at
        at = int(np.where(outside, near, np.inf).argmin())
        if not outside[at]:  # only where distances pass a double's range
            at = int(outside.argmax())
        depth[at], edge[at] = depth[parent[at]] + 1, near[at]
    order = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    return [(c, parent[c], edge[c]) for c in np.split(order, cuts)[1:]]


class Best:
    """The k best of each slot: higher scores first, ties by smaller id."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.limit = np.full(slots, NO_SCORE)  # score of the k-th best

    def add(self, new: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        if not new:
            return
        slot, score, ids = (np.concatenate(x) for x in zip((self.slot, self.score, self.id), *new))
        order = np.lexsort((ids, ~score, slot))  # ~x falls as x rises and cannot overflow
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        last = place == self.k - 1
        self.limit[slot[last]] = score[last]
        kept = place < self.k
        self.slot, self.score, self.id = slot[kept], score[kept], ids[kept]


class Anchors:
    """A block of anchors of one vector length and their tree. `scored` of all `pairs` were scored."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray):
        self.ids, self.labels, self.v = ids, labels, v
        self.levels = spanning_tree(v)
        self.scored = self.pairs = 0

    def down(self, v: np.ndarray, wanted, take) -> None:
        """One tile of candidates through the tree.

        wanted(anchors, low, high) says which pairs may matter; take(anchors, candidates, scores)
        is given the scores of those. Scores too large for doubles narrow no bounds.
        """
        with np.errstate(over="ignore", invalid="ignore"):
            norm = np.sqrt((v ** 2).sum(1))
            narrow = greatest_product(self.v, v) < EXACT
            low, high = np.full((2, len(self.v), len(v)), np.inf)
            low *= -1
            for children, parents, edge in [(np.zeros(1, np.int64), None, None), *self.levels]:
                if parents is not None:
                    reach = edge[:, None] * norm
                    reach += 1e-9 * (reach + np.abs(low[parents]) + np.abs(high[parents])) + 1e-6
                    reach = np.nan_to_num(reach, nan=np.inf, posinf=np.inf)
                    low[children], high[children] = low[parents] - reach, high[parents] + reach
                need = wanted(children, low[children], high[children])
                if parents is None:
                    need = np.ones_like(need)
                self.pairs += need.size
                some, cols = np.flatnonzero(need.any(1)), np.flatnonzero(need.any(0))
                if not len(some):
                    continue
                self.scored += int(need.sum())
                # One product over the rows and columns that hold a wanted pair.
                score = products(self.v[children[some]], v[cols])
                i, j = np.nonzero(need[np.ix_(some, cols)])
                at, candidate, score = children[some[i]], cols[j], score[i, j]
                if narrow:
                    low[at, candidate] = high[at, candidate] = score
                take(at, candidate, score)


def _at_least(score: np.ndarray) -> np.ndarray:
    """As a double that is no larger."""
    f = score.astype(float)
    return f - 1 - 1e-9 * np.abs(f)


class OwnLabel:
    """The best rows of each anchor's own label in one task."""

    def __init__(self, anchors: Anchors, k: int):
        self.anchors, self.best = anchors, Best(len(anchors.ids), k)

    def meet(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray) -> None:
        a, best, new = self.anchors, self.best, []
        mine = (a.labels[:, None] == labels) & (a.ids[:, None] != ids)

        def wanted(rows, low, high):
            return mine[rows] & (high >= _at_least(best.limit[rows])[:, None])

        def take(rows, cols, score):
            good = mine[rows, cols] & (score >= best.limit[rows])
            new.append((rows[good], score[good], ids[cols[good]]))

        a.down(v, wanted, take)
        best.add(new)

    def rows(self) -> list[np.ndarray]:
        return [self.anchors.ids[self.best.slot], self.best.id, self.best.score]


class OtherLabels:
    """The best rows of other labels in each window (anchor, least, most score) in one task."""

    def __init__(self, anchors: Anchors, windows: np.ndarray, k: int):
        # A slot of its own for anchors with fewer windows than others; no score lies in it.
        self.anchors, self.windows = anchors, windows
        self.least, self.most = np.append(windows[:, 1], _LARGE), np.append(windows[:, 2], _SMALL)
        self.best = Best(len(self.least), k)
        order = np.argsort(windows[:, 0], kind="stable")
        of = windows[order, 0]
        place = np.arange(len(order)) - np.searchsorted(of, of)
        self.slots = np.full((len(anchors.ids), int(place.max(initial=0)) + 1), len(windows))
        self.slots[of, place] = order

    def meet(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray) -> None:
        a, best, new = self.anchors, self.best, []
        other = (a.labels[:, None] != labels) & (a.ids[:, None] != ids)
        least = np.maximum(self.least, best.limit)

        def wanted(rows, low, high):
            out = np.zeros(low.shape, bool)
            for slot in self.slots[rows].T:
                top = self.most[slot].astype(float)
                out |= ((high >= _at_least(least[slot])[:, None])
                        & (low <= (top + 1 + 1e-9 * np.abs(top))[:, None]))
            return out & other[rows]

        def take(rows, cols, score):
            for slot in self.slots[rows].T:
                good = other[rows, cols] & (score >= least[slot]) & (score <= self.most[slot])
                new.append((slot[good], score[good], ids[cols[good]]))

        a.down(v, wanted, take)
        best.add(new)

    def rows(self) -> list[np.ndarray]:
        return [self.best.slot, self.best.id, self.best.score]


def _tiles(batches, lengths):
    """(vector length, ids, labels, vectors) of candidates, TILE_ROWS at a time."""
    for b in batches:
        ids, labels = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        lists = b.column(2)
        size = np.diff(lists.offsets.to_numpy())
        for n in sorted(set(size.tolist()) & set(lengths)):
            at = np.flatnonzero(size == n)
            for part in np.array_split(at, -(-len(at) // TILE_ROWS)):
                v = lists.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False)
                yield n, ids[part], labels[part], whole(v.reshape(len(part), n))


def _pass(candidates: DataFrame, blocks: dict, start, names: list[str]) -> DataFrame:
    """Let the candidates meet start(length, anchors) of each vector length, and give out its rows."""
    shared = candidates.sparkSession.sparkContext.broadcast(blocks)

    def run(batches):
        states = {n: start(n, Anchors(*b)) for n, b in shared.value.items()}
        for n, *tile in _tiles(batches, states):
            states[n].meet(*tile)
        for state in states.values():
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in state.rows()], names)

    out = written(candidates.mapInArrow(run, ", ".join(f"{n} long" for n in names)), "scored")
    shared.destroy()
    return out


def _ranked(found: DataFrame, by: str, score: str, row: str, k: int) -> DataFrame:
    """The k best of each `by`; a task gave k of them at most."""
    order = Window.partitionBy(by).orderBy(F.desc(score), row)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _window(score: int) -> tuple[int, int]:
    """Least and most score of a negative: whole numbers between the two percentages."""
    return -(-LOWEST * score // 100), HIGHEST * score // 100


def _anchor_blocks(anchors: DataFrame) -> tuple[DataFrame, int]:
    """Anchors with the number of their block; a repeated id has one row, the smallest."""
    one = written(anchors.groupBy("id").agg(F.min(F.struct("label", "v")).alias("x"))
                  .select("id", "x.label", "x.v"), "anchors")
    total = one.select(F.coalesce(F.sum(F.size("v") + 1), F.lit(0))).first()[0]
    n = -(-total // ANCHOR_VALUES)
    return one.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, n)))), n


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
         id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    The positives of an anchor are the `positives` best other rows of its label, and for each of
    them the negatives are the `negatives` best rows of other labels whose score is LOWEST to
    HIGHEST percent of the positive's. Higher scores come first, ties by smaller id. A positive without
    negatives has no row.

    Rows with a null id, label, vector or component, or one that is not finite, take no part; zero
    and empty vectors do. Only vectors of an anchor's length meet it. Rows with the anchor's id are
    never its partners. An id repeated among the anchors stands for its smallest row; repeated
    rows are as many partners. Scores beyond a long become the largest or smallest one. Other
    columns are not looked at.

    Two passes over the rows for each block of anchors, which is broadcast, at most ANCHOR_VALUES numbers
    or so. A task passes on `negatives` rows per positive at most.
    """
    candidates = quantised(rows, id_col, label_col, vector_col)
    asked, n = _anchor_blocks(quantised(anchors, id_col, label_col, vector_col))
    outs = []
    for number in range(n):
        block = asked.where(F.col("block") == number).select("id", "label", "v").toArrow()
        if not block.num_rows:
            continue
        # The block as one tile for each vector length.
        ids, labels = (block.column(i).to_numpy() for i in (0, 1))
        lists = block.column(2).combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        blocks = {}
        for length in sorted(set(size.tolist())):
            at = np.flatnonzero(size == length)
            v = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
            blocks[length] = ids[at], labels[at], whole(v.reshape(len(at), length))
        found = _pass(candidates, blocks, lambda n, a: OwnLabel(a, positives),
                      ["anchor_id", "positive_id", "positive_score"])
        pairs = _ranked(found, "anchor_id", "positive_score", "positive_id", positives).toArrow()
        place = {int(i): (n, k) for n, b in blocks.items() for k, i in enumerate(b[0])}
        slots = {n: [] for n in blocks}  # (place of the anchor, least, most)
        names = {n: [] for n in blocks}  # (anchor_id, positive_id, positive_score)
        for a, p, s in zip(*(pairs.column(i).to_pylist() for i in range(3))):
            length, at = place[a]
            slots[length].append((at, *_window(s)))
            names[length].append((a, p, s))
        slots = {n: np.array(x, np.int64).reshape(-1, 3) for n, x in slots.items()}
        first = dict(zip(names, np.cumsum([0, *(len(x) for x in names.values())])))
        found = _pass(candidates, blocks, lambda n, a: _Shifted(a, slots[n], negatives, int(first[n])),
                      ["slot", "negative_id", "negative_score"])
        table = rows.sparkSession.createDataFrame(
            pa.table([[i for i in range(sum(map(len, names.values())))],
                      *([x[c] for y in names.values() for x in y] for c in range(3))],
                     schema=pa.schema([(c, pa.int64()) for c in (
                         "slot", "anchor_id", "positive_id", "positive_score")])))
        outs.append(written(_ranked(found, "slot", "negative_score", "negative_id", negatives)
                            .join(table, "slot").select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"),
            "negatives"))
    if not outs:
        return rows.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                "negative_score long")
    return reduce(DataFrame.union, outs)


class _Shifted(OtherLabels):
    """With slots that count on from those of other vector lengths."""

    def __init__(self, anchors, windows, k, first):
        super().__init__(anchors, windows, k)
        self.first = first

    def rows(self):
        slot, ids, score = super().rows()
        return [slot + self.first, ids, score]
