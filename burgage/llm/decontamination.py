"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact verification.

Every document is covered by windows of about an item's size, each with a 64-bit SimHash of its
five-word shingles. A window's fingerprint is cut into four blocks of 16 bits. Fingerprints within
RADIUS bits of an item's differ in at most a quarter of them in some block, so each block has an
index of all its values that near to an item's: whatever is within the radius is found. Candidates
are then measured by the weighted Jaccard similarity of shingle counts, at every place and length of
a passage around the window.

Windows start at every `step`-th shingle and are short enough that one lies wholly inside any
passage with four fifths of an item's shingles; items are fingerprinted at the offsets at which
such a window can lie. A whole copy of an item hence has a window with distance zero.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .simhash import pack
from .words import SHINGLE_WORDS, shingles, text_chunks, word_hashes, word_table

SIMILARITY = 0.8
RADIUS = 12
BLOCKS = 4
ITEMS_PER_PASS = 1_000  # their block indexes take about 100 MB in a task; more items, more passes
BYTES_PER_PASS = 32 << 20


def window_shape(n: int) -> tuple[int, int]:
    """(shingles of a window, step) for an item of `n` shingles; few different shapes in all."""
    step = 1 if n < 10 else 2 if n < 24 else 4
    most = max(1, int(SIMILARITY * n) - step + 1)
    size = step * max(1, most // step)
    grain = step
    while size // grain > 8:  # round down to 4..8 multiples of a power of two
        grain *= 2
    return max(step, size // grain * grain), step


NARROW = 255  # shingles of a window up to which a bit is counted in a byte


def running_bits(hashes: np.ndarray, step: int, narrow: bool = False) -> np.ndarray:
    """Row i: how often each of the 64 bits is set in the first i * step hashes, modulo 2^32.

    With `narrow`, eight bits share a number of 64 bits, a byte each. What overflows a byte goes to the
    next, and is taken back in the difference of two rows, as long as that has no more than NARROW."""
    n = len(hashes) // step
    bits = np.unpackbits(hashes[:n * step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    if narrow:
        bits = bits.view(np.uint64)
        bits = sum((bits[i::step] for i in range(1, step)), bits[::step])
        total = np.zeros((n + 1, 8), np.uint64)
        np.cumsum(bits, axis=0, out=total[1:])
        return total
    if step > 1:
        bits = bits.reshape(n, step, 64).sum(1, dtype=np.uint8)
    total = np.zeros((n + 1, 64), np.uint32)
    np.cumsum(bits, axis=0, dtype=np.uint32, out=total[1:])
    return total


def window_prints(running: np.ndarray, size: int, step: int) -> np.ndarray:
    """Fingerprint of the `size` shingles from every `step`-th on."""
    w = size // step
    counts = running[w:] - running[:-w]
    return pack((counts.view(np.uint8) if running.dtype == np.uint64 else counts) > size // 2)


class Index:
    """Fingerprints of one shape, by each block value near to one of them."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        near = np.array([sum(1 << b for b in bits) for n in range(RADIUS // BLOCKS + 1)
                         for bits in combinations(range(16), n)])
        self.tables = []
        for b in range(BLOCKS):
            value = (prints >> np.uint64(16 * b) & np.uint64(0xFFFF)).astype(np.int64)
            values = (value[:, None] ^ near).ravel()
            order = np.argsort(values, kind="stable")
            items = (order // len(near)).astype(np.int32)
            self.tables.append((np.searchsorted(values[order], np.arange(65_537)), items, prints[items]))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in `prints`, position in the index) of all pairs within the radius."""
        a, b = [], []
        for block, (first, items, theirs) in enumerate(self.tables):
            value = (prints >> np.uint64(16 * block) & np.uint64(0xFFFF)).astype(np.int64)
            n = first[value + 1] - first[value]
            upto = np.cumsum(n)
            place = np.repeat(first[value] - upto + n, n)
            place += np.arange(len(place))
            good = np.flatnonzero(np.bitwise_count(np.repeat(prints, n) ^ theirs[place]) <= RADIUS)
            a.append(np.searchsorted(upto, good, side="right"))
            b.append(items[place[good]])
        pairs = np.unique(np.concatenate(a) << 32 | np.concatenate(b).astype(np.int64))
        return pairs >> 32, pairs & 0xFFFFFFFF


class Items:
    """Items of one pass, ready to be looked up: indexes by shape, and shingle counts."""

    def __init__(self, items: list[tuple[int, str]]):
        table = word_table()
        self.ids, self.hashes = [], []
        shapes = defaultdict(lambda: ([], [], []))
        for item, text in items:
            h, _ = shingles(*word_hashes([text], table))
            if not len(h):
                continue
            number = len(self.ids)
            self.ids.append(item)
            self.hashes.append(h)
            size, step = window_shape(len(h))
            room = max(0, len(h) - size)  # the first and the last places a window can have
            for at in sorted({*range(min(step, room + 1)), *range(max(0, room - step + 1), room + 1)}):
                prints, who, offset = shapes[size, step]
                prints.append(window_prints(running_bits(h[at:at + size], 1), size, 1)[0])
                who.append(number)
                offset.append(at)
        self.shapes = {k: (Index(np.array(p, np.uint64)), np.array(w), np.array(o))
                       for k, (p, w, o) in shapes.items()}
        self.counts = [Counter(h.tolist()) for h in self.hashes]

    def best_place(self, hashes: np.ndarray, number: int, at: int) -> tuple[float, int, int]:
        """(similarity, start, shingles) of the stretch near `at` most like the item.

        Stretches start within about a quarter of the item's length from `at`, which is as much as
        a passage can have put in, and have any length that can reach SIMILARITY. Of equally good
        ones the nearest start counts.
        """
        n, counts = len(self.hashes[number]), self.counts[number]
        slack, least, most = n // 4 + 4, int(SIMILARITY * n), int(n / SIMILARITY) + 1
        low, high = max(0, at - slack), min(len(hashes), at + slack + most)
        part = hashes[low:high].tolist()
        best = (0.0, 0, 0)
        if sum(min(c, counts.get(h, 0)) for h, c in Counter(part).items()) < least:
            return best
        starts = range(low, min(at + slack, len(hashes) - 1) + 1)
        for start in sorted(starts, key=lambda s: (abs(s - at), s)):
            shared, seen = 0, {}
            for size, h in enumerate(part[start - low:start - low + most], 1):
                have = counts.get(h, 0)
                if have:
                    seen[h] = seen.get(h, 0) + 1
                    shared += seen[h] <= have
                if size >= least:
                    value = shared / (size + n - shared)
                    if value > best[0]:
                        best = (value, start, size)
            if best[0] == 1.0:
                break
        return best

    def found(self, hashes: np.ndarray, before: np.ndarray) -> list[tuple[int, int, float, int, int]]:
        """(text, item, similarity, start, shingles) of the best passage of each item in each text."""
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        tried = set()
        kinds = {(step, size <= NARROW) for size, step in self.shapes}
        running = {kind: running_bits(hashes, *kind) for kind in kinds}
        for (size, step), (index, who, offset) in self.shapes.items():
            prints = window_prints(running[step, size <= NARROW], size, step)
            start = np.arange(len(prints)) * step
            doc = np.searchsorted(before, start, side="right") - 1
            inside = np.flatnonzero(start + size <= before[doc + 1])
            at, met = index.near(prints[inside])
            at = inside[at]
            for d, s, m in zip(doc[at].tolist(), start[at].tolist(), met.tolist()):
                number, place = int(who[m]), s - int(before[d]) - int(offset[m])
                if (d, number, place) in tried or best.get((d, number), (0,))[0] == 1.0:
                    continue
                tried.add((d, number, place))
                got = self.best_place(hashes[before[d]:before[d + 1]], number, place)
                if got[0] >= SIMILARITY and (got[0], -got[1]) > (
                        lambda b: (b[0], -b[1]))(best.get((d, number), (0.0, 0))):
                    best[d, number] = got
        return [(d, self.ids[number], *got) for (d, number), got in best.items()]


def _passes(benchmark: DataFrame, id_col: str, text_col: str) -> list[DataFrame]:
    """The items in groups, each small enough to be broadcast."""
    rows = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text")
                            ).where("item is not null and text is not null")
    n, size = rows.select(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    groups = max(1, -(-n // ITEMS_PER_PASS), -(-size // BYTES_PER_PASS))
    group = F.pmod(F.xxhash64("item"), F.lit(groups))
    return [rows.where(group == i) for i in range(groups)]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): the best passage of each item in each row.

    Rows of `docs` are judged one by one, so repeated rows, repeated ids and null ids come out as
    often as they go in. Null and empty texts hold nothing. Items with fewer than five words have
    no shingle and match nothing; items with a null id or text are left out; a repeated item
    matches once per row it has. Of equally good passages the first one counts.

    No shuffle: the items are broadcast in groups of bounded count and bytes, one pass over the
    documents for each. A task holds the hashes of one chunk of texts at a time.
    """
    kind = docs.schema[id_col].dataType
    item_kind = benchmark.schema[item_col].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("item_id", item_kind),
        T.StructField("similarity", T.DoubleType()), T.StructField("first_word", T.LongType()),
        T.StructField("n_words", T.LongType())])
    rows = docs.select(id_col, F.col(text_col).cast("string"))
    kinds = [to_arrow_type(item_kind), pa.float64(), pa.int64(), pa.int64()]
    out = None
    for group in _passes(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in group.collect()])

        def run(batches, shared=shared):
            items, table = Items(shared.value), word_table()
            for b in batches:
                ids, texts = b.column(0), b.column(1).to_pylist()
                who, rest = [], []
                for at, stop in text_chunks(texts):
                    for d, *found in items.found(*shingles(*word_hashes(texts[at:stop], table))):
                        who.append(at + d)
                        rest.append(found)
                cols = [list(c) for c in zip(*rest)] or [[], [], [], []]
                cols[3] = [n + SHINGLE_WORDS - 1 for n in cols[3]]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(who, pa.int64())),
                     *(pa.array(c, k) for c, k in zip(cols, kinds))],
                    ["doc_id", "item_id", "similarity", "first_word", "n_words"])

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out


def without_benchmark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that hold no item. One whose id is null cannot be named, and stays."""
    found = contaminated(docs, benchmark, id_col).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(found, id_col, "left_anti").select(docs.columns)
