"""SimHash near-duplicates by anchor points of a covering code.

The 64 bits of a fingerprint are cut into blocks of 23, 23 and 18 bits. Two fingerprints that
differ in at most 4 bits differ in at most 1, 1 or 0 bits of the first, second or third block
(otherwise they would differ in 2 + 2 + 1 = 5). In a 23-bit block the anchors are the words of
the perfect binary Golay code, whose covering radius is 3: each fingerprint is at home at one
anchor and is copied to every anchor within 3 + 1 bits, six at most. In the third block every
value is its own anchor, with radius 0. So of any two fingerprints to be linked, one meets the
other at its home. Only fingerprints that meet at an anchor are compared.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .components import connected
from .runs import key_runs, merge_labels, unused

SHINGLE_WORDS = 4   # fixed by the contract
SEED = 42           # fixed by the contract
MAX_BITS = 4        # fixed by the contract

BLOCKS = ((0, 23), (23, 23), (46, 18))  # first bit, width
GOLAY = 0b101011100011                  # generator polynomial of the (23, 12) Golay code
RADIUS = 3                              # its covering radius
HOME_ROWS = 4_096                       # at most so many residents of an anchor in a task's run,
VISITOR_ROWS = 65_536                   # and so many visitors; more of either are split


def word_bytes(text: bytes | None) -> list[bytes]:
    """Words between ASCII blanks, with A-Z lower-cased; other letters stay."""
    return text.lower().split() if text else []


def shingle_hashes(words: list[bytes], size: int, seed: int) -> np.ndarray:
    """XXH64 of each shingle; of all words together where there are fewer than `size`."""
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, seed)] if words else [], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-size]]).tolist()
    stops = (ends[size - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, stops)),
                       np.uint64, len(starts))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """For each of the 64 bits, how many hashes have it set."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(0, dtype=np.int64)
    return total


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of 64 bits to unsigned fingerprints."""
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)[..., 0]


def fingerprint(text: bytes | None, size: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    hashes = shingle_hashes(word_bytes(text), size, seed)
    return int(pack(2 * bit_counts(hashes) > len(hashes)))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int, seed: int) -> DataFrame:
    """(doc, fp) for each row; texts without words have fingerprint zero."""
    def run(batches):
        for b in batches:
            found = [fingerprint(t.as_py(), size, seed) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc"),
                       F.col(text_col).cast("binary").alias("text")
                       ).mapInArrow(run, "doc long, fp long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator polynomial."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GOLAY << (bit - 11), 0)
    return rest


def golay_cover(extra: int) -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the pattern that leads home, and a padded list of those within radius + extra."""
    patterns = np.array([sum(1 << b for b in bits) for n in range(RADIUS + extra + 1)
                         for bits in combinations(range(23), n)], np.int64)
    home = np.zeros(2048, np.int64)
    near: list[list[int]] = [[] for _ in range(2048)]
    for p, s in zip(patterns.tolist(), _syndromes(patterns).tolist()):
        if p.bit_count() <= RADIUS:
            home[s] = p
        near[s].append(p)
    width = max(map(len, near))
    table = np.array([n + [-1] * (width - len(n)) for n in near], np.int64)
    return home, table


def at_anchors(prints: DataFrame) -> DataFrame:
    """fp -> (block, anchor, home, fp): once at home, once at each anchor within reach."""
    def run(batches):
        home, near = golay_cover(1)
        for b in batches:
            fp = b.column(0).to_numpy()
            bits = fp.view(np.uint64)
            out = []
            for block, (first, width) in enumerate(BLOCKS):
                value = (bits >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64)
                if width < 23:  # each value is an anchor, and fingerprints stay at home
                    met, who = value[:, None], np.zeros((len(fp), 1), np.int64)
                    own = value
                else:
                    s = _syndromes(value)
                    who = near[s]
                    met, own = value[:, None] ^ who, value ^ home[s]
                row, col = np.nonzero(who >= 0)
                anchor = met[row, col]
                out.append((np.full(len(row), block, np.int32), anchor,
                            anchor == own[row], fp[row]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([o[i] for o in out])) for i in range(4)],
                ["block", "anchor", "home", "fp"])

    return prints.select("fp").mapInArrow(run, "block int, anchor long, home boolean, fp long")


def links_at_anchors(met: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) that keep together what is within `max_bits`, as stars, not as all pairs.

    Anchors with many residents or visitors are split into cells: a resident goes to each cell
    row of its anchor, a visitor to each column, so every pair meets in one cell of bounded size.
    The sizes are counted before, one row per anchor, and joined.
    """
    sizes = (met.groupBy("block", "anchor")
             .agg(F.count_if("home").alias("homes"), F.count("*").alias("visitors"))
             .where("homes > 0 and visitors > 1")
             .select("block", "anchor",
                     F.ceil(F.col("homes") / HOME_ROWS).cast("int").alias("rows"),
                     F.ceil(F.col("visitors") / VISITOR_ROWS).cast("int").alias("cols")))
    own = F.xxhash64("fp", F.lit(1))
    placed = met.join(sizes, ["block", "anchor"])
    cells = placed.select(
        "block", "anchor", "fp", "home",
        F.pmod(own, "rows").cast("int").alias("row"), F.pmod(own, "cols").cast("int").alias("col"),
        "rows", "cols")
    residents = cells.where("home").select(
        "block", "anchor", "row", F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("col"),
        F.lit(True).alias("home"), "fp")
    visitors = cells.select(
        "block", "anchor", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"), "col",
        F.lit(False).alias("home"), "fp")
    keys = ["block", "anchor", "row", "col"]
    dealt = residents.union(visitors).repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        a, b, n = [], [], 0
        for _, g in key_runs(batches, keys):
            fp, home = g["fp"], g["home"].astype(bool)
            here, there = fp[home].view(np.uint64), fp[~home].view(np.uint64)
            if not len(here) or len(there) < 2:
                continue
            nodes = np.unique(fp)
            where = np.searchsorted(nodes, fp[~home])
            at = np.searchsorted(nodes, fp[home])
            labels = np.arange(len(nodes))
            step = max(1, 1_000_000 // len(there))
            for i in range(0, len(here), step):
                close = np.bitwise_count(here[i:i + step, None] ^ there) <= max_bits
                others = close & (where != at[i:i + step, None])
                for j in np.flatnonzero(others.any(1)):
                    merge_labels(labels, np.append(where[others[j]], at[i + j]))
            moved = labels != np.arange(len(nodes))
            if moved.any():
                a.append(nodes[moved])
                b.append(nodes[labels[moved]])
                n += int(moved.sum())
            if n > 100_000:
                yield pa.RecordBatch.from_arrays([np.concatenate(a), np.concatenate(b)], ["a", "b"])
                a, b, n = [], [], 0
        if n:
            yield pa.RecordBatch.from_arrays([np.concatenate(a), np.concatenate(b)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = SHINGLE_WORDS, seed: int = SEED,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of `docs`.

    `max_bits` may be 0 to 4, which the three blocks are made for. Repeated rows come out as
    often as they went in. A null or empty text has no words, hence fingerprint zero, and is
    linked like any other. A null id comes out as null; a component's id is its smallest id that
    is not null, or null if it has none. Other columns are not looked at.

    Copies have one fingerprint and are one node: only different fingerprints are compared. Both
    tables of the last join are written ones, so adaptive execution can split a frequent
    fingerprint.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("max_bits must be 0 to 4")
    prints = written(fingerprints(docs, id_col, text_col, size, seed), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc").alias("first")), "nodes")
    roots = connected(links_at_anchors(written(at_anchors(nodes), "anchors"), max_bits))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(rooted.join(smallest, "root").select("fp", "component_id"), "components")
    return prints.join(named, "fp").select(
        F.col("doc").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of `docs` with one document of each component left: that with the smallest id.

    Rows that repeat both id and text are reduced to one, any of
    them. Rows that share a kept id but not the text all stay, since nothing says which
    of them the id means. Rows without an id cannot be told from one another and all stay.
    """
    found = near_duplicates(docs, id_col, text_col, **how)
    stay = found.select(F.col("component_id").alias(id_col)).where(F.col(id_col).isNotNull()).distinct()
    key = unused(docs.columns, "text_hash")
    kept = docs.join(stay, id_col, "left_semi").withColumn(key, F.xxhash64(F.col(text_col).cast("string")))
    return (kept.dropDuplicates([id_col, key]).drop(key)
            .unionByName(docs.where(F.col(id_col).isNull())).select(docs.columns))
