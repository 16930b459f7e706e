"""Phrase collocations by multikey quicksort of suffix pointers.

Every word of a piece of text is the start of a suffix of up to MOST words. A three-way quicksort on
one word at a time puts equal prefixes together: the part equal to the pivot goes one word deeper,
and its size is the count of its prefix. Suffixes meet in one task by their leading two words, so a
part is whole there and is abandoned as soon as it is smaller than the least count.

What cannot matter is left out before suffixes are shuffled. Words are counted first, then pairs of
frequent words, and a suffix ends where its next pair is not frequent. The sets of frequent words and
pairs reach the tasks as hash filters of bounded size, which may let through too much but never lose
anything; final counts come from the sort alone. Suffixes alike are counted together in each task,
and those behind a very frequent pair are spread by all their words, their shorter prefixes being
added up at the end.

Words are 64-bit hashes of language and word until the result is made; two of a million words share
one with a probability of 1 in 37 million. Blobs are sorted numpy arrays as bytes, so that rows are
many to a record.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .runs import partitions
from .words import scramble

MOST = 4               # words of the longest phrase
LEAST = 30             # occurrences of a phrase
TOP = 2_000            # phrases reported for each language
INSIDE = (100, 80)     # dropped if 100 f(longer) >= 80 f
SCALE = 2_000_000      # score of a phrase whose parts occur nowhere else, times two

CHUNK_BYTES = 1 << 20
HELD_ROWS = 1 << 21    # words, pairs or suffixes that a task counts together
BUCKET_ROWS = 1 << 20  # rows of a bucket, which one task sorts
FILTER_BITS = 1 << 27  # of the largest hash filter: 16 MB

WORD, SPACE, BREAK = 0, 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = SPACE
_CLASS[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MORE = np.uint64(0xC2B2AE3D27D4EB4F)


def _hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each of the byte ranges, which follow each other and are not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = stops - starts
    before = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(before, size)
    at = np.repeat(starts, size) + place
    powers = np.full(int(size.max()) + 1, _BASE)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    return scramble(np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * powers[place], before))


class Words:
    """The words of some texts in order: bytes, ranges, hashes, and the number of each one's piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray):
        self.data = _LOWER[data]
        kind = _CLASS[data]
        word = kind == WORD
        # Places where something begins anew: after no word, and at the start of each text.
        new = np.ones(len(data), bool)
        new[1:] = ~word[:-1]
        new[offsets[:-1][offsets[:-1] < len(data)]] = True
        end = np.ones(len(data), bool)
        end[:-1] = ~word[1:] | new[1:]
        self.starts, self.stops = np.flatnonzero(word & new), np.flatnonzero(word & end) + 1
        text = np.searchsorted(offsets, self.starts, side="right") - 1
        self.text = text
        self.piece = np.cumsum(kind == BREAK)[self.starts] + text
        h = scramble(_hashes(self.data, self.starts, self.stops) ^ seeds[text])
        h[h == 0] = 1  # 0 stands for no word
        self.hash = h

    def followed(self, step: int = 1) -> np.ndarray:
        """Whether the word `step` places on belongs to the same piece, for each word."""
        out = np.zeros(len(self.piece), bool)
        if len(out) > step:
            out[:-step] = self.piece[step:] == self.piece[:-step]
        return out

    def strings(self, which: np.ndarray) -> pa.Array:
        starts, size = self.starts[which], self.stops[which] - self.starts[which]
        before = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(starts - before[:-1], size) + np.arange(before[-1])
        return pa.StringArray.from_buffers(len(which), pa.py_buffer(before.astype(np.int32).tobytes()),
                                           pa.py_buffer(self.data[at].tobytes()))


def _chunks(batches):
    """(Words, language of each text) of batches (lang, text) without nulls, a piece at a time."""
    for b in batches:
        if not b.num_rows:
            continue
        langs = b.column(0).dictionary_encode()
        names = langs.dictionary.to_pylist()
        seeds = np.array([_seed(x) for x in names], np.uint64)[langs.indices.to_numpy()]
        text = b.column(1).cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(text):
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1)
            cut = slice(offsets[at], offsets[stop])
            yield (Words(data[cut], offsets[at:stop + 1] - offsets[at], seeds[at:stop]),
                   np.array(names, object)[langs.indices.to_numpy()[at:stop]])
            at = stop


def _seed(lang: str) -> np.uint64:
    """A hash of the language, other than that of a word of the same letters."""
    data = np.frombuffer(f"{lang} ".encode(), np.uint8)
    return _hashes(data, np.zeros(1, np.int64), np.array([len(data)]))[0]


class HashFilter:
    """A set of hashes as bits: what is in it is always found, and a few others are."""

    def __init__(self, words: np.ndarray):
        self.words, self.bits = words, np.uint64(64 * len(words))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes % self.bits
        return self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1) == 1


def hash_filter(hashes: DataFrame, n: int) -> HashFilter:
    """A filter of the `n` values of column h, of 16 bits each but no more than FILTER_BITS."""
    bits = 1 << min(max(10, (16 * n).bit_length()), FILTER_BITS.bit_length() - 1)
    at = F.col("h").bitwiseAND(F.lit(bits - 1))  # the same as modulo of the unsigned value
    filled = (hashes.select(F.shiftright(at, 6).alias("word"),
                            F.expr("shiftleft(1L, CAST(h & 63 AS INT))").alias("bit"))
              .groupBy("word").agg(F.bit_or("bit").alias("bits"))).toArrow()
    words = np.zeros(bits >> 6, np.uint64)
    words[filled["word"].to_numpy()] = filled["bits"].to_numpy().view(np.uint64)
    return HashFilter(words)


def _summed(rows: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns of equal rows as one, in sorted order, with the sum of their n."""
    order = np.lexsort(rows[::-1])
    rows, n = [c[order] for c in rows], n[order]
    new = np.ones(len(n), bool)
    new[1:] = reduce(np.logical_or, (c[1:] != c[:-1] for c in rows))
    first = np.flatnonzero(new)
    return [c[first] for c in rows], np.add.reduceat(n, first) if len(n) else n


class _Held:
    """Rows that a task counts together before it passes them on, HELD_ROWS at a time."""

    def __init__(self, bucket):
        self.bucket, self.parts, self.size = bucket, [], 0

    def add(self, columns: list[np.ndarray]):
        self.parts.append([*columns, np.ones(len(columns[0]), np.int64)])
        self.size += len(columns[0])
        if self.size >= HELD_ROWS:
            yield from self.flush()

    def flush(self):
        """Batches (bucket, blob), a blob being the columns of its rows one after the other."""
        if not self.size:
            return
        *columns, n = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.size = [], 0
        columns, n = _summed(columns, n)
        bucket = self.bucket(columns)
        order = np.argsort(bucket, kind="stable")
        rows = [c[order].astype(np.uint64) for c in (*columns, n)]
        names, first = np.unique(bucket[order], return_index=True)
        blobs = [b"".join(c[a:b].tobytes() for c in rows)
                 for a, b in zip(first, np.append(first[1:], len(order)))]
        yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), pa.array(blobs, pa.binary())],
                                         ["bucket", "blob"])


def _buckets(batches, width: int):
    """The columns of one bucket after the other, from batches (bucket, blob) sorted by bucket."""
    held, bucket = [], None

    def columns():
        return [np.concatenate(c) for c in zip(*held)]

    for b in batches:
        for here, blob in zip(b.column(0).to_pylist(), b.column(1)):
            if here != bucket and held:
                yield columns()
                held = []
            bucket = here
            held.append(np.frombuffer(blob.as_buffer(), np.uint64).reshape(width, -1))
    if held:
        yield columns()


def _dealt(df: DataFrame, buckets: int) -> DataFrame:
    return df.repartition(min(buckets, 4 * partitions(df)), "bucket").sortWithinPartitions("bucket")


def count_words(texts: DataFrame) -> DataFrame:
    """(lang, text) -> (lang, word, h, n), every word."""
    def run(batches):
        for words, langs in _chunks(batches):
            h, first, n = np.unique(words.hash, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs[words.text[first]], pa.string()), words.strings(first),
                 pa.array(h.view(np.int64)), pa.array(n)], ["lang", "word", "h", "n"])

    made = texts.mapInArrow(run, "lang string, word string, h long, n long")
    return made.groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return scramble(a * _MORE + b)


def count_pairs(texts: DataFrame, words: HashFilter, total: int, least: int) -> DataFrame:
    """(h, n) of the pairs of neighbours that occur `least` times, of words in the filter."""
    buckets = max(partitions(texts), -(-total // BUCKET_ROWS))
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def make(batches):
        known = shared.value
        # Buckets follow the hash, so that a sorted run falls into them in order.
        held = _Held(lambda c: (c[0] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32))
        for words, _ in _chunks(batches):
            good = known.has(words.hash)
            both = words.followed() & good
            both[:-1] &= good[1:]
            at = np.flatnonzero(both)
            yield from held.add([pair_hash(words.hash[at], words.hash[at + 1])])
        yield from held.flush()

    def add(batches):
        for h, n in _buckets(batches, 2):
            (h,), n = _summed([h], n)
            good = n >= least
            yield pa.RecordBatch.from_arrays([pa.array(h[good].view(np.int64)),
                                              pa.array(n[good].astype(np.int64))], ["h", "n"])

    made = texts.mapInArrow(make, "bucket long, blob binary")
    return _dealt(made, buckets).mapInArrow(add, "h long, n long")


def quicksort(words: list[np.ndarray], n: np.ndarray, least: int):
    """Yield (a row, depth, count) of the prefixes of 2 words and more that occur `least` times.

    `words` has one column for each place of a suffix, 0 where it has ended, and `n` says how often a
    row stands. Three-way partition by the word at the current depth; the part equal to the pivot
    is a prefix with its count. Smaller parts are abandoned.
    """
    pointers = np.arange(len(n))
    todo = [(0, len(n), 0)]
    while todo:
        low, high, depth = todo.pop()
        part = pointers[low:high]
        if not len(part) or int(n[part].sum()) < least:
            continue
        keys = words[depth][part]
        pivot = np.partition(keys[[0, len(keys) // 2, -1]], 1)[1]
        smaller, larger = keys < pivot, keys > pivot
        same = ~(smaller | larger)
        a, b = low + int(smaller.sum()), high - int(larger.sum())
        pointers[low:high] = np.concatenate([part[smaller], part[same], part[larger]])
        todo += [(low, a, depth), (b, high, depth)]
        count = int(n[pointers[a:b]].sum())
        if not pivot or count < least:  # suffixes that end here, or too few
            continue
        if depth:
            yield int(pointers[a]), depth + 1, count
        if depth + 1 < len(words):
            todo.append((a, b, depth + 1))


def count_phrases(texts: DataFrame, pairs: HashFilter, total: int, hot: np.ndarray, least: int,
                  most: int) -> DataFrame:
    """(w1 .. w_most, n) of the phrases of 2 words or more that occur `least` times; 0 is no word.

    `total` is the number of suffixes to expect, `hot` the sorted hashes of very frequent pairs.
    """
    buckets = max(partitions(texts), -(-total // BUCKET_ROWS))
    shared = texts.sparkSession.sparkContext.broadcast((pairs, hot))
    names = [f"w{i + 1}" for i in range(most)]

    def bucket(c):
        lead = pair_hash(c[0], c[1])
        spread = lead
        for x in c[2:]:
            spread = pair_hash(spread, x)
        return np.where(np.isin(lead, shared.value[1]), spread, lead) % np.uint64(buckets)

    def make(batches):
        known, _ = shared.value
        held = _Held(bucket)
        for words, _ in _chunks(batches):
            h = words.hash
            joined = words.followed()
            at = np.flatnonzero(joined)
            joined[at] = known.has(pair_hash(h[at], h[at + 1]))
            at = np.flatnonzero(joined)
            columns, alive = [h[at], h[at + 1]], np.ones(len(at), bool)
            for step in range(2, most):
                alive &= joined[np.minimum(at + step - 1, len(h) - 1)]
                columns.append(np.where(alive, h[np.minimum(at + step, len(h) - 1)], np.uint64(0)))
            yield from held.add(columns)
        yield from held.flush()

    def sort(batches):
        for *words, n in _buckets(batches, most + 1):
            # Of a spread pair only some rows are here: its prefixes are given out whatever their count.
            some = np.isin(pair_hash(words[0], words[1]), shared.value[1])
            for which, enough in ((~some, least), (some, 1)):
                *here, times = (c[which] for c in (*words, n.astype(np.int64)))
                found = np.array(list(quicksort(here, times, enough)), np.int64).reshape(-1, 3)
                row, depth, count = found.T
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.where(depth > i, w[row], np.uint64(0)).view(np.int64))
                       for i, w in enumerate(here)), pa.array(count)], [*names, "n"])

    made = texts.mapInArrow(make, "bucket long, blob binary")
    sorted_ = _dealt(made, buckets).mapInArrow(
        sort, ", ".join(f"{c} long" for c in names) + ", n long")
    return sorted_.groupBy(*names).agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _scored(phrases: DataFrame, words: list[str]) -> DataFrame:
    """Phrases of one word and more -> those of two and more with l, r and score of their best cut.

    Each cut looks up its two parts by all their words; a phrase has fewer cuts than MOST.
    """
    most = len(words)
    zero = F.lit(0).cast("long")
    depth = sum(F.when(F.col(w) != 0, 1).otherwise(0) for w in words)
    candidates = phrases.where(F.col(words[1]) != 0).withColumn("depth", depth)
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("depth") - 1)))
    array = F.array(*words)
    for i in range(most):
        cuts = (cuts.withColumn(f"first{i}", F.when(F.col("k") > i, F.col(words[i])).otherwise(zero))
                .withColumn(f"rest{i}", F.coalesce(F.get(array, F.col("k") + i), zero)))
    for side, name in (("first", "l"), ("rest", "r")):
        part = phrases.select(*(F.col(w).alias(f"{side}{i}") for i, w in enumerate(words)),
                              F.col("n").alias(name))
        cuts = cuts.join(part, [f"{side}{i}" for i in range(most)])
    score = F.expr(f"(CAST(a AS DECIMAL(20,0)) * {SCALE}) DIV (CAST(l AS DECIMAL(20,0)) + r)")
    return (cuts.withColumnRenamed("n", "a").withColumn("score", score)
            .groupBy(*words, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select(*words, "a", "cut.score", "cut.l", "cut.r"))


def _outgrown(phrases: DataFrame, words: list[str]) -> DataFrame:
    """(words, longer): the largest count of a longer phrase that each phrase lies in."""
    most = len(words)
    zero = F.lit(0).cast("long")
    parts = []
    array = F.array(*words)
    for size in range(2, most):
        for at in range(most - size + 1):
            part = F.struct(*(F.get(array, F.lit(at + i)).alias(words[i]) if i < size else zero.alias(words[i])
                              for i in range(most)))
            # A longer phrase: its last word here is one, and so is another before or after.
            longer = (F.col(words[at + size - 1]) != 0) & (
                F.lit(at > 0) | (F.col(words[min(at + size, most - 1)]) != 0) & F.lit(at + size < most))
            parts.append(F.when(longer, part))
    inside = phrases.select(F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("p"), "n")
    return inside.groupBy(*(F.col(f"p.{w}").alias(w) for w in words)).agg(F.max("n").alias("longer"))


def mined(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
          most: int = MOST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    Texts, with A-Z in lower case, are split at . , ; : ! ? and line ends into pieces, and those at
    blanks and tabs into words; a phrase is 2 to `most` words of a piece that follow each other.
    `a` counts its occurrences, overlapping ones too, `n` all words of the language, `l` and `r` the
    two parts of the cut that scores lowest: floor(SCALE a / (l + r)), ties by the shorter first part.
    Phrases that occur `least` times count, unless they lie inside a longer one that has 80 percent of
    their occurrences. The `top` first by score, a and phrase (byte order) are reported.

    A null text counts as empty, a null language as `und`. Rows are counted as often as they occur.
    Other columns are not looked at.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    names = [f"w{i + 1}" for i in range(most)]
    words = written(count_words(texts), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= least)
    known, occurrences = frequent.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    pairs = written(count_pairs(texts, hash_filter(frequent, known), occurrences, least), "pairs")
    known, occurrences = pairs.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # Pairs of more than a quarter of a task's share: fewer than four times the tasks.
    hot = pairs.where(F.col("n") > occurrences / (4 * partitions(docs))).select("h").toArrow()
    hot = np.sort(hot["h"].to_numpy().view(np.uint64))
    phrases = written(count_phrases(texts, hash_filter(pairs, known), occurrences, hot, least, most),
                      "phrases")
    single = frequent.select(F.col("h").alias(names[0]),
                             *(F.lit(0).cast("long").alias(w) for w in names[1:]), "n")
    scored = _scored(phrases.unionByName(single), names)
    many, few = INSIDE
    kept = scored
    if most > 2:
        kept = (scored.join(_outgrown(phrases, names), names, "left")
                .where(F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * many
                                                   < F.col("a").cast("decimal(20,0)") * few)))
    for w in names:
        word = frequent.select(F.col("h").alias(w), F.col("word").alias(f"{w}_word"),
                               *([F.col("lang")] if w == names[0] else []))
        kept = kept.join(word, w, "inner" if w == names[0] else "left")
    phrase = F.concat_ws(" ", *(f"{w}_word" for w in names))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = (kept.select("lang", phrase.alias("phrase"), "a", "l", "r", "score")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
