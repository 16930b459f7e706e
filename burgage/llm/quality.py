"""Quality classifier: random Fourier features of document statistics, ridge, isotonic calibration.

Tasks compute a few statistics of each text. Random Fourier features of the standardised
statistics approximate a Gaussian kernel; tasks sum their part of the normal equations, Spark adds
the parts up, and the driver solves one system of FEATURES + 1 unknowns. Raw scores of the labelled
rows, counted in bins, are calibrated by pooling adjacent violators.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .words import text_chunks, word_hashes, word_table

FEATURES = 256      # random Fourier features
WIDTH = 4.0         # of the Gaussian kernel, in standard deviations of a statistic
RIDGE = 1e-3        # per labelled row
BINS = 2_048        # of raw scores, for the calibration
LOW, HIGH = -0.5, 1.5
SEED = 20_240
THRESHOLD = 0.7     # fixed by the contract

STATISTICS = ("log_chars", "log_words", "word_length", "upper", "digit", "mark", "exclaim", "symbol",
              "blank", "breaks", "distinct_words", "distinct_pairs", "distinct_lines",
              "log_line_length", "other")
UPPER, LOWER, DIGIT, MARK, EXCLAIM, SYMBOL, BREAK, BLANK, OTHER = range(9)


def category_table() -> np.ndarray:
    """For each code point, what sort of character it is."""
    def sort(i: int) -> int:
        c = chr(i)
        if c == "\n":
            return BREAK
        if c in "!?":
            return EXCLAIM
        if c in ".,;:'\"-()":
            return MARK
        kind = unicodedata.category(c)
        return {"Lu": UPPER, "Lt": UPPER, "Zs": BLANK}.get(kind) or (
            LOWER if kind[0] == "L" else DIGIT if kind[0] == "N" else
            SYMBOL if kind[0] in "PS" else OTHER)

    return np.fromiter(map(sort, range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)


def _distinct(doc: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each document has."""
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    return np.bincount(d[new], minlength=n)


def statistics(texts: list[str | None], sorts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each text; null and empty texts have zeros throughout."""
    texts = [t or "" for t in texts]
    n = len(texts)
    chars = np.array([len(t) for t in texts], np.float64)
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(n), chars.astype(np.int64))
    sort = np.bincount(doc * 9 + sorts[code], minlength=n * 9).reshape(n, 9).astype(np.float64)
    words, before = word_hashes(texts, table)
    count = np.diff(before).astype(np.float64)
    who = np.repeat(np.arange(n), np.diff(before))
    pair = who[1:] == who[:-1]
    pairs = np.bincount(who[1:][pair], minlength=n)
    lines = [[x for x in t.split("\n") if x] for t in texts]
    n_lines = np.array([len(x) for x in lines], np.float64)
    distinct_lines = np.array([len(set(x)) for x in lines], np.float64)
    part = lambda a, b: a / np.maximum(b, 1)
    letters = sort[:, UPPER] + sort[:, LOWER]
    return np.stack([
        np.log1p(chars), np.log1p(count), part(letters + sort[:, DIGIT], count),
        part(sort[:, UPPER], letters), part(sort[:, DIGIT], chars), part(sort[:, MARK], chars),
        part(sort[:, EXCLAIM], chars), part(sort[:, SYMBOL], chars), part(sort[:, BLANK], chars),
        part(sort[:, BREAK], chars), part(_distinct(who, words, n), count),
        part(_distinct(who[1:][pair], words[1:][pair] * np.uint64(3) + words[:-1][pair], n), pairs),
        part(distinct_lines, n_lines), np.log1p(part(chars, n_lines)), part(sort[:, OTHER], chars),
    ], axis=1)


def statistics_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, stats) for each row, written to the shared folder: texts are read once."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType),
                           T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def run(batches):
        sorts, table = category_table(), word_table()
        for b in batches:
            texts = b.column(1).to_pylist()
            rows = [statistics(texts[at:stop], sorts, table) for at, stop in text_chunks(texts)]
            flat = np.concatenate(rows).ravel() if rows else np.zeros(0)
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * len(STATISTICS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                ["doc_id", "stats"])

    return written(docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema), "stats")


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of rows of statistics, and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.standard_normal((x.shape[1], FEATURES)) / WIDTH
    shift = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.cos(np.clip((x - mean) / scale, -8, 8) @ w + shift) * np.sqrt(2 / FEATURES)
    return np.concatenate([z, np.ones((len(x), 1))], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def isotonic(at: np.ndarray, value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and values of the blocks of the least-squares rising fit, pooled from the left."""
    blocks: list[list[float]] = []
    for x, y, w in zip(at, value, weight):
        blocks.append([x * w, y * w, w])
        while len(blocks) > 1 and (blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]):
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    xs, ys, ws = np.array(blocks).T
    return xs / ws, ys / ws


def fit(stats: DataFrame, labels: DataFrame, learn: Column, label_col: str) -> dict | None:
    """The model from all rows of `labels` where `learn` holds; None if there are none.

    Each task hands on its part of the normal equations as (row, column, sum); what reaches the
    driver is their sum and BINS counts, whatever the number of rows.
    """
    n = len(STATISTICS)
    moments = stats.select(
        *(F.avg(F.col("stats")[i]) for i in range(n)),
        *(F.stddev_pop(F.col("stats")[i]) for i in range(n))).first()
    if moments[0] is None:
        return None
    mean, scale = np.array(moments[:n]), np.array(moments[n:])
    scale[scale < 1e-9] = 1.0
    rows = written(labels.where(learn & F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
                   .select("doc_id", F.when(F.col(label_col) > 0, 1.0).otherwise(0.0).alias("y"))
                   .join(stats, "doc_id").select("y", "stats"), "labelled")
    size = FEATURES + 1

    def normal(batches):
        a, b, seen = np.zeros((size, size)), np.zeros(size), 0
        for batch in batches:
            y, x = batch.column(0).to_numpy(), batch.column(1)
            for at in range(0, len(y), 4_096):
                z = fourier(_matrix(x[at:at + 4_096]), mean, scale)
                a += z.T @ z
                b += z.T @ y[at:at + 4_096]
            seen += len(y)
        if seen:
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(i, np.arange(size))), pa.array(np.append(j, np.full(size, size))),
                 pa.array(np.append(a[i, j], b))], ["i", "j", "v"])

    sums = rows.mapInArrow(normal, "i long, j long, v double").groupBy("i", "j").agg(
        F.sum("v").alias("v")).toPandas()
    if sums.empty:
        return None
    both = np.zeros((size, size + 1))
    both[sums["i"], sums["j"]] = sums["v"]
    a, b = both[:, :size], both[:, size]
    a = a + np.triu(a, 1).T
    total = a[-1, -1]
    ridge = np.full(size, RIDGE * total + 1e-6)
    ridge[-1] = 1e-9
    weights = np.linalg.solve(a + np.diag(ridge), b)

    def binned(batches):
        count = np.zeros((BINS, 2))
        for batch in batches:
            y = batch.column(0).to_numpy()
            raw = fourier(_matrix(batch.column(1)), mean, scale) @ weights
            at = np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int64)
            count += np.stack([np.bincount(at, minlength=BINS),
                               np.bincount(at, weights=y, minlength=BINS)], axis=1)
        at = np.flatnonzero(count[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at, 0]), pa.array(count[at, 1])],
                                         ["bin", "n", "good"])

    bins = rows.mapInArrow(binned, "bin long, n double, good double").groupBy("bin").agg(
        F.sum("n").alias("n"), F.sum("good").alias("good")).toPandas().sort_values("bin")
    centre = LOW + (bins["bin"].to_numpy() + 0.5) * (HIGH - LOW) / BINS
    xs, ys = isotonic(centre, (bins["good"] / bins["n"]).to_numpy(), bins["n"].to_numpy())
    return {"mean": mean, "scale": scale, "weights": weights, "xs": xs, "ys": ys}


def score(stats: DataFrame, model: dict | None) -> DataFrame:
    """`stats` (doc_id, stats) -> (doc_id, score); 0.5 where there was nothing to learn from."""
    if model is None:
        return stats.select("doc_id", F.lit(0.5).alias("score"))

    def run(batches):
        for b in batches:
            raw = fourier(_matrix(b.column(1)), model["mean"], model["scale"]) @ model["weights"]
            found = np.clip(np.interp(raw, model["xs"], model["ys"]), 0, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found)], ["doc_id", "score"])

    schema = T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return stats.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality",
             threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) for each row of `docs`; `learn` is a condition on labels' doc_id.

    Null and empty texts are scored by their statistics, all zero. Repeated label rows count as
    often as they occur, null labels and ids not at all; labels above 0 are good. Repeated
    documents are scored each. Other columns are not looked at.
    """
    stats = statistics_table(docs, id_col, text_col)
    model = fit(stats, labels, learn, label_col)
    return score(stats, model).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
