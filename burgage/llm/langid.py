"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting and scoring work on whole Arrow batches in numpy: the texts of a batch become one array
of code points, n-grams are hashes of neighbouring ones, and scores are sums of rows of the
log-probability matrix over a document's n-grams.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .runs import unused
from .words import text_chunks

BUCKETS = 1 << 16   # hashed n-grams; the matrix has so many columns
ORDERS = (1, 2, 3)  # lengths of the n-grams
SMOOTHING = 0.5     # added to each count
BLOCK_LANGUAGES = 256  # of a matrix, which is broadcast: 67 MB as float32; more are several matrices
DENSE_LANGUAGES = 64   # of a batch that are counted in full vectors

_CHUNK = 1 << 19    # n-grams scored at a time
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)  # odd multipliers


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool,
                       sys.maxunicode + 1)


def grams(texts: list[str | None], letters: np.ndarray,
          buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document position, bucket) of each n-gram, in document order, and whether texts have letters.

    Runs of characters other than letters count as one blank; an n-gram has a letter at least.
    """
    lowered = [(t or "").lower() for t in texts]
    code = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    letter = letters[code]
    has = np.zeros(len(texts), bool)
    has[doc[letter]] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1]          # one blank after each word
    first = np.ones(len(code), bool)
    first[1:] = doc[1:] != doc[:-1]  # and one before the text
    keep |= first & ~letter
    code = np.where(letter, code, 32).astype(np.uint64)[keep]
    doc, letter = doc[keep], letter[keep]
    who, what = [], []
    for n in ORDERS:
        m = max(0, len(code) - n + 1)
        h = np.full(m, n * 0x27D4EB2F165667C5 % (1 << 64), np.uint64)
        some = np.zeros(m, bool)
        for i in range(n):
            h = (h ^ code[i:i + m]) * np.uint64(_MIX[i])
            h ^= h >> np.uint64(29)
            some |= letter[i:i + m]
        some &= doc[:m] == doc[n - 1:n - 1 + m]
        who.append(doc[:m][some])
        what.append((h[some] >> np.uint64(20)) % np.uint64(buckets))
    who, what = np.concatenate(who), np.concatenate(what).astype(np.int64)
    order = np.argsort(who, kind="stable")
    return who[order], what[order], has


def train(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang",
          buckets: int = BUCKETS) -> dict | None:
    """Counts over all rows where `learn` holds and the language is known, as a model; None if none.

    Tasks count into one vector per language, or by single buckets where a batch has very many
    languages; Spark adds up the buckets that occur and writes the sums. Up to BLOCK_LANGUAGES languages
    are one matrix. More are scored block by block, each read from the sums when its turn comes,
    so neither driver nor tasks ever hold more than one.
    """
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def sparse(names, keys, n):
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()).take(pa.array(keys // (buckets + 1))), pa.array(keys % (buckets + 1)),
             pa.array(n.astype(np.int64))], ["lang", "bucket", "n"])

    def run(batches):
        letters = letter_table()
        total: dict[str, np.ndarray] = {}  # the last place counts documents

        def flush():
            for name, sums in total.items():
                at = np.flatnonzero(sums)
                yield sparse([name], at, sums[at])
            total.clear()

        for b in batches:
            langs = b.column(0).dictionary_encode()
            names, code = langs.dictionary.to_pylist(), langs.indices.to_numpy().astype(np.int64)
            texts = b.column(1).to_pylist()
            for at, stop in text_chunks(texts):
                who, what, has = grams(texts[at:stop], letters, buckets)
                here = code[at:stop]
                if len(names) > DENSE_LANGUAGES:
                    keys = np.concatenate([here[who] * (buckets + 1) + what, here[has] * (buckets + 1) + buckets])
                    yield sparse(names, *np.unique(keys, return_counts=True))
                    continue
                cells = np.bincount(here[who] * buckets + what, minlength=len(names) * buckets)
                seen = np.bincount(here[has], minlength=len(names))
                for i, name in enumerate(names):
                    if seen[i]:
                        sums = total.setdefault(name, np.zeros(buckets + 1, np.int64))
                        sums[:-1] += cells[i * buckets:(i + 1) * buckets]
                        sums[-1] += seen[i]
            if len(total) > DENSE_LANGUAGES:
                yield from flush()
        yield from flush()

    counted = written(rows.mapInArrow(run, "lang string, bucket long, n long").groupBy(
        "lang", "bucket").agg(F.sum("n").alias("n")), "grams")
    names = counted.where(F.col("bucket") == buckets).select("lang", F.col("n").alias("documents"))
    n, documents = names.agg(F.count("*"), F.sum("documents")).first()
    if not n:
        return None
    model = {"buckets": buckets, "documents": documents, "blocks": -(-n // BLOCK_LANGUAGES)}
    if model["blocks"] == 1:
        return model | _matrix(counted.toArrow(), model)
    place = F.row_number().over(Window.orderBy("lang")) - 1  # a row per language
    blocks = written(names.select("lang", F.floor(place / BLOCK_LANGUAGES).alias("block")), "languages")
    return model | {"counted": counted.join(blocks, "lang")}


def _matrix(found: pa.Table, model: dict) -> dict:
    """Languages in order, log of their parts of the documents, log of their parts of the n-grams."""
    buckets, names = model["buckets"], found["lang"].to_numpy().astype(str)
    langs = np.unique(names)
    n = np.zeros((buckets + 1, len(langs)))
    n[found["bucket"].to_numpy(), np.searchsorted(langs, names)] = found["n"].to_numpy()
    counts = n[:-1] + SMOOTHING
    return {"langs": langs.tolist(), "prior": np.log(n[-1] / model["documents"]),
            "matrix": np.log(counts / counts.sum(0)).astype(np.float32)}


def log_scores(texts: list[str | None], model: dict,
               letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of prior and likelihood of each language for each text, and which texts have letters."""
    matrix = model["matrix"]
    scores = np.tile(model["prior"], (len(texts), 1))
    who, what, has = grams(texts, letters, len(matrix))
    for at in range(0, len(who), _CHUNK):
        w = who[at:at + _CHUNK]
        starts = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        scores[w[starts]] += np.add.reduceat(
            matrix[what[at:at + _CHUNK]].astype(np.float64), starts, axis=0)
    return scores, has


def posteriors(texts: list[str | None], model: dict,
               letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each language for each text, and which texts have letters."""
    scores, has = log_scores(texts, model, letters)
    scores -= scores.max(1, keepdims=True)
    p = np.exp(scores)
    return p / p.sum(1, keepdims=True), has


def _scored(docs: DataFrame, block: dict, text_col: str, state: list[str], begun: bool) -> DataFrame:
    """`docs` with the best language so far, its log score, and the sum of all relative to it."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        letters, m = letter_table(), shared.value
        langs = np.array(m["langs"], object)
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col)).to_pylist()
            lang, top, mass = [], [], []
            for at, stop in text_chunks(texts):
                scores, has = log_scores(texts[at:stop], m, letters)
                best = scores.max(1)
                lang += np.where(has, langs[scores.argmax(1)], "und").tolist()
                top.append(best)
                mass.append(np.where(has, np.exp(scores - best[:, None]).sum(1), np.inf))
            lang, top, mass = (np.array(lang, object), *(np.concatenate(x) if x else np.zeros(0) for x in (top, mass)))
            columns, names = b.columns, b.schema.names
            if begun:  # ties stay with the block before, whose languages come first
                old, was, before = (b.column(names.index(c)).to_numpy(zero_copy_only=False) for c in state)
                lang = np.where(top > was, lang, old)
                high = np.maximum(top, was)
                mass = mass * np.exp(top - high) + before * np.exp(was - high)
                top = high
                columns, names = columns[:-3], names[:-3]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lang, pa.string()), pa.array(top, pa.float64()), pa.array(mass, pa.float64())],
                [*names, *state])

    kept = [f for f in docs.schema.fields if f.name not in state]
    return docs.mapInArrow(run, T.StructType([
        *kept, T.StructField(state[0], T.StringType()), T.StructField(state[1], T.DoubleType()),
        T.StructField(state[2], T.DoubleType())]))


def predict(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred and score in place of any columns of those names.

    A null text, one without letters, or any text under no model is `und` with score 0. Ties go
    to the language first in alphabetical order. More than BLOCK_LANGUAGES languages take a pass over
    the documents for each block of them, at once and written, but for the last.
    """
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    state = ["lang_pred", *(unused(docs.columns, c) for c in ("lang_top", "lang_mass"))]
    out = docs
    for number in range(model["blocks"]):
        if number:
            out = written(out, "scored")
        block = model if model["blocks"] == 1 else _matrix(
            model["counted"].where(F.col("block") == number).toArrow(), model)
        out = _scored(out, {k: block[k] for k in ("langs", "prior", "matrix")}, text_col, state, number > 0)
    return out.withColumn("score", 1 / F.col(state[2])).drop(*state[1:])


def identified(docs: DataFrame, learn: Column, min_score: float, text_col: str = "text",
               lang_col: str = "lang") -> DataFrame:
    """The documents whose language can be told: not `und`, and with at least `min_score`."""
    model = train(docs, learn, text_col, lang_col)
    own = {c: unused(docs.columns, c) for c in ("lang_pred", "score") if c in docs.columns}
    text_col = own.get(text_col, text_col)
    return (predict(docs.withColumnsRenamed(own), model, text_col)
            .where((F.col("lang_pred") != "und") & (F.col("score") >= min_score))
            .drop("lang_pred", "score")
            .withColumnsRenamed({new: old for old, new in own.items()}).select(docs.columns))
