"""Collocations against brute force: counts, cuts, longer phrases, hot pairs and odd texts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from burgage.llm import collocations

DOCS = "doc_id long, text string, lang string, w1 long, h long, n long, word string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least=30, most=4, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i:i + size])] += 1
    out = set()
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least}
        longer = Counter()
        for p, a in often.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i:i + size]] = max(longer[p[i:i + size]], a)
        rows = []
        for p, a in often.items():
            if len(p) > 1 and 100 * longer[p] < 80 * a:
                score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out |= {(lang, i + 1, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(rows)[:top])}
    return out


def got(docs, **more):
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.mined(docs, **more).collect()}


def texts(rng, n, vocabulary=60):
    words = [rng.choice(["Ab", "c", "É", "日本", "-", "x_y"]) + str(i) for i in range(vocabulary)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(" ".join(rng.choice(words[:5] if rng.random() < 0.4 else words) for _ in range(rng.randint(0, 9))))
            parts.append(rng.choice([". ", ",", "\n", "\t", "  ", "!? ", " Ab1 c2 New York City "]))
        out.append((i, "".join(parts), rng.choice(["en", "en", "de", None, "und", ""]), 1, 2, 3, "w"))
    return out


@pytest.mark.parametrize("least, top", [(30, 2000), (2, 50), (1, 2000)])
def test_equals_brute_force(frame, least, top):
    docs = texts(random.Random(6), 300)
    assert got(frame(docs, DOCS), least=least, top=top) == plain(docs, least, 4, top)


def test_shorter_and_longer_phrases(frame):
    docs = texts(random.Random(7), 200)
    assert got(frame(docs, DOCS), least=5, most=2) == plain(docs, 5, 2)
    assert got(frame(docs, DOCS), least=5, most=6) == plain(docs, 5, 6)


def test_pairs_behind_which_much_follows(frame):
    """A third of all words follow one pair, in as many ways; its bucket is spread and added up."""
    rng = random.Random(8)
    docs = [(i, "the one " + " ".join(f"v{rng.randint(0, 9)}" for _ in range(4)), "en", 0, 0, 0, "") for i in range(900)]
    docs += [(i, "the one the one the one", "en", 0, 0, 0, "") for i in range(100)]
    assert got(frame(docs, DOCS), least=10) == plain(docs, 10)


def test_small_chunks(frame, monkeypatch):
    """Chunk, flush and bucket borders change nothing."""
    docs = texts(random.Random(9), 120)
    table = frame(docs, DOCS)
    for name, value in {"CHUNK_BYTES": 50, "HELD_ROWS": 100, "BUCKET_ROWS": 64}.items():
        monkeypatch.setattr(collocations, name, value)
    assert got(table, least=4) == plain(docs, 4)


def test_filter_that_lets_everything_through(frame, monkeypatch):
    docs = texts(random.Random(10), 120)
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 10)
    assert got(frame(docs, DOCS), least=3) == plain(docs, 3)


def test_quicksort_counts_prefixes():
    rng = np.random.default_rng(11)
    rows = rng.integers(1, 5, (4, 3000)).astype(np.uint64)
    rows[2, rows[3] == 1] = 0
    rows[3, rows[2] == 0] = 0
    n = rng.integers(1, 4, 3000)
    want = Counter()
    for row, k in zip(rows.T.tolist(), n.tolist()):
        for size in range(2, 5):
            if row[size - 1]:
                want[tuple(row[:size])] += k
    found = list(collocations.quicksort(list(rows), n, 40))
    assert Counter({tuple(rows[:size, at].tolist()): c for at, size, c in found}) == Counter(
        {p: c for p, c in want.items() if c >= 40})
    assert len(found) == len({tuple(rows[:size, at].tolist()) for at, size, _ in found})


@pytest.mark.parametrize("docs", [
    [], [(None, None, None, None, None, None, None)], [(1, "", "en", 0, 0, 0, "")] * 40,
    [(1, " \t ,.;", "en", 0, 0, 0, "")] * 40, [(1, "a b", None, 0, 0, 0, "")] * 30,
    [(1, "a b", None, 0, 0, 0, "")] * 29, [(1, "word " * 20_000, "en", 0, 0, 0, "")],
    [(1, "x" * 100_000 + " y", "en", 0, 0, 0, "")] * 31])
def test_odd_texts(frame, docs):
    assert got(frame(docs, DOCS)) == plain(docs)


def test_scores_pass_64_bits(spark):
    """2,000,000 a alone is beyond a long."""
    big = 9_000_000_000_000_000_000
    rows = spark.createDataFrame([(1, 2, big), (1, 0, big), (2, 0, big)], "w1 long, w2 long, n long")
    (row,) = collocations._scored(rows, ["w1", "w2"]).collect()
    assert (row.score, row.l, row.r) == (1_000_000, big, big)
