"""Differencing against brute force, and the sharding law on odd tables."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import pytest

from burgage.llm import sharding

DOCS = "doc_id long, text string, shard string, size string, _a long"


def spread(sizes, parts, shards):
    sums = [sum(s for s, p in zip(sizes, parts) if p == i) for i in range(shards)]
    return max(sums) - min(sums)


def test_textbook_case():
    # Two parts of 4, 5, 6, 7, 8: differencing ends at a difference of 2.
    assert spread([4, 5, 6, 7, 8], sharding.differenced([4, 5, 6, 7, 8], 2), 2) == 2
    assert sharding.differenced([], 3) == [] and sharding.differenced([5, 1], 1) == [0, 0]
    assert sorted(sharding.differenced([9, 9, 9], 3)) == [0, 1, 2]


@pytest.mark.parametrize("seed", range(20))
def test_differencing_is_near_the_best(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 40) for _ in range(8)]
    best = min(spread(sizes, p, 3) for p in product(range(3), repeat=8))
    got = sharding.differenced(sizes, 3)
    assert set(got) <= {0, 1, 2} and spread(sizes, got, 3) <= best + max(sizes) // 3


def test_differencing_of_many():
    rng = random.Random(1)
    sizes = [int(rng.paretovariate(1.5) * 100) for _ in range(5_000)]
    greedy = [0] * 24
    for s in sorted(sizes, reverse=True):
        greedy[greedy.index(min(greedy))] += s
    got = spread(sizes, sharding.differenced(sizes, 24), 24)
    assert got <= max(greedy) - min(greedy) and got <= 0.01 * sum(sizes) / 24


def check(rows, docs, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in docs)
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    homes = defaultdict(set)
    for r in rows:
        homes[r.text_crc32, r.size].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    return [sizes[i] for i in range(shards)]


@pytest.mark.parametrize("top", [sharding.TOP, 64])
def test_sizes_near_equal_with_copies(frame, top):
    """With a small last level the same is reached over several levels."""
    rng = random.Random(2)
    docs = [(i, "x" * int(rng.paretovariate(1.2) * 20) + str(i), "s", None, i) for i in range(1500)]
    docs += [(5_000 + i, "copy of one text", None, "z", 0) for i in range(700)]
    sums = check(sharding.sharded(frame(docs, DOCS), 8, top=top).collect(), docs, 8)
    # No further apart than an item of the last level is large.
    assert max(sums) - min(sums) <= max(0.01 * sum(sums) / 8, sum(sums) / top)


@pytest.mark.parametrize("top", [sharding.TOP, 64])
def test_a_group_larger_than_a_shard_is_alone(frame, top):
    docs = [(i, f"text {i}", None, None, None) for i in range(400)]
    docs += [(1, "the largest group of all", None, None, None)] * 400
    sums = sorted(check(sharding.sharded(frame(docs, DOCS), 6, top=top).collect(), docs, 6))
    assert sums[-1] == 400 * 32 and sums[-2] - sums[0] <= max(0.02 * sums[0], sum(sums) / top)


@pytest.mark.parametrize("docs", [
    [], [(None, None, None, None, None)], [(None, None, None, None, None), (1, "", "a", "b", 1)],
    [(7, "same", "a", "b", 1)] * 50, [(i, "äö" * i, None, None, None) for i in range(5)]])
def test_odd_tables(frame, docs):
    check(sharding.sharded(frame(docs, DOCS)).collect(), docs, 24)


def test_text_ids(frame):
    rows = sharding.sharded(frame([("a", "x"), (None, "x")], "name string, body string"), 2, "name", "body")
    assert {r.doc_id for r in rows.collect()} == {"a", None} and len({r.shard for r in rows.collect()}) == 1


def test_written_shards(spark, frame, tmp_path):
    docs = [(i, f"text {i % 60}", "old", f"{i}", i) for i in range(300)]
    path = str(tmp_path / "shards")
    sharding.write_shards(frame(docs, DOCS), path, 4)
    back = spark.read.parquet(path)
    assert set(back.columns) == {"doc_id", "text", "size", "shard", "_a"} and back.count() == 300
    homes = back.groupBy("text").agg({"shard": "max", "*": "count"}).count()
    assert homes == 60 and back.select("text", "shard").distinct().count() == 60
