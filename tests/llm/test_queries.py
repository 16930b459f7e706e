"""The registered queries against SQL, and the pipeline against a plain version of its stages."""

import re
import zlib
from collections import Counter

import duckdb
import pytest
from oracle import TESTDATA, compare, connect
from test_pairs import plain_fingerprint, roots, similarity
from test_rows import plain_base

import __spark_entry__ as entry
import corpus_pipeline
from burgage.llm import langid, queries

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, sf):
    sf_dir = f"{TESTDATA}/{sf}"
    with connect(sf_dir, TABLES) as con:
        assert compare(queries.QUERIES[name](spark, sf_dir), con, queries.ORACLE_SQL[name]) is None


def test_every_operator_is_registered():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def documents(sf_dir):
    rows = duckdb.sql(f"SELECT doc_id, text, lang FROM '{sf_dir}/documents.parquet'").fetchall()
    return {i: (t, lang) for i, t, lang in rows}


def test_simhash_query_equals_brute_force(spark):
    docs = documents(f"{TESTDATA}/sf0.001")
    prints = {i: plain_fingerprint(t) for i, (t, _) in docs.items()}
    root = roots(prints, [(a, b) for a in prints for b in prints
                          if a < b and (prints[a] ^ prints[b]).bit_count() <= 4])
    got = queries.QUERIES["op3_simhash_near_dedup"](spark, f"{TESTDATA}/sf0.001").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        i: (f"{p:016x}", root[i]) for i, p in prints.items()}


def test_held_out_accuracy(spark):
    sf_dir = f"{TESTDATA}/sf0.01"
    lang = {i: x for i, (_, x) in documents(sf_dir).items()}
    got = queries.QUERIES["op7_language_id"](spark, sf_dir).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf_dir}/labels.parquet'").fetchall())
    got = queries.QUERIES["op8_quality"](spark, sf_dir).collect()
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert len(got) == len(lang) and sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def plain_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def best_similarity(parts, item):
    """The greatest weighted similarity of an item with a stretch of `parts`, of any length."""
    n, best = sum(item.values()), 0.0
    for start in range(len(parts)):
        if parts[start] not in item:
            continue
        seen, shared = Counter(), 0
        for size, part in enumerate(parts[start:start + 2 * n], 1):
            seen[part] += 1
            shared += seen[part] <= item.get(part, 0)
            best = max(best, shared / (size + n - shared))
    return best


def plain_leak(text, items):
    """Whether some stretch of any length has weighted similarity 0.8 with an item."""
    words = plain_words(text)
    parts = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    known = Counter(parts)
    return any(best_similarity(parts, item) >= 0.8 for item in items
               if sum((known & item).values()) >= 0.6 * sum(item.values()))


def test_shards_of_the_query(spark):
    """The law of equal bytes, slots without gaps, equal texts together."""
    sf_dir = f"{TESTDATA}/sf0.001"
    texts = {i: t or "" for i, (t, _) in documents(sf_dir).items()}
    rows = queries.QUERIES["op13_sharding"](spark, sf_dir).collect()
    assert {(r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in rows} == {
        (i, len(t.encode()) + 8, zlib.crc32(t.encode()), "bytes", None) for i, t in texts.items()}
    assert len(rows) == len(texts) and len({(texts[r.doc_id], r.shard) for r in rows}) == len(set(texts.values()))
    sizes, slots = Counter(), {}
    for r in rows:
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(sizes) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for r in rows:
        groups[texts[r.doc_id]] += r.size
    assert max(sizes.values()) <= max(max(groups.values()), 1.02 * sum(sizes.values()) / 24)


def test_contaminated_query_equals_brute_force(spark):
    """All stretches of all lengths of all documents against all items."""
    sf_dir = f"{TESTDATA}/sf0.001"
    items = {i: Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4)) for i, w in (
        (i, plain_words(t)) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall())}
    want = set()
    for i, (text, _) in documents(sf_dir).items():
        words = plain_words(text)
        parts = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
        known = Counter(parts)
        want |= {(i, k) for k, item in items.items() if sum((known & item).values()) >= 0.6 * sum(item.values())
                 and best_similarity(parts, item) >= 0.8}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op1_decontamination"](spark, sf_dir).collect()}
    assert got <= want and len(got) >= 0.95 * len(want) and want


def test_pipeline_equals_plain_stages(spark):
    sf_dir = f"{TESTDATA}/sf0.001"
    docs = documents(sf_dir)
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # Language: plain sums over n-grams; the model itself is checked in test_rows.
    model = langid.train(source, corpus_pipeline.F.expr("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1"))
    p, has = langid.posteriors([t for t, _ in docs.values()], model, langid.letter_table())
    left = [i for i, sure, any_ in zip(docs, p.max(1), has) if any_ and sure >= 0.5]
    prints = {i: plain_fingerprint(docs[i][0]) for i in left}
    root = roots(prints, [(a, b) for a in prints for b in prints
                          if a < b and (prints[a] ^ prints[b]).bit_count() <= 4])
    left = [i for i in left if root[i] == i]
    items = [Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) for w in (plain_words(t) for (t,) in duckdb.sql(
        f"SELECT text FROM '{sf_dir}/benchmark.parquet'").fetchall())]
    left = [i for i in left if not plain_leak(docs[i][0], items)]
    left = [i for i in left if not plain_base(docs[i][0])]  # these texts have no linked weak parts
    con = duckdb.connect()
    con.execute("CREATE TABLE kept (doc_id BIGINT)")
    con.executemany("INSERT INTO kept VALUES (?)", [(i,) for i in left])
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet' SEMI JOIN kept USING (doc_id)")
    want = con.execute(queries.ORACLE_SQL["op9_mixing"])
    names = [d[0] for d in want.description]
    got = corpus_pipeline.run(spark, sf_dir)
    assert set(source.columns) < set(got.columns)
    assert Counter(map(tuple, got.select(names).collect())) == Counter(want.fetchall())
    assert all(r.text == docs[r.doc_id][0] for r in got.collect())


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, row string"


@pytest.mark.parametrize("rows", [
    [], [(None, None, None, None, None, None, None)],
    [(1, "", "en", "a", 0, "s", "r")] * 3,
    [(i, t, "en", "a", None, "s", "r") for i, t in enumerate(["the words of it", None, "the words of it", "x" * 50_000, "12"])],
])
def test_stages_take_odd_tables(spark, frame, rows):
    docs = frame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, f"{TESTDATA}/sf0.001")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == [f.split()[0] for f in SCHEMA.split(", ")]
    kept = [r.doc_id for r in docs.collect()]
    assert sorted(kept) == ([0, 3] if len(rows) == 5 else [])
