"""SimHash, components, passages and decontamination against brute force, and odd inputs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from burgage.llm import components, decontamination, passages, simhash

DOCS = "doc_id long, text string, lang string"


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ---- components ----

def test_components_of_random_graphs(frame):
    rng = random.Random(1)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (5, None), (2000, 2001), (2001, 2000)]
    got = {r.node: r.root for r in components.connected(frame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if b is not None and a != b]
    assert got == roots({x for p in real for x in p}, real)


def test_rows_that_share_an_id_but_not_the_text(frame):
    rng = random.Random(17)
    text = lambda: " ".join(f"q{rng.randint(0, 10**9)}" for _ in range(40))
    a, b, c = text(), text(), text()
    rows = [(1, a, "x"), (1, b, "x"), (1, a, "x"), (2, a, "x"), (3, c, "x"), (None, a, "x"), (None, a, "x")]
    got = simhash.one_of_each(frame(rows, DOCS)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter({(1, a): 1, (1, b): 1, (3, c): 1, (None, a): 2})


def test_components_without_links(frame):
    assert components.connected(frame([], "a long, b long")).collect() == []


# ---- SimHash ----

def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(frame):
    rng = random.Random(2)
    texts = [None, "", " \t\n", "One", "one two THREE", "Äb cd  ef gh", " x y z q"]
    base = [f"v{rng.randint(0, 50)}" for _ in range(120)]
    for _ in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"v{rng.randint(0, 50)}"
        texts.append(" ".join(words))
    texts += [" ".join(f"u{rng.random()}" for _ in range(rng.randint(1, 30))) for _ in range(60)]
    texts += ["a b c d e " * 4000, texts[8]]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "x"), (None, texts[9], "y")]
    got = simhash.near_duplicates(frame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    prints = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    root = roots(prints, links)
    for r in got:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", root[r.doc_id])
        else:
            assert r.component_id == root[9]


def test_cover_reaches_every_pair():
    rng = np.random.default_rng(3)
    home, near = simhash.golay_cover(1)
    x = rng.integers(0, 1 << 23, 20_000)
    y = x ^ np.where(rng.random(len(x)) < 0.5, 0, 1 << rng.integers(0, 23, len(x)))
    anchor = x ^ home[simhash._syndromes(x)]
    assert (np.bitwise_count(x ^ anchor) <= simhash.RADIUS).all()
    met = y[:, None] ^ near[simhash._syndromes(y)]
    assert (met == anchor[:, None]).any(1).all()


@pytest.mark.parametrize("rows, cols", [(4096, 65536), (3, 5)])
def test_split_anchors_lose_no_link(spark, monkeypatch, rows, cols):
    """Random fingerprints with many at distance 1 to 4, with cells so small that anchors split."""
    monkeypatch.setattr(simhash, "HOME_ROWS", rows)
    monkeypatch.setattr(simhash, "VISITOR_ROWS", cols)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 40)
    fps = set(base.tolist())
    for b in base.tolist():
        for n in (1, 2, 3, 4, 5, 6):
            fps.add(b ^ sum(1 << int(k) for k in rng.choice(63, n, replace=False)))
    hot = int(base[0])
    fps |= {hot ^ 1 << i ^ 1 << j for i in range(20) for j in range(i)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = simhash.links_at_anchors(simhash.at_anchors(df), 4)
    got = {r.node: r.root for r in components.connected(links).collect()}
    want = roots(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4])
    assert {f: got.get(f, f) for f in fps} == want


def test_simhash_of_nothing(frame):
    assert simhash.near_duplicates(frame([], DOCS)).collect() == []
    assert simhash.one_of_each(frame([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        simhash.near_duplicates(frame([], DOCS), max_bits=5)


def test_one_of_each_group_stays(frame):
    rows = [(4, "a b c d e", "x"), (2, "a b c d e", "y"), (2, "a b c d e", "z"), (7, "other words here", "x"),
            (None, "a b c d e", "n"), (None, "a b c d e", "n")]
    got = simhash.one_of_each(frame(rows, "doc_id long, text string, component_id string"))
    assert got.columns == ["doc_id", "text", "component_id"]
    assert sorted((r.doc_id or -1) for r in got.collect()) == [-1, -1, 2, 7]


# ---- passages ----

def merged(spans):
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def test_windows_are_dealt_evenly():
    """Lowest values are small numbers; no bucket gets many more windows than others for that."""
    hashes = np.random.default_rng(7).integers(1, 1 << 63, 20_000).astype(np.uint64)
    texts = passages._Texts(np.array([1]), hashes, np.array([0, len(hashes)]))
    key = np.concatenate([texts.windows(f)[0] for f in range(passages.FUNCTIONS)])
    sizes = np.bincount(passages._bucket(key, 16).astype(np.int64), minlength=16)
    assert sizes.max() < 1.5 * sizes.mean()


def test_passages_that_repeat(frame, words):
    p = words(10_000, 60)
    edited = list(p)
    edited[30] = "edit"
    short = words(20_000, 40)
    texts = [
        words(0, 80) + p + words(100, 30), p + words(300, 200), words(600, 51), words(600, 51),
        words(700, 20) + edited, words(800, 100) + short, short + words(1000, 90), words(1200, 49),
        words(1200, 49), [], None, ["same"] * 3000, words(1300, 300)]
    rows = [(i, None if t is None else " ".join(t), "x") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in passages.repeated_passages(frame(rows, DOCS)).collect()}
    assert len(got) == len(rows)
    spans = {i: r.spans for i, r in got.items() if r.n_passages}
    assert {i: r.class_id for i, r in got.items()} == {
        **{i: i for i in range(13)}, 1: 0, 4: 0, 3: 2}
    assert spans == {0: "80:140", 1: "0:60", 2: "0:51", 3: "0:51", 4: "20:80"}


def test_passages_equal_brute_force(frame):
    """Random texts with passages copied between them, some edited."""
    rng = random.Random(5)
    texts = [[f"r{rng.randint(0, 10**6)}" for _ in range(rng.randint(100, 400))] for _ in range(60)]
    for _ in range(40):
        a, b = rng.sample(range(60), 2)
        n = rng.randint(55, 90)
        at = rng.randint(0, len(texts[a]) - n) if len(texts[a]) > n else 0
        part = texts[a][at:at + n]
        if rng.random() < 0.3:
            part = part[:10] + ["e"] + part[11:]
        to = rng.randint(0, len(texts[b]))
        texts[b] = texts[b][:to] + part + texts[b][to:]
    hashed = []
    for t in texts:
        hashed.append(np.array([xxhash.xxh32_intdigest(" ".join(t[i:i + 5])) for i in range(len(t) - 4)],
                               np.uint32).view(np.int32))
    want, links = defaultdict(list), []
    for a in range(60):
        for b in range(a):
            for s, e, s2, e2 in passages.near_passages(hashed[a], hashed[b]):
                want[a].append((s, e + 4))
                want[b].append((s2, e2 + 4))
                links.append((a, b))
    root = roots(range(60), links)
    rows = [(i, " ".join(t), "x") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in passages.repeated_passages(frame(rows, DOCS)).collect()}
    assert {i for i, r in got.items() if r.n_passages} == set(want)
    assert {i: got[i].class_id for i in want} == {i: root[i] for i in want}
    both = either = 0
    for i in want:
        a = {w for s, e in merged(want[i]) for w in range(s, e)}
        b = {w for s in got[i].spans.split(",") for w in range(*map(int, s.split(":")))}
        both, either = both + len(a & b), either + len(a | b)
    assert both >= 0.98 * either


def test_passages_of_texts_in_different_tasks(spark):
    """A frequent block of 40 words; in each task two texts have it, one of them with 20 words more."""
    rng = random.Random(8)
    rest = lambda n: [f"q{rng.randint(0, 10**9)}" for _ in range(n)]
    tasks = [], []
    for i in range(16):
        block, more = rest(40), rest(20)
        for j, task in enumerate(tasks):
            task.append((4 * i + 2 * j, " ".join(rest(80) + block + rest(80)), "x"))
            task.append((4 * i + 2 * j + 1, " ".join(rest(80) + block + more + rest(80)), "x"))
    docs = spark.createDataFrame(spark.sparkContext.parallelize(tasks[0] + tasks[1], 2), DOCS)
    got = {r.doc_id: r for r in passages.repeated_passages(docs).collect()}
    assert {i: r.spans for i, r in got.items()} == {i: "80:140" if i % 2 else "" for i in range(64)}
    assert {i: r.class_id for i, r in got.items()} == {
        i: i - 2 if i % 4 == 3 else i for i in range(64)}


def test_passages_behind_many_texts_with_the_same_block(frame):
    """A block of 40 words in 60 texts; ten pairs of them share 20 words more, ten are copied whole."""
    rng = random.Random(9)
    rest = lambda n: [f"q{rng.randint(0, 10**9)}" for _ in range(n)]
    block, copied, texts = rest(40), rest(120), []
    for i in range(10):
        more = rest(20)
        texts += [rest(80) + block + more + rest(80) for _ in range(2)]
    texts += [rest(80) + block + rest(80) for _ in range(40)]
    texts += [rest(i) + copied + rest(80) for i in range(10)]
    rows = [(i, " ".join(t), "x") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in passages.repeated_passages(frame(rows, DOCS)).collect()}
    assert {i: r.spans for i, r in got.items()} == {
        i: "80:140" if i < 20 else f"{i - 60}:{i + 60}" if i >= 60 else "" for i in range(70)}
    assert {i: r.class_id for i, r in got.items()} == {
        i: i - i % 2 if i < 20 else min(i, 60) for i in range(70)}


def some_windows(rng, keys, contexts, texts, n):
    """Windows whose contexts are a few ones with some places changed."""
    w = np.zeros(n, passages.WINDOW)
    w["key"], w["node"] = rng.integers(1, keys + 1, n), rng.integers(0, texts, n)
    w["at"] = rng.integers(100, 5000, n)
    w["low"], w["high"] = w["at"] - 60, w["at"] + 60
    base = rng.integers(1, 1 << 16, (keys * contexts, w["context"].shape[1]))
    w["context"] = base[(w["key"].astype(int) - 1) * contexts + rng.integers(0, contexts, n)]
    for i in range(n):
        for at in rng.integers(0, w["context"].shape[1], rng.integers(0, 4)):
            w["context"][i, at:at + 5] = rng.integers(1, 1 << 16)
    return w


@pytest.mark.parametrize("cell", [256, 8])
def test_links_connect_what_is_alike(monkeypatch, cell):
    """Every window with a partner alike has one, and what hangs together by pairs still does."""
    monkeypatch.setattr(passages, "CELL", cell)
    rng = np.random.default_rng(10)
    w = some_windows(rng, 6, 5, 150, 400)
    pairs = passages.linked(w)
    name = lambda r: (int(r["key"]), int(r["node"]), int(r["at"]))
    links = [(name(p), name(q)) for p, q in pairs]
    assert all(p[0] == q[0] and p[1] != q[1] for p, q in links) and len(links) < 2 * len(w)
    every = [(name(w[i]), name(w[j])) for i in range(len(w)) for j in range(i) if w["key"][i] == w["key"][j]
             and w["node"][i] != w["node"][j] and passages.common(w["context"][i:i + 1], w["context"][j:j + 1])[0] >= passages.SHARED]
    nodes = {x for p in every for x in p}
    want, got = roots(nodes, every), roots(nodes | {x for p in links for x in p}, links)
    alone = [x for x in nodes if x not in {y for p in links for y in p}]
    assert len(alone) <= (0 if cell == 256 else 0.01 * len(nodes))
    same = sum(want[a] == want[b] for a, b in every)
    assert sum(got[a] == got[b] for a, b in every) >= (1.0 if cell == 256 else 0.98) * same


def test_common_hashes_of_contexts():
    a = np.zeros((2, 91), np.uint16)
    a[:, :50] = np.arange(1, 51)
    b = np.zeros((2, 91), np.uint16)
    b[0, 30:80], b[1, 20:70] = np.arange(1, 51), np.arange(100, 150)
    assert passages.common(a, b).tolist() == [50, 0]


@pytest.mark.parametrize("kind", ["random", "few values", "one value"])
def test_windows_of_many_texts_at_once(kind):
    rng = np.random.default_rng(3)
    top = {"random": 1 << 60, "few values": 6, "one value": 2}[kind]
    parts = [rng.integers(1, top, n).astype(np.uint64) for n in (1, 19, 20, 21, 400, 3, 90, 1000)]
    values = np.concatenate([np.concatenate([np.zeros(1, np.uint64), p]) for p in parts] + [np.zeros(1, np.uint64)])
    want, at = set(), 1
    for p in parts:
        want |= {(a + at, b + at, c + at) for a, b, c in passages.compact_windows(p, 20)}
        at += len(p) + 1
    assert {*zip(*(x.tolist() for x in passages.all_windows(values, 20)))} == want


def test_passages_that_repeat_themselves(frame):
    """Verbatim passages of 60 to 400 words with a period of 7 to 31, each in two texts."""
    rng = random.Random(14)
    rest = lambda n: [f"q{rng.randint(0, 10**9)}" for _ in range(n)]
    rows = []
    for i in range(20):
        line, n = rest(rng.randint(7, 31)), rng.randint(60, 400)
        part = (line * 60)[:n]
        rows += [(2 * i + j, " ".join(rest(rng.randint(0, 120)) + part + rest(100)), "x") for j in (0, 1)]
    got = {r.doc_id: r for r in passages.repeated_passages(frame(rows, DOCS)).collect()}
    assert all(got[i].n_passages and got[i].class_id == i - i % 2 for i in range(40))


def test_values_of_very_many_texts(frame, monkeypatch):
    """Windows spread by their agreements find what windows together find."""
    rng = random.Random(15)
    rest = lambda n: [f"q{rng.randint(0, 10**9)}" for _ in range(n)]
    block, copied = rest(30), rest(90)
    texts = [rest(60) + block + rest(60) for _ in range(40)] + [rest(i) + copied + rest(50) for i in range(40)]
    rows = [(i, " ".join(t), "x") for i, t in enumerate(texts)]
    monkeypatch.setattr(passages, "CELL", 4)
    monkeypatch.setattr(passages, "partitions", lambda df: 120)  # so that 4 windows of a value are very many
    calls = []
    original = passages.hot_links
    monkeypatch.setattr(passages, "hot_links", lambda *a: (calls.append(len(a[2])), original(*a))[1])
    got = {r.doc_id: r for r in passages.repeated_passages(frame(rows, DOCS).coalesce(2)).collect()}
    assert calls and calls[0] > 0
    assert {i: r.spans for i, r in got.items()} == {i: f"{i - 40}:{i + 50}" if i >= 40 else "" for i in range(80)}
    assert {r.class_id for i, r in got.items() if i >= 40} == {40}


def test_links_of_values_of_very_many_texts(spark, frame):
    """A block of 38 words in 120 texts, of which two each have 6 words more on either side in common, with
    an edit: pairs that windows together link are linked where they are spread, too."""
    rng = random.Random(22)
    rest = lambda n: [f"q{rng.randint(0, 10**9)}" for _ in range(n)]
    block, texts = rest(38), []
    for _ in range(60):
        one = rest(6) + block + rest(6)
        texts += [rest(60) + one + rest(60), rest(60) + one[:1] + rest(1) + one[2:] + rest(60)]
    table = frame([*zip(rng.sample(range(1000), 120), map(" ".join, texts))], "node long, text string")
    values = passages.shared_values(table).where("n > 16").select("h")
    hot = values.toArrow()["h"].to_numpy().view(np.uint64)
    known = passages.hash_filter(values, 1 << 20)
    pairs = lambda links: {(r.a, r.b) for r in links.select("a", "b").collect()}
    together = pairs(passages.window_links(table, known, 10_000, hot[:0]))
    assert len(together) >= 55
    assert together <= pairs(passages.hot_links(table, known, hot))


def test_recall_against_all_pairs_of_stretches(frame):
    """An independent brute force: for each pair of texts all stretches of LEAST shingles, and their
    similarity as multisets. Texts of frequent lines, rare ones, and edits."""
    rng = random.Random(16)
    rest = lambda n: [f"q{rng.randint(0, 10**9)}" for _ in range(n)]
    lines = [rest(rng.randint(6, 14)) for _ in range(12)]
    long = [rest(rng.randint(55, 110)) for _ in range(6)]
    texts = []
    for _ in range(50):
        t = []
        for _ in range(rng.randint(1, 5)):
            kind = rng.random()
            part = rng.choice(long) if kind < 0.35 else sum(rng.choices(lines, k=rng.randint(1, 3)), []) if kind < 0.7 else rest(rng.randint(5, 60))
            part = list(part)
            for _ in range(len(part) // 60):
                if rng.random() < 0.5:
                    part[rng.randrange(len(part))] = f"e{rng.randint(0, 10**9)}"
            t += part
        texts.append(t)
    n = passages.LEAST
    parts = [[tuple(t[i:i + 5]) for i in range(len(t) - 4)] for t in texts]
    want = defaultdict(set)
    for a in range(50):
        for b in range(a):
            one, two = parts[a], parts[b]
            if len(one) < n or len(two) < n or len(set(one) & set(two)) < 40:
                continue
            for i in range(len(one) - n + 1):
                here = Counter(one[i:i + n])
                for j in range(len(two) - n + 1):
                    if two[j] not in here and two[j + n - 1] not in here:
                        continue
                    both = sum((here & Counter(two[j:j + n])).values())
                    if both >= 0.8 * (2 * n - both):
                        want[a] |= set(range(i, i + n + 4))
                        want[b] |= set(range(j, j + n + 4))
    rows = [(i, " ".join(t), "x") for i, t in enumerate(texts)]
    got = {r.doc_id: {w for s in r.spans.split(",") if s for w in range(*map(int, s.split(":")))}
           for r in passages.repeated_passages(frame(rows, DOCS)).collect()}
    found, all_ = sum(len(want[i] & got[i]) for i in want), sum(map(len, want.values()))
    assert all_ > 1000 and found >= 0.95 * all_
    assert sum(bool(got[i]) for i in want) >= 0.95 * len(want)


def test_passages_that_lie_apart_in_the_other_text():
    """Half of a stretch lies far off: neither half is a passage, and nothing breaks."""
    a = np.arange(90, dtype=np.int32)
    gap = np.arange(1000, 1500, dtype=np.int32)
    assert passages.near_passages(a, np.concatenate([a[:45], gap, a[45:]])) == []
    assert passages.near_passages(a, np.concatenate([a[45:], gap, a[:45]])) == []
    assert passages.near_passages(a, np.concatenate([a[:40], gap, a[40:]])) == [(40, 90, 540, 590)]


@pytest.mark.parametrize("n, more", [(66, 6), (76, 7), (81, 8)])
def test_passages_whichever_side_is_longer(n, more):
    a = np.arange(n, dtype=np.int32)
    cut = n // 2  # words put in break four shingles and make as many and their own
    b = np.concatenate([a[:cut - 2], np.arange(1000, 1004 + more, dtype=np.int32), a[cut + 2:]])
    assert passages.near_passages(a, b) == [(0, n, 0, len(b))]
    assert passages.near_passages(b, a) == [(0, len(b), 0, n)]
    twice = np.concatenate([b, a[:1]])  # a shingle that repeats
    assert (0, n, 0, len(b)) in passages.near_passages(a, twice)
    assert (0, len(b), 0, n) in passages.near_passages(twice, a)


def test_passages_equal_all_pairs_of_stretches():
    """Every two stretches between shared shingles, by a running count over the table of matches."""
    rng = np.random.default_rng(11)
    found = 0
    for _ in range(60):
        a = np.arange(rng.integers(60, 90), dtype=np.int32)
        b, new = [], 1000
        for x in a.tolist():
            if rng.random() < 0.07:
                k = int(rng.integers(1, 8))
                b += range(new, new + k)
                new += k
            if rng.random() > 0.05:
                b.append(x)
        b = np.array(b, np.int32)
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        table[1:, 1:] = (a[:, None] == b).cumsum(0).cumsum(1)
        place = {x: k for k, x in enumerate(b.tolist())}
        both = [(i, place[i]) for i in range(len(a)) if i in place]
        want = set()
        for s, s2 in both:
            for e, e2 in both:
                if e - s + 1 >= passages.LEAST and e2 - s2 + 1 >= passages.LEAST:
                    m = table[e + 1, e2 + 1] - table[s, e2 + 1] - table[e + 1, s2] + table[s, s2]
                    if m >= 0.8 * (e - s + e2 - s2 + 2 - m):
                        want |= {*range(s, e + 1)}
        for got in ([x[:2] for x in passages.near_passages(a, b)],
                    [x[2:] for x in passages.near_passages(b, a)]):
            assert {k for s, e in got for k in range(s, e)} == want
        found += bool(want)
    assert 10 < found < 60


def test_compact_windows_hold_their_lowest():
    rng = np.random.default_rng(6)
    for values in (rng.integers(0, 1 << 60, 400).astype(np.uint64), np.zeros(5000, np.uint64)):
        got = passages.compact_windows(values, 20)
        assert all(values[a:b].min() == values[c] and a <= c < b and b - a >= 20 for a, c, b in got)
        for i in range(0, len(values) - 20, 37):  # each long subsequence lies in one window with its lowest
            for j in range(i + 20, min(len(values), i + 90), 13):
                assert any(a <= i <= c < j <= b for a, c, b in got)


def test_passages_of_nothing(frame):
    assert passages.repeated_passages(frame([], DOCS)).collect() == []
    got = passages.repeated_passages(frame([(None, "x " * 60, "a"), (None, "x " * 60, "a")], DOCS)).collect()
    assert [(r.doc_id, r.class_id, r.spans) for r in got] == [(None, None, "0:60")] * 2


# ---- decontamination ----

def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def test_items_in_documents(frame, words):
    items = [(0, " ".join(words(0, 30))), (1, " ".join(words(100, 60))), (2, "w1 w2 w3"), (3, None), (4, ""),
             (None, "x y z u v w"), (5, "Just five words, here now."), (6, " ".join(words(0, 30)))]
    edited = words(100, 60)
    edited[3] = "edit"
    broken = words(100, 60)
    for i in range(5, 60, 9):
        broken[i] = "edit"
    texts = [words(500, 100) + words(0, 30) + words(700, 50), edited, broken, words(0, 30)[:27], words(0, 22),
             ["said:", "JUST", "five-words", "HERE", "(now)"], [], None, words(900, 5000) + words(0, 30), words(1, 3)]
    rows = [(i, None if t is None else " ".join(t), "x") for i, t in enumerate(texts)] + [(0, None, "y")]
    got = decontamination.contaminated(frame(rows, "doc_id long, text string, item_id string"),
                                       frame(items, "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id): (r.first_word, r.n_words) for r in got}
    assert set(found) == {(0, 0), (0, 6), (1, 1), (3, 0), (3, 6), (5, 5), (8, 0), (8, 6)}
    assert found[0, 0] == (100, 30) and found[8, 0] == (5000, 30) and found[3, 6] == (0, 27)
    assert {r.similarity for r in got if r.doc_id in (0, 8, 5)} == {1.0}
    parts = [tuple(edited[i:i + 5]) for i in range(56)]  # the best stretch leaves out the edit
    item = Counter(tuple(words(100, 60)[i:i + 5]) for i in range(56))
    best = max(similarity(Counter(parts[max(0, i):max(0, i + 56)]), item) for i in range(-11, 12))
    assert [round(r.similarity, 9) for r in got if r.doc_id == 1] == [round(best, 9)]


def test_shortened_and_widened_items_inside_documents(frame, words):
    """A part of an item, or an item with words put in, counts whatever stands around it."""
    items = [(n, " ".join(words(1000 * n, n))) for n in (30, 60, 100)]
    docs = []
    for n, k in ((30, 27), (60, 52), (100, 86)):
        docs.append((n, words(800_000, 80) + words(1000 * n, k) + words(900_000, 80), k))
        docs.append((n, words(800_000, 80) + words(1000 * n + n - k, k) + words(900_000, 80), k))
    for n, k in ((60, 5), (100, 9)):
        mine = words(1000 * n, n)
        docs.append((n, words(800_000, 80) + mine[:n // 2] + words(700_000, k) + mine[n // 2:] + words(900_000, 80), n + k))
    rows = [(i, " ".join(t), "x") for i, (_, t, _) in enumerate(docs)]
    got = decontamination.contaminated(frame(rows, DOCS), frame(items, "item_id long, text string")).collect()
    assert {r.doc_id: (r.item_id, r.first_word, r.n_words) for r in got} == {
        i: (n, 80, size) for i, (n, _, size) in enumerate(docs)}


def test_many_items_take_more_passes(frame, words, monkeypatch):
    monkeypatch.setattr(decontamination, "ITEMS_PER_PASS", 4)
    items = [(i, " ".join(words(i * 100, 20 + i))) for i in range(20)]
    docs = [(i, " ".join(words(50_000, 30) + words(i * 100, 20 + i)), "x") for i in range(20)]
    got = decontamination.contaminated(frame(docs, DOCS), frame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(i, i) for i in range(20)]


@pytest.mark.parametrize("docs, items", [([], [(1, "a b c d e f")]), ([(1, "a b c d e f", "x")], [])])
def test_decontamination_of_nothing(frame, docs, items):
    docs, items = frame(docs, DOCS), frame(items, "item_id long, text string")
    assert decontamination.contaminated(docs, items).collect() == []
    assert decontamination.without_benchmark(docs, items).count() == docs.count()


def test_all_within_the_radius_are_found():
    rng = np.random.default_rng(7)
    prints = rng.integers(0, 1 << 63, 50).astype(np.uint64)
    index = decontamination.Index(prints)
    bits = np.array([np.bitwise_xor.reduce(1 << rng.choice(63, n, replace=False).astype(np.uint64))
                     if n else np.uint64(0) for n in rng.integers(0, 14, 2000)], np.uint64)
    asked = prints[rng.integers(0, 50, 2000)] ^ bits
    a, b = index.near(asked)
    distance = np.bitwise_count(asked[:, None] ^ prints)
    assert set(zip(a.tolist(), b.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(
        distance <= decontamination.RADIUS))))


def test_edited_items_are_found(frame):
    """Random items with edits anywhere: pairs at 0.8 or more by all stretches of all lengths, and no other."""
    rng = random.Random(19)
    rest = lambda n: [f"q{rng.randint(0, 10**9)}" for _ in range(n)]
    items = [rest(rng.randint(12, 120)) for _ in range(60)]
    docs = []
    for _ in range(240):
        item = rng.randrange(60)
        part = list(items[item])
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            at = rng.randrange(len(part))
            part[at:at + rng.choice([0, 1, 1, 3])] = rest(rng.choice([0, 1, 1, 2]))
        docs.append(rest(rng.randint(0, 150)) + part + rest(rng.randint(0, 150)))
    counts = [Counter(tuple(t[i:i + 5]) for i in range(len(t) - 4)) for t in items]
    want = set()
    for d, words in enumerate(docs):
        parts = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        known = Counter(parts)
        for k, item in enumerate(counts):
            n = sum(item.values())
            if sum((known & item).values()) < 0.6 * n:
                continue
            best = 0.0
            for start in (i for i, p in enumerate(parts) if p in item):
                seen, shared = Counter(), 0
                for size, p in enumerate(parts[start:start + 2 * n], 1):
                    seen[p] += 1
                    shared += seen[p] <= item.get(p, 0)
                    best = max(best, shared / (size + n - shared))
            if best >= 0.8:
                want.add((d, k))
    found = decontamination.contaminated(
        frame([(i, " ".join(t), "x") for i, t in enumerate(docs)], DOCS),
        frame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got <= want and len(got) >= 0.97 * len(want) > 100


@pytest.mark.parametrize("step", [1, 2, 4])
def test_bits_counted_in_bytes_are_those_counted_wide(step):
    rng = np.random.default_rng(step)
    hashes = rng.integers(0, 1 << 63, 3_000).astype(np.uint64)
    hashes[500:1200] = np.uint64((1 << 64) - 1)  # more than a byte holds
    size = decontamination.NARROW // step * step
    wide = decontamination.running_bits(hashes, step)
    narrow = decontamination.running_bits(hashes, step, narrow=True)
    assert narrow.nbytes * 4 == wide.nbytes
    for n in (step, 5 * step, size):
        assert (decontamination.window_prints(narrow, n, step) == decontamination.window_prints(wide, n, step)).all()


def test_values_of_many_contexts_link_all_that_are_alike():
    rng = np.random.default_rng(3)
    n, width = passages.CELL, 2 * passages.REACH + 1
    w = np.zeros(2 * n, passages.WINDOW)
    w["key"], w["node"], w["at"], w["high"] = 5, np.arange(2 * n), passages.REACH, width
    for i in range(n):  # SHARED hashes and some more in common, but no stretch of them
        mine = rng.permutation(60_000)[:width] + 1
        other = rng.permutation(60_000)[:width] + 1
        kept = rng.permutation(width)[:passages.SHARED + 5]
        other[kept] = mine[kept]
        w["context"][2 * i], w["context"][2 * i + 1] = mine, other
    got = {tuple(sorted(p)) for p in passages.linked(w)["node"].tolist()}
    assert got == {(2 * i, 2 * i + 1) for i in range(n)}


@pytest.mark.parametrize("seed", range(20))
def test_longest_chain_of_runs_is_that_of_all_pairs(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    i = np.flatnonzero(rng.random(300) < 0.8)
    j = rng.integers(0, 60, len(i)) if seed % 2 else (i + 7 * rng.integers(0, 5, len(i))) % 200
    seen = []
    monkeypatch.setattr(passages, "_in_order", lambda a, b: seen.append((a, b)) or [])
    passages._chained_passages(i, j)
    cuts = np.flatnonzero((np.diff(i) != 1) | (np.diff(j) != 1)) + 1
    runs = np.split(np.arange(len(i)), cuts)
    best = []
    for k, run in enumerate(runs):  # the longest chain that ends here, of equal ones by the first run
        before = [(best[x][0], -x) for x in range(k) if j[runs[x][-1]] < j[run[0]]]
        n, x = max(before, default=(0, None))
        best.append((n + len(run), ([] if x is None else best[-x][1]) + run.tolist()))
    want = max(best, key=lambda b: b[0])[1]
    assert seen[0][0].tolist() == i[want].tolist() and seen[0][1].tolist() == j[want].tolist()


def test_contexts_that_cannot_be_alike_are_not_compared(monkeypatch):
    """Contexts of fewer than SHARED different hashes have not as many in common with any."""
    n, width = 2 * passages.CELL, 2 * passages.REACH + 1
    w = np.zeros(n, passages.WINDOW)
    w["key"], w["node"] = 5, np.arange(n)
    w["context"] = np.arange(width) % 20 + 1 + 40 * np.arange(n)[:, None]
    seen = []
    original = passages._alike
    monkeypatch.setattr(passages, "_alike", lambda w: (seen.append(len(w)), original(w))[1])
    assert not len(passages._alike_in_blocks(w)) and not seen
    w["context"][7], w["context"][300] = np.arange(1, width + 1), np.arange(3, width + 3)
    assert original(w)[0].tolist() == [7] and original(w)[1].tolist() == [300]


def test_equal_contexts_lie_side_by_side():
    rng = np.random.default_rng(21)
    w = np.zeros(300, passages.WINDOW)
    w["key"], w["node"] = 5, rng.permutation(300)
    w["context"] = rng.integers(1, 1 << 16, (3, w["context"].shape[1]))[np.arange(300) % 3]
    _, rows = passages._once(w, 16)
    assert len(rows) == 300 and (np.diff(passages._contents(rows["context"]).astype(float)) != 0).sum() == 2


def test_contexts_around_a_frequent_line_meet_at_rare_hashes(monkeypatch):
    """Contexts that share a line only are not compared; all pairs that are alike are found, those that have
    repeated hashes in common too."""
    rng = np.random.default_rng(23)
    n, width = 4 * passages.CELL, 2 * passages.REACH + 1
    w = np.zeros(n, passages.WINDOW)
    w["key"], w["node"] = 5, np.arange(n)
    w["context"] = rng.integers(1, 1 << 16, (n, width))
    w["context"][:, 40:50] = np.arange(1, 11)
    for i in range(0, 40, 2):  # 28 hashes beside the line, four of them twice
        w["context"][i + 1, 50:78] = w["context"][i, 55:83]
        w["context"][i:i + 2, :4] = w["context"][i, 55:59]
    seen = []
    monkeypatch.setattr(passages, "_alike", lambda w: seen.append(len(w)) or (np.zeros(0, int),) * 2)
    got = {tuple(sorted(p)) for p in passages._alike_in_blocks(w).tolist()}
    assert not seen
    assert got == {(i, i + 1) for i in range(0, 40, 2)}
