"""One query per operator, over whole tables with production parameters, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    collocations, decontamination, hardneg, langid, mixing, nearest, passages, quality, secret_scan,
    sharding, simhash, urls, warc,
)
from .runs import crc_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Five hex digits of a SHA-1 are four base32 letters.
ORACLE_SQL["op2_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h,
             min(page_id) OVER (PARTITION BY html) AS low FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1
           AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)), '')
           AS payload_digest,
       CASE WHEN page_id <> low THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> low THEN low END AS refers_to
FROM d
"""


@query
def op3_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches_sql(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = _quoted(pattern)
    mixed = " AND ".join(f"regexp_matches(m.part, '[{c}]')" for c in ("A-Z", "a-z", "0-9"))
    good = f"length(m.part) >= {least}" + (f" AND {mixed}" if kind == "mixed" else "")
    return f"""
SELECT row, kind, stop - m.size AS start, stop FROM (
    SELECT row, {number} AS kind, m, {good} AS good,
           sum(m.gap + m.size) OVER (PARTITION BY row ORDER BY m.at)::BIGINT AS stop
    FROM (SELECT row, unnest(list_transform(range(1, len(f) + 1), lambda i: {{
              'at': i, 'gap': length(s[i]), 'size': length(f[i]), 'part': g[i]}})) AS m
          FROM (SELECT row, regexp_split_to_array(text, {p}) AS s, regexp_extract_all(text, {p}) AS f,
                       regexp_extract_all(text, {p}, {group}) AS g FROM t)))
WHERE good"""


_REACH, _BASE = secret_scan.REACH, len(secret_scan.BASE)
_ROLE = "CASE kind " + " ".join(
    f"WHEN {i} THEN '{secret_scan.ROLES[k]}'" for i, k in enumerate(secret_scan.KINDS)) + " END"
_NAME = "CASE kind " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(secret_scan.KINDS)) + " END"
_AROUND = ", ".join(map(str, secret_scan.AROUND))
_SPAN = f"{_NAME} || ':' || start || ':' || stop"

ORACLE_SQL["op4_secret_scan"] = f"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
every AS ({' UNION ALL '.join(
    _matches_sql(i, *k) for i, k in enumerate(secret_scan.BASE + secret_scan.WEAK))}),
p AS (
    SELECT *, {_ROLE} AS role FROM every e WHERE kind <> {secret_scan.KINDS.index("mixed")} OR NOT EXISTS (
        SELECT 1 FROM every o WHERE o.row = e.row AND o.kind IN ({_AROUND})
        AND o.start <= e.start AND e.stop <= o.stop)),
found AS (
    SELECT * FROM p WHERE kind < {_BASE} OR EXISTS (
        SELECT 1 FROM p o WHERE o.row = p.row AND o.role <> p.role
        AND (o.role = 'secret' OR p.role = 'secret')
        AND o.start <= p.stop + {_REACH} AND p.start <= o.stop + {_REACH})),
g AS (
    SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
           count(*) FILTER (kind = 2) AS n_hex,
           string_agg({_SPAN}, ',' ORDER BY start, kind) FILTER (kind < {_BASE}) AS base,
           string_agg({_SPAN}, ',' ORDER BY start, kind) AS spans
    FROM found GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (row)
"""


@query
def op6_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), "url").drop("url")


_ABC = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _rule_sql(text: str) -> str:
    host, slash, path = text.partition("/")
    return (f"(host = '{host}' OR suffix(host, '.{host}')) AND starts_with(path, '{slash}{path}')")


def _patterns_sql(verdict: str) -> str:
    return " OR ".join(f"regexp_matches(low, {_quoted(urls.pattern_rule(*p).regex)})"
                       for p in urls.PATTERNS if p[0] == verdict)


_LONGEST = sorted(urls.HOST_RULES, key=lambda r: (-len(r[1]), r[1]))
ORACLE_SQL["op6_url_filter"] = f"""
WITH r AS (
    SELECT page_id, translate(coalesce(url, ''), {_ABC}) AS low,
           CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
s AS (
    SELECT page_id, low, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_ABC}) AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
v AS (
    SELECT *, CASE {' '.join(f"WHEN {_rule_sql(t)} THEN '{t}'" for _, t in _LONGEST)} END AS rule FROM s)
SELECT page_id, host, path, rule,
       CASE {' '.join(f"WHEN rule = '{t}' THEN '{v}'" for v, t in _LONGEST)}
            WHEN ({_patterns_sql('block')}) AND NOT ({_patterns_sql('allow')}) THEN 'block'
            ELSE 'allow' END AS verdict
FROM v
"""


@query
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    model = langid.train(docs, ~held_out)
    return langid.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


@query
def op1_decontamination(spark, sf_dir):
    return decontamination.contaminated(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))


@query
def op8_quality(spark, sf_dir):
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                            ~held_out).withColumn("held_out", held_out)


@query
def op10_nearest(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.search(vectors, vectors.where("vec_id % 100 = 0"))


ORACLE_SQL["op10_nearest"] = """
WITH e AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(
        range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])))) AS score
    FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op9_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).drop("text")


# Both conditions are bisected over the list of shares; the sums run in the list's order, so the
# last digits of the exponent may differ, which no whole token depends on.
ORACLE_SQL["op9_mixing"] = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, coalesce(source, '') AS s,
           CAST(len(regexp_extract_all(coalesce(text, ''), '{mixing.TOKEN}')) AS BIGINT) AS t,
           CAST(CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
                AS BIGINT) % {mixing.BLOCKS} AS INTEGER) AS b
    FROM documents),
blocks AS (SELECT s, b, CAST(sum(t) AS BIGINT) AS t FROM d GROUP BY s, b),
sources AS (SELECT s, CAST(sum(t) AS BIGINT) AS t FROM blocks GROUP BY s HAVING sum(t) > 0),
l AS (SELECT CAST(sum(t) AS DOUBLE) AS total, list(t / (SELECT CAST(sum(t) AS DOUBLE) FROM sources)
             ORDER BY s) AS p FROM sources),
step AS (
    SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, 0.0::DOUBLE AS lo2, 1.0::DOUBLE AS hi2
    UNION ALL
    SELECT i + 1, CASE WHEN even THEN m ELSE lo END, CASE WHEN even THEN hi ELSE m END,
           CASE WHEN often THEN m2 ELSE lo2 END, CASE WHEN often THEN hi2 ELSE m2 END
    FROM (
        SELECT *, ln(list_sum(list_transform(p, lambda x: pow(x, m))))
                  - m * list_sum(list_transform(p, lambda x: pow(x, m) * ln(x)))
                      / list_sum(list_transform(p, lambda x: pow(x, m)))
                  >= {mixing.ENTROPY} * ln(len(p)) - 1e-12 AS even,
               {mixing.BUDGET} * pow(list_min(p), m2 - 1)
                   / list_sum(list_transform(p, lambda x: pow(x, m2))) > {mixing.MAX_PASSES} AS often
        FROM (SELECT step.*, (lo + hi) / 2 AS m, (lo2 + hi2) / 2 AS m2, p FROM step, l WHERE i < 40))),
a AS (
    SELECT greatest(
        CASE WHEN -list_sum(list_transform(p, lambda x: x * ln(x))) >= {mixing.ENTROPY} * ln(len(p)) - 1e-12
             THEN 1.0 ELSE lo END,
        CASE WHEN {mixing.BUDGET} / list_min(p) / len(p) > {mixing.MAX_PASSES} THEN hi2 ELSE 0.0 END) AS a,
        total, p
    FROM step, l WHERE i = 40),
share AS (
    SELECT s, t, CAST(floor(pow(t / total, a) / list_sum(list_transform(p, lambda x: pow(x, a)))
                            * {mixing.BUDGET} * total * (1 + {mixing.ROUNDING})) AS BIGINT) AS n
    FROM sources, a),
plan AS (SELECT s, CAST(n // t AS INTEGER) AS full_, n % t AS rest FROM share),
upto AS (
    SELECT s, b, full_, rest, t, sum(t) OVER (
        PARTITION BY s ORDER BY substr(md5('{mixing.SEED}:' || s || ':' || b || ':' || full_), 1, 8), b
        ROWS UNBOUNDED PRECEDING) AS upto
    FROM blocks JOIN plan USING (s)),
k AS (
    SELECT doc_id, source, d.s, d.b, d.t, full_, upto <= rest AS inside,
           CASE WHEN upto > rest AND upto - upto.t < rest THEN rest - upto + upto.t END AS left_,
           substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || full_ || ':' || d.t),
                  1, 16) AS key
    FROM d JOIN upto ON d.s = upto.s AND d.b = upto.b),
times AS (
    SELECT *, full_ + CASE WHEN inside OR coalesce(
        sum(t) OVER (PARTITION BY s, b ORDER BY key RANGE UNBOUNDED PRECEDING) <= left_, false)
        THEN 1 ELSE 0 END AS n FROM k)
SELECT doc_id, source, t AS n_tokens, pass, b AS block,
       substr(md5('{mixing.SEED}:' || s || ':' || b || ':' || pass), 1, 8) AS block_key,
       substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || pass || ':' || t), 1, 16)
           AS doc_key
FROM (SELECT *, CAST(unnest(range(n)) AS INTEGER) AS pass FROM times)
"""


@query
def op5_passages(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op12_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hardneg.mine(rows, rows.where("vec_id % 100 = 0"))


ORACLE_SQL["op12_hard_negatives"] = """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS own,
           CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
    FROM e a JOIN e c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id,
       positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.own AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5
"""


@query
def op13_sharding(spark, sf_dir):
    return sharding.sharded(table(spark, sf_dir, "documents"))


@query
def op11_collocations(spark, sf_dir):
    return collocations.mined(table(spark, sf_dir, "documents"))


ORACLE_SQL["op11_collocations"] = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), {_ABC}), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
    {' UNION ALL '.join(f"SELECT lang, w[i:i + {k - 1}] AS p FROM starts WHERE i + {k - 1} <= len(w)"
                        for k in range(1, 5))}),
f AS (SELECT lang, p, CAST(count(*) AS BIGINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, p, f AS a, unnest(range(1, len(p))) AS k FROM f WHERE len(p) > 1),
best AS (
    SELECT c.lang, c.p, c.a, x.f AS l, y.f AS r,
           CAST(2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f) AS BIGINT) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.p[1:c.k]
    JOIN f y ON y.lang = c.lang AND y.p = c.p[c.k + 1:]
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.p ORDER BY score, c.k) = 1),
inner_ AS (
    {' UNION ALL '.join(f"SELECT lang, p[{i}:{i + k - 1}] AS p, f FROM f WHERE len(p) > {k} AND {i + k - 1} <= len(p)"
                        for k in (2, 3) for i in range(1, 6 - k))}),
longer AS (SELECT lang, p, max(f) AS f FROM inner_ GROUP BY ALL),
kept AS (
    SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM best b LEFT JOIN longer x USING (lang, p)
    WHERE x.f IS NULL OR 100::HUGEINT * x.f < 80::HUGEINT * b.a)
SELECT lang, CAST(row_number() OVER o AS INTEGER) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER o <= 2000
"""
