"""The same reports as SQL for an independent engine, over views of the same tables."""

from __future__ import annotations

from ..schemas import COUNTIES, MISSING_SENTINEL

_BREAKS = r"""!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>\s"""


def _initcap(x: str) -> str:
    """Words end at a break; each is put together from its first letter and the rest."""
    words = f"regexp_extract_all(lower({x}), '[^{_BREAKS}]*[{_BREAKS}]?')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), '')"


def _spaced(x: str) -> str:
    words = f"regexp_extract_all(lower({x}), '[^ ]* ?')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), '')"


_TIMED = """
timed AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_custkey,
         o_orderpriority AS permit_type, year(l_shipdate) AS issued_year,
         date_diff('day', o_orderdate, l_shipdate) AS processing_days,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS estimated_cost
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_PLACED = _TIMED + """,
placed AS (
  SELECT timed.*, n_name AS neighborhood, c_mktsegment AS segment, c_nationkey AS zipcode
  FROM timed JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

_BRANDS = """
brands AS (
  SELECT p_brand AS permit_type, year(l_shipdate) AS issued_year
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

_BRAND_TREND = _BRANDS + """,
trend AS (
  SELECT issued_year, permit_type, count(*) AS permit_count FROM brands
  WHERE issued_year BETWEEN 1996 AND 2000 GROUP BY ALL)"""

_TEXTS = """
texts AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS permit_number,
         o_orderpriority AS permit_type_definition,
         CASE WHEN l_orderkey % 11 = 0 THEN 'unknown'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS filed,
         CASE WHEN l_partkey % 13 = 0 THEN '13/45/2001'
              WHEN l_partkey % 17 <> 0 THEN strftime(l_shipdate, '%m/%d/%Y') END AS issued,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS completed,
         l_linestatus, l_returnflag, l_extendedprice, l_linenumber, l_quantity, l_suppkey,
         o_orderstatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
dated AS (
  SELECT *, try_strptime(filed, '%Y-%m-%d') AS filed_date,
         try_strptime(issued, '%m/%d/%Y') AS issued_date,
         try_strptime(completed, '%Y-%m-%d %H:%M:%S') AS completed_date
  FROM texts)"""

_PARCELS = """
parcels AS (
  SELECT CAST(p_partkey AS VARCHAR) AS blklot, p_name AS street, CAST(p_size AS BIGINT) AS units,
         CASE WHEN p_partkey % 19 <> 0 THEN p_brand END AS landuse,
         trim(CASE WHEN p_partkey % 23 = 0 THEN '   '
                   WHEN p_partkey % 5 = 0 THEN '  ' || p_type || ' ' ELSE p_type END) AS restype
  FROM part)"""

_HOUSING = f"""WITH {_PARCELS}
SELECT restype, count(*) AS parcel_count FROM parcels
WHERE landuse IS NOT NULL AND restype <> '' GROUP BY restype"""

_CHANGES = """
changes AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN lower(r1.r_name || '/' || n1.n_name)
              ELSE r1.r_name || '/' || n1.n_name END AS src,
         r2.r_name || '/' || n2.n_name AS dst
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation n1 ON c_nationkey = n1.n_nationkey JOIN region r1 ON n1.n_regionkey = r1.r_regionkey
  JOIN nation n2 ON s_nationkey = n2.n_nationkey JOIN region r2 ON n2.n_regionkey = r2.r_regionkey)
"""


def _merged(cap, limit: str = "LIMIT 15") -> str:
    return _CHANGES + f""",
merged AS (
  SELECT {cap('src')} AS existing_use, {cap('dst')} AS proposed_use, count(*) AS flow_count
  FROM changes WHERE src <> dst GROUP BY 1, 2
  ORDER BY flow_count DESC, existing_use, proposed_use {limit})"""


_NODES = """,
edges AS (
  SELECT *, row_number() OVER (ORDER BY flow_count DESC, existing_use, proposed_use) AS pos
  FROM merged),
sources AS (SELECT existing_use AS label, min(pos) AS pos FROM edges GROUP BY 1),
targets AS (
  SELECT proposed_use AS label, min(pos) AS pos FROM edges
  WHERE proposed_use NOT IN (SELECT label FROM sources) GROUP BY 1),
nodes AS (
  SELECT row_number() OVER (ORDER BY side, pos) - 1 AS node_id, label
  FROM (SELECT 0 AS side, pos, label FROM sources
        UNION ALL SELECT 1, pos, label FROM targets))"""

_LINKS = """
SELECT s.node_id AS source_id, t.node_id AS target_id, flow_count AS value
FROM edges JOIN nodes s ON s.label = existing_use JOIN nodes t ON t.label = proposed_use"""

_TRACTS = """
tracts AS (
  SELECT s_nationkey AS tract, s_acctbal AS median_income,
         CASE WHEN s_suppkey % 6 <> 0 THEN s_acctbal / 4 END AS median_rent
  FROM supplier)"""


def _pairs(place: str, kind: str) -> str:
    """The pairs themselves, joined one by one."""
    condition = "p.zipcode = c.tract AND c.median_income > 0"
    return f"""
report AS (
  SELECT p.{place} AS place, avg(p.processing_days) AS wait, count(*) AS pairs,
         round(avg(c.median_income), 0) AS income, round(avg(c.median_rent), 0) AS rent
  FROM placed p {kind} JOIN tracts c ON {condition}
  WHERE p.processing_days BETWEEN 0 AND 1000
  GROUP BY p.{place} HAVING count(*) >= 50)"""


def _income(kind: str) -> str:
    return f"""WITH {_PLACED}, {_TRACTS}, {_pairs('segment', kind)}
SELECT place AS segment, round(wait, 4) AS avg_wait_days, pairs AS permit_count,
       income AS avg_median_income, rent AS avg_median_rent FROM report"""


_INDEX = """
index_series AS (
  SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS observation_date,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS hpi_value
  FROM orders GROUP BY 1)"""

_CENSUS = f"""
census AS (
  SELECT c_name AS tract_name, '06' || c_custkey AS geoid, '06' AS state,
         lpad(CAST(c_nationkey * 4 + 1 AS VARCHAR), 3, '0') AS county,
         CAST(c_custkey AS VARCHAR) AS tract,
         nullif(CASE WHEN c_custkey % 7 = 0 THEN {MISSING_SENTINEL}.0 ELSE c_acctbal END,
                {MISSING_SENTINEL}.0) AS median_rent,
         nullif(CASE WHEN c_custkey % 8 = 0 THEN {MISSING_SENTINEL}.0 ELSE c_acctbal * 2 END,
                {MISSING_SENTINEL}.0) AS median_income,
         c_custkey % 10 * 100 AS pop_total, c_custkey % 3 * 30 AS pop_white
  FROM customer)"""

_STATS = _CENSUS + """,
stats AS (
  SELECT county, median(median_rent) AS median_rent, median(median_income) AS median_income,
         CAST(sum(pop_total) AS BIGINT) AS population, count(tract) AS tract_count
  FROM census WHERE median_rent IS NOT NULL GROUP BY county)"""

_TEXT_STATS = """
stats AS (
  SELECT lpad(CAST(c_nationkey * 4 + 1 AS VARCHAR), 3, '0') AS county,
         median(CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END) AS median_rent,
         median(CASE WHEN c_custkey % 8 <> 0 THEN c_acctbal END) AS median_income,
         CAST(sum(c_custkey % 10 * 100) AS DOUBLE) AS population, count(*) AS tract_count
  FROM customer GROUP BY 1)"""


def _counties(digits: int | None) -> str:
    def shown(x: float) -> float:
        return x if digits is None else round(x, digits)

    rows = ", ".join(f"('{c}', '{n}', CAST({shown(a)} AS DOUBLE), CAST({shown(o)} AS DOUBLE))"
                     for c, n, a, o in COUNTIES)
    return f"counties(county, name, lat, lon) AS (VALUES {rows})"


def _dollars(x: str, prefix: str = "$") -> str:
    return f"'{prefix}' || format('{{:,}}', CAST(round_even({x}, 0) AS BIGINT))"


def _markers(stats: str, digits: int | None, low: str, high: str) -> str:
    return f"""WITH {stats}, {_counties(digits)}
SELECT county, name, lat, lon, greatest(8.0, population / 100000.0) AS radius,
       round(median_rent, 4) AS median_rent, round(median_income, 4) AS median_income,
       population, tract_count, {low} AS vmin, {high} AS vmax,
       {_dollars('median_rent')} AS rent_text, {_dollars('median_income')} AS income_text,
       {_dollars('population', '')} AS population_text
FROM stats JOIN counties USING (county)"""


def _box(source: str, value: str, category: str) -> str:
    return f"""
box AS (
  SELECT {category} AS cat, quantile_cont({value}, 0.25) AS q1,
         quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3
  FROM {source} GROUP BY 1)
SELECT {category}, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       count(*) AS row_count,
       min({value}) FILTER ({value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
         AS whisker_low,
       max({value}) FILTER ({value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
         AS whisker_high,
       count(*) FILTER ({value} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
         AS outliers
FROM {source} JOIN box ON {category} = cat GROUP BY {category}, q1, median, q3"""


_STATS_SQL = """
SELECT permit_type, count(*) AS count, round(avg(processing_days), 1) AS avg_days,
       quantile_cont(processing_days, 0.5) AS median_days,
       min(processing_days) AS min_days, max(processing_days) AS max_days
FROM timed {where} GROUP BY permit_type"""

_TOP3 = """
timely AS (SELECT * FROM timed WHERE processing_days BETWEEN 0 AND 1000),
top3 AS (SELECT permit_type FROM timely GROUP BY 1 ORDER BY count(*) DESC, permit_type LIMIT 3),
kept AS (SELECT permit_type, processing_days FROM timely
         WHERE permit_type IN (SELECT permit_type FROM top3))"""

_CSV = """
fields AS (
  SELECT c_custkey AS custkey, c_name || ', "Ltd"' AS name,
         CASE WHEN c_custkey % 14 <> 1 AND c_custkey % 6 > 1 THEN c_mktsegment END AS segment,
         CASE WHEN c_custkey % 14 = 1 THEN NULL WHEN c_custkey % 10 = 0 THEN 'n.a.'
              ELSE CAST(c_acctbal AS VARCHAR) END AS balance,
         CASE WHEN c_custkey % 14 <> 1 THEN c_nationkey END AS nationkey
  FROM customer)"""

_TABLE_WIDTHS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
    "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2,
    "labels": 3, "conversations": 4,
}

_PERMIT_HEAD = """permit_number, {cap} AS permit_type, filed_date AS filed_date{s},
       issued_date AS issued_date{s}, {completed} year(issued_date) AS issued_year,
       l_linestatus AS existing_use, l_returnflag AS proposed_use,
       l_extendedprice AS estimated_cost, {units} o_orderstatus AS neighborhood,
       CAST(l_suppkey AS VARCHAR) AS zipcode, {district}
       date_diff('day', filed_date, issued_date) AS processing_days"""

ORACLE_SQL: dict[str, str] = {
    "permits_clean": f"""WITH {_TEXTS}
SELECT {_PERMIT_HEAD.format(
    cap=_initcap('permit_type_definition'), s='', completed='completed_date,',
    units='CAST(l_linenumber AS BIGINT) AS existing_units, '
          'CAST(l_quantity AS BIGINT) AS proposed_units,',
    district='o_orderstatus AS supervisor_district,')}
FROM dated WHERE issued_date IS NOT NULL""",

    "permits_clean_narrow": f"""WITH {_TEXTS}
SELECT {_PERMIT_HEAD.format(cap=_spaced('permit_type_definition'), s='_ts', completed='',
                            units='', district='')}
FROM dated WHERE date_diff('day', filed_date, issued_date) BETWEEN 0 AND 1000""",

    "land_use_clean": f"""WITH {_PARCELS}
SELECT blklot, street, units, landuse, restype FROM parcels WHERE landuse IS NOT NULL""",

    "hpi_clean": """SELECT CAST(o_orderdate AS DATE) AS observation_date,
       o_totalprice AS hpi_value FROM orders WHERE o_orderkey % 9 <> 0""",

    "census_clean": f"""WITH {_CENSUS}
SELECT tract_name, geoid, state, county, tract, median_rent, round(median_income, 4) AS
       median_income, pop_total, pop_white,
       CASE WHEN pop_total > 0 THEN round(CAST(pop_white AS DOUBLE) / pop_total * 100, 1) END
         AS pct_white FROM census""",

    "quality_summary": f"""WITH {_PLACED}
SELECT count(*) AS total_rows, min(issued_year) AS min_year, max(issued_year) AS max_year,
       round(avg(processing_days), 4) AS avg_processing_days,
       count(DISTINCT neighborhood) AS distinct_neighborhoods FROM placed""",

    "permits_trend": """SELECT year(l_shipdate) AS issued_year, l_returnflag AS permit_type,
       count(*) AS permit_count FROM lineitem
WHERE year(l_shipdate) BETWEEN 1996 AND 2000 GROUP BY 1, 2""",

    "trend_top_types": f"""WITH {_BRAND_TREND}
SELECT issued_year, permit_type, permit_count FROM trend WHERE permit_type IN (
  SELECT permit_type FROM trend GROUP BY 1
  ORDER BY sum(permit_count) DESC, permit_type LIMIT 5)""",

    "neighborhood_activity": f"""WITH {_PLACED}
SELECT neighborhood, count(*) AS total_permits,
       round(avg(processing_days), 4) AS avg_processing_days,
       round(CAST(sum(estimated_cost) AS DOUBLE), 4) AS total_estimated_cost
FROM placed GROUP BY 1 ORDER BY total_permits DESC, neighborhood LIMIT 20""",

    "neighborhood_activity_all": f"""WITH {_PLACED}
SELECT neighborhood, count(*) AS total_permits,
       round(avg(processing_days), 1) AS avg_processing_days FROM placed GROUP BY 1""",

    "neighborhood_ranked": f"""WITH {_PLACED},
counts AS (
  SELECT neighborhood, issued_year, count(*) AS permit_count FROM placed
  WHERE processing_days BETWEEN 0 AND 1000 AND issued_year BETWEEN 1996 AND 2000 GROUP BY 1, 2)
SELECT neighborhood, issued_year, permit_count,
       rank() OVER (PARTITION BY issued_year ORDER BY permit_count DESC) AS rank_in_year,
       permit_count - lag(permit_count) OVER (PARTITION BY neighborhood ORDER BY issued_year)
         AS yoy_change FROM counts""",

    "housing_types": _HOUSING,
    "housing_types_bar": _HOUSING,

    "use_type_counts": f"""WITH {_BRANDS}
SELECT permit_type AS existing_use, count(*) AS permit_count FROM brands
GROUP BY 1 ORDER BY permit_count DESC, existing_use LIMIT 12""",

    "top_share": f"""WITH {_PLACED}
SELECT neighborhood, count(*) AS permit_count,
       round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share
FROM placed GROUP BY 1 ORDER BY permit_count DESC, neighborhood LIMIT 5""",

    "peak_years": f"""WITH {_BRANDS},
trend AS (SELECT issued_year, permit_type, count(*) AS permit_count FROM brands GROUP BY ALL),
changes AS (
  SELECT *, permit_count - lag(permit_count) OVER (PARTITION BY permit_type
                                                   ORDER BY issued_year) AS change,
         row_number() OVER (PARTITION BY permit_type
                            ORDER BY permit_count DESC, issued_year) AS place
  FROM trend)
SELECT permit_type, max(issued_year) FILTER (place = 1) AS peak_year,
       max(permit_count) FILTER (place = 1) AS peak_count, min(change) AS largest_drop
FROM changes GROUP BY 1""",

    "type_value_counts": """SELECT o_orderpriority AS permit_type, count(*) AS row_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",

    "processing_time": f"""WITH {_TIMED}
SELECT permit_type, processing_days FROM timed WHERE processing_days BETWEEN 0 AND 1000""",

    "processing_time_sample": f"""WITH {_TIMED}
SELECT permit_type, processing_days FROM timed WHERE processing_days BETWEEN 0 AND 1000
ORDER BY md5(concat_ws('~', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
                       '42')),
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate LIMIT 10000""",

    "processing_stats": f"WITH {_TIMED}" + _STATS_SQL.format(
        where="WHERE processing_days BETWEEN 0 AND 1000"),
    "processing_stats_all_days": f"WITH {_TIMED}" + _STATS_SQL.format(where=""),

    "processing_time_top_types": f"""WITH {_TIMED}, {_TOP3}
SELECT permit_type, processing_days FROM kept""",

    "processing_time_box":
        f"WITH {_TIMED}, {_TOP3}, " + _box("kept", "processing_days", "permit_type"),
    "cost_box": "WITH " + _box("lineitem", "l_extendedprice", "l_returnflag"),

    "change_of_use": f"""WITH {_CHANGES}
SELECT {_initcap('src')} AS existing_use, {_initcap('dst')} AS proposed_use, flow_count
FROM (SELECT src, dst, count(*) AS flow_count FROM changes WHERE src <> dst
      GROUP BY 1, 2 ORDER BY flow_count DESC, src, dst LIMIT 15)""",

    "change_of_use_merged": f"WITH {_merged(_spaced)} SELECT * FROM merged",
    "change_of_use_merged_words": f"WITH {_merged(_initcap)} SELECT * FROM merged",
    "sankey_nodes": f"WITH {_merged(_initcap)} {_NODES} SELECT node_id, label FROM nodes",
    "sankey_links": f"WITH {_merged(_initcap)} {_NODES} {_LINKS}",
    "sankey_nodes_all": f"WITH {_merged(_initcap, '')} {_NODES} SELECT node_id, label FROM nodes",
    "sankey_links_all": f"WITH {_merged(_initcap, '')} {_NODES} {_LINKS}",

    "income_vs_wait": _income("INNER"),
    "income_vs_wait_keep_unmatched": _income("LEFT"),

    "income_wait_scatter": f"""WITH {_PLACED}, {_TRACTS}, {_pairs('neighborhood', 'INNER')}
SELECT place AS label, income AS x, round(wait, 4) AS y, pairs AS size, rent AS colour
FROM report""",

    "permits_vs_hpi": f"""WITH {_INDEX},
totals AS (SELECT year(l_shipdate) AS year, count(*) AS total_permits FROM lineitem GROUP BY 1),
means AS (SELECT year(observation_date) AS year, avg(hpi_value) AS hpi
          FROM index_series GROUP BY 1)
SELECT year, total_permits, round(hpi, 4) AS hpi FROM totals JOIN means USING (year)
WHERE year BETWEEN 1996 AND 2000""",

    "hpi_series": f"""WITH {_INDEX}
SELECT observation_date, round(hpi_value, 4) AS hpi_value,
       year(observation_date) || ' Q' || quarter(observation_date) AS quarter
FROM index_series""",

    "county_stats": f"""WITH {_STATS}
SELECT county, round(median_rent, 4) AS median_rent, round(median_income, 4) AS median_income,
       population, tract_count FROM stats""",

    "county_stats_from_text": f"""WITH {_TEXT_STATS}
SELECT county, round(median_rent, 4) AS median_rent, round(median_income, 4) AS median_income,
       population, tract_count FROM stats""",

    "colour_bounds": f"""WITH {_CENSUS}
SELECT round(quantile_cont(median_rent, 0.1), 4) AS vmin,
       round(quantile_cont(median_rent, 0.9), 4) AS vmax FROM census""",

    "county_markers": _markers(
        _STATS, None, "(SELECT round(quantile_cont(median_rent, 0.1), 4) FROM census)",
        "(SELECT round(quantile_cont(median_rent, 0.9), 4) FROM census)"),
    "county_markers_fixed_range": _markers(
        _TEXT_STATS, 2, "CAST(1200 AS DOUBLE)", "CAST(3000 AS DOUBLE)"),

    "order_price_quantiles": """SELECT o_orderpriority,
       round(quantile_cont(o_totalprice, 0.1), 4) AS p10,
       round(quantile_cont(o_totalprice, 0.5), 4) AS p50,
       round(quantile_cont(o_totalprice, 0.9), 4) AS p90 FROM orders GROUP BY 1""",

    "event_time_quantiles": """SELECT event_type,
       round(quantile_cont(CAST(epoch_us(ts) AS DOUBLE), 0.1), 0) AS p10,
       round(quantile_cont(CAST(epoch_us(ts) AS DOUBLE), 0.5), 0) AS p50,
       round(quantile_cont(CAST(epoch_us(ts) AS DOUBLE), 0.9), 0) AS p90 FROM events GROUP BY 1""",

    "cost_stats": """SELECT l_returnflag, count(*) AS count, round(avg(l_extendedprice), 1) AS avg_days,
       round(quantile_cont(l_extendedprice, 0.5), 1) AS median_days,
       round(min(l_extendedprice), 1) AS min_days, round(max(l_extendedprice), 1) AS max_days
FROM lineitem GROUP BY 1""",

    "attached_areas": f"""WITH {_CENSUS}
SELECT o_orderkey, '06' || o_custkey AS geoid, median_rent
FROM orders LEFT JOIN census ON census.geoid = '06' || o_custkey""",

    "census_landing": """SELECT c_name AS name, CAST(c_acctbal AS VARCHAR) AS median_rent,
       lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS county, CAST(c_custkey AS VARCHAR) AS tract,
       '06' AS state,
       '06' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || c_custkey AS geoid FROM customer""",

    "census_landed": """SELECT c_name AS name, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS county,
       CAST(c_custkey AS VARCHAR) AS tract FROM customer
UNION ALL SELECT 'no table', NULL, NULL""",

    "appended_responses": """SELECT c_name AS name, CAST(c_acctbal AS VARCHAR) AS median_rent,
       lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS county, CAST(c_custkey AS VARCHAR) AS tract
FROM customer UNION ALL
SELECT s_name, CAST(s_acctbal AS VARCHAR), lpad(CAST(s_nationkey AS VARCHAR), 3, '0'), NULL
FROM supplier""",

    "csv_inferred": """SELECT o_orderkey AS order_key, round(o_totalprice, 4) AS total_price,
       CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status FROM orders""",

    "csv_load": f"""WITH {_CSV}
SELECT custkey, name, segment, CAST(balance AS DOUBLE) AS balance, CAST(nationkey AS BIGINT)
       AS nationkey FROM fields WHERE balance IS NULL OR balance <> 'n.a.'""",

    "csv_rejects": f"""WITH {_CSV}
SELECT CAST(custkey AS VARCHAR) AS custkey, name, segment, balance,
       CAST(nationkey AS VARCHAR) AS nationkey, 'balance' AS bad_columns
FROM fields WHERE balance = 'n.a.'""",

    "csv_export_multiline": """SELECT doc_id, lang, length(text) AS text_length,
       md5(text) AS text_md5 FROM documents""",

    "stored_trend": f"""WITH {_TEXTS}
SELECT year(issued_date) AS issued_year, {_initcap('permit_type_definition')} AS permit_type,
       count(*) AS permit_count FROM dated WHERE year(issued_date) BETWEEN 1996 AND 2000
GROUP BY 1, 2""",

    "stored_once": f"""WITH {_PARCELS} SELECT blklot, landuse, units FROM parcels""",

    "view_trend": """SELECT year(l_shipdate) AS issued_year, l_returnflag AS permit_type,
       count(*) AS permit_count FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 2000 GROUP BY 1, 2""",

    "kept_trend": """SELECT year(l_shipdate) AS issued_year, l_returnflag AS permit_type,
       count(*) AS permit_count, CAST(sum(count(*)) OVER () AS INTEGER) AS all_permits
FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 2000 GROUP BY 1, 2""",

    "exported_views": f"""SELECT restype AS label, parcel_count AS n, 'housing' AS view FROM ({_HOUSING})
UNION ALL SELECT permit_type, count(*), 'types' FROM (WITH {_TIMED} SELECT permit_type FROM timed)
GROUP BY 1""",

    "table_profile": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({w} AS BIGINT) AS column_count "
        f"FROM {t}" for t, w in _TABLE_WIDTHS.items()),

    "label_texts": f"""SELECT o_orderkey,
       {_initcap("replace(o_orderpriority, ' ', '/')")} AS words,
       {_spaced('o_orderpriority')} AS spaced,
       lpad(CAST(o_custkey % 100 AS VARCHAR), 3, '0') AS code,
       coalesce(map_extract_value(MAP {{{', '.join(f"'{c}': '{n}'" for c, n, _, _ in COUNTIES)}}},
                lpad(CAST(o_custkey % 100 AS VARCHAR), 3, '0')),
                lpad(CAST(o_custkey % 100 AS VARCHAR), 3, '0')) AS county,
       year(o_orderdate) || ' Q' || quarter(o_orderdate) AS quarter,
       '$' || format('{{:,.2f}}', o_totalprice) AS price_text,
       CASE WHEN o_orderkey % 4 > 1 THEN CAST(o_orderkey AS DOUBLE) END AS number
FROM orders""",
}

_QUANTILES = ", ".join(f"round(quantile_cont(l_extendedprice, 0.{q}), 4) AS p{q}0" for q in (1, 5, 9))

# One row for each permit number: the highest cost, then the other columns.
_PERMITS = """
keyed AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS permit_number, l_orderkey AS o,
         year(l_shipdate) AS issued_year, CAST(l_extendedprice AS DECIMAL(18,2)) AS cost,
         CAST(l_shipdate AS DATE) AS as_of FROM lineitem),
permits AS (
  SELECT * FROM keyed
  QUALIFY row_number() OVER (PARTITION BY permit_number ORDER BY cost DESC, o DESC, issued_year DESC, as_of DESC) = 1)"""


def _diamond(r: str) -> str:
    """How many edges of a diamond around (s_acctbal, sy) a ray to the right from (x, y) crosses."""
    corners = [(f"(s_acctbal + {dx})", f"(sy + {dy})") for dx, dy in (
        (r, "0"), ("0", r), (f"(-{r})", "0"), ("0", f"(-{r})"))]
    return " + ".join(
        f"CAST(({y1} > y) <> ({y2} > y) AND x < ({x2} - {x1}) * (y - {y1}) / ({y2} - {y1}) + {x1} AS INTEGER)"
        for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1]))


def _votes(name: str, kind: str, nulls: str, counts: str, least: str, most: str) -> str:
    n = dict.fromkeys(("boolean", "bigint", "double", "date", "timestamp_ntz"), "0") | dict(
        pair.split("=") for pair in counts.split())
    votes = ", ".join(f"CAST({v.replace('all', 'count(*)').replace('known', 'count(*) FILTER (o_orderkey % 3 <> 0)').replace('digits', 'count(*) FILTER (o_orderkey % 100 <> 1)')} AS BIGINT) AS n_{k}"
                      for k, v in n.items())
    return (f"SELECT '{name}' AS column_name, '{kind}' AS voted_type, count(*) AS rows, CAST({nulls} AS BIGINT) AS nulls, "
            f"{votes}, {least} AS least, {most} AS most FROM orders")


def _text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


ORACLE_SQL |= {
    "csv_split_multiline": ORACLE_SQL["csv_export_multiline"],
    "merged_trend": ORACLE_SQL["permits_trend"],
    "merged_activity": ORACLE_SQL["neighborhood_activity"],
    "merged_quality": ORACLE_SQL["quality_summary"],
    "merged_stats": ORACLE_SQL["processing_stats"],
    "bucketed_stats": ORACLE_SQL["processing_stats"],
    "merged_quantiles": f"SELECT l_returnflag, {_QUANTILES} FROM lineitem GROUP BY 1",

    "report_pack": f"""
SELECT 'trend' AS report, CAST(issued_year AS VARCHAR) AS label, permit_type AS second, permit_count AS n,
       CAST(NULL AS DOUBLE) AS amount
FROM (WITH {_TIMED} SELECT issued_year, permit_type, count(*) AS permit_count FROM timed
      WHERE issued_year BETWEEN 1996 AND 2000 GROUP BY ALL)
UNION ALL SELECT 'places', neighborhood, NULL, total_permits, avg_processing_days
FROM ({ORACLE_SQL["neighborhood_activity"]})
UNION ALL SELECT 'quality', NULL, NULL, total_rows, avg_processing_days FROM ({ORACLE_SQL["quality_summary"]})
UNION ALL SELECT 'stats', permit_type, NULL, count, median_days FROM ({ORACLE_SQL["processing_stats"]})
UNION ALL SELECT 'uses', segment, permit_type, n, NULL FROM (
    WITH {_PLACED} SELECT segment, permit_type, count(*) AS n FROM placed WHERE segment <> permit_type
    GROUP BY ALL ORDER BY n DESC, segment, permit_type LIMIT 15)""",

    "upserted_permits": f"""WITH {_PERMITS}
SELECT permit_number,
       round(CAST(CASE WHEN o % 17 = 0 OR o % 7 = 0 THEN cost * 2 ELSE cost END AS DOUBLE), 4) AS cost,
       CASE WHEN o % 17 = 0 OR o % 7 = 0 THEN as_of + 30 ELSE as_of END AS as_of,
       CASE WHEN o % 7 = 0 THEN issued_year + 1 ELSE issued_year END AS issued_year
FROM permits WHERE o % 13 <> 0 OR o % 17 = 0""",

    "landed_responses": "SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS tract FROM customer",

    "top_parts": """SELECT l_partkey, count(*) AS score FROM lineitem GROUP BY 1
ORDER BY score DESC, l_partkey LIMIT 15""",

    "column_votes": " UNION ALL ".join([
        _votes("o_orderkey", "bigint", "0", "bigint=all double=all", _text("min(o_orderkey)"), _text("max(o_orderkey)")),
        _votes("o_totalprice", "double", "0", "bigint=0 double=all", "NULL", "NULL"),
        _votes("o_orderdate", "date", "0", "date=all timestamp_ntz=all",
               "strftime(min(o_orderdate), '%Y-%m-%d 00:00:00')", "strftime(max(o_orderdate), '%Y-%m-%d 00:00:00')"),
        _votes("o_orderstatus", "string", "0", "bigint=0", "min(o_orderstatus)", "max(o_orderstatus)"),
        _votes("o_custkey", "bigint", "count(*) FILTER (o_orderkey % 3 = 0)", "bigint=known double=known",
               _text("min(o_custkey) FILTER (o_orderkey % 3 <> 0)"), _text("max(o_custkey) FILTER (o_orderkey % 3 <> 0)")),
        _votes("is_even", "boolean", "0", "boolean=all", "min(CAST(o_orderkey % 2 = 0 AS VARCHAR))",
               "max(CAST(o_orderkey % 2 = 0 AS VARCHAR))"),
        _votes("mixed", "string", "0", "bigint=digits double=digits",
               "min(CASE WHEN o_orderkey % 100 = 1 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END)",
               "max(CASE WHEN o_orderkey % 100 = 1 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END)")]),

    "customers_in_areas": f"""WITH points AS (
  SELECT c_custkey, c_acctbal AS x, CAST(c_custkey * 37 % 10000 AS DOUBLE) AS y FROM customer),
areas AS (SELECT s_suppkey, s_acctbal, s_suppkey * 53 % 10000 AS sy, 200 + s_nationkey * 40 AS r FROM supplier)
SELECT c_custkey, s_suppkey AS area FROM points, areas
WHERE ({_diamond('r')} + {_diamond('(r / 4)')}) % 2 = 1""",
}
