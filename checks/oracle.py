"""SQL counterparts of the registered queries, written independently of the Spark code.

Each query is composed of named views; ``_compose`` prepends the ones it needs.
"""

from __future__ import annotations

import re

_BREAKS = r"""\s!?@"^#$&~_,.:;+*%/|\\\[\](){}<>-"""


def _title(expr: str) -> str:
    words = f"regexp_extract_all(lower({expr}), '[^{_BREAKS}]+|[{_BREAKS}]+')"
    return (
        f"CASE WHEN {expr} IS NOT NULL THEN "
        f"array_to_string(list_transform({words}, lambda w: upper(w[1:1]) || w[2:]), '') END"
    )


def _region(key: str, fallback: str) -> str:
    return (
        f"CASE left({key}, 1) WHEN '1' THEN 'Manhattan' WHEN '2' THEN 'Bronx' WHEN '3' THEN 'Brooklyn' "
        f"WHEN '4' THEN 'Queens' WHEN '5' THEN 'Staten Island' "
        f"ELSE coalesce({_title(f'nullif(nullif({fallback}, {chr(39)}Unspecified{chr(39)}), {chr(39)}{chr(39)})')}, 'Unknown') END"
    )


def _clean(n: str) -> str:
    return (
        f"cast({n} % 5 + 1 AS varchar) || lpad(cast({n} % 100000 AS varchar), 5, '0') "
        f"|| lpad(cast({n} % 97 AS varchar), 4, '0')"
    )


def _label(year: str) -> str:
    return f"cast({year} AS varchar) || '-' || lpad(cast(({year} + 1) % 100 AS varchar), 2, '0')"


def _minutes(a: str, b: str) -> str:
    return f"CASE WHEN {b} >= {a} THEN date_diff('minute', {a}, {b}) END"


_BAND = (
    "CASE WHEN {0} IS NULL THEN NULL WHEN {0} <= 25 THEN '1-25' WHEN {0} <= 50 THEN '26-50' "
    "WHEN {0} <= 75 THEN '51-75' ELSE '76-100' END"
)
_ERA = (
    "CASE WHEN {0} IS NULL OR {0} <= 0 THEN NULL WHEN {0} <= 1929 THEN 'pre-1930' "
    "WHEN {0} <= 1959 THEN '1930-59' WHEN {0} <= 1989 THEN '1960-89' ELSE '1990+' END"
)

_VIEWS: dict[str, str] = {
    "base_c": f"""
        SELECT cast(o_orderkey AS varchar) AS unique_key,
               o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS created_at,
               (SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey)
                   + to_seconds((o_orderkey * 104729) % 86400) AS closed_at,
               CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS status,
               CASE WHEN o_totalprice < 20000 THEN 'PLUMBING' ELSE 'HEAT/HOT WATER' END AS complaint_type,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'NO HEAT' WHEN '2-HIGH' THEN 'NO HEAT AND NO HOT WATER'
                    WHEN '3-MEDIUM' THEN 'NO HOT WATER' WHEN '5-LOW' THEN 'HEAT ON IN SUMMER' END AS descriptor_detail,
               CASE o_orderstatus WHEN 'F' THEN 'STATEN ISLAND' WHEN 'O' THEN 'Unspecified' ELSE '' END AS borough,
               CASE WHEN o_custkey % 53 = 0 THEN 'Unspecified' ELSE {_clean('o_custkey')} END AS bbl,
               40.3::DOUBLE + (o_custkey % 800)::DOUBLE * 0.001::DOUBLE AS latitude,
               -74.4::DOUBLE + (o_orderkey % 900)::DOUBLE * 0.001::DOUBLE AS longitude,
               strftime(o_orderdate, '%Y-%m') AS created_month, o_orderstatus AS code
        FROM orders""",
    "rc": """
        SELECT * EXCLUDE (code, created_month), TIMESTAMP '2001-09-01' AS updated_at,
               'created_month=' || created_month AS source_file, TIMESTAMP '2001-09-01' AS loaded_at
        FROM base_c
        UNION ALL
        SELECT * EXCLUDE (code, created_month) REPLACE (CASE code WHEN 'O' THEN 'Closed' ELSE status END AS status),
               CASE code WHEN 'O' THEN TIMESTAMP '2001-09-03' ELSE TIMESTAMP '2001-09-01' END,
               'dt=2001-09-03', TIMESTAMP '2001-09-03'
        FROM base_c WHERE code <> 'F'""",
    "stg": """
        SELECT unique_key AS complaint_id, * EXCLUDE (unique_key) FROM rc
        QUALIFY row_number() OVER (PARTITION BY unique_key
                                   ORDER BY updated_at DESC NULLS LAST, source_file DESC) = 1""",
    "base_p": f"""
        SELECT y AS yr, cast(y AS varchar) AS report_year, cast(p_partkey AS varchar) AS property_id,
               p_name AS property_name, p_partkey AS k, p_brand,
               CASE p_partkey % 12
                    WHEN 0 THEN cast(p_partkey % 5 + 1 AS varchar) || '-' || cast(p_partkey % 100000 AS varchar)
                                || '-' || cast(p_partkey % 97 AS varchar)
                    WHEN 5 THEN {_clean('p_partkey')} || '; ' || {_clean('(p_partkey + 1)')}
                    WHEN 1 THEN {_clean('p_partkey')} || ', ' || {_clean('(p_partkey + 1)')}
                    WHEN 2 THEN '0000000001, 0000000002' WHEN 3 THEN 'Not Available' WHEN 4 THEN '1-2-3-4'
                    WHEN 7 THEN cast(p_partkey % 5 + 1 AS varchar) || '/' || cast(p_partkey % 100000 AS varchar)
                    ELSE {_clean('p_partkey')} END AS bbl_raw,
               CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'Office' ELSE 'Multifamily Housing' END AS primary_property_type,
               CASE WHEN p_partkey % 9 = 0 THEN 'Not Available' ELSE cast(p_size * 2 AS varchar) END AS score,
               CASE WHEN p_partkey % 31 = 0 THEN 'Not Available' WHEN p_partkey % 37 = 0 THEN '0'
                    WHEN p_partkey % 29 = 0 THEN cast(1900 + p_partkey % 125 AS varchar) || '.5'
                    ELSE cast(1900 + p_partkey % 125 AS varchar) END AS built,
               CASE WHEN p_partkey % 41 = 0 THEN '0'
                    ELSE cast(cast(trunc(p_retailprice * 100) AS bigint) AS varchar) END AS gfa,
               cast(p_partkey AS varchar) || ' ' || p_name || ' st-east' AS address
        FROM part, (SELECT unnest(range(1993, 1998)) AS y)""",
    "rp": """
        SELECT * EXCLUDE (k, p_brand), TIMESTAMP '2001-01-15' AS report_generated_at,
               TIMESTAMP '2001-09-02' AS loaded_at, 'report_year=' || report_year AS source_file FROM base_p
        UNION ALL
        SELECT * EXCLUDE (k, p_brand) REPLACE ('1' AS score), TIMESTAMP '2000-12-01', TIMESTAMP '2001-09-02',
               'report_year=' || report_year FROM base_p WHERE yr < 1996 AND p_brand IN ('Brand#7', 'Brand#8')
        UNION ALL
        SELECT * EXCLUDE (k, p_brand) REPLACE ('50' AS score), TIMESTAMP '2001-02-01', TIMESTAMP '2001-08-01',
               'report_year=' || report_year FROM base_p WHERE yr = 1996""",
    "cur_p": """
        SELECT * FROM rp QUALIFY loaded_at = max(loaded_at) OVER (PARTITION BY source_file)""",
    "props": """
        SELECT report_year || '-' || property_id AS property_year_id, cast(yr AS integer) AS report_year, property_id,
               property_name, bbl_raw, primary_property_type,
               cast(round(try_cast(built AS double)) AS integer) AS year_built,
               cast(round(try_cast(score AS double)) AS integer) AS energy_star_score,
               try_cast(gfa AS double) AS gfa_sqft, address, report_generated_at, source_file, loaded_at
        FROM cur_p
        QUALIFY row_number() OVER (PARTITION BY report_year, property_id
                                   ORDER BY report_generated_at DESC NULLS LAST, gfa DESC NULLS LAST) = 1""",
    "pieces": """
        SELECT property_year_id, trim(x) AS piece
        FROM (SELECT property_year_id, unnest(string_split(replace(bbl_raw, ';', ','), ',')) AS x FROM props)""",
    # digit groups taken by one pattern and put together as a number
    "keyed": r"""
        SELECT DISTINCT property_year_id, cast(number AS varchar) AS bbl FROM (
            SELECT property_year_id,
                   CASE WHEN len(g.b) = 0 AND len(g.a) = 10 THEN cast(g.a AS bigint)
                        WHEN len(g.a) = 1 AND len(g.b) BETWEEN 1 AND 5 AND len(g.c) BETWEEN 1 AND 4
                        THEN cast(g.a AS bigint) * 1000000000 + cast(g.b AS bigint) * 10000 + cast(g.c AS bigint) END AS number
            FROM (SELECT property_year_id, regexp_extract(piece, '^([0-9]+)(?:-([0-9]+)-([0-9]+))?$', ['a', 'b', 'c']) AS g
                  FROM pieces))
        WHERE number BETWEEN 1000000000 AND 5999999999""",
    "pl": """
        SELECT p.report_year, p.property_id, p.property_year_id, p.primary_property_type, p.energy_star_score,
               p.gfa_sqft, p.year_built, p.address, n.n_lots, q.bbl, p.gfa_sqft / n.n_lots AS gfa_share_sqft
        FROM keyed q JOIN props p USING (property_year_id)
        JOIN (SELECT property_year_id, count(*) AS n_lots FROM keyed GROUP BY 1) n USING (property_year_id)""",
    "dim": f"""
        SELECT cast(report_year AS varchar) || '-' || bbl AS lot_year_id, a.*,
               energy_star_score IS NOT NULL AS has_energy_star_score,
               {_BAND.format('energy_star_score')} AS energy_star_band, {_ERA.format('year_built')} AS era
        FROM (SELECT report_year, bbl, count(DISTINCT property_id) AS n_properties,
                     sum(gfa_share_sqft) AS total_gfa_sqft,
                     sum(gfa_share_sqft) FILTER (energy_star_score IS NOT NULL) AS scored_gfa_sqft,
                     round(sum(energy_star_score * gfa_share_sqft)
                           / nullif(sum(gfa_share_sqft) FILTER (energy_star_score IS NOT NULL), 0), 4) AS energy_star_score,
                     first(year_built ORDER BY gfa_share_sqft DESC NULLS LAST, property_id DESC) AS year_built
              FROM pl WHERE primary_property_type = 'Multifamily Housing' GROUP BY report_year, bbl) a
        WHERE total_gfa_sqft > 0""",
    "fct": f"""
        SELECT *, CASE WHEN heating_year_start IS NOT NULL
                       THEN least(heating_year_start - 1, (SELECT max(report_year) FROM props)) END AS ll84_report_year
        FROM (SELECT complaint_id, CASE WHEN regexp_full_match(bbl, '[1-5][0-9]{{9}}') THEN bbl END AS bbl,
                     created_at, cast(created_at AS date) AS created_date, closed_at, status, descriptor_detail,
                     coalesce(descriptor_detail IN ('NO HEAT', 'NO HEAT AND NO HOT WATER'), false) AS is_no_heat,
                     borough, cast(hy AS integer) AS heating_year_start,
                     CASE WHEN month(created_at) NOT IN (6, 7, 8, 9) THEN {_label('hy')} END AS heat_season,
                     latitude, longitude
              FROM (SELECT *, CASE WHEN month(created_at) >= 10 THEN year(created_at) ELSE year(created_at) - 1 END AS hy
                    FROM stg) WHERE complaint_type = 'HEAT/HOT WATER')""",
    "season": """
        SELECT heat_season, heating_year_start, ll84_report_year,
               make_date(heating_year_start, 10, 1) >= (SELECT min(created_date) FROM fct WHERE heat_season IS NOT NULL)
               AND make_date(heating_year_start + 1, 5, 31) <= (SELECT max(created_date) FROM fct WHERE heat_season IS NOT NULL)
                   AS is_season_complete
        FROM fct WHERE heat_season IS NOT NULL GROUP BY ALL""",
    "lot_n": """
        SELECT heat_season, bbl, count(*) FILTER (is_no_heat) AS no_heat_complaints, count(*) AS all_heat_complaints
        FROM fct WHERE heat_season IS NOT NULL AND bbl IS NOT NULL GROUP BY 1, 2""",
    "mart": """
        SELECT s.heat_season || '-' || d.bbl AS lot_season_id, s.heat_season, s.ll84_report_year, d.bbl, d.n_properties,
               d.total_gfa_sqft, d.energy_star_score, d.has_energy_star_score, d.energy_star_band, d.year_built, d.era,
               CASE WHEN d.has_energy_star_score THEN cast(ntile(4) OVER (
                    PARTITION BY s.heat_season, d.has_energy_star_score ORDER BY d.total_gfa_sqft, d.bbl) AS integer) END AS size_quartile,
               coalesce(n.no_heat_complaints, 0) AS no_heat_complaints,
               coalesce(n.all_heat_complaints, 0) AS all_heat_complaints,
               coalesce(n.no_heat_complaints, 0) / d.total_gfa_sqft * 100000 AS no_heat_per_100k_sqft,
               s.is_season_complete
        FROM season s JOIN dim d ON d.report_year = s.ll84_report_year
        LEFT JOIN lot_n n ON n.heat_season = s.heat_season AND n.bbl = d.bbl""",
    "daily": f"""
        SELECT created_date AS d, boro, count(*) FILTER (is_no_heat) AS no_heat, count(*) AS all_heat
        FROM (SELECT *, {_region('bbl', 'borough')} AS boro FROM fct) WHERE created_date IS NOT NULL GROUP BY 1, 2""",
    "scored": """
        SELECT heat_season, bbl, energy_star_band AS band, era, energy_star_score, no_heat_complaints AS no_heat,
               total_gfa_sqft AS gfa,
               CASE size_quartile WHEN 1 THEN 'Smallest 25%' WHEN 2 THEN 'Small-mid' WHEN 3 THEN 'Mid-large'
                    WHEN 4 THEN 'Largest 25%' END AS size
        FROM mart WHERE has_energy_star_score""",
    "rlots": f"""
        SELECT heat_season, ll84_report_year, bbl, {_region('bbl', 'NULL::varchar')} AS boro,
               round(energy_star_score, 1) AS score, energy_star_band AS band, era, year_built AS built,
               round(total_gfa_sqft) AS gfa, size_quartile AS size_q, no_heat_complaints AS no_heat,
               all_heat_complaints AS all_heat,
               CASE WHEN round(total_gfa_sqft) > 0 THEN no_heat_complaints / round(total_gfa_sqft) * 100000 END AS rate
        FROM mart""",
    "addr": """
        SELECT report_year, bbl, first(address ORDER BY gfa_share_sqft DESC NULLS LAST, property_id DESC) AS address
        FROM pl WHERE primary_property_type = 'Multifamily Housing' GROUP BY 1, 2""",
    "xlots": f"""
        SELECT r.bbl, r.heat_season, r.boro, r.score, r.band, r.era, r.built, r.gfa, r.size_q, r.no_heat, r.all_heat,
               {_title('a.address')} AS address
        FROM rlots r LEFT JOIN addr a ON a.report_year = r.ll84_report_year AND a.bbl = r.bbl""",
    "cells": f"""
        SELECT heat_season AS season, round(round(latitude / 0.004::DOUBLE) * 0.004::DOUBLE, 4) AS lat,
               round(round(longitude / 0.004::DOUBLE) * 0.004::DOUBLE, 4) AS lon,
               {_region('bbl', 'borough')} AS boro, count(*) AS n
        FROM fct WHERE is_no_heat AND heat_season IS NOT NULL AND latitude BETWEEN 40.4::DOUBLE AND 41.0::DOUBLE
             AND longitude BETWEEN -74.3::DOUBLE AND -73.6::DOUBLE GROUP BY ALL""",
    "sized": """
        SELECT heat_season, bbl, rate, CASE WHEN gfa <= a THEN 1 WHEN gfa <= b THEN 2 WHEN gfa <= c THEN 3 ELSE 4 END AS g
        FROM rlots JOIN (
            SELECT heat_season, s[cast(floor(0.25 * (len(s) - 1)) AS bigint) + 1] AS a,
                   s[cast(floor(0.5 * (len(s) - 1)) AS bigint) + 1] AS b, s[cast(floor(0.75 * (len(s) - 1)) AS bigint) + 1] AS c
            FROM (SELECT heat_season, list(gfa ORDER BY gfa) AS s FROM rlots WHERE gfa > 0 GROUP BY 1)) USING (heat_season)
        WHERE gfa > 0""",
    "spans": """
        SELECT s.heat_season AS season, s.heating_year_start AS y, make_date(s.heating_year_start, 10, 1) AS start,
               least(make_date(s.heating_year_start + 1, 5, 31), (SELECT max(d) FROM daily)) AS upto,
               make_date(s.heating_year_start - 1, 10, 1) >= (SELECT min(d) FROM daily) AS reached
        FROM season s""",
}


def _compose(sql: str) -> str:
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _VIEWS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(_VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    views = ",\n".join(f"{name} AS ({_VIEWS[name].strip()})" for name in needed)
    return f"WITH {views}\n{sql.strip()}"


_RATE = "round(CASE WHEN sum(gfa) > 0 THEN sum(no_heat) / sum(gfa) * 100000 END, 4)"


def _bands(source: str, by: str) -> str:
    return f"""
        SELECT {by}, band, count(bbl) AS lots, cast(coalesce(sum(no_heat), 0) AS bigint) AS complaints,
               coalesce(sum(gfa), 0.0) AS gfa, {_RATE} AS per_100k
        FROM (SELECT DISTINCT {by} FROM {source}) CROSS JOIN (SELECT unnest(['1-25', '26-50', '51-75', '76-100']) AS band)
        LEFT JOIN {source} USING ({by}, band) GROUP BY {by}, band"""


def _cells(by: str, labels: str) -> str:
    """All groups and bands of the seasons, with or without lots."""
    return f"""
        SELECT heat_season, {by}, band, count(bbl) AS lots, cast(coalesce(sum(no_heat), 0) AS bigint) AS complaints,
               coalesce(sum(gfa), 0.0) AS gfa, {_RATE} AS per_100k
        FROM (SELECT * FROM (SELECT DISTINCT heat_season FROM scored WHERE {by} IS NOT NULL),
              (SELECT unnest([{labels}]) AS {by}), (SELECT unnest(['1-25', '26-50', '51-75', '76-100']) AS band))
        LEFT JOIN scored USING (heat_season, {by}, band) GROUP BY ALL"""


def _matrix(by: str, value: str, source: str) -> str:
    cols = ", ".join(
        f"max(CASE WHEN band = '{b}' THEN v END) AS b{b.replace('-', '_')}"
        for b in ("1-25", "26-50", "51-75", "76-100")
    )
    return f"""
        SELECT heat_season, {by}, {cols} FROM (SELECT heat_season, {by}, band, {value} AS v
        FROM {source} GROUP BY ALL) GROUP BY heat_season, {by}"""


def _effect(by: str, where: str = "true") -> str:
    return f"""
        SELECT heat_season, {by}, lo / lo_g * 100000 AS lo_rate, hi / hi_g * 100000 AS hi_rate
        FROM (SELECT heat_season, {by},
                     count(*) FILTER (band = '1-25') AS lo_k, count(*) FILTER (band = '76-100') AS hi_k,
                     sum(no_heat) FILTER (band = '1-25') AS lo, sum(no_heat) FILTER (band = '76-100') AS hi,
                     sum(gfa) FILTER (band = '1-25') AS lo_g, sum(gfa) FILTER (band = '76-100') AS hi_g
              FROM rlots WHERE gfa > 0 AND score IS NOT NULL AND {where} GROUP BY 1, 2)
        WHERE lo_k >= 20 AND hi_k >= 20 AND lo > 0"""


def _match(stage: str, keys: str) -> str:
    return f"""
        SELECT '{stage}' AS stage, round(avg(hit), 4) AS key_rate, round(sum(hit * n) / sum(n), 4) AS volume_rate
        FROM (SELECT n, CASE WHEN c.bbl IN (SELECT k FROM ({keys}) z(k) WHERE k IS NOT NULL) THEN 1 ELSE 0 END AS hit
              FROM (SELECT bbl, count(*) AS n FROM fct WHERE is_no_heat GROUP BY 1) c)"""


_QCUT = """
    CASE WHEN {v} <= c.q1 THEN 'smallest 25%' WHEN {v} <= c.q2 THEN 'small-mid'
         WHEN {v} <= c.q3 THEN 'mid-large' ELSE 'largest 25%' END"""
_CUTS = "quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS q2, quantile_cont({v}, 0.75) AS q3"

_CHECKS = [
    ("stg_complaints.complaint_id unique", "(SELECT complaint_id FROM stg GROUP BY 1 HAVING count(*) > 1)"),
    ("stg_complaints.complaint_id not null", "(SELECT 1 FROM stg WHERE complaint_id IS NULL)"),
    ("stg_properties.property_year_id unique", "(SELECT property_year_id FROM props GROUP BY 1 HAVING count(*) > 1)"),
    ("stg_properties.property_year_id not null", "(SELECT 1 FROM props WHERE property_year_id IS NULL)"),
    ("stg_properties.report_year not null", "(SELECT 1 FROM props WHERE report_year IS NULL)"),
    ("property_lots.bbl not null", "(SELECT 1 FROM pl WHERE bbl IS NULL)"),
    ("complaint_fact.complaint_id unique", "(SELECT complaint_id FROM fct GROUP BY 1 HAVING count(*) > 1)"),
    ("complaint_fact.complaint_id not null", "(SELECT 1 FROM fct WHERE complaint_id IS NULL)"),
    ("lot_dimension.lot_year_id unique", "(SELECT lot_year_id FROM dim GROUP BY 1 HAVING count(*) > 1)"),
    ("lot_dimension.lot_year_id not null", "(SELECT 1 FROM dim WHERE lot_year_id IS NULL)"),
    ("lot_dimension.band accepted", "(SELECT 1 FROM dim WHERE energy_star_band NOT IN ('1-25', '26-50', '51-75', '76-100'))"),
    ("lot_dimension.era accepted", "(SELECT 1 FROM dim WHERE era NOT IN ('pre-1930', '1930-59', '1960-89', '1990+'))"),
    ("lot_dimension.score in range", "(SELECT 1 FROM dim WHERE energy_star_score < 1 OR energy_star_score > 100)"),
    ("lot_season_mart.lot_season_id unique", "(SELECT lot_season_id FROM mart GROUP BY 1 HAVING count(*) > 1)"),
    ("lot_season_mart.lot_season_id not null", "(SELECT 1 FROM mart WHERE lot_season_id IS NULL)"),
    ("lot_season_mart invents nothing",
     "(SELECT 1 FROM (SELECT heat_season, sum(no_heat_complaints) AS a FROM mart GROUP BY 1) JOIN "
     "(SELECT heat_season, count(*) FILTER (is_no_heat) AS b FROM fct WHERE bbl IS NOT NULL GROUP BY 1) "
     "USING (heat_season) WHERE a > b)"),
]
_CHECK_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS \"check\", count(*) = 0 AS passed, count(*) AS failing_rows FROM {rows}"
    for name, rows in _CHECKS
)

_QUERIES: dict[str, str] = {
    # models
    "stg_complaints": """
        SELECT complaint_id, created_at, closed_at, status, complaint_type, descriptor_detail, borough, bbl,
               round(latitude, 4) AS latitude, round(longitude, 4) AS longitude,
               updated_at AS source_updated_at, source_file AS last_seen_in, loaded_at FROM stg""",
    "stg_properties": """
        SELECT property_year_id, report_year, property_id, property_name, bbl_raw, primary_property_type, year_built,
               energy_star_score, gfa_sqft, address, report_generated_at, source_file, loaded_at FROM props""",
    "property_lots": "SELECT * EXCLUDE (address) REPLACE (round(gfa_share_sqft, 4) AS gfa_share_sqft) FROM pl",
    "lot_dimension": """
        SELECT * REPLACE (round(total_gfa_sqft, 4) AS total_gfa_sqft, round(scored_gfa_sqft, 4) AS scored_gfa_sqft)
        FROM dim""",
    "complaint_fact": "SELECT * EXCLUDE (latitude, longitude) FROM fct",
    "lot_season_mart": """
        SELECT * REPLACE (round(total_gfa_sqft, 4) AS total_gfa_sqft,
                          round(no_heat_per_100k_sqft, 4) AS no_heat_per_100k_sqft) FROM mart""",
    "incremental_mart": """
        SELECT * REPLACE (round(total_gfa_sqft, 4) AS total_gfa_sqft,
                          round(no_heat_per_100k_sqft, 4) AS no_heat_per_100k_sqft) FROM mart""",
    "incremental_season_counts": """
        SELECT heat_season, bbl, count(*) FILTER (is_no_heat) AS no_heat_complaints, count(*) AS all_heat_complaints, days
        FROM fct JOIN (SELECT heat_season, count(DISTINCT created_date) AS days FROM fct GROUP BY 1) USING (heat_season)
        GROUP BY heat_season, bbl, days""",
    "lots_export": "SELECT * FROM xlots",
    "lots_files": "SELECT * FROM xlots",
    # extraction and loading
    "incremental_extract": """
        SELECT unique_key, updated_at FROM rc
        WHERE complaint_type = 'HEAT/HOT WATER' AND updated_at > TIMESTAMP '2001-09-01'""",
    "reconcile_counts": """
        SELECT source_file, count(*) AS expected, count(*) FILTER (complaint_type = 'HEAT/HOT WATER') AS collected,
               count(*) = count(*) FILTER (complaint_type = 'HEAT/HOT WATER') AS ok FROM rc GROUP BY 1""",
    "backfill_window": """
        SELECT complaint_id AS unique_key, created_at FROM stg
        WHERE created_at >= TIMESTAMP '1996-01-01' AND created_at < TIMESTAMP '1996-02-01'""",
    "month_windows": """
        SELECT strftime(m, '%Y-%m') AS label, cast(m AS date) AS first_day, cast(m + INTERVAL 1 MONTH AS date) AS next_first_day
        FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate))::TIMESTAMP,
                                            date_trunc('month', max(o_orderdate))::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM orders)""",
    "backfill_month_counts": """
        SELECT strftime(m, '%Y-%m') AS created_month, count(complaint_id) AS n
        FROM (SELECT unnest(generate_series(TIMESTAMP '1994-10-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) AS m)
        LEFT JOIN stg ON date_trunc('month', created_at) = m GROUP BY 1""",
    "load_year_counts": "SELECT report_year, count(*) AS n FROM cur_p GROUP BY 1",
    "available_years": "SELECT report_year, count(*) AS n FROM rp GROUP BY 1",
    "nested_to_json": """
        SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || '}' AS props_json FROM events""",
    "scan_with_lineage": "SELECT o_orderkey, 'orders.parquet' AS source_file FROM orders",
    "rows_per_file": "SELECT source_file, count(*) AS n, max(loaded_at) AS loaded_at FROM rp GROUP BY 1",
    "columnar_export": """
        SELECT list(cast(d AS varchar) ORDER BY d, boro) AS d, list(boro ORDER BY d, boro) AS boro,
               list(no_heat ORDER BY d, boro) AS no_heat, list(all_heat ORDER BY d, boro) AS all_heat FROM daily""",
    "columnar_import": "SELECT cast(d AS varchar) AS d, boro, no_heat, all_heat FROM daily",
    "export_meta": """
        SELECT heat_season AS season, max(ll84_report_year) AS ll84_year, bool_and(is_season_complete) AS complete,
               count(*) AS lots, (SELECT max(created_date) FROM fct) AS data_through,
               (SELECT count(*) FROM fct) AS complaints_total,
               (SELECT count(*) FROM fct WHERE is_no_heat) AS no_heat_total FROM mart GROUP BY 1""",
    "incremental_ingest": "SELECT cast(cast(updated_at AS date) AS varchar) AS dt, count(*) AS n FROM rc GROUP BY 1",
    "ledger_load": "SELECT report_year, count(*) AS n, TIMESTAMP '2001-09-03' AS loaded_at FROM rp GROUP BY 1",
    "ledger_reload": """
        SELECT report_year, count(*) AS n,
               count(CASE report_year WHEN '1993' THEN cast(try_cast(score AS integer) AS varchar) WHEN '1994' THEN NULL
                     WHEN '1997' THEN cast(try_cast(score AS integer) + 1 AS varchar) ELSE score END) AS scores,
               cast(sum(CASE report_year WHEN '1994' THEN NULL WHEN '1997' THEN try_cast(score AS integer) + 1
                        ELSE try_cast(score AS integer) END) AS bigint) AS score_sum
        FROM rp GROUP BY 1""",
    "upsert_latest": "SELECT complaint_id AS unique_key, status, source_file FROM stg",
    "union_by_name": """
        SELECT unique_key, CASE WHEN source_file = 'dt=2001-09-03' THEN status END AS status, source_file FROM rc""",
    "deleted_keys": """
        SELECT complaint_id FROM stg
        WHERE complaint_id NOT IN (SELECT unique_key FROM rc WHERE source_file = 'dt=2001-09-03')""",
    "deleted_keys_by_digest": """
        SELECT complaint_id FROM stg
        WHERE complaint_id NOT IN (SELECT unique_key FROM rc WHERE source_file = 'dt=2001-09-03')""",
    "sketched_lots": """
        SELECT heat_season, borough, count(DISTINCT bbl) AS lots, true AS within_bound
        FROM fct WHERE heat_season IS NOT NULL AND bbl IS NOT NULL GROUP BY 1, 2""",
    "sketched_closing_times": """
        SELECT heat_season, count(closed_at) AS closed, true AS within_bound
        FROM fct WHERE heat_season IS NOT NULL AND closed_at IS NOT NULL GROUP BY 1""",
    "completeness_by_month": """
        SELECT strftime(created_at, '%Y-%m') AS month, count(*) FILTER (source_file <> 'dt=2001-09-03') AS expected,
               count(*) FILTER (source_file = 'dt=2001-09-03') AS got,
               round(count(*) FILTER (source_file = 'dt=2001-09-03')
                     / nullif(count(*) FILTER (source_file <> 'dt=2001-09-03'), 0), 4) AS ratio FROM rc GROUP BY 1""",
    # columns
    "variant_projection": "SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events",
    "tolerant_cast": """
        SELECT property_id, cast(yr AS integer) AS report_year, cast(round(try_cast(score AS double)) AS integer) AS score,
               cast(round(try_cast(built AS double)) AS integer) AS year_built, try_cast(gfa AS double) AS gfa FROM rp""",
    "tolerant_timestamps": """
        SELECT unique_key, created_at, closed_at, updated_at, try_cast(status AS timestamp) AS junk FROM rc""",
    "sentinel_nulls": """
        SELECT property_id, report_year, nullif(score, 'Not Available') AS score_text,
               nullif(nullif(built, 'Not Available'), '0') AS year_text FROM rp""",
    "explode_lot_keys": """
        SELECT report_year, property_id, trim(x) AS piece
        FROM (SELECT report_year, property_id, unnest(regexp_split_to_array(bbl_raw, '[;,]')) AS x FROM rp)""",
    "normalize_lot_keys": "SELECT report_year, property_id, bbl FROM pl",
    "valid_lot_key": """
        SELECT unique_key, CASE WHEN regexp_full_match(bbl, '[1-5][0-9]{9}') THEN bbl END AS bbl FROM rc""",
    "no_heat_flag": """
        SELECT unique_key, coalesce(descriptor_detail IN ('NO HEAT', 'NO HEAT AND NO HOT WATER'), false) AS is_no_heat
        FROM rc WHERE complaint_type = 'HEAT/HOT WATER'""",
    "heat_season_calendar": f"""
        SELECT complaint_id, cast(hy AS integer) AS heating_year_start,
               CASE WHEN month(created_at) >= 10 OR month(created_at) <= 5 THEN {_label('hy')} END AS heat_season
        FROM (SELECT *, year(created_at - INTERVAL 9 MONTH) AS hy FROM stg)""",
    "season_bounds": f"""
        SELECT heat_season, make_date(heating_year_start, 10, 1) AS season_start,
               make_date(heating_year_start + 1, 5, 31) AS season_end, {_label('(heating_year_start - 1)')} AS prev_season
        FROM season""",
    "asof_report_year": "SELECT complaint_id, ll84_report_year FROM fct",
    "score_bands": f"SELECT lot_year_id, {_BAND.format('energy_star_score')} AS band FROM dim",
    "score_bands_cut": f"""
        SELECT lot_year_id, CASE WHEN s BETWEEN 0 AND 100 THEN {_BAND.format('s')} END AS band
        FROM (SELECT lot_year_id, energy_star_score * 1.25::DOUBLE AS s FROM dim)""",
    "era_bands": f"""
        SELECT lot_year_id, era, CASE WHEN year_built + 20 <= 2030 THEN {_ERA.format('(year_built + 20)')} END AS era_cut,
               CASE era WHEN 'pre-1930' THEN 1 WHEN '1930-59' THEN 2 WHEN '1960-89' THEN 3 WHEN '1990+' THEN 4 END AS era_order
        FROM dim""",
    "region_name": f"""
        SELECT complaint_id, {_region('b', 'borough')} AS boro
        FROM (SELECT *, CASE WHEN regexp_full_match(bbl, '[1-5][0-9]{{9}}') THEN bbl END AS b FROM stg)""",
    "title_case": f"""
        SELECT p_partkey, {_title('txt')} AS title
        FROM (SELECT p_partkey, p_name || ' ' || p_type || '/east-o''neil' AS txt FROM part)""",
    "close_hours": f"""
        SELECT complaint_id, round({_minutes('created_at', 'closed_at')} / 60.0::DOUBLE, 4) AS hours FROM stg""",
    "rate_per_100k": """
        SELECT lot_season_id, round(no_heat_complaints / total_gfa_sqft * 100000, 4) AS rate FROM mart""",
    # deduplication and lots
    "dedup_latest": "SELECT complaint_id AS unique_key, status, source_file FROM stg",
    "latest_load": "SELECT property_id, report_year, loaded_at FROM cur_p",
    "dedup_property_year": "SELECT property_year_id, energy_star_score FROM props",
    "even_split": """
        SELECT report_year, property_id, bbl, n_lots, round(gfa_share_sqft, 4) AS gfa_share_sqft FROM pl""",
    "weighted_score": """
        SELECT report_year, bbl, round(sum(energy_star_score * gfa_share_sqft)
               / nullif(sum(CASE WHEN energy_star_score IS NOT NULL THEN gfa_share_sqft END), 0), 4) AS energy_star_score
        FROM pl GROUP BY 1, 2""",
    "biggest_per_lot": """
        SELECT report_year, bbl, property_id, year_built FROM pl
        QUALIFY row_number() OVER (PARTITION BY report_year, bbl ORDER BY gfa_share_sqft DESC NULLS LAST, property_id) = 1""",
    "lot_address": "SELECT report_year, bbl, address FROM addr",
    # profiling
    "key_format_census": """
        SELECT count(*) FILTER (regexp_full_match(bbl_raw, '[0-9]{10}')) AS clean_10,
               count(*) FILTER (contains(bbl_raw, '-')) AS dashed, count(*) FILTER (contains(bbl_raw, ',')) AS comma,
               count(*) FILTER (starts_with(bbl_raw, '0')) AS zero_led FROM rp""",
    "key_format_unknown": """
        SELECT bbl_raw, count(*) AS n FROM rp
        WHERE NOT (regexp_full_match(bbl_raw, '[0-9]{10}') OR regexp_matches(bbl_raw, '[-,]') OR starts_with(bbl_raw, '0'))
        GROUP BY 1""",
    "key_fill_rate": """
        SELECT round(count(bbl) / count(*), 4) AS bbl_rate, round(count(descriptor_detail) / count(*), 4) AS descriptor_detail_rate,
               round(count(closed_at) / count(*), 4) AS closed_at_rate FROM stg""",
    "category_counts": """
        SELECT descriptor_detail, count(*) AS n, round(count(*) / (SELECT count(*) FROM stg), 4) AS share
        FROM stg GROUP BY 1""",
    "duplicated_keys": "SELECT report_year, bbl_raw, count(*) AS n FROM rp GROUP BY 1, 2 HAVING count(*) > 1",
    "duplicated_rows": """
        SELECT report_year, bbl_raw, property_id FROM rp QUALIFY count(*) OVER (PARTITION BY report_year, bbl_raw) > 1""",
    "newest_rows": "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 5",
    "no_heat_by_lot": """
        SELECT bbl, count(*) AS complaints FROM fct
        WHERE is_no_heat AND created_date BETWEEN DATE '1996-01-01' AND DATE '1996-01-31' GROUP BY 1""",
    "match_rates": _match("normalized", "SELECT bbl FROM pl"),
    "match_rates_before_after": _match("raw", "SELECT bbl_raw FROM props")
    + " UNION ALL "
    + _match("normalized", "SELECT bbl FROM pl"),
    # ranks
    "size_quartile": """
        SELECT lot_year_id, cast(ntile(4) OVER (PARTITION BY report_year ORDER BY total_gfa_sqft, bbl) AS integer) AS size_quartile
        FROM dim WHERE has_energy_star_score""",
    "size_qcut": f"""
        SELECT lot_year_id, {_QCUT.format(v='total_gfa_sqft')} AS size_band FROM dim d
        JOIN (SELECT report_year, {_CUTS.format(v='total_gfa_sqft')} FROM dim WHERE has_energy_star_score GROUP BY 1) c
        USING (report_year) WHERE d.has_energy_star_score""",
    "peer_comparison": """
        SELECT p.heat_season, p.bbl, cast(p.g AS integer) AS size_group, p.peers,
               round(m.med, 4) AS peer_median,
               cast(round((p.rk - 1) / p.peers * 100) AS bigint) AS pct_below
        FROM (SELECT *, count(*) OVER (PARTITION BY heat_season, g) AS peers,
                     rank() OVER (PARTITION BY heat_season, g ORDER BY rate) AS rk FROM sized) p
        JOIN (SELECT heat_season, g, r[cast(floor(len(r) / 2) AS bigint) + 1] AS med
              FROM (SELECT heat_season, g, list(rate ORDER BY rate) AS r FROM sized GROUP BY 1, 2)) m
        USING (heat_season, g)""",
    "grid_hotspots": "SELECT * FROM cells",
    "hotspot_classes": """
        SELECT season, lat, lon, boro, n, CASE WHEN n <= a THEN 0 WHEN n <= b THEN 1 WHEN n <= c THEN 2 ELSE 3 END AS "class",
               round(2 + sqrt(n / top) * 11, 4) AS radius
        FROM cells JOIN (
            SELECT season, s[cast(floor(0.5 * (len(s) - 1)) AS bigint) + 1] AS a, s[cast(floor(0.8 * (len(s) - 1)) AS bigint) + 1] AS b,
                   s[cast(floor(0.95 * (len(s) - 1)) AS bigint) + 1] AS c, s[len(s)] AS top
            FROM (SELECT season, list(n ORDER BY n) AS s FROM cells GROUP BY 1)) USING (season)""",
    # counts and rates
    "daily_region_counts": "SELECT * FROM daily",
    "monthly_counts": """
        SELECT cast(date_trunc('month', created_date) AS date) AS month, count(*) FILTER (is_no_heat) AS no_heat,
               count(*) FILTER (NOT is_no_heat) AS other_heat_hot_water FROM fct GROUP BY 1""",
    "counts_by_lot_season": "SELECT * FROM lot_n",
    "season_completeness": "SELECT heat_season, is_season_complete FROM season",
    "season_lots": """
        SELECT s.heat_season, d.report_year, d.bbl FROM season s JOIN dim d ON d.report_year = s.ll84_report_year""",
    "season_region_rollup": f"""
        SELECT * FROM (WITH rows AS (SELECT heat_season AS season, {_region('bbl', 'borough')} AS boro, bbl, is_no_heat,
                             {_minutes('created_at', 'closed_at')} AS mins FROM fct WHERE heat_season IS NOT NULL),
        levels AS (FROM rows UNION ALL SELECT * REPLACE ('All' AS boro) FROM rows),
        lots AS (SELECT season, boro, count(*) AS buildings
                 FROM (SELECT DISTINCT season, boro, bbl FROM levels WHERE is_no_heat AND bbl IS NOT NULL) GROUP BY 1, 2),
        seats AS (SELECT season, boro, mins, row_number() OVER w AS seat, count(*) OVER (PARTITION BY season, boro) AS taken
                  FROM levels WHERE is_no_heat AND mins IS NOT NULL WINDOW w AS (PARTITION BY season, boro ORDER BY mins)),
        middle AS (SELECT season, boro, taken, avg(mins) / 60 AS hours FROM seats
                   WHERE 2 * seat BETWEEN taken AND taken + 2 GROUP BY 1, 2, 3)
        SELECT s.season, s.boro, coalesce(buildings, 0) AS buildings, round(hours, 4) AS median_close_hours,
               coalesce(taken, 0) AS closed
        FROM (SELECT DISTINCT season, boro FROM levels) s
        LEFT JOIN lots USING (season, boro) LEFT JOIN middle USING (season, boro))""",
    "season_summary": """
        SELECT heat_season, max(ll84_report_year) AS ll84_year, bool_and(is_season_complete) AS complete, count(*) AS lots
        FROM mart GROUP BY 1""",
    "season_kpis": """
        SELECT heat_season, count(*) AS lots, count(*) FILTER (has_energy_star_score) AS scored_lots,
               cast(sum(no_heat_complaints) AS bigint) AS matched,
               (SELECT count(*) FROM fct f WHERE f.is_no_heat AND f.heat_season = mart.heat_season) AS no_heat,
               (SELECT max(created_date) FROM fct) AS data_through FROM mart GROUP BY 1""",
    "latest_complete_season": """
        SELECT heat_season FROM (SELECT heat_season, bool_and(is_season_complete) AS c FROM mart GROUP BY 1)
        ORDER BY c DESC, heat_season DESC LIMIT 1""",
    "rates_by_band": _bands("scored", "heat_season"),
    "rates_by_size": _cells("size", "'Smallest 25%', 'Small-mid', 'Mid-large', 'Largest 25%'"),
    "rates_by_era": _cells("era", "'pre-1930', '1930-59', '1960-89', '1990+'"),
    "random_points": """
        SELECT heat_season AS season, complaint_id, round(latitude, 4) AS lat, round(longitude, 4) AS lon FROM fct
        WHERE is_no_heat AND heat_season IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY heat_season ORDER BY md5('7:' || complaint_id)) <= 20000""",
    "fact_coordinates": """
        SELECT f.complaint_id, round(s.latitude, 4) AS latitude, round(s.longitude, 4) AS longitude
        FROM fct f JOIN stg s USING (complaint_id)""",
    "rate_matrix": _matrix("size", _RATE, "scored"),
    "lots_matrix": _matrix("era", "count(*)", "scored WHERE era IS NOT NULL"),
    "size_summary": f"""
        SELECT heat_season, {_QCUT.format(v='gfa')} AS size_band, count(*) AS lots, cast(sum(no_heat) AS bigint) AS complaints,
               sum(gfa) AS gfa, round(avg(energy_star_score), 4) AS avg_score, {_RATE} AS per_100k
        FROM scored JOIN (SELECT heat_season, {_CUTS.format(v='gfa')} FROM scored GROUP BY 1) c USING (heat_season)
        GROUP BY 1, 2""",
    "weekly_trend": """
        SELECT season, cast(w AS integer) AS week, cast(start + cast(7 * w AS integer) AS date) AS week_start,
               (SELECT cast(coalesce(sum(no_heat), 0) AS bigint) FROM daily
                WHERE d BETWEEN start + cast(7 * w AS integer) AND least(start + cast(7 * w + 6 AS integer), upto)) AS n,
               start + cast(7 * w + 6 AS integer) > upto AS is_partial
        FROM (SELECT *, unnest(range(0, cast(floor((upto - start) / 7) AS bigint) + 1)) AS w FROM spans WHERE upto >= start)""",
    "season_to_date": """
        SELECT season, cur, CASE WHEN reached THEN prev END AS prev,
               CASE WHEN reached AND prev > 0 THEN round((cur - prev) / prev * 100, 4) END AS pct_change
        FROM (SELECT season, reached,
                     (SELECT cast(coalesce(sum(no_heat), 0) AS bigint) FROM daily WHERE d BETWEEN start AND upto) AS cur,
                     (SELECT cast(coalesce(sum(no_heat), 0) AS bigint) FROM daily
                      WHERE d BETWEEN make_date(y - 1, 10, 1) AND make_date(y - 1, 10, 1) + cast(upto - start AS integer)) AS prev
              FROM spans)""",
    "benchmarked_share": """
        SELECT heat_season, count(*) FILTER (no_heat > 0) AS flagged_lots, cast(sum(no_heat) AS bigint) AS on_lots,
               (SELECT count(*) FROM fct f WHERE f.is_no_heat AND f.heat_season = rlots.heat_season) AS total,
               round(sum(no_heat) / (SELECT count(*) FROM fct f WHERE f.is_no_heat AND f.heat_season = rlots.heat_season), 4) AS share
        FROM rlots GROUP BY heat_season""",
    "band_effect": f"""
        SELECT heat_season, size_q, round(lo_rate, 4) AS lo_rate, round(hi_rate, 4) AS hi_rate,
               round((hi_rate - lo_rate) / lo_rate * 100, 4) AS effect_pct FROM ({_effect('size_q')})""",
    "band_effect_verdict": f"""
        SELECT heat_season, count(*) AS "groups", count(*) FILTER (hi_rate < lo_rate) AS better
        FROM ({_effect('era', 'era IS NOT NULL')}) GROUP BY 1""",
    "window_band_check": """
        SELECT * FROM (WITH snapshot AS (SELECT energy_star_band AS band, bbl, total_gfa_sqft AS gfa FROM dim
                          WHERE report_year = 1994 AND has_energy_star_score),
        hits AS (SELECT bbl FROM fct WHERE is_no_heat AND strftime(created_date, '%Y-%m') = '1996-01'),
        touched AS (SELECT band, count(DISTINCT bbl) AS reached, count(*) AS hit FROM snapshot JOIN hits USING (bbl) GROUP BY 1)
        SELECT band, lots, round(coalesce(reached, 0) / lots, 3) AS pct_with_complaint,
               coalesce(hit, 0) AS complaints, round(coalesce(hit, 0) / gfa * 100000, 3) AS per_100k_sqft
        FROM (SELECT band, count(*) AS lots, sum(gfa) AS gfa FROM snapshot GROUP BY 1) LEFT JOIN touched USING (band))""",
    "top_lots": """
        SELECT heat_season, r.bbl, round(r.energy_star_score) AS energy_star, r.energy_star_band, r.era, r.year_built,
               round(r.total_gfa_sqft) AS floor_area_sqft, r.no_heat_complaints,
               round(r.no_heat_per_100k_sqft, 1) AS per_100k_sqft
        FROM (SELECT heat_season, unnest(list(mart ORDER BY no_heat_per_100k_sqft DESC, bbl)[1:25]) AS r
              FROM mart WHERE total_gfa_sqft >= 50000 GROUP BY heat_season)""",
    "leaderboard": """
        SELECT heat_season, bbl, boro, no_heat, score, round(rate, 4) AS rate FROM rlots
        WHERE gfa >= 50000 AND no_heat >= 2
        QUALIFY row_number() OVER (PARTITION BY heat_season ORDER BY no_heat DESC, bbl) <= 25""",
    "entity_search": """
        SELECT 'text' AS searched, heat_season, bbl, no_heat FROM xlots
        WHERE contains(lower(coalesce(address, '')) || ' ' || bbl, 'widget')
        QUALIFY row_number() OVER (PARTITION BY heat_season ORDER BY no_heat DESC, bbl) <= 8
        UNION ALL
        SELECT 'key', heat_season, bbl, no_heat FROM xlots WHERE starts_with(bbl, '30')
        QUALIFY row_number() OVER (PARTITION BY heat_season ORDER BY no_heat DESC, bbl) <= 8""",
    "entity_search_index": """
        SELECT 'text' AS searched, heat_season, bbl, no_heat FROM xlots
        WHERE contains(lower(coalesce(address, '')) || ' ' || bbl, 'widget')
        QUALIFY row_number() OVER (PARTITION BY heat_season ORDER BY no_heat DESC, bbl) <= 8
        UNION ALL
        SELECT 'key', heat_season, bbl, no_heat FROM xlots WHERE starts_with(bbl, '30')
        QUALIFY row_number() OVER (PARTITION BY heat_season ORDER BY no_heat DESC, bbl) <= 8""",
    "poisson_score_equations": """
        SELECT term, round(sum(x * no_heat_complaints::DOUBLE), 1) AS total FROM (
            SELECT no_heat_complaints, unnest(['Intercept', 'score_10', 'log_gfa', 'era[1930-59]', 'era[1960-89]', 'era[1990+]']) AS term,
                   unnest([1.0::DOUBLE, energy_star_score / 10, ln(total_gfa_sqft), (era = '1930-59')::INT, (era = '1960-89')::INT,
                           (era = '1990+')::INT]) AS x
            FROM mart WHERE has_energy_star_score AND era IS NOT NULL) GROUP BY 1""",
    "poisson_era_rate_ratio": """
        SELECT g.era, round(g.r / b.r, 4) AS rate_ratio, round(sqrt(g.v + b.v), 4) AS se
        FROM (SELECT era, any_value(r) AS r, sum((y - r * a) * (y - r * a)) / (sum(y) * sum(y)) AS v FROM (
                  SELECT era, no_heat_complaints::DOUBLE AS y, total_gfa_sqft AS a,
                         sum(no_heat_complaints::DOUBLE) OVER (PARTITION BY era) / sum(total_gfa_sqft) OVER (PARTITION BY era) AS r
                  FROM mart WHERE has_energy_star_score AND era IS NOT NULL) GROUP BY era) g,
             (SELECT any_value(r) AS r, sum((y - r * a) * (y - r * a)) / (sum(y) * sum(y)) AS v FROM (
                  SELECT no_heat_complaints::DOUBLE AS y, total_gfa_sqft AS a,
                         sum(no_heat_complaints::DOUBLE) OVER () / sum(total_gfa_sqft) OVER () AS r
                  FROM mart WHERE has_energy_star_score AND era = 'pre-1930')) b
        WHERE g.era <> 'pre-1930'""",
    # quality
    "freshness": """
        SELECT m AS max_loaded, cast(date_diff('day', m, TIMESTAMP '2024-02-04 12:00:00') AS integer) AS age_days,
               CASE WHEN TIMESTAMP '2024-02-04 12:00:00' > m + INTERVAL 5 DAY THEN 'error'
                    WHEN TIMESTAMP '2024-02-04 12:00:00' > m + INTERVAL 3 DAY THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT max(ts) + INTERVAL 8 HOUR AS m FROM events)""",
    "data_health": """
        SELECT cast(DATE '2001-08-04' - max(created_date) AS integer) AS age_days, DATE '2001-08-04' - max(created_date) <= 4 AS fresh,
               count(*) AS complaints_total, count(*) FILTER (is_no_heat) AS no_heat_total,
               (SELECT count(DISTINCT heat_season) FROM mart WHERE is_season_complete) AS complete_seasons FROM fct""",
    "dq_unique": "SELECT unique_key, count(*) AS n FROM rc GROUP BY 1 HAVING count(*) > 1",
    "dq_not_null": "SELECT complaint_id FROM stg WHERE descriptor_detail IS NULL",
    "dq_accepted": """
        SELECT descriptor_detail, count(*) AS n FROM stg
        WHERE descriptor_detail NOT IN ('NO HEAT', 'NO HEAT AND NO HOT WATER') GROUP BY 1""",
    "dq_range": "SELECT lot_year_id, energy_star_score FROM dim WHERE energy_star_score NOT BETWEEN 10 AND 90",
    "dq_no_invented": """
        SELECT heat_season, a AS mart_total, b AS fact_total
        FROM (SELECT heat_season, cast(3 * sum(no_heat_complaints) AS bigint) AS a FROM mart GROUP BY 1)
        JOIN (SELECT heat_season, count(*) FILTER (is_no_heat) AS b FROM fct WHERE bbl IS NOT NULL GROUP BY 1) USING (heat_season)
        WHERE a > b""",
    "dq_summary": _CHECK_ROWS,
    "incremental_checks": """
        SELECT heat_season, count(*) FILTER (is_no_heat) AS fact_total,
               (SELECT count(*) FROM (SELECT complaint_id FROM stg GROUP BY 1 HAVING count(*) > 1 OR complaint_id IS NULL)) AS failing_keys
        FROM fct WHERE heat_season IS NOT NULL AND bbl IS NOT NULL GROUP BY heat_season""",
    "dq_run_summary": f"""
        SELECT '2001-08-04' AS built_at, count(*) AS tests_total, count(*) FILTER (passed) AS tests_passed,
               6::BIGINT AS models_built FROM ({_CHECK_ROWS})""",
}

ORACLE: dict[str, str] = {name: _compose(sql) for name, sql in _QUERIES.items()}
