"""A provider-directory corpus derived from the star-schema tables.

The derivation is SQL text that Spark and DuckDB read alike, so that a query and its oracle start from equal rows. Every
relation is a named step; a step may use the tables and the steps before it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from . import staging

FETCH_DATE = "2026-08-21"
SNAPSHOT = "2026-08"
#: Tables that grow with the records: never broadcast where a step joins them (Spark takes the size of a few columns of compressed files
#: for that of their rows, and 900,000 customers for less than the 41 MB that they fill on the driver).
GROWING = ("customer", "supplier", "part", "orders", "lineitem", "events")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")

_DIGITS = [f"CAST(floor(b / {10**j}) AS BIGINT) % 10" for j in range(9)]
_LUHN = " + ".join(f"CASE WHEN 2 * ({d}) > 9 THEN 2 * ({d}) - 9 ELSE 2 * ({d}) END" if j % 2 == 0 else d for j, d in enumerate(_DIGITS))
_STATE = "substr('ALAZFLGATX', CAST(2 * {} + 1 AS INT), 2)"
_FIPS = "substr('0104121348', CAST(2 * {} + 1 AS INT), 2)"


def _providers(shift: int) -> str:
    """Records of one snapshot; another shift moves every modulus."""
    return f"""
SELECT concat('file-', lpad(CAST(c_nationkey AS STRING), 2, '0')) AS source_sha256, c_custkey AS record_idx,
       CASE WHEN k % 97 = 5 THEN NULL WHEN k % 89 = 5 THEN 'BAD'
            ELSE concat(CAST(b AS STRING), CAST(((10 - (24 + {_LUHN}) % 10) % 10 + CASE WHEN k % 50 = 7 THEN 1 ELSE 0 END) % 10 AS STRING)) END AS npi,
       CASE WHEN k % 10 = 0 THEN 'FACILITY' WHEN k % 10 = 1 THEN 'GROUP' ELSE 'INDIVIDUAL' END AS type,
       CASE WHEN k % 31 = 0 OR k % 10 = 0 THEN NULL ELSE 'Pat' END AS name_first,
       CASE WHEN k % 10 = 0 THEN NULL ELSE c_name END AS name_last,
       CASE WHEN k % 10 = 0 AND k % 20 <> 0 THEN concat('Center ', CAST(k AS STRING)) ELSE NULL END AS facility_name,
       CASE WHEN k % 20 = 2 THEN NULL WHEN k % 20 = 3 THEN 'unknown' WHEN k % 20 = 4 THEN 'not accepting' ELSE 'accepting' END AS accepting,
       CASE WHEN k % 40 = 9 THEN '1900-01-01' WHEN k % 40 = 19 THEN NULL
            ELSE CAST(DATE '{FETCH_DATE}' - CAST((7 * k) % 500 AS INT) AS STRING) END AS last_updated_on,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Psychiatry' WHEN 'MACHINERY' THEN 'Diagnostic Radiology'
            WHEN 'HOUSEHOLD' THEN 'Counselor|Psychology' WHEN 'FURNITURE' THEN 'Physical Therapy'
            ELSE CASE k % 4 WHEN 0 THEN 'MENTAL Health Aide|Nutrition' WHEN 1 THEN 'Developmental Aide' WHEN 2 THEN ' psychologist |Physical Therapy' ELSE NULL END END AS specialties
FROM (SELECT *, c_custkey + {shift} AS k, 100000000 + c_custkey AS b FROM customer) t"""


_COUNTY = f"concat({_FIPS.format('floor((p % 500) / 100)')}, lpad(CAST(CAST(2 * floor((p % 100) / 10) + 1 AS BIGINT) AS STRING), 3, '0'))"

STEPS: dict[str, str] = {
    "providers": _providers(0),
    "providers_before": _providers(3),
    "provider_addresses": f"""
SELECT concat('file-', lpad(CAST(c_nationkey AS STRING), 2, '0')) AS source_sha256, o_custkey AS record_idx,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS addr_idx,
       CASE WHEN o % 41 = 0 THEN 'null' WHEN o % 43 = 0 THEN NULL ELSE concat(CAST(o % 900 AS STRING), ' Main St') END AS address,
       concat('City', CAST(o % 50 AS STRING)) AS city, {_STATE.format('(o % 5)')} AS state,
       CASE WHEN o % 37 = 0 THEN '99999' WHEN o % 53 = 0 THEN '123'
            ELSE CAST(10000 + (o % 5) * 100 + (o_custkey % 10) * 10 + o % 2 AS STRING) END AS zip,
       CASE WHEN o % 101 = 0 THEN '9999999999' WHEN o % 103 = 0 THEN NULL
            WHEN o_custkey % 6 = 0 OR o % 3 = 0 THEN concat('(800) 555-', lpad(CAST(c_nationkey AS STRING), 4, '0'))
            ELSE concat('212', CAST(1000000 + o AS STRING)) END AS phone
FROM (SELECT *, o_orderkey AS o FROM orders) t JOIN customer ON o_custkey = c_custkey""",
    "provider_plans": f"""
SELECT concat('file-', lpad(CAST(c_nationkey AS STRING), 2, '0')) AS source_sha256, o_custkey AS record_idx,
       CASE WHEN l_linenumber = 7 THEN 'OTHER' ELSE 'HIOS-PLAN-ID' END AS plan_id_type,
       concat(CAST(10000 + s % 20 AS STRING), {_STATE.format('(s % 5)')},
              lpad(CAST(l_partkey % CASE s % 4 WHEN 0 THEN 20 WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 1 END AS STRING), 7, '0'),
              CASE WHEN l_partkey % 3 = 0 THEN '-01' ELSE '' END) AS plan_id,
       CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN '2025' ELSE '2025|2026' END AS years
FROM (SELECT *, l_suppkey AS s FROM lineitem) t JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE o_custkey % 29 <> 3""",
    "zip_county": f"SELECT DISTINCT CAST(10000 + p % 500 AS STRING) AS zip, {_COUNTY} AS county_fips FROM (SELECT p_partkey AS p FROM part) t",
    "county_adjacency": """
SELECT DISTINCT a.county_fips, b.county_fips AS adjacent_fips FROM zip_county a JOIN zip_county b
ON substr(a.county_fips, 1, 2) = substr(b.county_fips, 1, 2) AND abs(CAST(a.county_fips AS INT) - CAST(b.county_fips AS INT)) <= 2""",
    "plan_attributes": """
SELECT DISTINCT substr(plan_id, 1, 14) AS standardcomponentid, substr(plan_id, 1, 5) AS issuerid, substr(plan_id, 6, 2) AS statecode,
       concat(substr(plan_id, 6, 2), 'S00', CAST(CAST(substr(plan_id, 14, 1) AS INT) % 2 AS STRING)) AS serviceareaid FROM provider_plans""",
    "counties": "SELECT DISTINCT county_fips, substr('ALAZFLGATX', CAST(2 * floor(position(substr(county_fips, 1, 2) IN '0104121348') / 2) + 1 AS INT), 2) AS state FROM zip_county",
    "service_area": """
SELECT DISTINCT issuerid, statecode, serviceareaid, 'Yes' AS coverentirestate, CAST(NULL AS STRING) AS county FROM plan_attributes WHERE substr(serviceareaid, 6, 1) = '1'
UNION ALL
SELECT DISTINCT a.issuerid, a.statecode, a.serviceareaid, 'No', c.county_fips FROM plan_attributes a JOIN counties c ON c.state = a.statecode
WHERE substr(a.serviceareaid, 6, 1) <> '1' AND substr(c.county_fips, 3, 3) <= '007'""",
    "plan_county": """
SELECT DISTINCT a.standardcomponentid AS plan_id, c.county_fips AS fips, a.statecode AS state, concat('County ', c.county_fips) AS county_name,
       concat('Issuer ', a.issuerid) AS issuer_name, concat('Plan ', a.standardcomponentid) AS plan_marketing_name,
       CASE CAST(substr(a.issuerid, 5, 1) AS INT) % 3 WHEN 0 THEN 'Gold' WHEN 1 THEN 'Silver' ELSE 'Bronze' END AS metal_level
FROM plan_attributes a JOIN counties c ON c.state = a.statecode
UNION ALL
SELECT DISTINCT concat('99999', state, '0000001'), county_fips, state, concat('County ', county_fips), 'Issuer 99999', 'Plan without a file', 'Silver' FROM counties""",
    "nppes": """
SELECT npi, CASE WHEN record_idx % 23 = 0 THEN NULL ELSE '1' END AS entity_type, concat('312', CAST(1000000 + record_idx AS STRING)) AS practice_phone,
       CASE WHEN record_idx % 13 = 0 THEN '225100000X' WHEN specialties = 'Psychiatry' THEN '2084P0800X' WHEN specialties = 'Counselor|Psychology' THEN '101YM0800X|225100000X'
            WHEN specialties = 'Diagnostic Radiology' THEN '2085R0202X' ELSE NULL END AS taxonomies
FROM providers WHERE record_idx % 11 <> 0 AND npi IS NOT NULL AND npi <> 'BAD'""",
    "nppes_deactivated": """
SELECT npi, concat(lpad(CAST(1 + record_idx % 12 AS STRING), 2, '0'), '/15/', CAST(2020 + record_idx % 6 AS STRING)) AS deactivation_date
FROM providers WHERE record_idx % 23 = 0 AND npi IS NOT NULL AND npi <> 'BAD'""",
    "nucc_taxonomy": "SELECT column0 AS code FROM (SELECT '2084P0800X' AS column0 UNION ALL SELECT '101YM0800X' UNION ALL SELECT '2084N0400X' UNION ALL SELECT '225100000X' UNION ALL SELECT '2085R0202X' UNION ALL SELECT '363LP0808X') t",
    "manifest": """
SELECT 'provider' AS role, concat('https://www.host', CAST(n_nationkey % 7 AS STRING), '.com/providers-', CAST(n_nationkey AS STRING), '.json') AS url,
       concat('https://www.host', CAST(n_nationkey % 7 AS STRING), '.com/index.json') AS index_url,
       CASE WHEN n_nationkey % 7 = 3 AND n_nationkey > 7 OR n_nationkey % 7 = 5 THEN NULL ELSE concat('file-', lpad(CAST(n_nationkey AS STRING), 2, '0')) END AS sha256 FROM nation
UNION ALL
SELECT DISTINCT 'index', concat('https://www.host', CAST(n_nationkey % 7 AS STRING), '.com/index.json'), CAST(NULL AS STRING),
       CASE WHEN n_nationkey % 7 >= 5 THEN NULL ELSE concat('index-', CAST(n_nationkey % 7 AS STRING)) END FROM nation""",
    "file_issuers": "SELECT DISTINCT source_sha256, substr(plan_id, 1, 5) AS issuer_id FROM provider_plans WHERE plan_id_type = 'HIOS-PLAN-ID'",
}


class Corpus:
    """The relations by name. A step is staged as a table when it is first asked for, like the files that stages of an
    audit hand on; later queries of the application start from there."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.known:
            if name in TABLES:
                self.known[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                sql = STEPS[name]
                used = {k: self[k] for k in (*TABLES, *STEPS) if k != name and _uses(sql, k)}
                for k in used:
                    if k in GROWING and re.search(rf"(?<=JOIN ){k}\b", sql):
                        used[k] = used[k].hint("merge")
                    sql = _replace(sql, k)
                self.known[name] = staging.stage(self.spark.sql(sql, **used))
        return self.known[name]


_LOADED: dict[tuple[str, str], Corpus] = {}


def load(spark: SparkSession, sf_dir: str) -> Corpus:
    """The corpus over the tables of ``sf_dir``."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        _LOADED[key] = Corpus(spark, sf_dir)
    return _LOADED[key]


def _pattern(name: str) -> str:
    return rf"(?<=FROM ){name}\b|(?<=JOIN ){name}\b"


def _uses(sql: str, name: str) -> bool:
    return bool(re.search(_pattern(name), sql))


def _replace(sql: str, name: str) -> str:
    return re.sub(_pattern(name), "{" + name + "}", sql)


def with_clause(*names: str, more: dict[str, str] | None = None) -> str:
    """The named steps (of the corpus or of ``more``), and those they need, as the CTEs of a DuckDB query."""
    steps = STEPS | (more or {})
    need: list[str] = []

    def add(name: str) -> None:
        for other in steps:
            if other != name and _uses(steps[name], other):
                add(other)
        if name not in need:
            need.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({steps[n].strip()})" for n in need)
