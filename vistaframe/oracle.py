"""DuckDB SQL oracle texts: the same adapters and the same questions, written
independently as plain SQL over the parquet views."""

from __future__ import annotations

ADAPTERS = {
    "prices": """
SELECT CAST(l_shipdate AS DATE) AS d, l_returnflag || l_linestatus AS asset,
       CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)
         / CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS close
FROM lineitem GROUP BY CAST(l_shipdate AS DATE), l_returnflag || l_linestatus""",
    "prices_gappy": """
SELECT d, asset, CASE WHEN asset = 'NF' AND dayofmonth(d) = 13 THEN NULL ELSE close END AS close
FROM prices""",
    "event_series": "SELECT user_id AS asset, ts AS d, value AS close FROM events",
    "tracks": """
SELECT p_brand AS artist_name, p_type AS release, p_name AS title, CAST(year(l_shipdate) AS INT) AS year,
       l_extendedprice / 200 AS duration, l_quantity / 50 AS artist_familiarity,
       l_discount * 10 AS artist_hotttnesss
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "census": """
SELECT c_custkey AS id, 18 + c_custkey % 60 AS age,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Private' WHEN 'MACHINERY' THEN 'Local-gov'
            WHEN 'HOUSEHOLD' THEN 'State-gov' WHEN 'AUTOMOBILE' THEN 'Self-emp-inc' ELSE '?' END AS workclass,
       n AS education_num,
       CASE c_nationkey % 3 WHEN 0 THEN 'White' WHEN 1 THEN 'Black' ELSE 'Other' END AS race,
       CASE c_custkey % 2 WHEN 0 THEN 'Male' ELSE 'Female' END AS sex, n_name AS native_country,
       CASE WHEN c_acctbal > 8000 THEN c_acctbal ELSE 0.0 END AS capital_gain, 20 + n AS hours_per_week,
       CASE WHEN c_acctbal + 400 * n > 9000 THEN '>50K' ELSE '<=50K' END AS income
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey""",
    "census_null": "SELECT * REPLACE (nullif(workclass, '?') AS workclass) FROM census",
    "discourse": """
SELECT doc_id AS id, lang AS discourse_type, text AS discourse_text, doc_id % 500 AS discourse_start,
       doc_id % 500 + n_chars AS discourse_end,
       CAST(length(text) - length(replace(text, ' ', '')) + 1 AS INT) AS predictionstring_len
FROM documents""",
    "snapshots_base": """
SELECT DISTINCT event_type AS site, CAST(ts AS DATE) AS snapshot, 'user-' || CAST(user_id AS VARCHAR) AS item
FROM events""",
    "snapshots": """
SELECT site, snapshot, item FROM snapshots_base WHERE dayofmonth(snapshot) NOT IN (10, 20)
UNION ALL
SELECT DISTINCT site, snapshot, CAST(NULL AS VARCHAR) FROM snapshots_base WHERE dayofmonth(snapshot) IN (10, 20)""",
    "predictions": """
SELECT 'retail' AS model, l_extendedprice AS actual, p_retailprice * l_quantity AS predicted
FROM lineitem JOIN part ON l_partkey = p_partkey
UNION ALL SELECT 'flat', l_extendedprice, 1500 * l_quantity FROM lineitem""",
    "votes": """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
       CAST(o_custkey % 101 AS DOUBLE) / 100 AS p_a, CAST(o_orderkey % 97 AS DOUBLE) / 96 AS p_b,
       CAST(o_custkey % 53 AS DOUBLE) / 52 AS p_c, CAST(o_orderkey % 29 AS DOUBLE) / 28 AS p_d
FROM orders""",
}

# adapters that build on other adapters
_DEPS = {"prices_gappy": ["prices"], "census_null": ["census"], "snapshots": ["snapshots_base"]}


def with_(*names: str, extra: dict | None = None) -> str:
    """``WITH`` clause holding the named adapters (dependencies first) and
    any extra named subqueries, in the given order."""
    order: list[str] = []

    def add(n):
        for dep in _DEPS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({ADAPTERS[n]})" for n in order]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v})")
    return "WITH " + ",\n".join(parts) + "\n"


ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text
