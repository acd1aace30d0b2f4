"""The fixture adapters as SQL text (common subset of Spark SQL and DuckDB).

These are the statements of FIXTURES.md section 2.  They serve the
independent oracle: each oracle query in ``__spark_entry__`` is written as
``WITH <adapters> SELECT ...`` over the driver's tables, so DuckDB rebuilds
the inputs itself.  The Spark side builds the same inputs with DataFrame code
in ``custmaster.sources.fixtures``; a test checks that both agree.
"""

from __future__ import annotations

ADAPTERS: dict[str, str] = {}

ADAPTERS["party"] = """
SELECT o_orderkey AS contract_no, CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_custkey END AS customer_id,
  CASE WHEN c_custkey % 11 = 0 AND o_orderkey % 2 = 0 THEN '4'
       ELSE CAST(1 + c_custkey % 4 AS STRING) END AS idntfctn_type,
  c_name || ' ' || CAST(o_orderkey % 3 AS STRING) AS customer_name, o_orderdate AS change_date_time,
  CASE (c_custkey + o_orderkey) % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE NULL END AS sex,
  CASE WHEN (c_custkey + o_orderkey) % 9 = 0 THEN '****-**-**' WHEN (c_custkey + o_orderkey) % 9 = 1 THEN NULL
       ELSE '19' || CAST(20 + (c_custkey + o_orderkey % 3) % 80 AS STRING) || '-01-15' END AS birthday,
  CASE WHEN (c_custkey + o_orderkey) % 5 = 0 THEN NULL
       ELSE CAST((c_nationkey + o_orderkey % 2) % 25 AS INTEGER) END AS national_country_code,
  CASE WHEN (c_custkey + o_orderkey) % 8 = 0 THEN NULL
       ELSE (c_nationkey + c_custkey + o_orderkey) % 27 END AS ocr_country_code,
  (c_nationkey + o_orderkey) % 25 AS entity_reg_ctycode, (c_nationkey + o_orderkey + 1) % 25 AS entity_head_ctycode,
  CAST(1950 + (c_custkey + o_orderkey) % 70 AS STRING) AS entity_settime,
  CASE WHEN o_orderkey % 6 = 0 THEN 'BUILDING' ELSE c_mktsegment END AS occu_type1_code,
  c_mktsegment || '-' || CAST((c_custkey + o_orderkey) % 10 AS STRING) AS occu_type2_code,
  c_mktsegment || '-' || CAST((c_custkey + o_orderkey) % 30 AS STRING) AS occu_type3_code,
  CAST(o_orderkey % 2 AS STRING) AS bearer_shares_status,
  CASE WHEN (c_custkey + o_orderkey) % 13 = 0 THEN NULL
       ELSE 'T' || lpad(CAST(((c_custkey + o_orderkey) % 13) * 10 AS STRING), 3, '0') END AS risk_jobtitle_code,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL
       ELSE 'M' || CAST((c_custkey + o_orderkey) % 97 AS STRING) END AS manager_id,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL
       ELSE 'Mgr ' || CAST((c_custkey + o_orderkey) % 97 AS STRING) END AS manager_name,
  CASE WHEN (c_custkey + o_orderkey) % 7 = 0 THEN '' WHEN (c_custkey + o_orderkey) % 7 = 1 THEN NULL
       ELSE '09' || CAST(c_custkey AS STRING) || '-' || CAST(o_orderkey % 3 AS STRING) END AS cellular_phone,
  CASE WHEN (c_custkey + o_orderkey) % 6 = 0 THEN NULL WHEN (c_custkey + o_orderkey) % 6 = 1 THEN ''
       ELSE 'u' || CAST(o_orderkey % 2 AS STRING) || '@' || CAST(c_custkey AS STRING) END AS email,
  CASE (c_custkey + o_orderkey) % 4 WHEN 0 THEN '00' WHEN 1 THEN '30' WHEN 2 THEN '10' ELSE NULL END AS risk_level,
  o_orderdate AS risk_level_update,
  CASE WHEN (c_custkey + o_orderkey) % 18 = 0 THEN '1' ELSE NULL END AS san,
  CASE WHEN (c_custkey + o_orderkey) % 10 = 0 THEN '1' ELSE NULL END AS mny_err,
  CASE WHEN (c_custkey + o_orderkey) % 12 = 0 THEN '1' ELSE NULL END AS sip,
  CASE WHEN (c_custkey + o_orderkey) % 14 = 0 THEN '1' ELSE NULL END AS am,
  CASE WHEN (c_custkey + o_orderkey) % 15 = 0 THEN '1' ELSE NULL END AS pep,
  CASE WHEN (c_custkey + o_orderkey) % 16 = 0 THEN '1' ELSE NULL END AS rca,
  CASE WHEN o_orderkey % 6 = 0 THEN 'BUILDING' ELSE c_mktsegment END AS risk_industry_code
FROM orders JOIN customer ON o_custkey = c_custkey
"""

ADAPTERS["policy"] = """
SELECT o_orderkey AS contract_no,
  CASE WHEN o_orderstatus = 'F' THEN '7' ELSE o_orderstatus END AS policy_status,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderdate END AS end_datetime
FROM orders
"""

ADAPTERS["policy_agent"] = """
SELECT CASE WHEN l_orderkey % 20 = 0 THEN -1 - l_orderkey ELSE l_orderkey END AS contract_no,
  l_suppkey AS agent_id
FROM lineitem
"""

ADAPTERS["insured"] = """
SELECT CASE WHEN l_orderkey % 20 = 1 THEN -1 - l_orderkey ELSE l_orderkey END AS contract_no,
  l_partkey AS customer_id, 'P' || CAST(l_partkey AS STRING) AS customer_name,
  CASE WHEN l_partkey % 9 = 0 THEN NULL
       ELSE '19' || CAST(20 + l_partkey % 80 AS STRING) || '-02-01' END AS birthday
FROM lineitem
"""

ADAPTERS["benef_health"] = """
SELECT CASE WHEN l_orderkey % 20 = 2 THEN -1 - l_orderkey ELSE l_orderkey END AS contract_no,
  l_partkey AS assured_id, 'B' || CAST(l_partkey AS STRING) AS assured_name,
  CAST(l_linenumber AS STRING) AS relative_to_insured
FROM lineitem WHERE l_returnflag = 'R'
"""

ADAPTERS["benef_travel"] = """
SELECT CASE WHEN l_orderkey % 20 = 3 THEN -1 - l_orderkey ELSE l_orderkey END AS contract_no,
  'B' || CAST(l_partkey AS STRING) AS assured_name,
  CAST(l_linenumber AS STRING) AS relative_to_insured
FROM lineitem WHERE l_returnflag = 'A'
"""

ADAPTERS["income"] = """
SELECT CASE WHEN o_custkey % 17 = 0 OR l_orderkey % 20 = 4 THEN -1 - l_orderkey ELSE l_orderkey END AS contract_no,
  CASE WHEN o_custkey % 17 = 1 OR (l_partkey + l_linenumber) % 10 = 0 THEN NULL
       WHEN (l_partkey + l_linenumber) % 10 = 9 THEN ''
       ELSE CAST((l_partkey + l_linenumber) % 10 AS STRING) END AS pay_source,
  CASE WHEN l_quantity < 10 THEN NULL ELSE CAST(l_quantity AS BIGINT) * 10000 END AS min_year_income,
  l_shipdate AS change_date_time
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

ADAPTERS["income_extra"] = """
SELECT CASE WHEN o_orderkey % 20 = 5 THEN -1 - o_orderkey ELSE o_orderkey END AS contract_no,
  CASE WHEN o_orderkey % 8 = 0 THEN '' ELSE CAST(o_orderkey % 8 AS STRING) END AS pay_source,
  CAST(floor(o_totalprice) AS BIGINT) AS min_year_income, o_orderdate AS change_date_time
FROM orders
"""

ADAPTERS["entity_manager"] = """
SELECT CAST(1 + c_custkey % 4 AS STRING) AS idntfctn_type,
  CASE WHEN c_custkey % 3 = 1 THEN -c_custkey ELSE c_custkey END AS customer_id,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE title || CAST(c_custkey AS STRING) END AS manager_name,
  '19' || CAST(20 + c_custkey % 80 AS STRING) || born AS birthday, c_nationkey AS national_country_code
FROM customer
JOIN (SELECT 'Boss ' AS title, '-03-01' AS born UNION ALL SELECT 'Deputy ' AS title, '-04-01' AS born) post
  ON title = 'Boss ' OR c_custkey % 4 = 0
"""

ADAPTERS["param_lookup"] = """
SELECT 'RISK_INDUSTRY_TYPE' AS param_id,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'NO SUCH TRADE' ELSE c_mktsegment END AS display_value,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '00' WHEN 'BUILDING' THEN '30' ELSE '10' END AS data1
FROM customer GROUP BY c_mktsegment
UNION ALL
SELECT 'OTHER_PARAM' AS param_id, c_mktsegment AS display_value, '99' AS data1
FROM customer GROUP BY c_mktsegment
"""

ADAPTERS["country_risk"] = """
SELECT n_nationkey AS country_code,
  CASE WHEN n_nationkey % 7 = 6 THEN '40' WHEN n_regionkey = 0 THEN '10' WHEN n_regionkey = 1 THEN '20'
       WHEN n_regionkey = 2 THEN '25' WHEN n_regionkey = 3 THEN '30' ELSE '90' END AS risk_level
FROM nation
"""

ADAPTERS["party_address"] = """
SELECT o_custkey AS customer_id, CAST(1 + o_orderkey % 3 AS STRING) AS address_kind,
  CASE WHEN o_orderkey % 6 = 0 THEN '' WHEN o_orderkey % 6 = 1 THEN NULL
       ELSE 'No.' || CAST(o_orderkey AS STRING) || ' Road' END AS address,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '02' || CAST(o_custkey AS STRING) END AS phone1,
  CASE WHEN o_orderkey % 5 = 1 THEN NULL ELSE '03' || CAST(o_custkey AS STRING) END AS phone2,
  o_orderdate AS create_date, o_orderdate AS dbc_business_date
FROM orders
"""

ADAPTERS["product_risk"] = """
SELECT CASE WHEN l_orderkey % 20 = 6 THEN -1 - l_orderkey ELSE l_orderkey END AS contract_no,
  'PR' || CAST((l_suppkey + l_orderkey) % 3 AS STRING) AS product_code,
  CASE l_partkey % 6 WHEN 0 THEN '10' WHEN 1 THEN '20' WHEN 2 THEN '25' WHEN 3 THEN '30' WHEN 4 THEN '90' ELSE '40' END
    AS risk_level,
  CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) END AS valid_from
FROM lineitem
"""

ADAPTERS["industry_codes"] = """
SELECT '1' AS code_type, c_mktsegment AS source_code, lpad(CAST(length(c_mktsegment) AS STRING), 2, '0') AS target_code,
  CAST(NULL AS TIMESTAMP) AS valid_from,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN CAST('2001-05-31' AS TIMESTAMP) ELSE NULL END AS valid_to
FROM customer WHERE c_mktsegment <> 'FURNITURE' GROUP BY c_mktsegment
UNION ALL
SELECT '1', c_mktsegment, '9' || substring(CAST(length(c_mktsegment) AS STRING), 1, 1), CAST('2001-06-01' AS TIMESTAMP),
  CAST(NULL AS TIMESTAMP)
FROM customer WHERE c_mktsegment = 'MACHINERY' GROUP BY c_mktsegment
UNION ALL
SELECT '1', c_mktsegment, '99', CAST(NULL AS TIMESTAMP), CAST('2001-05-31' AS TIMESTAMP)
FROM customer WHERE c_mktsegment = 'FURNITURE' GROUP BY c_mktsegment
UNION ALL
SELECT '2', c_mktsegment || '-' || CAST(n AS STRING),
  lpad(CAST(length(c_mktsegment) AS STRING), 2, '0') || lpad(CAST(n AS STRING), 5, '0'), CAST('1990-01-01' AS TIMESTAMP),
  CAST(NULL AS TIMESTAMP)
FROM (SELECT c_mktsegment FROM customer GROUP BY c_mktsegment) seg
JOIN (SELECT DISTINCT n_nationkey AS n FROM nation) numbers ON n BETWEEN 0 AND 24
"""

def with_adapters(body: str, names: list[str] | None = None) -> str:
    """``WITH`` all (or the named) adapters, then ``body``."""
    names = names or list(ADAPTERS)
    ctes = ",\n".join(f"{n} AS ({ADAPTERS[n].strip()})" for n in names)
    return f"WITH {ctes}\n{body.strip()}"
