"""DuckDB SQL for each key of ``queries.QUERIES`` (``oracle_sql()``).

Written independently of the Spark code: where Spark parses a period label,
the SQL usually derives the expected date straight from the timestamp
(``date_trunc``); where Spark unpivots, the SQL uses ``UNPIVOT INCLUDE
NULLS`` or an explicit join. Column names and types match the Spark output.
"""

from __future__ import annotations

# Fixed value: what counts as numeric text in a measure column.
NUMERIC = r"^-?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?$"


def _q(ident: str) -> str:
    return '"' + ident.replace('"', '""') + '"'


def _s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _money(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"


# Generic label parsers (used where the label itself is the input).
def monthly_sql(t: str) -> str:
    return (
        f"TRY_CAST(concat_ws('-', regexp_extract({t}, '^(\\d{{4}})', 1), "
        f"lpad(CAST(TRY_CAST(regexp_extract({t}, 'M(\\d{{1,2}})', 1) AS INTEGER) AS VARCHAR), 2, '0'), '01') AS DATE)"
    )


def quarterly_sql(t: str) -> str:
    return (
        f"TRY_CAST(concat_ws('-', regexp_extract({t}, '^(\\d{{4}})', 1), "
        f"lpad(CAST(TRY_CAST(regexp_extract({t}, 'Q([1-4])', 1) AS INTEGER) * 3 - 2 AS VARCHAR), 2, '0'), '01') AS DATE)"
    )


def annual_sql(t: str) -> str:
    # strict: a year has four digits
    y = f"CAST(trunc(TRY_CAST({t} AS DOUBLE)) AS INTEGER)"
    return f"CASE WHEN {y} BETWEEN 1000 AND 9999 THEN make_date({y}, 1, 1) END"


# A cell that no row falls in is NULL, so each group has a row for every header:
# the documented years 1960 to 2029, plus "0000" for rows outside them.
_UNPIVOT_YEARS_PREFIXED = """
    WITH labels AS (SELECT CAST(y AS VARCHAR) AS year FROM generate_series(1960, 2029) t(y) UNION ALL SELECT '0000'),
    cnt AS (SELECT o_orderpriority, COUNT(*) AS c,
                   CASE WHEN year(o_orderdate) BETWEEN 1960 AND 2029 THEN CAST(year(o_orderdate) AS VARCHAR) ELSE '0000' END AS year
            FROM orders GROUP BY ALL)
    SELECT g.o_orderpriority, l.year, cnt.c AS value
    FROM (SELECT DISTINCT o_orderpriority FROM orders) g CROSS JOIN labels l
    LEFT JOIN cnt ON cnt.o_orderpriority IS NOT DISTINCT FROM g.o_orderpriority AND cnt.year = l.year
"""

_UNPIVOT_YEARS_PLAIN = """
    WITH cnt AS (SELECT l_returnflag, l_linestatus, year(l_shipdate) AS y, COUNT(*) AS c FROM lineitem GROUP BY ALL)
    SELECT g.l_returnflag, g.l_linestatus, CAST(t.y AS INTEGER) AS year, CAST(cnt.c AS FLOAT) AS value
    FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem) g CROSS JOIN generate_series(1960, 2029) t(y)
    LEFT JOIN cnt ON cnt.l_returnflag IS NOT DISTINCT FROM g.l_returnflag
     AND cnt.l_linestatus IS NOT DISTINCT FROM g.l_linestatus AND cnt.y = t.y
"""

_UNPIVOT_ENTITIES = """
    WITH headers(country) AS (VALUES ('Auto. Mobile'), ('Build''ing'), ('Furniture, Rep.'), ('House hold (all)'),
                                     ('MACHINERY'), ('Other (n.e.s.)')),
    base AS (
      SELECT strftime(o_orderdate, '%Y') || 'M' || strftime(o_orderdate, '%m') AS year,
             CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Auto. Mobile' WHEN 'BUILDING' THEN 'Build''ing'
                  WHEN 'FURNITURE' THEN 'Furniture, Rep.' WHEN 'HOUSEHOLD' THEN 'House hold (all)'
                  WHEN 'MACHINERY' THEN 'MACHINERY' ELSE 'Other (n.e.s.)' END AS country,
             CAST(o_totalprice AS DECIMAL(18,2)) AS p
      FROM orders JOIN customer ON o_custkey = c_custkey),
    cells AS (SELECT year, country, CAST(SUM(p) AS DOUBLE) AS value FROM base GROUP BY ALL)
    SELECT y.year, h.country, cells.value
    FROM (SELECT DISTINCT year FROM base) y CROSS JOIN headers h
    LEFT JOIN cells ON cells.year IS NOT DISTINCT FROM y.year AND cells.country = h.country
"""


def _all_periods_union() -> str:
    parts = []
    for freq, unit in (("monthly", "month"), ("quarterly", "quarter"), ("annual", "year")):
        parts.append(f"""
        SELECT r.country, CAST(c.v AS DOUBLE) AS value, 'order_value' AS indicator, '{freq}' AS frequency, p.period
        FROM (SELECT DISTINCT CAST(date_trunc('{unit}', d) AS DATE) AS period FROM base) p
        CROSS JOIN regions r
        LEFT JOIN (SELECT CAST(date_trunc('{unit}', d) AS DATE) AS period, country, SUM(p) AS v FROM base GROUP BY 1, 2) c
          ON c.period = p.period AND c.country = r.country""")
    return f"""
    WITH regions(country) AS (VALUES ('AFRICA'), ('AMERICA'), ('ASIA'), ('EUROPE'), ('MIDDLE EAST'), ('Other (n.e.s.)')),
    base AS (
      SELECT o_orderdate AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS p,
             CASE WHEN r_name IN (SELECT country FROM regions) THEN r_name ELSE 'Other (n.e.s.)' END AS country
      FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    {' UNION ALL '.join(parts)}
    """


_MEASURE_TEXT = """
    CASE event_id % 9
      WHEN 0 THEN 'NA'
      WHEN 1 THEN CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)
      WHEN 2 THEN 'abc'
      WHEN 3 THEN ''
      WHEN 4 THEN '.' || CAST(user_id AS VARCHAR)
      WHEN 5 THEN CAST(user_id AS VARCHAR) || '.'
      WHEN 6 THEN '-' || CAST(user_id AS VARCHAR) || 'e2'
      WHEN 7 THEN '+' || CAST(user_id AS VARCHAR)
      ELSE NULL END"""

_MALFORMED = """
    CASE event_id % 10
      WHEN 0 THEN '2000M13' WHEN 1 THEN '2000M' WHEN 2 THEN 'x' WHEN 3 THEN '2000Q5'
      WHEN 4 THEN CAST(year(ts) AS VARCHAR) || 'M' || CAST(month(ts) AS VARCHAR)
      WHEN 5 THEN '1999.5' WHEN 6 THEN '87' WHEN 7 THEN '12.0' WHEN 8 THEN '0'
      ELSE CAST(year(ts) AS VARCHAR) || 'Q' || CAST(quarter(ts) AS VARCHAR) END"""

_CONFORM = """
    WITH p_raw AS (
      SELECT n_nationkey AS country_code, n_name AS country_name FROM nation WHERE n_nationkey < 15
      UNION ALL SELECT n_nationkey, 'ALT ' || n_name FROM nation WHERE n_nationkey < 5
      UNION ALL SELECT n_nationkey, CAST(NULL AS VARCHAR) FROM nation WHERE n_regionkey = 0),
    p AS (SELECT country_code, MIN(country_name) AS country_name FROM p_raw
          WHERE country_code IS NOT NULL AND country_name IS NOT NULL GROUP BY country_code),
    s_raw AS (
      SELECT CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE s_nationkey END AS country_code,
             CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE s_name END AS country,
             'R' || CAST(s_nationkey % 5 AS VARCHAR) AS region,
             'S' || CAST(s_suppkey % 3 AS VARCHAR) AS subregion
      FROM supplier),
    s AS (SELECT * FROM s_raw WHERE country_code IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY country_code ORDER BY country NULLS LAST, region NULLS LAST, subregion NULLS LAST) = 1),
    every_code AS (
      SELECT country_code, country_name FROM p
      UNION ALL
      SELECT country_code, country FROM s WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.country_code = s.country_code))
    SELECT e.country_code, e.country_name, s.region, s.subregion
    FROM every_code e LEFT JOIN s ON e.country_code = s.country_code
"""

_KEY_A = "SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS key FROM customer"
_KEY_B = "SELECT CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_nationkey + 5 END AS key FROM supplier"

_CODED = "SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_nationkey END AS code FROM customer"

def _job_non_gem_gold() -> str:
    return """
    WITH base AS (
      SELECT n_nationkey, n_name, p_brand, CASE WHEN l_returnflag = 'R' THEN 'A' ELSE 'B' END AS src,
             year(l_shipdate) AS y
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
      JOIN part ON l_partkey = p_partkey),
    grp AS (SELECT DISTINCT src, n_nationkey, n_name, p_brand FROM base),
    years(y) AS (SELECT y FROM generate_series(1960, 2029) t(y)),
    cnt AS (SELECT src, n_nationkey, p_brand, y, COUNT(*) AS c FROM base GROUP BY ALL),
    fact AS (
      SELECT g.n_nationkey, g.p_brand, CAST(yr.y AS INTEGER) AS y, CAST(cnt.c AS FLOAT) AS value
      FROM grp g CROSS JOIN years yr
      LEFT JOIN cnt ON cnt.src = g.src AND cnt.n_nationkey = g.n_nationkey AND cnt.p_brand = g.p_brand AND cnt.y = yr.y),
    dimc AS (SELECT n_nationkey, MIN(CASE WHEN src = 'B' THEN n_name || ' (IDS)' WHEN n_nationkey % 5 <> 0 THEN n_name END) AS country_name
             FROM grp GROUP BY n_nationkey),
    dimi AS (SELECT p_brand, MIN(CASE WHEN src = 'A' THEN 'Lines ' ELSE 'Lines of ' END || p_brand) AS indicator_name
             FROM grp GROUP BY p_brand)
    SELECT dimc.country_name, dimi.indicator_name, fact.y AS year, fact.value
    FROM fact JOIN dimc ON fact.n_nationkey = dimc.n_nationkey JOIN dimi ON fact.p_brand = dimi.p_brand
    """


_JOB_EDSTATS = f"""
    WITH e AS (
      SELECT 'User ' || CAST(user_id AS VARCHAR) AS country_name, event_type AS indicator_name,
             CASE user_id % 3 WHEN 0 THEN '_T' WHEN 1 THEN 'F' ELSE 'M' END AS sex,
             CASE WHEN event_type IN ('view', 'click') THEN '_T' ELSE 'U' END AS urbanization,
             CASE WHEN user_id % 4 = 0 THEN NULL ELSE '_T' END AS age,
             'NUM' AS unit_type, 'EV' AS unit_measure, day(ts) AS d
      FROM events),
    cnt AS (SELECT country_name, indicator_name, sex, urbanization, age, unit_type, unit_measure, d, COUNT(*) AS c
            FROM e GROUP BY ALL),
    cells AS (
      SELECT *, CASE c % 4 WHEN 1 THEN 'NA' WHEN 2 THEN CAST(c AS VARCHAR) || '.'
                           WHEN 3 THEN 'x' || CAST(c AS VARCHAR) ELSE '-' || CAST(c AS VARCHAR) || 'e1' END AS raw
      FROM cnt)
    SELECT country_name, indicator_name,
           CASE WHEN sex = '_T' THEN 'T' ELSE sex END AS sex,
           CASE WHEN urbanization = '_T' THEN 'T' ELSE urbanization END AS urbanization,
           CASE WHEN age = '_T' THEN 'T' ELSE age END AS age,
           unit_type, unit_measure,
           CASE WHEN raw = 'NA' THEN NULL ELSE TRY_CAST(raw AS DOUBLE) END AS value,
           make_date(1990 + d, 1, 1) AS period
    FROM cells
    WHERE age IS NOT NULL AND (raw = 'NA' OR regexp_full_match(raw, '{NUMERIC}'))
"""

_JOB_UNODC = """
    WITH o AS (
      SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate, c_nationkey, c_mktsegment
      FROM orders JOIN customer ON o_custkey = c_custkey),
    sheet AS (
      SELECT CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS country_code,
             o_orderpriority AS indicator, o_orderstatus AS dimension, c_mktsegment AS category,
             CAST(year(o_orderdate) AS INTEGER) AS year,
             TRY_CAST(CASE WHEN o_orderkey % 11 = 0 THEN 'n/a'
                           ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS FLOAT) AS value
      FROM o),
    prim AS (SELECT CAST(n_nationkey AS VARCHAR) AS country_code, n_name AS country_name FROM nation WHERE n_nationkey < 15),
    sec AS (SELECT DISTINCT country_code, 'Country ' || country_code AS country_name FROM sheet WHERE country_code IS NOT NULL),
    dim AS (SELECT * FROM prim
            UNION ALL SELECT * FROM sec WHERE NOT EXISTS (SELECT 1 FROM prim WHERE prim.country_code = sec.country_code))
    SELECT dim.country_name, indicator, dimension, category, 'Total' AS sex, 'Total' AS age, year, value, 'CTS' AS source
    FROM sheet JOIN dim ON sheet.country_code = dim.country_code
"""

ORACLE: dict[str, str] = {
    "unpivot_years_prefixed": _UNPIVOT_YEARS_PREFIXED,
    "unpivot_years_plain": _UNPIVOT_YEARS_PLAIN,
    "unpivot_entities": _UNPIVOT_ENTITIES,
    "period_monthly": """
        SELECT l_orderkey, l_linenumber,
               CAST(year(l_shipdate) AS VARCHAR) || 'M' || CAST(month(l_shipdate) AS VARCHAR) AS period_text,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS period
        FROM lineitem""",
    "period_quarterly": """
        SELECT l_orderkey, l_linenumber,
               CAST(year(l_shipdate) AS VARCHAR) || 'Q' || CAST(quarter(l_shipdate) AS VARCHAR) AS period_text,
               CAST(date_trunc('quarter', l_shipdate) AS DATE) AS period
        FROM lineitem""",
    "period_annual": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '.0' AS period_text,
               make_date(year(o_orderdate), 1, 1) AS period
        FROM orders""",
    "period_malformed": f"""
        WITH t AS (SELECT event_id, {_MALFORMED} AS period_text FROM events)
        SELECT event_id, period_text, {monthly_sql('period_text')} AS p_monthly,
               {quarterly_sql('period_text')} AS p_quarterly, {annual_sql('period_text')} AS p_annual
        FROM t""",
    "all_periods_union": _all_periods_union(),
    "clean_measure": f"""
        WITH r AS (SELECT event_id, {_MEASURE_TEXT} AS raw FROM events)
        SELECT event_id, raw, CASE WHEN raw = 'NA' THEN NULL ELSE TRY_CAST(raw AS DOUBLE) END AS value
        FROM r WHERE raw = 'NA' OR regexp_full_match(raw, '{NUMERIC}')""",
    "numeric_gate": f"""
        WITH r AS (SELECT event_id, {_MEASURE_TEXT} AS raw FROM events)
        SELECT event_id, raw, regexp_full_match(raw, '{NUMERIC}') AS is_numeric FROM r""",
    "recode_values": """
        WITH r AS (
          SELECT event_id,
                 CASE event_id % 3 WHEN 0 THEN '_T' WHEN 1 THEN 'F' ELSE 'M' END AS sex,
                 CASE WHEN event_type = 'view' THEN '_T' ELSE event_type END AS urbanization,
                 CASE user_id % 4 WHEN 0 THEN '_T' WHEN 1 THEN '_t' WHEN 2 THEN NULL ELSE 'Y15T24' END AS age
          FROM events)
        SELECT event_id,
               CASE WHEN sex = '_T' THEN 'T' ELSE sex END AS sex,
               CASE WHEN urbanization = '_T' THEN 'T' ELSE urbanization END AS urbanization,
               CASE WHEN age = '_T' THEN 'T' ELSE age END AS age
        FROM r""",
    "drop_incomplete": """
        SELECT * FROM (
          SELECT event_id,
                 CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS kind,
                 CASE WHEN user_id % 5 = 0 THEN NULL ELSE value END AS amount
          FROM events)
        WHERE kind IS NOT NULL AND amount IS NOT NULL""",
    "cast_by_name": """
        SELECT CAST(p_partkey AS VARCHAR) AS id, p_name,
               TRY_CAST(CASE WHEN p_partkey % 10 = 0 THEN 'n/a'
                             ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS FLOAT) AS value,
               TRY_CAST(CASE WHEN p_partkey % 10 = 1 THEN 'unknown'
                             ELSE CAST(1990 + p_size % 30 AS VARCHAR) END AS INTEGER) AS year,
               CAST(p_size AS VARCHAR) AS p_size
        FROM part""",
    "sanitize_headers": """
        SELECT p_partkey AS part_key, CAST(p_partkey AS VARCHAR) AS part_key_2, p_name AS p_name_x,
               p_brand AS brandcode, p_type AS type1, p_size AS sizenum, p_retailprice AS retail_price
        FROM part""",
    "project_alias": """
        SELECT A.c_custkey AS customer_id, A.c_name AS customer_name, A.c_nationkey AS country_code
        FROM customer A""",
    "drop_rename": "SELECT c_custkey AS id, c_name AS name, c_nationkey, c_mktsegment AS segment FROM customer",
    "literal_columns": """
        SELECT c_custkey, 'customer' AS source, 1 AS version, CAST(NULL AS VARCHAR) AS note FROM customer""",
    "common_columns_union": """
        SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
        UNION ALL
        SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
    "union_all": """
        SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
               c_mktsegment AS segment, 'customer' AS kind FROM customer
        UNION ALL
        SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS VARCHAR), 'supplier' FROM supplier""",
    "parquet_roundtrip": "SELECT * FROM orders",
    "partitioned_roundtrip": "SELECT * FROM orders",
    "partition_types": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 12 <> 11 THEN lpad(CAST(o_orderkey % 12 AS VARCHAR), 3, '0') END AS code,
               CAST(date_trunc('year', o_orderdate) AS DATE) AS period
        FROM orders""",
    "append_accumulate": "SELECT * FROM orders",
    "idempotent_delivery": """
        SELECT *, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus ELSE 'rest' END AS batch FROM orders""",
    "replaced_partitions": """
        SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE substr(o_orderpriority, 1, 1) IN ('1', '2')""",
    "contract_evolution": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS o_totalprice,
               CAST(CASE WHEN o_orderkey % 3 = 0 THEN year(o_orderdate) END AS INTEGER) AS o_year,
               lpad(CAST(o_custkey % 7 AS VARCHAR), 3, '0') AS code
        FROM orders""",
    "catalog_table": """
        SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders WHERE year(o_orderdate) % 3 <> 1""",
    "control_totals": f"""
        WITH r AS (SELECT event_id, {_MEASURE_TEXT} AS raw FROM events),
        m AS (SELECT raw, regexp_full_match(raw, '{NUMERIC}') AS is_numeric FROM r),
        t AS (
          SELECT 'measures' AS "table", CAST(NULL AS VARCHAR) AS batch, COUNT(*) AS rows_all,
                 COUNT(*) FILTER (WHERE raw IS NOT NULL AND NOT coalesce(is_numeric, FALSE)) AS rejected,
                 COUNT(*) FILTER (WHERE raw IS NULL) AS missing
          FROM m)
        SELECT "table", batch, 'rows' AS control, rows_all AS n FROM t
        UNION ALL SELECT "table", batch, 'rejected', rejected FROM t
        UNION ALL SELECT "table", batch, 'missing', missing FROM t
        UNION ALL
        SELECT 'orders', k.batch, c.control, COUNT(*) FILTER (WHERE o_orderkey IS NOT NULL AND (c.control = 'rows' OR o_totalprice > 100000))
        FROM (VALUES ('F'), ('O')) k(batch) CROSS JOIN (VALUES ('rows'), ('big')) c(control) LEFT JOIN orders ON o_orderstatus = k.batch
        GROUP BY ALL
        UNION ALL SELECT 'clicks', NULL, 'rows', COUNT(*) FROM events WHERE event_type = 'click'
        UNION ALL SELECT 'clicks', NULL, 'no_user', COUNT(*) FROM events WHERE event_type = 'click' AND user_id IS NULL""",
    "csv_rejects": """
        WITH l AS (
          SELECT c_custkey % 11 AS k, CAST(c_custkey AS VARCHAR) AS a, c_name AS b, c_mktsegment AS s,
                 concat(chr(34), c_name, ', Ltd ', chr(34), chr(34), 'x', chr(34), chr(34), chr(34)) AS quoted FROM customer)
        SELECT a AS c_custkey, b || ', Ltd "x"' AS c_name, s AS c_mktsegment,
               CAST(NULL AS VARCHAR) AS record, CAST(NULL AS VARCHAR) AS reason, FALSE AS has_file
        FROM l WHERE k NOT IN (3, 5, 7)
        UNION ALL
        SELECT NULL, NULL, NULL,
               CASE k WHEN 3 THEN a WHEN 5 THEN a || ',' || quoted ELSE a || ',' || quoted || ',' || s || ',more' END,
               CASE k WHEN 7 THEN 'too many fields' ELSE 'too few fields' END, TRUE
        FROM l WHERE k IN (3, 5, 7)""",
    "survivorship": """
        WITH rows_in AS (
          SELECT 0 AS rank, 'nations' AS list, n_nationkey AS code, CASE WHEN n_nationkey % 4 <> 0 THEN n_name END AS name,
                 CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS segment FROM nation WHERE n_nationkey < 18
          UNION ALL
          SELECT 1, 'suppliers', CASE WHEN s_suppkey % 13 <> 0 THEN s_nationkey END, CASE WHEN s_nationkey < 9 THEN s_name END,
                 'R' || CAST(s_suppkey % 5 AS VARCHAR), NULL FROM supplier
          UNION ALL
          SELECT 2, 'customers', c_nationkey + 3, c_name, 'R9', c_mktsegment FROM customer),
        codes AS (SELECT DISTINCT code FROM rows_in WHERE code IS NOT NULL),
        names AS (SELECT code, name, list FROM rows_in WHERE name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY code ORDER BY rank, name) = 1),
        regions AS (SELECT code, region, list FROM rows_in WHERE region IS NOT NULL QUALIFY row_number() OVER (PARTITION BY code ORDER BY rank, region) = 1),
        segments AS (SELECT code, segment, list FROM rows_in WHERE segment IS NOT NULL QUALIFY row_number() OVER (PARTITION BY code ORDER BY rank, segment) = 1)
        SELECT codes.code, name, names.list AS name_source, region, regions.list AS region_source, segment, segments.list AS segment_source
        FROM codes LEFT JOIN names USING (code) LEFT JOIN regions USING (code) LEFT JOIN segments USING (code)""",
    "unpivot_map_rows": f"""
        WITH o AS (SELECT o_orderpriority AS series, year(o_orderdate) AS y, COUNT(*) AS n FROM orders GROUP BY ALL),
        l AS (SELECT l_returnflag || '/' || l_linestatus AS series, year(l_shipdate) AS y, COUNT(*) AS n FROM lineitem GROUP BY ALL)
        SELECT series, 'YR' || CAST(y AS VARCHAR) AS year, CAST(n AS VARCHAR) AS value FROM o WHERE y BETWEEN 1960 AND 2029
        UNION ALL
        SELECT series, CAST(y AS VARCHAR), CAST(n AS VARCHAR) FROM l WHERE y BETWEEN 1959 AND 2030""",
    "audit_column": """
        SELECT c_custkey, c_name, TRUE AS stamped, TRUE AS stamped_after_start, TRUE AS stamped_before_end FROM customer""",
    "csv_roundtrip": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
               CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal,
               c_name || chr(10) || '"' || c_mktsegment || '"' AS note
        FROM customer""",
    "join_inner_dim": """
        SELECT c_custkey, c_name, c_nationkey, n_name AS country_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 2""",
    "left_enrich": """
        SELECT c_custkey, c_name, c_nationkey, n.n_name AS country_name, n.n_regionkey AS region_code
        FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c_nationkey = n.n_nationkey""",
    "star_join": """
        SELECT l_orderkey, l_linenumber, l_quantity, s_name AS supplier_name, p_name AS part_name
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
    "semi_membership": f"""
        SELECT * FROM ({_CODED}) c
        WHERE EXISTS (SELECT 1 FROM nation WHERE n_regionkey IN (1, 3) AND n_nationkey = c.code)""",
    "anti_membership": f"""
        SELECT * FROM ({_CODED}) c
        WHERE c.code IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM nation WHERE n_regionkey IN (1, 3) AND n_nationkey = c.code)""",
    "group_count": "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey",
    "duplicate_keys": "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1",
    "row_count": "SELECT COUNT(*) AS n FROM orders",
    "distinct_rows": "SELECT DISTINCT l_returnflag, l_linestatus, l_discount, l_tax FROM lineitem",
    "extract_dim": "SELECT DISTINCT p_brand, p_type FROM part",
    "extract_dim_first": """
        SELECT p_brand, MIN(CASE WHEN p_partkey % 3 <> 0 AND p_brand <> 'Brand#11' THEN p_type END) AS p_type
        FROM part GROUP BY p_brand""",
    "keep_first": """
        SELECT * REPLACE (CASE WHEN c_custkey % 4 <> 0 AND c_nationkey <> 3 THEN c_name END AS c_name) FROM customer
        QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY
          CASE WHEN c_custkey % 4 <> 0 AND c_nationkey <> 3 THEN c_name END NULLS LAST, c_custkey, c_acctbal, c_mktsegment) = 1""",
    "conform_dimension": _CONFORM,
    "key_union": f"{_KEY_A} UNION {_KEY_B}",
    "key_intersect": f"{_KEY_A} INTERSECT {_KEY_B}",
    "key_except": f"{_KEY_A} EXCEPT {_KEY_B}",
    "sort_desc": "SELECT * FROM orders ORDER BY o_totalprice DESC",
    "job_bronze_metadata": """
        SELECT DISTINCT * FROM (
          SELECT CAST(n_nationkey AS VARCHAR) AS country_code, n_name || chr(10) || '"note"' AS short_name,
                 CAST(n_regionkey AS VARCHAR) AS ppp_survey_year
          FROM nation
          UNION ALL
          SELECT CASE WHEN n_regionkey = 1 THEN 'X' ELSE '' END || CAST(n_nationkey AS VARCHAR),
                 n_name || chr(10) || '"note"', CAST(n_regionkey AS VARCHAR)
          FROM nation)""",
    "job_bronze_series": """
        SELECT DISTINCT p_brand AS series_code, p_type AS topic FROM part
        UNION SELECT DISTINCT p_brand || 'b', p_type FROM part""",
    "job_bronze_stats": """
        WITH cnt AS (SELECT o_custkey, o_orderpriority, year(o_orderdate) AS y, COUNT(*) AS c FROM orders GROUP BY ALL),
        grp AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)
        SELECT 'Customer, no. ' || CAST(g.o_custkey AS VARCHAR) AS country_name, CAST(g.o_custkey AS VARCHAR) AS country_code,
               g.o_orderpriority AS indicator_name, substr(g.o_orderpriority, 1, 1) AS indicator_code,
               string_agg(coalesce(CAST(cnt.c AS VARCHAR), '-'), ' ' ORDER BY t.y) AS cells
        FROM grp g CROSS JOIN generate_series(1959, 2030) t(y)
        LEFT JOIN cnt ON cnt.o_custkey = g.o_custkey AND cnt.o_orderpriority = g.o_orderpriority AND cnt.y = t.y
        GROUP BY ALL""",
    "job_non_gem_gold": _job_non_gem_gold(),
    "job_edstats_gold": _JOB_EDSTATS,
    "job_unodc_gold": _JOB_UNODC,
}
