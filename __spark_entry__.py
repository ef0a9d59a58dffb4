
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata import workload

# The training-data operators are an optional part; only their absence is forgiven.
LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}
try:
    import corpus_pipeline
    from strata.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "strata.llm", "strata.llm.queries"):
        raise
else:
    LLM_QUERIES = {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}
    LLM_ORACLES = dict(llm_queries.ORACLES)

LINES = """
    SELECT l_orderkey * 10 + l_linenumber AS line_id, l_orderkey AS order_id,
           CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS BIGINT) AS quantity
    FROM lineitem
"""

HEADERS = """
    SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS date,
           lpad(CAST((o_orderkey * 37 % 86400) // 3600 AS VARCHAR), 2, '0') || ':' ||
           lpad(CAST((o_orderkey * 37 % 86400) // 60 % 60 AS VARCHAR), 2, '0') || ':' ||
           lpad(CAST((o_orderkey * 37 % 86400) % 60 AS VARCHAR), 2, '0') AS time
    FROM orders
"""

PARTS = """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_type_id,
           CASE WHEN p_size <= 15 THEN 'S' WHEN p_size <= 35 THEN 'M' ELSE 'L' END AS size,
           CAST(p_retailprice - 900 AS DECIMAL(4,2)) AS price, p_size
    FROM part
"""

OPEN_FIRST = "DATE '2024-01-01' AS start_date, CAST(NULL AS DATE) AS end_date, 'a' AS status"
OPEN_SECOND = "DATE '2024-02-01' AS start_date, CAST(NULL AS DATE) AS end_date, 'a' AS status"
CLOSED = "DATE '2024-01-01' AS start_date, DATE '2024-02-01' AS end_date, 'i' AS status"

PRODUCTS = f"SELECT product_id, product_type_id, size, price, {OPEN_FIRST} FROM ({PARTS})"

TYPES = f"""
    SELECT p_type AS product_type_id, min(p_name) AS name, min(p_brand) AS category,
           'flour, water, salt' AS ingredients, {OPEN_FIRST}
    FROM part GROUP BY p_type
"""

SECOND_PRODUCTS = f"""
    SELECT product_id, product_type_id, size,
           CAST(CAST(99.99 AS DECIMAL(4,2)) - price AS DECIMAL(4,2)) AS price
    FROM ({PARTS}) WHERE p_size > 40 OR product_type_id = 'PROMO'
"""

VERSIONED_PRODUCTS = f"""
    SELECT product_id, product_type_id, size, price, {CLOSED}
    FROM ({PARTS}) WHERE p_size <= 40 AND product_type_id = 'PROMO'
    UNION ALL
    SELECT product_id, product_type_id, size, price, {OPEN_FIRST}
    FROM ({PARTS}) WHERE p_size <= 40 AND product_type_id <> 'PROMO'
    UNION ALL
    SELECT product_id, product_type_id, size, price, {OPEN_SECOND} FROM ({SECOND_PRODUCTS})
"""

VERSIONED_TYPES = f"""
    SELECT p_type AS product_type_id, min(p_name) AS name, min(p_brand) AS category,
           'flour, water, salt' AS ingredients, {CLOSED}
    FROM part GROUP BY p_type
    UNION ALL
    SELECT p_type, max(p_name), min(p_brand), 'flour, water, salt', {OPEN_SECOND}
    FROM part GROUP BY p_type
"""


def mart(products: str, types: str) -> str:
    return f"""
        SELECT od.line_id, od.order_id, o.date AS order_date, o.time AS order_time,
               pt.name AS product_name, pt.category AS product_category, p.size, od.quantity,
               CAST(p.price * od.quantity AS DECIMAL(25,2)) AS total_price
        FROM ({LINES}) od
        LEFT JOIN ({HEADERS}) o ON o.order_id = od.order_id
        JOIN ({products}) p ON od.product_id = p.product_id
        JOIN ({types}) pt ON p.product_type_id = pt.product_type_id
    """


NULL_KEYS = """
    SELECT CASE WHEN l.quality IS NOT NULL THEN d.doc_id END AS key, d.lang
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

ORACLES: dict[str, str] = {
    "gold_order_lines": mart(PRODUCTS, TYPES),
    "gold_fanout_versions": mart(VERSIONED_PRODUCTS, VERSIONED_TYPES),
    "gold_table_replace": mart(PRODUCTS, TYPES),
    "left_join_missing_header": """
        SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
    "inner_join_missing_product": """
        SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    """,
    "inner_join_product": f"""
        SELECT od.line_id, od.product_id, p.size, p.price
        FROM ({LINES}) od JOIN ({PRODUCTS}) p ON od.product_id = p.product_id
    """,
    "inner_join_type": f"""
        SELECT p.product_id, pt.name, pt.category
        FROM ({PRODUCTS}) p JOIN ({TYPES}) pt ON p.product_type_id = pt.product_type_id
    """,
    "total_price": f"""
        SELECT od.line_id, CAST(p.price * od.quantity AS DECIMAL(25,2)) AS total
        FROM ({LINES}) od JOIN ({PRODUCTS}) p ON od.product_id = p.product_id
    """,
    "clean_price": r"""
        SELECT l_orderkey, l_linenumber,
               try_cast(regexp_replace(' $' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR),
                                       '\$', '', 'g') AS DECIMAL(4,2)) AS big,
               try_cast(regexp_replace('$1$' || CAST(CAST(l_discount * 10 AS DECIMAL(6,3)) AS VARCHAR),
                                       '\$', '', 'g') AS DECIMAL(4,2)) AS small,
               try_cast(regexp_replace(l_returnflag, '\$', '', 'g') AS DECIMAL(4,2)) AS word
        FROM lineitem
    """,
    "typed_fact_lines": LINES,
    "typed_fact_headers": HEADERS,
    "row_count_check": "SELECT DISTINCT count(*) AS row_count FROM lineitem",
    "scd2_products": VERSIONED_PRODUCTS,
    "scd2_types": VERSIONED_TYPES,
    "scd2_redelivery": f"""
        SELECT product_id, product_type_id, size, price, {CLOSED} FROM ({PARTS})
        UNION ALL
        SELECT product_id, product_type_id, size, price, {OPEN_SECOND} FROM ({PARTS})
    """,
    "scd2_null_keys": f"""
        SELECT key, lang, {CLOSED} FROM ({NULL_KEYS}) WHERE key IS NOT NULL
        UNION ALL
        SELECT key, lang, {OPEN_FIRST} FROM ({NULL_KEYS}) WHERE key IS NULL
        UNION ALL
        SELECT key, lang, {OPEN_SECOND} FROM ({NULL_KEYS})
        UNION ALL
        SELECT key, lang, {OPEN_SECOND} FROM ({NULL_KEYS}) WHERE key IS NULL
    """,
    "scd2_orders": f"""
        SELECT o_orderkey, o_orderstatus, o_totalprice, {OPEN_FIRST}
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT o_orderkey, o_orderstatus, o_totalprice, {CLOSED}
        FROM orders WHERE o_orderstatus = 'P'
        UNION ALL
        SELECT o_orderkey, 'F', o_totalprice, {OPEN_SECOND}
        FROM orders WHERE o_orderstatus = 'P'
    """,
    "staged_union": f"""
        SELECT product_id, product_type_id, size, '$' || CAST(price AS VARCHAR) AS price,
               product_id AS merge_id
        FROM ({PARTS})
        UNION ALL
        SELECT product_id, product_type_id, size, '$' || CAST(price AS VARCHAR), NULL
        FROM ({PARTS})
    """,
    "stream_fact_append": LINES,
    "stream_scd2": VERSIONED_PRODUCTS,
    "stream_scd2_buckets": VERSIONED_PRODUCTS,
    "ingest_json_rescue": f"""
        SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
                    ELSE h.order_id END AS order_id,
               CASE WHEN o_orderstatus <> 'P' THEN h.date END AS date,
               CASE WHEN o_orderstatus <> 'P' THEN h.time END AS time,
               CASE WHEN o_orderstatus = 'O' THEN '{{"key":' || o_custkey || '}}' END
                   AS rescued_customer,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT' THEN 'soon' END
                   AS rescued_date,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT' THEN h.time END
                   AS rescued_time,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
                    THEN '{{"order_id":' || h.order_id END AS rescued_line
        FROM ({HEADERS}) h JOIN orders ON h.order_id = o_orderkey
    """,
    "ingest_csv_rescue": """
        WITH parts AS (
            SELECT p_partkey AS product_id, p_type AS product_type_id, CAST(p_size AS BIGINT) AS size,
                   '$' || CAST(CAST(p_retailprice - 900 AS DECIMAL(4,2)) AS VARCHAR) AS price
            FROM part
        ), small AS (
            SELECT *, CAST(NULL AS VARCHAR) AS rescued_remark, CAST(NULL AS VARCHAR) AS rescued_size
            FROM parts WHERE size <= 25
        )
        SELECT * FROM small
        UNION ALL
        SELECT * FROM small
        UNION ALL
        SELECT product_id, product_type_id, CASE WHEN size <= 40 THEN size END, price,
               product_type_id || ', new', CASE WHEN size > 40 THEN size || ' cm' END
        FROM parts WHERE size > 25
    """,
    "rescue_lossless": """
        WITH o AS (
            SELECT o_orderkey AS k, o_custkey AS c, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
                   CASE WHEN o_orderstatus = 'F' THEN -1 ELSE o_orderkey % 5 END AS turn
            FROM orders
        )
        SELECT CASE WHEN turn <> 3 THEN k END AS order_id,
               CASE WHEN turn NOT IN (1, 3) THEN CAST(day AS DATE) END AS date,
               CASE WHEN turn NOT IN (0, 3) THEN c END AS customer_key,
               CASE WHEN turn = 4 THEN CAST(12.5 AS DOUBLE)
                    WHEN turn NOT IN (2, 3) THEN CAST(1.5 AS DOUBLE) END AS amount,
               CASE WHEN turn = 1 THEN day || ' 10:11:12' END AS rescued_date,
               CASE WHEN turn = 0 THEN '{"key":' || c || ',"new":2.50}' END AS rescued_customer,
               CASE WHEN turn = 2 THEN '12345678901234567890.123456789' END AS rescued_amount,
               CASE WHEN turn = 4 THEN '1e3' END AS rescued_rate,
               CASE WHEN turn = 3 THEN '{"order_id":' || k || ',"date":"' || day || '","customer":{"key":' || c
                                       || '},"z":1,"z":2}' END AS rescued_line
        FROM o
    """,
    "ingest_csv_odd_headers": """
        SELECT CASE WHEN p_partkey % 4 <> 3 THEN CAST(p_partkey AS INTEGER) END AS product_id,
               CASE WHEN p_partkey % 4 <> 3 THEN p_size END AS size,
               CASE WHEN p_partkey % 4 = 1 THEN 'x' END AS unnamed,
               CASE WHEN p_partkey % 4 = 2 THEN 'again' END AS repeated,
               CASE WHEN p_partkey % 4 = 3 THEN CAST(p_partkey AS VARCHAR) END AS other_case,
               CASE WHEN p_partkey % 4 = 3 THEN CAST(p_size AS VARCHAR) END AS with_space
        FROM part
    """,
    "rescue_nested_numbers": """
        WITH o AS (
            SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN -1 ELSE o_orderkey % 5 END AS turn FROM orders
        )
        SELECT k AS order_id,
               CAST(CASE turn WHEN -1 THEN '1.5' WHEN 3 THEN '12345678901234567890.123456789012345678'
                              WHEN 4 THEN '0.000000000000000025' END AS DECIMAL(38,18)) AS net,
               CAST(CASE turn WHEN -1 THEN 0.25 WHEN 3 THEN 0.1 END AS DOUBLE) AS rate,
               CAST(CASE turn WHEN -1 THEN '7' WHEN 4 THEN '-9223372036854775808' END AS BIGINT) AS count,
               CASE turn WHEN 0 THEN '{"count":' || repeat('9', 5000) || '}'
                         WHEN 1 THEN '{"rate":1e1000000}'
                         WHEN 2 THEN '{"net":1234567890.12345678901234567890123}' END AS rescued
        FROM o
    """,
    "ingest_csv_wide_rows": """
        SELECT CAST(p_partkey AS INTEGER) AS product_id, p_size AS size,
               CASE WHEN p_partkey % 100 = 7 THEN md5(p_partkey || ',' || p_size || repeat(',', 30000)) END AS rescued_md5
        FROM part
    """,
    "sample_of_ten": """
        SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 11 = 10 THEN '1' END AS late FROM orders
    """,
    "audit_columns": "SELECT o_orderkey AS order_id, true AS stamped, 'headers' AS folder FROM orders",
    "stream_name": "SELECT o_orderkey AS order_id, 'headers silver' AS query_name FROM orders",
    "bronze_products": f"""
        SELECT CAST(product_id AS INTEGER) AS product_id, product_type_id, size,
               '$' || CAST(price AS VARCHAR) AS price, CAST(NULL AS VARCHAR) AS _rescued_data
        FROM ({PARTS})
    """,
    "bronze_headers": f"SELECT order_id, date, time, CAST(NULL AS VARCHAR) AS _rescued_data FROM ({HEADERS})",
    "bronze_lines": f"""
        SELECT line_id, order_id, product_id, quantity, CAST(NULL AS VARCHAR) AS _rescued_data FROM ({LINES})
    """,
    "bronze_product_types": f"""
        SELECT product_type_id, name, category, ingredients, CAST(NULL AS VARCHAR) AS _rescued_data FROM ({TYPES})
    """,
    "silver_lines": LINES,
    "silver_headers": HEADERS,
    "silver_product_types": f"""
        SELECT product_type_id, name, category, ingredients, status,
               CASE WHEN end_date IS NOT NULL THEN true END AS ended_today,
               CASE WHEN end_date IS NOT NULL THEN true END AS same_day
        FROM ({VERSIONED_TYPES})
    """,
    "silver_products": f"""
        SELECT product_id, product_type_id, size, price, status,
               CASE WHEN end_date IS NOT NULL THEN true END AS ended_today,
               CASE WHEN end_date IS NOT NULL THEN true END AS same_day
        FROM ({VERSIONED_PRODUCTS})
    """,
    "files_to_gold": mart(VERSIONED_PRODUCTS, VERSIONED_TYPES),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the order-line mart over the smallest tables."""
    return workload.gold_order_lines(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**workload.QUERIES, **LLM_QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**ORACLES, **LLM_ORACLES}
