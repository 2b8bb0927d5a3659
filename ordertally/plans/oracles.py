"""The same results in plain SQL over the driver's tables."""

from __future__ import annotations

from ordertally.plans.queries import CUTS, FIRST_SECOND, SECONDS

_BASE = """orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey"""

_TOTALS = f"""
SELECT c_mktsegment AS source, n_name AS state,
       round(sum(o_totalprice), 2) AS total_sum_amount
FROM {_BASE}
GROUP BY 1, 2
"""

_EVENTS = """
SELECT c_mktsegment AS source, n_name AS state, round(sum(value), 2) AS total_sum_amount
FROM events JOIN customer ON user_id = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2
"""

_BY_PRODUCT = """
SELECT p_brand AS category, round(sum(l_extendedprice), 2) AS total_sum_amount
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
GROUP BY 1
"""

_ORDERS = """
SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS created_at,
       o_totalprice AS total, o_custkey AS customer_id
FROM orders
"""

_ENRICHED = f"""
SELECT o_orderkey AS order_id, c_mktsegment AS source, n_name AS state FROM {_BASE}
"""

_UNMATCHED = """
SELECT o_orderkey AS order_id FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
"""

_BATCH = (
    "CASE "
    + " ".join(f"WHEN o_orderdate < TIMESTAMP '{cut}' THEN {n}" for n, cut in enumerate(CUTS))
    + f" ELSE {len(CUTS)} END"
)

# Doubles as decimals, by their shortest text.
_EXACT_SUM = "CAST(sum(CAST(CAST({} AS VARCHAR) AS DECIMAL(28,10))) AS DOUBLE) AS total_sum_amount"

_EXACT_TOTALS = f"""
SELECT c_mktsegment AS source, n_name AS state, {_EXACT_SUM.format('o_totalprice')}
FROM {_BASE}
GROUP BY 1, 2
"""

_CORRECTED = f"""
WITH last AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN o_custkey % 100 + 1 ELSE o_custkey END AS customer_id,
         CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2
              WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1
              ELSE o_totalprice END AS total
  FROM orders
)
SELECT c_mktsegment AS source, n_name AS state, {_EXACT_SUM.format('total')}
FROM last JOIN customer ON customer_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2
"""

_AS_OF = f"""
SELECT o.order_id, o.total, v.source, v.state
FROM (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total,
         make_timestamp(({FIRST_SECOND} + o_orderkey * 7919 % {SECONDS}) * 1000000) AS at
  FROM orders
) o ASOF LEFT JOIN (
  SELECT user_id AS customer_id, ts AS valid_from, max(event_type) AS source,
         'day ' || day(ts) AS state
  FROM events GROUP BY 1, 2
) v ON o.customer_id = v.customer_id AND o.at >= v.valid_from
"""

_LAST_ORDERS = """
        SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS created_at,
               round(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1
                          ELSE o_totalprice END, 2) AS total,
               o_custkey AS customer_id
        FROM orders
    """

ORACLES: dict[str, str] = {
    "kpi_exact": _EXACT_TOTALS,
    "kpi_exact_large_dimension": _EXACT_TOTALS,
    "kpi_stream_exact": _EXACT_TOTALS,
    "kpi_backfill_then_stream": _EXACT_TOTALS,
    "kpi_state": _EXACT_TOTALS,
    "kpi_state_carried_over": _EXACT_TOTALS,
    "kpi_corrections": _CORRECTED,
    "kpi_last_versions": _CORRECTED,
    "kpi_waiting": f"""
        SELECT c_mktsegment AS source, n_name AS state, {_EXACT_SUM.format('o_totalprice')}
        FROM {_BASE} WHERE c_acctbal >= 0 OR c_custkey % 2 = 0
        GROUP BY 1, 2
    """,
    "kpi_run": f"""
        SELECT *, (SELECT count(*) FROM orders) AS archived FROM ({_TOTALS})
    """,
    "dropped_messages": """
        WITH known AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0),
        sent AS (SELECT count(*) AS n FROM (SELECT 1 FROM orders UNION ALL SELECT 1 FROM documents))
        SELECT 'archive' AS query, 'messages' AS what, n AS messages FROM sent
        UNION ALL
        SELECT 'archive', 'empty', count(*) FROM documents WHERE trim(text) = '' OR text IS NULL
        UNION ALL
        SELECT 'archive', 'malformed', count(*) FROM documents WHERE trim(text) <> ''
        UNION ALL
        SELECT 'archive', 'no_order_id', count(*) FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT 'totals', 'messages', n FROM sent
        UNION ALL
        SELECT 'totals', 'no_amount', count(*) FROM orders WHERE o_orderstatus = 'P'
        UNION ALL
        SELECT 'totals', 'unmatched', (SELECT count(*) FROM documents) + count(*)
        FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM known)
    """,
    "orders_as_of": f"SELECT order_id, source, state FROM ({_AS_OF})",
    "kpi_as_of_late": f"""
        SELECT source, state, {_EXACT_SUM.format('total')}, count(*) AS orders
        FROM ({_AS_OF}) WHERE source IS NOT NULL
        GROUP BY 1, 2
    """,
    "kpi_by_source_state": _TOTALS,
    "kpi_large_dimension": _TOTALS,
    "kpi_dedup": _TOTALS,
    "kpi_text_keys": _TOTALS,
    "kpi_dedup_missing_ids": _TOTALS,
    "kpi_untidy": f"""
        SELECT c_mktsegment AS source, n_name AS state,
               round(sum(CASE WHEN o_orderstatus NOT IN ('P', 'F') THEN o_totalprice END), 2)
                 AS total_sum_amount
        FROM {_BASE}
        GROUP BY 1, 2
    """,
    "kpi_mixed_messages": _TOTALS,
    "kpi_customers_listed_twice": f"""
        SELECT c_mktsegment AS source, place AS state,
               round(sum(o_totalprice), 2) AS total_sum_amount
        FROM {_BASE} JOIN region ON n_regionkey = r_regionkey,
          LATERAL (SELECT n_name AS place UNION ALL SELECT r_name)
        GROUP BY 1, 2
    """,
    "events_kpi": _EVENTS,
    "kpi_backfill": _TOTALS,
    "kpi_by_product": _BY_PRODUCT,
    "kpi_by_product_large_dimension": _BY_PRODUCT,
    "kpi_stream_current": _TOTALS,
    "kpi_stream_large_dimension": _TOTALS,
    "kpi_stream_dedup": _TOTALS,
    "events_kpi_stream": _EVENTS,
    "kpi_history": f"""
        WITH per_batch AS (
          SELECT c_mktsegment AS source, n_name AS state,
                 CAST({_BATCH} AS BIGINT) AS batch_id, sum(o_totalprice) AS amount
          FROM {_BASE}
          GROUP BY 1, 2, 3
        )
        SELECT source, state, batch_id,
               round(sum(amount) OVER (PARTITION BY source, state ORDER BY batch_id), 2)
                 AS total_sum_amount
        FROM per_batch
    """,
    "decoded_orders": _ORDERS,
    "decoded_order_lines": """
        SELECT l_orderkey AS order_id, strftime(l_shipdate, '%Y-%m-%d') AS created_at,
               l_partkey AS product_id, l_suppkey AS customer_id,
               l_discount AS discount, l_quantity AS quantity, l_extendedprice AS subtotal,
               l_tax AS tax, l_extendedprice + l_tax AS total
        FROM lineitem
    """,
    "decode_event_props": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
    """,
    "orders_csv_messages": _ORDERS,
    "orders_csv_scan": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS quantity,
               l_tax AS tax
        FROM lineitem
    """,
    "customers_csv_scan": """
        SELECT c_custkey AS customer_id, c_mktsegment AS source, n_name AS state
        FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
    "products_csv_scan": """
        SELECT CAST(p_partkey AS INTEGER) AS id, p_brand AS category,
               lpad(CAST(p_partkey AS VARCHAR), 13, '0') AS ean, p_retailprice AS price,
               CAST(p_size AS DOUBLE) AS rating, p_name AS title,
               p_type || ', ' || p_brand AS vendor
        FROM part
    """,
    "enriched_orders": _ENRICHED,
    "enriched_orders_large_dimension": _ENRICHED,
    "enriched_orders_spread": _ENRICHED,
    "unmatched_orders": _UNMATCHED,
    "unmatched_orders_large_dimension": _UNMATCHED,
    "unmatched_orders_spread": _UNMATCHED,
    "archive_scan": _ORDERS,
    "rejected_messages": """
        SELECT text, CASE WHEN trim(text) = '' THEN 'empty' ELSE 'malformed' END AS reason
        FROM (SELECT text FROM documents UNION ALL SELECT text FROM conversations)
    """,
    "rejected_orders": """
        SELECT reason, customer_id, count(*) AS messages
        FROM (
          SELECT 'no order_id' AS reason, o_custkey AS customer_id
          FROM orders WHERE o_orderstatus = 'F'
          UNION ALL
          SELECT CASE WHEN trim(text) = '' THEN 'empty' ELSE 'malformed' END, NULL
          FROM (SELECT text FROM documents UNION ALL SELECT text FROM conversations)
        )
        GROUP BY ALL
    """,
    "archive_current": _LAST_ORDERS,
    "archive_current_table": _LAST_ORDERS,
    "kpi_compacted": _EXACT_TOTALS,
    "kpi_published_once": _EXACT_TOTALS,
}
