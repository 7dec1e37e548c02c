"""For each registered query, the same answer as plain SQL over the given tables, for checking in another engine."""

from __future__ import annotations

ORDERS_NOW = "TIMESTAMP '2001-07-01 00:00:00'"
EVENTS_NOW = "TIMESTAMP '2024-01-31 00:00:00'"

# The derived tables of ``fixtures``.
FIXTURES = {
    "src_orders": """SELECT o_orderkey AS order_id, concat('CUST_', o_custkey) AS customer_id, o_orderdate AS order_date,
        CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount, o_orderstatus AS status,
        o_orderdate + to_seconds(o_orderkey % 86400) AS created_at FROM orders""",
    "tgt_orders": """SELECT order_id, customer_id, order_date,
        CASE WHEN order_id % 11 = 0 THEN CAST(total_amount + 1 AS DECIMAL(10,2)) ELSE total_amount END AS total_amount,
        CASE WHEN order_id % 13 = 0 THEN NULL WHEN order_id % 7 = 0 THEN 'X' ELSE status END AS status, created_at
        FROM src_orders WHERE order_id % 10 <> 0""",
    "sales": """SELECT o_orderkey AS sale_id, concat('PROD_', o_orderkey % 1000) AS product_id,
        concat('CUST_', o_custkey) AS customer_id, CAST(o_totalprice AS DECIMAL(10,2)) AS sale_amount,
        o_orderdate + to_seconds(o_orderkey % 86400) AS sale_date,
        CASE o_orderkey % 3 WHEN 0 THEN 'West' WHEN 1 THEN 'East' ELSE 'Central' END AS region,
        CAST(o_orderkey % 101 AS INTEGER) AS store_id,
        CASE o_orderkey % 4 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Books' WHEN 2 THEN 'Toys' ELSE 'Food' END AS category,
        o_orderkey % 10 <> 0 AS is_active FROM orders""",
    "sales_text": """SELECT sale_id, product_id, customer_id, sale_amount,
        CASE WHEN sale_id % 11 = 0 THEN 'n/a' WHEN sale_id % 7 = 0 THEN strftime(sale_date, '%Y-%m-%d')
             ELSE strftime(sale_date, '%Y-%m-%d %H:%M:%S') END AS sale_date, region, store_id FROM sales""",
    "sales_month": """SELECT sale_id, product_id, customer_id, sale_amount, store_id, category,
        CAST(date_trunc('month', sale_date) AS DATE) AS sale_date, region FROM sales""",
    "facts": """SELECT event_id AS fact_id, concat('DIM_', user_id) AS dimension_id,
        CAST(value AS DECIMAL(12,4)) AS metric_value, ts AS "timestamp", event_type AS category,
        CASE event_id % 2 WHEN 0 THEN 'SYS1' ELSE 'SYS2' END AS source_system FROM events""",
    "time_series": """SELECT ts AS "timestamp", CAST(value AS DECIMAL(12,4)) AS metric_value,
        event_type AS metric_name, concat('DEV_', user_id) AS device_id,
        CASE user_id % 3 WHEN 0 THEN 'north' WHEN 1 THEN 'south' ELSE 'east' END AS location FROM events""",
    "transactions": """SELECT o_orderkey AS transaction_id, concat('CUST_', o_custkey) AS customer_id,
        CAST(o_totalprice AS DECIMAL(12,2)) AS amount, o_orderdate AS transaction_date,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'open' ELSE 'pending' END AS status,
        o_orderpriority AS priority_level FROM orders""",
    "batch_runs": """SELECT event_id AS batch_id, concat('batch_', user_id) AS batch_name, ts AS processing_date,
        event_type AS status, CAST(event_id % 1000 AS INTEGER) AS records_processed,
        CAST(event_id % 7 AS INTEGER) AS processing_time_seconds FROM events""",
    "query_log": """SELECT event_id AS query_id,
        CASE event_id % 8 WHEN 0 THEN 'VACUUM sales' WHEN 1 THEN 'ANALYZE sales'
             WHEN 2 THEN 'SELECT 1 FROM ext_sales_parquet' WHEN 3 THEN 'DELETE FROM sales_with_deletes'
             ELSE 'SELECT 1' END AS query,
        event_type AS service_class, ts AS start_time, ts + to_seconds(event_id % 60) AS end_time,
        CAST(round(value * 100) AS BIGINT) AS total_time, user_id AS "rows", event_id * 17 AS bytes,
        (event_id * 7919) % 3000000 AS workmem, event_id % 50 AS temp_blocks, event_id % 2 = 0 AS is_rrscan
        FROM events""",
    "history": """SELECT concat('load_', event_type) AS procedure_name, ts AS call_time,
        CAST(round(value * 100) AS BIGINT) AS total_time, event_id AS rows_processed,
        event_type <> 'error' AS success_flag FROM events""",
    "run_log": """SELECT concat('job_', user_id) AS pipeline, concat('step_', event_id) AS task,
        CASE event_id % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'running' WHEN 2 THEN 'completed' WHEN 3 THEN 'failed'
             ELSE 'retrying' END AS status,
        CASE WHEN event_id % 5 <> 0 THEN ts END AS start_time,
        CASE WHEN event_id % 5 IN (2, 3) THEN ts + to_seconds(event_id % 600) END AS end_time,
        CAST(event_id % 4 AS INTEGER) AS retry_count, CASE WHEN event_id % 5 = 3 THEN event_type END AS error_message,
        event_id % 1000 AS "rows" FROM events""",
    "customers": """SELECT concat('CUST_', c_custkey) AS customer_id, c_name AS customer_name,
        CAST(c_acctbal AS DECIMAL(12,2)) AS total_purchases, c_nationkey AS preferred_store_id FROM customer""",
    "warehouse_sales": """SELECT sale_id, customer_id, product_id, CAST(sale_amount + 1 AS DECIMAL(10,2)) AS sale_amount,
        sale_date, region, store_id, CAST(NULL AS TIMESTAMP) AS processed_at,
        TIMESTAMP '1994-12-31 00:00:00' AS updated_at FROM sales WHERE sale_id % 10 <> 0""",
    "counts": """
        SELECT 'sales' AS table_name, count(*) FILTER (WHERE NOT is_active) AS deleted_rows, count(*) AS total_rows FROM sales
        UNION ALL SELECT 'facts', count(*) FILTER (WHERE metric_value < 100), count(*) FROM facts
        UNION ALL SELECT 'orders', count(*) FILTER (WHERE status = 'X'), count(*) FROM tgt_orders
        UNION ALL SELECT 'lines', count(*) FILTER (WHERE l_quantity < 3), count(*) FROM lineitem
        UNION ALL SELECT 'untouched', 0, count(*) FROM customer""",
}

# Which derived tables a derived table reads.
NEEDS = {"tgt_orders": ["src_orders"], "sales_text": ["sales"], "sales_month": ["sales"], "warehouse_sales": ["sales"],
         "counts": ["sales", "facts", "src_orders", "tgt_orders"]}

REPORTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark",
            "labels", "conversations")
PROFILED = ("sale_id", "product_id", "customer_id", "sale_amount", "sale_date", "region", "store_id", "category", "is_active")
ORDER = "order_id, customer_id, order_date, total_amount, status, created_at"


def using(names: str, body: str) -> str:
    """``body`` with the named derived tables, and those they read, in front."""
    chosen: list[str] = []
    for name in names.split():
        for one in [*NEEDS.get(name, []), name]:
            if one not in chosen:
                chosen.append(one)
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURES[n]})" for n in chosen) + "\n" + body


def _classify(compare: str, extra: str = "", where: str = "") -> str:
    return using("src_orders tgt_orders", f"""
        SELECT s.order_id, s.customer_id, s.order_date, s.total_amount, s.status,
               CASE WHEN t.order_id IS NULL THEN 'INSERT' WHEN {compare} THEN 'UPDATE' ELSE 'UNCHANGED' END
                   AS operation_type, {ORDERS_NOW} AS processed_at
        FROM src_orders s LEFT JOIN tgt_orders t ON s.order_id = t.order_id {where} {extra}""")


_SAFE = "(s.status IS DISTINCT FROM t.status OR s.total_amount IS DISTINCT FROM t.total_amount)"
_PLAIN = "(s.status <> t.status OR s.total_amount <> t.total_amount)"


def _generated(column_sql: str, table: str, key: str) -> str:
    """Synthetic rows: ``h(k, top)`` in the text stands for hash number ``k`` spread over 0..top-1."""
    import re

    multipliers = (7919, 104729, 1299709, 15485863, 32452843, 49979687, 67867967)

    def spread(match: re.Match) -> str:
        k, top = int(match[1]), int(match[2])
        unit = f"((id % 2147483647) * {multipliers[k]} + {(1 + k) * 12345}) % 1000003"
        return f"(({unit}) * {top} // 1000003)"
    columns = re.sub(r"h\((\d+), (\d+)\)", spread, column_sql)
    return f"SELECT {columns} FROM (SELECT {key} AS id FROM {table})"


def _value_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS value_count FROM sales GROUP BY {c}"
        for c in PROFILED)


def _ranked(k: int) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY column_name
               ORDER BY value_count DESC, value) AS rank FROM vc WHERE value IS NOT NULL) WHERE rank <= {k}"""


def _correlations() -> str:
    """Equal values share the mean of their ranks."""
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, round(corr(CAST(p AS DOUBLE), r), 6) AS correlation FROM
            (SELECT row_number() OVER (ORDER BY sale_id) AS p,
                    rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS r
             FROM sales)""" for c in PROFILED)


def _encoding() -> str:
    kinds = {"customer_id": "text", "region": "text", "store_id": "ordered", "sale_date": "ordered", "is_active": "boolean",
             "sale_id": "ordered", "product_id": "text", "sale_amount": "ordered", "category": "text"}
    parts = []
    for c, kind in kinds.items():
        rising = (f"round(CAST(count(*) FILTER (WHERE {c} >= p) AS DOUBLE) / nullif(count({c} >= p), 0), 6)"
                  if kind == "ordered" else "CAST(NULL AS DOUBLE)")
        parts.append(f"""SELECT '{c}' AS column_name, '{kind}' AS kind, count(*) AS row_count,
            count(*) FILTER (WHERE n = 1 OR {c} IS DISTINCT FROM p) AS run_count, {rising} AS rising_share,
            round(avg(length(CAST({c} AS VARCHAR))), 4) AS mean_length, count(DISTINCT {c}) AS n_distinct
            FROM (SELECT {c}, lag({c}) OVER (ORDER BY sale_id) AS p, row_number() OVER (ORDER BY sale_id) AS n
                  FROM sales)""")
    return using("sales", f"""SELECT column_name, row_count, run_count, rising_share, mean_length, n_distinct,
        CASE WHEN kind = 'boolean' THEN 'RUNLENGTH' WHEN kind = 'text' AND mean_length > 255 THEN 'ZSTD'
             WHEN run_count < 0.1 * row_count THEN 'RUNLENGTH' WHEN kind = 'ordered' AND rising_share >= 0.9 THEN 'DELTA'
             WHEN kind = 'text' AND n_distinct < 0.1 * row_count THEN 'BYTEDICT' ELSE 'TEXT255' END AS suggested_encoding
        FROM ({' UNION ALL '.join(parts)})""")


def _percentile(unit: str, p: float, span: str) -> str:
    name = f"p{round(p * 100)}_execution_time"
    return using("query_log", f"""SELECT date_trunc('{unit}', start_time) AS "{unit}", service_class,
        count(*) AS query_count, CAST(sum(total_time) AS DOUBLE) / count(total_time) AS avg_execution_time,
        round(percentile_cont({p}) WITHIN GROUP (ORDER BY total_time), 4) AS {name}
        FROM query_log WHERE start_time > {EVENTS_NOW} - INTERVAL {span} GROUP BY 1, 2""")


def _code() -> str:
    def level(expr: str, bounds: list[str]) -> str:
        return "(" + " + ".join(f"CASE WHEN {expr} >= {b} THEN 1 ELSE 0 END" for b in bounds) + ")"
    levels = [level("sale_date", [f"TIMESTAMP '{y}-01-01 00:00:00'" for y in (1996, 1998, 2000)]),
              level("region", ["'East'", "'West'"]), level("store_id", ["25", "50", "75"]),
              level("product_id", ["'PROD_3'", "'PROD_6'"])]
    bits = [f"(({x} // {1 << bit}) % 2) * {1 << (bit * 4 + 3 - i)}" for i, x in enumerate(levels) for bit in (0, 1)]
    return using("sales", f"SELECT sale_id, CAST({' + '.join(bits)} AS BIGINT) AS code FROM sales")


def _bounds(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, "
        f"count(*) - count({c}) AS null_count FROM {table}" for c in columns)


_ALL_SALES = using("sales", "SELECT * FROM sales")
_DELTA = f"""WITH feed AS (SELECT user_id, ts, event_id, event_type, value FROM events)
    SELECT user_id, ts, event_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM feed
        WHERE ts > {EVENTS_NOW} - INTERVAL 24 HOUR) r
    WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM feed t WHERE t.event_id % 3 = 0 AND t.user_id = r.user_id
                                 AND t.ts >= r.ts - INTERVAL 5 MINUTE)"""
_MONEY = "CAST(sum({}) AS DECIMAL(20,2))"
_JANUARY = "BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '1998-01-31 00:00:00'"

ORACLE = {
    # Scans
    "scan_delimited": using("sales_text", """
        SELECT sale_id, product_id, customer_id, sale_amount,
               try_strptime(sale_date, '%Y-%m-%d %H:%M:%S') AS sale_date_timestamp, region, store_id
        FROM sales_text WHERE sale_date BETWEEN '1998-01-01' AND '1998-01-31' AND region = 'West'
        ORDER BY sale_id LIMIT 1000"""),
    "scan_parquet": using("sales", f"""
        SELECT sale_id, product_id, customer_id, sale_amount, sale_date, region, store_id, category
        FROM sales WHERE sale_date {_JANUARY} AND region = 'West' AND category = 'Electronics'
        ORDER BY sale_date DESC, sale_id LIMIT 1000"""),
    "scan_partitioned": using("sales_month", f"""
        SELECT sale_date, region, count(*) AS row_count, {_MONEY.format('sale_amount')} AS sale_amount
        FROM sales_month GROUP BY sale_date, region"""),
    "filter_partitioned": using("sales_month", """
        SELECT sale_id, product_id, customer_id, sale_amount, store_id, category FROM sales_month
        WHERE sale_date BETWEEN DATE '1998-01-01' AND DATE '1998-01-31' AND region = 'West'
          AND category = 'Electronics' ORDER BY sale_date DESC, sale_id LIMIT 1000"""),
    "register_partition": using("sales_month", """
        SELECT sale_date, region, count(*) AS row_count FROM sales_month GROUP BY sale_date, region"""),
    "extract_files": """SELECT o_orderstatus, count(*) AS row_count,
        CAST(sum(CAST(o_totalprice AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total_price FROM orders GROUP BY 1""",
    "generate_sales": _generated("""id AS sale_id, concat('PROD_', h(0, 1000)) AS product_id,
        concat('CUST_', h(1, 1000)) AS customer_id,
        CAST(CAST(h(2, 100000) AS DECIMAL(18,2)) / 100 AS DECIMAL(10,2)) AS sale_amount,
        TIMESTAMP '2001-07-01 00:00:00' - to_seconds(h(3, 31536000)) AS sale_date,
        CASE WHEN h(4, 100) < 30 THEN 'West' WHEN h(4, 100) < 60 THEN 'East' ELSE 'Central' END AS region,
        CAST(h(5, 100) AS INTEGER) AS store_id, h(6, 10) <> 0 AS is_active""", "orders", "o_orderkey"),
    "generate_facts": _generated("""id AS fact_id, concat('DIM_', h(0, 500)) AS dimension_id,
        CAST(CAST(h(1, 10000000) AS DECIMAL(18,4)) / 10000 AS DECIMAL(12,4)) AS metric_value,
        TIMESTAMP '2024-01-31 00:00:00' - to_seconds(h(2, 31536000)) AS "timestamp",
        CASE h(3, 4) WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END AS category,
        CASE h(4, 2) WHEN 0 THEN 'SYS1' ELSE 'SYS2' END AS source_system""", "events", "event_id"),
    "compression_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, column_name, value_count, true AS codec_known, true AS has_bytes "
        f"FROM (SELECT count(*) AS value_count FROM {t}) CROSS JOIN "
        f"(SELECT column_name FROM (DESCRIBE {t}))" for t in REPORTED) + """
        UNION ALL SELECT 'embeddings', 'vec_id', count(*), true, true FROM embeddings
        UNION ALL SELECT 'embeddings', 'label', count(*), true, true FROM embeddings
        UNION ALL SELECT 'embeddings', 'embedding.list.element', CAST(sum(len(embedding)) AS BIGINT), true, true FROM embeddings""",
    "filter_patterns": using("query_log", """SELECT query_id, query, service_class FROM query_log
        WHERE query NOT LIKE 'VACUUM%' AND query NOT LIKE 'ANALYZE%' AND query NOT LIKE 'DELETE%'
          AND service_class IN ('view', 'click', 'purchase')"""),
    "reencode_table": _ALL_SALES,
    "maintain_schema": using("sales facts", """
        SELECT table_name, deleted AS deleted_before, total AS total_before,
               CASE WHEN deleted > 0.15 * total THEN 0 ELSE deleted END AS deleted_after,
               CASE WHEN deleted > 0.15 * total THEN total - deleted ELSE total END AS total_after, deleted > 0.15 * total AS compacted
        FROM (SELECT 'sales' AS table_name, count(*) FILTER (WHERE NOT is_active) AS deleted, count(*) AS total FROM sales
              UNION ALL SELECT 'facts', count(*) FILTER (WHERE metric_value < 100), count(*) FROM facts)"""),
    "load_query_log": """
        SELECT event_id AS query_id, event_type AS query, concat('pool', event_id % 3) AS service_class,
               CAST(date_trunc('second', ts) AS TIMESTAMP) AS start_time,
               CAST(date_trunc('second', ts) + to_milliseconds(event_id % 5000) AS TIMESTAMP) AS end_time, event_id % 5000 AS total_time,
               user_id AS rows, event_id * 17 AS bytes, event_id * 7 % 1000 AS workmem,
               CAST(ceil(event_id % 3 * 1500000 / 1048576.0) AS BIGINT) AS temp_blocks, false AS is_rrscan FROM events""",
    "approximate_profile": """SELECT unnest(['sale_id', 'product_id', 'customer_id', 'sale_amount', 'sale_date', 'region', 'store_id', 'category', 'is_active'])
        AS column_name,
        0.0::DOUBLE AS null_fraction, true AS distinct_close, true AS top_share_close""",
    "zone_overlap": using("sales", """
        SELECT count(*) AS file_count, count(*) FILTER (WHERE hi >= TIMESTAMP '1998-01-01' AND lo <= TIMESTAMP '1998-01-31') AS files_hit,
               CAST(sum(n) AS BIGINT) AS row_count, true AS footers_agree
        FROM (SELECT min(sale_date) AS lo, max(sale_date) AS hi, count(*) AS n FROM sales GROUP BY sale_id // 1000)"""),
    # Sinks and layout
    "append_load": using("src_orders tgt_orders", f"""SELECT {ORDER} FROM tgt_orders
        UNION ALL SELECT {ORDER} FROM src_orders WHERE order_id NOT IN (SELECT order_id FROM tgt_orders)"""),
    "layout_even": _ALL_SALES,
    "layout_auto": _ALL_SALES,
    "layout_key": _ALL_SALES,
    "layout_compound_sort": _ALL_SALES,
    "layout_interleaved": _ALL_SALES,
    "layout_encoded": _ALL_SALES,
    "layout_all_join": """SELECT p_partkey AS product_id, p_type AS category_id, p_size,
        lower(p_type) AS category_name, upper(p_type) AS department FROM part""",
    "interleave_key": _code(),
    "layout_bloom": using("sales", "SELECT * FROM sales WHERE customer_id IN ('CUST_7', 'CUST_70', 'CUST_none')"),
    "native_vs_external": using("sales", f"""
        SELECT side, count(*) AS row_count, {_MONEY.format('sale_amount')} AS sale_amount
        FROM sales CROSS JOIN (VALUES ('native'), ('external')) AS v(side)
        WHERE sale_date {_JANUARY} AND region = 'West' GROUP BY side"""),
    # Filters
    "filter_compound": using("sales", f"SELECT * FROM sales WHERE sale_date {_JANUARY} AND region = 'West'"),
    "filter_interleaved": using("sales", "SELECT * FROM sales WHERE region = 'West' AND store_id = 100"),
    "filter_time_series": using("time_series", """SELECT * FROM time_series
        WHERE "timestamp" BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-15 23:59:59'"""),
    "filter_string_dates": using("sales_text", f"""
        SELECT 'text' AS rule, sale_id, sale_date FROM sales_text WHERE sale_date BETWEEN '1998-01-01' AND '1998-01-31'
        UNION ALL SELECT 'typed', sale_id, sale_date FROM sales_text
        WHERE try_strptime(sale_date, '%Y-%m-%d %H:%M:%S') {_JANUARY}"""),
    "parse_timestamps": using("sales_text", """
        SELECT sale_id, try_strptime(sale_date, '%Y-%m-%d %H:%M:%S') AS parsed FROM sales_text"""),
    "cast_rounding": """SELECT l_orderkey, CAST(l_extendedprice AS BIGINT) AS from_double,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS BIGINT) AS from_decimal FROM lineitem""",
    # Joins
    "existing_orders": using("src_orders tgt_orders", """SELECT * FROM src_orders s
        WHERE EXISTS (SELECT 1 FROM tgt_orders t WHERE t.order_id = s.order_id)"""),
    "new_orders": using("src_orders tgt_orders", """SELECT * FROM src_orders s
        WHERE NOT EXISTS (SELECT 1 FROM tgt_orders t WHERE t.order_id = s.order_id)"""),
    "join_inner_multi": """SELECT o_orderkey, c_name, n_name, CAST(o_totalprice AS DECIMAL(10,2)) AS price
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "join_colocated": using("src_orders customers", """SELECT o.customer_id, customer_name, order_id, total_amount
        FROM src_orders o JOIN customers c ON o.customer_id = c.customer_id"""),
    "update_from": using("src_orders tgt_orders", """
        SELECT t.order_id, t.customer_id, t.order_date, CASE WHEN t.order_id % 15 <> 4 THEN s.total_amount ELSE t.total_amount END AS total_amount,
               CASE WHEN t.order_id % 15 <> 4 THEN s.status ELSE t.status END AS status, t.created_at
        FROM tgt_orders t JOIN src_orders s ON t.order_id = s.order_id"""),
    "key_violations": """SELECT l_orderkey, l_linenumber, count(*) AS row_count, 'duplicate key' AS reason
        FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    # Reports
    "top_customers": using("transactions", f"""
        SELECT customer_id, CAST(sum(amount) AS DECIMAL(20,2)) AS total_transactions, count(*) AS transaction_count,
               max(transaction_date) AS last_transaction FROM transactions
        WHERE transaction_date > {ORDERS_NOW} - INTERVAL 30 DAY AND status = 'completed'
        GROUP BY customer_id ORDER BY total_transactions DESC, customer_id LIMIT 100"""),
    "daily_report": using("transactions", f"""
        SELECT CAST(date_trunc('day', transaction_date) AS TIMESTAMP) AS transaction_day, count(*) AS daily_transactions,
               CAST(sum(amount) AS DECIMAL(20,2)) AS daily_amount,
               CAST(sum(amount) AS DOUBLE) / count(*) AS avg_transaction_amount
        FROM transactions WHERE transaction_date > {ORDERS_NOW} - INTERVAL 30 DAY GROUP BY 1"""),
    "throughput": using("batch_runs", f"""
        SELECT batch_name, processing_date, status, records_processed, processing_time_seconds,
               CAST(records_processed // nullif(processing_time_seconds, 0) AS BIGINT) AS records_per_second
        FROM batch_runs WHERE processing_date > {EVENTS_NOW} - INTERVAL 7 DAY"""),
    "high_water_mark": using("tgt_orders", "SELECT max(order_date) AS high_water_mark FROM tgt_orders"),
    "latest_version": """SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC,
            l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""",
    "keyset_page": using("src_orders", "SELECT * FROM src_orders WHERE order_id > 100 ORDER BY order_id LIMIT 1000"),
    "identity_across_loads": """SELECT event_id, ts, event_type,
        row_number() OVER (ORDER BY day(ts) % 3, ts, event_id) AS row_key FROM events""",
    "assign_identity_key": """SELECT event_id, ts, event_type, row_number() OVER (ORDER BY ts, event_id) AS row_key
        FROM events""",
    # Loads
    "inc_by_timestamp": using("src_orders", f"""SELECT * FROM src_orders
        WHERE order_date > (SELECT max(order_date) FROM src_orders WHERE order_date <= TIMESTAMP '2001-01-01 00:00:00')
          AND order_date <= {ORDERS_NOW}"""),
    "inc_by_timestamp_initial": using("src_orders", """SELECT * FROM src_orders
        WHERE order_date <= TIMESTAMP '2001-01-01 00:00:00'"""),
    "inc_late_rows": using("src_orders", f"""SELECT * FROM src_orders
        WHERE order_date >= (SELECT max(order_date) - INTERVAL 365 DAY FROM src_orders
                             WHERE order_date <= TIMESTAMP '2001-01-01 00:00:00' AND order_id % 10 <> 0)
          AND order_date <= {ORDERS_NOW}
          AND (order_date > TIMESTAMP '2001-01-01 00:00:00' OR order_id % 10 = 0)"""),
    "inc_by_id": using("src_orders", """SELECT * FROM src_orders
        WHERE order_id > (SELECT max(order_id) FROM src_orders WHERE order_date < TIMESTAMP '1995-01-03 00:00:00')"""),
    "inc_by_id_gaps": using("src_orders", "SELECT * FROM src_orders WHERE order_id % 10 = 0"),
    "cdc_classify": _classify(_SAFE),
    "cdc_classify_plain": _classify(f"coalesce({_PLAIN}, false)"),
    "cdc_classify_window": _classify(_SAFE, where=f"""WHERE s.created_at > {ORDERS_NOW} - INTERVAL 30 DAY
        OR (t.order_id IS NOT NULL AND {_SAFE})"""),
    "cdc_deletes": _classify(_SAFE, where="WHERE s.order_id % 15 <> 4", extra=f"""
        UNION ALL SELECT order_id, customer_id, order_date, total_amount, status, 'DELETE', {ORDERS_NOW}
        FROM tgt_orders WHERE order_id % 15 = 4"""),
    "cdc_apply": using("src_orders tgt_orders", f"""
        SELECT s.order_id, s.customer_id, s.order_date, s.total_amount, s.status,
               CASE WHEN t.order_id IS NULL OR {_SAFE} THEN {ORDERS_NOW} ELSE TIMESTAMP '2001-06-30 00:00:00' END
                   AS loaded_at
        FROM src_orders s LEFT JOIN tgt_orders t ON s.order_id = t.order_id WHERE s.order_id % 15 <> 4"""),
    "replay_changes": using("src_orders tgt_orders", """,
        first AS (SELECT order_id, customer_id, order_date, total_amount, status,
                         CASE WHEN order_id % 10 <> 0 THEN TIMESTAMP '2001-06-30 00:00:00' END AS loaded_at
                  FROM src_orders WHERE order_id % 15 <> 4),
        second AS (SELECT order_id, customer_id, order_date,
                          CASE WHEN order_id % 4 = 0 THEN CAST(total_amount + 10 AS DECIMAL(10,2)) ELSE total_amount END AS total_amount,
                          CASE WHEN order_id % 4 = 0 THEN 'B2' ELSE status END AS status, loaded_at FROM first),
        third AS (SELECT * FROM second WHERE order_id % 7 <> 0 UNION ALL
                  SELECT order_id, customer_id, order_date, total_amount, 'B3', NULL FROM src_orders WHERE order_id % 30 = 4)
        SELECT *, 0 AS as_of_batch FROM first UNION ALL SELECT *, 1 FROM second UNION ALL SELECT *, 2 FROM third
        """.replace(",\n        first", ", first", 1)),
    "staging_purge": using("src_orders", """
        SELECT order_id, customer_id, order_date, total_amount, status, created_at AS processed_at
        FROM src_orders WHERE created_at >= TIMESTAMP '2001-01-01 11:00:00'"""),
    "delta_load": _DELTA,
    "batch_assign": using("src_orders", """
        SELECT order_id, CAST((row_number() OVER (ORDER BY order_id) - 1) // 1000 AS BIGINT) AS batch_no
        FROM src_orders"""),
    "batch_load": using("src_orders", "SELECT * FROM src_orders"),
    "batch_load_streamed": using("src_orders", "SELECT * FROM src_orders"),
    "upsert": using("src_orders tgt_orders", f"""SELECT *, {ORDERS_NOW} AS updated_at FROM src_orders WHERE order_id % 15 <> 4
        UNION ALL SELECT *, CAST(NULL AS TIMESTAMP) FROM tgt_orders WHERE order_id % 15 = 4"""),
    "upsert_moved_key": using("src_orders tgt_orders", f"""
        SELECT *, CAST(year(order_date) AS INTEGER) AS order_year FROM (
            SELECT {ORDER} FROM tgt_orders WHERE order_id % 15 <> 4 UNION ALL
            SELECT order_id, customer_id, CAST(order_date + INTERVAL 1 YEAR AS TIMESTAMP), total_amount, status, created_at FROM src_orders
            WHERE order_id % 15 = 4)"""),
    "upsert_bucketed": using("src_orders tgt_orders", f"""SELECT {ORDER} FROM src_orders WHERE order_id % 15 <> 4
        UNION ALL SELECT {ORDER} FROM tgt_orders WHERE order_id % 15 = 4"""),
    "delete_partitioned": using("src_orders", f"""SELECT {ORDER}, CAST(year(order_date) AS INTEGER) AS order_year FROM src_orders
        WHERE year(order_date) <> 1997 AND order_id % 7 <> 0"""),
    "compact_partitioned": using("src_orders", f"""SELECT {ORDER}, CAST(year(order_date) AS INTEGER) AS order_year FROM src_orders
        WHERE status <> 'P'"""),
    "cdc_repeated_keys": f"""
        WITH newest AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
                 ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1),
             known AS (SELECT * FROM lineitem WHERE l_orderkey % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY l_orderkey
                 ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
        SELECT n.l_orderkey, n.l_shipdate, n.l_linenumber, n.l_partkey, n.l_suppkey, n.l_extendedprice, n.l_returnflag,
               CASE WHEN k.l_orderkey IS NULL THEN 'INSERT'
                    WHEN k.l_returnflag IS DISTINCT FROM n.l_returnflag OR k.l_partkey IS DISTINCT FROM n.l_partkey THEN 'UPDATE'
                    ELSE 'UNCHANGED' END AS operation_type, {ORDERS_NOW} AS processed_at
        FROM newest n LEFT JOIN known k USING (l_orderkey)""",
    "proc_by_timestamp": using("src_orders", f"""SELECT *, CASE WHEN order_date > TIMESTAMP '2001-01-01 00:00:00' THEN {ORDERS_NOW} END AS loaded_at
        FROM src_orders WHERE order_date <= {ORDERS_NOW}"""),
    "proc_by_id": using("src_orders", f"""
        SELECT *, CAST(NULL AS TIMESTAMP) AS loaded_at FROM src_orders WHERE order_date < TIMESTAMP '1995-01-03 00:00:00'
        UNION ALL SELECT *, {ORDERS_NOW} FROM src_orders
        WHERE order_id > (SELECT max(order_id) FROM src_orders WHERE order_date < TIMESTAMP '1995-01-03 00:00:00')"""),
    "proc_delta": f"""
        WITH newest AS (SELECT user_id, ts, event_id, event_type, value FROM events WHERE ts > {EVENTS_NOW} - INTERVAL 24 HOUR
                        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
             held AS (SELECT user_id, ts, event_id, event_type, value FROM events WHERE event_id % 3 = 0)
        SELECT *, CAST(NULL AS TIMESTAMP) AS loaded_at FROM held
        UNION ALL SELECT n.*, {EVENTS_NOW} FROM newest n WHERE NOT EXISTS (
            SELECT 1 FROM held h WHERE h.user_id = n.user_id AND h.ts >= n.ts - INTERVAL 5 MINUTE)""",
    "proc_batches": using("src_orders", f"""SELECT *, CASE WHEN order_id >= 5 THEN {ORDERS_NOW} END AS loaded_at FROM src_orders"""),
    "proc_changes": using("src_orders tgt_orders", f"""
        SELECT s.order_id, s.customer_id, s.order_date, s.total_amount, s.status,
               CASE WHEN t.order_id IS NULL OR {_SAFE} THEN {ORDERS_NOW} END AS loaded_at,
               CASE WHEN t.order_id IS NULL THEN 'INSERT' WHEN {_SAFE} THEN 'UPDATE' END AS noted
        FROM src_orders s LEFT JOIN tgt_orders t ON s.order_id = t.order_id WHERE s.order_id % 15 <> 4"""),
    "daily_sales_load": using("sales", f"""
        SELECT sale_id, customer_id, product_id, sale_amount, sale_date, region, store_id, {ORDERS_NOW} AS updated_at
        FROM sales WHERE sale_date >= TIMESTAMP '2001-06-30 00:00:00'
        UNION ALL SELECT sale_id, customer_id, product_id, CAST(sale_amount + 1 AS DECIMAL(10,2)), sale_date, region, store_id, NULL
        FROM sales WHERE sale_date < TIMESTAMP '2001-06-30 00:00:00' AND sale_id % 2 = 0"""),
    "upsert_partitions": using("src_orders tgt_orders", f"""
        SELECT {ORDER}, CAST(year(order_date) AS INTEGER) AS order_year FROM src_orders WHERE year(order_date) = 1998
        UNION ALL SELECT {ORDER}, CAST(year(order_date) AS INTEGER) FROM tgt_orders WHERE year(order_date) <> 1998"""),
    "upsert_after_failure": using("src_orders tgt_orders", f"""
        SELECT {ORDER}, CAST(year(order_date) AS INTEGER) AS order_year FROM src_orders WHERE order_id % 15 <> 4
        UNION ALL SELECT {ORDER}, CAST(year(order_date) AS INTEGER) FROM tgt_orders WHERE order_id % 15 = 4"""),
    "upsert_segments": using("src_orders tgt_orders", f"""
        SELECT {ORDER} FROM src_orders WHERE order_date >= TIMESTAMP '1998-01-01' AND order_date < TIMESTAMP '1998-02-01'
        UNION ALL SELECT {ORDER} FROM tgt_orders WHERE order_date < TIMESTAMP '1998-01-01' OR order_date >= TIMESTAMP '1998-02-01'"""),
    "delete_segments": using("src_orders tgt_orders", f"""
        SELECT {ORDER} FROM tgt_orders WHERE order_date >= TIMESTAMP '1994-01-01'
        UNION ALL SELECT {ORDER} FROM src_orders WHERE order_date < TIMESTAMP '1994-01-01' AND order_id % 10 = 0"""),
    "default_fill": using("tgt_orders", f"""SELECT *,
        CASE WHEN order_id % 3 <> 0 THEN order_date ELSE {ORDERS_NOW} END AS loaded_at FROM tgt_orders"""),
    "delete_where": using("tgt_orders", "SELECT * FROM tgt_orders WHERE status IS NULL OR status <> 'X'"),
    "delete_from_table": using("facts", "SELECT * FROM facts WHERE metric_value >= 100"),
    "daily_transform": using("sales", f"""SELECT sale_id, customer_id, product_id, sale_amount, sale_date, region,
        store_id, {ORDERS_NOW} AS processed_at FROM sales WHERE sale_date >= TIMESTAMP '2001-06-30 00:00:00'"""),
    "load_history": using("history", f"""SELECT * FROM history WHERE call_time > {EVENTS_NOW} - INTERVAL 24 HOUR"""),
    # Upkeep
    "maintenance_needed": using("counts", "SELECT * FROM counts WHERE deleted_rows > 1000"),
    "maintenance_by_ratio": using("counts", """SELECT *, CAST(deleted_rows AS DOUBLE) / total_rows AS deleted_ratio
        FROM counts WHERE deleted_rows > 0 AND CAST(deleted_rows AS DOUBLE) / total_rows > 0.1"""),
    "deleted_rows_report": using("counts", "SELECT * FROM counts WHERE deleted_rows > 0"),
    "compact": using("sales", "SELECT * FROM sales WHERE is_active"),
    "selective_compact": using("counts", """
        SELECT table_name, deleted_rows AS deleted_before, total_rows AS total_before,
               CASE WHEN needed THEN 0 ELSE deleted_rows END AS deleted_after,
               CASE WHEN needed THEN total_rows - deleted_rows ELSE total_rows END AS total_after,
               needed AS compacted, false AS failed
        FROM (SELECT *, deleted_rows > 0.15 * total_rows AS needed FROM counts WHERE table_name IN ('sales', 'facts'))
        UNION ALL SELECT 'absent', NULL, NULL, NULL, NULL, false, true"""),
    "analyze_table": using("tgt_orders", f"""SELECT column_name, CASE WHEN column_name <> 'status' THEN min_value END
        AS min_value, CASE WHEN column_name <> 'status' THEN max_value END AS max_value, null_count
        FROM ({_bounds('tgt_orders', ['order_id', 'total_amount', 'status'])})"""),
    "column_profile": using("sales", f""",
        vc AS ({_value_counts()}), top AS ({_ranked(5)}), c AS ({_correlations()}),
        n AS (SELECT count(*) AS n FROM sales)
        SELECT b.column_name, b.n_distinct, 0.0::DOUBLE AS null_fraction, correlation, most_common_vals,
               round(CAST(top_count AS DOUBLE) / n, 4) AS most_common_share
        FROM (SELECT column_name, count(*) AS n_distinct FROM vc GROUP BY 1) b JOIN c USING (column_name)
        JOIN (SELECT column_name, string_agg(value, ',' ORDER BY rank) AS most_common_vals,
                     sum(value_count) AS top_count FROM top GROUP BY 1) USING (column_name) CROSS JOIN n
        """.replace(",\n        vc", ", vc", 1)),
    "profile_after_append": using("sales", f""",
        vc AS ({_value_counts()}), top AS ({_ranked(5)}), n AS (SELECT count(*) AS n FROM sales)
        SELECT b.column_name, b.n_distinct, 0.0::DOUBLE AS null_fraction, most_common_vals,
               round(CAST(top_count AS DOUBLE) / n, 4) AS most_common_share
        FROM (SELECT column_name, count(*) AS n_distinct FROM vc GROUP BY 1) b
        JOIN (SELECT column_name, string_agg(value, ',' ORDER BY rank) AS most_common_vals,
                     sum(value_count) AS top_count FROM top GROUP BY 1) USING (column_name) CROSS JOIN n
        """.replace(",\n        vc", ", vc", 1)),
    "most_common_values": using("sales", f""", vc AS ({_value_counts()})
        SELECT column_name, CAST(rank AS INTEGER) AS rank, value, value_count,
               round(CAST(value_count AS DOUBLE) / (SELECT count(*) FROM sales), 6) AS frequency
        FROM ({_ranked(10)})"""),
    "encoding_profile": _encoding(),
    "key_skew": """SELECT *, round(row_count / avg(row_count) OVER (), 4) AS skew FROM (
        SELECT l_partkey % 16 AS bucket, count(*) AS row_count, count(DISTINCT l_partkey) AS key_count
        FROM lineitem GROUP BY 1)""",
    # Query log
    "log_recent": using("query_log", f"SELECT * FROM query_log WHERE start_time > {EVENTS_NOW} - INTERVAL 1 HOUR"),
    "log_by_class": using("query_log", f"""
        SELECT service_class, count(*) AS query_count,
               CAST(sum(total_time) AS DOUBLE) / count(total_time) AS avg_execution_time,
               max(total_time) AS max_execution_time, CAST(sum("rows") AS BIGINT) AS total_rows_processed,
               CAST(sum(bytes) AS BIGINT) AS total_bytes_processed
        FROM query_log WHERE start_time > {EVENTS_NOW} - INTERVAL 24 HOUR GROUP BY 1"""),
    "log_heavy": using("query_log", f"""SELECT * FROM query_log
        WHERE total_time > 5000 AND start_time > {EVENTS_NOW} - INTERVAL 1 HOUR
        ORDER BY total_time DESC, query, query_id LIMIT 20"""),
    "log_memory": using("query_log", f"""SELECT * FROM query_log
        WHERE workmem > 1000000 AND start_time > {EVENTS_NOW} - INTERVAL 1 HOUR
        ORDER BY workmem DESC, query, query_id LIMIT 20"""),
    "log_hourly_p95": _percentile("hour", 0.95, "24 HOUR"),
    "log_daily_median": _percentile("day", 0.5, "60 DAY"),
    "log_sketched": using("query_log", "\nUNION ALL\n".join(f"""
        SELECT {days} AS days, service_class, count(*) AS row_count, CAST(sum(total_time) AS DOUBLE) / count(total_time) AS average,
               min(total_time) AS least, max(total_time) AS most, true AS percentile_near, true AS distinct_near
        FROM query_log WHERE start_time >= {EVENTS_NOW} - INTERVAL {days} DAY AND start_time < {EVENTS_NOW} GROUP BY 2"""
        for days in (1, 7))),
    "log_table_access": using("query_log", f"""SELECT * FROM query_log
        WHERE query LIKE '%ext_sales%' AND start_time > {EVENTS_NOW} - INTERVAL 1 HOUR"""),
    "log_text_search": using("query_log", "SELECT * FROM query_log WHERE query LIKE '%ext_sales%'"),
    "log_maintenance": using("query_log", f"""SELECT * FROM query_log
        WHERE query LIKE '%VACUUM%' OR query LIKE '%ANALYZE%' AND start_time > {EVENTS_NOW} - INTERVAL 24 HOUR"""),
    "log_maintenance_strict": using("query_log", f"""SELECT * FROM query_log
        WHERE (query LIKE '%VACUUM%' OR query LIKE '%ANALYZE%') AND start_time > {EVENTS_NOW} - INTERVAL 24 HOUR"""),
    "log_table_history": using("query_log", f"""SELECT query, service_class, start_time, total_time, "rows", bytes
        FROM query_log WHERE query LIKE '%sales_with_deletes%' AND start_time > {EVENTS_NOW} - INTERVAL 48 HOUR"""),
    # Jobs
    "daily_sales_job": using("sales warehouse_sales", f"""
        SELECT w.sale_id, w.customer_id, w.product_id,
               CASE WHEN s.sale_id IS NULL THEN w.sale_amount ELSE s.sale_amount END AS sale_amount,
               w.sale_date, w.region, w.store_id, w.processed_at,
               CASE WHEN s.sale_id IS NULL THEN w.updated_at ELSE {ORDERS_NOW} END AS updated_at
        FROM warehouse_sales w LEFT JOIN sales s
             ON w.sale_id = s.sale_id AND s.sale_date >= TIMESTAMP '2001-06-30 00:00:00'
        UNION ALL SELECT sale_id, customer_id, product_id, sale_amount, sale_date, region, store_id, {ORDERS_NOW},
               {ORDERS_NOW} FROM sales
        WHERE sale_date >= TIMESTAMP '2001-06-30 00:00:00' AND sale_id NOT IN (SELECT sale_id FROM warehouse_sales)"""),
    "load_metrics": using("src_orders", f"""SELECT 'orders' AS target, count(*) AS records_loaded,
        {ORDERS_NOW} AS load_time FROM src_orders
        WHERE order_date > (SELECT max(order_date) FROM src_orders WHERE order_date <= TIMESTAMP '2001-01-01 00:00:00')
          AND order_date <= {ORDERS_NOW}"""),
    "sql_transform": using("sales", f"""SELECT region, count(*) AS row_count,
        {_MONEY.format('sale_amount')} AS sale_amount FROM sales WHERE is_active GROUP BY region"""),
    "fn_transform": using("sales", "SELECT sale_id, sale_amount FROM sales WHERE sale_amount > 100000"),
    "run_summary": using("run_log", """
        SELECT pipeline AS pipeline_name,
               CASE WHEN failed_tasks > 0 THEN 'failed' WHEN completed_tasks = total_tasks THEN 'completed'
                    WHEN start_time IS NULL THEN 'pending' ELSE 'running' END AS status, start_time, end_time,
               CAST((epoch_us(end_time) - epoch_us(start_time)) // 1000000 AS BIGINT) AS duration_seconds,
               total_tasks, completed_tasks, failed_tasks, "rows"
        FROM (SELECT pipeline, min(start_time) AS start_time, max(end_time) AS end_time, count(*) AS total_tasks,
                     count(*) FILTER (WHERE status = 'completed') AS completed_tasks,
                     count(*) FILTER (WHERE status = 'failed') AS failed_tasks, CAST(sum("rows") AS BIGINT) AS "rows"
              FROM run_log GROUP BY pipeline)"""),
    "run_details": using("run_log", """
        SELECT pipeline, task, status, start_time, end_time,
               CAST((epoch_us(end_time) - epoch_us(start_time)) // 1000000 AS BIGINT) AS duration_seconds, retry_count,
               error_message, "rows" FROM run_log"""),
    # Streams
    "stream_append": using("src_orders", "SELECT * FROM src_orders"),
    "stream_latest_upsert": """SELECT user_id, hour, ts, event_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, hour ORDER BY ts DESC, event_id DESC) AS rn FROM (
            SELECT user_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, event_id, event_type, value FROM events))
        WHERE rn = 1""",
    "stream_dedup": """SELECT event_id, ts, event_type FROM events
        UNION ALL SELECT event_id, ts + INTERVAL 1 HOUR, event_type FROM events WHERE event_id % 5 = 0""",
}
