"""The same queries as SQL over the test tables, for an independent engine to answer."""

from __future__ import annotations

# ---- the sales tables ---------------------------------------------------------------

_SALES = """
WITH au_orders AS (
  SELECT l.l_orderkey AS orderid, o.o_custkey AS customerid, l.l_partkey AS productid,
         CAST(o.o_orderdate AS DATE) AS orderdate, l.l_quantity AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS orderamt, s.s_name AS salesrep
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
), au_customers AS (
  SELECT c_custkey AS customerid, c_name AS customername, c_mktsegment AS city, n_name AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey
), au_products AS (
  SELECT p_partkey AS productid, p_name AS productname FROM part
), au_opportunities AS (
  SELECT o_orderkey AS opportunityid, o_custkey AS customerid, o_orderstatus AS salesphase,
         o_orderpriority AS salesrep, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders
), history AS (
  SELECT o.*, c.customername, c.city, c.state AS customer_state, p.productname
  FROM au_orders o
  JOIN au_customers c ON o.customerid = c.customerid
  JOIN au_products p ON o.productid = p.productid
)
"""

_ORDER = "orderid, customerid, productid, orderdate, quantity, CAST(orderamt AS DOUBLE) AS orderamt, salesrep"
_SUM = "CAST(sum(orderamt) AS DOUBLE)"
_MEAN = "CAST(sum(orderamt) AS DOUBLE) / count(orderamt)"
_DATES = "orderdate BETWEEN DATE '1997-03-01' AND DATE '1998-08-31'"
_PRODUCTS = "productid IN (3, 7, 11, 13, 17, 19, 23, 42, 77, 101)"
_CELL = "salesrep = 'Supplier#000000007' AND customer_state = 'NATION_2'"


def _monthly(where: str = "TRUE") -> str:
    return f"""{_SALES}
    SELECT CAST(date_trunc('month', orderdate) AS DATE) AS order_month,
           {_SUM} AS total_sales_value, count(*) AS count_of_sales_orders
    FROM history WHERE {where} GROUP BY 1"""


def _page(where: str = "TRUE") -> str:
    figures = f"""{_SUM} AS amount, {_MEAN} AS average_amount, sum(quantity) AS quantity,
                  count(*) AS orders"""
    return f"""{_SALES}, shown AS (SELECT * FROM history WHERE {where})
    SELECT 'Order History' AS chart,
           CAST(CAST(date_trunc('month', orderdate) AS DATE) AS VARCHAR) AS label,
           CAST(NULL AS VARCHAR) AS second_label, {figures}
    FROM shown GROUP BY 2
    UNION ALL
    SELECT 'Average Order Amount per Product', productname, NULL, {figures}
    FROM shown GROUP BY productname
    UNION ALL
    SELECT 'Revenue Share by State', customer_state, NULL, {figures}
    FROM shown GROUP BY customer_state
    UNION ALL
    SELECT 'Distribution of Order Quantity across States and Sales Reps', salesrep,
           customer_state, {figures}
    FROM shown GROUP BY salesrep, customer_state"""


_MONTH = "date_trunc('month', orderdate) = DATE '1997-05-01'"
_SLICE = "customer_state = 'NATION_3'"


def _clicked_page(dates: str) -> str:
    """The page with a bar and a slice clicked: each chart heeds the marks of the others."""
    figures = f"""{_SUM} AS amount, {_MEAN} AS average_amount, sum(quantity) AS quantity,
                  count(*) AS orders"""
    whole = "CAST(NULL AS DOUBLE) AS share"
    return f"""{_SALES}, shown AS (SELECT * FROM history WHERE {dates}),
    states AS (SELECT customer_state, {figures} FROM shown WHERE {_MONTH} GROUP BY 1)
    SELECT 'Order History' AS chart,
           CAST(CAST(date_trunc('month', orderdate) AS DATE) AS VARCHAR) AS label,
           CAST(NULL AS VARCHAR) AS second_label, {figures}, {whole}
    FROM shown WHERE {_SLICE} GROUP BY 2
    UNION ALL
    SELECT 'Average Order Amount per Product', productname, NULL, {figures}, {whole}
    FROM shown WHERE {_SLICE} AND {_MONTH} GROUP BY productname
    UNION ALL
    SELECT 'Revenue Share by State', customer_state, NULL, amount, average_amount, quantity,
           orders, amount / sum(amount) OVER () AS share
    FROM states
    UNION ALL
    SELECT 'Distribution of Order Quantity across States and Sales Reps', salesrep,
           customer_state, {figures}, {whole}
    FROM shown WHERE {_SLICE} AND {_MONTH} GROUP BY salesrep, customer_state"""


_KEY_CHECK = """
  SELECT '{child}.{key}' AS relation,
    (SELECT count(*) FROM {table} WHERE {key} IN (SELECT {key} FROM {parent})) AS matched_rows,
    (SELECT count(*) FROM {table} x
      WHERE NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{key} = x.{key})) AS orphan_rows,
    (SELECT count(*) FROM
      (SELECT {key} FROM {parent} GROUP BY {key} HAVING count(*) > 1)) AS duplicated_parent_keys,
    (SELECT count(DISTINCT {key}) FROM {parent}
      WHERE {key} NOT IN (SELECT {key} FROM {table})) AS unused_parent_keys
"""

# ---- the message feed ---------------------------------------------------------------

_FEED = """
WITH copies AS (
  SELECT *, 0 AS copy FROM events
  UNION ALL
  SELECT *, 1000000000 AS copy FROM events WHERE event_id % 10 = 0
), feed AS (
  SELECT CAST(user_id AS VARCHAR) AS "key",
         CASE WHEN event_type IN ('click', 'view', 'error') THEN 'bpm'
              WHEN event_type = 'purchase' THEN 'workout' ELSE 'user_info' END AS topic,
         CAST(0 AS BIGINT) AS "partition", CAST(event_id + copy AS BIGINT) AS "offset",
         CAST(epoch(date_trunc('second', ts)) AS BIGINT) * 1000 AS "timestamp",
         CAST(user_id + 101950 AS INTEGER) AS device_id,
         CAST(epoch(date_trunc('second', ts)) AS DOUBLE) AS "time",
         value AS heartrate, date_trunc('second', ts) AS read_at
  FROM copies
), bpm AS (
  SELECT device_id, read_at AS "timestamp", heartrate FROM feed WHERE topic = 'bpm'
)
"""

_READABLE = f"""{_FEED}
SELECT "key", topic, "partition", "offset", "timestamp", device_id, "time", heartrate FROM feed"""
_PARSED = f"""{_FEED} SELECT device_id, "time", heartrate FROM feed WHERE topic = 'bpm'"""
_SILVER = f"""{_FEED}
SELECT device_id, "timestamp", min(heartrate) AS heartrate FROM bpm
WHERE device_id >= 102000 GROUP BY device_id, "timestamp" """
_TOPICS = f"{_FEED} SELECT DISTINCT topic FROM feed"
_DUPLICATES = f"""{_FEED}
SELECT device_id, "timestamp" AS "time", count(*) AS "count" FROM bpm
GROUP BY device_id, "timestamp" HAVING count(*) > 1 ORDER BY "count" DESC, device_id, "time" """
_AVERAGE = f"""{_FEED}
SELECT device_id,
       CAST(sum(CAST(heartrate AS DECIMAL(18,2))) AS DOUBLE) / count(heartrate) AS avg_heartrate
FROM bpm GROUP BY device_id"""
_CURSOR = '"timestamp", topic, "partition", "offset"'
_PRODUCTS_TABLE = "SELECT p_partkey AS productid, p_name AS productname FROM part"

_ARRIVALS = f"""{_FEED}, arrived AS (
  SELECT device_id, read_at AS "timestamp", heartrate, topic,
         least(CAST(floor(4.0 * ("timestamp" - (SELECT min("timestamp") FROM feed))
               / (SELECT max("timestamp") - min("timestamp") + 1 FROM feed)) AS BIGINT)
               + CASE WHEN "offset" % 3 = 0 THEN 1 ELSE 0 END, 3) AS batch
  FROM feed
), landed AS (SELECT * FROM arrived WHERE topic = 'bpm'),
steps AS (
  SELECT batch, max("timestamp") AS newest,
         max(max("timestamp")) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           - INTERVAL 2 DAY AS mark
  FROM landed GROUP BY batch
), judged AS (
  SELECT l.*, coalesce(l."timestamp" <= mark, FALSE) AS late,
         NOT coalesce(l."timestamp" <= mark, FALSE) AND device_id < 102000 AS dropped
  FROM landed l JOIN steps USING (batch)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY device_id, "timestamp" ORDER BY batch, heartrate) AS place
  FROM judged WHERE NOT late AND NOT dropped
)
"""

_ALL_TOPICS = f"""{_FEED}
SELECT topic, device_id, read_at AS "timestamp", min(heartrate) AS heartrate
FROM feed WHERE topic <> 'bpm' OR device_id >= 102000
GROUP BY topic, device_id, read_at"""

_KEY_COLUMNS = {
    "orders": {"orderid": "number", "customerid": "number", "productid": "number", "salesrep": "text"},
    "customers": {"customerid": "number", "customername": "text", "city": "text", "state": "text"},
    "products": {"productid": "number", "productname": "text"},
    "opportunities": {
        "opportunityid": "number", "customerid": "number", "salesphase": "text", "salesrep": "text"
    },
}


def _connections(tables: list[str], least: float, where: dict[str, str]) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{t}' AS t, '{c}' AS c, '{kind}' AS kind, CAST({c} AS VARCHAR) AS v "
        f"FROM au_{t} WHERE {where.get(t, 'TRUE')}"
        for t in tables
        for c, kind in _KEY_COLUMNS[t].items()
    )
    return f"""{_SALES}, cells AS ({cells}),
        counted AS (SELECT t, c, kind, v, count(*) AS n FROM cells WHERE v IS NOT NULL GROUP BY ALL),
        whole AS (SELECT t, c, count(*) AS vals, sum(n) AS n, max(n) AS most FROM counted GROUP BY ALL),
        shared AS (
          SELECT a.t, a.c, b.t AS pt, b.c AS pc, count(*) AS vals, sum(a.n) AS n
          FROM counted a JOIN counted b ON a.kind = b.kind AND a.v = b.v AND (a.t, a.c) <> (b.t, b.c)
          GROUP BY ALL)
        SELECT s.t AS child_table, s.c AS child_column, pt AS parent_table, pc AS parent_column,
               child.vals AS child_values, parent.vals AS parent_values, s.vals AS matched_values,
               CAST(child.n - s.n AS BIGINT) AS orphan_rows
        FROM shared s JOIN whole child ON s.t = child.t AND s.c = child.c
        JOIN whole parent ON s.pt = parent.t AND s.pc = parent.c
        WHERE parent.most = 1 AND s.vals >= {least} * child.vals"""


ORACLES: dict[str, str] = {
    # sources
    "scan_json_inferred": _READABLE.replace('SELECT "key",', 'SELECT base64(encode("key")) AS "key",'),
    "scan_json_envelope": _READABLE,
    "sql_on_files": f"{_FEED} SELECT topic, count(*) AS messages FROM feed GROUP BY topic",
    "scan_table": f"{_SALES} SELECT * FROM au_customers",
    "stream_bronze": _READABLE,
    "stream_bpm_bronze": _PARSED,
    "raw_preview_parsed": f"{_FEED} SELECT least(20, count(*)) AS lines, least(20, count(*)) AS in_feed FROM feed",
    "find_duplicates_sql": _DUPLICATES,
    # sinks
    "save_overwrite": _PRODUCTS_TABLE,
    "save_error_if_exists": "SELECT p_partkey AS productid, p_name AS productname, "
    "'TABLE_OR_VIEW_ALREADY_EXISTS' AS second_save FROM part",
    "save_append": f"{_PRODUCTS_TABLE} UNION ALL {_PRODUCTS_TABLE}",
    "json_round_trip": _READABLE,
    "copy_table": f"""{_SALES}
        SELECT opportunityid, customerid, salesphase, salesrep, CAST(amount AS DOUBLE) AS amount
        FROM au_opportunities""",
    "refresh_dataset": f"""{_FEED}
        SELECT topic, count(*) AS messages, max("timestamp") AS newest FROM feed GROUP BY topic""",
    "refresh_figures": f"""{_FEED}
        SELECT topic, count(*) AS messages, max("timestamp") AS newest,
               CAST(sum(CAST(heartrate AS DECIMAL(18,2))) AS DOUBLE) / count(heartrate) AS avg_heartrate
        FROM feed GROUP BY topic""",
    # cleaning
    "envelope_columns": f"""{_FEED}
        SELECT "key", topic, "partition", "offset", "timestamp" FROM feed""",
    "demux_bpm": _PARSED,
    "demux_topic": f"""{_FEED}
        SELECT device_id, read_at AS "timestamp", min(heartrate) AS heartrate
        FROM feed WHERE topic = 'workout' GROUP BY device_id, read_at""",
    "payload_topics": _ALL_TOPICS,
    "payload_fields": f"""{_FEED}
        SELECT field, count(*) AS "rows", count(v) AS "values", CAST(0 AS BIGINT) AS other
        FROM (SELECT 'device_id' AS field, CAST(device_id AS DOUBLE) AS v FROM feed WHERE topic = 'user_info'
              UNION ALL SELECT 'time', "time" FROM feed WHERE topic = 'user_info'
              UNION ALL SELECT 'heartrate', heartrate FROM feed WHERE topic = 'user_info')
        GROUP BY field""",
    "bpm_parsed": f"""{_FEED} SELECT device_id, "timestamp" AS "time", heartrate FROM bpm""",
    "bpm_parsed_float": f"""{_FEED}
        SELECT device_id, make_timestamp(CAST(CAST("time" AS FLOAT) AS BIGINT) * 1000000) AS "timestamp",
               count(*) AS readings
        FROM feed WHERE topic = 'bpm' GROUP BY 1, 2""",
    "bpm_silver": _SILVER,
    "dedup_deterministic": f"""{_FEED}
        SELECT device_id, "timestamp", heartrate, "day" FROM (
          SELECT *, row_number() OVER (PARTITION BY device_id, "day"
                                       ORDER BY heartrate, "timestamp") AS place
          FROM (SELECT *, CAST("timestamp" AS DATE) AS "day" FROM bpm))
        WHERE place = 1""",
    "distinct_topics": _TOPICS,
    "distinct_topics_saved": _TOPICS,
    "find_duplicates": _DUPLICATES,
    "test_devices": f"{_FEED} SELECT * FROM bpm WHERE device_id < 102000",
    "quality_drop": f"{_FEED} SELECT * FROM bpm WHERE device_id >= 102000",
    "quality_report": f"""{_FEED}
        SELECT count(*) AS rows_checked,
               count(*) FILTER (WHERE NOT device_id >= 102000) AS failed_valid_id,
               count(*) FILTER (WHERE NOT device_id >= 102000) AS rows_dropped
        FROM bpm""",
    "message_report": f"""{_FEED}
        SELECT topic, count(*) AS messages, CAST(0 AS BIGINT) AS undecodable
        FROM feed GROUP BY topic""",
    "avg_bpm_batch": _AVERAGE,
    "parse_props": "SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events",
    "normalise_identifier": """
        SELECT c_custkey AS customerid,
               regexp_replace(lower(split_part(c_name || '@' || c_mktsegment, '@', 1)),
                              '[^\\p{L}\\p{N}]', '_', 'g') AS identifier
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    # landing
    "high_water_mark": f"""{_FEED} SELECT max("timestamp") AS "timestamp" FROM feed""",
    "row_count": f'{_FEED} SELECT count(*) AS "rows" FROM feed',
    "next_batch": f"{_FEED} SELECT {_CURSOR} FROM feed ORDER BY {_CURSOR} LIMIT 1000 OFFSET 1000",
    "landing_replay": _READABLE,
    # streaming
    "stream_silver": _SILVER,
    "stream_silver_rule_before": _SILVER,
    "stream_silver_rule_at_watermark": _SILVER,
    "stream_topics": _ALL_TOPICS,
    "stream_payload_topics": _ALL_TOPICS,
    "stream_incremental_rerun": _SILVER,
    "stream_late_report": f"""{_ARRIVALS},
        kept AS (SELECT batch, count(*) AS kept FROM ranked WHERE place = 1 GROUP BY batch)
        SELECT batch, count(*) AS landed, count(*) FILTER (WHERE late) AS late,
               count(*) FILTER (WHERE dropped) AS dropped,
               count(*) FILTER (WHERE NOT late AND NOT dropped) - any_value(coalesce(kept, 0)) AS duplicates,
               any_value(coalesce(kept, 0)) AS kept, max("timestamp") AS newest
        FROM judged LEFT JOIN kept USING (batch) GROUP BY batch""",
    "stream_late_rows": f"""{_ARRIVALS}
        SELECT 'kept' AS fate, device_id, "timestamp", heartrate, batch FROM ranked WHERE place = 1
        UNION ALL
        SELECT 'late', device_id, "timestamp", heartrate, batch FROM judged WHERE late""",
    "stream_rule_positions": f"""{_FEED}, landed AS (
          SELECT *, device_id < 102000 AS fails,
                 greatest(CAST(floor(4.0 * ("timestamp" - (SELECT min("timestamp") FROM feed))
                          / (SELECT max("timestamp") - min("timestamp") + 1 FROM feed)) AS BIGINT)
                          - CASE WHEN device_id < 102000 THEN 1 ELSE 0 END, 0) AS batch
          FROM feed WHERE topic = 'bpm'
        ), steps AS (
          SELECT batch,
                 max(max(read_at)) OVER earlier - INTERVAL 2 DAY AS mark,
                 max(max(read_at) FILTER (WHERE NOT fails)) OVER earlier - INTERVAL 2 DAY AS good_mark
          FROM landed GROUP BY batch
          WINDOW earlier AS (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), judged AS (
          SELECT l.*, coalesce(read_at <= mark, FALSE) AS late,
                 coalesce(read_at <= good_mark, FALSE) AS late_before
          FROM landed l JOIN steps USING (batch)
        ), figures AS (
          SELECT count(DISTINCT (device_id, read_at)) FILTER (WHERE NOT late AND NOT fails) AS kept,
                 max(read_at) FILTER (WHERE NOT late AND NOT fails) AS newest,
                 count(DISTINCT (device_id, read_at)) FILTER (WHERE NOT late AND fails) AS dropped_keys,
                 count(DISTINCT (device_id, read_at)) FILTER (WHERE NOT late_before AND NOT fails) AS kept_before,
                 max(read_at) FILTER (WHERE NOT late_before AND NOT fails) AS newest_before,
                 count(*) FILTER (WHERE fails) AS failed
          FROM judged)
        SELECT 'after' AS "position", kept, dropped_keys AS dropped, newest FROM figures
        UNION ALL SELECT 'before', kept_before, failed, newest_before FROM figures
        UNION ALL SELECT 'at_watermark', kept, failed, newest FROM figures""",
    "stream_continuous_restart": _READABLE,
    "landed_not_ingested": f"""{_FEED}, ends AS (
          SELECT (min("timestamp") + max("timestamp")) // 2 AS middle FROM feed)
        SELECT CASE WHEN "timestamp" < middle THEN 'ingested' ELSE 'pending' END AS status,
               count(*) AS messages
        FROM feed, ends GROUP BY 1""",
    "avg_bpm_stream": _AVERAGE,
    # sales
    "order_history": f"""{_SALES}
        SELECT {_ORDER}, customername, customer_state, productname FROM history""",
    "order_history_with_city": f"""{_SALES}
        SELECT {_ORDER}, customername, city, customer_state, productname FROM history""",
    "opportunity_history": f"""{_SALES}
        SELECT o.opportunityid, o.customerid, o.salesphase, o.salesrep,
               CAST(o.amount AS DOUBLE) AS amount, c.customername, c.state AS customer_state
        FROM au_opportunities o JOIN au_customers c ON o.customerid = c.customerid""",
    "key_check": _SALES
    + " UNION ALL ".join(
        _KEY_CHECK.format(child=child, key=key, table=f"au_{child}", parent=f"au_{parent}")
        for child, key, parent in [
            ("orders", "customerid", "customers"),
            ("orders", "productid", "products"),
            ("opportunities", "customerid", "customers"),
        ]
    ),
    "find_connections": _connections(list(_KEY_COLUMNS), 1.0, {}),
    "find_connections_with_orphans": _connections(
        ["customers", "opportunities"], 0.8, {"customers": "customerid % 10 <> 0"}
    ),
    "browse_pages": f"""{_SALES}, shown AS (
          SELECT *, row_number() OVER (ORDER BY orderdate DESC NULLS LAST, orderid, customerid,
                    productid, quantity, orderamt, salesrep, customername, customer_state,
                    productname) - 1 AS place
          FROM history)
        SELECT CAST(place // 1000 AS INTEGER) AS page, orderdate, quantity,
               CAST(orderamt AS DOUBLE) AS orderamt, salesrep, customername, customer_state, productname
        FROM shown WHERE place < 5000""",
    "sales_vs_goal": f"""{_SALES}
        SELECT {_SUM} AS Total_Sales, 390000000 AS Sales_Goal,
               sum(orderamt) <= 390000000 AS at_or_below_goal
        FROM au_orders WHERE orderdate BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'""",
    "monthly_orders": _monthly(),
    "avg_amount_by_product": f"""{_SALES}
        SELECT productname, {_MEAN} AS average_order_amount FROM history GROUP BY productname""",
    "avg_amount_by_product_id": f"""{_SALES}
        SELECT productid, productname, {_MEAN} AS average_order_amount
        FROM history GROUP BY productid, productname""",
    "sum_amount_by_product": f"""{_SALES}
        SELECT productname, {_SUM} AS order_amount FROM history GROUP BY productname""",
    "revenue_share_by_state": f"""{_SALES}
        SELECT customer_state AS state, {_SUM} AS revenue,
               {_SUM} / (SELECT {_SUM} FROM history) AS share
        FROM history GROUP BY customer_state""",
    "order_share_by_state": f"""{_SALES}
        SELECT customer_state AS state, count(*) AS orders,
               CAST(count(*) AS DOUBLE) / (SELECT CAST(count(*) AS DOUBLE) FROM history) AS share
        FROM history GROUP BY customer_state""",
    "quantity_by_rep_state": f"""{_SALES}
        SELECT salesrep AS rep, customer_state AS state, sum(quantity) AS qty
        FROM history GROUP BY salesrep, customer_state""",
    "browse_orders": f"""{_SALES}
        SELECT orderdate, quantity, CAST(orderamt AS DOUBLE) AS orderamt, salesrep,
               customername, customer_state, productname
        FROM history""",
    "preview_orders": f"""{_SALES}
        SELECT {_ORDER} FROM au_orders
        ORDER BY orderid, customerid, productid, orderdate, quantity, orderamt, salesrep LIMIT 10""",
    "filter_date_range": _monthly(_DATES),
    "filter_products": _monthly(_PRODUCTS),
    "cross_filter_rep_state": _monthly(_CELL),
    "filter_scope": f"""{_SALES}
        SELECT 'Sales Goal' AS widget, {_SUM} AS amount FROM au_orders
        WHERE orderdate BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
        UNION ALL
        SELECT 'Browse', {_SUM} FROM history WHERE {_PRODUCTS}""",
    "dashboard_filtered": _page(f"{_DATES} AND {_PRODUCTS}"),
    "dashboard_unfiltered": _page(),
    "dashboard_clicked": _clicked_page(_DATES),
    "stream_run_report": f"""{_FEED},
        keys AS (SELECT DISTINCT device_id, "timestamp" FROM bpm)
        SELECT (SELECT count(*) FROM feed) AS landed,
               count(*) FILTER (WHERE device_id >= 102000) AS kept,
               count(*) FILTER (WHERE device_id < 102000) AS dropped
        FROM keys""",
    "opportunities_by_phase": f"""{_SALES}
        SELECT salesphase, count(*) AS opportunities FROM au_opportunities GROUP BY salesphase""",
    "opportunities_by_rep": f"""{_SALES}
        SELECT salesrep, count(*) AS opportunities FROM au_opportunities GROUP BY salesrep""",
    "customers_in_state": f"""{_SALES}
        SELECT count(*) AS customers FROM au_customers WHERE state = 'NATION_2'""",
    "list_customers_in_state": f"""{_SALES}
        SELECT * FROM au_customers WHERE state = 'NATION_2' ORDER BY customername, customerid""",
    "unknown_state_is_empty": f"""{_SALES}
        SELECT * FROM au_customers WHERE state = 'Nation Nowhere'""",
    "revenue_by_rep_in_state": f"""{_SALES}
        SELECT salesrep, {_SUM} AS revenue
        FROM au_orders o JOIN au_customers c ON o.customerid = c.customerid
        WHERE state = 'NATION_2' GROUP BY salesrep""",
    "top_rep_in_state": f"""{_SALES}
        SELECT salesrep, {_SUM} AS revenue
        FROM au_orders o JOIN au_customers c ON o.customerid = c.customerid
        WHERE state = 'NATION_2' GROUP BY salesrep
        ORDER BY sum(orderamt) DESC, salesrep LIMIT 1""",
}
