"""The derived tables as SQL, written against the test tables."""

_ORDERS = """
delivery_orders AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey,
         'c' || o_custkey AS customer_id, 'r' || l_suppkey AS restaurant_id,
         o_orderdate + to_minutes(CAST((7 * l_orderkey + 61 * l_linenumber + 13 * l_partkey) % 1440 AS INTEGER)) AS order_ts,
         o_orderdate + to_minutes(CAST((7 * l_orderkey + 61 * l_linenumber + 13 * l_partkey) % 1440 AS INTEGER))
           + to_minutes(CAST(20 + (17 * l_partkey + 5 * l_suppkey) % 100 AS INTEGER)) AS delivery_ts,
         l_extendedprice AS order_value,
         (l_partkey % 6) * CAST(10 AS DOUBLE) AS delivery_fee,
         o_orderpriority AS payment_method,
         CASE WHEN l_discount = 0 THEN 'None'
              WHEN l_discount < 0.045 THEN CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%'
              WHEN l_discount < 0.075 THEN CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '% on App'
              WHEN l_discount < 0.085 THEN '50 off Promo'
              WHEN l_discount < 0.095 THEN NULL
              ELSE 'FREESHIP10' END AS discounts_and_offers,
         l_extendedprice * l_tax AS commission_fee,
         l_quantity AS payment_processing_fee,
         CASE WHEN l_returnflag = 'R' THEN (l_orderkey % 4) * CAST(50 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS refunds
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_MINUTES = "CAST(epoch(delivery_ts) - epoch(order_ts) AS DOUBLE) / 60"

_FINANCE = f"""
priced AS (
  SELECT *, {_MINUTES} AS delivery_minutes,
         CAST(CASE WHEN contains(discounts_and_offers, '%')
              THEN order_value * (CAST(split_part(discounts_and_offers, '%', 1) AS DOUBLE) / 100)
              WHEN contains(discounts_and_offers, 'off') THEN 50 ELSE 0 END AS DOUBLE) AS discount_value
  FROM delivery_orders
),
finance AS (
  SELECT *, delivery_fee + discount_value + payment_processing_fee + refunds AS total_cost,
         commission_fee - (delivery_fee + discount_value + payment_processing_fee + refunds) AS profit
  FROM priced
)"""

_REQUESTS = """
requests AS (
  SELECT event_id, 'e' || event_id AS "UUID", 'c' || user_id AS customer_id,
         'r' || (event_id % 40) AS restaurant_id,
         date_trunc('second', ts) AS order_date_and_time,
         value AS order_value, (event_id % 6) * CAST(1 AS DOUBLE) AS delivery_fee,
         CASE WHEN event_id % 50 <> 0 THEN event_type END AS payment_method,
         CASE event_id % 5 WHEN 1 THEN 'None' WHEN 2 THEN json_extract_string(props, '$.k') || '%'
              WHEN 3 THEN '50 off Promo' WHEN 4 THEN json_extract_string(props, '$.k') || '% on App' END
           AS discounts_and_offers,
         value * CAST(0.125 AS DOUBLE) AS commission_fee, CAST(0.5 AS DOUBLE) AS payment_processing_fee,
         CASE WHEN event_type = 'error' THEN value ELSE CAST(0 AS DOUBLE) END AS "refunds/chargebacks"
  FROM events
)"""

_RESPONSES = """
responses AS (
  SELECT 'e' || event_id AS "UUID", CAST(20 AS DOUBLE) + event_id % 60 AS prediction,
         date_trunc('second', ts) + to_seconds(CAST(event_id % 90 AS INTEGER)) AS resp_ts
  FROM events WHERE event_id % 7 <> 0
)"""

_RESENT = """
resent AS (
  SELECT *, 0 AS attempt FROM requests
  UNION ALL
  SELECT * REPLACE (order_date_and_time + to_minutes(10) AS order_date_and_time), 1 AS attempt
  FROM requests WHERE event_id % 10 = 0
)"""

_PARTS = {
    "orders": [_ORDERS],
    "finance": [_ORDERS, _FINANCE],
    "requests": [_REQUESTS],
    "responses": [_REQUESTS, _RESPONSES],
    "resent": [_REQUESTS, _RESENT],
    "resent_responses": [_REQUESTS, _RESENT, _RESPONSES],
}


def sql(views: str, body: str) -> str:
    """A full statement: the named derived tables, then the query over them."""
    return "WITH " + ",".join(_PARTS[views]).strip() + "\n" + body.strip()
