"""The registered queries as plain SQL over the same tables, to compare results with.

Written from the meaning of each report, not from the way the package computes it: facts and
dashboards use the literal joins, newest rows use ``row_number``.
"""

from __future__ import annotations

# Shared building blocks ----------------------------------------------------------------------

ORDERS = """
orders_v AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS pedido_em,
         CAST(o_totalprice AS DECIMAL(12,2)) AS valor, o_orderstatus AS status
  FROM orders)"""

EVENT_ORDERS = """
events_v AS (
  SELECT event_id AS order_id, user_id AS customer_id, ts AS pedido_em,
         CAST(value AS DECIMAL(12,2)) AS valor, event_type AS status
  FROM events)"""

RAW = """
raw AS (
  SELECT 'P' || p_partkey AS product_id, p_name AS product_name, p_type AS category,
         l_extendedprice * (1 - l_discount) AS discounted_price,
         l_extendedprice AS actual_price, l_discount * 100 AS discount_percentage,
         1 + l_quantity % 5 AS rating, l_linenumber AS rating_count,
         p_brand || ' ' || p_name AS about_product,
         'U' || c_custkey AS user_id, c_name AS user_name,
         o_orderkey || '-' || p_partkey || '-' || l_linenumber AS review_id,
         'about ' || p_name AS review_title, o_orderpriority AS review_content,
         'https://img.example/' || p_partkey AS img_link,
         'https://shop.example/' || p_partkey AS product_link
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey)"""

TEXT = f"""{RAW},
sheet AS (
  SELECT * REPLACE (
    'R$ ' || CAST(CAST(actual_price AS DECIMAL(12,2)) AS VARCHAR) AS actual_price,
    CASE WHEN rating_count > 3
         THEN replace(CAST(CAST(rating AS DECIMAL(3,1)) AS VARCHAR), '.', ',')
         ELSE CAST(CAST(rating AS DECIMAL(3,1)) AS VARCHAR) END AS rating,
    CAST(rating_count AS VARCHAR) AS rating_count)
  FROM raw)"""


def _staged(keys: str) -> str:
    return f"""{RAW},
numbered AS (
  SELECT *, row_number() OVER (
    PARTITION BY {keys}
    ORDER BY rating_count DESC, review_id DESC, product_id DESC, product_name DESC,
             category DESC, discounted_price DESC, actual_price DESC, discount_percentage DESC,
             rating DESC, about_product DESC, user_id DESC, user_name DESC) AS n
  FROM raw),
stg AS MATERIALIZED (SELECT * EXCLUDE (n) FROM numbered WHERE n = 1)"""


STAR = """,
dim_product AS MATERIALIZED (
  SELECT DISTINCT product_id, product_name, category, about_product, img_link, product_link
  FROM stg),
dim_user AS MATERIALIZED (SELECT DISTINCT user_id, user_name FROM stg),
dim_rating AS MATERIALIZED (
  SELECT user_id, product_id, CAST(rating AS DECIMAL(3,2)) AS rating,
         CAST(rating_count AS BIGINT) AS rating_count
  FROM stg),
fact_product_rating AS MATERIALIZED (
  SELECT product_id, dim_product.product_name,
         AVG(CAST(dim_rating.rating AS DOUBLE)) AS avg_rating
  FROM stg JOIN dim_product USING (product_id) JOIN dim_rating USING (product_id)
  WHERE dim_rating.rating IS NOT NULL
  GROUP BY ALL),
fact_sales_category AS MATERIALIZED (
  SELECT user_id, dim_product.category, SUM(CAST(actual_price AS DECIMAL(10,2))) AS sales_amount
  FROM stg JOIN dim_product USING (product_id) JOIN dim_user USING (user_id)
  GROUP BY ALL)"""

BY_PAIR = _staged("product_id, user_id") + STAR
BY_PRODUCT = _staged("product_id") + STAR

IMAGE = """
    k AS event_id, {time} AS event_timestamp, {type} AS event_type,
    'https://site.example/' || event_type AS page_url, '/' || event_type AS page_url_path,
    NULL::VARCHAR AS referer_url, NULL::VARCHAR AS referer_url_scheme,
    NULL::VARCHAR AS referer_url_port, NULL::VARCHAR AS referer_medium,
    NULL::VARCHAR AS utm_medium, CASE WHEN user_id % 3 = 0 THEN 'mail' END AS utm_source,
    NULL::VARCHAR AS utm_content, NULL::VARCHAR AS utm_campaign,
    CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS click_id,
    NULL::VARCHAR AS geo_latitude, NULL::VARCHAR AS geo_longitude,
    'C' || (user_id % 20) AS geo_country, NULL::VARCHAR AS geo_timezone,
    NULL::VARCHAR AS geo_region_name, '10.0.0.' || (user_id % 250) AS ip_address,
    'B' || (user_id % 5) AS browser_name, 'agent/' || user_id AS browser_user_agent,
    NULL::VARCHAR AS browser_language, NULL::VARCHAR AS os, NULL::VARCHAR AS os_name,
    NULL::VARCHAR AS os_timezone, NULL::VARCHAR AS device_type,
    user_id % 2 = 0 AS device_is_mobile, 'custom-' || user_id AS user_custom_id,
    'domain-' || user_id AS user_domain_id"""

_STRICT_TIME = "try_strptime(time_text, '%Y-%m-%d %H:%M:%S.%f')"
_ANY_TIME = f"""date_trunc('second', coalesce({_STRICT_TIME},
      try_strptime(time_text, '%Y-%m-%d %H:%M:%S')))"""
_SHOWN_TYPE = "CASE WHEN op = 'd' THEN 'was ' || event_type ELSE event_type END"

CHANGES = f"""
env AS (
  SELECT *, 'E' || (event_id // 4) AS k, epoch_us(ts) // 1000 AS ts_ms,
    CASE WHEN event_id % 4 = 0 THEN 'c'
         WHEN event_id % 4 = 3 AND user_id % 2 = 0 THEN 'd' ELSE 'u' END AS op,
    CASE WHEN event_id % 11 = 5 THEN 'not a time'
         WHEN event_id % 7 = 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS time_text
  FROM events),
flat AS (
  SELECT {IMAGE.format(time=_STRICT_TIME, type=_SHOWN_TYPE)}, op, ts_ms
  FROM env),
log AS (
  SELECT * EXCLUDE (ip_address, browser_name, browser_user_agent, browser_language, os, os_name,
                    device_type, device_is_mobile, user_custom_id)
  FROM flat),
live AS (
  SELECT event_id, event_timestamp, event_type, page_url, page_url_path, referer_url,
         referer_medium, utm_medium, utm_source, utm_campaign, geo_country, browser_name, os_name,
         device_type, device_is_mobile, user_custom_id, user_domain_id, op AS _op, ts_ms AS _ts_ms
  FROM (SELECT {IMAGE.format(time=_ANY_TIME, type="event_type")}, op, ts_ms FROM env)
  WHERE op <> 'd' AND event_id IS NOT NULL)"""


def _newest(source: str, version: str, order: str, where: str = "TRUE") -> str:
    return f"""
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY event_id ORDER BY {version} DESC, {order}) AS n
  FROM {source}) WHERE n = 1 AND {where}"""


_TIES = "event_timestamp DESC NULLS LAST, event_type DESC, page_url DESC, utm_source DESC NULLS LAST"
STATE = f"WITH {CHANGES}" + _newest("log", "ts_ms", _TIES, "op <> 'd'")
KEPT = f"WITH {CHANGES}" + _newest("(SELECT * FROM log WHERE op <> 'd')", "ts_ms", _TIES)
LOG = f"WITH {CHANGES} SELECT * FROM log"

HOURLY = f"""WITH {EVENT_ORDERS}
SELECT date_trunc('hour', pedido_em) AS hora, COUNT(*) AS pedidos, SUM(valor) AS receita
FROM events_v"""
HOURLY_ALL = f"{HOURLY} GROUP BY 1 ORDER BY 1"

_UPSERTED = f"""WITH {ORDERS}, {EVENT_ORDERS},
upserted AS (
  SELECT * FROM orders_v WHERE order_id NOT IN (SELECT order_id FROM events_v)
  UNION ALL SELECT * FROM events_v)"""

HISTORY = """
history AS (
  SELECT o_custkey AS customer_id,
         CAST(COUNT(*) FILTER (o_orderdate >= TIMESTAMP '2001-05-03') AS INTEGER)
           AS pedidos_ultimos_90d,
         CAST(COUNT(*) FILTER (o_orderpriority = '1-URGENT') AS INTEGER) AS chargebacks
  FROM orders GROUP BY 1)"""


# Quality report ------------------------------------------------------------------------------

# The rules of the five tables, as columns that exist, that are never NULL, that are
# unique, and that are text.
_RULES: dict[str, tuple[tuple[str, ...], ...]] = {
    "dim_user": (
        ("user_id", "user_name"),
        ("user_id", "user_name"),
        ("user_id",),
        ("user_id", "user_name"),
    ),
    "dim_product": (
        ("product_id", "product_name", "category", "about_product", "img_link", "product_link"),
        ("product_id", "product_name", "category", "img_link", "product_link"),
        ("product_id",),
        ("product_id", "product_name", "category", "about_product", "img_link", "product_link"),
    ),
    "dim_rating": (
        ("user_id", "product_id", "rating", "rating_count"),
        ("user_id", "product_id"),
        (),
        ("user_id", "product_id"),
    ),
    "fact_product_rating": (
        ("product_id", "product_name", "avg_rating"),
        ("product_id", "product_name", "avg_rating"),
        (),
        ("product_id", "product_name"),
    ),
    "fact_sales_category": (
        ("user_id", "category", "sales_amount"),
        ("user_id", "category", "sales_amount"),
        (),
        ("user_id", "category"),
    ),
}


def _quality_report() -> str:
    parts = []

    def rule(table: str, name: str, column: str, observed: str, passes: str) -> None:
        shown = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"SELECT '{table}' AS table_name, '{name}' AS rule, {shown} AS column_name,"
            f" round(o, 6) AS observed, o {passes} AS passed"
            f" FROM (SELECT CAST({observed} AS DOUBLE) AS o FROM {table})"
        )

    for table, (exist, filled, unique, text) in _RULES.items():
        for c in exist:
            rule(table, "ColumnExists", c, f"CASE WHEN COUNT({c}) >= 0 THEN 1 END", "= 1")
        for c in filled:
            rule(table, "NotNull", c, f"COUNT(*) - COUNT({c})", "= 0")
        for c in unique:
            rule(table, "UniqueProportion", c,
                 f"COUNT(DISTINCT {c}) / CAST(COUNT({c}) AS DOUBLE)", ">= 0.99")
        for c in text:
            rule(table, "OfType", c,
                 f"CASE WHEN typeof(any_value({c})) = 'VARCHAR' THEN 1 ELSE 0 END", "= 1")
        rule(table, "RowCount", "", "COUNT(*)", ">= 1")
    rule("fact_product_rating", "InRange", "avg_rating",
         "COUNT(*) FILTER (avg_rating NOT BETWEEN 0 AND 5)", "= 0")
    return f"WITH {BY_PAIR}\n" + "\nUNION ALL\n".join(parts)


def _row_counts(names: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{label}' AS table_name, COUNT(*) AS row_count FROM {name}"
        for label, name in (pair.split("=") for pair in names.split())
    )


# Outputs that are exact decimals; shown as doubles on both sides.
DECIMAL_OUTPUTS = {
    "receita": "hourly_revenue hourly_revenue_since hourly_revenue_by_day hourly_revenue_newest"
    " mv_incremental mv_state_merge mv_stream mv_signed_changes mv_out_of_order",
    "valor": "stg_upsert replica_snapshot replica_initial_load replica_chunked_copy table_overwrite table_bulk_load"
    " land_gzip",
    "rating": "dim_rating",
    "sales_amount": "fact_sales_category pipeline_star_sales",
    "total_sales": "dash_sales_rating dash_category_listing dash_category_top dash_total_sales",
}

# One text per registered query ----------------------------------------------------------------

_BY_OFFSET = """
SELECT 'E' || (event_id // 4) AS event_id, event_type, 'u' AS op, 0::BIGINT AS ts_ms, event_id AS "offset"
FROM (SELECT *, row_number() OVER (PARTITION BY event_id // 4 ORDER BY event_id DESC) AS n FROM events)
WHERE n = 1 AND event_id % 4 <> 0 AND NOT (event_id % 4 = 3 AND user_id % 2 = 0)
UNION ALL
SELECT 'E' || (event_id // 4), event_type, 'c', 0::BIGINT, event_id
FROM (SELECT *, row_number() OVER (PARTITION BY event_id // 4 ORDER BY event_id DESC) AS n FROM events)
WHERE n = 1 AND event_id % 4 = 0"""


def _lost_values() -> str:
    columns = (
        "product_id product_name category discounted_price actual_price discount_percentage rating"
        " rating_count about_product user_id user_name review_id review_title review_content"
        " img_link product_link"
    ).split()

    def lost(column: str) -> str:
        if column not in ("actual_price", "rating"):
            return "0 * COUNT(*)"
        return f"COUNT({column}) - COUNT(TRY_CAST({column} AS DOUBLE))"

    rows = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {lost(c)} AS lost FROM sheet" for c in columns
    )
    return f"WITH {TEXT}\n{rows}"


SQL: dict[str, str] = {
    "hourly_revenue": HOURLY_ALL,
    "hourly_revenue_since": f"""{HOURLY}
WHERE pedido_em >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1 ORDER BY 1""",
    "hourly_revenue_by_day": f"""{HOURLY}
WHERE pedido_em >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1 ORDER BY 1""",
    "hourly_revenue_newest": f"{HOURLY} GROUP BY 1 ORDER BY 1 DESC LIMIT 5",
    "contract_conform": f"""WITH {TEXT}
SELECT * REPLACE (TRY_CAST(actual_price AS DOUBLE) AS actual_price,
                  TRY_CAST(rating AS DOUBLE) AS rating,
                  TRY_CAST(rating_count AS INTEGER) AS rating_count) FROM sheet""",
    "contract_normalized": f"""WITH {TEXT}
SELECT * REPLACE (
  CAST(regexp_replace(actual_price, '[^0-9.]', '', 'g') AS DOUBLE) AS actual_price,
  CAST(replace(rating, ',', '.') AS DOUBLE) AS rating,
  CAST(replace(rating_count, ',', '') AS INTEGER) AS rating_count) FROM sheet""",
    "contract_lost_values": _lost_values(),
    "stg_dedup": f"WITH {_staged('product_id')} SELECT * FROM stg",
    "stg_duplicates": f"""WITH {RAW}
SELECT COUNT(*) AS rows, COUNT(DISTINCT (product_id, user_id)) AS distinct_keys,
       COUNT(*) - COUNT(DISTINCT (product_id, user_id)) AS duplicates FROM raw""",
    "stg_upsert": f"{_UPSERTED} SELECT * FROM upserted",
    "stg_upsert_repeated_target": """
SELECT l_orderkey AS order_id, coalesce(value, l_quantity) AS valor
FROM lineitem LEFT JOIN events ON event_id = l_orderkey
UNION ALL
SELECT event_id, value FROM events WHERE event_id NOT IN (SELECT l_orderkey FROM lineitem)""",
    "pipeline_star_sales": f"WITH {BY_PRODUCT} SELECT * FROM fact_sales_category",
    "cdc_equal_versions": _BY_OFFSET,
    "replica_equal_versions": _BY_OFFSET,
    "cdc_frame_strip": "SELECT event_id, event_type AS body FROM events",
    "cdc_two_consumers": f"""WITH {CHANGES}
SELECT event_id, op, ts_ms, consumer FROM flat, (VALUES (0), (1)) AS c(consumer)""",
    "mv_out_of_order": HOURLY_ALL,
    "mv_refresh_history": """
SELECT 'Success' AS status, kind AS refresh_type, true AS ended FROM (VALUES ('Manual'), ('Auto')) AS k(kind)""",
    "replica_full_load_orders": "SELECT * FROM orders",
    "stg_sales": f"WITH {_staged('product_id, user_id')} SELECT * FROM stg",
    "dim_product": f"WITH {BY_PAIR} SELECT * FROM dim_product",
    "dim_user": f"WITH {BY_PAIR} SELECT * FROM dim_user",
    "dim_rating": f"WITH {BY_PAIR} SELECT * FROM dim_rating",
    "fact_product_rating": f"""WITH {BY_PAIR}
SELECT product_id, product_name, round(avg_rating, 6) AS avg_rating FROM fact_product_rating""",
    "fact_sales_category": f"WITH {BY_PAIR} SELECT * FROM fact_sales_category",
    "pipeline_star": f"WITH {BY_PRODUCT}\n" + _row_counts(
        "stg_sales=stg dim_product=dim_product dim_user=dim_user dim_rating=dim_rating"
        " fact_product_rating=fact_product_rating fact_sales_category=fact_sales_category"
    ),
    "dash_rating_by_category": f"""WITH {BY_PAIR}
SELECT category, round(avg_rating, 6) AS avg_rating FROM (
  SELECT category, AVG(avg_rating) AS avg_rating
  FROM fact_product_rating JOIN dim_product USING (product_id)
  GROUP BY category ORDER BY 2 DESC, 1 LIMIT 10)""",
    "dash_sales_rating": f"""WITH {BY_PAIR}
SELECT category, round(AVG(rating), 2) AS avg_rating,
       SUM(coalesce(sales_amount, 10)) AS total_sales
FROM dim_product
LEFT JOIN dim_rating USING (product_id) LEFT JOIN fact_sales_category USING (category)
GROUP BY category ORDER BY 2, 3 DESC, 1 LIMIT 10""",
    "dash_rating_by_product": f"""WITH {BY_PAIR}
SELECT product_id, dim_product.product_name, round(avg_rating, 6) AS avg_rating
FROM fact_product_rating JOIN dim_product USING (product_id)
ORDER BY 3 DESC""",
    "dash_category_listing": f"""WITH {BY_PAIR}
SELECT category, total_sales FROM (
  SELECT category, product_name, SUM(coalesce(sales_amount, 10)) AS total_sales
  FROM fact_sales_category JOIN dim_product USING (category)
  GROUP BY ALL
  ORDER BY category, total_sales DESC, product_name LIMIT 10)""",
    "dash_category_top": f"""WITH {BY_PAIR}
SELECT category, total_sales FROM (
  SELECT category, product_name, SUM(coalesce(sales_amount, 10)) AS total_sales
  FROM fact_sales_category JOIN dim_product USING (category)
  GROUP BY ALL
  ORDER BY total_sales DESC, category, product_name LIMIT 10)""",
    "dash_total_sales": f"""WITH {BY_PAIR}
SELECT SUM(coalesce(sales_amount, 10)) AS total_sales FROM fact_sales_category""",
    "dash_sales_count": f"WITH {BY_PAIR} SELECT COUNT(*) AS total_sales FROM fact_sales_category",
    "dq_report": _quality_report(),
    "cdc_flatten": f"WITH {CHANGES} SELECT * FROM flat",
    "cdc_pii_drop": LOG,
    "cdc_insert_view": f"WITH {CHANGES} SELECT * FROM live",
    "cdc_latest_by_version": f"WITH {CHANGES}" + _newest("live", "_ts_ms", _TIES),
    "cdc_state_from_log": STATE,
    "cdc_stream_log": LOG,
    "cdc_stream_state": f"WITH {CHANGES}" + _newest("live", "_ts_ms", _TIES),
    "mv_incremental": HOURLY_ALL,
    "mv_state_merge": HOURLY_ALL,
    "mv_stream": HOURLY_ALL,
    "mv_signed_changes": f"""WITH {CHANGES},
signed AS (
  SELECT 'C' || (user_id % 20) AS geo_country, CAST(value AS DECIMAL(12,2)) AS valor,
         CASE op WHEN 'c' THEN 1 WHEN 'd' THEN -1 ELSE 0 END AS sign
  FROM env)
SELECT geo_country, CAST(SUM(sign) AS BIGINT) AS eventos, SUM(sign * valor) AS receita
FROM signed GROUP BY 1 HAVING SUM(sign) > 0""",
    "replica_mirror": STATE,
    "replica_mirror_keep_deleted": KEPT,
    "replica_mirror_stream": STATE,
    "replica_snapshot": f"""WITH {ORDERS}, {EVENT_ORDERS}
SELECT *, 'r' AS op, CAST(0 AS BIGINT) AS ts_ms FROM orders_v
WHERE order_id NOT IN (SELECT order_id FROM events_v)
UNION ALL
SELECT *, 'u' AS op, epoch_us(pedido_em) // 1000 AS ts_ms FROM events_v WHERE status <> 'error'""",
    "replica_full_load": _row_counts(
        "source.public.region=region source.public.customer=customer"
        " source.public.supplier=supplier source.public.part=part source.public.orders=orders"
        " source.public.lineitem=lineitem source.public.events=events"
    ),
    "freshness_lag": f"""WITH {EVENT_ORDERS}
SELECT COUNT(*) AS source_rows, COUNT(*) FILTER (status <> 'error') AS destination_rows,
       epoch_us(MAX(pedido_em)) - epoch_us(MAX(pedido_em) FILTER (status <> 'error'))
         AS lag_micros FROM events_v""",
    "federated_lookup": f"""WITH {HISTORY}
SELECT o.o_orderkey AS order_id, o.o_orderstatus AS status, o.o_orderdate AS updated_at,
       h.pedidos_ultimos_90d, h.chargebacks
FROM orders o LEFT JOIN history h ON h.customer_id = o.o_custkey WHERE o.o_orderkey = 902""",
    "federated_history": f"""WITH {HISTORY}
SELECT e.event_id AS order_id, e.event_type AS status, e.ts AS updated_at,
       h.pedidos_ultimos_90d, h.chargebacks
FROM events e LEFT JOIN history h ON h.customer_id = e.user_id""",
    "federated_recent": """
SELECT event_id AS order_id, event_type AS status, ts AS updated_at FROM events
WHERE ts > TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 15 MINUTE""",
    "share_proof": f"""{_UPSERTED}
SELECT COUNT(*) AS pedidos, MAX(pedido_em) AS ultimo_pedido FROM upserted""",
    "bounded_query": """
SELECT o_custkey, COUNT(*) AS pedidos, MAX(o_orderdate) AS ultimo FROM orders
GROUP BY o_custkey ORDER BY pedidos DESC, o_custkey LIMIT 100""",
    "table_overwrite": f"WITH {EVENT_ORDERS} SELECT * FROM events_v",
    "table_bulk_load": f"WITH {ORDERS} SELECT * FROM orders_v",
    "land_gzip": f"WITH {EVENT_ORDERS} SELECT * FROM events_v",
    "pipeline_gated": f"WITH {BY_PRODUCT} SELECT *, true AS blocked FROM (\n" + _row_counts(
        "dim_product=dim_product dim_user=dim_user dim_rating=dim_rating"
        " fact_product_rating=fact_product_rating fact_sales_category=fact_sales_category"
    ) + ")",
    "pipeline_rows": f"WITH {BY_PRODUCT} SELECT table_name AS step, row_count FROM (\n" + _row_counts(
        "raw=raw stg_sales=stg dim_product=dim_product dim_user=dim_user dim_rating=dim_rating"
        " fact_product_rating=fact_product_rating fact_sales_category=fact_sales_category"
    ) + ")",
    "dq_gate_failures": f"""WITH {BY_PAIR}
SELECT 'dim_user' AS table_name, 'NotNull' AS rule, 'user_id' AS column_name,
       CAST(COUNT(*) AS DOUBLE) AS observed, false AS passed
FROM dim_user WHERE user_id LIKE '%7'""",
    "dq_sketched_unique": "\nUNION ALL\n".join(
        f"SELECT '{shown}' AS column_name, COUNT(*) AS row_count, COUNT({column}) AS non_null,"
        f" COUNT(DISTINCT {column}) >= 0.99 * COUNT({column}) AS passed FROM events"
        for shown, column in (("order_id", "event_id"), ("customer_id", "user_id"), ("status", "event_type"))
    ),
    "cdc_log_replayed": LOG,
    "cdc_stream_until_stopped": f"SELECT *, true AS was_active FROM ({LOG})",
    "replica_chunked_copy": f"""WITH {ORDERS}, {EVENT_ORDERS},
changed AS (
  SELECT event_id // 4 AS order_id, user_id AS customer_id, ts AS pedido_em,
         CAST(value AS DECIMAL(12,2)) AS valor, event_type AS status,
         event_id % 4 = 3 AND user_id % 2 = 0 AS deleted,
         row_number() OVER (PARTITION BY event_id // 4 ORDER BY event_id DESC) AS n
  FROM events)
SELECT * FROM orders_v WHERE order_id NOT IN (SELECT order_id FROM changed)
UNION ALL
SELECT order_id, customer_id, pedido_em, valor, status FROM changed WHERE n = 1 AND NOT deleted""",
    "share_revoked": """
SELECT 'vendas' AS table_name, false AS visible, CAST(NULL AS BIGINT) AS row_count
UNION ALL SELECT 'eventos', true, COUNT(*) FROM events""",
    "table_schema_guard": """
SELECT fault, row_count FROM (SELECT COUNT(*) AS row_count FROM orders), (VALUES
  ('column valor is missing'), ('column extra is not in the table'),
  ('column order_id is number 2 instead of 1; column customer_id is number 1 instead of 2')) AS f(fault)""",
    "bounded_query_outcomes": """
SELECT name, outcome, CASE name WHEN 'whole' THEN n WHEN 'cut' THEN 5 END AS row_count,
       CASE name WHEN 'whole' THEN false WHEN 'cut' THEN true END AS truncated
FROM (SELECT COUNT(DISTINCT o_orderstatus) AS n FROM orders), (VALUES
  ('whole', 'rows'), ('cut', 'rows'), ('no such column', 'QueryFailed'), ('drop', 'QueryFailed'),
  ('computed path', 'QueryInputError'), ('reflection', 'QueryInputError'),
  ('too slow', 'QueryTimeout')) AS o(name, outcome)""",
}

SQL["replica_initial_load"] = SQL["replica_snapshot"]
SQL["federated_lookup_indexed"] = SQL["federated_lookup"]

for _column, _names in DECIMAL_OUTPUTS.items():
    for _name in _names.split():
        SQL[_name] = (
            f"SELECT * REPLACE (CAST({_column} AS DOUBLE) AS {_column}) FROM (\n{SQL[_name]}\n)"
        )
