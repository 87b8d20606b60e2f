"""SQL for DuckDB that gives the expected rows of each registered query from the test tables."""

from __future__ import annotations

import re

# Shared steps, each in terms of the test tables and earlier steps.
STEPS: dict[str, str] = {
    "raw_weblogs": """
        SELECT event_id AS row_index,
          CASE WHEN event_id > 0 AND event_id % 33 = 0 THEN event_id % 200 ELSE event_id END AS log_id,
          CASE WHEN event_id % 20 = 7 THEN NULL WHEN event_id % 13 = 5 THEN 1000000 + user_id
               WHEN user_id <= 5 THEN 1 ELSE user_id END AS user_id,
          CASE WHEN event_id % 17 = 3 THEN 1000000 WHEN event_id % 41 = 6 THEN NULL
               ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS product_id,
          CASE WHEN event_id % 19 = 2 THEN NULL WHEN event_id % 19 = 11 THEN 'bad-session'
               WHEN user_id <= 5 THEN 'sess_1' WHEN event_id % 50 = 1 THEN 'sess_2'
               ELSE 'sess_' || CAST(1000 + user_id * 100 + day(ts) AS VARCHAR) END AS session_id,
          CASE event_type WHEN 'view' THEN ' View ' WHEN 'click' THEN 'Add_To_Cart'
               WHEN 'purchase' THEN 'PURCHASE' WHEN 'signup' THEN 'view' ELSE 'bogus' END AS action,
          CASE WHEN event_id % 23 = 4 THEN 'invalid_timestamp' ELSE CAST(ts AS VARCHAR) END AS ts_text
        FROM events""",
    "raw_users": """
        SELECT c_custkey * 2 AS row_index, c_custkey AS user_id,
          CASE WHEN c_custkey % 20 = 3 THEN NULL ELSE c_name END AS user_name,
          CASE WHEN c_custkey % 10 = 4 THEN 'invalid_email' WHEN c_custkey % 15 = 6 THEN 'shared@x.com'
               WHEN c_custkey % 50 = 11 THEN NULL
               ELSE 'u' || CAST(c_custkey AS VARCHAR) || '@x.com' END AS email,
          CASE WHEN c_custkey % 20 = 9 THEN 'invalid_date' ELSE CAST(CAST(
               DATE '2019-01-01' + CAST(c_custkey * 7 % 1825 AS INTEGER) AS DATE) AS VARCHAR) END
               AS signup_text
        FROM customer
        UNION ALL
        SELECT c_custkey * 2 + 1, c_custkey, c_name || ' v2',
          'u' || CAST(c_custkey AS VARCHAR) || '@x.com',
          CASE WHEN c_custkey % 74 = 0 THEN 'invalid_date' ELSE '2024-01-01' END
        FROM customer WHERE c_custkey % 37 = 0
        UNION ALL
        SELECT 1000000000 + c_custkey, NULL, c_name, 'n' || CAST(c_custkey AS VARCHAR) || '@x.com',
          '2024-01-01'
        FROM customer WHERE c_custkey % 100 = 50""",
    "raw_products": """
        SELECT p_partkey * 2 AS row_index, p_partkey AS product_id, p_name AS product_name,
          p_type AS category, CASE WHEN p_partkey % 10 = 6 THEN NULL ELSE p_retailprice END AS price
        FROM part
        UNION ALL
        SELECT p_partkey * 2 + 1, p_partkey, p_name || ' v2', p_type, p_retailprice * 2
        FROM part WHERE p_partkey % 50 = 0
        UNION ALL
        SELECT 1000000000 + p_partkey, NULL, p_name, p_type, p_retailprice
        FROM part WHERE p_partkey % 100 = 50""",
    "times": """
        SELECT event_id AS row_index, ts,
          CASE event_id // 500 % 7 WHEN 6 THEN event_id % 6 ELSE event_id // 500 % 6 END AS form,
          event_id % 11 <> 3 AS readable, event_id // 500 AS chunk FROM events""",
    "times_utc": """
        SELECT *, CASE WHEN readable THEN CASE form WHEN 3 THEN ts - INTERVAL 2 HOUR
            WHEN 4 THEN ts + INTERVAL 330 MINUTE WHEN 5 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
            ELSE ts END END AS utc,
          CASE form WHEN 2 THEN 24 WHEN 4 THEN 24 ELSE form END AS look FROM times""",
    "users_latest": """
        SELECT * FROM raw_users r WHERE user_id IS NULL OR row_index =
          (SELECT max(row_index) FROM raw_users o WHERE o.user_id = r.user_id)""",
    "users_judged": """
        SELECT *, TRY_CAST(signup_text AS DATE) AS signup_date,
          CASE WHEN user_id IS NULL THEN 'null user_id'
               WHEN TRY_CAST(signup_text AS DATE) IS NULL THEN 'invalid signup_date' END
               AS rejection_reason
        FROM users_latest""",
    "users_ok": """
        SELECT user_id, coalesce(user_name, 'unknown') AS user_name, email, signup_date,
          email IS NOT NULL AND row_number() OVER (PARTITION BY email ORDER BY row_index) > 1
            AS is_duplicate_email,
          NOT coalesce(regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$'), false)
            AS is_invalid_email,
          row_index
        FROM users_judged WHERE rejection_reason IS NULL""",
    "products_judged": """
        SELECT *, CASE WHEN product_id IS NULL THEN 'null product_id' END AS rejection_reason
        FROM raw_products r WHERE product_id IS NULL OR row_index =
          (SELECT max(row_index) FROM raw_products o WHERE o.product_id = r.product_id)""",
    "products_ok": """
        SELECT product_id, product_name, category, coalesce(price, 0.0) AS price, row_index
        FROM products_judged WHERE rejection_reason IS NULL""",
    "logs_typed": """
        SELECT *, TRY_CAST(ts_text AS TIMESTAMP) AS ts_value,
          log_id IS NOT NULL AND row_number() OVER (PARTITION BY log_id ORDER BY row_index) > 1
            AS is_repeat
        FROM raw_weblogs""",
    "logs_judged": """
        SELECT *, CASE
            WHEN user_id IS NULL THEN 'null user_id'
            WHEN is_repeat THEN 'duplicate log_id'
            WHEN user_id NOT IN (SELECT user_id FROM users_ok) THEN 'orphan user_id'
            WHEN product_id NOT IN (SELECT product_id FROM products_ok) THEN 'orphan product_id'
            WHEN session_id IS NULL OR NOT regexp_matches(session_id, '^sess_[0-9]+$')
              THEN 'invalid session_id'
            WHEN ts_value IS NULL THEN 'invalid timestamp' END AS rejection_reason
        FROM logs_typed""",
    "halves_judged": """
        SELECT log_id, CASE
            WHEN user_id IS NULL THEN 'null user_id'
            WHEN log_id IS NOT NULL AND row_number() OVER (PARTITION BY log_id,
              least(1, row_index * 2 // (SELECT count(*) FROM raw_weblogs)) ORDER BY row_index) > 1
              THEN 'duplicate log_id'
            WHEN user_id NOT IN (SELECT user_id FROM users_ok) THEN 'orphan user_id'
            WHEN product_id NOT IN (SELECT product_id FROM products_ok) THEN 'orphan product_id'
            WHEN session_id IS NULL OR NOT regexp_matches(session_id, '^sess_[0-9]+$')
              THEN 'invalid session_id'
            WHEN ts_value IS NULL THEN 'invalid timestamp' END AS rejection_reason
        FROM logs_typed""",
    "logs_ok": """
        SELECT log_id, user_id, product_id, session_id, action, ts_text, ts_value AS action_ts, row_index,
          CASE WHEN lower(trim(action)) IN ('view', 'add_to_cart', 'purchase')
               THEN lower(trim(action)) END AS act
        FROM logs_judged WHERE rejection_reason IS NULL""",
    "silver": """
        SELECT l.*, u.user_name, u.email, p.product_name, p.category, p.price
        FROM logs_ok l LEFT JOIN users_ok u ON l.user_id = u.user_id
          LEFT JOIN products_ok p ON l.product_id = p.product_id""",
    "log_arrivals": """
        SELECT *, least(2, row_index * 3 // (SELECT count(*) FROM raw_weblogs)) AS arrival FROM logs_ok""",
    "arrival_marks": """
        SELECT a.arrival, (SELECT max(b.action_ts) FROM log_arrivals b WHERE b.arrival < a.arrival)
          - INTERVAL 1 DAY AS mark FROM (SELECT DISTINCT arrival FROM log_arrivals) a""",
    "logs_in_time": """
        SELECT log_arrivals.* FROM log_arrivals JOIN arrival_marks USING (arrival)
        WHERE action_ts >= mark OR mark IS NULL""",
    "session_sums": """
        SELECT session_id, min(action_ts) AS session_start, max(action_ts) AS session_end,
          (epoch_us(max(action_ts)) - epoch_us(min(action_ts))) / 1000000.0 AS secs,
          CASE WHEN count(act) > 0 THEN count(*) FILTER (act = 'view') END AS views,
          CASE WHEN count(act) > 0 THEN count(*) FILTER (act = 'add_to_cart') END AS adds,
          CASE WHEN count(act) > 0 THEN count(*) FILTER (act = 'purchase') END AS buys
        FROM logs_ok GROUP BY session_id""",
    "sessions": """
        SELECT session_id, session_start, session_end,
          round(CAST(secs AS DOUBLE), 6) AS session_duration_s, views AS total_views,
          adds AS total_cart_adds, buys AS total_purchases, views + adds + buys AS total_actions,
          round(CAST(buys AS DOUBLE) / nullif(views, 0), 6) AS conversion_rate,
          coalesce(adds > 0 AND buys = 0, false) AS is_abandoned_cart,
          coalesce(views + adds + buys > 50, false) AS is_high_activity,
          coalesce(secs > (SELECT avg(secs) + 2 * stddev_samp(secs) FROM session_sums), false)
            AS is_long_session
        FROM session_sums""",
    "dim_u": """
        SELECT row_number() OVER (ORDER BY user_id) AS user_sk, user_id, user_name, email,
          signup_date, TIMESTAMP '2024-02-01 03:00:00' AS dw_created_at,
          TIMESTAMP '2024-02-01 03:00:00' AS dw_updated_at
        FROM users_ok""",
    "dim_p": """
        SELECT row_number() OVER (ORDER BY product_id) AS product_sk, product_id, product_name,
          category, price, TIMESTAMP '2024-02-01 03:00:00' AS dw_created_at
        FROM products_ok""",
    "fact": """
        SELECT l.log_id, u.user_sk, p.product_sk, l.session_id, l.act AS action, l.action_ts,
          'run-0001' AS etl_run_id, DATE '2024-02-01' AS etl_run_date
        FROM logs_ok l JOIN dim_u u ON l.user_id = u.user_id
          JOIN dim_p p ON l.product_id = p.product_id""",
    "broken": """
        SELECT l.log_id, u.user_sk, p.product_sk
        FROM raw_weblogs l LEFT JOIN dim_u u ON l.user_id = u.user_id
          LEFT JOIN dim_p p ON l.product_id = p.product_id""",
    "agg": """
        SELECT l.session_id, u.user_sk, min(l.action_ts) AS session_start,
          max(l.action_ts) AS session_end,
          CAST(date_diff('second', min(l.action_ts), max(l.action_ts)) AS DOUBLE)
            AS session_duration_s,
          count(*) AS total_actions, count(*) FILTER (act = 'view') AS total_views,
          count(*) FILTER (act = 'add_to_cart') AS total_cart_adds,
          count(*) FILTER (act = 'purchase') AS total_purchases,
          round(CAST(count(*) FILTER (act = 'purchase') AS DOUBLE)
            / nullif(count(*) FILTER (act = 'view'), 0), 6) AS conversion_rate,
          count(*) FILTER (act = 'add_to_cart') > 0 AND count(*) FILTER (act = 'purchase') = 0
            AS is_abandoned_cart,
          count(*) > 50 AS is_high_activity, DATE '2024-02-01' AS etl_run_date
        FROM logs_ok l JOIN dim_u u ON l.user_id = u.user_id
        GROUP BY l.session_id, u.user_sk""",
    "early": "SELECT * FROM logs_ok WHERE action_ts < TIMESTAMP '2024-01-15 00:00:00'",
    "reasons": """
        SELECT 'users' AS source, rejection_reason FROM users_judged
        UNION ALL SELECT 'products', rejection_reason FROM products_judged
        UNION ALL SELECT 'weblogs', rejection_reason FROM logs_judged""",
    "extracted": """
        SELECT 'users' AS source, count(*) AS n FROM raw_users
        UNION ALL SELECT 'products', count(*) FROM raw_products
        UNION ALL SELECT 'weblogs', count(*) FROM raw_weblogs""",
    "loads": """
        SELECT 'bronze' AS layer, 'users' AS name, count(*) AS n FROM users_ok
        UNION ALL SELECT 'bronze', 'products', count(*) FROM products_ok
        UNION ALL SELECT 'bronze', 'weblogs', count(*) FROM logs_ok
        UNION ALL SELECT 'silver', 'users_clean', count(*) FROM users_ok
        UNION ALL SELECT 'silver', 'products_clean', count(*) FROM products_ok
        UNION ALL SELECT 'silver', 'weblogs_clean', count(*) FROM logs_ok
        UNION ALL SELECT 'gold', 'dim_user', count(*) FROM dim_u
        UNION ALL SELECT 'gold', 'dim_product', count(*) FROM dim_p
        UNION ALL SELECT 'gold', 'fact_user_activity', count(*) FROM fact
        UNION ALL SELECT 'gold', 'agg_session_metrics', count(*) FROM agg""",
    "anomalies": """
        SELECT 'abandoned_cart' AS name, count(*) FILTER (is_abandoned_cart) AS n FROM sessions
        UNION ALL SELECT 'high_activity', count(*) FILTER (is_high_activity) FROM sessions
        UNION ALL SELECT 'long_session', count(*) FILTER (is_long_session) FROM sessions""",
    "metrics": """
        SELECT 'extracted' AS kind, CAST(NULL AS VARCHAR) AS layer, source AS name,
          CAST(NULL AS VARCHAR) AS detail, CAST(n AS DOUBLE) AS value FROM extracted
        UNION ALL SELECT 'quarantined', NULL, source, NULL, CAST(count(*) AS DOUBLE) FROM reasons
          WHERE rejection_reason IS NOT NULL GROUP BY source
        UNION ALL SELECT 'reason', NULL, source, rejection_reason, CAST(count(*) AS DOUBLE)
          FROM reasons WHERE rejection_reason IS NOT NULL GROUP BY source, rejection_reason
        UNION ALL SELECT 'loaded', layer, name, NULL, CAST(n AS DOUBLE) FROM loads
        UNION ALL SELECT 'anomaly', NULL, name, NULL, CAST(n AS DOUBLE) FROM anomalies""",
    "observations": """
        SELECT 'users.null_user_name_rate' AS observation,
          avg(CAST(user_name IS NULL AS INTEGER)) AS rate FROM raw_users
        UNION ALL SELECT 'users.invalid_email_rate', avg(CAST(is_invalid_email AS INTEGER)) FROM users_ok
        UNION ALL SELECT 'users.duplicate_email_rate', avg(CAST(is_duplicate_email AS INTEGER))
          FROM users_ok
        UNION ALL SELECT 'products.null_price_rate', avg(CAST(price IS NULL AS INTEGER)) FROM raw_products
        UNION ALL SELECT 'weblogs.unknown_action_rate', avg(CAST(action = 'bogus' AS INTEGER))
          FROM raw_weblogs""",
}


def _complete(body: str) -> str:
    """Put the steps a statement names, and those they name, before it."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"\b[a-z_]+\b", todo.pop()))
        for name in words & STEPS.keys() - needed:
            needed.add(name)
            todo.append(STEPS[name])
    steps = [f"{n} AS ({STEPS[n]})" for n in STEPS if n in needed]
    return f"WITH {', '.join(steps)} {body}" if steps else body


_RECORD = """SELECT 'run-0001' AS etl_run_id, DATE '2024-02-01' AS etl_run_date,
    TIMESTAMP '2024-02-01 03:00:00' AS etl_run_timestamp, 'raw/{0}' AS source_file, row_index,
    rejection_reason FROM {1} WHERE rejection_reason IS NOT NULL"""

_SESSION_COLUMNS = """session_id, session_start, session_end, session_duration_s, total_views,
    total_cart_adds, total_purchases, total_actions, conversion_rate, is_abandoned_cart,
    is_high_activity"""

# A log belongs to the session of the one before it unless more than a day lies between them.
_WINDOWS = """
        SELECT session_id, min(action_ts) AS session_start, max(action_ts) AS session_end,
          count(*) FILTER (act = 'view') AS total_views,
          count(*) FILTER (act = 'add_to_cart') AS total_cart_adds,
          count(*) FILTER (act = 'purchase') AS total_purchases, count(*) AS total_rows
        FROM (SELECT *, sum(starts) OVER (PARTITION BY session_id ORDER BY action_ts, row_index) AS part
          FROM (SELECT *, CASE WHEN action_ts <= lag(action_ts) OVER
              (PARTITION BY session_id ORDER BY action_ts, row_index) + INTERVAL 1 DAY
              THEN 0 ELSE 1 END AS starts FROM {}))
        GROUP BY session_id, part"""

_REPORT = """
        SELECT 'row_counts' AS section, source AS item, 'extracted' AS sub_item,
          CAST(n AS DOUBLE) AS value FROM extracted
        UNION ALL SELECT 'row_counts', source, 'quarantined', count(*) FROM reasons
          WHERE rejection_reason IS NOT NULL GROUP BY source
        UNION ALL SELECT 'rows_loaded', layer, name, n FROM loads
        UNION ALL SELECT 'quarantine_breakdown', source, rejection_reason, count(*) FROM reasons
          WHERE rejection_reason IS NOT NULL GROUP BY source, rejection_reason
        UNION ALL SELECT 'quality_observations', observation, NULL, round(rate, 6)
          FROM observations
        UNION ALL SELECT 'session_anomalies', name, NULL, n FROM anomalies
        UNION ALL SELECT 'session_anomalies', 'null_sk_in_fact', NULL, count(*) FROM fact
          WHERE user_sk IS NULL OR product_sk IS NULL
        UNION ALL SELECT 'post_load_checks', 'orphan_user_sk_check', 'passed', 0
        UNION ALL SELECT 'post_load_checks', 'duplicate_log_id_check', 'passed', 0
        UNION ALL SELECT 'post_load_checks', 'negative_session_duration_check', 'passed', 0
        UNION ALL SELECT 'post_load_checks', 'null_sk_check', 'passed', 0"""

_RULE = "SELECT '{0}' AS rule, {1} AS observed, {2} AS threshold, {1} > {2} AS triggered"
_ANOMALY = "(SELECT CAST(n AS DOUBLE) FROM anomalies WHERE name = '{0}')"
_RATE = """(SELECT round(count(*) * 1.0 / (SELECT sum(n) FROM extracted), 6) FROM reasons
    WHERE rejection_reason IS NOT NULL)"""
_LAYER = "(SELECT CAST(sum(n) AS BIGINT) FROM loads WHERE layer = '{0}')"
_AUDIT = """SELECT CAST({0} AS BIGINT) AS audit_id, 'run-0001' AS etl_run_id,
    DATE '2024-02-01' AS etl_run_date, TIMESTAMP '2024-02-01 03:00:00' AS etl_run_timestamp,
    'raw/weblogs' AS source_file, '{1}' AS layer, CAST({2} AS BIGINT) AS rows_extracted,
    CAST({3} AS BIGINT) AS rows_quarantined, {4} AS rows_loaded, '' AS quarantine_path,
    'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message,
    TIMESTAMP '2024-02-01 03:00:00' AS created_at"""

_BODIES: dict[str, str] = {
    "users_classified": "SELECT row_index, user_id, rejection_reason FROM users_judged",
    "users_clean": "SELECT * FROM users_ok",
    "products_classified": "SELECT row_index, product_id, rejection_reason FROM products_judged",
    "products_clean": "SELECT * FROM products_ok",
    "weblogs_classified": "SELECT row_index, log_id, rejection_reason FROM logs_judged",
    "weblogs_clean": """SELECT log_id, user_id, product_id, session_id, action,
        ts_text AS "timestamp", row_index FROM logs_ok""",
    "valid_id_sets": """SELECT DISTINCT 'users' AS source, user_id AS id FROM users_ok
        UNION ALL SELECT DISTINCT 'products', product_id FROM products_ok""",
    "quarantine_weblogs": _RECORD.format("weblogs", "logs_judged"),
    "quarantine_users": _RECORD.format("users", "users_judged"),
    "quarantine_products": _RECORD.format("products", "products_judged"),
    "quarantine_raw_json": """SELECT row_index, CAST(log_id AS VARCHAR) AS raw_log_id,
        CAST(user_id AS VARCHAR) AS raw_user_id, CAST(product_id AS VARCHAR) AS raw_product_id,
        session_id AS raw_session_id, action AS raw_action
        FROM logs_judged WHERE rejection_reason IS NOT NULL""",
    "rejection_reason_counts": """SELECT source, rejection_reason, count(*) AS rejected FROM reasons
        WHERE rejection_reason IS NOT NULL GROUP BY source, rejection_reason""",
    "conservation": """SELECT e.source, e.n AS extracted,
        count(*) FILTER (rejection_reason IS NULL) AS kept,
        count(*) FILTER (rejection_reason IS NOT NULL) AS rejected
        FROM extracted e JOIN reasons r ON e.source = r.source GROUP BY e.source, e.n""",
    "find_duplicates": "SELECT row_index, log_id, is_repeat AS is_duplicate FROM logs_typed",
    "find_duplicates_seen": """SELECT row_index, log_id, is_repeat OR log_id IN
        (SELECT l_orderkey * 10 + l_linenumber FROM lineitem) AS is_duplicate FROM logs_typed""",
    "dedupe_keep_first": """SELECT row_index, user_id, session_id FROM raw_weblogs
        QUALIFY row_number() OVER (PARTITION BY user_id, session_id ORDER BY row_index) = 1""",
    "dedupe_keep_latest": "SELECT row_index, user_id, user_name FROM users_latest",
    "schema_required_mask": """SELECT row_index, log_id IS NOT NULL AND user_id IS NOT NULL
        AND product_id IS NOT NULL AND session_id IS NOT NULL AS is_complete FROM raw_weblogs""",
    "parse_timestamp": "SELECT row_index, ts_value AS action_ts FROM logs_typed",
    "parse_timestamp_utc": "SELECT row_index, utc AS ts FROM times_utc",
    "parse_timestamp_by_chunk": """SELECT t.row_index, CASE WHEN NOT f.readable OR t.look = f.look THEN t.utc END AS ts
        FROM times_utc t JOIN (SELECT chunk, arg_min(look, row_index) AS look,
          arg_min(readable, row_index) AS readable FROM times_utc GROUP BY chunk) f USING (chunk)""",
    "valid_email": """SELECT row_index, coalesce(regexp_matches(email,
        '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$'), false) AS is_valid FROM raw_users""",
    "valid_session": """SELECT row_index, coalesce(regexp_matches(session_id, '^sess_[0-9]+$'), false)
        AS is_valid FROM raw_weblogs""",
    "categorize_action": """SELECT row_index, CASE WHEN lower(trim(action)) IN
        ('view', 'add_to_cart', 'purchase') THEN lower(trim(action)) END AS action
        FROM raw_weblogs""",
    "numeric_coercion": """SELECT row_index,
        TRY_CAST(regexp_replace(session_id, '^sess_', '') AS BIGINT) AS session_number,
        CAST(product_id AS DOUBLE) AS product_number FROM raw_weblogs""",
    "silver_weblogs": """SELECT log_id, user_id, product_id, session_id, act AS action,
        ts_text AS "timestamp", action_ts, 'run-0001' AS etl_run_id,
        DATE '2024-02-01' AS etl_run_date, user_name, email, product_name, category, price,
        row_index FROM silver""",
    "silver_users": """SELECT * EXCLUDE (row_index), DATE '2024-02-01' AS etl_run_date
        FROM users_ok""",
    "silver_products": """SELECT * EXCLUDE (row_index), DATE '2024-02-01' AS etl_run_date
        FROM products_ok""",
    "session_bounds": """SELECT session_id, session_start, session_end, session_duration_s
        FROM sessions""",
    "session_metrics_silver": f"SELECT {_SESSION_COLUMNS} FROM sessions",
    "session_flags": """SELECT session_id, is_abandoned_cart, is_high_activity, is_long_session
        FROM sessions""",
    "long_sessions_silver": """SELECT session_id, session_duration_s FROM sessions
        WHERE is_long_session""",
    "session_anomaly_counts": """SELECT count(*) FILTER (is_abandoned_cart) AS abandoned_cart,
        count(*) FILTER (is_high_activity) AS high_activity,
        count(*) FILTER (is_long_session) AS long_session FROM sessions""",
    "order_session_metrics": """
        SELECT session_id, session_start, session_end,
          round(CAST((epoch_us(session_end) - epoch_us(session_start)) / 1000000.0 AS DOUBLE), 6)
            AS session_duration_s,
          total_views, total_cart_adds, total_purchases, total_actions,
          round(CAST(total_purchases AS DOUBLE) / nullif(total_views, 0), 6) AS conversion_rate,
          total_cart_adds > 0 AND total_purchases = 0 AS is_abandoned_cart,
          total_actions > 50 AS is_high_activity
        FROM (SELECT 'sess_' || CAST(l_orderkey AS VARCHAR) AS session_id,
            min(l_shipdate) AS session_start, max(l_shipdate) AS session_end,
            count(*) FILTER (l_returnflag = 'A') AS total_views,
            count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS total_cart_adds,
            count(*) FILTER (l_returnflag = 'N') AS total_purchases, count(*) AS total_actions
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey)""",
    "order_repeats": """SELECT l_orderkey * 10 + l_linenumber AS log_id,
        count(*) - 1 AS later_copies FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        GROUP BY 1 HAVING count(*) > 1""",
    "dim_user": "SELECT * FROM dim_u",
    "dim_product": "SELECT * FROM dim_p",
    "dim_user_upsert": """
        SELECT row_number() OVER (ORDER BY NOT early, user_id) AS user_sk, user_id, user_name, email,
          CASE WHEN early THEN CAST(signup_date - 1 AS DATE) ELSE signup_date END AS signup_date,
          CASE WHEN early THEN TIMESTAMP '2024-02-01 03:00:00'
               ELSE TIMESTAMP '2024-02-02 03:00:00' END AS dw_created_at,
          TIMESTAMP '2024-02-02 03:00:00' AS dw_updated_at,
          CASE WHEN early THEN 'update' ELSE 'insert' END AS _change
        FROM (SELECT *, signup_date < DATE '2022-01-01' AS early FROM users_ok)""",
    "dim_product_upsert": """
        SELECT row_number() OVER (ORDER BY NOT early, product_id) AS product_sk, product_id,
          product_name, category, round(price, 6) AS price,
          CASE WHEN early THEN TIMESTAMP '2024-02-01 03:00:00'
               ELSE TIMESTAMP '2024-02-02 03:00:00' END AS dw_created_at,
          CASE WHEN early THEN 'update' ELSE 'insert' END AS _change
        FROM (SELECT *, price < 1200 AS early FROM products_ok)""",
    "fact_user_activity": "SELECT * FROM fact",
    "fact_incremental": """SELECT * FROM fact WHERE log_id IS NULL OR log_id NOT IN
        (SELECT l.log_id FROM early l JOIN dim_p p ON l.product_id = p.product_id
         WHERE l.log_id IS NOT NULL)""",
    "agg_session_metrics": "SELECT * FROM agg",
    "fact_after_failed_run": "SELECT * FROM fact",
    "agg_after_failed_run": "SELECT * FROM agg",
    "rebuild_sessions_once": "SELECT * FROM agg",
    "agg_incremental": """SELECT * FROM agg
        WHERE session_id NOT IN (SELECT session_id FROM early)""",
    "product_daily_stats": """SELECT product_sk, etl_run_date,
        count(*) FILTER (action = 'view') AS views,
        count(*) FILTER (action = 'purchase') AS purchases FROM fact GROUP BY 1, 2""",
    "bi_01_most_viewed_products": """SELECT p.product_name, count(*) AS view_count
        FROM fact f JOIN dim_p p ON f.product_sk = p.product_sk WHERE f.action = 'view'
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "bi_02_overall_conversion_rate": """SELECT round(CAST(count(DISTINCT CASE WHEN total_purchases > 0
        THEN session_id END) AS DOUBLE) / nullif(count(DISTINCT session_id), 0), 6)
        AS overall_conversion_rate FROM agg""",
    "bi_03_average_session_duration": """SELECT round(avg(session_duration_s) / 60, 6)
        AS avg_duration_minutes FROM agg WHERE session_duration_s >= 0""",
    "bi_04_top_users_by_purchases": """SELECT u.user_name, CAST(sum(s.total_purchases) AS BIGINT)
        AS total_purchases FROM agg s JOIN dim_u u ON s.user_sk = u.user_sk
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "bi_05_abandoned_cart_rate_per_day": """SELECT etl_run_date, round(CAST(sum(CASE WHEN
        is_abandoned_cart THEN 1 ELSE 0 END) AS DOUBLE) / nullif(count(*), 0), 6)
        AS abandoned_cart_rate FROM agg GROUP BY 1 ORDER BY 1""",
    "bi_06_product_conversion_rate": """SELECT p.product_name, round(CAST(sum(CASE WHEN
        f.action = 'purchase' THEN 1 ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN f.action = 'view'
        THEN 1 ELSE 0 END), 0), 6) AS product_cvr
        FROM fact f JOIN dim_p p ON f.product_sk = p.product_sk
        GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1""",
    "bi_07_average_actions_per_session": """SELECT round(avg(total_actions), 6)
        AS avg_actions_per_session FROM agg""",
    "bi_08_peak_activity_hours": """SELECT CAST(hour(action_ts) AS BIGINT) AS hour_of_day,
        count(*) AS action_count FROM fact GROUP BY 1 ORDER BY 1""",
    "bi_09_unusually_long_sessions": """SELECT session_id, session_duration_s FROM agg
        WHERE session_duration_s >
          (SELECT avg(session_duration_s) + 2 * stddev_samp(session_duration_s) FROM agg)""",
    "bi_10_cohort_signup_vs_purchases": """SELECT CAST(date_trunc('month', u.signup_date) AS DATE)
        AS signup_cohort, CAST(sum(s.total_purchases) AS BIGINT) AS total_purchases,
        count(DISTINCT s.user_sk) AS active_users
        FROM agg s JOIN dim_u u ON s.user_sk = u.user_sk GROUP BY 1 ORDER BY 1""",
    "check_orphan_user_sk": """SELECT count(*) AS orphan_users FROM fact
        WHERE user_sk IS NULL OR user_sk NOT IN (SELECT user_sk FROM dim_u)""",
    "check_orphan_user_sk_broken": """SELECT count(*) AS orphan_users FROM broken
        WHERE user_sk IS NULL OR user_sk NOT IN (SELECT user_sk FROM dim_u)""",
    "check_duplicate_log_id": """SELECT log_id, count(*) AS cnt FROM fact GROUP BY 1
        HAVING count(*) > 1""",
    "check_duplicate_log_id_broken": """SELECT log_id, count(*) AS cnt FROM broken GROUP BY 1
        HAVING count(*) > 1""",
    "check_negative_duration": """SELECT count(*) AS invalid_duration_count FROM agg
        WHERE session_duration_s < 0""",
    "check_null_sk": """SELECT count(*) FILTER (user_sk IS NULL) AS null_user_sk,
        count(*) FILTER (product_sk IS NULL) AS null_product_sk FROM fact""",
    "check_null_sk_broken": """SELECT count(*) FILTER (user_sk IS NULL) AS null_user_sk,
        count(*) FILTER (product_sk IS NULL) AS null_product_sk FROM broken""",
    "run_checks": """
        SELECT 'orphan_user_sk_check' AS check_name, count(*) AS violations, count(*) = 0 AS passed
          FROM fact WHERE user_sk IS NULL OR user_sk NOT IN (SELECT user_sk FROM dim_u)
        UNION ALL SELECT 'duplicate_log_id_check', count(*), count(*) = 0
          FROM (SELECT log_id FROM fact GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'negative_session_duration_check', count(*), count(*) = 0
          FROM agg WHERE session_duration_s < 0
        UNION ALL SELECT 'null_sk_check', count(*), count(*) = 0
          FROM fact WHERE user_sk IS NULL OR product_sk IS NULL""",
    "run_metrics": "SELECT * FROM metrics",
    "audit_rows": " UNION ALL ".join(
        [
            _AUDIT.format(
                1, "bronze", "(SELECT sum(n) FROM extracted)",
                "(SELECT count(*) FROM reasons WHERE rejection_reason IS NOT NULL)",
                _LAYER.format("bronze"),
            ),
            _AUDIT.format(2, "silver", 0, 0, _LAYER.format("silver")),
            _AUDIT.format(3, "gold", 0, 0, _LAYER.format("gold")),
        ]
    ),
    "quality_observations": "SELECT observation, round(rate, 6) AS rate FROM observations",
    "recommendations": " UNION ALL ".join(
        [
            _RULE.format("quarantine_rate", f"CAST({_RATE} AS DOUBLE)", "CAST(0.1 AS DOUBLE)"),
            *[
                _RULE.format(rule, _ANOMALY.format(name), "CAST(0 AS DOUBLE)")
                for rule, name in (
                    ("abandoned_cart_sessions", "abandoned_cart"),
                    ("long_sessions", "long_session"),
                    ("high_activity_sessions", "high_activity"),
                )
            ],
            _RULE.format("run_failed", "CAST(0 AS DOUBLE)", "CAST(0 AS DOUBLE)"),
        ]
    ),
    "csv_scan_positions": """SELECT row_number() OVER (ORDER BY row_index) - 1 AS row_index,
        CAST(log_id AS VARCHAR) AS log_id, CAST(user_id AS VARCHAR) AS user_id, session_id
        FROM raw_weblogs""",
    "bulk_load_by_name": """SELECT 'good' AS kind, count(*) FILTER (signup_text <> 'invalid_date')
        AS "rows" FROM raw_users UNION ALL SELECT 'bad', count(*) FILTER
        (signup_text = 'invalid_date') FROM raw_users""",
    "csv_mixed_headers": """SELECT CAST(log_id AS VARCHAR) AS log_id, CAST(user_id AS VARCHAR) AS user_id,
        CAST(product_id AS VARCHAR) AS product_id, session_id, action, ts_text AS "timestamp"
        FROM raw_weblogs""",
    "csv_multiline_cells": """SELECT row_number() OVER (ORDER BY row_index) - 1 AS row_index,
        CAST(product_id AS VARCHAR) AS product_id,
        CASE product_id % 4 WHEN 0 THEN product_name || chr(10) || 'second, "line"'
          WHEN 1 THEN '"' || product_name || '"' ELSE product_name END AS product_name, category
        FROM raw_products""",
    "bulk_load_rows": """SELECT user_id, user_name, email, CAST(signup_text AS DATE) AS signup_date
        FROM raw_users WHERE user_id % 50 NOT IN (7, 8) AND signup_text <> 'invalid_date'""",
    "bulk_load_rejects": """SELECT CASE WHEN user_id % 50 IN (7, 8) THEN 'width' ELSE 'value' END AS reason,
          CASE user_id % 50 WHEN 7 THEN concat_ws(',', user_id, coalesce(user_name, ''), coalesce(email, ''))
            WHEN 8 THEN concat_ws(',', user_id, coalesce(user_name, ''), coalesce(email, ''), signup_text, 'one more')
            ELSE '{"user_id":"' || user_id || '","user_name":' || coalesce('"' || user_name || '"', 'null')
              || ',"email":' || coalesce('"' || email || '"', 'null') || ',"signup_date":"invalid_date"}' END AS raw_row
        FROM raw_users WHERE user_id IS NOT NULL AND (user_id % 50 IN (7, 8) OR signup_text = 'invalid_date')""",
    "staged_scan_typed": "SELECT product_id, product_name, price FROM raw_products",
    "full_run_report": _REPORT,
    "report_ranked": f"""SELECT section, item, sub_item, CAST(row_number() OVER (PARTITION BY section
        ORDER BY CASE WHEN section = 'quarantine_breakdown' THEN -value ELSE 0 END NULLS FIRST,
          item NULLS FIRST, sub_item NULLS FIRST) AS INTEGER) AS rank FROM ({_REPORT})""",
    "audit_rows_with_paths": """
        SELECT CAST(1 AS BIGINT) AS audit_id, 'bronze' AS layer,
          (SELECT CAST(sum(n) AS BIGINT) FROM extracted) AS rows_extracted,
          (SELECT count(*) FROM reasons WHERE rejection_reason IS NOT NULL) AS rows_quarantined,
          (SELECT CAST(sum(n) AS BIGINT) FROM loads WHERE layer = 'bronze') AS rows_loaded,
          'SUCCESS' AS status, (SELECT string_agg('quarantine/source=' || source
            || '/etl_run_date=2024-02-01/etl_run_id=run-0001', ';' ORDER BY source) FROM
            (SELECT DISTINCT source FROM reasons WHERE rejection_reason IS NOT NULL)) AS quarantine_path
        UNION ALL SELECT CAST(i AS BIGINT), layer, 0, 0,
          (SELECT CAST(sum(n) AS BIGINT) FROM loads WHERE loads.layer = v.layer), 'SUCCESS', ''
          FROM (VALUES (2, 'silver'), (3, 'gold')) v(i, layer)""",
    "gold_export": "SELECT * FROM fact",
    "silver_session_order": """SELECT session_id, row_index, CAST(row_number() OVER (PARTITION BY session_id
        ORDER BY action_ts, row_index) AS INTEGER) AS place FROM logs_ok""",
    "long_sessions_running": """SELECT session_id, session_duration_s FROM agg
        WHERE session_duration_s >
          (SELECT avg(session_duration_s) + 2 * stddev_samp(session_duration_s) FROM agg)""",
    "check_negative_duration_broken": """SELECT count(*) AS invalid_duration_count FROM agg
        WHERE total_views = 0 OR session_duration_s < 0""",
    "layer_inventory": """SELECT 'users' AS source, count(*) AS "rows" FROM users_ok
        UNION ALL SELECT 'products', count(*) FROM products_ok""",
    "stream_weblogs_classified": "SELECT row_index, rejection_reason FROM logs_judged",
    "stream_two_runs_one_day": "SELECT log_id, rejection_reason FROM halves_judged",
    "stream_counters": """
        SELECT 'extracted' AS kind, CAST(NULL AS VARCHAR) AS layer, 'weblogs' AS name,
          CAST(NULL AS VARCHAR) AS detail, CAST(count(*) AS DOUBLE) AS value FROM logs_judged
        UNION ALL SELECT 'loaded', 'bronze', 'weblogs', NULL, count(*) FROM logs_ok
        UNION ALL SELECT 'quarantined', NULL, 'weblogs', NULL, count(*) FROM logs_judged
          WHERE rejection_reason IS NOT NULL
        UNION ALL SELECT 'reason', NULL, 'weblogs', r.reason, count(l.rejection_reason) FROM
          (VALUES ('null user_id'), ('duplicate log_id'), ('orphan user_id'), ('orphan product_id'),
            ('invalid session_id'), ('invalid timestamp')) r(reason)
          LEFT JOIN logs_judged l ON l.rejection_reason = r.reason GROUP BY r.reason""",
    "stream_session_windows": _WINDOWS.format("logs_ok"),
    "stream_late_logs": """SELECT log_id, row_index, session_id, action_ts, arrival AS batch
        FROM log_arrivals JOIN arrival_marks USING (arrival) WHERE action_ts < mark""",
    "stream_sessions_in_time": f"""SELECT *, CASE WHEN session_end + INTERVAL 1 DAY <
          (SELECT max(action_ts) FROM logs_ok) - INTERVAL 1 DAY THEN 'closed' ELSE 'open' END AS state
        FROM ({_WINDOWS.format("logs_in_time")})""",
    "stream_sessions_reconciled": _WINDOWS.format("logs_ok"),
}

ORACLES: dict[str, str] = {name: _complete(body) for name, body in _BODIES.items()}
