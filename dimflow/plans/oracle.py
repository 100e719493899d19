"""The catalog's queries as plain SQL over the same tables."""

from __future__ import annotations

from dimflow.plans.archived import DAYS
from dimflow.plans.catalog import LOADED_BEFORE, RUN_TS, SNAPSHOTS

ORACLE: dict[str, str] = {}


def _with(ctes: dict[str, str], *names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in names) + "\n"


_CTE = {
    "feed": """
        SELECT o_custkey AS customer_id, o_orderstatus AS status, o_orderpriority AS plan_id,
               o_orderdate AS ingestion_ts, o_orderkey AS feed_seq
        FROM orders""",
    "latest": """
        SELECT * FROM feed
        QUALIFY row_number() OVER (
            PARTITION BY customer_id ORDER BY ingestion_ts DESC, feed_seq DESC) = 1""",
    "customers": """
        SELECT l.*, c_name AS first_name, c_mktsegment AS phone, n_name AS country
        FROM latest l JOIN customer ON c_custkey = customer_id
        JOIN nation ON n_nationkey = c_nationkey""",
    "odd_customers": """
        SELECT * REPLACE (CASE WHEN customer_id % 23 = 0 THEN NULL
                               WHEN customer_id % 29 = 0 THEN '9-UNKNOWN'
                               ELSE plan_id END AS plan_id)
        FROM customers""",
    "plans": """
        SELECT o_orderpriority AS plan_id, 'Plan ' || substr(o_orderpriority, 3) AS plan_name,
               CASE WHEN substr(o_orderpriority, 1, 1) <= '2' THEN 'Premium' ELSE 'Basic' END
                   AS plan_category,
               o_totalprice AS monthly_price
        FROM orders
        QUALIFY row_number() OVER (
            PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "dim_plan": """
        SELECT *, row_number() OVER (ORDER BY substr(md5(plan_id), 1, 3), plan_id) AS plan_sk
        FROM plans""",
    "shipped": """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC,
                     l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                     l_linestatus DESC) = 1""",
    "activity": """
        SELECT o_custkey AS customer_id, l_orderkey || '-' || l_linenumber AS event_id,
               l_returnflag AS event_type, l_shipdate AS event_timestamp,
               l_linestatus AS device_type,
               CASE l_suppkey % 3 WHEN 0 THEN '4G' WHEN 1 THEN '5G' ELSE 'WIFI' END
                   AS network_type
        FROM shipped JOIN orders ON l_orderkey = o_orderkey""",
    "batches": """
        SELECT * FROM feed
        QUALIFY row_number() OVER (
            PARTITION BY customer_id, ingestion_ts ORDER BY feed_seq DESC) = 1""",
    "seen": """
        SELECT *, lag(status) OVER w AS was_status, lag(plan_id) OVER w AS was_plan,
               row_number() OVER w AS place
        FROM batches WINDOW w AS (PARTITION BY customer_id ORDER BY ingestion_ts)""",
    "dim": """
        SELECT customer_id, status, plan_id, feed_seq, ingestion_ts AS effective_start_date,
               lead(ingestion_ts) OVER w AS effective_end_date,
               lead(ingestion_ts) OVER w IS NULL AS is_current
        FROM seen
        WHERE place = 1 OR coalesce(status, '') <> coalesce(was_status, '')
              OR coalesce(plan_id, '') <> coalesce(was_plan, '')
        WINDOW w AS (PARTITION BY customer_id ORDER BY ingestion_ts)""",
    "resolved": """
        SELECT a.*, d.effective_start_date AS version_from, d.status, d.plan_id
        FROM activity a LEFT JOIN dim d
          ON a.customer_id = d.customer_id
         AND a.event_timestamp >= d.effective_start_date
         AND a.event_timestamp < coalesce(d.effective_end_date, TIMESTAMP '9999-12-31')""",
    "keyed_dim": """
        SELECT d.*, p.plan_sk, row_number() OVER (
                   ORDER BY substr(md5(d.customer_id || '|' || CAST(d.effective_start_date AS VARCHAR)), 1, 3),
                            d.customer_id, d.effective_start_date) AS customer_sk
        FROM dim d LEFT JOIN dim_plan p ON d.plan_id = p.plan_id""",
    "fact_rows": f"""
        SELECT a.event_id, a.customer_id, d.customer_sk, d.plan_sk, a.event_type,
               a.event_timestamp, a.device_type, a.network_type,
               TIMESTAMP '{RUN_TS}' AS ingestion_ts
        FROM activity a LEFT JOIN keyed_dim d
          ON a.customer_id = d.customer_id
         AND a.event_timestamp >= d.effective_start_date
         AND a.event_timestamp < coalesce(d.effective_end_date, TIMESTAMP '9999-12-31')""",
    "part_plans": """
        SELECT 'P' || p_partkey AS plan_id, p_name AS plan_name, p_type AS plan_category,
               CAST(CAST(p_retailprice AS DECIMAL(10, 2)) AS DOUBLE) AS monthly_price,
               p_size AS data_allowance_gb, p_size * 100 AS voice_minutes,
               p_size * 10 AS sms_allowance, p_partkey % 2 = 0 AS roaming_enabled,
               CAST(30 AS INTEGER) AS validity_days
        FROM part""",
    "doc_lines": """
        SELECT doc_id, len(parts) AS n_lines, i - 1 AS line_no, parts[i] AS text
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents) s,
             LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)""",
}
_HISTORY = ("feed", "batches", "seen", "dim")
_RESOLVED = (*_HISTORY, "shipped", "activity", "resolved")

# --- standardize -------------------------------------------------------------------------

ORACLE["split_good_bad"] = """
WITH e AS (
    SELECT event_id AS seq, CASE WHEN event_id % 17 <> 0 THEN event_id END AS event_id,
           CASE WHEN event_id % 19 <> 0 THEN user_id END AS customer_id, event_type
    FROM events)
SELECT *, CASE WHEN event_id IS NULL OR customer_id IS NULL THEN 'bad' ELSE 'good' END AS quality,
       CASE WHEN event_id IS NULL AND customer_id IS NULL THEN 'null_keys_[event_id, customer_id]'
            WHEN event_id IS NULL THEN 'null_keys_[event_id]'
            WHEN customer_id IS NULL THEN 'null_keys_[customer_id]' END AS reason
FROM e
"""

ORACLE["standardize_timestamps"] = f"""
WITH e AS (
    SELECT *, CASE WHEN event_id % 13 = 0 THEN 'not a time'
                   WHEN event_id % 11 = 0 THEN ''
                   WHEN event_id % 7 = 0 THEN replace(CAST(ts AS VARCHAR), ' ', 'T')
                   ELSE CAST(ts AS VARCHAR) END AS written
    FROM events)
SELECT event_id, user_id AS customer_id, event_type, TRY_CAST(written AS TIMESTAMP) AS event_ts,
       TIMESTAMP '{RUN_TS}' AS ingestion_ts
FROM e
"""

ORACLE["dedupe_latest_activity"] = _with(_CTE, "shipped") + "SELECT * FROM shipped"

ORACLE["dedupe_with_copies"] = """
SELECT l_orderkey, l_linenumber, max(l_shipdate) AS l_shipdate,
       max(l_returnflag) FILTER (l_shipdate = newest) AS l_returnflag, count(*) AS copies
FROM (SELECT *, max(l_shipdate) OVER (PARTITION BY l_orderkey, l_linenumber) AS newest
      FROM lineitem) t
GROUP BY l_orderkey, l_linenumber
"""

ORACLE["run_summary"] = """
WITH rows AS (
    SELECT 'activity_logs' AS dataset,
           CASE WHEN l_suppkey % 17 <> 0 THEN l_orderkey || '-' || l_linenumber END AS k
    FROM lineitem
    UNION ALL
    SELECT 'customers', CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_custkey AS VARCHAR) END
    FROM orders
    UNION ALL
    SELECT 'plans', o_orderpriority FROM orders)
SELECT dataset, count(*) AS total, count(DISTINCT k) AS good, count(*) - count(k) AS bad,
       count(k) - count(DISTINCT k) AS duplicates
FROM rows GROUP BY dataset
"""

ORACLE["payload_field_extract"] = """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.absent') AS absent
FROM events
"""

# --- staging -----------------------------------------------------------------------------

ORACLE["latest_customer_snapshot"] = (
    _with(_CTE, "feed", "latest", "customers") + "SELECT * FROM customers"
)

ORACLE["latest_plan_snapshot"] = """
SELECT o_orderpriority AS plan_id, o_totalprice AS monthly_price, o_orderdate AS ingestion_ts,
       o_orderkey AS feed_seq
FROM orders
QUALIFY row_number() OVER (
    PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
"""

ORACLE["customer_plan_enrichment"] = (
    _with(_CTE, "feed", "latest", "customers", "odd_customers", "plans")
    + """
SELECT c.customer_id, c.first_name, CAST(NULL AS VARCHAR) AS last_name,
       CAST(NULL AS VARCHAR) AS email, c.phone, c.country, c.status, c.plan_id,
       p.plan_name, p.plan_category, p.monthly_price, c.ingestion_ts
FROM odd_customers c LEFT JOIN plans p ON c.plan_id = p.plan_id
"""
)

ORACLE["activity_current_plan"] = (
    _with(_CTE, "feed", "latest", "shipped", "activity")
    + """
SELECT a.*, l.plan_id FROM activity a LEFT JOIN latest l ON a.customer_id = l.customer_id
"""
)

ORACLE["align_columns_by_name"] = (
    _with(_CTE, "part_plans")
    + f"""
SELECT * REPLACE (CASE WHEN data_allowance_gb = 7 THEN NULL ELSE roaming_enabled END
                      AS roaming_enabled,
                  CAST(NULL AS INTEGER) AS sms_allowance),
       TIMESTAMP '{RUN_TS}' AS ingestion_ts
FROM part_plans
"""
)

# --- customer dimension ------------------------------------------------------------------

ORACLE["scd2_bulk_history"] = _with(_CTE, *_HISTORY) + "SELECT * FROM dim"

ORACLE["scd2_late_batch"] = ORACLE["scd2_bulk_history"]

ORACLE["scd2_current_rows"] = (
    _with(_CTE, *_HISTORY)
    + """
SELECT plan_id, status, count(*) AS current_rows FROM dim WHERE is_current
GROUP BY plan_id, status
"""
)


def _batches(reopen_same_run: bool) -> str:
    """Close and insert per snapshot, each as a CTE on the state before."""
    columns = "customer_id, status, plan_id, feed_seq"
    parts = [f"feed AS ({_CTE['feed']})"]
    state = None
    for n, at in enumerate(SNAPSHOTS, 1):
        parts.append(f"""snap{n} AS (
            SELECT {columns} FROM feed WHERE ingestion_ts < TIMESTAMP '{at}'
            QUALIFY row_number() OVER (
                PARTITION BY customer_id ORDER BY ingestion_ts DESC, feed_seq DESC) = 1)""")
        opened = f"""SELECT {columns}, TIMESTAMP '{at}' AS effective_start_date,
                            CAST(NULL AS TIMESTAMP) AS effective_end_date, true AS is_current
                     FROM snap{n} s"""
        if state is None:
            parts.append(f"state{n} AS ({opened})")
        else:
            changed = """(coalesce(d.status, '') <> coalesce(s.status, '')
                          OR coalesce(d.plan_id, '') <> coalesce(s.plan_id, ''))"""
            parts.append(f"""closed{n} AS (
                SELECT d.customer_id, d.status, d.plan_id, d.feed_seq, d.effective_start_date,
                       CASE WHEN s.customer_id IS NOT NULL AND {changed}
                            THEN TIMESTAMP '{at}' ELSE d.effective_end_date END
                           AS effective_end_date,
                       d.is_current AND NOT (s.customer_id IS NOT NULL AND {changed})
                           AS is_current
                FROM {state} d LEFT JOIN snap{n} s
                  ON d.customer_id = s.customer_id AND d.is_current)""")
            without = f"closed{n}" if reopen_same_run else state
            parts.append(f"""state{n} AS (
                SELECT * FROM closed{n} UNION ALL
                {opened} WHERE NOT EXISTS (
                    SELECT 1 FROM {without} c
                    WHERE c.customer_id = s.customer_id AND c.is_current))""")
        state = f"state{n}"
    return "WITH " + ",\n".join(parts) + "\n"


_LAST = f"state{len(SNAPSHOTS)}"
ORACLE["scd2_apply_three_batches"] = _batches(True) + f"SELECT * FROM {_LAST}"
ORACLE["scd2_merge_one_step"] = _batches(False) + f"SELECT * FROM {_LAST}"
ORACLE["scd2_closed_in_batch"] = (
    _batches(True)
    + f"""
SELECT effective_end_date, count(*) AS closed_rows FROM {_LAST} WHERE NOT is_current
GROUP BY effective_end_date
"""
)

# --- keys and plan dimension -------------------------------------------------------------

ORACLE["dim_plan_type1"] = (
    _with(_CTE, "part_plans")
    + f"""
SELECT row_number() OVER (ORDER BY substr(md5(plan_id), 1, 3), plan_id) AS plan_sk, *,
       true AS is_active, TIMESTAMP '{RUN_TS}' AS updated_at
FROM part_plans
"""
)

ORACLE["dim_plan_append_variant"] = (
    _with(_CTE, "part_plans")
    + f"""
, numbered AS (
    SELECT row_number() OVER (ORDER BY substr(md5(plan_id), 1, 3), plan_id) AS n,
           plan_id, plan_name
    FROM part_plans)
SELECT n AS plan_sk, plan_id, plan_name, true AS is_active,
       TIMESTAMP '2001-01-01 00:00:00' AS updated_at
FROM numbered
UNION ALL
SELECT n + (SELECT count(*) FROM part_plans), plan_id, plan_name, true, TIMESTAMP '{RUN_TS}'
FROM numbered
"""
)

ORACLE["surrogate_keys"] = """
SELECT c_custkey AS customer_id,
       row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3), c_custkey)
           AS customer_sk
FROM customer
"""

ORACLE["surrogate_keys_incremental"] = """
WITH known AS (
    SELECT k, row_number() OVER (ORDER BY substr(md5(CAST(k AS VARCHAR)), 1, 3), k) AS sk
    FROM (SELECT DISTINCT o_custkey AS k FROM orders
          WHERE o_orderdate < TIMESTAMP '1995-06-01') t),
fresh AS (
    SELECT c_custkey AS k, (SELECT max(sk) FROM known)
           + row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3), c_custkey)
               AS sk
    FROM customer WHERE c_custkey NOT IN (SELECT k FROM known))
SELECT k AS customer_id, sk AS customer_sk
FROM known WHERE k IN (SELECT c_custkey FROM customer)
UNION ALL
SELECT k, sk FROM fresh
"""

ORACLE["plan_key_lookup"] = (
    _with(_CTE, "feed", "latest", "customers", "odd_customers", "plans", "dim_plan")
    + """
SELECT c.customer_id, c.first_name, c.status, p.plan_sk
FROM odd_customers c LEFT JOIN dim_plan p ON c.plan_id = p.plan_id
"""
)

# --- facts -------------------------------------------------------------------------------

ORACLE["fact_point_in_time"] = _with(_CTE, *_RESOLVED) + "SELECT * FROM resolved"

ORACLE["fact_point_in_time_merge"] = ORACLE["fact_point_in_time"]

ORACLE["plan_at_event"] = (
    _with(_CTE, *_RESOLVED, "plans")
    + """
SELECT r.event_id, r.customer_id, r.event_timestamp, r.plan_id, p.plan_name, p.plan_category,
       p.monthly_price
FROM resolved r LEFT JOIN plans p ON r.plan_id = p.plan_id
"""
)

ORACLE["unmatched_facts"] = (
    _with(_CTE, *_RESOLVED)
    + """
SELECT event_id, customer_id, event_timestamp FROM resolved WHERE version_from IS NULL
"""
)

_FACT = (*_HISTORY, "plans", "dim_plan", "keyed_dim", "shipped", "activity", "fact_rows")
ORACLE["fact_idempotent_append"] = (
    _with(_CTE, *_FACT)
    + f"""
SELECT * FROM fact_rows f
WHERE NOT EXISTS (
    SELECT 1 FROM activity l
    WHERE l.event_id = f.event_id AND l.event_timestamp < TIMESTAMP '{LOADED_BEFORE}')
"""
)

ORACLE["fact_reload_adds_zero"] = (
    _with(_CTE, *_FACT)
    + """
SELECT (SELECT count(*) FROM fact_rows) AS first_load,
       (SELECT count(*) FROM activity a
        WHERE NOT EXISTS (SELECT 1 FROM fact_rows f WHERE f.event_id = a.event_id))
           AS second_load
"""
)

# --- reports -----------------------------------------------------------------------------

ORACLE["behavior_change_monthly"] = (
    _with(_CTE, "shipped", "activity")
    + """
, monthly AS (
    SELECT customer_id, CAST(date_trunc('month', event_timestamp) AS TIMESTAMP) AS month,
           count(*) AS events
    FROM activity WHERE event_timestamp IS NOT NULL GROUP BY 1, 2)
SELECT *, lag(events) OVER w AS events_before, events - lag(events) OVER w AS change
FROM monthly WINDOW w AS (PARTITION BY customer_id ORDER BY month)
"""
)

ORACLE["behavior_change_incremental"] = ORACLE["behavior_change_monthly"]

ORACLE["plan_usage_ranked"] = (
    _with(_CTE, *_RESOLVED)
    + """
SELECT plan_id, count(*) AS events, count(DISTINCT customer_id) AS customers,
       rank() OVER (ORDER BY count(*) DESC) AS usage_rank
FROM resolved GROUP BY plan_id
"""
)

ORACLE["plan_churn_matrix"] = (
    _with(_CTE, *_HISTORY)
    + """
, moves AS (
    SELECT customer_id, plan_id AS from_plan, lead(plan_id) OVER w AS to_plan,
           status AS from_status, lead(status) OVER w AS to_status,
           lead(effective_start_date) OVER w AS next_from
    FROM dim WINDOW w AS (PARTITION BY customer_id ORDER BY effective_start_date))
SELECT from_plan, to_plan, from_status, to_status, count(*) AS moves,
       count(DISTINCT customer_id) AS customers
FROM moves
WHERE next_from IS NOT NULL
  AND (from_plan IS DISTINCT FROM to_plan OR from_status IS DISTINCT FROM to_status)
GROUP BY from_plan, to_plan, from_status, to_status
"""
)

ORACLE["customer_lifecycle"] = (
    _with(_CTE, *_HISTORY, "shipped", "activity")
    + f"""
, v AS (
    SELECT customer_id, count(*) AS versions,
           CAST(sum(days) AS BIGINT) AS days_covered,
           CAST(max(days) AS BIGINT) AS longest_version_days,
           min(effective_start_date) AS first_version_from,
           CAST(count(*) FILTER (is_current) AS BIGINT) AS open_versions
    FROM (SELECT *, date_diff('day', CAST(effective_start_date AS DATE),
                    CAST(coalesce(effective_end_date, TIMESTAMP '{RUN_TS}') AS DATE)) AS days
          FROM dim) t
    GROUP BY customer_id),
a AS (
    SELECT customer_id, count(*) AS events, min(event_timestamp) AS first_event,
           max(event_timestamp) AS last_event
    FROM activity GROUP BY customer_id)
SELECT v.*, coalesce(a.events, 0) AS events, a.first_event, a.last_event
FROM v LEFT JOIN a ON v.customer_id = a.customer_id
"""
)

ORACLE["daily_event_trend"] = """
WITH a AS (
    SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS event_date, event_type FROM events)
SELECT event_date, event_type, count(*) AS events,
       CAST(grouping(event_date, event_type) AS BIGINT) AS subtotal_level
FROM a GROUP BY ROLLUP (event_date, event_type)
"""

ORACLE["daily_device_trend"] = """
WITH a AS (
    SELECT CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS event_date,
           l_linestatus AS device_type,
           CASE l_suppkey % 3 WHEN 0 THEN '4G' WHEN 1 THEN '5G' ELSE 'WIFI' END AS network_type
    FROM lineitem)
SELECT event_date, device_type, network_type, count(*) AS events,
       CAST(grouping(event_date, device_type, network_type) AS BIGINT) AS subtotal_level
FROM a GROUP BY ROLLUP (event_date, device_type, network_type)
"""

# --- landed files ------------------------------------------------------------------------

_NDJSON_LINES = """
    SELECT CASE WHEN form = 9 THEN 'raw/other' WHEN form = 10 THEN 'landing/customers'
                WHEN doc_id % 2 = 0 THEN 'raw/customers' ELSE 'raw/activity_logs' END
               || '/doc-' || doc_id || '.ndjson' AS key,
           line_no,
           CASE WHEN form = 2 AND line_no = n_lines - 1 THEN '{"event_id":"e'
                WHEN form = 3 THEN ' ' || chr(9) || ' '
                WHEN form = 4 THEN '{' || t || '}'
                WHEN form = 5 AND line_no % 2 = 0 THEN '{' || e || ',' || t || '}'
                WHEN form = 5 THEN '{' || c || ',' || t || '}'
                WHEN form = 6 THEN '{"event_id":null,"customer_id":null}'
                WHEN form = 7 THEN '[' || q || ']'
                WHEN form = 8 THEN CAST(line_no AS VARCHAR)
                WHEN form = 11 THEN '{' || e || ',' || c || ',' || t || '} x'
                WHEN form = 12 THEN q
                ELSE '{' || e || ',' || c || ',' || t || '}' END AS value
    FROM (SELECT *, doc_id % 13 AS form, '"event_id":"e' || line_no || '"' AS e,
                 '"customer_id":"c' || doc_id || '"' AS c,
                 CAST(to_json(text) AS VARCHAR) AS q,
                 '"text":' || CAST(to_json(text) AS VARCHAR) AS t
          FROM doc_lines) f"""


def _ndjson(lines: str) -> str:
    """Verdict per file from ``lines`` (key, line_no, value); all files come from ``landed``."""

    def found(field: str) -> str:
        return f"""coalesce(bool_or(CASE
            WHEN NOT parsed THEN false
            WHEN kind = 'OBJECT' THEN list_contains(json_keys(line), '{field}')
            WHEN kind = 'ARRAY' THEN list_contains(json_extract_string(line, '$[*]'), '{field}')
            ELSE contains(line, '{field}') END), false)"""

    return f"""
WITH doc_lines AS ({_CTE['doc_lines']}),
landed AS ({_NDJSON_LINES}),
{lines},
valid AS (
    SELECT key, trim(value, ' ' || chr(9)) AS line, json_valid(value) AS is_json FROM seen),
typed AS (
    SELECT key, line, CASE WHEN is_json THEN json_type(line) END AS kind,
           CASE WHEN line = '' THEN NULL WHEN NOT is_json THEN false
                ELSE json_type(line) IN ('OBJECT', 'ARRAY', 'VARCHAR') END AS parsed
    FROM valid),
facts AS (
    SELECT key, count(*) FILTER (parsed) AS n_parsed, count(*) FILTER (NOT parsed) AS n_broken,
           {found('event_id')} AS has_event, {found('customer_id')} AS has_customer
    FROM typed GROUP BY key),
files AS (
    SELECT DISTINCT key, CASE WHEN split_part(key, '/', 2) IN ('customers', 'activity_logs')
                              THEN split_part(key, '/', 2) END AS dataset
    FROM landed WHERE key LIKE 'raw/%'),
judged AS (
    SELECT files.key, dataset,
           CASE WHEN dataset IS NULL THEN 'unknown_folder_structure'
                WHEN n_broken > 0 THEN 'invalid_ndjson_format'
                WHEN coalesce(n_parsed, 0) = 0 THEN 'no_json_lines_detected'
                WHEN dataset = 'customers' AND NOT has_customer
                    THEN 'missing_fields_[''customer_id'']'
                WHEN dataset = 'activity_logs' AND NOT has_event AND NOT has_customer
                    THEN 'missing_fields_[''event_id'', ''customer_id'']'
                WHEN dataset = 'activity_logs' AND NOT has_event
                    THEN 'missing_fields_[''event_id'']'
                WHEN dataset = 'activity_logs' AND NOT has_customer
                    THEN 'missing_fields_[''customer_id'']'
                ELSE 'ok' END AS reason
    FROM files LEFT JOIN facts ON files.key = facts.key)
SELECT key, dataset, reason = 'ok' AS ok, reason,
       CASE WHEN reason = 'ok' THEN 'archive' ELSE 'rejected' END || '/'
           || coalesce(dataset, '_unknown') || '/{RUN_TS[:10]}/'
           || split_part(key, '/', -1) AS moved_to
FROM judged
"""


ORACLE["ndjson_verdicts"] = _ndjson("seen AS (SELECT key, value FROM landed)")

ORACLE["ndjson_verdicts_sampled"] = _ndjson("""sized AS (
    SELECT *, row_number() OVER w AS n, sum(strlen(value) + 1) OVER w AS bytes
    FROM landed WINDOW w AS (PARTITION BY key ORDER BY line_no)),
seen AS (SELECT key, value FROM sized WHERE n <= 3 AND bytes <= 2049)""")

ORACLE["csv_verdicts"] = f"""
WITH files AS (
    SELECT 'raw/plans/doc-' || doc_id || '.csv' AS key, doc_id % 6 AS form,
           len(string_split(text, chr(10))) AS n_lines
    FROM documents),
judged AS (
    SELECT key, CASE WHEN form IN (1, 3) THEN 'missing_columns_[''plan_id'']'
                     WHEN form = 5 OR n_lines < 2 THEN 'no_data_rows_found'
                     ELSE 'ok' END AS reason
    FROM files)
SELECT key, 'plans' AS dataset, reason = 'ok' AS ok, reason,
       CASE WHEN reason = 'ok' THEN 'archive' ELSE 'rejected' END
           || '/plans/{RUN_TS[:10]}/' || split_part(key, '/', -1) AS moved_to
FROM judged
"""

ORACLE["csv_verdicts_multiline"] = f"""
WITH judged AS (
    SELECT 'raw/plans/doc-' || doc_id || '.csv' AS key,
           CASE WHEN doc_id % 4 + CASE WHEN doc_id % 3 = 2 THEN 1 ELSE 0 END < 2 THEN 'no_data_rows_found'
                ELSE 'ok' END AS reason
    FROM documents WHERE text IS NOT NULL)
SELECT key, 'plans' AS dataset, reason = 'ok' AS ok, reason,
       CASE WHEN reason = 'ok' THEN 'archive' ELSE 'rejected' END
           || '/plans/{RUN_TS[:10]}/' || split_part(key, '/', -1) AS moved_to
FROM judged
"""

_ROUTED = f"""
WITH keyed AS (
    SELECT CASE source WHEN 'src0' THEN 'customers' WHEN 'src1' THEN 'plans'
                       WHEN 'src2' THEN 'activity_logs' ELSE source END AS folder,
           lang || ' part ' || doc_id || '.ndjson' AS file, n_chars
    FROM documents),
judged AS (
    SELECT 'raw/' || folder || '/' || file AS key, file,
           CASE WHEN folder IN ('customers', 'plans', 'activity_logs') THEN folder END AS dataset,
           CASE WHEN folder NOT IN ('customers', 'plans', 'activity_logs')
                    THEN 'unknown_folder_structure'
                WHEN n_chars >= 1000 THEN 'ok' ELSE 'invalid_ndjson_format' END AS reason
    FROM keyed),
routed AS (
    SELECT key, dataset, reason, reason = 'ok' AS ok,
           CASE WHEN reason = 'ok' THEN 'archive' ELSE 'rejected' END || '/'
               || coalesce(dataset, '_unknown') || '/{RUN_TS[:10]}/' || file AS moved_to
    FROM judged)
"""

ORACLE["route_destinations"] = _ROUTED + "SELECT * FROM routed"

ORACLE["rejection_alerts"] = (
    _ROUTED
    + """
SELECT key, '{"file":"' || key || '","reason":"' || reason || '"'
            || CASE WHEN dataset IS NULL THEN '' ELSE ',"moved_to":"' || moved_to || '"' END
            || '}' AS message
FROM routed WHERE NOT ok
"""
)

_LANDED = _with(_CTE, "doc_lines") + """,
numbered AS (
    SELECT l.doc_id, l.line_no, d.source,
        coalesce(TRY_CAST(regexp_extract(d.source, '^src(\\d{1,6})$', 1) AS INTEGER), 4) % 7 AS form
    FROM doc_lines l JOIN documents d ON l.doc_id = d.doc_id
), keyed AS (
    SELECT *, ['customers', 'activity_logs', 'plans', 'customers', 'other', 'activity_logs', 'customers'][form + 1] AS folder,
        coalesce(source, 'none') || '-' || (doc_id // 2000) || '.'
            || ['ndjson', 'ndjson', 'csv', 'ndjson', 'txt', 'ndjson', 'ndjson.gz'][form + 1] AS file
    FROM numbered
), delivered AS (
    SELECT 1 AS delivery, form AS written, * FROM keyed
    UNION ALL
    SELECT 2, CASE form WHEN 0 THEN 3 WHEN 3 THEN 0 ELSE form END, * FROM keyed WHERE form IN (0, 1, 3) AND doc_id % 2 = 0
), lines AS (
    SELECT delivery, folder, file, written,
        CASE WHEN written <= 1 THEN '{"event_id":"e' || doc_id || '-' || line_no || '","customer_id":"c' || doc_id || '"}'
             WHEN written = 2 THEN 'P' || doc_id || '-' || line_no || ',"a, b"'
             WHEN written = 3 THEN '{"id":"' || doc_id || '-' || line_no || '"}'
             WHEN written = 5 THEN '{"event_id":"' || doc_id || '-' || line_no || '"'
             ELSE 'line ' || doc_id || '-' || line_no END AS value
    FROM delivered
    UNION ALL
    SELECT DISTINCT delivery, folder, file, written, 'plan_id,plan_name' FROM delivered WHERE folder = 'plans'
), counted AS (
    SELECT delivery, folder, file, written, count(*) AS n FROM lines GROUP BY ALL
), judged AS (
    SELECT *, 'raw/' || folder || '/' || file AS key, CASE WHEN folder <> 'other' THEN folder END AS dataset,
        CASE WHEN folder = 'other' THEN 'unknown_folder_structure'
             WHEN written = 6 THEN 'error_reading_file_no_line_read'
             WHEN written = 5 THEN 'invalid_ndjson_format'
             WHEN written = 3 THEN 'missing_fields_[''customer_id'']'
             WHEN written = 2 AND n < 3 THEN 'no_data_rows_found'
             ELSE 'ok' END AS reason
    FROM counted
), placed AS (
    SELECT *, reason = 'ok' AS ok,
        CASE WHEN reason = 'ok' THEN 'archive' ELSE 'rejected' END || '/' || coalesce(dataset, '_unknown') || '/2002-01-01/' || file AS moved_to
    FROM judged
), held AS (
    SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY moved_to ORDER BY delivery DESC) = 1
)
"""

ORACLE["intake_manifest"] = _LANDED + "SELECT delivery, key, dataset, ok, reason, moved_to FROM placed"

ORACLE["intake_routed_lines"] = _LANDED + """
SELECT moved_to, value, count(*) AS n
FROM held JOIN lines USING (delivery, folder, file) WHERE held.written <> 6 GROUP BY ALL"""

ORACLE["intake_redelivery"] = _LANDED + """
SELECT key, count(*) AS deliveries, string_agg(reason, '; ' ORDER BY delivery) AS reasons,
    max_by(moved_to, delivery) AS moved_to, max_by(n, delivery) AS lines
FROM placed GROUP BY key HAVING count(*) > 1"""

ORACLE["plans_across_headers"] = """
WITH parts AS (
    SELECT 'P' || p_partkey AS plan_id, p_partkey, p_name AS plan_name, p_retailprice AS monthly_price, p_size AS data_allowance_gb,
           p_size * 100 AS voice_minutes, p_size * 10 AS sms_allowance,
           CASE WHEN p_partkey % 2 = 0 THEN 'Y' ELSE 'N' END AS roaming_enabled,
           CAST(30 AS INTEGER) AS validity_days, p_type AS plan_category
    FROM part
), days AS (
    SELECT '1999-01-01' AS archive_date, * FROM parts
    UNION ALL
    SELECT '1999-01-02', * REPLACE (CAST(NULL AS INTEGER) AS voice_minutes) FROM parts WHERE p_partkey % 2 = 0
    UNION ALL
    SELECT '1999-01-03', plan_id, p_partkey, NULL, monthly_price, NULL, NULL, NULL, NULL, NULL, NULL
    FROM parts WHERE p_partkey % 3 = 0
)
SELECT * EXCLUDE (p_partkey), 'all' AS asked FROM days
UNION ALL
SELECT * EXCLUDE (p_partkey), 'middle' FROM days WHERE archive_date = '1999-01-02'
"""

ORACLE["archive_date_replay"] = """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS archive_date, event_type, count(*) AS events
FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'
GROUP BY 1, 2
"""

ORACLE["normalized_columns"] = """
SELECT s_suppkey AS supp_key, s_name AS supp_name, s_nationkey AS nation_key,
       s_acctbal AS acct_bal, true AS is_active
FROM supplier
"""

ORACLE["scd2_current_check"] = (
    _with(_CTE, *_HISTORY) + "SELECT count(*) AS current_rows FROM dim WHERE is_current"
)

# --- whole runs over archived files ------------------------------------------------------

_DELIVERED = ",\n".join(
    [
        f"""customers_{n} AS (
    SELECT CASE WHEN customer_id % 19 <> 0 THEN CAST(customer_id AS VARCHAR) END AS customer_id,
           'C' || customer_id AS first_name, plan_id, status
    FROM feed WHERE ingestion_ts < TIMESTAMP '{day}'
    QUALIFY row_number() OVER (
        PARTITION BY feed.customer_id ORDER BY ingestion_ts DESC, feed_seq DESC) = 1),
activity_{n} AS (
    SELECT * REPLACE (CASE WHEN customer_id % 17 <> 0 THEN CAST(customer_id AS VARCHAR) END
                          AS customer_id)
    FROM activity WHERE event_timestamp < TIMESTAMP '{day}')"""
        for n, day in enumerate(DAYS, 1)
    ]
)
_ARCHIVE = _with(_CTE, "feed", "shipped", "activity", "plans") + ", " + _DELIVERED

ORACLE["standardize_counts"] = (
    _ARCHIVE
    + """
, rows AS (
    SELECT 'customers' AS dataset, customer_id AS k, true AS whole FROM customers_1
    UNION ALL SELECT 'customers', customer_id, true FROM customers_2
    UNION ALL SELECT 'activity_logs', event_id, customer_id IS NOT NULL FROM activity_1
    UNION ALL SELECT 'activity_logs', event_id, customer_id IS NOT NULL FROM activity_2
    UNION ALL SELECT 'plans', plan_id, true FROM plans
    UNION ALL SELECT 'plans', plan_id, true FROM plans),
counted AS (
    SELECT dataset, count(*) AS total, count(DISTINCT k) FILTER (whole) AS good,
           count(*) FILTER (k IS NULL OR NOT whole) AS bad
    FROM rows GROUP BY dataset)
SELECT *, total - good - bad AS duplicates FROM counted
"""
)

ORACLE["quarantined_records"] = (
    _ARCHIVE
    + f"""
SELECT event_id, event_timestamp AS event_ts, 'null_keys_[customer_id]' AS reason,
       event_type AS flag, '{DAYS[0]}' AS archive_date
FROM activity_1 WHERE customer_id IS NULL
UNION ALL
SELECT event_id, event_timestamp, 'null_keys_[customer_id]', event_type, '{DAYS[1]}'
FROM activity_2 WHERE customer_id IS NULL
"""
)

ORACLE["staged_customers"] = (
    _ARCHIVE
    + f"""
, newest AS (
    SELECT * FROM customers_2 WHERE customer_id IS NOT NULL
    UNION ALL
    SELECT * FROM customers_1 o WHERE customer_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM customers_2 n WHERE n.customer_id = o.customer_id))
SELECT c.customer_id, c.first_name, CAST(NULL AS VARCHAR) AS last_name,
       CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone,
       CAST(NULL AS VARCHAR) AS country, c.status, c.plan_id, p.plan_name, p.plan_category,
       p.monthly_price, TIMESTAMP '{RUN_TS}' AS ingestion_ts
FROM newest c LEFT JOIN plans p ON c.plan_id = p.plan_id
"""
)

ORACLE["staging_misfits"] = """
WITH lost AS (
    SELECT 'stg_plans' AS staging_table, 'monthly_price' AS staging_column, count(*) AS n_rows,
           count(*) FILTER (p_size % 5 = 0 AND p_retailprice * 1000000 >= 99999999.995) AS misfits
    FROM part
    UNION ALL SELECT 'stg_plans', 'voice_minutes', count(*), count(*) FILTER (p_type = 'PROMO') FROM part
    UNION ALL SELECT 'stg_plans', 'sms_allowance', count(*),
           count(*) FILTER (CAST(p_size AS BIGINT) * 100000000 > 2147483647) FROM part
    UNION ALL SELECT 'stg_plans', 'roaming_enabled', count(*), count(*) FILTER (p_size = 7) FROM part
    UNION ALL SELECT 'stg_customers', 'ingestion_ts', count(*), count(*) FILTER (c_custkey % 3 = 0)
    FROM customer
    UNION ALL SELECT 'stg_activity', 'event_timestamp', count(*), count(*) FILTER (event_type = 'error')
    FROM events)
SELECT * FROM lost WHERE misfits > 0
"""

_WAREHOUSE = (
    _ARCHIVE
    + f"""
, first_run AS (SELECT * FROM customers_1 WHERE customer_id IS NOT NULL),
second_run AS (SELECT * FROM customers_2 WHERE customer_id IS NOT NULL),
versions AS (
    SELECT f.*, TIMESTAMP '{DAYS[0]}' AS effective_start_date,
           CASE WHEN s.status <> f.status OR s.plan_id <> f.plan_id
                THEN TIMESTAMP '{DAYS[1]}' END AS effective_end_date
    FROM first_run f LEFT JOIN second_run s ON f.customer_id = s.customer_id
    UNION ALL
    SELECT s.*, TIMESTAMP '{DAYS[1]}', NULL
    FROM second_run s LEFT JOIN first_run f ON f.customer_id = s.customer_id
    WHERE f.customer_id IS NULL OR s.status <> f.status OR s.plan_id <> f.plan_id)
"""
)

ORACLE["warehouse_customers"] = (
    _WAREHOUSE
    + """
SELECT v.*, v.effective_end_date IS NULL AS is_current, p.plan_category = 'Premium'
           AS roaming_enabled, p.monthly_price
FROM versions v LEFT JOIN plans p ON v.plan_id = p.plan_id
"""
)

ORACLE["warehouse_customers_compacted"] = ORACLE["warehouse_customers"]

ORACLE["warehouse_facts"] = (
    _WAREHOUSE
    + f"""
, delivered AS (
    SELECT *, TIMESTAMP '{DAYS[0]}' AS ingestion_ts FROM activity_1
    WHERE customer_id IS NOT NULL
    UNION ALL
    SELECT *, TIMESTAMP '{DAYS[1]}' FROM activity_2 n
    WHERE customer_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM activity_1 o WHERE o.event_id = n.event_id))
SELECT d.event_id, d.customer_id, d.event_type, d.event_timestamp, d.device_type,
       d.network_type, d.ingestion_ts, v.effective_start_date AS version_from, v.plan_id
FROM delivered d LEFT JOIN versions v
  ON d.customer_id = v.customer_id AND d.event_timestamp >= v.effective_start_date
 AND d.event_timestamp < coalesce(v.effective_end_date, TIMESTAMP '9999-12-31')
"""
)
