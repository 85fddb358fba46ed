"""SQL counterparts of the catalogue, written independently of the plans.

``STEPS`` are named sub-queries; a check names the steps it reads and gets
exactly those it needs as a WITH clause.
"""

from __future__ import annotations

import re

ISO = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z"


def _clean(*columns: str) -> str:
    return ", ".join(f"nullif(trim({c}), '') AS {c}" for c in columns)


def _instant(column: str) -> str:
    text = f"replace(replace({column}, 'T', ' '), 'Z', '')"
    return f"CASE WHEN regexp_full_match({column}, '{ISO}') THEN TRY_CAST({text} AS TIMESTAMP) END"


def _lenient(column: str) -> str:
    return f"TRY_CAST(replace(replace({column}, 'T', ' '), 'Z', '') AS TIMESTAMP)"


PAM_COLUMNS = ("pam_customer_id", "tenant", "full_name", "email_sha256", "country", "registered_at")
APP_COLUMNS = ("app_customer_id", "username", "email_sha256", "created_at")
EVENT_COLUMNS = (
    "event_id", "app_customer_id", "tenant", "event_type", "event_time",
    "net_result_usdt", "platform_fee_usdt",
)
SESSION_COLUMNS = ("session_id", "pam_customer_id", "login_at", "logout_at", "device", "ip_region")

STEPS: dict[str, str] = {}

# --- the four sources ------------------------------------------------------------

STEPS["raw_pam"] = """
    SELECT CASE WHEN c_custkey % 211 = 5 THEN NULL ELSE 'TG-' || c_custkey END AS pam_customer_id,
           CASE WHEN copy = 1 THEN 'tenant-9'
                WHEN c_custkey % 223 = 7 THEN NULL
                WHEN c_custkey % 227 = 9 THEN 'ten:ant'
                WHEN c_custkey % 229 = 11 THEN '  '
                ELSE 'tenant-' || ((c_custkey // 2) % 3) END AS tenant,
           CASE WHEN c_custkey % 17 = 3 THEN c_name
                ELSE 'Person ' || (c_custkey // 2) END AS full_name,
           CASE WHEN copy = 2 THEN sha256('alt-' || c_custkey || '@mail')
                WHEN c_custkey % 53 = 13 THEN NULL
                ELSE sha256('person-' || (c_custkey // 2) || '@mail') END AS email_sha256,
           n_name AS country,
           CASE WHEN c_custkey % 61 = 17 THEN 'not-a-date'
                WHEN c_custkey % 67 = 19 THEN NULL
                ELSE strftime(TIMESTAMP '2023-01-01 08:00:00' + to_days((c_custkey % 300)::INTEGER),
                              '%Y-%m-%dT%H:%M:%SZ') END AS registered_at
    FROM (
        SELECT *, 0 AS copy FROM customer
        UNION ALL SELECT *, 1 FROM customer WHERE c_custkey % 101 = 4
        UNION ALL SELECT *, 2 FROM customer WHERE c_custkey % 103 = 2
        UNION ALL SELECT *, 3 FROM customer WHERE c_custkey % 107 = 6
    ) c
    LEFT JOIN nation n
      ON n.n_nationkey
         = CASE WHEN c_custkey % 17 = 3 THEN c_nationkey ELSE (c_custkey // 2) % 25 END
"""

STEPS["raw_app"] = """
    SELECT CASE WHEN c_custkey % 211 = 15 THEN NULL ELSE 'PK-' || c_custkey END AS app_customer_id,
           'user_' || c_custkey AS username,
           CASE WHEN c_custkey % 59 = 21 THEN NULL
                WHEN c_custkey % 5 = 4 THEN sha256('solo-' || c_custkey || '@mail')
                ELSE sha256('person-' || c_custkey || '@mail') END AS email_sha256,
           strftime(TIMESTAMP '2023-06-01 09:30:00' + to_days((c_custkey % 200)::INTEGER),
                    '%Y-%m-%dT%H:%M:%SZ') AS created_at
    FROM customer
"""

STEPS["raw_events"] = """
    SELECT CASE WHEN event_id % 211 = 0 THEN NULL WHEN event_id % 499 = 3 THEN ''
                ELSE 'E-' || event_id END AS event_id,
           CASE WHEN event_id % 103 = 0 THEN NULL
                WHEN event_id % 401 = 7 THEN 'PK-ghost-' || user_id
                ELSE 'PK-' || user_id END AS app_customer_id,
           CASE WHEN event_id % 307 = 1 THEN NULL
                WHEN user_id % 7 = 3 AND event_id % 13 = 0 THEN 'tenant-' || ((user_id + 1) % 3)
                ELSE 'tenant-' || (user_id % 3) END AS tenant,
           event_type,
           CASE WHEN event_id % 101 = 0 THEN NULL
                WHEN event_id % 397 = 5 THEN 'soon'
                WHEN event_id % 503 = 9 THEN ''
                ELSE strftime(CASE WHEN copy = 3 THEN ts - INTERVAL 1 HOUR ELSE ts END,
                              '%Y-%m-%dT%H:%M:%S.%gZ') END AS event_time,
           CAST(CAST(cents - 100 AS DECIMAL(18,2)) AS VARCHAR)
               || CASE WHEN event_id % 97 = 0 THEN 'X' ELSE '' END AS net_result_usdt,
           CASE WHEN event_id % 89 = 0 THEN '-0.30'
                WHEN event_id % 409 = 11 THEN 'n/a'
                WHEN event_id % 113 = 0 THEN '0E-18'
                ELSE CAST(CAST(cents * CAST('0.05' AS DECIMAL(3,2))
                               + CASE WHEN copy = 2 THEN 1 ELSE 0 END AS DECIMAL(18,4))
                          AS VARCHAR) END AS platform_fee_usdt
    FROM (
        SELECT *, CAST(value AS DECIMAL(18,2)) AS cents FROM (
            SELECT *, 0 AS copy FROM events
            UNION ALL SELECT *, 1 FROM events WHERE event_id % 20 = 1
            UNION ALL SELECT *, 2 FROM events WHERE event_id % 50 = 2
            UNION ALL SELECT *, 3 FROM events WHERE event_id % 70 = 3
        )
    )
"""

STEPS["raw_sessions"] = """
    SELECT CASE WHEN o_orderkey % 307 = 0 THEN NULL ELSE 'S-' || o_orderkey END AS session_id,
           CASE WHEN o_orderkey % 211 = 0 THEN NULL
                WHEN o_orderkey % 401 = 7 THEN 'TG-ghost-' || o_custkey
                ELSE 'TG-' || o_custkey END AS pam_customer_id,
           CASE WHEN o_orderkey % 101 = 0 THEN 'not-a-time'
                ELSE strftime(login, '%Y-%m-%dT%H:%M:%SZ') END AS login_at,
           CASE WHEN o_orderkey % 409 = 11 THEN ''
                ELSE strftime(login + to_minutes(((o_orderkey % 7 - 1) * 10)::INTEGER),
                              '%Y-%m-%dT%H:%M:%SZ') END AS logout_at,
           CASE o_orderstatus WHEN 'O' THEN 'web' WHEN 'F' THEN 'ios' ELSE 'android' END AS device,
           o_orderpriority AS ip_region
    FROM (
        SELECT *, o_orderdate + to_seconds((o_orderkey % 86400)::INTEGER) AS login FROM (
            SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 30 = 1
        )
    )
"""

# --- strict labelling ----------------------------------------------------------------

STEPS["events_typed"] = f"""
    SELECT *, TRY_CAST(net_result_usdt AS DECIMAL(38,18)) AS net_result_decimal,
           TRY_CAST(platform_fee_usdt AS DECIMAL(38,18)) AS platform_fee_decimal,
           {_instant('event_time')} AS event_time_ts
    FROM (SELECT {_clean(*EVENT_COLUMNS)} FROM raw_events)
"""

STEPS["events_labelled"] = """
    SELECT *, CASE WHEN event_id IS NULL THEN 'missing_event_id'
                   WHEN app_customer_id IS NULL THEN 'missing_app_customer_id'
                   WHEN tenant IS NULL THEN 'missing_tenant'
                   WHEN contains(tenant, ':') THEN 'invalid_tenant'
                   WHEN event_time IS NULL THEN 'missing_event_time'
                   WHEN event_time_ts IS NULL THEN 'invalid_event_time'
                   WHEN net_result_decimal IS NULL THEN 'invalid_net_result_usdt'
                   WHEN platform_fee_decimal IS NULL THEN 'invalid_platform_fee_usdt'
                   WHEN platform_fee_decimal < 0 THEN 'negative_platform_fee_usdt'
              END AS rejection_reason
    FROM events_typed
"""

STEPS["events_dealt"] = """
    SELECT *, 'tenant-' || coalesce(TRY_CAST(
               regexp_extract(app_customer_id, '([0-9]+)$', 1) AS BIGINT) % 3, 0) AS file_tenant
    FROM raw_events
"""

STEPS["events_stamped"] = f"""
    SELECT {_clean('event_id', 'app_customer_id', 'event_type', 'event_time')},
           coalesce(nullif(trim(tenant), ''), file_tenant) AS tenant, file_tenant,
           TRY_CAST(nullif(trim(net_result_usdt), '') AS DECIMAL(38,18)) AS net,
           TRY_CAST(nullif(trim(platform_fee_usdt), '') AS DECIMAL(38,18)) AS fee
    FROM events_dealt
"""

STEPS["events_good"] = """
    SELECT event_id, app_customer_id, tenant, event_type, event_time,
           net_result_decimal AS net_result_usdt, platform_fee_decimal AS platform_fee_usdt,
           event_time_ts
    FROM events_labelled WHERE rejection_reason IS NULL
"""

STEPS["events_unique"] = """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY event_id, app_customer_id
            ORDER BY event_time_ts, tenant, event_type NULLS FIRST, event_time,
                     net_result_usdt, platform_fee_usdt) AS rn
        FROM events_good
    ) WHERE rn = 1
"""

STEPS["sessions_labelled"] = f"""
    SELECT *, CASE WHEN session_id IS NULL THEN 'missing_session_id'
                   WHEN pam_customer_id IS NULL THEN 'missing_pam_customer_id'
                   WHEN login_at_ts IS NULL THEN 'invalid_login_at'
                   WHEN logout_at_ts IS NULL THEN 'invalid_logout_at'
                   WHEN logout_at_ts < login_at_ts THEN 'logout_before_login'
              END AS rejection_reason
    FROM (
        SELECT *, {_instant('login_at')} AS login_at_ts, {_instant('logout_at')} AS logout_at_ts
        FROM (SELECT {_clean(*SESSION_COLUMNS)} FROM raw_sessions)
    )
"""

STEPS["sessions_good"] = """
    SELECT * EXCLUDE (rejection_reason) FROM sessions_labelled WHERE rejection_reason IS NULL
"""

STEPS["sessions_unique"] = """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY session_id
            ORDER BY login_at_ts, logout_at_ts, pam_customer_id, login_at, logout_at,
                     device, ip_region) AS rn
        FROM sessions_good
    ) WHERE rn = 1
"""

# --- strict identity ---------------------------------------------------------------------

STEPS["pam_labelled"] = f"""
    SELECT *, {_instant('registered_at')} AS registered_at_ts,
           CASE WHEN pam_customer_id IS NULL THEN 'missing_pam_customer_id'
                WHEN tenant IS NULL THEN 'missing_tenant'
                WHEN contains(tenant, ':') THEN 'invalid_tenant'
                WHEN email_sha256 IS NULL THEN 'missing_email_sha256'
           END AS rejection_reason
    FROM (SELECT {_clean(*PAM_COLUMNS)} FROM raw_pam)
"""

STEPS["pam_good"] = "SELECT * FROM pam_labelled WHERE rejection_reason IS NULL"

STEPS["tenant_pairs"] = """
    SELECT DISTINCT app_customer_id, tenant FROM events_typed
    WHERE app_customer_id IS NOT NULL AND tenant IS NOT NULL AND NOT contains(tenant, ':')
"""

STEPS["app_with_tenants"] = f"""
    SELECT a.app_customer_id, a.username, a.email_sha256, a.created_at,
           coalesce(p.tenant, t.tenant) AS tenant
    FROM (SELECT DISTINCT {_clean(*APP_COLUMNS)} FROM raw_app) a
    LEFT JOIN tenant_pairs p ON a.app_customer_id = p.app_customer_id
    LEFT JOIN (
        SELECT email_sha256, min(tenant) AS tenant FROM pam_good
        GROUP BY email_sha256 HAVING count(DISTINCT tenant) = 1
    ) t ON a.email_sha256 = t.email_sha256
"""

STEPS["app_labelled"] = f"""
    SELECT *, {_instant('created_at')} AS created_at_ts,
           CASE WHEN app_customer_id IS NULL THEN 'missing_app_customer_id'
                WHEN tenant IS NULL THEN 'missing_tenant'
                WHEN contains(tenant, ':') THEN 'invalid_tenant'
                WHEN email_sha256 IS NULL THEN 'missing_email_sha256'
           END AS rejection_reason
    FROM app_with_tenants
"""

STEPS["app_good"] = "SELECT * FROM app_labelled WHERE rejection_reason IS NULL"

STEPS["claims"] = """
    SELECT 'PAM' AS source_system, pam_customer_id AS source_customer_id, tenant, email_sha256,
           full_name, CAST(NULL AS VARCHAR) AS username, country, registered_at_ts AS since_ts
    FROM pam_good
    UNION ALL
    SELECT 'APP', app_customer_id, tenant, email_sha256, NULL, username, NULL, created_at_ts
    FROM app_good
"""

STEPS["bridge"] = """
    SELECT sha256(tenant || ':' || email_sha256) AS canonical_customer_id, tenant, source_system,
           source_customer_id, email_sha256
    FROM (
        SELECT *, row_number() OVER (PARTITION BY tenant, source_system, source_customer_id
                                     ORDER BY email_sha256) AS rn
        FROM claims
    ) WHERE rn = 1
"""

# The dimension as the literal full join of all account pairs.
STEPS["dim"] = """
    SELECT canonical_customer_id, tenant, email_sha256, full_name, username, country,
           registered_at, first_seen_at
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY canonical_customer_id
            ORDER BY registered_at NULLS LAST, given, pam_id NULLS LAST, full_name, country,
                     created NULLS LAST, app_id NULLS LAST) AS rn
        FROM (
            SELECT sha256(coalesce(p.tenant, a.tenant) || ':'
                          || coalesce(p.email_sha256, a.email_sha256)) AS canonical_customer_id,
                   coalesce(p.tenant, a.tenant) AS tenant,
                   coalesce(p.email_sha256, a.email_sha256) AS email_sha256,
                   p.full_name, a.username, p.country,
                   p.registered_at_ts AS registered_at,
                   coalesce(p.registered_at_ts, a.created_at_ts) AS first_seen_at,
                   p.registered_at IS NOT NULL AS given,
                   p.pam_customer_id AS pam_id, a.created_at_ts AS created,
                   a.app_customer_id AS app_id
            FROM pam_good p
            FULL JOIN app_good a ON p.tenant = a.tenant AND p.email_sha256 = a.email_sha256
        )
    ) WHERE rn = 1
"""

# --- strict facts ----------------------------------------------------------------------------

STEPS["activity"] = """
    SELECT e.event_id, e.app_customer_id, b.canonical_customer_id, e.tenant, e.event_type,
           e.event_time_ts AS event_time, CAST(e.event_time_ts AS DATE) AS event_date,
           e.net_result_usdt, e.platform_fee_usdt
    FROM events_unique e
    LEFT JOIN bridge b ON b.source_system = 'APP' AND b.source_customer_id = e.app_customer_id
                      AND b.tenant = e.tenant
"""

STEPS["activity_fact"] = "SELECT * FROM activity WHERE canonical_customer_id IS NOT NULL"

STEPS["session"] = """
    SELECT s.session_id, s.pam_customer_id, b.canonical_customer_id, b.tenant,
           s.login_at_ts AS login_at, s.logout_at_ts AS logout_at,
           CAST(s.login_at_ts AS DATE) AS session_date, s.device, s.ip_region, n.tenants
    FROM sessions_unique s
    LEFT JOIN (
        SELECT source_customer_id, count(*) AS tenants FROM bridge
        WHERE source_system = 'PAM' GROUP BY source_customer_id
    ) n ON n.source_customer_id = s.pam_customer_id
    LEFT JOIN bridge b ON b.source_system = 'PAM' AND b.source_customer_id = s.pam_customer_id
                      AND n.tenants = 1
"""

STEPS["session_fact"] = """
    SELECT * EXCLUDE (tenants) FROM session WHERE canonical_customer_id IS NOT NULL
"""

STEPS["persons"] = """
    SELECT tenant, email_sha256,
           count(*) FILTER (source_system = 'PAM') AS pam_accounts,
           count(*) FILTER (source_system = 'APP') AS app_accounts
    FROM claims GROUP BY tenant, email_sha256
"""

# What waits after a load of half the events without any customer, and what of it still
# waits after the other half and all customers.
STEPS["waiting"] = """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY event_id, app_customer_id
            ORDER BY event_time_ts, tenant, event_type NULLS FIRST, event_time,
                     net_result_usdt, platform_fee_usdt) AS rn
        FROM events_good
        WHERE coalesce((TRY_CAST(substr(event_time, 12, 2) AS INTEGER)
                        + CAST(floor(platform_fee_usdt) AS INTEGER)) % 2, 0) = 1
    ) WHERE rn = 1
"""

STEPS["lost"] = """
    SELECT u.* FROM events_unique u JOIN activity a USING (event_id, app_customer_id)
    WHERE a.canonical_customer_id IS NULL
"""

STEPS["still_waiting"] = """
    SELECT count(*) AS n FROM waiting w JOIN lost l
    USING (event_id, app_customer_id, event_time_ts, tenant, event_time,
           net_result_usdt, platform_fee_usdt)
"""

# --- compat -----------------------------------------------------------------------------------

STEPS["c_events_labelled"] = f"""
    SELECT *, CASE WHEN event_id IS NULL THEN 'missing_event_id'
                   WHEN app_customer_id IS NULL THEN 'missing_app_customer_id'
                   WHEN tenant IS NULL THEN 'missing_tenant'
                   WHEN event_time IS NULL THEN 'missing_event_time'
                   WHEN net_result_decimal IS NULL THEN 'invalid_net_result_usdt'
                   WHEN platform_fee_decimal IS NULL THEN 'invalid_platform_fee_usdt'
                   WHEN platform_fee_decimal < 0 THEN 'negative_platform_fee_usdt'
              END AS rejection_reason
    FROM (
        SELECT *, TRY_CAST(net_result_usdt AS DECIMAL(38,18)) AS net_result_decimal,
               TRY_CAST(platform_fee_usdt AS DECIMAL(38,18)) AS platform_fee_decimal,
               {_lenient('event_time')} AS event_time_ts
        FROM raw_events
    )
"""

STEPS["c_events_unique"] = """
    SELECT event_id, app_customer_id, tenant, event_type, event_time,
           net_result_decimal AS net_result_usdt, platform_fee_decimal AS platform_fee_usdt,
           event_time_ts
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY event_id, app_customer_id
            ORDER BY event_time_ts NULLS FIRST, tenant, event_type NULLS FIRST, event_time,
                     net_result_decimal, platform_fee_decimal) AS rn
        FROM c_events_labelled WHERE rejection_reason IS NULL
    ) WHERE rn = 1
"""

STEPS["c_app"] = """
    SELECT a.*, p.tenant FROM raw_app a
    LEFT JOIN (SELECT DISTINCT app_customer_id, tenant FROM raw_events) p
      ON a.app_customer_id = p.app_customer_id
"""

STEPS["c_dim"] = f"""
    SELECT canonical_customer_id, tenant, email_sha256, full_name, username, country,
           registered_at, first_seen_at
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY canonical_customer_id
            ORDER BY registered_at NULLS LAST, first_seen_at NULLS LAST, email_sha256 NULLS FIRST,
                     pam_id NULLS FIRST, created NULLS LAST, app_id NULLS FIRST) AS rn
        FROM (
            SELECT *, sha256(concat_ws(':', tenant, email_sha256)) AS canonical_customer_id
            FROM (
                SELECT coalesce(p.tenant, a.tenant) AS tenant,
                       coalesce(p.email_sha256, a.email_sha256) AS email_sha256,
                       p.full_name, a.username, p.country,
                       {_lenient('p.registered_at')} AS registered_at,
                       {_lenient('coalesce(p.registered_at, a.created_at)')} AS first_seen_at,
                       p.pam_customer_id AS pam_id, {_lenient('a.created_at')} AS created,
                       a.app_customer_id AS app_id
                FROM raw_pam p FULL JOIN c_app a ON p.email_sha256 = a.email_sha256
            )
        )
    ) WHERE rn = 1
"""

STEPS["c_bridge"] = """
    SELECT sha256(concat_ws(':', tenant, email_sha256)) AS canonical_customer_id, tenant,
           source_system, source_customer_id, email_sha256
    FROM (
        SELECT source_system, source_customer_id, tenant, email_sha256,
               row_number() OVER (PARTITION BY tenant, source_system, source_customer_id
                                  ORDER BY email_sha256 NULLS LAST) AS rn
        FROM (
            SELECT 'PAM' AS source_system, pam_customer_id AS source_customer_id, tenant,
                   email_sha256 FROM raw_pam
            UNION ALL
            SELECT 'APP', app_customer_id, tenant, email_sha256 FROM c_app
        )
    ) WHERE rn = 1
"""

STEPS["c_activity"] = """
    SELECT e.event_id, e.app_customer_id, b.canonical_customer_id, e.tenant, e.event_type,
           e.event_time_ts AS event_time, CAST(e.event_time_ts AS DATE) AS event_date,
           e.net_result_usdt, e.platform_fee_usdt
    FROM c_events_unique e
    LEFT JOIN c_bridge b ON b.source_system = 'APP' AND b.source_customer_id = e.app_customer_id
                        AND b.tenant = e.tenant
"""

STEPS["c_sessions_unique"] = f"""
    SELECT * FROM (
        SELECT *, row_number() OVER (
            PARTITION BY session_id
            ORDER BY login_at_ts, logout_at_ts, pam_customer_id, login_at, logout_at,
                     device, ip_region) AS rn
        FROM (
            SELECT *, {_lenient('login_at')} AS login_at_ts, {_lenient('logout_at')} AS logout_at_ts
            FROM raw_sessions
        )
        WHERE session_id IS NOT NULL AND pam_customer_id IS NOT NULL
          AND login_at_ts IS NOT NULL AND logout_at_ts IS NOT NULL AND logout_at_ts >= login_at_ts
    ) WHERE rn = 1
"""

STEPS["c_session"] = """
    SELECT s.session_id, s.pam_customer_id, b.canonical_customer_id, b.tenant,
           s.login_at_ts AS login_at, s.logout_at_ts AS logout_at,
           CAST(s.login_at_ts AS DATE) AS session_date, s.device, s.ip_region
    FROM c_sessions_unique s
    LEFT JOIN c_bridge b ON b.source_system = 'PAM' AND b.source_customer_id = s.pam_customer_id
"""

# --- checks --------------------------------------------------------------------------------------

ACTIVITY = (
    "event_id, app_customer_id, canonical_customer_id, tenant, event_type, event_time, "
    "event_date, net_result_usdt, platform_fee_usdt"
)
SESSION = (
    "session_id, pam_customer_id, canonical_customer_id, tenant, login_at, logout_at, "
    "session_date, device, ip_region"
)
MONEY = "DECIMAL(38,18)"

KPI_FEE = f"""
    SELECT tenant, CAST(sum(platform_fee_usdt) AS {MONEY}) AS total_platform_fee_usdt
    FROM %s GROUP BY tenant ORDER BY tenant
"""
KPI_TOP = f"""
    SELECT canonical_customer_id, count(*) AS event_count,
           CAST(sum(net_result_usdt) AS {MONEY}) AS net_result_usdt
    FROM %s GROUP BY canonical_customer_id
    ORDER BY event_count DESC, net_result_usdt DESC, canonical_customer_id NULLS FIRST LIMIT 10
"""
KPI_DAILY = """
    SELECT event_date, count(DISTINCT canonical_customer_id) AS daily_active_customers
    FROM %s GROUP BY event_date ORDER BY event_date
"""

SESSIONS_30_MIN = """
    SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS event_count
    FROM (
        SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                   ROWS UNBOUNDED PRECEDING) AS session_no
        FROM (
            SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                                <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens
            FROM events
        )
    ) GROUP BY user_id, session_no
"""

CHECKS: dict[str, str] = {
    "source_typed_events": """
        SELECT event_id, app_customer_id, tenant, event_type, event_time_ts AS event_time,
               net_result_decimal AS net_result_usdt, platform_fee_decimal AS platform_fee_usdt
        FROM events_typed
    """,
    "ndjson_events": "SELECT * FROM raw_events",
    "ndjson_sessions": "SELECT * FROM raw_sessions",
    "events_rejected": """
        SELECT event_id, app_customer_id, tenant, event_type, event_time, net_result_usdt,
               platform_fee_usdt, net_result_decimal, platform_fee_decimal, rejection_reason
        FROM events_labelled WHERE rejection_reason IS NOT NULL
    """,
    "events_valid": "SELECT * EXCLUDE (event_time_ts) FROM events_good",
    "sessions_rejected": """
        SELECT * FROM sessions_labelled WHERE rejection_reason IS NOT NULL
    """,
    "sessions_valid": "SELECT * EXCLUDE (login_at_ts, logout_at_ts) FROM sessions_good",
    "rejections_by_reason": """
        SELECT 'activity_events' AS source, rejection_reason, count(*) AS rejected_count
        FROM events_labelled WHERE rejection_reason IS NOT NULL GROUP BY rejection_reason
        UNION ALL
        SELECT 'customer_sessions', rejection_reason, count(*)
        FROM sessions_labelled WHERE rejection_reason IS NOT NULL GROUP BY rejection_reason
    """,
    "events_deduplicated": "SELECT * EXCLUDE (event_time_ts) FROM events_unique",
    "sessions_deduplicated": "SELECT * EXCLUDE (login_at_ts, logout_at_ts) FROM sessions_unique",
    "app_tenant_pairs": "SELECT * FROM tenant_pairs",
    "app_enriched": "SELECT * FROM app_with_tenants",
    "canonical_ids": """
        SELECT DISTINCT tenant, email_sha256,
               sha256(tenant || ':' || email_sha256) AS canonical_customer_id
        FROM claims
    """,
    "unresolvable_accounts": """
        SELECT 'PAM' AS source_system, pam_customer_id AS source_customer_id, tenant,
               email_sha256, rejection_reason
        FROM pam_labelled WHERE rejection_reason IS NOT NULL
        UNION ALL
        SELECT 'APP', app_customer_id, tenant, email_sha256, rejection_reason
        FROM app_labelled WHERE rejection_reason IS NOT NULL
    """,
    "dim_full_join": """
        SELECT coalesce(p.tenant, a.tenant) AS tenant,
               coalesce(p.email_sha256, a.email_sha256) AS email_sha256,
               count(DISTINCT p.rowid_) AS pam_accounts, count(DISTINCT a.rowid_) AS app_accounts,
               count(*) AS joined_rows
        FROM (SELECT *, row_number() OVER () AS rowid_ FROM pam_good) p
        FULL JOIN (SELECT *, row_number() OVER () AS rowid_ FROM app_good) a
          ON p.tenant = a.tenant AND p.email_sha256 = a.email_sha256
        GROUP BY 1, 2
    """,
    "dim_customer": "SELECT * FROM dim",
    "identity_bridge": "SELECT * FROM bridge",
    "fact_activity": f"SELECT {ACTIVITY} FROM activity_fact",
    "fact_sessions": f"SELECT {SESSION} FROM session_fact",
    "unresolved_facts": """
        SELECT 'activity_events' AS source, event_id AS source_key, app_customer_id AS account,
               'unresolved_identity' AS rejection_reason
        FROM activity WHERE canonical_customer_id IS NULL
        UNION ALL
        SELECT 'customer_sessions', session_id, pam_customer_id,
               CASE WHEN tenants > 1 THEN 'ambiguous_tenant' ELSE 'unresolved_identity' END
        FROM session WHERE canonical_customer_id IS NULL
    """,
    "kpi_fee_by_tenant": KPI_FEE % "activity_fact",
    "kpi_top_customers": KPI_TOP % "activity_fact",
    "kpi_daily_active": KPI_DAILY % "activity_fact",
    "kpi_daily_active_within_bound": """
        SELECT event_date, count(DISTINCT canonical_customer_id) AS daily_active_customers,
               TRUE AS within_bound
        FROM activity_fact GROUP BY event_date""",
    "value_drift_within_bound": """
        SELECT measure, tenant, day, day_values, past_values, TRUE AS ranks_fit, TRUE AS flag_fits
        FROM (
            SELECT measure, tenant, day, n AS day_values,
                   CAST(sum(n) OVER (PARTITION BY measure, tenant ORDER BY day
                       RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS BIGINT)
                       AS past_values
            FROM (
                SELECT 'fee' AS measure, tenant, event_date AS day, count(*) AS n
                FROM activity_fact GROUP BY ALL
                UNION ALL
                SELECT 'minutes', tenant, session_date, count(*) FROM session_fact GROUP BY ALL
            )
        ) WHERE past_values IS NOT NULL""",
    "kpi_sql_on_views": """
        SELECT d.country, f.event_date, count(*) AS event_count,
               count(DISTINCT f.canonical_customer_id) AS customers
        FROM activity_fact f JOIN dim d
          ON d.tenant = f.tenant AND d.canonical_customer_id = f.canonical_customer_id
        GROUP BY d.country, f.event_date
    """,
    "latest_version_dim": """
        SELECT * EXCLUDE (country),
               CASE WHEN registered_at IS NOT NULL THEN country END AS country
        FROM dim
    """,
    "latest_version_bridge": """
        SELECT * EXCLUDE (email_sha256),
               CASE WHEN source_system = 'APP' THEN email_sha256 ELSE 'old' END AS email_sha256
        FROM bridge
    """,
    "latest_version_activity": f"""
        SELECT * EXCLUDE (platform_fee_usdt),
               CAST(CASE WHEN event_date >= DATE '2024-01-16' THEN platform_fee_usdt
                         ELSE platform_fee_usdt + 1 END AS {MONEY}) AS platform_fee_usdt
        FROM activity_fact
    """,
    "latest_version_session": """
        SELECT * EXCLUDE (device),
               CASE WHEN session_date >= DATE '1998-01-01' THEN device ELSE 'old' END AS device
        FROM session_fact
    """,
    "month_pruned_sessions": """
        SELECT session_date, count(*) AS session_count FROM session_fact
        WHERE session_date BETWEEN DATE '1997-03-01' AND DATE '1997-05-31'
        GROUP BY session_date
    """,
    "compacted_activity": f"SELECT {ACTIVITY} FROM activity_fact",
    "clustered_activity": f"""
        SELECT {ACTIVITY} FROM activity_fact
        WHERE (tenant = 'tenant-0' AND event_date BETWEEN DATE '2024-01-04' AND DATE '2024-01-12')
           OR (tenant = 'tenant-1' AND event_date BETWEEN DATE '2024-01-07' AND DATE '2024-01-15')
           OR (tenant = 'tenant-2' AND event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-18')
    """,
    "compacted_session_compat": f"SELECT {SESSION} FROM c_session",
    "warehouse_row_counts": """
        SELECT 'dim_customer' AS table_name, count(*) AS row_count FROM dim
        UNION ALL SELECT 'bridge_customer_identity', count(*) FROM bridge
        UNION ALL SELECT 'fact_activity_event', count(*) FROM activity_fact
        UNION ALL SELECT 'fact_customer_session', count(*) FROM session_fact
    """,
    "rerun_idempotent": f"SELECT {ACTIVITY} FROM activity_fact",
    "rerun_idempotent_dim": "SELECT * FROM dim",
    "contract_violations": """
        SELECT column_name, null_rows FROM (
            SELECT 'canonical_customer_id' AS column_name,
                   count(*) FILTER (canonical_customer_id IS NULL) AS null_rows FROM c_activity
            UNION ALL SELECT 'event_time', count(*) FILTER (event_time IS NULL) FROM c_activity
            UNION ALL SELECT 'event_date', count(*) FILTER (event_date IS NULL) FROM c_activity
            UNION ALL SELECT 'event_type', count(*) FILTER (event_type IS NULL) FROM c_activity
        ) WHERE null_rows > 0
    """,
    "quarantine_table": """
        SELECT source, rejection_reason, count(*) AS distinct_rows, CAST(sum(n) AS BIGINT) AS copies
        FROM (
            SELECT 'activity_events' AS source, rejection_reason, count(*) AS n
            FROM events_labelled WHERE rejection_reason IS NOT NULL
            GROUP BY event_id, app_customer_id, tenant, event_type, event_time, net_result_usdt,
                     platform_fee_usdt, rejection_reason
            UNION ALL
            SELECT 'customer_sessions', rejection_reason, count(*) AS n
            FROM sessions_labelled WHERE rejection_reason IS NOT NULL
            GROUP BY session_id, pam_customer_id, login_at, logout_at, device, ip_region,
                     rejection_reason
        ) GROUP BY source, rejection_reason
    """,
    "quarantine_replay": """
        SELECT DISTINCT event_id, app_customer_id, tenant, event_type, event_time,
               net_result_usdt, platform_fee_usdt, rejection_reason
        FROM events_labelled WHERE rejection_reason IS NOT NULL
    """,
    "incremental_new_events": """
        SELECT event_id, app_customer_id, event_time FROM activity_fact
        WHERE event_date >= DATE '2024-01-20'
    """,
    "incremental_split_events": f"SELECT {ACTIVITY} FROM activity_fact",
    "incremental_split_views": f"""
        SELECT event_date, tenant, count(*) AS event_count,
               CAST(sum(platform_fee_usdt) AS {MONEY}) AS total_platform_fee_usdt
        FROM activity_fact
        WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
        GROUP BY event_date, tenant""",
    "load_after_email_change": """
        SELECT 'fact_activity_event' AS table_name, event_id || '|' || app_customer_id AS row_key,
               canonical_customer_id, tenant FROM activity_fact
        UNION ALL SELECT 'fact_customer_session', session_id, canonical_customer_id, tenant
        FROM session_fact
        UNION ALL SELECT 'dim_customer', tenant || '|' || canonical_customer_id,
                         canonical_customer_id, tenant FROM dim
        UNION ALL SELECT 'bridge_customer_identity',
                         tenant || '|' || source_system || '|' || source_customer_id,
                         canonical_customer_id, tenant FROM bridge""",
    "quarantine_states": f"""
        SELECT 'activity_events' AS source, rejection_reason, 'held' AS state,
               count(DISTINCT ({', '.join(EVENT_COLUMNS)})) AS row_count, count(*) AS copies
        FROM events_labelled WHERE rejection_reason IS NOT NULL GROUP BY rejection_reason
        UNION ALL
        SELECT 'customer_sessions', rejection_reason, 'held',
               count(DISTINCT ({', '.join(SESSION_COLUMNS)})), count(*)
        FROM sessions_labelled WHERE rejection_reason IS NOT NULL GROUP BY rejection_reason
        UNION ALL
        SELECT 'activity_events', 'unresolved_identity', 'held', count(*), count(*)
        FROM lost HAVING count(*) > 0
        UNION ALL
        SELECT 'activity_events', 'unresolved_identity', 'resolved', n, n
        FROM (SELECT (SELECT count(*) FROM waiting) - (SELECT n FROM still_waiting) AS n) WHERE n > 0
        UNION ALL
        SELECT 'customer_sessions', 'unresolved_identity', 'held', count(*), count(*)
        FROM session WHERE canonical_customer_id IS NULL HAVING count(*) > 0
        UNION ALL
        SELECT 'customer_sessions', 'unresolved_identity', 'resolved', count(*), count(*)
        FROM session_fact HAVING count(*) > 0""",
    "reidentified_facts": """
        SELECT f.event_id, f.app_customer_id, sha256('late:' || b.email_sha256)
                   AS canonical_customer_id
        FROM activity_fact f
        JOIN bridge b ON b.source_system = 'APP' AND b.source_customer_id = f.app_customer_id
                     AND b.tenant = f.tenant
        WHERE f.tenant = 'tenant-1'
    """,
    "duplicate_emails": """
        SELECT tenant, email_sha256, source_system,
               count(DISTINCT source_customer_id) AS account_count
        FROM claims GROUP BY tenant, email_sha256, source_system
        HAVING count(DISTINCT source_customer_id) > 1
    """,
    "missing_emails": """
        SELECT source_system, tenant, count(*) AS accounts_without_email
        FROM (
            SELECT 'PAM' AS source_system, tenant, email_sha256 FROM pam_labelled
            UNION ALL SELECT 'APP', tenant, email_sha256 FROM app_labelled
        ) WHERE email_sha256 IS NULL GROUP BY source_system, tenant
    """,
    "identity_conflicts": """
        SELECT tenant, 'email_with_two_names' AS conflict, email_sha256 AS subject
        FROM claims GROUP BY tenant, email_sha256 HAVING count(DISTINCT full_name) > 1
        UNION ALL
        SELECT tenant, 'email_with_two_countries', email_sha256
        FROM claims GROUP BY tenant, email_sha256 HAVING count(DISTINCT country) > 1
        UNION ALL
        SELECT tenant, 'account_with_two_emails', source_system || ':' || source_customer_id
        FROM claims GROUP BY tenant, source_system, source_customer_id
        HAVING count(DISTINCT email_sha256) > 1
    """,
    "bridge_with_review": """
        SELECT b.*,
               EXISTS (SELECT 1 FROM claims c WHERE c.tenant = b.tenant
                       AND c.email_sha256 = b.email_sha256
                       GROUP BY c.tenant
                       HAVING count(DISTINCT full_name) > 1 OR count(DISTINCT country) > 1)
               OR EXISTS (SELECT 1 FROM claims c WHERE c.tenant = b.tenant
                          AND c.source_system = b.source_system
                          AND c.source_customer_id = b.source_customer_id
                          GROUP BY c.tenant HAVING count(DISTINCT email_sha256) > 1)
               AS review_flag
        FROM bridge b
    """,
    "identity_match_rate": """
        SELECT tenant, count(*) AS persons,
               count(*) FILTER (pam_accounts > 0 AND app_accounts > 0) AS matched,
               count(*) FILTER (pam_accounts > 0 AND app_accounts = 0) AS pam_only,
               count(*) FILTER (pam_accounts = 0 AND app_accounts > 0) AS app_only,
               count(*) FILTER (pam_accounts > 0 AND app_accounts > 0)::DOUBLE
                   / count(*)::DOUBLE AS match_rate
        FROM persons GROUP BY tenant
    """,
    "app_only": """
        SELECT DISTINCT tenant, source_system, source_customer_id, email_sha256 FROM claims c
        WHERE source_system = 'APP' AND NOT EXISTS (
            SELECT 1 FROM claims o WHERE o.source_system = 'PAM' AND o.tenant = c.tenant
            AND o.email_sha256 = c.email_sha256)
    """,
    "pam_only": """
        SELECT DISTINCT tenant, source_system, source_customer_id, email_sha256 FROM claims c
        WHERE source_system = 'PAM' AND NOT EXISTS (
            SELECT 1 FROM claims o WHERE o.source_system = 'APP' AND o.tenant = c.tenant
            AND o.email_sha256 = c.email_sha256)
    """,
    "pam_session_no_activity": """
        SELECT canonical_customer_id, tenant, full_name, username FROM dim
        WHERE canonical_customer_id IN (SELECT canonical_customer_id FROM session_fact)
          AND canonical_customer_id NOT IN (SELECT canonical_customer_id FROM activity_fact)
    """,
    "active_no_session": """
        SELECT canonical_customer_id, tenant, full_name, username FROM dim
        WHERE canonical_customer_id IN (SELECT canonical_customer_id FROM activity_fact)
          AND canonical_customer_id NOT IN (SELECT canonical_customer_id FROM session_fact)
    """,
    "rejection_rates": """
        SELECT tenant, event_date, rejection_reason, rejected_count, day_rows,
               rejected_count::DOUBLE / day_rows::DOUBLE AS rejection_rate
        FROM (
            SELECT tenant, event_date, rejection_reason, count(*) AS rejected_count,
                   CAST(sum(count(*)) OVER (PARTITION BY tenant, event_date) AS BIGINT) AS day_rows
            FROM (SELECT *, CAST(event_time_ts AS DATE) AS event_date FROM events_labelled)
            GROUP BY tenant, event_date, rejection_reason
        ) WHERE rejection_reason IS NOT NULL
    """,
    "column_profile": "\n UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, "
        f"count(*) FILTER ({c} IS NULL) AS null_count, "
        f"min({c}) AS min_value, max({c}) AS max_value FROM events_typed"
        for c in EVENT_COLUMNS
    ),
    "tenant_manifest_union": """
        SELECT tenant, coalesce(rejection_reason,
                   CASE WHEN tenant = 'tenant-1' AND platform_fee_decimal > 10
                        THEN 'platform_fee_over_limit' END, 'accepted') AS verdict,
               count(*) AS row_count
        FROM events_labelled GROUP BY 1, 2
    """,
    "tenant_rules_labelled": f"""
        SELECT file_tenant, tenant,
               CASE WHEN event_id IS NULL THEN 'missing_event_id'
                    WHEN app_customer_id IS NULL THEN 'missing_app_customer_id'
                    WHEN contains(tenant, ':') THEN 'invalid_tenant'
                    WHEN event_time IS NULL THEN 'missing_event_time'
                    WHEN ({_instant('event_time')}) IS NULL THEN 'invalid_event_time'
                    WHEN net IS NULL THEN 'invalid_net_result_usdt'
                    WHEN fee IS NULL THEN 'invalid_platform_fee_usdt'
                    WHEN fee < 0 THEN 'negative_platform_fee_usdt'
                    WHEN tenant <> file_tenant THEN 'wrong_tenant'
                    WHEN tenant = 'tenant-0' AND fee > 10 THEN 'fee_over_limit'
                    WHEN tenant = 'tenant-0'
                         AND ({_instant('event_time')}) < TIMESTAMP '2024-01-03 00:00:00'
                         THEN 'not_before_event_time'
                    WHEN tenant = 'tenant-1' AND event_type NOT IN ('click', 'purchase', 'view')
                         THEN 'one_of_event_type'
                    WHEN tenant = 'tenant-1' AND net < -75.5 THEN 'min_net_result_usdt'
                    WHEN tenant = 'tenant-1' AND length(app_customer_id) > 6
                         THEN 'max_length_app_customer_id'
                    WHEN tenant = 'tenant-2'
                         AND NOT regexp_full_match(event_id, 'E-[0-9]*[02468]')
                         THEN 'matches_event_id'
                    ELSE 'accepted' END AS verdict,
               count(*) AS row_count
        FROM events_stamped GROUP BY 1, 2, 3
    """,
    "topic_replay_counts": """
        SELECT topic, count(*) AS messages FROM (
            SELECT 'pam_customers' AS topic FROM raw_pam
            UNION ALL SELECT 'app_customers' FROM raw_app
            UNION ALL SELECT 'activity_events' FROM raw_events
            UNION ALL SELECT 'customer_sessions' FROM raw_sessions
        ) GROUP BY ROLLUP (topic)
    """,
    "stream_validate": """
        SELECT event_id, app_customer_id, tenant, event_time, rejection_reason
        FROM events_labelled
    """,
    "stream_dedup": "SELECT DISTINCT event_id, app_customer_id FROM events_good",
    "stream_enrich": """
        SELECT event_id, app_customer_id, tenant, canonical_customer_id FROM activity
    """,
    "stream_sink": f"SELECT {ACTIVITY} FROM activity_fact",
    "stream_sink_batches": f"SELECT {ACTIVITY} FROM activity_fact",
    "stream_late_rows": """
        SELECT (SELECT count(*) FROM events_good) AS arrived,
               (SELECT count(*) FROM late) AS dropped_late,
               (SELECT count(*) FROM (
                   SELECT DISTINCT event_id, app_customer_id FROM in_time
               )) AS kept
        FROM (SELECT 1)
    """,
    "stream_late_rows_kept": f"""
        SELECT 'kept' AS part, count(DISTINCT (event_id, app_customer_id)) AS row_count
        FROM events_good WHERE event_time >= '2024-01-16'
        UNION ALL
        SELECT 'in_time', count(*) FROM events_good WHERE event_time >= '2024-01-16'
        UNION ALL
        SELECT 'late', count(*) FROM events_good WHERE event_time < '2024-01-16'
        UNION ALL
        SELECT 'late_distinct', count(DISTINCT ({', '.join(EVENT_COLUMNS)}))
        FROM events_good WHERE event_time < '2024-01-16'""",
    "stream_daily_fee": f"""
        SELECT event_date, tenant,
               CAST(sum(platform_fee_usdt) AS {MONEY}) AS total_platform_fee_usdt
        FROM activity_fact GROUP BY 1, 2
    """,
    "stream_trigger": KPI_FEE % "activity_fact",
    "stream_fee_by_tenant": KPI_FEE % "activity_fact",
    "stream_daily_active": """
        SELECT CAST(e.event_time_ts AS DATE) AS event_date,
               count(DISTINCT b.canonical_customer_id) AS daily_active_customers
        FROM events_good e
        JOIN bridge b ON b.source_system = 'APP' AND b.source_customer_id = e.app_customer_id
                     AND b.tenant = e.tenant
        GROUP BY 1
    """,
    "event_sessions": SESSIONS_30_MIN,
    "stream_sessions": f"""
        SELECT user_id, session_start, session_end + INTERVAL 30 MINUTE AS session_end, event_count
        FROM ({SESSIONS_30_MIN})
        WHERE session_end + INTERVAL 30 MINUTE
              <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM events)
    """,
    "customer_activity_sessions": """
        SELECT canonical_customer_id, min(event_time) AS session_start,
               max(event_time) AS session_end, count(*) AS event_count,
               CAST(sum(net_result_usdt) AS DECIMAL(38,18)) AS net_result_usdt
        FROM (
            SELECT *, sum(opens) OVER (PARTITION BY canonical_customer_id
                                       ORDER BY event_time, event_id
                                       ROWS UNBOUNDED PRECEDING) AS session_no
            FROM (
                SELECT *, CASE WHEN event_time - lag(event_time) OVER (
                                        PARTITION BY canonical_customer_id
                                        ORDER BY event_time, event_id)
                                    <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS opens
                FROM activity_fact
            )
        ) GROUP BY canonical_customer_id, session_no
    """,
    "compat_events_rejected": """
        SELECT event_id, app_customer_id, tenant, event_type, event_time, net_result_usdt,
               platform_fee_usdt, net_result_decimal, platform_fee_decimal, rejection_reason
        FROM c_events_labelled WHERE rejection_reason IS NOT NULL
    """,
    "compat_events_valid": "SELECT * EXCLUDE (event_time_ts) FROM c_events_unique",
    "compat_dim_customer": "SELECT * FROM c_dim",
    "compat_identity_bridge": "SELECT * FROM c_bridge",
    "compat_fact_activity": f"SELECT {ACTIVITY} FROM c_activity",
    "compat_fact_sessions": f"SELECT {SESSION} FROM c_session",
    "compat_kpi_fee_by_tenant": KPI_FEE % "c_activity",
    "compat_kpi_top_customers": KPI_TOP % "c_activity",
    "compat_kpi_daily_active": KPI_DAILY % "c_activity",
}

# Two arrivals: the second half of January first, then the first half.
STEPS["watermark"] = """
    SELECT max(event_time_ts) - INTERVAL 1 DAY AS at FROM events_good
    WHERE event_time_ts >= TIMESTAMP '2024-01-16'
"""
STEPS["late"] = """
    SELECT e.* FROM events_good e, watermark w
    WHERE e.event_time_ts < TIMESTAMP '2024-01-16' AND e.event_time_ts <= w.at
"""
STEPS["in_time"] = """
    SELECT e.* FROM events_good e, watermark w
    WHERE e.event_time_ts >= TIMESTAMP '2024-01-16' OR e.event_time_ts > w.at
"""


def _needed(sql: str, found: list[str]) -> list[str]:
    """Steps ``sql`` mentions, each after the steps it reads itself."""
    for name, body in STEPS.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(body, found)
            if name not in found:
                found.append(name)
    return found


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, sql in CHECKS.items():
        steps = _needed(sql, [])
        clause = ",\n".join(f"{s} AS ({STEPS[s]})" for s in steps)
        out[name] = f"WITH {clause}\n{sql}" if steps else sql
    return out
