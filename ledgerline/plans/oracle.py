"""Independent DuckDB SQL for every SQL-expressible query.

Each statement starts from the given test tables (views ``lineitem orders
customer supplier events``), applies the same raw mapping as
:mod:`ledgerline.sources.testdata`, and recomputes silver, gold and the reports
in plain SQL. Ratios that the lake rounds half up are computed here as exact
integer quotients, ``(2*a*10^k + b) // (2*b)``, because DuckDB divides
decimals as doubles; money is handled in integer ten-thousandths for the same
reason. Output column names and types match the Spark queries.
"""

from __future__ import annotations


def _half_up(num: str, den: str, scale: int, out: str) -> str:
    """Exact ROUND(num/den, scale) of non-negative integers, typed ``out``."""
    if scale == 0:
        return f"CAST((2 * CAST({num} AS HUGEINT) + {den}) // (2 * CAST({den} AS HUGEINT)) AS {out})"
    unit = "0." + "0" * (scale - 1) + "1"
    return (
        f"CAST(CAST((2 * CAST({num} AS HUGEINT) * {10 ** scale} + {den}) // (2 * CAST({den} AS HUGEINT)) "
        f"AS DECIMAL(38,0)) * CAST('{unit}' AS DECIMAL({scale + 1},{scale})) AS {out})"
    )


def _pct(num: str, den: str) -> str:
    """ROUND(num / NULLIF(den, 0) * 100, 2) of counts, exact, DECIMAL(20,2)."""
    return f"CASE WHEN {den} <> 0 THEN {_half_up(f'({num}) * 100', den, 2, 'DECIMAL(20,2)')} END"


def _money_units(x: str) -> str:
    return f"CAST({x} * 10000 AS HUGEINT)"


def _round2(x: str) -> str:
    return f"CAST(ROUND({x}, 2) AS DECIMAL(20,2))"


def _iso(ts: str, fmt: str = "%Y-%m-%dT%H:%M:%S") -> str:
    return f"strftime({ts}, '{fmt}') || '+00:00'"


def _utc(s: str) -> str:
    return f"timezone('UTC', TRY_CAST({s} AS TIMESTAMPTZ))"


RAW = f"""
o_lines AS (
    SELECT l_orderkey AS ok, l_linenumber AS ln, min(l_suppkey) AS sk,
           sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS amt
    FROM lineitem GROUP BY l_orderkey, l_linenumber
),
o_pay_k AS (
    SELECT li.ok, li.ln, li.sk,
           o.o_orderdate + li.ln * INTERVAL 1 HOUR AS created_ts,
           'p_' || li.ok || '_' || li.ln AS payment_id,
           CASE WHEN o.o_custkey % 97 = 3 THEN 'cx_' ELSE 'c_' END || o.o_custkey AS customer_id,
           CASE WHEN li.sk % 41 = 9 THEN 'mx_' ELSE 'm_' END || li.sk AS merchant_id,
           CAST(li.amt AS DOUBLE) AS amount,
           CASE WHEN (li.ok + li.ln) % 20 < 1 THEN 'CLP' WHEN (li.ok + li.ln) % 20 < 3 THEN 'EUR'
                WHEN (li.ok + li.ln) % 20 < 5 THEN 'MXN' WHEN (li.ok + li.ln) % 20 < 8 THEN 'BRL'
                WHEN (li.ok + li.ln) % 20 < 14 THEN 'ARS' ELSE 'USD' END AS currency,
           CASE WHEN (li.ok * 31 + li.ln * 17) % 100 < 82 THEN 'captured'
                WHEN (li.ok * 31 + li.ln * 17) % 100 < 94 THEN 'refused'
                WHEN (li.ok * 31 + li.ln * 17) % 100 < 98 THEN 'refunded' ELSE 'pending' END AS status,
           CASE WHEN (li.ok + li.ln * 3) % 20 < 11 THEN 'card' WHEN (li.ok + li.ln * 3) % 20 < 16 THEN 'wallet'
                WHEN (li.ok + li.ln * 3) % 20 < 19 THEN 'bank_transfer' ELSE 'crypto' END AS method
    FROM o_lines li JOIN orders o ON o.o_orderkey = li.ok
),
o_raw_payments AS (
    SELECT payment_id, customer_id, merchant_id, amount, currency, status,
           {_iso('created_ts')} AS created_at,
           {_iso('created_ts + ((ok * 7 + ln) % 720) * INTERVAL 1 MINUTE')} AS updated_at,
           method
    FROM o_pay_k
),
o_raw_chargebacks AS (
    SELECT payment_id,
           ['FRAUD', 'DISPUTED', 'NOT_RECEIVED', 'DUPLICATE'][ok % 4 + 1] AS reason_code,
           {_iso('created_ts + (5 + ok % 26) * INTERVAL 1 DAY')} AS filed_at
    FROM o_pay_k
    WHERE (ok * 13 + ln) % 25 = 0 AND sk % 4 <> 0 AND status IN ('captured', 'refunded')
),
o_raw_customers AS (
    SELECT 'c_' || c_custkey AS customer_id,
           CAST(DATE '1995-01-01' + CAST((c_custkey * 37) % 900 AS INTEGER) AS VARCHAR) AS signup_date,
           ['AR', 'US', 'BR', 'MX', 'CL', 'ES'][c_nationkey % 6 + 1] AS country,
           c_mktsegment AS marketing_channel
    FROM customer
),
o_raw_merchants AS (
    SELECT 'm_' || s_suppkey AS merchant_id,
           ['retail', 'groceries', 'crypto', 'gaming', 'travel', 'saas', 'digital_content'][s_suppkey % 7 + 1] AS category,
           ['low', 'medium', 'high'][s_suppkey % 3 + 1] AS risk_level,
           {_iso("CAST(DATE '1995-01-01' + CAST((s_suppkey * 11) % 900 AS INTEGER) AS TIMESTAMP)")} AS created_at
    FROM supplier
),
o_raw_fx AS (
    SELECT CAST(DATE '1995-01-01' + CAST(r.d AS INTEGER) AS VARCHAR) AS date, q.ccy AS from_ccy, 'USD' AS to_ccy,
           CAST((q.base * (950 + (r.d * 7 + q.idx * 13) % 101)) // 1000 AS DOUBLE) / 1000000 AS rate
    FROM range(0, (DATE '2001-12-31' - DATE '1995-01-01') + 1) r(d),
         (VALUES (0, 'USD', 1000000), (1, 'ARS', 1200), (2, 'BRL', 200000), (3, 'MXN', 58000), (4, 'EUR', 1080000))
             q(idx, ccy, base)
),
o_raw_blacklist AS (
    SELECT 'c_' || c_custkey AS customer_id, '2001-12-31T23:59:59+00:00' AS blacklist_updated_at
    FROM customer WHERE c_custkey % 50 = 7
),
o_ev AS (
    SELECT event_id AS _id, ts AS _ts, 'e_' || event_id AS event_id, 'c_' || user_id AS customer_id,
           CASE event_type WHEN 'click' THEN 'login' WHEN 'view' THEN 'login' WHEN 'error' THEN 'failed_pin'
                WHEN 'purchase' THEN 'password_reset' WHEN 'signup' THEN 'kyc_submit' END AS type,
           {_iso('ts', '%Y-%m-%dT%H:%M:%S.%f')} AS event_ts
    FROM events
),
o_raw_events AS (SELECT event_id, customer_id, type, event_ts FROM o_ev),
o_stream AS (
    SELECT CASE WHEN _id % 5 = 0 THEN 'es_' || _id ELSE event_id END AS event_id, customer_id, type, event_ts,
           _ts + INTERVAL 2 SECOND AS kafka_ts
    FROM o_ev
)"""

def _double_to_decimal(x: str, target: str) -> str:
    """Spark converts a double to a decimal through its shortest decimal text and
    rounds that half up; DuckDB's direct cast rounds the exact binary value
    (4.15415 -> 4.1541 instead of 4.1542), so the oracle goes through text."""
    return f"TRY_CAST(CAST({x} AS VARCHAR) AS {target})"


CLEAN = f"""
o_customers AS (
    SELECT customer_id, TRY_CAST(signup_date AS DATE) AS signup_date, country, marketing_channel FROM o_raw_customers
),
o_merchants AS (
    SELECT merchant_id, category, risk_level, {_utc('created_at')} AS created_at FROM o_raw_merchants
),
o_payments AS (
    SELECT payment_id, customer_id, merchant_id, {_double_to_decimal('amount', 'DECIMAL(18,4)')} AS amount_original,
           currency, status, method,
           {_utc('created_at')} AS created_at_utc, {_utc('updated_at')} AS updated_at_utc
    FROM o_raw_payments
),
o_chargebacks AS (SELECT payment_id, reason_code, {_utc('filed_at')} AS filed_at FROM o_raw_chargebacks),
o_fx AS (
    SELECT TRY_CAST(date AS DATE) AS date, from_ccy, to_ccy, {_double_to_decimal('rate', 'DECIMAL(18,6)')} AS rate
    FROM o_raw_fx
),
o_events_batch AS (
    SELECT event_id, customer_id, type, {_utc('event_ts')} AS event_ts FROM o_raw_events
),
o_denylist AS (SELECT DISTINCT customer_id FROM o_raw_blacklist)"""

SILVER = """
o_fk AS (
    SELECT p.*, c.signup_date
    FROM o_payments p
    JOIN o_customers c ON c.customer_id = p.customer_id
    JOIN (SELECT merchant_id FROM o_merchants) m ON m.merchant_id = p.merchant_id
),
o_valid AS (
    SELECT * EXCLUDE (signup_date) FROM o_fk WHERE CAST(created_at_utc AS DATE) >= signup_date
),
o_priced AS (
    SELECT v.*, fx.rate AS fx_rate_to_usd,
           CAST(CAST(v.amount_original AS DECIMAL(28,4)) * CAST(fx.rate AS DECIMAL(10,6)) AS DECIMAL(18,4)) AS amount_usd
    FROM o_valid v
    JOIN o_fx fx ON fx.to_ccy = 'USD' AND fx.date = CAST(v.created_at_utc AS DATE) AND fx.from_ccy = v.currency
),
o_silver_payments AS (
    SELECT p.payment_id, p.customer_id, p.merchant_id, p.amount_original, p.currency, p.status, p.method,
           p.created_at_utc, p.updated_at_utc, p.fx_rate_to_usd, p.amount_usd,
           cb.reason_code AS chargeback_reason_code, cb.filed_at AS chargeback_filed_at,
           cb.reason_code IS NOT NULL AS has_chargeback
    FROM o_priced p LEFT JOIN o_chargebacks cb ON cb.payment_id = p.payment_id
),
o_silver_customers AS (
    SELECT c.customer_id, c.signup_date, c.country, c.marketing_channel,
           d.customer_id IS NOT NULL AS is_blacklisted,
           CAST(date_trunc('month', c.signup_date) AS DATE) AS cohort_month
    FROM o_customers c LEFT JOIN o_denylist d ON d.customer_id = c.customer_id
)"""

GOLD = f"""
o_dim_customer AS (
    SELECT customer_id, signup_date, country, marketing_channel, cohort_month, is_blacklisted FROM o_silver_customers
),
o_dim_merchant AS (SELECT merchant_id, category, risk_level, created_at FROM o_merchants),
o_fct AS (
    SELECT payment_id, customer_id, merchant_id, CAST(created_at_utc AS DATE) AS date_key, amount_original,
           currency, fx_rate_to_usd, amount_usd, status, method, created_at_utc, updated_at_utc,
           has_chargeback, chargeback_reason_code, chargeback_filed_at
    FROM o_silver_payments
),
o_dim_date AS (
    SELECT CAST(d AS DATE) AS date_key,
           CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
           CAST(month(d) AS SMALLINT) AS month, monthname(d) AS month_name,
           CAST(day(d) AS SMALLINT) AS day, CAST(isodow(d) - 1 AS SMALLINT) AS day_of_week,
           dayname(d) AS day_name, CAST(weekofyear(d) AS SMALLINT) AS week_of_year,
           dayofweek(d) IN (0, 6) AS is_weekend
    FROM (SELECT unnest(generate_series(min(date_key), max(date_key), INTERVAL 1 DAY)) AS d FROM o_fct)
    WHERE d IS NOT NULL
),
o_kpi_base AS (
    SELECT date_key, count(*) AS total, count(*) FILTER (WHERE status = 'captured') AS cap,
           count(*) FILTER (WHERE status = 'refused') AS refused,
           count(*) FILTER (WHERE status = 'refunded') AS refunded,
           sum(amount_usd) AS gross, sum(CASE WHEN status = 'captured' THEN amount_usd ELSE 0 END) AS capvol,
           count(DISTINCT customer_id) AS uc, count(DISTINCT merchant_id) AS um,
           count(*) FILTER (WHERE has_chargeback) AS cb
    FROM o_fct GROUP BY date_key
),
o_kpis AS (
    SELECT date_key, CAST(total AS INTEGER) AS total_payments, CAST(cap AS INTEGER) AS captured_payments,
           CAST(refused AS INTEGER) AS refused_payments, CAST(refunded AS INTEGER) AS refunded_payments,
           {_half_up('cap', 'total', 5, 'DECIMAL(6,5)')} AS auth_rate,
           CASE WHEN cap > 0 THEN TRY_CAST({_half_up('cb', 'cap', 5, 'DECIMAL(38,5)')} AS DECIMAL(6,5))
                ELSE CAST(0 AS DECIMAL(6,5)) END AS chargeback_rate,
           CAST(gross AS DECIMAL(18,4)) AS gross_volume_usd, CAST(capvol AS DECIMAL(18,4)) AS captured_volume_usd,
           CAST(uc AS INTEGER) AS unique_customers, CAST(um AS INTEGER) AS unique_merchants
    FROM o_kpi_base
),
o_cohort_base AS (
    SELECT c.cohort_month,
           CAST((year(p.date_key) - year(c.cohort_month)) * 12 + (month(p.date_key) - month(c.cohort_month))
                AS SMALLINT) AS months_since_signup,
           count(DISTINCT p.customer_id) AS active, sum(p.amount_usd) AS total
    FROM o_fct p JOIN o_dim_customer c ON c.customer_id = p.customer_id
    WHERE p.status = 'captured'
    GROUP BY 1, 2
),
o_cohort AS (
    SELECT cohort_month, months_since_signup, CAST(active AS INTEGER) AS active_customers,
           CAST(total AS DECIMAL(18,4)) AS total_ltv_usd,
           {_half_up(_money_units('total'), 'active', 0, 'HUGEINT')} AS _avg_units
    FROM o_cohort_base
),
o_agg_cohort_ltv AS (
    SELECT cohort_month, months_since_signup, active_customers, total_ltv_usd,
           CAST(CAST(_avg_units AS DECIMAL(38,0)) * CAST('0.0001' AS DECIMAL(5,4)) AS DECIMAL(18,4)) AS avg_ltv_usd
    FROM o_cohort
),
o_merchant_stats AS (
    SELECT m.merchant_id, m.category, m.risk_level, count(*) AS total_payments,
           count(*) FILTER (WHERE p.status = 'captured') AS captured_payments,
           count(*) FILTER (WHERE p.has_chargeback) AS chargebacks,
           sum(p.amount_usd) AS gross_volume_usd
    FROM o_fct p JOIN o_dim_merchant m ON m.merchant_id = p.merchant_id
    GROUP BY m.merchant_id, m.category, m.risk_level
),
o_customer_risk_stats AS (
    SELECT p.customer_id, count(*) AS total_payments,
           count(*) FILTER (WHERE p.has_chargeback) AS chargebacks,
           CAST(sum(p.amount_usd) AS DECIMAL(28,4)) AS total_volume_usd,
           CAST(sum(CASE WHEN m.risk_level = 'high' OR m.category IN ('crypto', 'gaming') THEN p.amount_usd ELSE 0 END)
               AS DECIMAL(28,4)) AS risky_volume_usd
    FROM o_fct p JOIN o_dim_merchant m ON m.merchant_id = p.merchant_id
    GROUP BY p.customer_id
),
o_cohort_size AS (
    SELECT cohort_month, count(*) AS cohort_customers FROM o_dim_customer GROUP BY cohort_month
)"""

PREFIX = "WITH" + RAW + "," + CLEAN + "," + SILVER + "," + GOLD + "\n"


def _q(body: str) -> str:
    return PREFIX + body


_CHARGEBACK_RATE_PCT = _pct("chargebacks", "captured_payments")

_RISKY_PCT = (
    "CASE WHEN s.total_volume_usd <> 0 THEN "
    + _half_up(
        f"{_money_units('s.risky_volume_usd')} * 100",
        _money_units("s.total_volume_usd"),
        2,
        "DECIMAL(20,2)",
    )
    + " END"
)

_DROP_FLAGS = """
o_flagged AS (
    SELECT p.*, c.signup_date, c.customer_id IS NOT NULL AS has_c, m.merchant_id IS NOT NULL AS has_m,
           fx.rate AS fx_rate, CAST(p.created_at_utc AS DATE) AS day
    FROM o_payments p
    LEFT JOIN o_customers c ON c.customer_id = p.customer_id
    LEFT JOIN (SELECT merchant_id FROM o_merchants) m ON m.merchant_id = p.merchant_id
    LEFT JOIN o_fx fx ON fx.to_ccy = 'USD' AND fx.date = CAST(p.created_at_utc AS DATE) AND fx.from_ccy = p.currency
),
o_rules AS (
    SELECT NOT has_c AS orphan_customer,
           has_c AND NOT has_m AS orphan_merchant,
           has_c AND has_m AND (day IS NULL OR signup_date IS NULL) AS null_date,
           has_c AND has_m AND day < signup_date AS pre_signup,
           has_c AND has_m AND day >= signup_date AND fx_rate IS NULL AS missing_fx
    FROM o_flagged
)
"""


def _dq(suite: str, checks: list[tuple[str, str, str]], table: str) -> str:
    """checks: (expectation, column, unexpected-row predicate or 'UNIQUE')."""
    parts = []
    for pos, (expectation, column, predicate) in enumerate(checks, start=1):
        if predicate == "UNIQUE":
            count = (
                f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {table} "
                f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1))"
            )
        else:
            count = f"(SELECT count(*) FROM {table} WHERE {predicate})"
        parts.append(
            f"SELECT '{suite}' AS suite, {pos} AS position, '{expectation}' AS expectation, "
            f"'{column}' AS column_name, CAST({count} AS BIGINT) AS unexpected_count"
        )
    return _q(
        "SELECT suite, position, expectation, column_name, unexpected_count, unexpected_count = 0 AS success "
        "FROM (" + " UNION ALL ".join(parts) + ")"
    )


_CCY = "('USD', 'ARS', 'BRL', 'MXN', 'EUR')"
_STATUS = "('captured', 'refused', 'refunded', 'pending')"
_METHOD = "('card', 'wallet', 'bank_transfer', 'crypto')"


def _nn(c: str) -> tuple[str, str, str]:
    return ("not_null", c, f"{c} IS NULL")


def _in(c: str, domain: str) -> tuple[str, str, str]:
    return ("in_set", c, f"{c} IS NOT NULL AND {c} NOT IN {domain}")


def _min(c: str, lo: str) -> tuple[str, str, str]:
    return ("between", c, f"{c} IS NOT NULL AND {c} < {lo}")


DQ_BRONZE = _dq(
    "bronze_payments",
    [
        _nn("payment_id"),
        ("unique", "payment_id", "UNIQUE"),
        _nn("customer_id"),
        _nn("merchant_id"),
        _in("currency", _CCY),
        _in("status", _STATUS),
        _in("method", _METHOD),
        ("between", "amount", "amount IS NOT NULL AND (amount < 0.01 OR amount > 100000)"),
    ],
    "o_raw_payments",
)

DQ_SILVER = _dq(
    "silver_payments",
    [
        _nn("payment_id"),
        ("unique", "payment_id", "UNIQUE"),
        _nn("customer_id"),
        _nn("merchant_id"),
        _nn("created_at_utc"),
        _nn("amount_usd"),
        _in("currency", _CCY),
        _in("status", _STATUS),
        _min("amount_original", "0.01"),
        _min("amount_usd", "0.000001"),
        _min("fx_rate_to_usd", "0.000001"),
    ],
    "o_silver_payments",
)

DQ_GOLD = _dq(
    "gold_fct_payments",
    [
        _nn("payment_id"),
        ("unique", "payment_id", "UNIQUE"),
        _nn("customer_id"),
        _nn("merchant_id"),
        _nn("date_key"),
        _in("status", _STATUS),
        _min("amount_usd", "0.000001"),
    ],
    "o_fct",
)


ORACLE_SQL: dict[str, str] = {
    # ---- silver ----
    "denylist_explode": _q("SELECT customer_id, blacklist_updated_at FROM o_raw_blacklist"),
    "denylist_distinct": _q("SELECT customer_id FROM o_denylist"),
    "clean_customers": _q("SELECT * FROM o_customers"),
    "clean_merchants": _q("SELECT * FROM o_merchants"),
    "clean_payments": _q("SELECT * FROM o_payments"),
    "clean_chargebacks": _q("SELECT * FROM o_chargebacks"),
    "clean_events": _q("SELECT * FROM o_events_batch"),
    "fk_payments": _q("SELECT * FROM o_fk"),
    "filter_pre_signup": _q("SELECT * FROM o_valid"),
    "price_usd": _q("SELECT * FROM o_priced"),
    "enrich_customers": _q("SELECT * FROM o_silver_customers"),
    "enrich_payments": _q("SELECT * FROM o_silver_payments"),
    "drop_report": PREFIX.rstrip() + ",\n" + _DROP_FLAGS + """
SELECT 1 AS step, 'orphan_customer' AS rule, count(*) FILTER (WHERE orphan_customer) AS dropped FROM o_rules
UNION ALL SELECT 2, 'orphan_merchant', count(*) FILTER (WHERE orphan_merchant) FROM o_rules
UNION ALL SELECT 3, 'null_date', count(*) FILTER (WHERE null_date) FROM o_rules
UNION ALL SELECT 4, 'pre_signup', count(*) FILTER (WHERE pre_signup) FROM o_rules
UNION ALL SELECT 5, 'missing_fx', count(*) FILTER (WHERE missing_fx) FROM o_rules""",
    "events_union_dedupe": _q(
        f"""SELECT event_id, customer_id, type, {_utc('event_ts')} AS event_ts FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY src, event_ts, customer_id, type) AS rn
    FROM (SELECT event_id, customer_id, type, event_ts, 0 AS src FROM o_raw_events
          UNION ALL SELECT event_id, customer_id, type, event_ts, 1 AS src FROM o_stream)
    WHERE event_id IS NOT NULL
) WHERE rn = 1"""
    ),
    "events_batch_only": _q("SELECT * FROM o_events_batch"),
    "stream_parse": _q("SELECT event_id, customer_id, type, event_ts, kafka_ts FROM o_stream"),
    # ---- gold ----
    "dim_customer": _q("SELECT * FROM o_dim_customer"),
    "dim_merchant": _q("SELECT * FROM o_dim_merchant"),
    "dim_date": _q("SELECT * FROM o_dim_date"),
    "fct_payments": _q("SELECT * FROM o_fct"),
    "agg_daily_kpis": _q("SELECT * FROM o_kpis"),
    "agg_cohort_ltv": _q("SELECT * FROM o_agg_cohort_ltv"),
    "merchant_stats": _q("SELECT * FROM o_merchant_stats"),
    "customer_risk_stats": _q("SELECT * FROM o_customer_risk_stats"),
    "cohort_size": _q("SELECT * FROM o_cohort_size"),
    # ---- reports ----
    "auth_rate_daily": _q(
        f"""SELECT date_key, total_payments, captured_payments,
       {_round2('auth_rate * 100')} AS auth_rate_pct,
       {_round2('chargeback_rate * 100')} AS chargeback_rate_pct,
       {_round2('gross_volume_usd')} AS gross_volume_usd,
       {_round2('captured_volume_usd')} AS captured_volume_usd,
       unique_customers, unique_merchants
FROM o_kpis ORDER BY date_key"""
    ),
    "chargeback_rate_by_merchant": _q(
        f"""SELECT merchant_id, category, risk_level, total_payments, captured_payments, chargebacks,
       {_round2('gross_volume_usd')} AS gross_volume_usd,
       {_CHARGEBACK_RATE_PCT} AS chargeback_rate_pct
FROM o_merchant_stats
WHERE captured_payments > 20
ORDER BY chargebacks / NULLIF(captured_payments, 0) DESC NULLS LAST, merchant_id
LIMIT 20"""
    ),
    "high_risk_merchants": _q(
        f"""SELECT merchant_id, category, risk_level, total_payments, chargebacks,
       {_CHARGEBACK_RATE_PCT} AS chargeback_rate_pct,
       {_round2('gross_volume_usd')} AS gross_volume_usd,
       risk_level = 'high' AS flag_risk_high,
       category IN ('crypto', 'gaming') AS flag_category_risky,
       CASE WHEN captured_payments > 0 THEN chargebacks * 50 > captured_payments END AS flag_chargeback_over_2pct
FROM o_merchant_stats
WHERE risk_level = 'high' OR category IN ('crypto', 'gaming')
   OR (CASE WHEN captured_payments > 0 THEN chargebacks * 50 > captured_payments END)
ORDER BY chargebacks / NULLIF(captured_payments, 0) DESC NULLS LAST, gross_volume_usd DESC, merchant_id"""
    ),
    "fraud_signals": _q(
        f"""SELECT *, CAST(signal_blacklist AS INTEGER) + CAST(signal_multi_chargeback AS INTEGER)
              + CAST(signal_risky_merchants AS INTEGER) AS signals_triggered
FROM (
    SELECT c.customer_id, c.country, c.cohort_month, s.total_payments, s.chargebacks,
           {_round2('s.total_volume_usd')} AS total_volume_usd,
           {_RISKY_PCT} AS risky_volume_pct,
           c.is_blacklisted AS signal_blacklist,
           s.chargebacks >= 2 AS signal_multi_chargeback,
           CASE WHEN s.total_volume_usd > 0 THEN s.risky_volume_usd * 10 > s.total_volume_usd * 3 END
               AS signal_risky_merchants
    FROM o_customer_risk_stats s JOIN o_dim_customer c ON c.customer_id = s.customer_id
)
WHERE signal_blacklist OR signal_multi_chargeback OR signal_risky_merchants
ORDER BY signals_triggered DESC NULLS FIRST, total_volume_usd DESC NULLS FIRST, customer_id
LIMIT 50"""
    ),
    "ltv_by_cohort": _q(
        f"""SELECT a.cohort_month, cs.cohort_customers, a.months_since_signup, a.active_customers,
       {_pct('a.active_customers', 'cs.cohort_customers')} AS retention_pct,
       {_round2('a.total_ltv_usd')} AS total_ltv_usd,
       {_round2('a.avg_ltv_usd')} AS avg_ltv_usd
FROM o_agg_cohort_ltv a JOIN o_cohort_size cs ON cs.cohort_month = a.cohort_month
ORDER BY a.cohort_month, a.months_since_signup"""
    ),
    # ---- quality ----
    "dq_bronze_payments": DQ_BRONZE,
    "dq_silver_payments": DQ_SILVER,
    "dq_gold_fct_payments": DQ_GOLD,
}


# ---- Gold constraint report ------------------------------------------------------

_GOLD_VIEWS = {
    "dim_customer": (
        "o_dim_customer",
        ["customer_id", "signup_date", "country", "marketing_channel", "cohort_month", "is_blacklisted"],
    ),
    "dim_merchant": ("o_dim_merchant", ["merchant_id", "category", "risk_level", "created_at"]),
    "dim_date": (
        "o_dim_date",
        ["date_key", "year", "quarter", "month", "month_name", "day", "day_of_week", "day_name",
         "week_of_year", "is_weekend"],
    ),
    "fct_payments": (
        "o_fct",
        ["payment_id", "customer_id", "merchant_id", "date_key", "amount_original", "currency",
         "fx_rate_to_usd", "amount_usd", "status", "method", "created_at_utc", "updated_at_utc",
         "has_chargeback", "chargeback_reason_code", "chargeback_filed_at"],
    ),
    "agg_daily_kpis": (
        "o_kpis",
        ["date_key", "total_payments", "captured_payments", "refused_payments", "refunded_payments",
         "auth_rate", "chargeback_rate", "gross_volume_usd", "captured_volume_usd", "unique_customers",
         "unique_merchants"],
    ),
    "agg_cohort_ltv": (
        "o_agg_cohort_ltv",
        ["cohort_month", "months_since_signup", "active_customers", "total_ltv_usd", "avg_ltv_usd"],
    ),
}


def _constraint_sql() -> str:
    from ledgerline.operators.quality import CHECKS, FOREIGN_KEYS, NULLABLE, PRIMARY_KEYS, VARCHAR

    parts = []

    def row(table: str, kind: str, name: str, count: str) -> None:
        parts.append(
            f"SELECT '{table}' AS table_name, '{kind}' AS kind, '{name.replace(chr(39), chr(39) * 2)}' AS constraint_name, "
            f"CAST(({count}) AS BIGINT) AS violations"
        )

    for table, (view, cols) in _GOLD_VIEWS.items():
        for c in cols:
            if c not in NULLABLE.get(table, set()):
                row(table, "not_null", f"not_null({c})", f"SELECT count(*) FROM {view} WHERE {c} IS NULL")
        for cond in CHECKS.get(table, []):
            row(table, "check", f"check({cond})", f"SELECT count(*) FROM {view} WHERE NOT ({cond})")
        for c, n in VARCHAR.get(table, {}).items():
            row(table, "varchar", f"varchar({c},{n})", f"SELECT count(*) FROM {view} WHERE length({c}) > {n}")
        pk = PRIMARY_KEYS[table]
        keys = ", ".join(pk)
        not_null = " AND ".join(f"{k} IS NOT NULL" for k in pk)
        row(
            table,
            "primary_key",
            f"unique({','.join(pk)})",
            f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {view} WHERE {not_null} "
            f"GROUP BY {keys} HAVING count(*) > 1)",
        )
    for child, key, parent, parent_key in FOREIGN_KEYS:
        cview, pview = _GOLD_VIEWS[child][0], _GOLD_VIEWS[parent][0]
        row(
            child,
            "foreign_key",
            f"fk({key}->{parent}.{parent_key})",
            f"SELECT count(*) FROM {cview} c WHERE c.{key} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {pview} p WHERE p.{parent_key} = c.{key})",
        )
    return _q("\nUNION ALL ".join(parts))


ORACLE_SQL["constraint_report"] = _constraint_sql()


# ---- I/O jobs: what they write and read back equals the mapped data -----------------

ORACLE_SQL.update(
    {
        "scan_csv": _q("SELECT * FROM o_raw_payments"),
        "scan_jsonl": _q("SELECT * FROM o_raw_events"),
        "silver_snapshot": _q("SELECT * FROM o_customers"),
        "silver_refresh": _q("SELECT * FROM o_silver_payments"),
        "gold_refresh": _q("SELECT *, CAST(date_trunc('month', date_key) AS DATE) AS date_month FROM o_fct"),
        "stream_land": _q("SELECT event_id, customer_id, type, event_ts, kafka_ts FROM o_stream"),
        "bronze_ingest": _q(
            """SELECT 'customers' AS table_name, count(*) AS rows FROM o_raw_customers
UNION ALL SELECT 'merchants', count(*) FROM o_raw_merchants
UNION ALL SELECT 'payments', count(*) FROM o_raw_payments
UNION ALL SELECT 'chargebacks', count(*) FROM o_raw_chargebacks
UNION ALL SELECT 'fx_rates', count(*) FROM o_raw_fx
UNION ALL SELECT 'events', count(*) FROM o_raw_events
UNION ALL SELECT 'blacklist', count(*) FROM o_raw_blacklist"""
        ),
        "bronze_partition_overwrite": _q(
            """SELECT d.dt, p.rows, p.payment_ids
FROM (VALUES ('2001-12-30'), ('2001-12-31')) d(dt),
     (SELECT count(*) AS rows, count(DISTINCT payment_id) AS payment_ids FROM o_raw_payments) p"""
        ),
    }
)


# ---- Whole jobs: rows and digests of every table they write -------------------------

_REJECT_COLUMNS = "payment_id customer_id merchant_id amount_original currency status method created_at_utc updated_at_utc outcome"
_REJECTS = f"""SELECT {', '.join(_REJECT_COLUMNS.split())} FROM (
    SELECT p.*, CASE WHEN c.customer_id IS NULL THEN 'orphan_customer'
                     WHEN m.merchant_id IS NULL THEN 'orphan_merchant'
                     WHEN p.created_at_utc IS NULL OR c.signup_date IS NULL THEN 'null_date'
                     WHEN CAST(p.created_at_utc AS DATE) < c.signup_date THEN 'pre_signup'
                     WHEN fx.rate IS NULL THEN 'missing_fx' END AS outcome
    FROM o_payments p
    LEFT JOIN o_customers c ON c.customer_id = p.customer_id
    LEFT JOIN o_merchants m ON m.merchant_id = p.merchant_id
    LEFT JOIN o_fx fx ON fx.to_ccy = 'USD' AND fx.date = CAST(p.created_at_utc AS DATE) AND fx.from_ccy = p.currency
) WHERE outcome IS NOT NULL"""
ORACLE_SQL["silver_rejects"] = _q(_REJECTS)
_EVENTS = ORACLE_SQL["events_union_dedupe"].removeprefix(PREFIX)
_TIMES = {"created_at_utc", "updated_at_utc", "filed_at", "event_ts", "chargeback_filed_at"}


def _digest(table: str, view: str, columns: str | list[str], times: set[str] = _TIMES) -> str:
    """Rows of a view, and the sum of the first 32 bits of the MD5 of each row (columns by name, ``|`` between, ``~`` for NULL)."""
    names = columns.split() if isinstance(columns, str) else columns

    def text(c: str) -> str:
        value = f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')" if c in times else f"CAST({c} AS VARCHAR)"
        return f"coalesce({value}, '~')"

    row = " || '|' || ".join(map(text, sorted(names)))
    return (
        f"SELECT '{table}' AS table_name, count(*) AS rows, "
        f"CAST(coalesce(sum(CAST('0x' || substr(md5({row}), 1, 8) AS BIGINT)), 0) AS BIGINT) AS digest FROM {view}"
    )


def _digests(*parts: str) -> str:
    return _q("\nUNION ALL ".join(parts))


_MONEY_RAW = "CAST(amount AS DECIMAL(24,6)) AS amount"
ORACLE_SQL.update(
    {
        "events_incremental": ORACLE_SQL["events_union_dedupe"],
        "gold_incremental": _q(
            """SELECT *, CAST(date_trunc('month', date_key) AS DATE) AS date_month,
       CASE WHEN date_trunc('month', date_key) = DATE '1997-03-01' THEN 2 ELSE 1 END AS written_by
FROM o_fct"""
        ),
        "cohort_ltv_incremental": _q("SELECT *, 2 AS merged_refreshes FROM o_agg_cohort_ltv"),
        "bronze_tables": _digests(
            _digest("customers", "o_raw_customers", "customer_id signup_date country marketing_channel"),
            _digest("merchants", "o_raw_merchants", "merchant_id category risk_level created_at"),
            _digest(
                "payments",
                f"(SELECT * REPLACE ({_MONEY_RAW}) FROM o_raw_payments)",
                "payment_id customer_id merchant_id amount currency status created_at updated_at method",
            ),
            _digest("chargebacks", "o_raw_chargebacks", "payment_id reason_code filed_at", set()),
            _digest(
                "fx_rates",
                "(SELECT * REPLACE (CAST(rate AS DECIMAL(24,6)) AS rate) FROM o_raw_fx)",
                "date from_ccy to_ccy rate",
            ),
            _digest("events", "o_raw_events", "event_id customer_id type event_ts", set()),
            _digest("blacklist", "o_raw_blacklist", "customer_id blacklist_updated_at"),
        ),
        "silver_tables": _digests(
            _digest(
                "customers",
                "o_silver_customers",
                "customer_id signup_date country marketing_channel is_blacklisted cohort_month",
            ),
            _digest("merchants", "o_merchants", "merchant_id category risk_level created_at", {"created_at"}),
            _digest(
                "payments",
                "o_silver_payments",
                "payment_id customer_id merchant_id amount_original currency status method created_at_utc updated_at_utc "
                "fx_rate_to_usd amount_usd chargeback_reason_code chargeback_filed_at has_chargeback",
            ),
            _digest("payments_rejected", f"({_REJECTS})", _REJECT_COLUMNS),
            _digest("chargebacks", "o_chargebacks", "payment_id reason_code filed_at"),
            _digest("fx_rates", "o_fx", "date from_ccy to_ccy rate"),
            _digest("blacklist", "o_denylist", "customer_id"),
            _digest("events", f"({_EVENTS})", "event_id customer_id type event_ts"),
            "SELECT 'events_quarantine', 0, 0",
        ),
        "gold_tables": _digests(
            *(
                _digest(table, view, columns, _TIMES | ({"created_at"} if table == "dim_merchant" else set()))
                for table, (view, columns) in _GOLD_VIEWS.items()
                if table != "fct_payments"
            ),
            _digest(
                "fct_payments",
                "(SELECT *, CAST(date_trunc('month', date_key) AS DATE) AS date_month FROM o_fct)",
                [*_GOLD_VIEWS["fct_payments"][1], "date_month"],
            ),
        ),
    }
)

_FCT_COLUMNS = _GOLD_VIEWS["fct_payments"][1]
_HELD = _digest("held", "(SELECT * FROM o_fct WHERE date_trunc('month', date_key) <> DATE '1997-03-01')", _FCT_COLUMNS)
ORACLE_SQL["versions_expired"] = _q(
    f"SELECT *, 2 AS versions FROM ({_HELD})\nUNION ALL SELECT *, 1 FROM ({_digest('newest', 'o_fct', _FCT_COLUMNS)})"
)
ORACLE_SQL["bronze_rescued"] = _q(
    """SELECT 'payments' AS table_name,
       concat_ws(',', payment_id, customer_id, merchant_id, 'n/a', currency, status, created_at, updated_at, method) AS line,
       (SELECT count(*) FROM o_raw_payments) AS bronze_rows
FROM o_raw_payments WHERE payment_id LIKE '%\\_7' ESCAPE '\\'
UNION ALL SELECT 'events', '{"event_id":"' || event_id || '","customer_id', (SELECT count(*) FROM o_raw_events)
FROM o_raw_events WHERE event_id LIKE '%7'"""
)
