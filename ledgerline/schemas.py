"""Raw input schemas and value domains.

Raw (bronze) data keeps dates and timestamps as strings; only ``amount`` and
``rate`` are typed (double). Fields are declared non-null, but file sources
return nullable columns regardless, so nullability is enforced by the quality
suites, not by these flags.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), False) for n in names]


CUSTOMERS = StructType(_strings("customer_id", "signup_date", "country", "marketing_channel"))

MERCHANTS = StructType(_strings("merchant_id", "category", "risk_level", "created_at"))

PAYMENTS = StructType(
    _strings("payment_id", "customer_id", "merchant_id")
    + [StructField("amount", DoubleType(), False)]
    + _strings("currency", "status", "created_at", "updated_at", "method")
)

CHARGEBACKS = StructType(_strings("payment_id", "reason_code", "filed_at"))

FX_RATES = StructType(
    _strings("date", "from_ccy", "to_ccy") + [StructField("rate", DoubleType(), False)]
)

EVENTS = StructType(_strings("event_id", "customer_id", "type", "event_ts"))

# The denylist arrives as a JSON document: an id array plus one timestamp.
DENYLIST_DOCUMENT = StructType(
    [
        StructField("blacklisted_customer_ids", ArrayType(StringType(), False), False),
        StructField("updated_at", StringType(), False),
    ]
)

DENYLIST_ROWS = StructType(_strings("customer_id", "blacklist_updated_at"))

RAW_SCHEMAS: dict[str, StructType] = {
    "customers": CUSTOMERS,
    "merchants": MERCHANTS,
    "payments": PAYMENTS,
    "chargebacks": CHARGEBACKS,
    "fx_rates": FX_RATES,
    "events": EVENTS,
    "blacklist": DENYLIST_ROWS,
}

# --- Fixed values: value domains that must equal the reference's -----------
CURRENCIES = ["USD", "ARS", "BRL", "MXN", "EUR"]
STATUSES = ["captured", "refused", "refunded", "pending"]
METHODS = ["card", "wallet", "bank_transfer", "crypto"]
RISK_LEVELS = ["low", "medium", "high"]
# Merchant categories counted as risky by the fraud and merchant-risk reports.
RISKY_CATEGORIES = ["crypto", "gaming"]
# ---------------------------------------------------------------------------

_TYPES = {
    "string": StringType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "boolean": BooleanType(),
    "int": IntegerType(),
    "smallint": ShortType(),
    "money": DecimalType(18, 4),
    "rate": DecimalType(18, 6),
    "ratio": DecimalType(6, 5),
}


def _columns(**kinds: str) -> StructType:
    """A schema from the name of each column's type, in order."""
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in kinds.items()])


# ---- Fixed values: the columns and types of the gold tables --------------------------
GOLD_SCHEMAS = {
    "dim_customer": _columns(
        customer_id="string", signup_date="date", country="string", marketing_channel="string",
        cohort_month="date", is_blacklisted="boolean",
    ),
    "dim_merchant": _columns(merchant_id="string", category="string", risk_level="string", created_at="timestamp"),
    "fct_payments": _columns(
        payment_id="string", customer_id="string", merchant_id="string", date_key="date", amount_original="money",
        currency="string", fx_rate_to_usd="rate", amount_usd="money", status="string", method="string",
        created_at_utc="timestamp", updated_at_utc="timestamp", has_chargeback="boolean",
        chargeback_reason_code="string", chargeback_filed_at="timestamp",
    ),
    "agg_daily_kpis": _columns(
        date_key="date", total_payments="int", captured_payments="int", refused_payments="int",
        refunded_payments="int", auth_rate="ratio", chargeback_rate="ratio", gross_volume_usd="money",
        captured_volume_usd="money", unique_customers="int", unique_merchants="int",
    ),
    "agg_cohort_ltv": _columns(
        cohort_month="date", months_since_signup="smallint", active_customers="int", total_ltv_usd="money",
        avg_ltv_usd="money",
    ),
}
# ---------------------------------------------------------------------------------------
