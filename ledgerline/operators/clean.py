"""Silver cleaning: raw strings to typed columns, driven by the raw schemas.

What a raw column becomes follows from its name, so every table is cleaned by
the same function. Spark 4 runs with ANSI mode on, where a bad date or number
would fail the whole job; raw input is parsed with the ``try_*`` forms so that a
malformed value becomes NULL and is then counted by the quality suites and the
drop report.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import MONEY, RATE
from ledgerline.schemas import RAW_SCHEMAS

# --- Fixed values: raw columns that are not text, and silver names that differ ---
DAYS = ("signup_date", "date")
INSTANTS = ("created_at", "updated_at", "filed_at", "event_ts")
DECIMALS = {"amount": MONEY, "rate": RATE}
SILVER_NAMES = {
    "payments": {"amount": "amount_original", "created_at": "created_at_utc", "updated_at": "updated_at_utc"},
}
# ---------------------------------------------------------------------------------


def _parsed(name: str) -> Column:
    if name in DECIMALS:
        return F.col(name).try_cast(DECIMALS[name])  # half up
    if name in INSTANTS:
        return F.try_to_timestamp(name)
    return F.try_to_date(name, "yyyy-MM-dd") if name in DAYS else F.col(name)


def typed(df: DataFrame, table: str) -> DataFrame:
    """The raw columns of ``table``, parsed; other columns (the ingest stamp) go."""
    renamed = SILVER_NAMES.get(table, {})
    return df.select(*(_parsed(c).alias(renamed.get(c, c)) for c in RAW_SCHEMAS[table].names))


clean_customers = partial(typed, table="customers")
clean_merchants = partial(typed, table="merchants")
clean_payments = partial(typed, table="payments")
clean_chargebacks = partial(typed, table="chargebacks")
clean_fx_rates = partial(typed, table="fx_rates")
clean_events = partial(typed, table="events")


def explode_denylist(documents: DataFrame) -> DataFrame:
    """Denylist document(s) -> one row per id, the document timestamp repeated."""
    return documents.select(
        F.explode("blacklisted_customer_ids").alias("customer_id"),
        F.col("updated_at").alias("blacklist_updated_at"),
    )


def distinct_denylist(rows: DataFrame) -> DataFrame:
    """The set of denylisted ids (a customer may be listed more than once)."""
    return rows.select("customer_id").distinct()
