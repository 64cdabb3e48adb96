"""Data-quality suites and gold key/constraint checks, run as Spark jobs.

A suite compiles to one aggregate pass over the table (every not-null, in-set
and between check is a ``count_if``) plus one ``groupBy`` per uniqueness check,
and returns a small report table ``(suite, position, expectation, column_name,
unexpected_count, success)``. NULLs are skipped by the in-set, between and
unique checks, as column-map expectations conventionally do. ``validate``
collects that report (one row per expectation) and raises when anything failed,
which stops a refresh before it publishes.

The constraint report re-aims the warehouse DDL (primary keys, foreign keys,
CHECK constraints, NOT NULL, VARCHAR lengths) at the gold tables:
``(table_name, kind, constraint_name, violations)``.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import CURRENCIES, METHODS, RISK_LEVELS, STATUSES


class SuiteFailed(RuntimeError):
    """A gate is closed: its suite found rows it does not allow."""


class ConstraintsViolated(RuntimeError):
    """Tables about to be used or published break a key or constraint."""


@dataclass(frozen=True)
class Expectation:
    kind: str  # not_null | unique | in_set | between
    column: str
    values: tuple[str, ...] = ()
    min_value: float | None = None
    max_value: float | None = None

    def unexpected(self) -> Column:
        """Row predicate: the row violates this (non-unique) expectation."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "in_set":
            return c.isNotNull() & ~c.isin(*self.values)
        if self.kind == "between":
            outside = F.lit(False)
            if self.min_value is not None:
                outside = outside | (c < F.lit(self.min_value))
            if self.max_value is not None:
                outside = outside | (c > F.lit(self.max_value))
            return c.isNotNull() & outside
        raise ValueError(f"not a row-level expectation: {self.kind}")


def not_null(c: str) -> Expectation:
    return Expectation("not_null", c)


def unique(c: str) -> Expectation:
    return Expectation("unique", c)


def in_set(c: str, values: list[str]) -> Expectation:
    return Expectation("in_set", c, tuple(values))


def between(c: str, min_value: float | None = None, max_value: float | None = None) -> Expectation:
    return Expectation("between", c, (), min_value, max_value)


# --- Fixed values: the expectation suites ---------------------------------------
SUITES: dict[str, list[Expectation]] = {
    "bronze_payments": [
        not_null("payment_id"),
        unique("payment_id"),
        not_null("customer_id"),
        not_null("merchant_id"),
        in_set("currency", CURRENCIES),
        in_set("status", STATUSES),
        in_set("method", METHODS),
        between("amount", 0.01, 100000),
    ],
    "silver_payments": [
        not_null("payment_id"),
        unique("payment_id"),
        not_null("customer_id"),
        not_null("merchant_id"),
        not_null("created_at_utc"),
        not_null("amount_usd"),
        in_set("currency", CURRENCIES),
        in_set("status", STATUSES),
        between("amount_original", 0.01),
        between("amount_usd", 0.000001),
        between("fx_rate_to_usd", 0.000001),
    ],
    "gold_fct_payments": [
        not_null("payment_id"),
        unique("payment_id"),
        not_null("customer_id"),
        not_null("merchant_id"),
        not_null("date_key"),
        in_set("status", STATUSES),
        between("amount_usd", 0.000001),
    ],
}
# ---------------------------------------------------------------------------------


def duplicate_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row ``n``: rows whose (non-NULL) key occurs more than once.

    A ``groupBy`` count with map-side partial aggregation: a hot key is summed
    inside each task before the shuffle.
    """
    keyed = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    return (
        keyed.groupBy(*columns)
        .count()
        .where(F.col("count") > 1)
        .agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("n"))
    )


def suite_report(df: DataFrame, suite_name: str) -> DataFrame:
    """Evaluate a named suite on ``df``; unknown names raise ``KeyError``."""
    if suite_name not in SUITES:
        raise KeyError(f"Unknown expectation suite: {suite_name}")
    checks = list(enumerate(SUITES[suite_name], start=1))
    row_checks = [(i, e) for i, e in checks if e.kind != "unique"]

    def entry(i: int, e: Expectation, count: Column) -> Column:
        return F.struct(
            F.lit(i).alias("position"),
            F.lit(e.kind).alias("expectation"),
            F.lit(e.column).alias("column_name"),
            count.cast("long").alias("unexpected_count"),
        )

    counts = df.agg(*[F.count_if(e.unexpected()).alias(f"_c{i}") for i, e in row_checks])
    parts = [counts.select(F.inline(F.array(*[entry(i, e, F.col(f"_c{i}")) for i, e in row_checks])))]
    for i, e in checks:
        if e.kind == "unique":
            parts.append(duplicate_rows(df, [e.column]).select(F.inline(F.array(entry(i, e, F.col("n"))))))
    report = reduce(DataFrame.unionByName, parts)
    return report.select(
        F.lit(suite_name).alias("suite"),
        "position",
        "expectation",
        "column_name",
        "unexpected_count",
        (F.col("unexpected_count") == 0).alias("success"),
    )


def validate(df: DataFrame, suite_name: str) -> list:
    """Run a suite; return its report rows, raise :class:`SuiteFailed` on any failure."""
    rows = sorted(suite_report(df, suite_name).collect(), key=lambda r: r.position)
    failed = [r for r in rows if not r.success]
    if failed:
        detail = ", ".join(f"{r.expectation}({r.column_name})={r.unexpected_count}" for r in failed)
        raise SuiteFailed(f"{suite_name} refused, rows against each rule: {detail}")
    return rows


def require_unique(df: DataFrame, columns: list[str], what: str) -> None:
    """Raise :class:`ConstraintsViolated` if a (non-NULL) key of ``columns`` occurs more than once."""
    n = duplicate_rows(df, columns).first()["n"]
    if n:
        raise ConstraintsViolated(f"{what}: {n} rows share their ({', '.join(columns)})")


# ---- Gold constraints --------------------------------------------------------------

# --- Fixed values: the warehouse DDL's constraints ----------------------------------
PRIMARY_KEYS: dict[str, list[str]] = {
    "dim_customer": ["customer_id"],
    "dim_merchant": ["merchant_id"],
    "dim_date": ["date_key"],
    "fct_payments": ["payment_id"],
    "agg_daily_kpis": ["date_key"],
    "agg_cohort_ltv": ["cohort_month", "months_since_signup"],
}
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("fct_payments", "customer_id", "dim_customer", "customer_id"),
    ("fct_payments", "merchant_id", "dim_merchant", "merchant_id"),
    ("fct_payments", "date_key", "dim_date", "date_key"),
    ("agg_daily_kpis", "date_key", "dim_date", "date_key"),
]
CHECKS: dict[str, list[str]] = {
    "dim_merchant": ["risk_level IN (" + ", ".join(f"'{v}'" for v in RISK_LEVELS) + ")"],
    "fct_payments": [
        "amount_original > 0",
        "fx_rate_to_usd > 0",
        "amount_usd > 0",
        "status IN (" + ", ".join(f"'{v}'" for v in STATUSES) + ")",
    ],
    "agg_daily_kpis": ["auth_rate BETWEEN 0 AND 1", "chargeback_rate BETWEEN 0 AND 1"],
}
NULLABLE: dict[str, set[str]] = {"fct_payments": {"chargeback_reason_code", "chargeback_filed_at"}}
VARCHAR: dict[str, dict[str, int]] = {
    "dim_customer": {"country": 2, "marketing_channel": 50},
    "dim_merchant": {"merchant_id": 20, "category": 50, "risk_level": 10},
    "dim_date": {"month_name": 10, "day_name": 10},
    "fct_payments": {
        "payment_id": 20,
        "merchant_id": 20,
        "currency": 3,
        "status": 20,
        "method": 20,
        "chargeback_reason_code": 20,
    },
}
# ---------------------------------------------------------------------------------------

GOLD_TABLES = list(PRIMARY_KEYS)


def _row_rules(table: str, df: DataFrame) -> list[tuple[str, str, Column]]:
    """(kind, name, violation predicate) for every per-row constraint of a table."""
    rules = [
        ("not_null", f"not_null({c})", F.col(c).isNull())
        for c in df.columns
        if c not in NULLABLE.get(table, set())
    ]
    # A CHECK passes when its condition is TRUE or NULL.
    rules += [("check", f"check({cond})", F.coalesce(~F.expr(cond), F.lit(False))) for cond in CHECKS.get(table, [])]
    rules += [
        ("varchar", f"varchar({c},{n})", F.coalesce(F.length(c) > n, F.lit(False)))
        for c, n in VARCHAR.get(table, {}).items()
    ]
    return rules


def _rows(table: str, kind: str, name: str, count: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(kind).alias("kind"),
        F.lit(name).alias("constraint_name"),
        count.cast("long").alias("violations"),
    )


def foreign_key_orphans(child: DataFrame, parents: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """One row with a column for each ``(key, parent, parent_key)``: child rows whose non-NULL key has no parent row.

    One pass over the child for all of its keys: they are counted by (which
    key, value) within each task first, so the anti join moves one row per
    distinct key, not one per child row and key.
    """
    which = [F.struct(F.lit(i).alias("fk"), F.col(key).cast("string").alias("value")) for i, (key, _, _) in enumerate(parents)]
    held = child.select(F.inline(F.array(*which))).where("value is not null").groupBy("fk", "value").agg(F.count("*").alias("n"))
    known = reduce(
        DataFrame.unionByName,
        [p.select(F.lit(i).alias("fk"), F.col(key).cast("string").alias("value")) for i, (_, p, key) in enumerate(parents)],
    )
    lost = held.join(known, ["fk", "value"], "left_anti")
    return lost.agg(
        *(F.coalesce(F.sum(F.when(F.col("fk") == i, F.col("n"))), F.lit(0)).alias(f"_fk{i}") for i in range(len(parents)))
    )


def keys_checked(suite_name: str, table: str) -> set[str]:
    """``{table}`` if a suite that passed on the table has found its primary key unique, else nothing."""
    return {table} if any(e.kind == "unique" and [e.column] == PRIMARY_KEYS[table] for e in SUITES[suite_name]) else set()


def enforce_constraints(tables: dict[str, DataFrame], unique: Collection[str] = ()) -> None:
    """Raise :class:`ConstraintsViolated` naming every constraint that does not hold (one row each).

    ``unique`` names tables whose primary key has just been found unique (:func:`keys_checked`); it is not counted again.
    """
    broken = constraint_report(tables, unique).where("violations > 0").orderBy("table_name", "constraint_name").collect()
    if broken:
        raise ConstraintsViolated(", ".join(f"{r.table_name}.{r.constraint_name}: {r.violations} rows" for r in broken))


def constraint_report(tables: dict[str, DataFrame], unique: Collection[str] = ()) -> DataFrame:
    """Violations of every gold constraint, one row per constraint. ``unique``: see :func:`enforce_constraints`."""
    parts = []
    for table in GOLD_TABLES:
        df = tables[table]
        rules = _row_rules(table, df)
        counts = df.agg(*[F.count_if(pred).alias(f"_r{i}") for i, (_, _, pred) in enumerate(rules)])
        pk = PRIMARY_KEYS[table]

        def repeated(n: Column, table: str = table, pk: list[str] = pk) -> Column:
            return _rows(table, "primary_key", f"unique({','.join(pk)})", n)

        rows = [_rows(table, k, n, F.col(f"_r{i}")) for i, (k, n, _) in enumerate(rules)]
        if table in unique:
            rows.append(repeated(F.lit(0)))
        else:
            parts.append(duplicate_rows(df, pk).select(F.inline(F.array(repeated(F.col("n"))))))
        parts.append(counts.select(F.inline(F.array(*rows))))
    for child in dict.fromkeys(child for child, *_ in FOREIGN_KEYS):
        keys = [(key, parent, parent_key) for c, key, parent, parent_key in FOREIGN_KEYS if c == child]
        lost = foreign_key_orphans(tables[child], [(key, tables[parent], pk) for key, parent, pk in keys])
        rows = [
            _rows(child, "foreign_key", f"fk({key}->{parent}.{pk})", F.col(f"_fk{i}"))
            for i, (key, parent, pk) in enumerate(keys)
        ]
        parts.append(lost.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)
