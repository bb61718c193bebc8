"""Validation rules as data.

A rule states in SQL what a *good* row looks like, in the form a filter needs:
anything but TRUE, so also NULL, means that the rule is broken. A profile's
validity is then a plain conjunction of short predicates that Catalyst can push
into the scan one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from paywarden import schema as S


@dataclass(frozen=True)
class Rule:
    flag: str
    label: str
    holds: str

    @property
    def mark(self) -> str:
        """SQL of the label where the rule is broken, NULL elsewhere."""
        return f"CASE WHEN NOT coalesce({self.holds}, false) THEN '{self.label}' END"


@dataclass(frozen=True)
class Profile:
    name: str
    rules: tuple[Rule, ...]
    keeps_flags: bool = False
    # Does the processed table also hold the high-value rows?
    processed_has_high_value: bool = True
    # Constant columns of a velocity alert in the alert table.
    velocity_fill: tuple[tuple[str, str | None], ...] = ()

    @property
    def flags(self) -> list[str]:
        return [rule.flag for rule in self.rules]

    @property
    def _valid_sql(self) -> str:
        return " AND ".join(f"({rule.holds})" for rule in self.rules)

    def is_valid(self) -> Column:
        """TRUE for good rows, FALSE or NULL for others: a filter condition."""
        return F.expr(self._valid_sql)

    def is_invalid(self) -> Column:
        """TRUE or FALSE, never NULL."""
        return F.expr(f"NOT coalesce({self._valid_sql}, false)")

    def flag_columns(self) -> dict[str, Column]:
        return {rule.flag: F.expr(rule.mark) for rule in self.rules}

    def labels(self) -> Column:
        """Array of labels in rule order, NULL where a rule holds."""
        return F.expr(f"array({', '.join(rule.mark for rule in self.rules)})")


def _present(name: str) -> str:
    # Every text but the empty one sorts after it.
    return f"{name} > ''"


def _not_null(name: str) -> str:
    return f"{name} IS NOT NULL"


def _positive(name: str) -> str:
    return f"{name} > 0"


def _positive_number(name: str) -> str:
    return f"{name} > 0 AND NOT isnan({name})"


def _one_of(name: str, *allowed: str) -> str:
    return f"{name} IN ({', '.join(repr(value) for value in allowed)})"


def _one_of_or_null(name: str, *allowed: str) -> str:
    return f"{name} IS NULL OR {_one_of(name, *allowed)}"


# Labels, and the order in which a profile lists them.
BATCH = Profile(
    name="batch",
    rules=(
        Rule("invalid_customer", "MISSING_CUSTOMER_ID", _present("customer_id")),
        Rule("invalid_amount", "INVALID_AMOUNT", _positive("amount")),
        Rule("invalid_status", "INVALID_STATUS", _one_of_or_null("status", *S.STATUSES)),
        Rule("invalid_transaction_type", "INVALID_TRANSACTION_TYPE",
             _one_of_or_null("transaction_type", *S.TRANSACTION_TYPES)),
        Rule("invalid_currency", "INVALID_CURRENCY", _one_of("currency", S.CURRENCY)),
        Rule("invalid_transaction_id", "MISSING_TRANSACTION_ID", _present("transaction_id")),
        Rule("invalid_account", "MISSING_ACCOUNT_ID", _present("account_id")),
        Rule("invalid_merchant", "MISSING_MERCHANT", _present("merchant")),
    ),
    velocity_fill=(
        ("currency", None),
        ("transaction_type", None),
        ("merchant", None),
        ("location", None),
        ("status", "SUCCESS"),
    ),
)

STREAM = Profile(
    name="stream",
    rules=(
        Rule("invalid_customer", "INVALID_CUSTOMER", _not_null("customer_id")),
        Rule("invalid_amount", "INVALID_AMOUNT", _positive("amount")),
        Rule("invalid_currency", "INVALID_CURRENCY", _one_of_or_null("currency", S.CURRENCY)),
        Rule("invalid_transaction_type", "INVALID_TRANSACTION_TYPE",
             _one_of_or_null("transaction_type", *S.TRANSACTION_TYPES)),
        Rule("invalid_status", "INVALID_STATUS", _one_of_or_null("status", *S.STATUSES)),
        Rule("invalid_transaction_id", "INVALID_TRANSACTION_ID", _present("transaction_id")),
        Rule("invalid_account", "INVALID_ACCOUNT", _present("account_id")),
        Rule("invalid_merchant", "INVALID_MERCHANT", _present("merchant")),
    ),
    keeps_flags=True,
    processed_has_high_value=False,
    velocity_fill=(
        ("currency", S.CURRENCY),
        ("transaction_type", "MULTIPLE"),
        ("merchant", "MULTIPLE"),
        ("location", "MULTIPLE"),
        ("status", "DETECTED"),
    ),
)

# Opt-in: the stream labels with every NULL, blank, NaN and unreadable time refused.
STRICT = Profile(
    name="strict",
    rules=(
        Rule("invalid_customer", "INVALID_CUSTOMER", _present("customer_id")),
        Rule("invalid_amount", "INVALID_AMOUNT", _positive_number("amount")),
        Rule("invalid_currency", "INVALID_CURRENCY", _one_of("currency", S.CURRENCY)),
        Rule("invalid_transaction_type", "INVALID_TRANSACTION_TYPE",
             _one_of("transaction_type", *S.TRANSACTION_TYPES)),
        Rule("invalid_status", "INVALID_STATUS", _one_of("status", *S.STATUSES)),
        Rule("invalid_transaction_id", "INVALID_TRANSACTION_ID", _present("transaction_id")),
        Rule("invalid_account", "INVALID_ACCOUNT", _present("account_id")),
        Rule("invalid_merchant", "INVALID_MERCHANT", _present("merchant")),
        Rule("invalid_timestamp", "INVALID_TIMESTAMP", _not_null(S.EVENT_TIME)),
    ),
    keeps_flags=True,
    velocity_fill=STREAM.velocity_fill,
)

PROFILES = {p.name: p for p in (BATCH, STREAM, STRICT)}
