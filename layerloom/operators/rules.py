"""Data-quality rules. Each rule is a function giving its *violation* as a Column.

A violation that evaluates to NULL passes, so only NOT_NULL rejects NULLs.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from inspect import signature
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.columns import parsed

log = logging.getLogger(__name__)

# Patterns and allowed lists of the rules.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_PATTERN = r"^\d{10}$"
COUNTRIES = ["India", "USA", "Canada", "UK", "Australia"]
CATEGORIES = ["Electronics", "Clothing", "Furniture", "Grocery", "Sports", "Books"]
PRODUCT_STATUSES = ["Active", "Inactive"]
CURRENCIES = ["USD", "INR", "EUR", "GBP", "AUD", "CAD", "JPY"]
ORDER_TOTAL_TOLERANCE = 1

ERROR, WARNING = "ERROR", "WARNING"


@dataclass(frozen=True)
class Rule:
    """One configured check: which rule on which column, and how severe."""

    column: str
    name: str
    severity: str = ERROR
    args: Mapping[str, Any] = field(default_factory=dict, hash=False)

    @property
    def label(self) -> str:
        return f"{self.column}:{self.name}"


@dataclass(frozen=True)
class Scope:
    """What a rule may look at besides its column."""

    schema: T.StructType
    as_of: date
    now: datetime | None = None

    def is_date(self, column: str) -> bool:
        return isinstance(self.schema[column].dataType, T.DateType)


Violation = Callable[..., Column]
_RULES: dict[str, tuple[Violation, tuple[str, ...]]] = {}


def rule(name: str, needs: Sequence[str] = ()) -> Callable[[Violation], Violation]:
    """Register a violation under a rule name.

    ``needs`` lists arguments that name further columns; the rule is skipped
    when the frame lacks one of them.
    """

    def register(violation: Violation) -> Violation:
        _RULES[name] = (violation, tuple(needs))
        return violation

    return register


@rule("NOT_NULL")
def _not_null(scope: Scope, column: str) -> Column:
    return F.col(column).isNull()


@rule("NOT_EMPTY")
def _not_empty(scope: Scope, column: str) -> Column:
    return F.trim(column) == ""


@rule("POSITIVE_NUMBER")
def _positive(scope: Scope, column: str) -> Column:
    return F.col(column) <= 0


@rule("MATCHES")
def _matches(scope: Scope, column: str, pattern: str) -> Column:
    return ~F.col(column).rlike(pattern)


@rule("VALID_EMAIL")
def _email(scope: Scope, column: str) -> Column:
    return _matches(scope, column, EMAIL_PATTERN)


@rule("VALID_PHONE")
def _phone(scope: Scope, column: str) -> Column:
    return _matches(scope, column, PHONE_PATTERN)


def _outside(default: Sequence[str]) -> Violation:
    def violation(scope: Scope, column: str, allowed: Sequence[str] = tuple(default)) -> Column:
        return ~F.col(column).isin(list(allowed))

    return violation


rule("VALID_COUNTRY")(_outside(COUNTRIES))
rule("VALID_CATEGORY")(_outside(CATEGORIES))
rule("VALID_PRODUCT_STATUS")(_outside(PRODUCT_STATUSES))
rule("VALID_CURRENCY")(_outside(CURRENCIES))


@rule("VALID_DISCOUNT", needs=("discount", "price"))
def _discount(
    scope: Scope, column: str, discount: str = "Discount", price: str = "UnitPrice"
) -> Column:
    return F.col(discount) > F.col(price)


@rule("VALID_ORDER_TOTAL", needs=("total", "quantity", "price", "discount"))
def _order_total(
    scope: Scope,
    column: str,
    total: str = "TotalAmount",
    quantity: str = "Quantity",
    price: str = "UnitPrice",
    discount: str = "Discount",
    expected: str | None = None,
) -> Column:
    """The discount counts as an amount; ``expected`` gives another formula."""
    amount = F.col(quantity) * F.col(price) - F.col(discount)
    target = F.expr(expected) if expected else amount
    return F.abs(F.col(total) - target) > ORDER_TOTAL_TOLERANCE


@rule("NOT_FUTURE_DATE")
def _not_future(
    scope: Scope, column: str, now: datetime | str | None = None, midnight: bool = False
) -> Column:
    """Later than the run. A date is compared with the run's date, a timestamp
    with its clock, or with ``now`` (an ISO time) if the rule gives one. With
    ``midnight`` it is compared with midnight of the run's date, so that any
    later hour of that day counts as future; so it is where there is no clock."""
    now = now or scope.now
    if scope.is_date(column) or midnight or now is None:
        return F.col(column) > F.lit(scope.as_of)
    if isinstance(now, datetime):
        now = now.isoformat(sep=" ")
    return F.col(column) > F.lit(now).cast(scope.schema[column].dataType)


@rule("VALID_DOB")
def _dob(scope: Scope, column: str) -> Column:
    return F.col(column) >= F.lit(scope.as_of)


@rule("SHIP_AFTER_ORDER", needs=("shipped", "ordered"))
def _ship_after_order(
    scope: Scope, column: str, shipped: str = "ShipDate", ordered: str = "OrderDate"
) -> Column:
    return F.col(shipped) < F.col(ordered)


@rule("SELL_PRICE_GE_COST", needs=("price", "cost"))
def _sell_ge_cost(
    scope: Scope, column: str, price: str = "SellingPrice", cost: str = "UnitCost"
) -> Column:
    return F.col(price) < F.col(cost)


@rule("CASTABLE")
def _castable(scope: Scope, column: str, type: str = "string", failed: str | None = None) -> Column:
    """For text columns: a value that is there but does not parse. Once the
    column has been cast, ``failed`` names a flag that was set before."""
    if failed:
        return F.col(failed)
    return F.col(column).isNotNull() & parsed(F.col(column), type).isNull()


@rule("UNIQUE", needs=("copies",))
def _unique(
    scope: Scope, column: str, copies: str = "_Copies", keys: Sequence[str] | None = None
) -> Column:
    """Reads the count that ``with_copies`` adds for the keys."""
    return F.col(copies) > 1


def violation(
    df: DataFrame, check: Rule, as_of: date, now: datetime | None = None
) -> Column | None:
    """The violation of one rule on a frame, or None when it cannot apply.

    It may be NULL, which counts as passing: ``where``, ``when`` and ``count_if``
    all treat it so, and a filter on it can still be pushed to the scan. An
    unknown rule name is an error; a missing column only a warning.
    """
    if check.name not in _RULES:
        raise ValueError(f"unknown data-quality rule {check.name!r}")
    build, needs = _RULES[check.name]
    defaults = {n: p.default for n, p in signature(build).parameters.items()}
    args = defaults | dict(check.args)
    wanted = [check.column, *[args[n] for n in needs]]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        log.warning("rule %s skipped, columns missing: %s", check.label, missing)
        return None
    return build(Scope(df.schema, as_of, now), check.column, **check.args)


def rule_names() -> list[str]:
    return sorted(_RULES)
