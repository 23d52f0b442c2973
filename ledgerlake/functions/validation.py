"""Record checks of the payment library, as boolean Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def validate_amount(c) -> Column:
    """0.01 <= amount <= 999999.99 at the amount's own precision (NULL amount is invalid)."""
    a = _c(c).cast("decimal(38,10)")
    return F.coalesce(a.between(F.lit(K.MIN_AMOUNT).cast("decimal(18,2)"),
                                F.lit(K.MAX_AMOUNT).cast("decimal(18,2)")), F.lit(False))


def validate_currency(c) -> Column:
    return F.coalesce(F.upper(_c(c)).isin(*K.VALID_CURRENCIES), F.lit(False))


def validate_method(c) -> Column:
    return F.coalesce(F.lower(_c(c)).isin(*K.PAYMENT_METHODS), F.lit(False))


def validate_ids(merchant, customer) -> Column:
    return F.coalesce((F.length(_c(merchant)) > 0) & (F.length(_c(customer)) > 0), F.lit(False))


def validation_error(amount, currency, method, merchant, customer) -> Column:
    """First failing check in the order amount -> currency -> method -> ids, else NULL."""
    return (F.when(~validate_amount(amount), F.lit("Invalid amount"))
            .when(~validate_currency(currency), F.lit("Invalid currency"))
            .when(~validate_method(method), F.lit("Invalid payment method"))
            .when(~validate_ids(merchant, customer), F.lit("Invalid merchant or customer ID")))


def payment_record_ok(amount, currency) -> Column:
    """Payment record: amount > 0 and a 3-letter currency."""
    return F.coalesce((_c(amount) > 0) & (F.length(_c(currency)) == 3), F.lit(False))


def transaction_record_ok(amount) -> Column:
    return F.coalesce(_c(amount) > 0, F.lit(False))


def signal_record_ok(score, amount) -> Column:
    """Signal record: 0 <= score <= 1 and amount >= 0."""
    return F.coalesce(_c(score).between(0, 1) & (_c(amount) >= 0), F.lit(False))
