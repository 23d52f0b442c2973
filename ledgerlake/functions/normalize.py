"""CASE-style normalisation expressed as literal map lookups (one expression, codegen'd)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(c, mapping: dict, default=None) -> Column:
    """``mapping[c]`` as a literal map; ``default`` when the key is absent or NULL."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    key = _c(c)
    out = F.when(key.isNull(), F.lit(None)).otherwise(F.try_element_at(m, key))
    return out if default is None else F.coalesce(out, F.lit(default))


def _upper_map(values) -> dict:
    return {v: v.upper() for v in values}


def normalize_payment_method(c, ignore_case: bool = False) -> Column:
    """5 known methods -> UPPER, else UNKNOWN. Pipeline A matches exact lower case,
    pipeline B lower-cases first."""
    key = F.lower(_c(c)) if ignore_case else _c(c)
    return lookup(key, _upper_map(K.PAYMENT_METHODS), "UNKNOWN")


def normalize_status(c, ignore_case: bool = False) -> Column:
    """authorized/captured/declined/refunded/failed -> UPPER; pending, cancelled -> UNKNOWN."""
    key = F.lower(_c(c)) if ignore_case else _c(c)
    return lookup(key, _upper_map(K.NORMALIZED_STATUSES), "UNKNOWN")


def normalize_decision(c) -> Column:
    return lookup(c, K.DECISION_MAP, "UNKNOWN")


def normalize_case_status(c) -> Column:
    return lookup(c, _upper_map(K.CASE_STATUSES), "UNKNOWN")


def method_name(c) -> Column:
    return lookup(c, K.METHOD_DISPLAY_NAMES, "Other")


def method_category(c) -> Column:
    return lookup(c, K.METHOD_CATEGORIES, "Other")


def entity_name(c, prefix: str, require_non_empty: bool = True) -> Column:
    """'Merchant_' + id (pipeline A: 'Unknown' for an empty id); 'Merchant ' + id (B)."""
    col = _c(c)
    name = F.concat(F.lit(prefix), col)
    if not require_non_empty:
        return name
    return F.when(F.length(col) > 0, name).otherwise(F.lit("Unknown"))


def format_currency(amount, currency) -> Column:
    """Symbol ($ EUR GBP JPY) or the code itself, then the amount with 2 decimals."""
    symbol = lookup(currency, K.CURRENCY_SYMBOLS)
    return F.concat(F.coalesce(symbol, _c(currency)), _c(amount).cast("decimal(38,2)").cast("string"))
