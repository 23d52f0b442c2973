"""PCI masks as Column expressions (no Python in the data path)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from . import sensitive


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _stars_then_last4(c: Column) -> Column:
    return F.concat(F.repeat(F.lit("*"), F.length(c) - 4), F.right(c, F.lit(4)))


def mask_card(c) -> Column:
    """NULL / empty / shorter than 4 -> '****'; else stars and the last 4 characters."""
    col = _c(c)
    return F.when(col.isNull() | (F.length(col) < 4), F.lit("****")).otherwise(_stars_then_last4(col))


def mask_card_token_variant(c) -> Column:
    """Display variant of the tokenization service: shorter than 4 -> that many stars."""
    col = _c(c)
    return F.when(F.length(col) < 4, F.repeat(F.lit("*"), F.length(col))).otherwise(_stars_then_last4(col))


def mask_cvv(c) -> Column:
    return F.lit("***")


def mask_name(c) -> Column:
    """First character of the first whitespace-separated word + '***'; blank -> '***'."""
    first = F.regexp_extract(_c(c), r"^\s*(\S)", 1)
    return F.when(_c(c).isNull() | (first == ""), F.lit("***")).otherwise(F.concat(first, F.lit("***")))


def mask_email(c) -> Column:
    """Exactly one '@' with a non-empty local part -> first char + '***@' + domain; else '***'."""
    col = _c(c)
    parts = F.split(col, "@", -1)
    ok = (F.size(parts) == 2) & (F.length(F.element_at(parts, 1)) > 0)
    return (F.when(col.isNull(), F.lit(None).cast("string"))
            .when(ok, F.concat(F.substring(col, 1, 1), F.lit("***@"), F.element_at(parts, 2)))
            .otherwise(F.lit("***")))


def mask_phone(c) -> Column:
    col = _c(c)
    return F.when(F.length(col) < 4, F.lit("****")).otherwise(_stars_then_last4(col))


def mask_for_type(mask_type: str | None, column_name: str, c) -> Column:
    """Display mask for a column the classifier marked as masked (mask_type not NULL),
    chosen by what the column holds, as in the documented masking strategy: CVV / PIN
    fully redacted, names first initial, e-mail first letter + domain, phone and card
    last 4; any other masked column is redacted to '***'."""
    if mask_type is None:
        return _c(c)
    name = column_name.lower()
    if any(w in name for w in ("cvv", "cvc", "pin")):
        return F.when(_c(c).isNull(), F.lit(None).cast("string")).otherwise(mask_cvv(c))
    if "name" in name:
        return mask_name(c)
    if "email" in name:
        return mask_email(c)
    if "phone" in name:
        return mask_phone(c)
    if "card" in name or "pan" in name:
        return mask_card(c)
    return F.when(_c(c).isNull(), F.lit(None).cast("string")).otherwise(F.lit("***"))


# FIXED VALUES: phone numbers in free text (keep last 4)
PHONE_PATTERN = r"\b[0-9]{3}-[0-9]{3}-([0-9]{4})\b"


def redact_text(c) -> Column:
    """Card, phone and e-mail masks applied inside free text, by the rules that the value scan and the audit use."""
    no_cards = sensitive.mask_cards(_c(c))
    no_phones = F.regexp_replace(no_cards, PHONE_PATTERN, "***-***-$1")
    return F.when(F.contains(no_phones, F.lit("@")), F.regexp_replace(no_phones, sensitive.EMAIL_PARTS_ONCE, "$1***@$2")).otherwise(no_phones)


def mask_by_user(c, allowed_users: list[str], user: Column | None = None) -> Column:
    """Column visible only to allowed users, else '****MASKED****'."""
    who = F.current_user() if user is None else user
    return F.when(who.isin(*allowed_users), _c(c)).otherwise(F.lit(K.MASKED_PLACEHOLDER))


def mask_by_users_table(df: DataFrame, cols: list[str], allowed: DataFrame, user: Column | None = None) -> DataFrame:
    """``cols`` in clear where the user (by default the session's) is in the one-column table ``allowed``, else
    '****MASKED****'. The membership is one scalar subquery for the whole query; ``user`` may be a column
    of ``df`` (the reader of each row): then it is a left semi-style lookup by join."""
    if user is None:
        name = allowed.columns[0]
        shown = allowed.filter(F.col(name) == F.current_user()).agg((F.count(F.lit(1)) > 0).alias("shown")).scalar()
        return df.withColumns({c: F.when(shown, F.col(c)).otherwise(F.lit(K.MASKED_PLACEHOLDER)) for c in cols})
    users = allowed.toDF("_user").filter(F.col("_user").isNotNull()).distinct().withColumn("_shown", F.lit(True))
    out = df.withColumn("_reader", user).join(users, F.col("_reader") == F.col("_user"), "left")
    return out.withColumns({c: F.when(F.col("_shown"), F.col(c)).otherwise(F.lit(K.MASKED_PLACEHOLDER))
                            for c in cols}).drop("_reader", "_user", "_shown")
