"""What card numbers, e-mail addresses and phone numbers look like: one set of rules for the scan, the audit and the redactor.

A card number is a run of digits with single spaces or dashes between them that holds 13 to 19 digits and passes the Luhn check, so dashed and
15-digit cards are found and order numbers that fail the check are not. The patterns meet every character a bounded number of times: a run is
only tried at its head (or where the last match ended) and is taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: the plain patterns (any engine)
DIGIT_RUN = r"[0-9](?:[ -]?[0-9])+"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"[0-9]{3}-[0-9]{3}-[0-9]{4}"
CARD_DIGITS = (13, 19)
# the same matches without retries inside a run
_DIGIT_RUN_ONCE = r"(?<![0-9])[0-9](?:[ -]?[0-9])++"
_EMAIL_HELD = r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"  # enough to know that there is one
EMAIL_PARTS_ONCE = r"(?:(?<![A-Za-z0-9._%+-])|\G)([A-Za-z0-9._%+-])[A-Za-z0-9._%+-]*+@([A-Za-z0-9.-]+\.[A-Za-z]{2,})"
_CARD_LIKE = r"[0-9](?:[ -]?[0-9]){12}"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check (an empty one does not)."""
    def add(total: Column, i: Column) -> Column:
        weighed = F.substring(digits, -i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return total + F.when(weighed > 9, weighed - 9).otherwise(weighed)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return F.when(F.length(digits) > 0, total % 10 == 0).otherwise(F.lit(False))


def is_card(run: Column) -> Column:
    """Whether a digit run (separators included) is a card number."""
    digits = F.regexp_replace(run, "[ -]", "")
    return F.length(digits).between(*CARD_DIGITS) & luhn(digits)


def digit_runs(text: Column) -> Column:
    """All digit runs of a text, left to right."""
    return F.regexp_extract_all(text, F.lit(_DIGIT_RUN_ONCE), F.lit(0))


def card_numbers(text: Column) -> Column:
    """array<string> of the card numbers in a text as they stand there."""
    none = F.array().cast("array<string>")
    return F.when(F.rlike(text, F.lit(_CARD_LIKE)), F.filter(digit_runs(text), is_card)).otherwise(none)


def has_card(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(_CARD_LIKE)) & F.exists(digit_runs(text), is_card), F.lit(False))


def has_email(text: Column) -> Column:
    return F.coalesce(F.contains(text, F.lit("@")) & F.rlike(text, F.lit(_EMAIL_HELD)), F.lit(False))


def has_phone(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(PHONE)), F.lit(False))


HELD = {"card": has_card, "email": has_email, "phone": has_phone}


def mask_cards(text: Column) -> Column:
    """Card numbers as twelve stars and their last four digits; other digit runs stay."""
    def shown(run: Column) -> Column:
        return F.when(is_card(run), F.concat(F.lit("*" * 12), F.right(F.regexp_replace(run, "[ -]", ""), F.lit(4)))).otherwise(run)

    pieces = F.split(text, _DIGIT_RUN_ONCE, -1)
    runs = F.concat(F.transform(digit_runs(text), shown), F.array(F.lit("")))
    masked = F.array_join(F.zip_with(pieces, runs, lambda piece, run: F.concat(piece, run)), "")
    return F.when(F.rlike(text, F.lit(_CARD_LIKE)) & F.exists(digit_runs(text), is_card), masked).otherwise(text)


# ---- the same rules as DuckDB SQL -----------------------------------------------

def luhn_sql(digits: str) -> str:
    weighed = f"CAST(substr({digits}, length({digits}) - i, 1) AS INTEGER) * (1 + i % 2)"
    return f"COALESCE(list_sum(list_transform(range(length({digits})), lambda i: CASE WHEN {weighed} > 9 THEN {weighed} - 9 ELSE {weighed} END)) % 10 = 0, false)"


def is_card_sql(run: str) -> str:
    digits = f"regexp_replace({run}, '[ -]', '', 'g')"
    return f"(length({digits}) BETWEEN {CARD_DIGITS[0]} AND {CARD_DIGITS[1]} AND {luhn_sql(digits)})"


def held_sql(kind: str, text: str) -> str:
    if kind == "card":
        return f"COALESCE(len(list_filter(regexp_extract_all({text}, '{DIGIT_RUN}'), lambda r: {is_card_sql('r')})) > 0, false)"
    return f"COALESCE(regexp_matches({text}, '{EMAIL if kind == 'email' else PHONE}'), false)"


def mask_cards_sql(text: str) -> str:
    shown = f"CASE WHEN {is_card_sql('r')} THEN '{'*' * 12}' || right(regexp_replace(r, '[ -]', '', 'g'), 4) ELSE r END"
    runs = f"list_transform(regexp_extract_all({text}, '{DIGIT_RUN}'), lambda r: {shown})"
    return f"array_to_string(list_transform(list_zip(string_split_regex({text}, '{DIGIT_RUN}'), {runs}), lambda z: z[1] || COALESCE(z[2], '')), '')"
