"""Personal data in free text, in DataFrame functions only.

Regular expressions propose spans; validators confirm them (Luhn for cards, mod-97 for IBANs, ranges for IPs, telephone and social security
numbers); words near a span raise or lower its score. Base proposals that their validator confirms always stay. Added proposals (IPv6, cards of 13
to 15 digits, telephone numbers without country code, IBANs, social security numbers) stay if their score reaches ``threshold`` and
they overlap no base span.

All is one projection per text, so nothing is shuffled and a lost executor repeats its own rows. A pattern's matches and the pieces between
them (``split``) give every position: a match ends at the running sum of piece and match lengths. Running sums go over chunks of ``CHUNK`` matches
and then over the chunks, so a text with very many matches costs n * (CHUNK + n / CHUNK) steps, not n * n. The patterns are written so
that the regex engine neither tries every start of a long run nor recurses per repetition; they match what the plain forms match.

A span's score is points / 100: the pattern's own, the validator's and the context's, between 0 and 1. Context are the 48 characters before
and after the match, no further than the same pattern's neighbouring matches, lower-cased A-Z.

Defined results: null text = empty text = no spans. Positions are code points, the end exclusive. Spans of the base kinds may overlap each
other, as may added ones. Repeated rows and null ids are reported each; extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 128
NEAR = 48
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Length of an IBAN by country code.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24,
    "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


def iban_pattern() -> str:
    """Country code, check digits and the country's number of letters and digits, with single spaces between any of them."""
    of = defaultdict(list)
    for country, length in IBAN_LENGTHS.items():
        of[length].append(country)
    return "|".join(f"(?:{'|'.join(c)})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in sorted(of.items()))


#: By kind, the base patterns; the engine's form of each is below.
BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A match can only begin at the head of a run of its first class, or where the last match ended; runs are taken whole.
ENGINE_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: By kind, what the method adds: group 1 is the span; the character before it is part of the match, the one after it is checked apart.
ADDED_PATTERNS = {
    "ip": r"(?:^|[^0-9A-Za-z:.])((?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4})",
    "phone": r"(?:^|[^0-9A-Za-z+])(\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4})",
    "iban": rf"(?:^|[^0-9A-Za-z])({iban_pattern()})",
    "ssn": r"(?:^|[^0-9A-Za-z-])([0-9]{3}-[0-9]{2}-[0-9]{4})",
}
GOES_ON = {"ip": "^[0-9A-Za-z:]", "phone": "^[0-9A-Za-z]", "iban": "^[0-9A-Za-z]", "ssn": "^[0-9A-Za-z-]"}  # no span where the text goes on like this
#: Points of a confirmed proposal; a word of its kind nearby adds CONTEXT, a word for another kind of number takes OTHER.
BASE_POINTS = {"email": 90, "ip": 70, "card": 80, "phone": 70}
ADDED_POINTS = {"ip": 70, "card": 40, "phone": 40, "iban": 80, "ssn": 40}
CONTEXT, OTHER = 30, 20
# Words that speak for a kind and words that speak for another kind of number.
CONTEXT_WORDS = {
    "email": "e-?mail|mailto|contact", "ip": "ip|ipv6|address|host|server|login", "card": "card|visa|mastercard|amex|diners|credit|debit",
    "phone": "phone|tel|telephone|mobile|cell|call|fax|whatsapp", "iban": "iban|bank|account|bic|swift", "ssn": "ssn|social security|social insurance",
}
OTHER_WORDS = "order|invoice|isbn|tracking|serial|version|part|article|item"


def near_pattern(words: str) -> str:
    return f"(?:^|[^a-z])(?:{words})(?:$|[^a-z])"


@dataclass(frozen=True)
class PiiParams:
    threshold: float = 0.6


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _fold(values: Column, zero: Column, op: Callable[[Column, Column], Column]) -> Column:
    return F.aggregate(values, zero, op)


def _running(values: Column, zero: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Per element, ``op`` over all elements before it."""
    def over_parts(parts: Column) -> Column:
        def with_totals(totals: Column) -> Column:
            heads = F.transform(F.sequence(F.lit(0), F.size(totals) - 1), lambda i: _fold(F.slice(totals, F.lit(1), i), zero, op))
            return F.flatten(F.zip_with(parts, heads, lambda part, head: F.transform(part, lambda _, i: _fold(F.slice(part, F.lit(1), i), head, op))))

        return _let(F.transform(parts, lambda part: _fold(part, zero, op)), with_totals)

    def cut(v: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / CHUNK).cast("int"))
        return _let(F.transform(firsts, lambda c: F.slice(v, c * CHUNK + 1, F.lit(CHUNK))), over_parts)

    return F.when(F.size(values) > 0, _let(values, cut)).otherwise(F.array().cast("array<bigint>"))


def _proposals(matches: Column, groups: Column, pieces: Column) -> Column:
    """array<struct<start, end, value, before, after>>: the groups, which end with their matches, with the pieces of text around them."""
    def build(p: Column) -> Column:
        steps = F.zip_with(F.slice(p, F.lit(1), F.size(matches)), matches, lambda piece, match: (F.length(piece) + F.length(match)).cast("long"))

        def place(s: Column) -> Column:
            ends = F.zip_with(_running(s, F.lit(0).cast("long"), lambda a, b: a + b), s, lambda a, b: a + b)
            around = F.zip_with(F.slice(p, F.lit(1), F.size(matches)), F.slice(p, F.lit(2), F.size(matches)),
                                lambda before, after: F.struct(F.right(before, F.lit(NEAR)).alias("before"), F.left(after, F.lit(NEAR)).alias("after")))
            spans = F.zip_with(groups, ends, lambda g, e: F.struct((e - F.length(g)).alias("start"), e.alias("end"), g.alias("value")))
            return F.zip_with(spans, around, lambda a, b: F.struct(a["start"].alias("start"), a["end"].alias("end"), a["value"].alias("value"), b["before"].alias("before"), b["after"].alias("after")))

        return _let(steps, place)

    return _let(pieces, build)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def add(total: Column, i: Column) -> Column:
        doubled = F.substring(digits, -i, F.lit(1)).cast("int") * (2 - i % 2)
        return total + F.when(doubled > 9, doubled - 9).otherwise(doubled)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without spaces passes its check."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.left(iban, F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
IP_RANGES = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"
PHONE_RANGES = "^[2-9][0-9]{2}[2-9][0-9]{6}$"                      # area code and exchange begin with 2 to 9
SSN_RANGES = "^(?:00[1-9]|0[1-9][0-9]|[1-57-8][0-9]{2}|6[0-57-9][0-9]|66[0-57-9])-(?:0[1-9]|[1-9][0-9])-(?:000[1-9]|00[1-9][0-9]|0[1-9][0-9]{2}|[1-9][0-9]{3})$"
ISSUERS = "^(?:4[0-9]{12}|3[47][0-9]{13}|3(?:0[0-5]|[68][0-9])[0-9]{11})$"  # of 13, 15 and 14 digits


def _confirmed(kind: str, base: bool, value: Column) -> Column:
    digits = _digits(value)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.rlike(value, F.lit(IP_RANGES)) if base else F.lit(True)
    if kind == "card":
        return (F.length(digits).between(16, 19) & luhn(digits)) if base else (F.rlike(digits, F.lit(ISSUERS)) & luhn(digits))
    if kind == "phone":
        return F.length(digits).between(8, 15) if base else F.rlike(digits, F.lit(PHONE_RANGES))
    if kind == "iban":
        return mod97(F.regexp_replace(value, " ", ""))
    return F.rlike(value, F.lit(SSN_RANGES))


def _scored(kind: str, base: bool, proposals: Column, params: PiiParams) -> Column:
    """The confirmed proposals of one kind as array<struct<order, start, end, kind, base, score>>."""
    def span(p: Column) -> Column:
        near = F.translate(F.concat(p["before"], F.lit(" \n "), p["after"]), UPPER, LOWER)
        points = (F.lit((BASE_POINTS if base else ADDED_POINTS)[kind]) + F.when(F.rlike(near, F.lit(near_pattern(CONTEXT_WORDS[kind]))), CONTEXT).otherwise(0)
                  - F.when(F.rlike(near, F.lit(near_pattern(OTHER_WORDS))), OTHER).otherwise(0))
        return F.struct(F.lit(KINDS.index(kind)).alias("order"), p["start"].alias("start"), p["end"].alias("end"), F.lit(kind).alias("kind"), F.lit(base).alias("base"),
                        (F.least(points, F.lit(100)) / 100).alias("score"))

    held = F.filter(proposals, lambda p: _confirmed(kind, base, p["value"]))
    if base:
        return F.transform(held, span)
    if kind in GOES_ON:
        held = F.filter(held, lambda p: ~F.rlike(p["after"], F.lit(GOES_ON[kind])))
    return F.filter(F.transform(held, span), lambda s: s["score"] >= params.threshold)


def _clear_of(base: Column, added: Column) -> Column:
    """The added spans that overlap no base span, from running bounds over all spans sorted by start."""
    def by_start(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"), s.alias("span"))

    def keep(spans: Column) -> Column:
        reach = _running(F.transform(spans, lambda s: F.when(s["base"], s["end"]).otherwise(F.lit(0))), F.lit(0).cast("long"), lambda a, b: F.greatest(a, b))
        far = F.lit((1 << 62)).cast("long")
        ahead = F.reverse(_running(F.reverse(F.transform(spans, lambda s: F.when(s["base"], s["start"]).otherwise(far))), far, lambda a, b: F.least(a, b)))
        bounds = F.zip_with(reach, ahead, lambda a, b: F.struct(a.alias("reach"), b.alias("ahead")))
        marked = F.zip_with(spans, bounds, lambda s, b: F.struct(s["span"].alias("span"), (~s["base"] & (b["reach"] <= s["start"]) & (b["ahead"] >= s["end"])).alias("clear")))
        return F.transform(F.filter(marked, lambda m: m["clear"]), lambda m: m["span"])

    return F.when(F.size(added) == 0, added).otherwise(_let(F.array_sort(F.transform(F.concat(base, added), by_start)), keep))


def find_pii(df: DataFrame, text: str = "text", params: PiiParams = PiiParams()) -> DataFrame:
    """``df`` with ``pii``: array<struct<order, start, end, kind, base, score>> by kind (as in KINDS), then start."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    none = F.array().cast("array<string>")

    def matches(pattern: str, group: int, needs: Column) -> Column:
        return F.when(needs, F.regexp_extract_all(body, F.lit(pattern), F.lit(group))).otherwise(none)

    # a cheap test keeps each pattern from texts without what all its matches hold
    needs = {"email": F.contains(body, F.lit("@")), "ip": F.rlike(body, F.lit(r"[0-9]\.[0-9]")), "card": F.rlike(body, F.lit("[0-9]")), "phone": F.contains(body, F.lit("+"))}
    extra = {"ip": F.contains(body, F.lit(":")), "phone": F.rlike(body, F.lit(r"[0-9]{3}[\x20.-][0-9]{4}")), "iban": F.rlike(body, F.lit("[A-Z]{2}[0-9]{2}")), "ssn": F.rlike(body, F.lit("[0-9]-[0-9]{2}-[0-9]"))}
    found = df.select("*", F.struct(*[matches(p, 0, needs[k]).alias(f"base_{k}") for k, p in ENGINE_PATTERNS.items()],
                                    *[matches(p, g, extra[k]).alias(f"added_{k}_{g}") for k, p in ADDED_PATTERNS.items() for g in (0, 1)]).alias("_found"))

    def spans(kind: str, base: bool, all_of: str, group: str, pattern: str) -> Column:
        m, g = F.col(f"_found.{all_of}"), F.col(f"_found.{group}")
        placed = F.when(F.size(m) > 0, _let(_proposals(m, g, F.split(body, pattern, -1)), lambda p: F.struct(_scored(kind, base, p, params).alias("base"),
                        (_scored(kind, False, p, params) if kind == "card" else F.array().cast(_SPANS)).alias("added"))))
        return placed

    columns = [spans(k, True, f"base_{k}", f"base_{k}", p).alias(f"b_{k}") for k, p in ENGINE_PATTERNS.items()]
    columns += [spans(k, False, f"added_{k}_0", f"added_{k}_1", p).alias(f"a_{k}") for k, p in ADDED_PATTERNS.items()]
    placed = found.select(*df.columns, F.struct(*columns).alias("_spans"))

    def gathered(names: list[str]) -> Column:
        return F.concat(*[F.coalesce(F.col(f"_spans.{n}"), F.array().cast(_SPANS)) for n in names])

    both = placed.select(*df.columns, gathered([f"b_{k}.base" for k in ENGINE_PATTERNS]).alias("_base"),
                         gathered([f"a_{k}.base" for k in ADDED_PATTERNS] + ["b_card.added"]).alias("_added"))
    return both.select(*df.columns, F.array_sort(F.concat("_base", _clear_of(F.col("_base"), F.col("_added")))).alias("pii"))


_SPANS = "array<struct<order:int,start:bigint,end:bigint,kind:string,base:boolean,score:double>>"


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """doc_id, base counts by kind, digest of the base spans and all spans, per row."""
    found = find_pii(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), params=params).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["base"])
    return found.select("doc_id", *[F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{k}") for k in ENGINE_PATTERNS],
                        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("pii")).alias("spans"))
