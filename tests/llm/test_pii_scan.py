"""The PII scan against plain Python expressions and its SQL twin."""

import hashlib
import random
import re

import duckdb
import pytest

from ledgerlake.llm import pii_scan as P
from ledgerlake.llm import queries as Qs
from ledgerlake.llm.oracle import ORACLE_SQL
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD_ROWS

DOC = "doc_id long, text string, lang string, spans string, pii int"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def confirmed(kind, base, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "email":
        return True
    if kind == "ip":
        return not base or all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        if base:
            return 16 <= len(digits) <= 19 and luhn(digits)
        return luhn(digits) and bool(len(digits) == 13 and digits[0] == "4" or len(digits) == 15 and digits[:2] in ("34", "37")
                                     or len(digits) == 14 and (digits[:2] in ("36", "38") or "300" <= digits[:3] <= "305"))
    if kind == "phone":
        return 8 <= len(digits) <= 15 if base else digits[0] in "23456789" and digits[3] in "23456789"
    if kind == "iban":
        s = value.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    area, group, serial = value.split("-")
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


def brute(text):
    text = text or ""
    base, added = [], []

    def propose(kind, is_base, pattern, group, out, keep=lambda *_: True):
        found = list(re.finditer(pattern, text))
        for k, m in enumerate(found):
            before = text[found[k - 1].end() if k else 0:m.start()][-48:]
            after = text[m.end():found[k + 1].start() if k + 1 < len(found) else len(text)][:48]
            if not confirmed(kind, is_base, m.group(group)) or not keep(after):
                continue
            near = (before + " \n " + after).translate(str.maketrans(P.UPPER, P.LOWER))
            points = (P.BASE_POINTS if is_base else P.ADDED_POINTS)[kind]
            points += 30 * bool(re.search(P.near_pattern(P.CONTEXT_WORDS[kind]), near)) - 20 * bool(re.search(P.near_pattern(P.OTHER_WORDS), near))
            if is_base or points >= 60:
                out.append((P.KINDS.index(kind), m.start(group), m.end(group), kind, is_base, min(points, 100) / 100))

    for kind, pattern in P.BASE_PATTERNS.items():
        propose(kind, True, pattern, 0, base)
    propose("card", False, P.BASE_PATTERNS["card"], 0, added)
    for kind, pattern in P.ADDED_PATTERNS.items():
        propose(kind, False, pattern, 1, added, lambda after, kind=kind: not re.search(P.GOES_ON[kind], after))
    return sorted(base + [a for a in added if not any(a[1] < b[2] and b[1] < a[2] for b in base)])


def scan(spark, texts):
    df = spark.createDataFrame([(i, t, "en", "clash", 1) for i, t in enumerate(texts)], DOC).repartition(4)
    return {r.doc_id: [tuple(s) for s in r.found] for r in P.find_pii(df.drop("pii")).withColumnRenamed("pii", "found").collect()}


CASES = [
    None, "", " ", "a@b.c_d@e.f+x@y.z.w", "x@y a@b..c a@@b.c .@x.y", "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.255 1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "+1 (212) 555-7890 +49 30 1234567890 +1((( +12",
    "é🙂 +44 20 7946 0958 日本 1.1.1.1", "call me at 212-555-7890 or phone (415) 555.2671", "order 212-555-7890", "212-555-7890", "IBAN DE89 3704 0044 0532 0130 00 EUR, GB82WEST12345698765432", "DE89 3704 0044 0532 0130 01", "XDE89370400440532013000",
    "DE893704004405320130000", "ssn 123-45-6789, ssn 666-45-6789, ssn 123-00-6789 and 1-123-45-6789", "123-45-6789", "Amex card 3782 822463 10005", "card 4222222222222 and 3056 930902 5904", "3782 822463 10005", "ipv6 2001:0db8:85a3:0000:0000:8a2e:0370:7334 12:30:45",
    "phone +1 (212) 555-7890 tel 212.555.7890", "1" * 30, "7 7", "+1" * 5, "a@b.co" * 3, "card 4111 1111 1111 1111 phone 212 555 7890", "NO9386011117947 MT84MALT011000012345MTLCAST001S",
]


def test_cases_against_python(spark):
    got = scan(spark, CASES)
    assert {i: brute(t) for i, t in enumerate(CASES)} == got
    kinds = {k for spans in got.values() for *_, k, base, _ in spans if not base}
    assert kinds == {"ip", "card", "phone", "iban", "ssn"}


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_against_python(spark, seed):
    rng = random.Random(seed)
    bits = ["a", "@", ".", "b.c", "+", "1", "12", "4111111111111111", " ", "-", "(", ")", "é", "\n", "255", "2.", "_", "212-555-7890", "tel ", "123-45-6789", "ssn ", "DE89370400440532013000", "37828224631000", "5 ", "card", ":"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(800)]
    assert scan(spark, texts) == {i: brute(t) for i, t in enumerate(texts)}


def test_long_texts_stay_linear(spark):
    texts = ["a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "a@b" + ".c" * 100_000, "1 " * 100_000, "+1" + "(" * 200_000, "DE89 " * 50_000, "x a@b.cd 1.2.3.4 ssn 123-45-6789 " * 4_000]
    got = scan(spark, texts)  # the plain patterns take minutes here, so the results are stated
    assert all(not got[i] for i in (0, 1, 3, 5, 6, 7)) and got[4] == [(0, 0, 200_003, "email", True, 0.9)]
    assert [s[1:3] for s in got[2]] == [(8 * i, 8 * i + 7) for i in range(25_000)]
    assert len(got[8]) == 12_000 and got[8][3999] == (0, 3999 * 33 + 2, 3999 * 33 + 8, "email", True, 0.9) and got[8][-1][1:4] == (3999 * 33 + 21, 3999 * 33 + 32, "ssn")


def test_odd_rows_and_report(spark, odd_docs, no_docs):
    rows = P.pii_report(odd_docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in ODD_ROWS)
    assert P.pii_report(no_docs).count() == 0
    one = P.pii_report(spark.createDataFrame([(1, "x a@b.cd, 1.2.3.4; ssn 123-45-6789")], "doc_id long, text string")).first()
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone, one.spans) == (1, 1, 0, 0, "email:2:8,ip:10:17,ssn:23:34")
    assert one.base_sha256 == hashlib.sha256(b"email:2:8,ip:10:17").hexdigest()


def test_query_and_sql(spark):
    got = {r.doc_id: tuple(r[1:]) for r in Qs.queries()["op11_pii_scan"](spark, SF_SMALL).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    assert {r[0]: tuple(r[1:]) for r in con.execute(ORACLE_SQL["op11_pii_scan"]).fetchall()} == got
    con.execute("CREATE OR REPLACE TABLE odd AS SELECT unnest(range(len($1))) AS doc_id, unnest($1::VARCHAR[]) AS text", [CASES])
    twin = {r[0]: r[-1] for r in con.execute(ORACLE_SQL["op11_pii_scan"].replace("FROM documents", "FROM odd")).fetchall()}
    assert twin == {i: ",".join(f"{k}:{a}:{b}" for _, a, b, k, *_ in brute(t)) for i, t in enumerate(CASES)}


def test_no_python_workers_and_no_shuffle(spark):
    plan = Qs.queries()["op11_pii_scan"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
