"""The shared rules for sensitive values against plain Python."""

import random
import re
import time

import duckdb
from pyspark.sql import functions as F

from ledgerlake.functions import masks, sensitive
from ledgerlake.operators import pci


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def cards(text):
    runs = re.findall(r"[0-9](?:[ -]?[0-9])+", text or "")
    return [r for r in runs if 13 <= len(re.sub("[ -]", "", r)) <= 19 and luhn(re.sub("[ -]", "", r))]


def redact(text):
    def card(m):
        return "*" * 12 + re.sub("[ -]", "", m[0])[-4:] if cards(m[0]) else m[0]

    text = re.sub(r"[0-9](?:[ -]?[0-9])+", card, text)
    text = re.sub(r"\b[0-9]{3}-[0-9]{3}-([0-9]{4})\b", r"***-***-\1", text)
    return re.sub(r"([A-Za-z0-9._%+-])[A-Za-z0-9._%+-]*@([A-Za-z0-9.-]+\.[A-Za-z]{2,})", r"\1***@\2", text)


CASES = ["4111111111111111", "4111-1111-1111-1111", "4111 1111 1111 1111 and 378282246310005", "378282246310005", "4111111111111112", "4222222222222", "41111111111111110000", "4111--1111-1111-1111",
         "x4111111111111111y", "", " ", "a@b.co", "a@b.co_c@d.org", "a.b+c@d-e.museum.", "@b.co a@ a@b", "call 555-010-1234 or 4555-010-1234", "é 4111 1111 1111 1111 é", "1 2 3 4"]


def random_texts(n, seed):
    rng = random.Random(seed)
    bits = ["a", "@", ".", "b.co", "1", "4111111111111111", "4111-1111-1111-1111", " ", "-", "é", "\n", "555-010-1234", "_", "378282246310005", "00", "x"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def test_rules_against_python_and_duckdb(spark):
    texts = CASES + random_texts(1500, 3)
    df = spark.createDataFrame(list(enumerate([*texts, None])), "i int, t string")
    rows = df.select("i", sensitive.card_numbers(F.col("t")).alias("cards"), masks.redact_text("t").alias("redacted"),
                     *[has(F.col("t")).alias(k) for k, has in sensitive.HELD.items()]).orderBy("i").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE x AS SELECT unnest(range(len($1))) AS i, unnest($1::VARCHAR[]) AS t", [texts])
    twin = con.execute(f"SELECT {', '.join(sensitive.held_sql(k, 't') for k in sensitive.HELD)}, {sensitive.mask_cards_sql('t')} FROM x ORDER BY i").fetchall()
    for text, r, sql in zip(texts, rows, twin):
        assert r["cards"] == cards(text) and r["redacted"] == redact(text), text
        assert r["card"] == bool(cards(text)) and r["email"] == bool(re.search(sensitive.EMAIL, text)) and r["phone"] == bool(re.search(sensitive.PHONE, text))
        assert tuple(sql[:3]) == (r["card"], r["email"], r["phone"])
    assert (rows[-1]["redacted"], rows[-1]["card"], rows[-1]["email"]) == (None, False, False)


def test_what_the_audit_passes_the_redactor_leaves_alone(spark):
    df = spark.createDataFrame([(t,) for t in CASES + random_texts(500, 8)], "t string")
    clean = df.filter(~sensitive.has_card(F.col("t")) & ~sensitive.has_email(F.col("t")) & ~sensitive.has_phone(F.col("t")))
    assert clean.count() > 0 and clean.filter(masks.redact_text("t") != F.col("t")).count() == 0
    # where a phone number stood within a longer run of digits, what is left of the run may look like a card by chance
    no_phone = df.filter(~sensitive.has_phone(F.col("t")) & ~F.contains("t", F.lit("@")))
    leak = pci.leaking_rows(no_phone.select(masks.redact_text("t").alias("t")), "redacted").first()
    assert leak["leaking"] == 0


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 200_000, "1" * 200_000, "a@" * 100_000, "1-" * 100_000, ("4111 1111 1111 1111 x " * 5_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    began = time.time()
    got = {r["i"]: (r["n"], r["same"]) for r in df.select("i", F.size(sensitive.card_numbers(F.col("t"))).alias("n"), (masks.redact_text("t") == F.col("t")).alias("same")).collect()}
    assert got == {0: (0, True), 1: (0, True), 2: (0, True), 3: (0, True), 4: (5_000, False)}
    assert time.time() - began < 30  # a pattern tried at every character of a run takes minutes


def test_notes_with_many_kinds_of_numbers(spark):
    found = pci.scan_sensitive_values(spark.createDataFrame([("card 3782-822463-10005",), ("order 4111111111111112",), (None,)], "note string"), "notes")
    assert {r["pattern"]: (r["matches"], r["total_values"]) for r in found.collect()} == {"card": (1, 3), "email": (0, 3), "phone": (0, 3)}
