"""The encrypted token vault: keys outside plans, rotation, revocation."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import crypto
from ledgerlake.operators import pci, vault
from ledgerlake.session import scratch_path

SECRETS = {"k1": "first secret", "k2": "second secret"}
ROWS = [("a", "4532015112830366"), ("b", "4532015112830366"), ("c", "378282246310005"), ("d", None), ("e", ""), ("f", "é 日本")]


@pytest.fixture
def rings(spark):
    root = scratch_path(spark, "test-keyring")
    return {name: vault.read_keyring(spark, vault.write_keyring(spark, f"{root}/{name}", "token secret", keys, active))
            for name, keys, active in [("old", SECRETS, "k1"), ("new", SECRETS, "k2"), ("only_new", {"k2": SECRETS["k2"]}, "k2"), ("other", {"k1": "another"}, "k1")]}


@pytest.fixture
def made(spark, rings):
    df = spark.createDataFrame(ROWS, "h string, card string")
    return vault.tokenize(df, "card", rings["old"], "token")


def values(df):
    return {r["h"]: r["value"] for r in df.collect()}


def test_tokens_are_the_keyed_hmac_and_detokenize(spark, rings, made):
    out, store = made
    tokens = {r["h"]: r["token"] for r in out.collect()}
    want = spark.createDataFrame(ROWS, "h string, card string").select("h", crypto.token_for("card", "token secret").alias("t"))
    assert tokens == {r["h"]: r["t"] for r in want.collect()} and tokens["a"] == tokens["b"] and tokens["d"] is None
    assert store.count() == 4 and store.columns == ["token", "key_id", "sealed"]
    assert values(vault.detokenize(out, "token", store, rings["old"])) == dict(ROWS)
    assert vault.collisions(store).count() == 0
    unknown = spark.createDataFrame([("x", "tok_none")], "h string, token string")
    assert values(vault.detokenize(unknown, "token", store, rings["old"])) == {"x": None}


def test_sealing_is_repeatable_and_bound_to_its_token(spark, rings, made):
    _, store = made
    again = {r["token"]: bytes(r["sealed"]) for r in store.collect()}
    assert again == {r["token"]: bytes(r["sealed"]) for r in store.collect()}
    assert not any(b"4532015112830366" in s for s in again.values())
    moved = spark.createDataFrame([("tok_elsewhere", "k1", bytearray(next(iter(again.values()))))], "token string, key_id string, sealed binary")
    with pytest.raises(Exception, match="(?i)aes|decrypt|tag"):
        vault.opened(moved, rings["old"]).collect()
    with pytest.raises(Exception, match="(?i)aes|decrypt|tag"):
        vault.opened(store, rings["other"]).collect()


def test_rotation_keeps_tokens_and_values(spark, rings, made):
    out, store = made
    new = vault.rotated(store, rings["new"])
    assert {r["key_id"] for r in new.collect()} == {"k2"}
    assert values(vault.detokenize(out, "token", new, rings["only_new"])) == dict(ROWS)
    assert {r["value"] for r in vault.opened(store, rings["only_new"]).collect()} == {None}  # the old key is gone
    twice = vault.rotated(new, rings["only_new"])
    assert sorted(map(str, twice.collect())) == sorted(map(str, new.collect()))
    lost = vault.rotated(store, rings["only_new"])                                          # nothing can be opened, nothing is lost
    assert sorted(map(str, lost.collect())) == sorted(map(str, store.collect()))


def test_revoked_tokens_do_not_open(spark, rings, made):
    out, store = made
    first = out.filter("h = 'a'").select("token")
    remaining, result = pci.revoke_tokens(store, first.unionByName(spark.createDataFrame([("tok_x",)], "token string")))
    assert {r["revoked"] for r in result.collect()} == {True, False}
    back = values(vault.detokenize(out, "token", remaining, rings["old"]))
    assert back == {**dict(ROWS), "a": None, "b": None}


def test_no_key_in_plan_texts_of_a_session_without_redaction(spark, rings, made):
    out, store = made
    before = spark.conf.get("spark.sql.redaction.string.regex", None)
    spark.conf.unset("spark.sql.redaction.string.regex")
    try:
        texts = ""
        for df in (out, store, vault.detokenize(out, "token", store, rings["old"]), vault.rotated(store, rings["new"]),
                   out.select(crypto.hmac_column("h", vault.token_key(rings["old"])))):
            df.collect()
            texts += df._jdf.queryExecution().toString() + df._jdf.queryExecution().executedPlan().toString()
        secret = ["token secret", *SECRETS.values()]
        for s in ["token secret", *("nonce:" + v for v in SECRETS.values())]:
            secret += crypto.hmac_pads(s)
        secret += [hashlib.sha256(b"seal:" + v.encode()).hexdigest() for v in SECRETS.values()]
        low = texts.lower()
        assert "aes_encrypt" in low and not [s for s in secret if s.lower() in low]
        literal = spark.range(1).select(crypto.hmac_column(F.lit("x"), "token secret"))  # the literal form does show its pads here
        assert crypto.hmac_pads("token secret")[0] in literal._jdf.queryExecution().toString().lower()
    finally:
        if before is not None:
            spark.conf.set("spark.sql.redaction.string.regex", before)


def test_a_keyring_needs_its_active_key(spark):
    with pytest.raises(ValueError):
        vault.write_keyring(spark, scratch_path(spark, "bad-keyring"), "t", SECRETS, "k9")
