"""Token vault with encrypted values and keys that never enter a plan.

Keys live in a keyring table in a restricted folder: one ``token`` key, whose HMAC pads make the deterministic tokens, and ``vault`` keys by
id, one of them active. Operators take them from that table at run time (scalar subqueries, a join on the key id with a table of a few rows),
so neither explain texts nor event logs hold a key, whatever the session's redaction settings.

A vault row is (token, key_id, sealed): the value under AES-GCM with the token as additional data, so a sealed value moved to
another token does not open. The nonce is the head of a keyed digest of the value, which makes the sealing deterministic: a retried task writes the
same bytes, and equal nonces only meet equal values. Rotation opens every row of another key and seals it with the active one; tokens stay.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crypto

KEYRING = "key_id string, use string, active boolean, ipad binary, opad binary, sealing_key binary"
TOKEN, VAULT = "token", "vault"


def write_keyring(spark: SparkSession, path: str, token_secret: str, vault_secrets: dict[str, str], active: str) -> str:
    """A keyring of one token secret and some vault secrets by id (a new folder; a deployment restricts who may read it)."""
    if active not in vault_secrets:
        raise ValueError(f"no vault key {active!r}")

    def pads(secret: str) -> tuple[bytearray, bytearray]:
        ipad, opad = crypto.hmac_pads(secret)
        return bytearray.fromhex(ipad), bytearray.fromhex(opad)

    rows = [(TOKEN, TOKEN, True, *pads(token_secret), None)]
    for key_id, secret in vault_secrets.items():
        sealing = bytearray(hashlib.sha256(b"seal:" + secret.encode()).digest())
        rows.append((key_id, VAULT, key_id == active, *pads("nonce:" + secret), sealing))
    spark.createDataFrame(rows, KEYRING).coalesce(1).write.mode("errorifexists").parquet(path)
    return path


def read_keyring(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KEYRING).parquet(path)


def _of(keyring: DataFrame, use: str, column: str) -> Column:
    """One column of the active key of a use, as a scalar subquery."""
    return keyring.filter((F.col("use") == use) & F.col("active")).select(column).scalar()


def token_key(keyring: DataFrame) -> crypto.KeyRef:
    return crypto.KeyRef(_of(keyring, TOKEN, "ipad"), _of(keyring, TOKEN, "opad"))


def _seal(value: Column, token: Column, key: Column, nonce_key: crypto.KeyRef) -> Column:
    nonce = F.substring(F.unhex(crypto.hmac_column(value, nonce_key)), 1, 12)
    return F.aes_encrypt(value, key, F.lit("GCM"), F.lit("DEFAULT"), nonce, token)


def _open(sealed: Column, token: Column, key: Column) -> Column:
    return F.aes_decrypt(sealed, key, F.lit("GCM"), F.lit("DEFAULT"), token).cast("string")


def _active_seal(value: Column, token: Column, keyring: DataFrame) -> Column:
    nonce_key = crypto.KeyRef(_of(keyring, VAULT, "ipad"), _of(keyring, VAULT, "opad"))
    return _seal(value, token, _of(keyring, VAULT, "sealing_key"), nonce_key)


def tokenize(df: DataFrame, col: str, keyring: DataFrame, token_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(``df`` with ``col`` replaced by its token, vault rows of the distinct values)."""
    out = df.withColumn("_token", crypto.token_for(col, token_key(keyring)))
    pairs = out.select(F.col("_token").alias("token"), F.col(col).cast("string").alias("value")).filter(F.col("token").isNotNull()).distinct()
    vault = pairs.select("token", _of(keyring, VAULT, "key_id").alias("key_id"), _active_seal(F.col("value"), F.col("token"), keyring).alias("sealed"))
    return out.drop(col).withColumnRenamed("_token", token_col or col), vault


def opened(vault: DataFrame, keyring: DataFrame) -> DataFrame:
    """The vault with ``value`` in place of the sealed one; a row whose key is not in the keyring any more opens to null."""
    keys = keyring.filter(F.col("use") == VAULT).select("key_id", "sealing_key")
    return (vault.join(F.broadcast(keys), "key_id", "left")  # a keyring holds a few rows
            .withColumn("value", F.when(F.col("sealing_key").isNotNull(), _open(F.col("sealed"), F.col("token"), F.col("sealing_key"))))
            .drop("sealing_key", "sealed"))


def detokenize(df: DataFrame, token_col: str, vault: DataFrame, keyring: DataFrame, value_col: str = "value") -> DataFrame:
    """token -> value (null for an unknown or revoked token). Only the tokens asked for are opened."""
    asked = vault.join(df.select(F.col(token_col).alias("token")), "token", "left_semi")
    values = opened(asked, keyring).select(F.col("token").alias(token_col), F.col("value").alias(value_col))
    return df.join(values, token_col, "left")


def rotated(vault: DataFrame, keyring: DataFrame) -> DataFrame:
    """The vault with every row under the active key; rows that are already are passed through unopened. Rows whose key is gone stay."""
    active = _of(keyring, VAULT, "key_id")
    keys = keyring.filter(F.col("use") == VAULT).select("key_id", F.col("sealing_key").alias("_key"))
    rows = vault.join(F.broadcast(keys), "key_id", "left").withColumn("_active", active)
    moves = (F.col("key_id") != F.col("_active")) & F.col("_key").isNotNull()
    value = _open(F.col("sealed"), F.col("token"), F.col("_key"))
    return rows.select("token", F.when(moves, F.col("_active")).otherwise(F.col("key_id")).alias("key_id"),
                       F.when(moves, _active_seal(value, F.col("token"), keyring)).otherwise(F.col("sealed")).alias("sealed"))


def collisions(vault: DataFrame) -> DataFrame:
    """Tokens that stand for more than one value under one key (a vault must have none)."""
    return vault.groupBy("token", "key_id").agg(F.count_distinct("sealed").alias("n_values")).filter("n_values > 1")
