"""Readers for the shared test tables and for the domain tables of the pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables; column pruning and filters reach the parquet scan."""
    if name not in TEST_TABLES:
        raise ValueError(f"unknown test table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _read(spark: SparkSession, path: str, schema, fmt: str) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", "true").option("mode", "PERMISSIVE").csv(path)
    return reader.format(fmt).load(path)


def read_payments_raw(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """raw.payments_raw: every column text, schema declared (no inference)."""
    return _read(spark, path, schemas.PAYMENTS_RAW, fmt)


def read_fraud_raw(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """raw.fraud_signals_raw: every column text."""
    return _read(spark, path, schemas.FRAUD_SIGNALS_RAW, fmt)


def read_payment_transactions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """raw.payment_transactions (incremental pipeline): typed landing schema."""
    return _read(spark, path, schemas.PAYMENT_TRANSACTIONS, fmt)


def read_fraud_signals(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """raw.fraud_signals (incremental pipeline): typed landing schema."""
    return _read(spark, path, schemas.FRAUD_SIGNALS_TYPED, fmt)
