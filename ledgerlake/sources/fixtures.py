"""Domain views over the driver tables (FIXTURES.md section 3).

Each fixture is one SQL text with ``{name}`` placeholders for its inputs. Spark
runs it through ``spark.sql(text, name=DataFrame)``; the DuckDB oracle inlines the
same text as a CTE, so both engines start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import TEST_TABLES, table

_CURRENCY_CASE = ("CASE event_id % 7 WHEN 0 THEN 'usd' WHEN 1 THEN 'eur' WHEN 2 THEN 'gbp' WHEN 3 THEN 'jpy' "
                  "WHEN 4 THEN 'cad' WHEN 5 THEN 'aud' ELSE 'xxx' END")
_METHOD_CASE = ("CASE event_id % 6 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'ach' "
                "WHEN 3 THEN 'wire' WHEN 4 THEN 'digital_wallet' ELSE 'crypto' END")


def _check_digit_sql(body: str, n: int) -> str:
    """The Luhn check digit of ``n`` digits as text: from the right every second digit, the last one first, counts twice."""
    def weighed(i: int) -> str:
        d = f"CAST(substr({body}, {i}, 1) AS INT)"
        return f"CASE WHEN {d} > 4 THEN {d} * 2 - 9 ELSE {d} * 2 END" if (n - i) % 2 == 0 else d

    return f"CAST((10 - ({' + '.join(weighed(i) for i in range(1, n + 1))}) % 10) % 10 AS STRING)"


FIXTURES: dict[str, tuple[list[str], str]] = {
    "fx_base": (["events"], """
SELECT event_id, user_id, ts, event_type, CAST(value AS DECIMAL(18,2)) AS amt,
       CAST(date_trunc('second', ts) AS STRING) AS created_s,
       CAST(date_trunc('second', ts + (event_id % 5) * INTERVAL '1' HOUR) AS STRING) AS updated_s,
       CAST(date_trunc('second', ts + INTERVAL '24' HOUR) AS STRING) AS updated_dup_s,
       props
FROM {events}"""),
    "fx_payments_raw": (["fx_base"], f"""
SELECT 'PAY_' || lpad(CAST(event_id AS STRING), 9, '0') AS payment_id,
       'M' || CAST(event_id % 20 AS STRING) AS merchant_id,
       'C' || CAST(user_id AS STRING) AS customer_id,
       CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(amt AS STRING) END AS amount,
       {_CURRENCY_CASE} AS currency,
       {_METHOD_CASE} AS payment_method,
       CASE WHEN event_id % 11 = 0 THEN 'pending' WHEN event_type = 'signup' THEN 'authorized' WHEN event_type = 'purchase' THEN 'captured' WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'click' THEN 'declined' ELSE 'refunded' END AS status,
       CASE WHEN event_id % 101 = 0 THEN 'bad-ts' ELSE created_s END AS created_at,
       updated_s AS updated_at,
       props AS metadata
FROM {{fx_base}}
UNION ALL
SELECT 'PAY_' || lpad(CAST(event_id AS STRING), 9, '0') AS payment_id,
       'M' || CAST(event_id % 20 AS STRING) AS merchant_id,
       'C' || CAST(user_id AS STRING) AS customer_id,
       CAST(amt AS STRING) AS amount,
       {_CURRENCY_CASE} AS currency,
       {_METHOD_CASE} AS payment_method,
       'captured' AS status,
       created_s AS created_at,
       updated_dup_s AS updated_at,
       props AS metadata
FROM {{fx_base}} WHERE event_id % 10 = 0"""),
    "fx_fraud_signals_raw": (["events"], """
SELECT 'SIG_' || lpad(CAST(event_id AS STRING), 9, '0') AS signal_id,
       'PAY_' || lpad(CAST(event_id AS STRING), 9, '0') AS transaction_id,
       CAST(CAST(CAST((event_id * 37) % 101 AS DECIMAL(5,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(3,2)) AS STRING) AS risk_score,
       CASE WHEN (event_id * 37) % 101 >= 75 THEN 'critical' WHEN (event_id * 37) % 101 >= 50 THEN 'high' WHEN (event_id * 37) % 101 >= 25 THEN 'medium' ELSE 'low' END AS risk_level,
       CASE WHEN event_id % 3 = 0 THEN '["amount_anomaly","velocity_exceeded"]' ELSE '[]' END AS alerts,
       CASE event_id % 9 WHEN 0 THEN 'decline' WHEN 1 THEN 'review' WHEN 2 THEN 'challenge' WHEN 3 THEN 'block' WHEN 4 THEN 'escalate' ELSE 'approve' END AS decision,
       CASE event_id % 6 WHEN 0 THEN 'pending' WHEN 1 THEN 'under_review' WHEN 2 THEN 'resolved' WHEN 3 THEN 'escalated' WHEN 4 THEN 'closed' ELSE 'other' END AS case_status,
       CAST(date_trunc('second', ts + INTERVAL '5' MINUTE) AS STRING) AS created_at
FROM {events} WHERE event_id % 8 <> 0"""),
    "fx_settlement": (["fx_base"], """
SELECT 'ST_' || CAST(event_id AS STRING) AS settlement_id,
       'PAY_' || lpad(CAST(event_id AS STRING), 9, '0') AS transaction_id,
       CAST(ts + INTERVAL '48' HOUR AS DATE) AS settlement_date,
       CASE WHEN event_id % 50 = 0 THEN amt + CAST(1.00 AS DECIMAL(18,2)) ELSE amt END AS amount,
       CAST(amt * CAST(0.02 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS fee,
       event_id % 40 = 0 AS chargeback_flag
FROM {fx_base} WHERE event_id % 12 <> 0
UNION ALL
SELECT 'ST_X' || CAST(event_id AS STRING), 'PAY_X' || CAST(event_id AS STRING), CAST(ts AS DATE), amt, CAST(0 AS DECIMAL(18,2)), false
FROM {fx_base} WHERE event_id % 200 = 0"""),
    "fx_payments_bulk": (["lineitem", "orders"], """
SELECT 'LI_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) AS payment_id,
       'M' || CAST(l_suppkey AS STRING) AS merchant_id, 'C' || CAST(o_custkey AS STRING) AS customer_id,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) AS amount, 'usd' AS currency,
       CASE l_partkey % 5 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'ach' WHEN 3 THEN 'wire' ELSE 'digital_wallet' END AS payment_method,
       CASE WHEN l_returnflag = 'R' THEN 'refunded' WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'declined' WHEN l_linestatus = 'O' THEN 'captured' ELSE 'authorized' END AS status,
       CAST(date_trunc('second', l_shipdate) AS STRING) AS created_at,
       CAST(date_trunc('second', l_shipdate + l_linenumber * INTERVAL '1' HOUR) AS STRING) AS updated_at,
       '{{}}' AS metadata
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""),
    # One signal for seven of eight bulk payments, so that the bulk fraud join meets rows.
    "fx_fraud_signals_bulk": (["lineitem"], """
SELECT 'SIG_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) AS signal_id,
       'LI_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) AS transaction_id,
       CAST(CAST(CAST((l_partkey * 37 + l_linenumber) % 101 AS DECIMAL(5,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(3,2)) AS STRING) AS risk_score,
       CASE WHEN (l_partkey * 37 + l_linenumber) % 101 >= 75 THEN 'critical' WHEN (l_partkey * 37 + l_linenumber) % 101 >= 50 THEN 'high' WHEN (l_partkey * 37 + l_linenumber) % 101 >= 25 THEN 'medium' ELSE 'low' END AS risk_level,
       CASE WHEN l_partkey % 3 = 0 THEN '["amount_anomaly","velocity_exceeded"]' ELSE '[]' END AS alerts,
       CASE l_partkey % 9 WHEN 0 THEN 'decline' WHEN 1 THEN 'review' WHEN 2 THEN 'challenge' WHEN 3 THEN 'block' WHEN 4 THEN 'escalate' ELSE 'approve' END AS decision,
       CASE l_partkey % 6 WHEN 0 THEN 'pending' WHEN 1 THEN 'under_review' WHEN 2 THEN 'resolved' WHEN 3 THEN 'escalated' WHEN 4 THEN 'closed' ELSE 'other' END AS case_status,
       CAST(date_trunc('second', l_shipdate + l_linenumber * INTERVAL '1' HOUR) AS STRING) AS created_at
FROM {lineitem} WHERE l_partkey % 8 <> 0"""),
    # Payment events of the streaming design (pipeline C), one per event.
    "fx_payment_events": (["fx_base"], f"""
SELECT 'PAY_' || lpad(CAST(event_id AS STRING), 9, '0') AS transaction_id,
       'M' || CAST(event_id % 20 AS STRING) AS merchant_id,
       'C' || CAST(user_id AS STRING) AS customer_id,
       {_METHOD_CASE} AS payment_method,
       CASE WHEN event_type = 'signup' THEN 'authorized' WHEN event_type = 'purchase' THEN 'captured' WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'click' THEN 'declined' ELSE 'refunded' END AS status,
       ts AS event_ts,
       amt AS amount,
       {_CURRENCY_CASE} AS currency
FROM {{fx_base}}"""),
    # Payment-event stream payloads (JSON text): a second version of every 10th payment 10 minutes
    # later, malformed JSON for every 53rd and a missing amount for every 59th event.
    "fx_stream_payments": (["fx_payment_events"], """
SELECT event_id, order_ts,
       CASE WHEN event_id % 53 = 0 THEN '{{"transaction_id":"' || transaction_id || '","amount":'
            ELSE '{{"transaction_id":"' || transaction_id || '","merchant_id":"' || merchant_id
                 || '","customer_id":"' || customer_id || '","payment_method":"' || payment_method
                 || CASE WHEN event_id % 59 = 0 THEN '' ELSE '","amount":' || CAST(amount AS STRING) || ',"status":"' END
                 || CASE WHEN event_id % 59 = 0 THEN '","status":"' ELSE '' END
                 || status || '","card_number":"4' || lpad(CAST(event_id * 7919 % 1000000000000000 AS STRING), 15, '0')
                 || '","event_ts":"' || CAST(order_ts AS STRING) || '"}}' END AS payload
FROM (SELECT *, CAST(substr(transaction_id, 5) AS BIGINT) AS event_id, event_ts AS order_ts FROM {fx_payment_events}
      UNION ALL
      SELECT transaction_id, merchant_id, customer_id, payment_method, 'captured', event_ts, amount, currency,
             CAST(substr(transaction_id, 5) AS BIGINT), event_ts + INTERVAL '10' MINUTE
      FROM {fx_payment_events} WHERE CAST(substr(transaction_id, 5) AS BIGINT) % 10 = 0) e"""),
    "fx_stream_signals": (["fx_fraud_signals_raw"], """
SELECT CAST(substr(transaction_id, 5) AS BIGINT) AS event_id, CAST(created_at AS TIMESTAMP) AS order_ts,
       '{{"transaction_id":"' || transaction_id || '","risk_score":' || risk_score || ',"risk_level":"' || risk_level
       || '","decision":"' || decision || '","signal_ts":"' || created_at || '"}}' AS payload
FROM {fx_fraud_signals_raw}"""),
    # Versions of a payment that lie far apart: a second one 5 hours later for every 7th payment, a third one 9 days later for every 21st,
    # beside the versions 10 minutes later.
    "fx_stream_versions": (["fx_stream_payments", "fx_payment_events"], """
SELECT event_id, order_ts, payload FROM {fx_stream_payments}
UNION ALL
SELECT event_id, order_ts, '{{"transaction_id":"' || transaction_id || '","merchant_id":"' || merchant_id || '","customer_id":"' || customer_id
       || '","payment_method":"' || payment_method || '","amount":' || CAST(amount AS STRING) || ',"status":"' || status || '","card_number":"4","event_ts":"' || CAST(order_ts AS STRING) || '"}}'
FROM (SELECT transaction_id, merchant_id, customer_id, payment_method, amount, 'captured' AS status, CAST(substr(transaction_id, 5) AS BIGINT) AS event_id,
             event_ts + INTERVAL '5' HOUR AS order_ts FROM {fx_payment_events} WHERE CAST(substr(transaction_id, 5) AS BIGINT) % 7 = 0
      UNION ALL
      SELECT transaction_id, merchant_id, customer_id, payment_method, amount, 'refunded', CAST(substr(transaction_id, 5) AS BIGINT),
             event_ts + INTERVAL '216' HOUR FROM {fx_payment_events} WHERE CAST(substr(transaction_id, 5) AS BIGINT) % 21 = 0) v"""),
    # Signals up to 3 hours before and 9 hours after their payment, a second one for every 9th.
    "fx_stream_signals_far": (["fx_payment_events"], """
SELECT event_id, order_ts,
       '{{"transaction_id":"' || transaction_id || '","risk_score":' || CAST(score AS STRING) || ',"risk_level":"low","decision":"'
       || CASE WHEN event_id % 4 = 0 THEN 'review' ELSE 'approve' END || '","signal_ts":"' || CAST(order_ts AS STRING) || '"}}' AS payload
FROM (SELECT transaction_id, event_id, CAST(CAST(event_id % 100 AS DECIMAL(5,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(3,2)) AS score,
             event_ts + (event_id % 13 - 3) * INTERVAL '1' HOUR AS order_ts
      FROM (SELECT transaction_id, event_ts, CAST(substr(transaction_id, 5) AS BIGINT) AS event_id FROM {fx_payment_events}) a WHERE event_id % 5 <> 0
      UNION ALL
      SELECT transaction_id, event_id, CAST(0.99 AS DECIMAL(3,2)), event_ts + INTERVAL '11' HOUR
      FROM (SELECT transaction_id, event_ts, CAST(substr(transaction_id, 5) AS BIGINT) AS event_id FROM {fx_payment_events}) b
      WHERE event_id % 9 = 0 AND event_id % 5 <> 0) e"""),
    # Sensitive-record table in the shape of the reference's PCI tests (card, cvv, name,
    # e-mail, phone), derived from `customer`; a few rows carry short / empty / malformed values.
    "fx_cardholders": (["customer"], """
SELECT 'H' || CAST(c_custkey AS STRING) AS holder_id,
       CASE WHEN c_custkey % 211 = 0 THEN '' WHEN c_custkey % 223 = 0 THEN CAST(c_custkey % 1000 AS STRING)
            ELSE card16 END AS card_number,
       lpad(CAST((c_custkey * 37) % 1000 AS STRING), 3, '0') AS cvv,
       CASE WHEN c_custkey % 199 = 0 THEN '' ELSE lower(c_mktsegment) || ' ' || replace(c_name, 'Customer#', 'Holder') END AS cardholder_name,
       CASE WHEN c_custkey % 101 = 0 THEN 'no-at-sign' ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
       CASE WHEN c_custkey % 191 = 0 THEN '12' ELSE '555-' || lpad(CAST(c_custkey % 1000 AS STRING), 3, '0') || '-' || lpad(CAST((c_custkey * 13) % 10000 AS STRING), 4, '0') END AS phone,
       lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0') || '/' || CAST(25 + c_custkey % 5 AS STRING) AS expiration_date,
       CAST(c_acctbal AS DECIMAL(18,2)) AS amount
FROM (SELECT *, body || """ + _check_digit_sql("body", 15) + """ AS card16
      FROM (SELECT *, '4' || lpad(CAST((c_custkey * 7919 + 12345) % 100000000000000 AS STRING), 14, '0') AS body FROM {customer}) b) c"""),
    # Free text with card numbers in several forms and with numbers that are none.
    "fx_card_notes": (["customer"], """
SELECT 'H' || CAST(c_custkey AS STRING) AS holder_id, CAST(c_custkey % 6 AS INT) AS kind,
       CASE c_custkey % 6
            WHEN 0 THEN 'paid with ' || substr(card16, 1, 4) || '-' || substr(card16, 5, 4) || '-' || substr(card16, 9, 4) || '-' || substr(card16, 13, 4) || ', thanks'
            WHEN 1 THEN 'card ' || substr(card16, 1, 4) || ' ' || substr(card16, 5, 4) || ' ' || substr(card16, 9, 4) || ' ' || substr(card16, 13, 4)
            WHEN 2 THEN 'order ' || substr(card16, 1, 15) || CAST((CAST(substr(card16, 16, 1) AS INT) + 1) % 10 AS STRING) || ' shipped'
            WHEN 3 THEN 'amex ' || card15 || '.'
            WHEN 4 THEN 'write to holder' || CAST(c_custkey AS STRING) || '@example.com or call 555-010-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')
            ELSE 'parcel ' || card16 || '0000' END AS note
FROM (SELECT *, body || """ + _check_digit_sql("body", 15) + """ AS card16, amex || """ + _check_digit_sql("amex", 14) + """ AS card15
      FROM (SELECT *, '4' || lpad(CAST((c_custkey * 7919 + 12345) % 100000000000000 AS STRING), 14, '0') AS body,
                   '37' || lpad(CAST((c_custkey * 104729 + 777) % 1000000000000 AS STRING), 12, '0') AS amex FROM {customer}) b) c"""),
}

# FIXED VALUE: the evaluation time used by every query over the fixtures
AS_OF = "2024-04-10 00:00:00"


def fixture(spark: SparkSession, sf_dir: str, name: str, _memo: dict | None = None) -> DataFrame:
    """Build fixture ``name`` (and its inputs) over the tables in ``sf_dir``."""
    memo = {} if _memo is None else _memo
    if name in memo:
        return memo[name]
    if name in TEST_TABLES:
        df = table(spark, sf_dir, name)
    else:
        deps, text = FIXTURES[name]
        inputs = {d: fixture(spark, sf_dir, d, memo) for d in deps}
        df = spark.sql(text, **inputs)
    memo[name] = df
    return df


def oracle_ctes(*names: str) -> str:
    """``WITH`` clause (no trailing comma) defining the named fixtures for DuckDB."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in TEST_TABLES or n in order:
            return
        for d in FIXTURES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        deps, text = FIXTURES[n]
        parts.append(f"{n} AS ({text.format(**{d: d for d in deps})}\n)")
    return "WITH " + ",\n".join(parts)


def landing_range(order_col: str, cuts: list[str]) -> Column:
    """Which of the ranges between the cut times a row falls into; rows without a time come with the first."""
    at = F.col(order_col).cast("timestamp_ntz")
    number = sum((F.when(at >= F.lit(cut).cast("timestamp_ntz"), 1).otherwise(0) for cut in cuts), F.lit(0))
    return number.cast("int")


def land_files(df: DataFrame, path: str, cuts: list[str], order_col: str, fmt: str = "parquet", files: int = 1, key: str | None = None) -> str:
    """Drop ``df`` into ``path`` the way an upstream system does: ``files`` files per range between the
    given cut times, one range written after another, so file modification order equals the order of the
    ranges and every ``files`` files are one range (a range that fills fewer is made up by empty files). The caller's
    cut times fix the ranges, whatever the number of rows. Within a range the rows of one ``key`` are in one file,
    in the order of ``order_col``. Rows without a time come with the first range."""
    spark, staged = df.sparkSession, f"{path.rstrip('/')}-staged"
    # computed once into the shared folder, by range; each range's write below reads its own part only
    keyed = df.withColumn("_range", landing_range(order_col, cuts))
    keyed.write.partitionBy("_range").parquet(staged)
    rows = spark.read.schema(keyed.schema).parquet(staged)
    kept = df.schema if key is None else df.drop(key).schema
    landed = 0
    for number in range(len(cuts) + 1):
        part = rows.filter(F.col("_range") == number)
        if files > 1:
            part = part.repartition(files, *([] if key is None else [key]))
        part.select(*df.columns).coalesce(files).sortWithinPartitions(order_col).select(*kept.names).write.mode("append").format(fmt).save(path)
        landed += files
        for _ in range(landed - len(spark.read.schema(kept).format(fmt).load(path).inputFiles())):
            spark.createDataFrame([], kept).coalesce(1).write.mode("append").format(fmt).save(path)
    return path
