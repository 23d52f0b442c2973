"""Registered queries of the streaming design.

Each query lands its input (derived from the driver tables) as time-ordered files in a
fresh folder under the shared checkpoint dir, runs the Structured Streaming job with
one landed time range per micro-batch and ``availableNow``, waits for it, and returns the sink read
back as a batch DataFrame. The files of a range and the state partitions follow the number of landed rows. A far-future sentinel file ends each stream: the watermark
jumps past every open session / join bound, Spark runs one more (no-data) batch that
flushes append-mode state, and the sentinel rows are removed from the results.

Where the streaming result must equal a batch query (dedupe, join, velocity, routing,
tokens, validation), the DuckDB oracle states that batch query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import scratch_path, ship_package
from ..sinks.tables import read_if_exists
from ..sources import fixtures
from ..streaming import enrich, jobs, sources, stateful, upsert, validate, velocity
from .oracle_sql import sql_with
from .q_pci import token_key, token_sql
from .registry import register

SENTINEL_TS = ["2099-01-01 00:00:00", "2099-01-01 00:00:01"]
N_FILES = 4
N_SENTINELS = 1
# FIXED VALUES: the times at which one landed file ends and the next begins
FILE_CUTS = ["2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00"]
# FIXED VALUE: every tenth payment arrives this much after its event time in the late landing
STRAGGLER_DELAY = "INTERVAL '72' HOUR"
LATE_AFTER_SECONDS = 30 * 60


# State partitions of the registered streams, at least. A deployment sets its own: the count is fixed for the
# life of a checkpoint, so it follows the expected key count, not what the first batch happens to hold.
STATE_PARTITIONS = 8
ROWS_PER_STATE_PARTITION = 500_000
ROWS_PER_FILE = 100_000


def _payment_sentinel(spark, i: int) -> DataFrame:
    payload = ('{"transaction_id":"__sentinel__%d","merchant_id":"M0","customer_id":"__sentinel__","payment_method":"ach",'
               '"amount":0.00,"status":"captured","card_number":"0000","event_ts":"%s"}' % (i, SENTINEL_TS[i]))
    return spark.range(1).select(F.lit(payload).alias("payload"))


def _signal_sentinel(spark, i: int) -> DataFrame:
    payload = ('{"transaction_id":"__sentinel__%d","risk_score":0.00,"risk_level":"low","decision":"approve",'
               '"signal_ts":"%s"}' % (i, SENTINEL_TS[i]))
    return spark.range(1).select(F.lit(payload).alias("payload"))


@dataclass(frozen=True)
class Landing:
    """A landed payload stream: its folder, the files of one time range (one micro-batch) and its state partitions."""

    path: str
    files: int
    state_partitions: int


def _land(ctx, fixture: str, name: str, sentinel, late: bool = False) -> Landing:
    """The fixture's payloads as files by event time; with ``late``, by arrival time (stragglers come later)."""
    path = scratch_path(ctx.spark, name)
    arrival = F.col("order_ts")
    if late:
        arrival = F.when(F.col("event_id") % 10 == 7, arrival + F.expr(STRAGGLER_DELAY)).otherwise(arrival)
    rows = ctx.fx(fixture).select(arrival.alias("arrival_ts"), "payload", "event_id")
    sizes = [r["n"] for r in rows.groupBy(fixtures.landing_range("arrival_ts", FILE_CUTS)).agg(F.count(F.lit(1)).alias("n")).collect()]  # a row per range
    files = max(1, -(-max(sizes, default=0) // ROWS_PER_FILE))
    fixtures.land_files(rows, path, FILE_CUTS, "arrival_ts", files=files, key="event_id")
    for i in range(N_SENTINELS):
        sentinel(ctx.spark, i).write.mode("append").parquet(path)
    return Landing(path, files, max(STATE_PARTITIONS, -(-sum(sizes) // ROWS_PER_STATE_PARTITION)))


def _payments(ctx, late=False) -> Landing:
    key = f"_pay_path_{late}"
    if key not in ctx._memo:
        ctx._memo[key] = _land(ctx, "fx_stream_payments", "stream-payments", _payment_sentinel, late)
    return ctx._memo[key]


def _signals(ctx) -> Landing:
    if "_sig_path" not in ctx._memo:
        ctx._memo["_sig_path"] = _land(ctx, "fx_stream_signals", "stream-signals", _signal_sentinel)
    return ctx._memo["_sig_path"]


def _landed(ctx, fixture: str, sentinel) -> Landing:
    key = f"_landed_{fixture}"
    if key not in ctx._memo:
        ctx._memo[key] = _land(ctx, fixture, fixture.replace("_", "-"), sentinel)
    return ctx._memo[key]


def _signal_rows(ctx, landing: Landing) -> DataFrame:
    return sources.stream_signals(ctx.spark, landing.path, landing.files)


def wall_clock(df: DataFrame) -> DataFrame:
    """Event times back as TIMESTAMP_NTZ (the wall-clock text of the payload), so results do
    not depend on the reading session's time zone."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
                       else F.col(f.name) for f in df.schema.fields])


def _run_to_files(ctx, df: DataFrame, name: str, partition_by=None, state_partitions: int = STATE_PARTITIONS) -> DataFrame:
    out = scratch_path(ctx.spark, f"{name}-out")
    q = jobs.start_file_sink(df, out, scratch_path(ctx.spark, f"{name}-ckpt"), partition_by,
                             n_state_partitions=state_partitions)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return wall_clock(ctx.spark.read.parquet(out))


def _not_sentinel(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("transaction_id").startswith("__sentinel__"))


def _valid_payments(ctx, late=False, landing: Landing | None = None) -> DataFrame:
    landing = landing or _payments(ctx, late)
    raw = sources.payload_stream(ctx.spark, landing.path, landing.files)
    checked = validate.schema_validate(raw, "payload", schemas.PAYMENT_EVENT, schemas.PAYMENT_EVENT_REQUIRED)
    return checked.filter("is_valid").drop("payload", "is_valid", "error")


# ---- oracle fragments: the same streams parsed as tables ----------------------

S_LAYERS = {
    "sp": (["fx_stream_payments"], """
SELECT payload, json_valid(payload) AS ok,
       CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.transaction_id') END AS transaction_id,
       CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.merchant_id') END AS merchant_id,
       CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.customer_id') END AS customer_id,
       CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.payment_method') END AS payment_method,
       CASE WHEN json_valid(payload) THEN CAST(json_extract_string(payload, '$.amount') AS DECIMAL(18,2)) END AS amount,
       CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.status') END AS status,
       CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.card_number') END AS card_number,
       CASE WHEN json_valid(payload) THEN CAST(json_extract_string(payload, '$.event_ts') AS TIMESTAMP) END AS event_ts
FROM fx_stream_payments"""),
    "sp_valid": (["sp"], """SELECT * FROM sp WHERE ok AND transaction_id IS NOT NULL AND merchant_id IS NOT NULL
       AND amount IS NOT NULL AND event_ts IS NOT NULL"""),
    "sp_far_valid": (["fx_stream_versions"], """
SELECT * FROM (SELECT CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.transaction_id') END AS transaction_id,
       CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.merchant_id') END AS merchant_id,
       CASE WHEN json_valid(payload) THEN CAST(json_extract_string(payload, '$.amount') AS DECIMAL(18,2)) END AS amount,
       CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.status') END AS status,
       CASE WHEN json_valid(payload) THEN CAST(json_extract_string(payload, '$.event_ts') AS TIMESTAMP) END AS event_ts
FROM fx_stream_versions) x WHERE transaction_id IS NOT NULL AND merchant_id IS NOT NULL AND amount IS NOT NULL AND event_ts IS NOT NULL"""),
    "ss_far": (["fx_stream_signals_far"], """
SELECT json_extract_string(payload, '$.transaction_id') AS transaction_id,
       CAST(json_extract_string(payload, '$.risk_score') AS DECIMAL(3,2)) AS risk_score,
       json_extract_string(payload, '$.decision') AS decision,
       CAST(json_extract_string(payload, '$.signal_ts') AS TIMESTAMP) AS signal_ts
FROM fx_stream_signals_far"""),
    # the late landing: the file each valid payment arrives in, and the latest event time of the files before it
    "sp_arrived": (["sp_valid"], f"""
SELECT *, CASE {' '.join(f"WHEN arrival_ts < TIMESTAMP '{cut}' THEN {i}" for i, cut in enumerate(FILE_CUTS))}
       ELSE {len(FILE_CUTS)} END AS file_no
FROM (SELECT *, event_ts + CASE WHEN CAST(substr(transaction_id, 5) AS BIGINT) % 10 = 7 THEN {STRAGGLER_DELAY}
                ELSE INTERVAL '0' HOUR END AS arrival_ts FROM sp_valid) a"""),
    "sp_routed": (["sp_arrived"], f"""
SELECT a.*, COALESCE(a.event_ts < h.high - INTERVAL '{LATE_AFTER_SECONDS}' SECOND, false) AS late
FROM sp_arrived a LEFT JOIN (
  SELECT n.file_no, MAX(b.event_ts) AS high
  FROM (SELECT DISTINCT file_no FROM sp_arrived) n JOIN sp_arrived b ON b.file_no < n.file_no
  GROUP BY n.file_no) h ON a.file_no = h.file_no"""),
    "ss": (["fx_stream_signals"], """
SELECT json_extract_string(payload, '$.transaction_id') AS transaction_id,
       CAST(json_extract_string(payload, '$.risk_score') AS DECIMAL(3,2)) AS risk_score,
       json_extract_string(payload, '$.risk_level') AS risk_level,
       json_extract_string(payload, '$.decision') AS decision,
       CAST(json_extract_string(payload, '$.signal_ts') AS TIMESTAMP) AS signal_ts
FROM fx_stream_signals"""),
}


def ssql(names, final):
    return sql_with(names, final, extra=S_LAYERS)


# ---- sources ----------------------------------------------------------------

@register("src_stream_payments", ssql(["sp_valid"], "SELECT transaction_id, amount, status, event_ts FROM sp_valid"))
def _src_stream_payments(ctx):
    parsed = sources.stream_payments(ctx.spark, _payments(ctx).path, _payments(ctx).files)
    out = _run_to_files(ctx, parsed.filter(F.col("event_ts").isNotNull() & F.col("amount").isNotNull()
                                           & F.col("merchant_id").isNotNull()), "src-stream-payments")
    return _not_sentinel(out).select("transaction_id", "amount", "status", "event_ts")


@register("src_stream_signals", ssql(["ss"], "SELECT transaction_id, risk_score, decision, signal_ts FROM ss"))
def _src_stream_signals(ctx):
    parsed = _signal_rows(ctx, _signals(ctx))
    out = _run_to_files(ctx, parsed, "src-stream-signals")
    return _not_sentinel(out).select("transaction_id", "risk_score", "decision", "signal_ts")


def _settlement_dir(ctx) -> str:
    if "_st_dir" not in ctx._memo:
        path = scratch_path(ctx.spark, "settlement-drop")
        st = ctx.fx("fx_settlement")
        text = st.select(*[F.col(c).cast("string").alias(c) for c in st.columns])
        # a few malformed amounts, as a drop folder receives them
        text = text.withColumn("amount", F.when(F.col("settlement_id").endswith("7"), F.lit("12,50"))
                               .otherwise(F.col("amount")))
        (text.repartitionByRange(N_FILES, "settlement_date")
         .write.option("header", "true").mode("overwrite").csv(path))
        ctx._memo["_st_dir"] = path
    return ctx._memo["_st_dir"]


@register("src_settlement_files", sql_with(["fx_settlement"], """
SELECT settlement_id, transaction_id, CAST(settlement_date AS VARCHAR) AS settlement_date,
       CASE WHEN settlement_id LIKE '%7' THEN '12,50' ELSE CAST(amount AS VARCHAR) END AS amount,
       CAST(fee AS VARCHAR) AS fee, CAST(chargeback_flag AS VARCHAR) AS chargeback_flag FROM fx_settlement"""))
def _src_settlement(ctx):
    stream = sources.stream_settlement(ctx.spark, _settlement_dir(ctx), max_files=1)
    return _run_to_files(ctx, stream, "src-settlement")


# ---- st1 / st2: validation and DLQ -------------------------------------------

@register("st1_schema_validate", ssql(["sp"], """
SELECT CASE WHEN ok THEN transaction_id ELSE json_extract_string(
            regexp_replace(payload, ',"amount":$', '}'), '$.transaction_id') END AS transaction_id,
       CASE WHEN NOT ok THEN 'malformed json' WHEN transaction_id IS NULL THEN 'missing transaction_id'
            WHEN merchant_id IS NULL THEN 'missing merchant_id' WHEN amount IS NULL THEN 'missing amount'
            WHEN event_ts IS NULL THEN 'missing event_ts' END AS error
FROM sp"""))
def _st1(ctx):
    raw = sources.payload_stream(ctx.spark, _payments(ctx).path, _payments(ctx).files)
    checked = validate.schema_validate(raw, "payload", schemas.PAYMENT_EVENT, schemas.PAYMENT_EVENT_REQUIRED)
    out = _run_to_files(ctx, checked.select("transaction_id", "error", "is_valid", "payload"), "st1")
    tid = F.coalesce(F.col("transaction_id"), F.regexp_extract("payload", r'"transaction_id":"([^"]*)"', 1))
    return _not_sentinel(out.withColumn("transaction_id", tid)).select("transaction_id", "error")


def _dlq_run(ctx):
    if "_dlq" not in ctx._memo:
        good = scratch_path(ctx.spark, "st2-good")
        dlq = scratch_path(ctx.spark, "st2-dlq")
        q = jobs.start_validated_ingest(ctx.spark, _payments(ctx).path, good, dlq, scratch_path(ctx.spark, "st2-ckpt"), max_files=_payments(ctx).files)
        q.awaitTermination()
        ctx._memo["_dlq"] = (good, dlq)
    return ctx._memo["_dlq"]


@register("st2_dlq", ssql(["sp"], """
SELECT payload, CASE WHEN NOT ok THEN 'malformed json' WHEN transaction_id IS NULL THEN 'missing transaction_id'
            WHEN merchant_id IS NULL THEN 'missing merchant_id' WHEN amount IS NULL THEN 'missing amount'
            ELSE 'missing event_ts' END AS error
FROM sp WHERE NOT (ok AND transaction_id IS NOT NULL AND merchant_id IS NOT NULL AND amount IS NOT NULL
                   AND event_ts IS NOT NULL)"""))
def _st2(ctx):
    _good, dlq = _dlq_run(ctx)
    return wall_clock(ctx.spark.read.parquet(dlq).select("payload", "error"))


@register("st2_valid_rows", ssql(["sp_valid"], "SELECT transaction_id, merchant_id, customer_id, amount, status, event_ts FROM sp_valid"))
def _st2_good(ctx):
    good, _dlq = _dlq_run(ctx)
    rows = wall_clock(_not_sentinel(ctx.spark.read.parquet(good)))
    return rows.select("transaction_id", "merchant_id", "customer_id", "amount", "status", "event_ts")


# ---- st3: stream-stream join ----------------------------------------------------

BOUNDED_SQL = ssql(["sp_valid", "ss"], """
SELECT p.transaction_id, p.event_ts, p.status, s.risk_score, s.decision, s.signal_ts
FROM sp_valid p LEFT JOIN ss s ON p.transaction_id = s.transaction_id
 AND s.signal_ts >= p.event_ts AND s.signal_ts <= p.event_ts + INTERVAL 1 HOUR""")


@register("st3_bounded_join", BOUNDED_SQL)
def _st3_bounded(ctx):
    """The watermarked join: signals from the payment's time to an hour later."""
    joined = stateful.stream_join(_valid_payments(ctx), _signal_rows(ctx, _signals(ctx)), bound="1 hour")
    out = _run_to_files(ctx, joined.select("p.transaction_id", "p.event_ts", "p.status", "s.risk_score",
                                           "s.decision", "s.signal_ts"), "st3",
                        state_partitions=max(_payments(ctx).state_partitions, _signals(ctx).state_partitions))
    return _not_sentinel(out)


# Signals from hours before the payment to hours after it, two for some payments: joined on the id alone.
JOIN_SQL = ssql(["sp_valid", "ss_far"], """
SELECT p.transaction_id, p.event_ts, p.status, s.risk_score, s.decision, s.signal_ts
FROM sp_valid p LEFT JOIN ss_far s ON p.transaction_id = s.transaction_id""")


def _pending_join(ctx) -> enrich.PendingJoin:
    if "_pending" not in ctx._memo:
        payments = _valid_payments(ctx).select("transaction_id", "event_ts", "status")
        signals = _signal_rows(ctx, _landed(ctx, "fx_stream_signals_far", _signal_sentinel)).drop("risk_level")
        folder = scratch_path(ctx.spark, "st3-pending")
        job = enrich.PendingJoin(ctx.spark, folder, payments.schema, signals.schema, expiry="24 hours")
        w = enrich.both_sides(payments, signals).writeStream.foreachBatch(job.write).option("checkpointLocation", f"{folder}/checkpoint")
        jobs._trigger(w, True).start().awaitTermination()
        ctx._memo["_pending"] = job
    return ctx._memo["_pending"]


def _stream_join(ctx):
    return wall_clock(_not_sentinel(_pending_join(ctx).enriched()))


@register("st3_stream_join", JOIN_SQL)
def _st3(ctx):
    return _stream_join(ctx)


@register("join_fraud_stream", JOIN_SQL)
def _join_fraud_stream(ctx):
    return _stream_join(ctx)


@register("st3_pending_dlq", ssql(["sp_valid", "ss_far"], """
SELECT p.transaction_id, p.event_ts, 'no signal before expiry' AS error
FROM sp_valid p WHERE NOT EXISTS (SELECT 1 FROM ss_far s WHERE s.transaction_id = p.transaction_id)"""))
def _st3_dlq(ctx):
    return wall_clock(_not_sentinel(_pending_join(ctx).dead_letters()))


# ---- st4: dedupe ------------------------------------------------------------------

SESSION_SQL = ssql(["sp_valid"], """
SELECT transaction_id, status, amount, event_ts FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY event_ts DESC) AS rn FROM sp_valid) d
WHERE rn = 1""")


@register("st4_session_latest", SESSION_SQL)
def _st4_session(ctx):
    """The watermarked form: versions within 30 minutes of each other are one session."""
    d = stateful.dedupe_latest(_valid_payments(ctx), "transaction_id", "event_ts", "30 minutes")
    out = _run_to_files(ctx, d, "st4", state_partitions=_payments(ctx).state_partitions)
    return _not_sentinel(out).select("transaction_id", "status", "amount", "event_ts")


# A payment's versions lie minutes, hours and days apart and come in different files.
DEDUPE_SQL = ssql(["sp_far_valid"], """
SELECT transaction_id, status, amount, event_ts FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY event_ts DESC) AS rn FROM sp_far_valid) d
WHERE rn = 1""")


def _dedupe_latest(ctx):
    if "_upserted" not in ctx._memo:
        rows = _valid_payments(ctx, landing=_landed(ctx, "fx_stream_versions", _payment_sentinel)).select("transaction_id", "status", "amount", "event_ts")
        folder = scratch_path(ctx.spark, "st4-upsert")
        latest = upsert.UpsertTable(ctx.spark, f"{folder}/table", rows.schema, ["transaction_id"], ["event_ts"], buckets=8)
        w = rows.writeStream.foreachBatch(latest.writer(compact_every=2)).option("checkpointLocation", f"{folder}/checkpoint")
        jobs._trigger(w, True).start().awaitTermination()
        ctx._memo["_upserted"] = latest
    return wall_clock(_not_sentinel(ctx._memo["_upserted"].read()))


@register("st4_dedupe_latest", DEDUPE_SQL)
def _st4(ctx):
    return _dedupe_latest(ctx)


@register("dedupe_stream_latest", DEDUPE_SQL)
def _dedupe_stream_latest(ctx):
    return _dedupe_latest(ctx)


@register("st4b_dedupe_first", ssql(["sp_valid"], """
SELECT transaction_id, status, amount, event_ts FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY event_ts) AS rn FROM sp_valid) d
WHERE rn = 1"""))
def _st4b(ctx):
    d = stateful.dedupe_first(_valid_payments(ctx), "transaction_id", "event_ts", "30 minutes")
    out = _run_to_files(ctx, d, "st4b", state_partitions=_payments(ctx).state_partitions)
    return _not_sentinel(out).select("transaction_id", "status", "amount", "event_ts")


# ---- st5: late rows to the DLQ -----------------------------------------------------

@register("st5_late_to_dlq", ssql(["sp_routed"], """
SELECT transaction_id, event_ts, CASE WHEN late THEN 'dlq' ELSE 'on_time' END AS route FROM sp_routed"""))
def _st5(ctx):
    good, dlq, hwm = (scratch_path(ctx.spark, n) for n in ("st5-good", "st5-dlq", "st5-hwm"))
    stream = _valid_payments(ctx, late=True)
    w = stream.writeStream.foreachBatch(validate.late_router("event_ts", LATE_AFTER_SECONDS, good, dlq, hwm)) \
              .option("checkpointLocation", scratch_path(ctx.spark, "st5-ckpt"))
    jobs._trigger(w, True).start().awaitTermination()
    g = ctx.spark.read.parquet(good).select("transaction_id", "event_ts", F.lit("on_time").alias("route"))
    d = read_if_exists(ctx.spark, dlq)
    if d is not None:  # some row was late
        g = g.unionByName(d.select("transaction_id", "event_ts", F.lit("dlq").alias("route")))
    return wall_clock(_not_sentinel(g))


# ---- st6: partitioned bronze append -------------------------------------------------

@register("st6_bronze_append", ssql(["sp_valid"], """
SELECT transaction_id, amount, event_ts, CAST(event_ts AS DATE) AS ingestion_date FROM sp_valid"""))
def _st6(ctx):
    s = _valid_payments(ctx).withColumn("ingestion_date", F.col("event_ts").cast("date"))
    out = _run_to_files(ctx, s.select("transaction_id", "amount", "event_ts", "ingestion_date"), "st6",
                        partition_by=["ingestion_date"])
    return _not_sentinel(out).select("transaction_id", "amount", "event_ts", "ingestion_date")


# ---- the composed job: payload -> DLQ or bronze ---------------------------------------

def _bronze_run(ctx) -> tuple[str, str]:
    if "_bronze" not in ctx._memo:
        folder = scratch_path(ctx.spark, "bronze-job")
        bronze, dlq = f"{folder}/bronze", f"{folder}/dlq"
        pay, sig = _payments(ctx, late=True), _signals(ctx)
        jobs.run_bronze_pipeline(ctx.spark, pay.path, sig.path, bronze, dlq, folder, token_key(ctx), late_after_seconds=LATE_AFTER_SECONDS,
                                 n_state_partitions=max(pay.state_partitions, sig.state_partitions), max_files=pay.files, max_signal_files=sig.files)
        ctx._memo["_bronze"] = (bronze, dlq)
    return ctx._memo["_bronze"]


@register("pipeline_bronze_events", ssql(["sp_routed", "ss"], f"""
SELECT p.transaction_id, p.merchant_id, p.status, p.amount, p.event_ts, {token_sql('p.card_number')} AS tokenized_pan,
       s.risk_score, s.decision, CAST(p.event_ts AS DATE) AS ingestion_date
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY event_ts DESC) AS rn
      FROM sp_routed WHERE NOT late) p
LEFT JOIN ss s ON p.transaction_id = s.transaction_id AND s.signal_ts BETWEEN p.event_ts - INTERVAL 1 HOUR
      AND p.event_ts + INTERVAL 1 HOUR
WHERE p.rn = 1"""))
def _bronze_events(ctx):
    bronze, _dlq = _bronze_run(ctx)
    return wall_clock(_not_sentinel(ctx.spark.read.parquet(bronze))).select(
        "transaction_id", "merchant_id", "status", "amount", "event_ts", "tokenized_pan", "risk_score", "decision",
        "ingestion_date")


@register("pipeline_dlq", ssql(["sp", "sp_routed"], """
SELECT payload, CASE WHEN NOT ok THEN 'malformed json' WHEN transaction_id IS NULL THEN 'missing transaction_id'
            WHEN merchant_id IS NULL THEN 'missing merchant_id' WHEN amount IS NULL THEN 'missing amount'
            ELSE 'missing event_ts' END AS error
FROM sp WHERE NOT (ok AND transaction_id IS NOT NULL AND merchant_id IS NOT NULL AND amount IS NOT NULL
                   AND event_ts IS NOT NULL)
UNION ALL
SELECT payload, 'late event' FROM sp_routed WHERE late"""))
def _bronze_dlq(ctx):
    _bronze, dlq = _bronze_run(ctx)
    return ctx.spark.read.parquet(dlq).select("payload", "error")


# ---- st7: velocity with state --------------------------------------------------------

def _velocity(ctx, rows: DataFrame, name: str) -> DataFrame:
    ship_package(ctx.spark)
    with velocity.rocksdb_state(ctx.spark):
        n = _payments(ctx).state_partitions
        return _not_sentinel(_run_to_files(ctx, velocity.velocity(rows, minutes=24 * 60, delay="30 minutes", shards=n), name, state_partitions=n))


def _velocity_sql(customer: str) -> str:
    return ssql(["sp_valid"], f"""
, rows AS (SELECT {customer} AS customer_id, transaction_id, event_ts FROM sp_valid)
SELECT customer_id, transaction_id, event_ts,
       (SELECT COUNT(*) FROM rows b WHERE b.customer_id = a.customer_id AND b.event_ts >= a.event_ts - INTERVAL 24 HOUR
          AND (b.event_ts < a.event_ts OR (b.event_ts = a.event_ts AND b.transaction_id < a.transaction_id))) AS prior_count
FROM rows a""")


@register("st7_velocity_state", _velocity_sql("customer_id"))
def _st7(ctx):
    return _velocity(ctx, _valid_payments(ctx), "st7")


@register("st7_velocity_hot", _velocity_sql("CASE CAST(substr(transaction_id, 5) AS BIGINT) % 3 WHEN 0 THEN 'C_HOT' WHEN 1 THEN customer_id "
                                            "ELSE CASE WHEN CAST(substr(transaction_id, 5) AS BIGINT) % 7 > 0 THEN customer_id END END"))
def _st7_hot(ctx):
    """One customer with a third of all events; some events without a customer."""
    number = F.expr("CAST(substr(transaction_id, 5) AS BIGINT)")
    customer = F.when(F.col("transaction_id").startswith("__"), F.col("customer_id")).otherwise(
        F.when(number % 3 == 0, F.lit("C_HOT")).when((number % 3 == 1) | (number % 7 > 0), F.col("customer_id")))
    rows = _valid_payments(ctx).withColumn("customer_id", customer)
    return _velocity(ctx, rows, "st7-hot")


# ---- st8 / st9 / st10 ------------------------------------------------------------------

@register("st8_route_signals", ssql(["ss"], """
SELECT topic, transaction_id AS key FROM ss, unnest(list_filter(
  [CASE WHEN lower(risk_level) IN ('high', 'critical') THEN 'fraud.alerts' ELSE 'fraud.signals' END,
   CASE WHEN lower(decision) <> 'approve' THEN 'fraud.decisions' END], lambda x: x IS NOT NULL)) t(topic)"""))
def _st8(ctx):
    sig = _signal_rows(ctx, _signals(ctx))
    out = _run_to_files(ctx, jobs.route_signals_stream(sig), "st8")
    return out.filter(~F.col("key").startswith("__sentinel__")).select("topic", "key")


@register("st9_subscribe", ssql(["ss"], "SELECT decision, COUNT(*) AS signals FROM ss GROUP BY decision"))
def _st9(ctx):
    sink = scratch_path(ctx.spark, "st9-out")

    def callback(batch: DataFrame, batch_id: int) -> None:
        (_not_sentinel(batch).groupBy("decision").agg(F.count(F.lit(1)).alias("signals"))
         .withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}"))

    sig = _signal_rows(ctx, _signals(ctx))
    jobs.subscribe(sig, callback, scratch_path(ctx.spark, "st9-ckpt")).awaitTermination()
    return ctx.spark.read.parquet(sink).groupBy("decision").agg(F.sum("signals").alias("signals"))


@register("st10_tokenize_stream", ssql(["sp_valid"], f"""
SELECT transaction_id, event_ts, {token_sql('card_number')} AS tokenized_pan FROM sp_valid"""))
def _st10(ctx):
    t = jobs.tokenize_stream(_valid_payments(ctx), "card_number", token_key(ctx))
    out = _run_to_files(ctx, t.select("transaction_id", "event_ts", "tokenized_pan"), "st10")
    return _not_sentinel(out)


# ---- st11 and lag alert ------------------------------------------------------------------

@register("st11_settlement_ingest", sql_with(["fx_settlement"], """
SELECT settlement_id, transaction_id, settlement_date, CAST(amount AS DECIMAL(18,2)) AS amount, fee, chargeback_flag
FROM fx_settlement WHERE settlement_id NOT LIKE '%7'"""))
def _st11(ctx):
    bronze, dlq = scratch_path(ctx.spark, "st11-bronze"), scratch_path(ctx.spark, "st11-dlq")
    q = jobs.start_settlement_ingest(ctx.spark, _settlement_dir(ctx), bronze, dlq, scratch_path(ctx.spark, "st11-ckpt"),
                                     max_files=1)
    q.awaitTermination()
    return ctx.spark.read.parquet(bronze).select("settlement_id", "transaction_id", "settlement_date", "amount",
                                                 "fee", "chargeback_flag")


@register("st11_settlement_dlq", sql_with(["fx_settlement"], """
SELECT settlement_id, transaction_id, '12,50' AS amount, 'bad amount' AS error
FROM fx_settlement WHERE settlement_id LIKE '%7'"""))
def _st11_dlq(ctx):
    bronze, dlq = scratch_path(ctx.spark, "st11-bronze"), scratch_path(ctx.spark, "st11-dlq")
    jobs.start_settlement_ingest(ctx.spark, _settlement_dir(ctx), bronze, dlq, scratch_path(ctx.spark, "st11-ckpt"),
                                 max_files=1).awaitTermination()
    return ctx.spark.read.parquet(dlq).select("settlement_id", "transaction_id", "_raw.amount", "error")


@register("alert_stream_lag")
def _lag(ctx):
    d = stateful.dedupe_latest(_valid_payments(ctx), "transaction_id", "event_ts", "30 minutes")
    out = scratch_path(ctx.spark, "lag-out")
    q = jobs.start_file_sink(d, out, scratch_path(ctx.spark, "lag-ckpt"),
                             n_state_partitions=_payments(ctx).state_partitions)
    q.awaitTermination()
    return wall_clock(jobs.alert_stream_lag(ctx.spark, jobs.lag_rows(q), 60))
