"""Stateful stream operators with built-in state: watermarked dedupe, stream-stream join.

* dedupe_latest: ``QUALIFY ROW_NUMBER() ... = 1`` is illegal on a stream, so the latest
  row per key is ``max_by(row, ts)`` over a session window whose gap is the watermark
  delay; state is evicted when the watermark passes the session. Versions of a key that
  arrive more than the delay apart form separate sessions (``upsert`` keeps one row per key).
* dedupe_first: ``dropDuplicatesWithinWatermark`` (keeps the first row).
* stream_join: both sides watermarked, equi-join plus a time bound, so the state of each
  side is bounded; a left-outer row without a match is emitted once the watermark
  passes its bound (``enrich`` joins without a time bound).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def dedupe_latest(stream: DataFrame, key: str, ts: str, delay: str = K.WATERMARK_DELAY,
                  watermarked: bool = False) -> DataFrame:
    """``watermarked``: ``ts`` carries a watermark already (a watermark cannot be set twice)."""
    cols = stream.columns
    return ((stream if watermarked else stream.withWatermark(ts, delay))
            .groupBy(F.col(key).alias("_k"), F.session_window(F.col(ts), delay).alias("_w"))
            .agg(F.max_by(F.struct(*cols), F.struct(F.col(ts), *[F.col(c) for c in cols])).alias("_r"))
            .select("_r.*"))


def dedupe_first(stream: DataFrame, key: str, ts: str, delay: str = K.WATERMARK_DELAY) -> DataFrame:
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def stream_join(payments: DataFrame, signals: DataFrame, key: str = "transaction_id", p_ts: str = "event_ts",
                s_ts: str = "signal_ts", delay: str = K.WATERMARK_DELAY, bound: str = "1 hour",
                how: str = "leftOuter", before: str = "0 seconds") -> DataFrame:
    """payments LEFT JOIN signals ON key AND s_ts BETWEEN p_ts - before AND p_ts + bound. A positive
    ``before`` also lets a later version of a payment meet the signal of its first version."""
    p = payments.withWatermark(p_ts, delay).alias("p")
    s = signals.withColumnRenamed(key, "_s_key").withWatermark(s_ts, delay).alias("s")
    cond = ((F.col(f"p.{key}") == F.col("s._s_key"))
            & (F.col(f"s.{s_ts}") >= F.col(f"p.{p_ts}") - F.expr(f"INTERVAL {before}"))
            & (F.col(f"s.{s_ts}") <= F.col(f"p.{p_ts}") + F.expr(f"INTERVAL {bound}")))
    return p.join(s, cond, how).drop("_s_key")
