"""Window-style operators written so that one hot key cannot pin a whole task.

* ``latest_per_key`` uses ``row_number() == 1``; Catalyst turns that into a
  WindowGroupLimit that also runs *before* the shuffle, so a key holding a third
  of all rows reaches the exchange as at most one row per map task.
* Per-key totals attached to every row (COUNT/AVG/MAX OVER PARTITION BY key) are an
  aggregate joined back: the aggregate combines map-side, and the join back is a
  plain equi-join whose skewed partitions AQE can split.
* Time-bounded counts (velocity) are windows over (key, time bucket as wide as the window), each row
  standing in its own bucket and the next: one exchange, and a busy customer is spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _desc(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.desc_nulls_last()


def latest_per_key(df: DataFrame, keys: list[str], order_desc: list) -> DataFrame:
    """Keep one row per key: the greatest by ``order_desc`` (each DESC NULLS LAST)."""
    w = Window.partitionBy(*keys).orderBy(*[_desc(c) for c in order_desc])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def per_key_totals(df: DataFrame, key: str, aggs: list[Column]) -> DataFrame:
    """Attach per-key aggregates to every row (the ``agg() OVER (PARTITION BY key)`` result)."""
    totals = df.groupBy(F.col(key).alias("_key")).agg(*aggs)
    return df.join(totals, df[key].eqNullSafe(totals["_key"]), "left").drop("_key")


def window_count(df: DataFrame, key: str, name: str = "key_count") -> DataFrame:
    """COUNT(*) OVER (PARTITION BY key)."""
    return per_key_totals(df, key, [F.count(F.lit(1)).alias(name)])


def _micros(ts, ntz: bool = True) -> Column:
    """Microseconds since the epoch. For wall-clock (TIMESTAMP_NTZ) times the difference to
    the epoch is taken on the wall clock itself, so the session time zone (and its DST
    jumps) never changes a window length."""
    col = F.col(ts) if isinstance(ts, str) else ts
    if ntz:
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col)
    return F.unix_micros(col)


def _is_ntz(df: DataFrame, ts: str) -> bool:
    from pyspark.sql.types import TimestampNTZType
    return isinstance(df.schema[ts].dataType, TimestampNTZType)


def _bucket(ts: Column, seconds: int, ntz: bool = True) -> Column:
    return F.floor(_micros(ts, ntz) / F.lit(seconds * 1_000_000)).cast("long")


def _in_buckets(df: DataFrame, key: str, ts: str, order_id: str, span: int) -> DataFrame:
    """Every row with a key and a time, in its own time bucket (``span`` wide) and, as a row of the
    past, in the next one: all rows within ``span`` before a row are then in the row's bucket."""
    p = _micros(ts, _is_ntz(df, ts))
    known = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    return (known.withColumn("_p", p).withColumn("_oid", F.col(order_id))
            .withColumn("_own", F.explode(F.array(F.lit(True), F.lit(False))))
            .withColumn("_b", F.floor(F.col("_p") / F.lit(span)).cast("long") + F.when(F.col("_own"), 0).otherwise(1)))


def _prior_count(key: str, span: int) -> Column:
    """Rows of the key with a time in [_p - span, _p], without the row itself and those at the same
    instant whose id is not smaller. All windows share the partitioning by (key, bucket)."""
    within = Window.partitionBy(key, "_b").orderBy("_p").rangeBetween(-span, Window.currentRow)
    instant = Window.partitionBy(key, "_b", "_p")
    return (F.count(F.lit(1)).over(within) - F.count(F.lit(1)).over(instant)
            + F.rank().over(instant.orderBy("_oid")) - 1).cast("long")


def velocity_count(df: DataFrame, key: str, ts: str, order_id: str, minutes: int = 60,
                   name: str = "prior_count") -> DataFrame:
    """Number of *earlier* rows of the same key whose time lies in [ts - minutes, ts].

    "Earlier" is by (ts, order_id): rows at the same instant count only when their id is
    smaller, as if processed first (a NULL id is the smallest; rows with equal ids do not count each
    other). Every input row comes out once, whatever its id; rows without a key or a time get
    NULL. One exchange by (key, time bucket) and no join: a key with a third of all rows is spread over
    its buckets."""
    span = minutes * 60 * 1_000_000
    unknown = (df.filter(F.col(key).isNull() | F.col(ts).isNull())
               .withColumn(name, F.lit(None).cast("long")))
    counted = _in_buckets(df, key, ts, order_id, span).withColumn(name, _prior_count(key, span)).filter("_own")
    return counted.select(*df.columns, name).unionByName(unknown)


def velocity_and_previous(df: DataFrame, key: str, ts: str, order_id: str, value: str, minutes: int = 60,
                          count_name: str = "prior_count", prev_name: str = "previous_value") -> DataFrame:
    """``velocity_count`` and LAG(value) OVER (PARTITION BY key ORDER BY ts, order_id) in one pass over
    the same buckets. A row whose bucket and the one before hold no earlier row takes the last value
    of the key's nearest earlier bucket, from a summary with one small row per key and bucket. Rows
    without a key or a time get NULL for both."""
    span = minutes * 60 * 1_000_000
    value_type = df.schema[value].dataType.simpleString()
    unknown = (df.filter(F.col(key).isNull() | F.col(ts).isNull()).withColumn(count_name, F.lit(None).cast("long"))
               .withColumn(prev_name, F.lit(None).cast(value_type)))
    both = _in_buckets(df, key, ts, order_id, span).withColumn("_val", F.struct(F.col(value).alias("v")))
    before = Window.partitionBy(key, "_b").orderBy("_p", "_oid", "_val")
    counted = (both.withColumn(count_name, _prior_count(key, span)).withColumn("_prev", F.lag("_val").over(before))
               .filter("_own"))
    summary = (both.filter("_own").groupBy(key, "_b")
               .agg(F.max_by("_val", F.struct("_p", "_oid", "_val")).alias("_last")))
    carry = summary.select(F.col(key).alias("_k"), F.col("_b").alias("_cb"),
                           F.lag("_last").over(Window.partitionBy(key).orderBy("_b")).alias("_carry"))
    out = (counted.join(carry, (F.col(key) == F.col("_k")) & (F.col("_b") == F.col("_cb")), "left")
           .withColumn(prev_name, F.coalesce(F.col("_prev"), F.col("_carry")).getField("v")))
    return out.select(*df.columns, count_name, prev_name).unionByName(unknown)
