"""Velocity on a stream with ``transformWithStateInPandas``: earlier events of the customer within the window.

State is keyed by (customer shard, time bucket as wide as the window). An event is counted in its own bucket and handed on, as
context only, to the next one, so the window of every event lies in one key's state and a customer with very many events spreads over
as many keys and tasks as the stream spans windows. A shard holds many customers (by a hash), whose events are counted together in numpy, so
the calls into Python follow the shards and buckets, not the customers. A key's list state only ever grows by appended blocks of events (Arrow;
RocksDB merges them, no read-modify-write of one large value); an event-time timer clears it once the watermark has passed the bucket's end, when no
event that is still on time can fall into it. Events without a customer count nothing and are dealt out by their id.

The operator emits every event once, in append mode, with the number of events of the customer in [t - window, t), ties of t by id, among
those seen so far. Events older than the watermark are dropped by Spark; route them first (``validate.late_router``).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import constants as K

OUT = "customer_id string, transaction_id string, us long, prior_count long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NO_CUSTOMER_KEYS = 64
SHARDS = 8              # of customers per time bucket; a stream of many rows takes more
NO_SHARD = -1           # of events without a customer
BLOCK = 20_000          # events in one entry of the list state


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Start a query with RocksDB state, which ``transformWithState`` needs (a query keeps the provider it was started with)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def prior_counts(old_us: np.ndarray, old_ids: np.ndarray, new_us: np.ndarray, new_ids: np.ndarray, window_us: int,
                 old_owners: np.ndarray | None = None, new_owners: np.ndarray | None = None) -> np.ndarray:
    """For each new event, the old and new events of its owner (a code from 0; all of one without owners) in [t - window, t) plus those of
    its instant with a smaller id."""
    times, ids = np.concatenate([old_us, new_us]), np.concatenate([old_ids, new_ids]).astype(str)
    owners = np.zeros(len(times), np.int64) if new_owners is None else np.concatenate([old_owners, new_owners]).astype(np.int64)
    order = np.lexsort((ids, times, owners))
    times, ids, owners = times[order], ids[order], owners[order]
    changed = np.r_[True, (owners[1:] != owners[:-1]) | (times[1:] != times[:-1]) | (ids[1:] != ids[:-1])]
    first_alike = np.maximum.accumulate(np.where(changed, np.arange(len(times)), 0))
    at = np.empty(len(order), np.int64)
    at[order] = first_alike
    instants = np.unique(times)  # a place is (owner, instant) as one number, in the order of the events
    place = owners * (len(instants) + 1) + np.searchsorted(instants, times)
    opens = owners[np.argsort(order)[len(old_us):]] * (len(instants) + 1) + np.searchsorted(instants, new_us - window_us)
    return at[len(old_us):] - np.searchsorted(place, opens, side="left")


def _blocks(events: pa.RecordBatch) -> Iterator[tuple[bytes]]:
    """The events as entries of the list state."""
    for lo in range(0, events.num_rows, BLOCK):
        part, sink = events.slice(lo, BLOCK), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema) as out:
            out.write_batch(part)
        yield (sink.getvalue().to_pybytes(),)


def _events(rows: pd.DataFrame) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows["us"], pa.int64()), pa.array(rows["transaction_id"], pa.string(), from_pandas=True),
                                       pa.array(rows["customer_id"], pa.string(), from_pandas=True)], ["us", "transaction_id", "customer_id"])


class VelocityProcessor(StatefulProcessor):
    def __init__(self, window_us: int):
        self.window_us = window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", "block binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        shard, bucket = key
        new = pd.concat(list(rows), ignore_index=True)
        if shard == NO_SHARD:
            yield new[["customer_id", "transaction_id", "us"]].assign(prior_count=np.int64(0))
            return
        fresh, known = _events(new), [pa.ipc.open_stream(b[0]).read_all() for b in self.events.get()]
        self.events.appendList(list(_blocks(fresh)))
        if not known:
            self.handle.registerTimer((int(bucket) + 1) * self.window_us // 1000)
        old = pa.concat_tables(known).to_pandas() if known else new[:0]
        owners = pd.factorize(np.concatenate([old["customer_id"].to_numpy(object), new["customer_id"].to_numpy(object)]))[0]
        prior = prior_counts(old["us"].to_numpy("int64"), old["transaction_id"].to_numpy(object), new["us"].to_numpy("int64"),
                             new["transaction_id"].to_numpy(object), self.window_us, owners[:len(old)], owners[len(old):])
        yield new[["customer_id", "transaction_id", "us"]].assign(prior_count=prior)[new["counted"].to_numpy(bool)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.events.clear()
        return iter(())

    def close(self) -> None:
        pass


def placed_events(events: DataFrame, window_us: int) -> DataFrame:
    """Every event in its own (customer, bucket) and, as context (``counted`` false), in the next one."""
    us = F.unix_micros("event_ts")
    own = F.floor(us / window_us).cast("long")
    spread = F.pmod(F.xxhash64("transaction_id"), F.lit(NO_CUSTOMER_KEYS))
    first = F.struct(F.coalesce(F.when(F.col("customer_id").isNotNull(), own), spread).alias("bucket"), F.lit(True).alias("counted"))
    places = F.when(F.col("customer_id").isNull(), F.array(first)).otherwise(F.array(first, F.struct((own + 1).alias("bucket"), F.lit(False).alias("counted"))))
    return (events.select("*", us.alias("us"), F.explode(places).alias("p"))
            .select("customer_id", "transaction_id", "event_ts", "us", "p.bucket", "p.counted"))


def velocity(stream: DataFrame, minutes: int = K.ENGINE_WINDOW_MINUTES, delay: str = K.WATERMARK_DELAY, shards: int = SHARDS) -> DataFrame:
    """customer_id, transaction_id, event_ts and prior_count of every event (input columns customer_id, transaction_id, event_ts). Start
    the query inside ``rocksdb_state``. ``shards`` is fixed for the life of a checkpoint, like its state partitions."""
    window_us = minutes * 60 * 1_000_000
    rows = placed_events(stream.select("customer_id", "transaction_id", "event_ts").withWatermark("event_ts", delay), window_us)
    # a null key would reach Python as NaN, which equals no other
    shard = F.when(F.col("customer_id").isNull(), NO_SHARD).otherwise(F.pmod(F.xxhash64("customer_id"), F.lit(shards)))
    counted = rows.withColumn("shard", shard).groupBy("shard", "bucket").transformWithStateInPandas(VelocityProcessor(window_us), OUT, "Append", "EventTime")
    return counted.select("customer_id", "transaction_id", F.timestamp_micros("us").alias("event_ts"), "prior_count")
