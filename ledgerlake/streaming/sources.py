"""Streaming sources: JSON payload streams, the settlement CSV drop folder, file landings.

A broker source (Kafka) is not on this classpath, so every stream here is a file
stream; the transformations after the source are the same for a Kafka ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from .. import schemas

PAYLOAD_SCHEMA = T.StructType([T.StructField("payload", T.StringType(), True)])


def payload_stream(spark: SparkSession, path: str, max_files: int = 1, fmt: str = "parquet") -> DataFrame:
    """Rows with one text column ``payload`` (a broker message value), one file per trigger by default."""
    return spark.readStream.schema(PAYLOAD_SCHEMA).option("maxFilesPerTrigger", max_files).format(fmt).load(path)


def kafka_payload_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                         starting_offsets: str = "latest") -> DataFrame:
    """The broker form of ``payload_stream``: message value as ``payload`` (key and event
    time kept), so validation and parsing run unchanged. Needs the spark-sql-kafka
    connector on the classpath."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic).option("startingOffsets", starting_offsets).load()
            .select(F.col("value").cast("string").alias("payload"), F.col("key").cast("string").alias("key"),
                    F.col("timestamp").alias("broker_ts")))


def _parse_once(col: str, schema):
    """JSON parse as the output of a one-row explode, so filters on parsed fields cannot
    be pushed below it by inlining (and repeating) the parse."""
    return F.explode(F.array(F.from_json(col, schema)))


def stream_payments(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Payment-event stream: JSON payloads parsed with the declared schema."""
    raw = payload_stream(spark, path, max_files)
    return raw.select(_parse_once("payload", schemas.PAYMENT_EVENT).alias("e")).select("e.*")


def stream_signals(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Fraud-signal stream keyed by transaction_id: JSON payloads parsed with the declared schema."""
    raw = payload_stream(spark, path, max_files)
    return raw.select(_parse_once("payload", schemas.SIGNAL_EVENT).alias("s")).select("s.*")


def stream_settlement(spark: SparkSession, path: str, max_files: int = K.SETTLEMENT_FILES_PER_TRIGGER,
                      files_modified_since: str | None = None) -> DataFrame:
    """Settlement CSV drop folder: text columns (typed after validation), 100 files per trigger.
    ``files_modified_since`` skips files that were already in the folder before that time
    (the drop folder's "include existing files = false"), using the file-scan metadata."""
    stream = (spark.readStream.schema(schemas.SETTLEMENT_CSV).option("header", "true")
              .option("maxFilesPerTrigger", max_files).csv(path))
    if files_modified_since is None:
        return stream
    since = F.lit(files_modified_since).cast("timestamp")
    return stream.filter(F.col("_metadata.file_modification_time") >= since).select(*schemas.SETTLEMENT_CSV.names)
