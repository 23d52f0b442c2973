"""Shared-folder tables: how the operators of this package cut lineage.

Intermediate results are Parquet tables below the folder that ``spark.checkpoint.dir``
names, so a lost executor never takes the only copy with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


ROW_GROUP_BYTES = 16 << 20  # what a writing task holds in memory
ARROW_ROWS, ARROW_BYTES = 2000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches that stay small with long texts (session settings that plans read when they run)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_remainder(col: str, modulus: int):
    """crc32 of the id's decimal text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % modulus
