"""Table writers: overwrite, replace, append (by position), partitioned append, views.

Path-based parquet is the default storage. A write goes to a fresh folder and is
only then published, so a lost executor or a failed job never leaves a half-written
table behind (Spark's commit protocol already makes each write atomic per folder).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                fmt: str = "parquet") -> str:
    """Full-refresh (or append) write of a DataFrame to ``path``."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """CREATE OR REPLACE TABLE ... AS: the built-in catalog rejects it, so overwrite."""
    return write_table(df, path, "overwrite", partition_by)


def append_table(df: DataFrame, path: str, columns: list[str] | None = None,
                 partition_by: list[str] | None = None) -> str:
    """INSERT INTO: rows are matched by position, so the target column order is applied first."""
    if columns is not None:
        df = df.select(*columns)
    return write_table(df, path, "append", partition_by)


def append_partitioned(df: DataFrame, path: str, cols: list[str]) -> str:
    """Append partitioned by ingestion / settlement date; reads prune by those columns."""
    return write_table(df, path, "append", cols)


def overwrite_partitions(df: DataFrame, path: str, cols: list[str]) -> str:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols).parquet(path))
    return path


def save_as_table(df: DataFrame, name: str, mode: str = "overwrite") -> str:
    """Catalog table (``saveAsTable``) for deployments with a metastore."""
    df.write.mode(mode).saveAsTable(name)
    return name


def insert_into(df: DataFrame, name: str, spark: SparkSession | None = None) -> str:
    """Position-based append into an existing catalog table."""
    spark = spark or df.sparkSession
    target_cols = spark.table(name).columns
    df.select(*target_cols).write.insertInto(name)
    return name


def register_view(df: DataFrame, name: str) -> str:
    """CREATE OR REPLACE VIEW: a temp view holding the DataFrame's plan."""
    df.createOrReplaceTempView(name)
    return name


def write_versioned(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    """Write a new immutable version ``root/v=<n+1>``; only after it is complete, publish it by
    writing a one-row marker dataset ``root/_published/version=<n+1>``. Readers take the highest
    published version, so they see the old or the new table, never a mix, and a failed write
    leaves only an unpublished folder behind (nothing is overwritten or deleted)."""
    spark = df.sparkSession
    nxt = next_version(spark, root)
    target = version_path(root, nxt)
    write_table(df, target, "overwrite", partition_by)
    publish_version(spark, root, nxt)
    return target


def next_version(spark: SparkSession, root: str) -> int:
    return (current_version(spark, root) or 0) + 1


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version}"


def publish_version(spark: SparkSession, root: str, version: int) -> None:
    """Make a completely written version the one that readers take; fails if it is published already."""
    (spark.createDataFrame([(version_path(root, version),)], "path string").write.mode("errorifexists")
     .parquet(f"{root.rstrip('/')}/_published/version={version}"))


def read_if_exists(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None where the path does not exist. Any other failure is raised: a
    storage or permission error must not look like an empty table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_version(spark: SparkSession, root: str) -> int | None:
    """Highest published version under ``root`` (None before the first publish)."""
    from pyspark.sql import functions as F
    markers = read_if_exists(spark, f"{root.rstrip('/')}/_published")
    if markers is None:
        return None
    return markers.agg(F.max("version")).first()[0]


def read_current(spark: SparkSession, root: str) -> DataFrame:
    v = current_version(spark, root)
    if v is None:
        raise FileNotFoundError(f"no published version under {root}")
    return spark.read.parquet(version_path(root, v))


def published_path(spark: SparkSession, root: str, table: str) -> str:
    """The folder of one table in the published version of a set of tables (``Medallion.run``)."""
    v = current_version(spark, root)
    if v is None:
        raise FileNotFoundError(f"no published version under {root}")
    return f"{version_path(root, v)}/{table}"


def write_topics(routed: DataFrame, path: str) -> str:
    """Routed (topic, key, value) rows as one folder per topic (``topic=<name>``), appended."""
    routed.write.mode("append").partitionBy("topic").parquet(path)
    return path


def write_kafka(routed: DataFrame, bootstrap_servers: str) -> None:
    """Routed rows to a broker: the Kafka sink reads the ``topic`` column per row. Needs the
    spark-sql-kafka connector on the classpath (not bundled here)."""
    (routed.selectExpr("topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
     .write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).save())
