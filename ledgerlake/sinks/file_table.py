"""A table of Parquet files with a versioned manifest: MERGE rewrites only the files that hold a matched key.

    root/data/<write>/part-*.parquet        immutable data files, clustered by the key
    root/manifest/version=<n>/              the files of version n with rows and least and greatest key
    root/published/version=<n>/             written last; readers take the highest published version
    root/staged/<merge>/                    the source of a MERGE

A MERGE finds its files in two steps. The manifest's key ranges leave out files outside the source's keys: the sorted source
keys are cut into at most ``RANGES`` intervals and a file stays if its own range meets one of them. Of the remaining files only the
key column is read, with the file's name (``_metadata.file_path``), and semi-joined with the source keys. Files with a match are merged with
the source by one full outer join and written anew; source rows without a match are inserted with them. All other files keep their names
and are neither read nor written. A version that fails before it is published is never seen; an older version stays readable until a
cleaner removes what ``unreferenced`` lists.

What the driver holds are file names, ranges and ``RANGES`` intervals, never rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import read_if_exists

RANGES = 64
MANIFEST = "file string, n_rows long, least string, greatest string"


class FileTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, bloom: bool = True, row_group_bytes: int | None = None):
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key
        self.options = {f"parquet.bloom.filter.enabled#{key}": "true"} if bloom else {}
        if row_group_bytes:
            self.options["parquet.block.size"] = str(row_group_bytes)

    # ---- versions -------------------------------------------------------------

    def version(self) -> int | None:
        marks = read_if_exists(self.spark, f"{self.root}/published", "at timestamp, version int")
        return None if marks is None else marks.agg(F.max("version")).first()[0]

    def manifest(self, version: int | None = None) -> DataFrame:
        """file, n_rows, least, greatest (keys as text) of every file of a version (default: the published one)."""
        version = self.version() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no published version under {self.root}")
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/version={version}")

    def files(self, version: int | None = None) -> list[str]:
        return sorted(r["file"] for r in self.manifest(version).select("file").collect())

    def _scan(self, files: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*files) if files else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        return self._scan(self.files(version))

    def unreferenced(self) -> DataFrame:
        """Files of older versions that the published version does not use."""
        known = self.spark.read.schema(MANIFEST + ", version int").parquet(f"{self.root}/manifest")
        return known.select("file").distinct().join(self.manifest().select("file"), "file", "left_anti")

    # ---- writes ---------------------------------------------------------------

    def _write(self, df: DataFrame, n_files: int | None) -> DataFrame:
        """Write rows clustered by the key into new files; returns their manifest rows."""
        target = f"{self.root}/data/{uuid.uuid4().hex}"
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        dealt = rows.repartitionByRange(n_files, self.key) if n_files else rows.repartitionByRange(self.key)
        dealt.sortWithinPartitions(self.key).write.options(**self.options).parquet(target)
        key = F.col(self.key)
        return (self.spark.read.schema(self.schema).parquet(target).select(key, "_metadata.file_path")
                .groupBy(F.col("file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).cast("string").alias("least"), F.max(key).cast("string").alias("greatest")))

    def _publish(self, manifest: DataFrame) -> int:
        number = (self.version() or 0) + 1
        manifest.write.mode("overwrite").parquet(f"{self.root}/manifest/version={number}")
        self.spark.range(1).select(F.current_timestamp().alias("at")).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/published/version={number}")
        return number

    def create(self, df: DataFrame, n_files: int | None = None) -> int:
        return self._publish(self._write(df, n_files))

    def _intervals(self, keys: DataFrame) -> list[tuple]:
        """At most RANGES (first, last) key intervals that hold all source keys, in key order."""
        cut = keys.repartitionByRange(RANGES, self.key).groupBy(F.spark_partition_id().alias("p")).agg(F.min(self.key).alias("first"), F.max(self.key).alias("last"))
        return [(r["first"], r["last"]) for r in cut.orderBy("first").collect()]

    def candidates(self, keys: DataFrame) -> list[str]:
        """Files whose key range meets an interval of the (non-null) source keys."""
        kind = self.schema[self.key].dataType
        intervals = self._intervals(keys)
        meets = F.lit(False)
        for first, last in intervals:
            meets = meets | ((F.col("greatest").cast(kind) >= F.lit(first).cast(kind)) & (F.col("least").cast(kind) <= F.lit(last).cast(kind)))
        return sorted(r["file"] for r in self.manifest().filter(meets).select("file").collect())

    def touched(self, keys: DataFrame) -> list[str]:
        """Files that hold a source key: of the candidates, the key column is read and semi-joined."""
        near = self.candidates(keys)
        if not near:
            return []
        held = self._scan(near).select(self.key, "_metadata.file_path").join(keys, self.key, "left_semi").select("file_path").distinct()
        return sorted(r[0] for r in held.collect())  # file names

    def merge(self, source: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame], n_files: int | None = None) -> dict:
        """Replace the files that ``source`` touches by ``merged(their rows, source)`` and publish; returns what was done. The
        source is staged once, as its keys are read several times."""
        staged = f"{self.root}/staged/{uuid.uuid4().hex}"
        source.write.parquet(staged)
        source = self.spark.read.schema(source.schema).parquet(staged)
        keys = source.select(F.col(self.key).cast(self.schema[self.key].dataType).alias(self.key)).filter(F.col(self.key).isNotNull()).distinct()
        touched = self.touched(keys)
        before = self.manifest()
        written = self._write(merged(self._scan(touched), source), n_files or max(1, len(touched)))
        gone = self.spark.createDataFrame([(f,) for f in touched], "file string")
        number = self._publish(before.join(gone, "file", "left_anti").unionByName(written))
        return {"version": number, "rewritten": touched, "files": before.count()}

    # ---- point lookups ----------------------------------------------------------

    def lookup(self, values: list) -> DataFrame:
        """The rows of some keys: files by the manifest's ranges, row groups by their statistics and Bloom filters."""
        kind = self.schema[self.key].dataType
        meets = F.lit(False)
        for v in values:
            meets = meets | ((F.col("least").cast(kind) <= F.lit(v).cast(kind)) & (F.col("greatest").cast(kind) >= F.lit(v).cast(kind)))
        files = sorted(r["file"] for r in self.manifest().filter(meets).select("file").collect())
        return self._scan(files).filter(F.col(self.key).isin(*values))
