"""The bounded training sample that the trained operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import id_remainder


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, excluded: int,
                    per_class: int) -> DataFrame:
    """(doc_id, y, weight, text): at most ``per_class`` labelled rows of either class for training.

    Rows whose crc32(id) mod ``modulus`` is ``excluded`` are held out. An id that is labelled several times
    takes the majority (ties: 1). The sample is the rows with the smallest hash of the id, so it does not
    depend on partitioning; ``weight`` restores the classes' shares. The sample (ids, labels) is
    bounded by 2 * ``per_class`` rows, hence the broadcast; an id that stands in several rows trains on the least of its texts."""
    y = (F.avg(F.col(label).cast("double")) >= 0.5).cast("int")
    # labels of documents that are not there (a pipeline stage may have dropped them) take no part
    present = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null")
    known = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(y.alias("y"))
             .filter(id_remainder("doc_id", modulus) != excluded)
             .join(present, "doc_id", "left_semi"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    picks = None
    for c in (0, 1):
        n = sizes.get(c, 0)
        # Only the part of the hash range that holds about 1.5 times the sample is sorted.
        share = min(1.0, (1.5 * per_class + 200) / max(n, 1))
        pick = (known.filter((F.col("y") == c) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1))
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
                .withColumn("weight", F.lit(n / max(1, min(n, per_class)) * 2 * per_class / max(1, total))))
        picks = pick if picks is None else picks.union(pick)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (texts.join(F.broadcast(picks), "doc_id").groupBy("doc_id").agg(F.min("y").alias("y"), F.min("weight").alias("weight"), F.min("text").alias("text"))
            .select("doc_id", "y", "weight", "text"))
