"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``max_distance`` bits have a value between them that
differs from either in at most half of that. So every distinct fingerprint emits all values
("variants") in the ball of half the radius, variants are shuffled, and fingerprints that meet on a
variant are verified bit by bit.

A ball of radius 2 has 2,081 variants of 64 bits. They are shuffled by their ``key_bits`` highest
bits, and all variants of one fingerprint with the same key travel as one record ``(key,
fingerprint)``: the receiving task makes the variants again from it (79 records for 12 key bits).
A key with many records is split by the following bits inside its task, so the memory of a task is
bounded by ``GROUP`` fingerprints' variants whatever the key's size. Links found in a task leave it as a
spanning forest, never as all pairs of a group. Connected components run as star contractions over
link tables in the shared folder; exact copies were merged before.

Defined results: null text = empty text; no words = fingerprint 0, linked like any other. Rows with
a null id link like others; a component's id is its smallest non-null id (null if it has none).
Repeated rows stay repeated. Empty input = empty output. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import textvec as tv
from .components import connected_components, local_components
from .store import written

GROUP = 4096  # most fingerprints whose variants are sorted at once; fits the low 12 bits of a sort key


# ---- fingerprints ---------------------------------------------------------------------------

def _fingerprints(texts: list[bytes | None], shingle_words: int, seed: int) -> np.ndarray:
    """The fingerprint of each text: bit set where more than half of its shingle hashes have it."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):
        words = text.lower().split() if text else []  # bytes: A-Z only, white space \x20 \x09-\x0D
        if not words:
            continue
        line = b" ".join(words)
        n = len(words) - shingle_words + 1
        if n <= 1:
            hashes.append(digest(line, seed))
            counts[k] = 1
            continue
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        starts = np.cumsum(lengths + 1) - lengths - 1
        ends = (starts + lengths)[shingle_words - 1:]
        hashes.extend([digest(line[a:b], seed) for a, b in zip(starts[:n].tolist(), ends.tolist())])
        counts[k] = n
    out = np.zeros(len(texts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        h = np.array(hashes, dtype="<u8")
        heads = (np.cumsum(counts) - counts)[full]
        ones = np.empty((len(full), 64), dtype=np.int64)
        for lane in range(8):  # eight bits at a time: small temporaries
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8)[:, lane:lane + 1], axis=1, bitorder="little")
            ones[:, 8 * lane:8 * lane + 8] = np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
        major = (2 * ones > counts[full][:, None]).astype(np.uint8)
        out[full] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle_words: int, seed: int) -> Iterator[pa.RecordBatch]:
    for part in tv.slices(batches, "text", 1 << 20):
        f = _fingerprints(part.column("text").cast(pa.binary()).to_pylist(), shingle_words, seed)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(f.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle_words: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp) per row of ``docs``; ``fp`` holds the 64 bits as a signed long."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(partial(_fingerprint_batches, shingle_words=shingle_words, seed=seed),
                          "doc_id long, fp long")


# ---- variants -------------------------------------------------------------------------------

@lru_cache(maxsize=64)
def ball(bits: int, radius: int) -> list[np.ndarray]:
    """By weight 0..radius: all ``bits``-bit masks of that weight."""
    return [np.array([sum(1 << i for i in c) for c in combinations(range(bits), w)], dtype=np.uint64)
            for w in range(radius + 1)]


def _emit_keys(batches: Iterator[pa.RecordBatch], key_bits: int, radius: int) -> Iterator[pa.RecordBatch]:
    """One record per key that a fingerprint's variants have."""
    masks = np.concatenate(ball(key_bits, radius))
    shift = np.uint64(64 - key_bits)
    for batch in batches:
        f = np.asarray(batch.column("fp")).view(np.uint64)
        for lo in range(0, len(f), 10_000):
            g = f[lo:lo + 10_000]
            keys = (g >> shift)[:, None] ^ masks[None, :]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().astype(np.int32)), pa.array(np.repeat(g, len(masks)).view(np.int64))], ["key", "fp"])


def _pairs(f: np.ndarray, left: np.ndarray, done: int, radius: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of ``f`` that meet on a variant whose ``done`` highest bits are all the same here.

    ``left[i]``: bit flips that fingerprint i may still spend on the other bits. Where more than ``limit``
    fingerprints stand, the next bits split them."""
    low = 64 - done
    if len(f) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if low == 0:
        return np.zeros(len(f) - 1, np.int64), np.arange(1, len(f))
    if len(f) > limit:
        width = min(4, low)
        shift = np.uint64(low - width)
        nibble = (f >> shift) & np.uint64((1 << width) - 1)
        a, b = [], []
        for value in range(1 << width):
            cost = np.bitwise_count(nibble ^ np.uint64(value)).astype(np.int64)
            at = np.flatnonzero(cost <= left)
            x, y = _pairs(f[at], left[at] - cost[at], done + width, radius, limit)
            a.append(at[x])
            b.append(at[y])
        return np.concatenate(a), np.concatenate(b)
    keep = np.uint64((1 << low) - 1)
    owner = np.arange(len(f), dtype=np.uint64)
    parts = []
    for spent, flips in enumerate(ball(low, radius)):
        at = left >= spent
        v = ((f[at] & keep)[:, None] ^ flips[None, :]) << np.uint64(12)
        parts.append((v | owner[at][:, None]).ravel())
    v = np.sort(np.concatenate(parts))
    same = np.flatnonzero((v[1:] >> np.uint64(12)) == (v[:-1] >> np.uint64(12)))
    code = np.unique((v[same] & np.uint64(4095)) << np.uint64(12) | (v[same + 1] & np.uint64(4095)))
    return (code >> np.uint64(12)).astype(np.int64), (code & np.uint64(4095)).astype(np.int64)


def _links_of_key(key: int, f: np.ndarray, key_bits: int, max_distance: int, limit: int):
    """(fingerprint, smallest fingerprint that it is linked with here) for one key's records."""
    top = f >> np.uint64(64 - key_bits)
    left = max_distance // 2 - np.bitwise_count(top ^ np.uint64(key)).astype(np.int64)
    a, b = _pairs(f, left, key_bits, max_distance // 2, limit)
    near = np.bitwise_count(f[a] ^ f[b]) <= max_distance  # verify
    a, b = a[near], b[near]
    if not len(a):
        return f[:0], f[:0]
    root = local_components(len(f), a, b)
    moved = np.flatnonzero(root != np.arange(len(f)))
    return f[moved], f[root[moved]]


def _link_batches(batches: Iterator[pa.RecordBatch], key_bits: int, max_distance: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Links among each key's records; the input is sorted by (key, fp)."""
    held_key, held = None, []

    def close():
        f = np.concatenate(held)
        f = f[np.concatenate(([True], f[1:] != f[:-1]))]
        return _links_of_key(held_key, f, key_bits, max_distance, limit) if len(f) > 1 else (f[:0], f[:0])

    for batch in batches:
        keys = np.asarray(batch.column("key"))
        f = np.asarray(batch.column("fp")).view(np.uint64)
        cuts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)])) if len(keys) else [0]
        us, vs = [], []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if held and keys[lo] != held_key:
                u, v = close()
                us.append(u)
                vs.append(v)
                held = []
            held_key = int(keys[lo])
            held.append(f[lo:hi])
        if us:
            u, v = np.concatenate(us), np.concatenate(vs)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])
    if held:
        u, v = close()
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])


def fingerprint_links(distinct_fps: DataFrame, max_distance: int = 4, key_bits: int = 12, group: int = GROUP) -> DataFrame:
    """(u, v) links whose components are those of all pairs at ``max_distance`` bits or fewer.

    ``max_distance`` is even here (half of it is the radius of the balls)."""
    if max_distance % 2 or not 0 <= max_distance <= 8:
        raise ValueError("max_distance must be 0, 2, 4, 6 or 8")
    if not 12 <= key_bits <= 30 or not 2 <= group <= GROUP:
        raise ValueError("key_bits must be 12..30 and group 2..4096")
    keyed = distinct_fps.select("fp").mapInArrow(partial(_emit_keys, key_bits=key_bits, radius=max_distance // 2), "key int, fp long")
    dealt = keyed.repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(partial(_link_batches, key_bits=key_bits, max_distance=max_distance, limit=group), "u long, v long").distinct()


def simhash_components(docs: DataFrame, shingle_words: int = 4, max_distance: int = 4, seed: int = 42, key_bits: int = 12) -> DataFrame:
    """(doc_id, fp, label, component_id) per row of ``docs``; ``label`` is the component's smallest fp."""
    rows = written(fingerprints(docs, shingle_words, seed), "simhash_rows")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash_nodes")
    links = written(fingerprint_links(nodes, max_distance, key_bits), "simhash_links")
    labels = connected_components(links)
    grouped = (nodes.join(labels.select(F.col("node").alias("fp"), "label"), "fp", "left")
               .select("fp", "first_id", F.coalesce("label", "fp").alias("label")))
    smallest = grouped.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_fp = written(grouped.join(smallest, "label").select("fp", "label", "component_id"), "simhash_of_fp")
    return rows.join(of_fp, "fp").select("doc_id", "fp", "label", "component_id")


def near_duplicate_report(docs: DataFrame, **params) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return simhash_components(docs, **params).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _append_fingerprint(batches: Iterator[pa.RecordBatch], shingle_words: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        f = _fingerprints(batch.column("text").cast(pa.binary()).to_pylist(), shingle_words, seed)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(f.view(np.int64))], [*batch.schema.names, "fp"])


def keep_one_of_each_group(docs: DataFrame, shingle_words: int = 4, max_distance: int = 4, seed: int = 42, key_bits: int = 12) -> DataFrame:
    """The rows of ``docs``, all columns, one per component: the row with the component's smallest id.

    Where that id stands in several rows, or no row of the component has an id, the first of those rows
    in the order of their columns stays. Only such rows are fingerprinted again and sorted."""
    comps = written(simhash_components(docs, shingle_words, max_distance, seed, key_bits), "simhash_components")
    repeated = written(comps.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"),
                       "simhash_repeated")
    gone = written(comps.filter("doc_id is not null and (component_id is null or doc_id <> component_id)").select(F.col("doc_id").alias("__gone"))
                   .union(repeated), "simhash_gone")
    by_id = F.col("doc_id").cast("long")
    plain = docs.filter(by_id.isNotNull()).join(gone, by_id == gone["__gone"], "left_anti")

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    wide = docs.select(by_id.alias("doc_id"), F.col("text").cast("string").alias("text"), row.alias("row"))
    unclear = wide.filter("doc_id is null").unionByName(wide.join(repeated, "doc_id", "left_semi"))
    schema = StructType([*unclear.schema.fields, StructField("fp", LongType())])
    hashed = unclear.mapInArrow(partial(_append_fingerprint, shingle_words=shingle_words, seed=seed), schema)
    heads = (comps.join(repeated.withColumn("again", F.lit(True)), "doc_id", "left")
             .filter("doc_id <=> component_id and (doc_id is null or again)")
             .select(F.col("fp").alias("head_fp"), F.col("component_id").alias("head_id"), "label").distinct())
    chosen = (hashed.join(heads, (hashed["fp"] == heads["head_fp"]) & hashed["doc_id"].eqNullSafe(heads["head_id"]))
              .groupBy("label").agg(F.min("row").alias("row")).select("row.*"))
    return plain.unionByName(chosen)
