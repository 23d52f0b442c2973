"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items that share a seed (a run of ``seed_words`` words) are joined on it. For each such pair, the longest
common runs of still unmarked words are marked again and again (Running Karp-Rabin greedy string tiling, no run shorter than
``min_match``); the marked share of the item's words is the coverage. Tiles may come in any order, so an item whose sentences
were moved around is still covered. A text with an item at ``coverage`` or more is contaminated.

A Bloom filter of the items' seeds of a fixed size (2**``filter_bits`` bits) goes to every task, so only texts that hold a seed leave
the scan; a saturated filter only lets more texts through. Equal texts are tiled once. An item may skip its most frequent
seeds as long as one of the rest must be in any text that covers it, so common phrases pair nothing for their own sake.

Words are runs of letters, digits and non-ASCII bytes, lower-cased. An item with fewer words than a seed is one seed
and must occur whole; an item without words never matches.

Defined results: null text = empty text, never contaminated. Null items and repeated items are harmless; a null item id is not
listed. Repeated rows and rows with a null doc id are reported each. Empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from . import textvec as tv
from .store import written

_SEPARATORS = tv.non_alnum()
_PROBES = 3


@dataclass(frozen=True)
class TilingParams:
    seed_words: int = 5
    min_match: int = 5
    coverage: float = 0.6
    filter_bits: int = 24


# ---- words and seeds ------------------------------------------------------------------------

def word_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of every row."""
    data, offsets = tv.text_bytes(pc.utf8_lower(col.cast(pa.string())))
    starts, ends, rows = tv.word_spans(data, offsets, _SEPARATORS)
    return tv.span_hashes(tv.prefix_sums(data), starts, ends), rows


def gram_hashes(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of every run of ``size`` words within a row."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        h = tv.mix(h * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n])
    at = np.flatnonzero(rows[:n] == rows[size - 1:])
    return h[at], at


def _probe_bits(h: np.ndarray, bits: int) -> list[np.ndarray]:
    return [tv.keyed(h, salt) >> np.uint64(64 - bits) for salt in range(1, _PROBES + 1)]


# ---- tiling ---------------------------------------------------------------------------------

def _karp_rabin(words: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(running hash, start) of the windows of ``size`` words that hold no marked word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = tv.power_table(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[:len(words)], out=sums[1:])
    marked = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(~free, out=marked[1:])
    at = np.flatnonzero(marked[size:] == marked[:n])
    return (sums[at + size] - sums[at]) * down[at], at


def _run_lengths(item: np.ndarray, text: np.ndarray, item_free: np.ndarray, text_free: np.ndarray, p: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Length of the common run of unmarked words from each (item, text) place on; compares words, not hashes."""
    n = np.zeros(len(p), dtype=np.int64)
    going = np.arange(len(p))
    while len(going):
        i, j = p[going] + n[going], t[going] + n[going]
        inside = (i < len(item)) & (j < len(text))
        going, i, j = going[inside], i[inside], j[inside]
        going = going[item_free[i] & text_free[j] & (item[i] == text[j])]
        n[going] += 1
    return n


def _maximal_matches(item: np.ndarray, text: np.ndarray, item_free: np.ndarray, text_free: np.ndarray, size: int, pairs_at_once: int = 1 << 20) -> list[tuple[int, int, int]]:
    """(-length, text start, item start) of the maximal common runs of unmarked words, ``size`` words or more."""
    h_item, at_item = _karp_rabin(item, item_free, size)
    h_text, at_text = _karp_rabin(text, text_free, size)
    order = np.argsort(h_item, kind="stable")
    h_item, at_item = h_item[order], at_item[order]
    low, high = np.searchsorted(h_item, h_text, "left"), np.searchsorted(h_item, h_text, "right")
    hit = np.flatnonzero(high > low)
    at_text, low, count = at_text[hit], low[hit], (high - low)[hit]
    before = np.concatenate(([0], np.cumsum(count)))
    found, start = [], 0
    while start < len(hit):
        stop = max(start + 1, int(np.searchsorted(before, before[start] + pairs_at_once, "right")) - 1)
        c = count[start:stop]
        t = np.repeat(at_text[start:stop], c)
        p = at_item[np.repeat(low[start:stop], c) + np.arange(len(t)) - np.repeat(np.cumsum(c) - c, c)]
        q, u = np.maximum(p - 1, 0), np.maximum(t - 1, 0)
        inner = (p > 0) & (t > 0) & item_free[q] & text_free[u] & (item[q] == text[u])  # not the start of its run
        p, t = p[~inner], t[~inner]
        n = _run_lengths(item, text, item_free, text_free, p, t)
        ok = n >= size
        found.extend(zip((-n[ok]).tolist(), t[ok].tolist(), p[ok].tolist()))
        start = stop
    return found


def tile(item: np.ndarray, text: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (length, item start, text start): always the longest run of unmarked words that is left (ties: first in
    the text, then in the item), none shorter than ``min_match``.

    A run that a longer tile has cut since it was found goes back into the queue with what is left of it."""
    item_free, text_free = np.ones(len(item), dtype=bool), np.ones(len(text), dtype=bool)
    tiles, size, left = [], len(item), len(item)
    while size >= min_match and left >= min_match:
        queue = _maximal_matches(item, text, item_free, text_free, size)
        heapq.heapify(queue)
        while queue and left >= size:
            n, t, p = heapq.heappop(queue)
            free = item_free[p:p - n] & text_free[t:t - n]
            if free.all():
                item_free[p:p - n] = False
                text_free[t:t - n] = False
                tiles.append((-n, p, t))
                left += n
                continue
            edges = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
            for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if hi - lo >= size:
                    heapq.heappush(queue, (lo - hi, t + lo, p + lo))
        size = max(size // 2, min_match) if size > min_match else 0
    return tiles


def coverage(item: np.ndarray, text: np.ndarray, min_match: int) -> tuple[float, int]:
    """(share of the item's words in tiles, number of tiles)."""
    if not len(item):
        return 0.0, 0
    tiles = tile(item, text, min(min_match, len(item)))
    return sum(n for n, _, _ in tiles) / len(item), len(tiles)


# ---- Spark ----------------------------------------------------------------------------------

def _item_batches(batches: Iterator[pa.RecordBatch], seed_words: int) -> Iterator[pa.RecordBatch]:
    for part in tv.slices(batches, "item_text"):
        words, rows = word_hashes(part.column("item_text"))
        counts = tv.row_counts(rows, part.num_rows)
        seeds = [np.zeros(0, np.uint64)] * part.num_rows
        for size in np.unique(np.minimum(counts, seed_words)):
            if size:
                h, at = gram_hashes(words, rows, int(size))
                cuts = np.searchsorted(rows[at], np.arange(part.num_rows + 1))
                for i in np.flatnonzero(np.minimum(counts, seed_words) == size):
                    seeds[i] = h[cuts[i]:cuts[i + 1]]
        heads = np.concatenate(([0], np.cumsum([len(s) for s in seeds]))).astype(np.int32)
        flat = np.concatenate([*seeds, np.zeros(0, np.uint64)]).view(np.int64)
        yield pa.RecordBatch.from_arrays([part.column("item_key"), pa.array(counts), pa.ListArray.from_arrays(pa.array(heads), pa.array(flat))], ["item_key", "n_words", "seeds"])


def _hit_batches(batches: Iterator[pa.RecordBatch], bloom: np.ndarray, bits: int, sizes: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """The rows that hold a seed in the filter, with those seeds."""
    for part in tv.slices(batches, "text"):
        words, rows = word_hashes(part.column("text"))
        got_rows, got = [], []
        for size in sizes:
            h, at = gram_hashes(words, rows, size)
            for salt in range(1, _PROBES + 1):
                probe = tv.keyed(h, salt) >> np.uint64(64 - bits)
                ok = np.flatnonzero(bloom[probe >> np.uint64(6)] >> (probe & np.uint64(63)) & np.uint64(1))
                h, at = h[ok], at[ok]
            got_rows.append(rows[at])
            got.append(h)
        row, h = np.concatenate(got_rows), np.concatenate(got)
        if not len(row):
            continue
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        fresh = np.concatenate(([True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])))
        row, h = row[fresh], h[fresh]
        kept = np.unique(row)
        heads = np.concatenate((np.searchsorted(row, kept), [len(row)])).astype(np.int32)
        some = part.take(pa.array(kept))
        yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("text"), pa.ListArray.from_arrays(pa.array(heads), pa.array(h.view(np.int64)))], ["doc_id", "text", "seeds"])


def _tile_batches(batches: Iterator[pa.RecordBatch], params: TilingParams) -> Iterator[pa.RecordBatch]:
    held_key, held = None, None
    for batch in batches:
        covers, tiles = [], []
        items, item_rows = word_hashes(batch.column("item_text"))
        cuts = np.searchsorted(item_rows, np.arange(batch.num_rows + 1))
        texts = batch.column("text")
        for i, key in enumerate(batch.column("text_key").to_pylist()):
            if key != held_key:  # pairs of one text stand together
                held_key, held = key, word_hashes(texts.slice(i, 1))[0]
            c, n = coverage(items[cuts[i]:cuts[i + 1]], held, params.min_match)
            covers.append(c)
            tiles.append(n)
        yield pa.RecordBatch.from_arrays([batch.column("text_key"), batch.column("item_key"), pa.array(covers, pa.float64()), pa.array(tiles, pa.int32())],
                                         ["text_key", "item_key", "coverage", "tiles"])


def _bloom(seeds: DataFrame, bits: int) -> np.ndarray:
    """The filter's 64-bit words: at most 2**(bits - 6) rows come to the driver."""
    def places(batches):
        for batch in batches:
            h = np.asarray(batch.column("seed")).view(np.uint64)
            p = np.unique(np.concatenate([*_probe_bits(h, bits), np.zeros(0, np.uint64)])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(p)], ["p"])

    t = (seeds.select("seed").mapInArrow(places, "p long").groupBy(F.expr("p div 64").alias("word"))
         .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits")).toArrow())
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[np.asarray(t.column("word"))] = np.asarray(t.column("bits")).view(np.uint64)
    return words


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, params: TilingParams = TilingParams()) -> tuple[DataFrame, DataFrame]:
    """((doc_id, text_key) of rows that hold a seed, (text_key, item_key, coverage, tiles) of covered items)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("item_text"))
    keyed = items.select(F.md5("item_text").alias("item_key"), "item_text").dropDuplicates(["item_key"])
    seeds = written(keyed.mapInArrow(partial(_item_batches, seed_words=params.seed_words), "item_key string, n_words long, seeds array<long>").filter("n_words > 0"), "tiling_seeds")
    sizes = tuple(sorted(r[0] for r in seeds.select(F.least("n_words", F.lit(params.seed_words)).cast("int")).distinct().collect()))  # at most seed_words values
    by_seed = seeds.select("item_key", "n_words", F.explode("seeds").alias("seed"))
    bloom = _bloom(by_seed, params.filter_bits)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if sizes:
        hits = src.mapInArrow(partial(_hit_batches, bloom=bloom, bits=params.filter_bits, sizes=sizes), "doc_id long, text string, seeds array<long>")
    else:
        hits = src.limit(0).withColumn("seeds", F.lit(None).cast("array<bigint>"))
    hits = written(hits.withColumn("text_key", F.md5("text")), "tiling_hits")
    text_seeds = hits.dropDuplicates(["text_key"]).select("text_key", F.explode("seeds").alias("seed"))
    # An item of n words needs ceil(coverage * n) words in tiles, so at least a fifth (1 / seed length) of
    # that many seeds must be in the text: one seed less than that may be left out, the most frequent ones.
    frequency = text_seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("texts"))
    need = F.ceil(F.ceil(F.col("n_words") * params.coverage - 1e-9) / F.lit(max(params.min_match, params.seed_words)))
    skip = F.when(F.col("n_words") <= params.seed_words, 0).otherwise(F.greatest(need - 1, F.lit(0)))
    ranked = (by_seed.join(frequency, "seed").withColumn("place", F.row_number().over(Window.partitionBy("item_key").orderBy(F.desc("texts"), "seed")))
              .filter(F.col("place") > skip).select("item_key", "seed").distinct())
    pairs = text_seeds.join(ranked, "seed").select("text_key", "item_key").distinct()
    texts = hits.select("text_key", "text").dropDuplicates(["text_key"])
    both = (pairs.join(keyed, "item_key").join(texts, "text_key").select("text_key", "item_key", "text", "item_text"))
    tiled = both.mapInArrow(partial(_tile_batches, params=params), "text_key string, item_key string, coverage double, tiles int")
    covered = written(tiled.filter(F.col("coverage") >= params.coverage), "tiling_covered")
    return hits.select("doc_id", "text_key"), covered


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, params: TilingParams = TilingParams()) -> DataFrame:
    """One row per contaminated row of ``docs``: doc_id, item_ids (sorted), n_items, coverage (the highest)."""
    rows, covered = contaminated_texts(docs, benchmark, params)
    ids = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("item_key")).distinct()
    per_text = covered.join(ids, "item_key").groupBy("text_key").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.countDistinct("item_key").alias("n_items"), F.max("coverage").alias("coverage"))
    return rows.join(per_text, "text_key").select("doc_id", "item_ids", "n_items", "coverage")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, params: TilingParams = TilingParams()) -> DataFrame:
    """The rows of ``docs``, all columns, whose text covers no benchmark item."""
    bad = written(contaminated_texts(docs, benchmark, params)[1].select(F.col("text_key").alias("__bad_text")).distinct(), "tiling_bad")
    return docs.join(bad, F.md5(F.col("text").cast("string")) == bad["__bad_text"], "left_anti")
