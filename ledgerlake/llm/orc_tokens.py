"""Token-id output as ORC, read back by stripes.

``write_tokens`` encodes every text with a public word-BPE vocabulary, appends an end id and writes ORC files in ascending
id order: rows are range-partitioned and sorted by id before they are encoded, so the ids themselves are never shuffled. ORC's
integer run-length encoding packs the ids; row indexes (every ``index_stride`` rows) and Bloom filters on ``doc_id`` let a
reader skip stripes and row groups, and stripes are read in parallel.

A row is (doc_id, part, start_in_part, n_tokens, ids). ``part`` is the range partition that wrote it, ``start_in_part`` the ids of
that part before the row, so a document's global start is its part's offset (one small table of parts) plus ``start_in_part``.

The encoder splits texts at white space before the tokenizer, which does so too, and remembers words' ids.

Defined results: null text = empty text = the end id alone. Null ids come first; rows with equal ids are ordered by their
text, nulls first. Repeated rows are written each. An empty table gives an empty file set.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec as tv
from ..session import scratch_path

REMEMBERED = 400_000  # words whose ids a worker keeps
SCHEMA = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"


@dataclass(frozen=True)
class TokenParams:
    tokenizer: str | None = None   # path of a tokenizers file; None: the public 49k word-BPE file
    end_id: int = 1
    stripe_bytes: int = 64 << 20
    index_stride: int = 1000
    compression: str = "zstd"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=2)
def _word_ends(path: str) -> np.ndarray:
    """Which ids end a word of the tokenizer (its vocabulary marks them with </w>)."""
    vocabulary = _tokenizer(path).get_vocab(with_added_tokens=False)
    ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return ends


@lru_cache(maxsize=4)
def _tokenizer(path: str, words_only: bool = True):
    """The tokenizer as its file gives it; with ``words_only`` special tokens' strings are ordinary text, since words are lowered
    before they are encoded and must not become special tokens by that."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = words_only
    return t


@lru_cache(maxsize=2)
def _specials(path: str) -> tuple[bytes, ...]:
    return tuple(t.content.encode() for t in _tokenizer(path, False).get_added_tokens_decoder().values())


_memory: dict = {}
_TAIL = b".,!?;:*#$%&|"  # ends a word in a run of its own after a letter or digit


def _encode_words(words: list[bytes], path: str, known: dict) -> None:
    """Add the ids of ``words`` to ``known``.

    The tokenizer cuts between letters or digits and a run of punctuation, so a word with such an end is its stem's ids
    and its end's ids; stems recur far more often than whole words."""
    composed, direct = [], set()
    for w in words:
        stem = w.rstrip(_TAIL)
        if stem and stem != w and stem[-4:].decode("utf-8", "ignore").lower()[-1:].isalnum():
            tail = w[len(stem):]
            composed.append((w, stem, tail))
            direct.update(x for x in (stem, tail) if x not in known)
        else:
            direct.add(w)
    letters, others = [], []
    for w in direct:
        text = w.decode("utf-8", "replace")
        (letters if text.lower().isalpha() else others).append((w, text))
    encode = partial(_tokenizer(path).encode_batch_fast, add_special_tokens=False)
    # words of letters alone are one word of the tokenizer each: many go into one text, cut again at the ids that end words
    groups = [letters[i:i + 500] for i in range(0, len(letters), 500)]
    for group, e in zip(groups, encode([" ".join([t for _, t in g]) for g in groups])):
        ids = np.array(e.ids, dtype="<u4")
        cuts = np.flatnonzero(_word_ends(path)[ids]) + 1
        if len(cuts) != len(group) or (len(cuts) and cuts[-1] != len(ids)):
            others.extend(group)
            continue
        for (w, _), a, b in zip(group, np.concatenate(([0], cuts[:-1])).tolist(), cuts.tolist()):
            known[w] = ids[a:b].tobytes()
    for (w, _), e in zip(others, encode([t for _, t in others])):
        known[w] = np.array(e.ids, dtype="<u4").tobytes()
    for w, stem, tail in composed:
        known[w] = known[stem] + known[tail]


def encode_texts(texts: list[bytes | None], params: TokenParams) -> list[bytes]:
    """Ids of each text with the end id, as little-endian 32-bit bytes.

    The vocabulary is lower case, so A-Z may be lowered first. A text that holds a special token's string is given to the library whole."""
    path = params.tokenizer or default_tokenizer()
    if _memory.get("path") != path:
        _memory.update(path=path, old={}, new={})
    elif len(_memory["new"]) > REMEMBERED:
        _memory.update(old=_memory["new"], new={})
    old, new = _memory["old"], _memory["new"]
    special = [bool(t) and any(s in t for s in _specials(path)) for t in texts]
    split = [t.lower().split() if t and not whole else [] for t, whole in zip(texts, special)]  # white space \x20 \x09-\x0D
    missing = []
    for w in set().union(*split).difference(new):
        b = old.get(w)
        if b is None:
            missing.append(w)
        else:
            new[w] = b
    _encode_words(missing, path, new)
    end = np.array([params.end_id], dtype="<u4").tobytes()
    get = new.__getitem__
    blobs = [b"".join([*map(get, words), end]) for words in split]
    for i in np.flatnonzero(special):
        ids = _tokenizer(path, False).encode(texts[i].decode("utf-8", "replace"), add_special_tokens=False).ids
        blobs[i] = np.array(ids, dtype="<u4").tobytes() + end
    return blobs


def _encode_batches(batches: Iterator[pa.RecordBatch], params: TokenParams) -> Iterator[pa.RecordBatch]:
    part_no = TaskContext.get().partitionId()
    start = 0
    for part in tv.slices(batches, "text"):
        blobs = encode_texts(part.column("text").cast(pa.binary()).to_pylist(), params)
        counts = np.array([len(b) // 4 for b in blobs], dtype=np.int64)
        heads = np.concatenate(([0], np.cumsum(counts)))
        ids = pa.ListArray.from_arrays(pa.array(heads.astype(np.int32)), pa.array(np.frombuffer(b"".join(blobs), dtype="<i4")))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.full(len(counts), part_no, np.int32)), pa.array(start + heads[:-1]), pa.array(counts), ids],
                                         ["doc_id", "part", "start_in_part", "n_tokens", "ids"])
        start += int(heads[-1])


def write_tokens(docs: DataFrame, path: str, params: TokenParams = TokenParams()) -> None:
    """Encode every row of ``docs`` and write the files below ``path``."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = src.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (dealt.mapInArrow(partial(_encode_batches, params=params), SCHEMA).write
     .option("compression", params.compression).option("orc.stripe.size", str(params.stripe_bytes))
     .option("orc.row.index.stride", str(params.index_stride)).option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files with their global ``start``; filters on doc_id reach the ORC reader."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows.join(part_offsets(spark, path), "part").select(
        "doc_id", (F.col("start_in_part") + F.col("offset")).alias("start"), "n_tokens", "ids")


def part_offsets(spark: SparkSession, path: str) -> DataFrame:
    """(part, offset): the ids of all earlier parts. One row per written part; only two small columns are read."""
    from pyspark.sql import Window
    sizes = spark.read.schema(SCHEMA).orc(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents: statistics and Bloom filters skip the other stripes and row groups."""
    return spark.read.schema(SCHEMA).orc(path).filter(F.col("doc_id").isin([int(i) for i in doc_ids]))


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        data = np.asarray(ids.flatten()).astype("<u4", copy=False)
        offsets = np.asarray(ids.offsets).astype(np.int64)
        offsets = offsets - offsets[0] if len(offsets) else offsets
        crcs = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), batch.column("start_in_part"), pa.array(np.diff(offsets)), pa.array(crcs, pa.int64())],
                                         ["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32"])


def token_digest(docs: DataFrame, params: TokenParams = TokenParams()) -> DataFrame:
    """Write the files, read them back: doc_id, start, n_tokens, ids_crc32 per document."""
    spark = docs.sparkSession
    path = scratch_path(spark, "orc_tokens")
    write_tokens(docs, path, params)
    rows = spark.read.schema(SCHEMA).orc(path).select("doc_id", "part", "start_in_part", "ids")
    digests = rows.mapInArrow(_digest_batches, "doc_id long, part int, start_in_part long, n_tokens long, ids_crc32 long")
    return digests.join(F.broadcast(part_offsets(spark, path)), "part").select(
        "doc_id", (F.col("start_in_part") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
