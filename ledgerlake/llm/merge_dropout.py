"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

Encoding is the merge agenda of a merge-type (BPE) vocabulary: a text's characters are symbols; the adjacent pair
whose joined piece has the best score (ties: leftmost) is merged, until no pair joins to a piece. With dropout, each
candidate merge is skipped with probability ``dropout`` by a keyed hash of the candidate, so that a seed fixes the
segmentation. Characters without a piece become byte pieces. Spaces are kept one by one and a literal space mark
becomes bytes, so decoding gives the text back byte by byte.

No piece has a space after another character, so merges never cross into the next chunk (spaces, then other
characters) and chunks are encoded apart; where the vocabulary joins no Latin letter with ASCII punctuation,
digits or control characters, chunks end there too. Every occurrence of a chunk draws for itself, by a keyed hash of (seed,
document id, place in the text), and every occurrence runs its agenda: nothing is remembered, so cost and memory do not depend on how
many different chunks there are. Short chunks run in rounds over flat arrays, one pair of each unfinished chunk a round; a candidate is
hashed when it comes to be the best. Long ones run with a heap.

Defined results: null text = empty text = no ids. A null id hashes as 0. Repeated rows are encoded each, alike.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .pieces import _BASE, Pieces, PairTable, default_model, load_pieces, running_hash

MASK = (1 << 64) - 1
LOCKSTEP = 48           # longest chunk, in characters, whose agenda runs in rounds with others
BLOCK = 1 << 17         # characters whose chunks run together
_OFFSET_BITS, _OFFSET_MASK = 6, 63   # hold an offset below LOCKSTEP
_GONE, _LONG = -2, -3   # places of ``_agendas`` without a symbol, with a long chunk
_LETTER, _MARK = "A-Za-zÀ-ɏ", r"\x00-\x1f!-@\[-`{-~"
_CHUNK = re.compile(" +[^ ]*")
_FINE_CHUNK = re.compile(f" *[{_LETTER}]+(?=[{_MARK} ]|$)| *[{_MARK}]+(?=[{_LETTER} ]|$)| +[^ ]*|[^ ]+")
_JOINED = re.compile(f"[{_LETTER}][{_MARK}]|[{_MARK}][{_LETTER}]")
_A, _B, _C = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9


@dataclass(frozen=True)
class DropoutParams:
    model: str | None = None   # path of a SentencePiece model; None: the public 32k model
    dropout: float = 0.1
    seed: int = 42
    run: ClassVar[int] = 1     # every chunk draws for itself


def _mix(h: int) -> int:
    h = (h ^ h >> 33) * 0xFF51AFD7ED558CCD & MASK
    h = (h ^ h >> 33) * 0xC4CEB9FE1A85EC53 & MASK
    return h ^ h >> 33


class variant_keys:
    """The key of every draw (see ``run_variants``)."""

    def __init__(self, params: DropoutParams):
        self.key = params.seed * _A + 1

    def __getitem__(self, draws) -> np.ndarray:
        return tv.keyed(np.asarray(draws, dtype=np.uint64), self.key)


def chunk_pattern(pieces: Pieces) -> re.Pattern:
    """How this vocabulary's texts may be cut without cutting a possible merge."""
    return _CHUNK if any(_JOINED.search(s) for s in pieces.id_of) else _FINE_CHUNK


def run_variants(doc_id: int | None, chunks: int, params: DropoutParams) -> np.ndarray:
    """The draw of each of a document's chunks."""
    doc = np.uint64(_mix((int(doc_id or 0) & MASK) ^ (params.seed * _B & MASK)))
    return tv.mix(np.arange(chunks, dtype=np.uint64) * np.uint64(_A) + doc)


def _chunk_keys(points: np.ndarray, variant: np.ndarray) -> np.ndarray:
    """A key for every row of code points under its variant's key."""
    return tv.mix(running_hash(points)[:, -1] ^ variant)


def _skip_limit(dropout: float) -> int:
    return min(MASK, int(dropout * 2.0 ** 64)) if dropout > 0 else 0


def encode_agenda(chunk: str, key: int, pieces: Pieces, dropout: float) -> list[int]:
    """One chunk's ids by a heap agenda over linked symbols. ``key`` comes from ``_chunk_keys``."""
    pair, rank, limit = pieces.merges().of_pair, pieces.merges().rank, _skip_limit(dropout)
    n = len(chunk)
    ids = [int(pieces.char_id[ord(c)]) for c in chunk]
    start, after, before, alive = list(range(n)), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    end = list(range(1, n + 1))
    agenda: list[tuple[int, int, int, int]] = []

    def offer(a: int):
        b = after[a]
        if b >= n or ids[a] < 0 or ids[b] < 0:
            return
        merged = pair.get(ids[a] << 32 | ids[b])
        if merged is None:
            return
        if limit and _mix(key ^ (start[a] * _A + start[b] * _B + end[b] * _C & MASK)) < limit:
            return  # skipped
        heapq.heappush(agenda, (int(rank[merged]), start[a], end[b], merged))

    for a in range(n - 1):
        offer(a)
    while agenda:
        _, a, stop, merged = heapq.heappop(agenda)  # a symbol is named by its first character
        if not alive[a] or after[a] >= n:
            continue
        b = after[a]
        if end[b] != stop or pair.get(ids[a] << 32 | ids[b] if min(ids[a], ids[b]) >= 0 else -1) != merged:
            continue
        alive[b] = False
        ids[a], end[a], after[a] = merged, end[b], after[b]
        if after[b] < n:
            before[after[b]] = a
        if before[a] >= 0:
            offer(before[a])
        offer(a)
    out, a = [], 0
    while a < n:
        out.extend([ids[a]] if ids[a] >= 0 else pieces.byte_pieces(chunk[a]))
        a = after[a]
    return out


def _offer(score: np.ndarray, joined: np.ndarray, at: np.ndarray, offset: np.ndarray, place: np.ndarray, merged: np.ndarray, table: PairTable):
    """Notes pairs' merged ids at ``place`` and, where there is one, rank and offset in ``score[at]``."""
    joined[place] = merged
    score[at] = np.where(merged >= 0, table.rank[merged] << _OFFSET_BITS | offset, table.NONE)


def _agendas(symbols: np.ndarray, starts: np.ndarray, stops: np.ndarray, keys: np.ndarray, pieces: Pieces, dropout: float):
    """Runs the agendas of chunks of at most ``LOCKSTEP`` characters that stand in a row (those without are left alone): ``symbols`` has a
    character's id at its place and gets each symbol's id at its first character, ``_GONE`` elsewhere. In every round each unfinished chunk
    takes its best pair, which the keyed hash skips or which is merged; pairs that are never best need no hash."""
    table, limit, none = pieces.merges(), np.uint64(_skip_limit(dropout)), PairTable.NONE
    n = len(symbols)
    after, before, joined = np.arange(1, n + 1), np.arange(-1, n - 1), np.full(n, -1, dtype=np.int64)
    score = np.full(n, none, dtype=np.int64)      # of the pair that begins with a symbol: rank, then offset in the chunk
    long = stops - starts > LOCKSTEP
    open_pair = np.ones(n, dtype=bool)
    open_pair[stops - 1] = False
    if long.any():
        open_pair[np.repeat(long, stops - starts)] = False
    a = np.flatnonzero(open_pair)
    _offer(score, joined, a, a - np.repeat(starts, stops - starts)[a], a, table.find(symbols[a], symbols[a + 1]), table)
    heads, size = starts, stops - starts          # of the unfinished chunks' scores
    while len(heads):
        best = np.minimum.reduceat(score, heads)
        live = best < none
        count = np.count_nonzero(live)
        if not count:
            return
        if count * 4 < len(heads) * 3:            # scores of finished chunks go
            score, starts, stops, keys, best, size = score[np.repeat(live, size)], starts[live], stops[live], keys[live], best[live], size[live]
            heads = np.cumsum(size) - size
            base, stop, key, shift = starts, stops, keys, heads - starts
        else:
            base, stop, key, best, shift = starts[live], stops[live], keys[live], best[live], (heads - starts)[live]
        a = base + (best & _OFFSET_MASK)
        b = after[a]
        end = after[b]
        score[a + shift] = none
        if limit:
            span = (a - base).view(np.uint64) * np.uint64(_A) + (b - base).view(np.uint64) * np.uint64(_B) + (end - base).view(np.uint64) * np.uint64(_C)
            kept = np.flatnonzero(tv.mix(key ^ span) >= limit)
            a, b, end, base, stop, shift = a[kept], b[kept], end[kept], base[kept], stop[kept], shift[kept]
        symbols[a] = joined[a]
        symbols[b] = _GONE
        score[b + shift] = none
        after[a] = end
        right, left = np.flatnonzero(end < stop), np.flatnonzero(a > base)
        before[end[right]] = a[right]
        first = np.concatenate((a[right], before[a[left]]))
        offset = first - np.concatenate((base[right], base[left]))
        merged = table.find(symbols[first], symbols[np.concatenate((end[right], a[left]))])
        _offer(score, joined, first + np.concatenate((shift[right], shift[left])), offset, first, merged, table)


def _encode_row(chunks: list[str], length: np.ndarray, variant: np.ndarray, pieces: Pieces, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the chunks in a row, how many each has)."""
    points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    stops = np.cumsum(length)
    starts = stops - length
    power = np.full(int(length.max()), int(_BASE), dtype=np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    terms = (points.astype(np.uint64) + np.uint64(1)) * power[np.repeat(stops, length) - 1 - np.arange(len(points))]
    keys = tv.mix(np.add.reduceat(terms, starts) ^ variant)   # as ``_chunk_keys``
    symbols = pieces.char_id[points].astype(np.int64)
    _agendas(symbols, starts, stops, keys, pieces, dropout)
    long = np.flatnonzero(length > LOCKSTEP).tolist()
    for i in long:
        symbols[starts[i]:stops[i]] = _GONE
    symbols[starts[long]] = _LONG
    size = (symbols != _GONE).astype(np.int64)
    other = np.flatnonzero((symbols < 0) & (symbols != _GONE))   # a long chunk or a character of several byte pieces
    if not len(other):
        return np.repeat(symbols, size).astype("<i4"), np.add.reduceat(size, starts)
    heap = (encode_agenda(chunks[i], int(keys[i]), pieces, dropout) for i in long)
    found = [next(heap) if s == _LONG else pieces.byte_pieces(chr(c)) for s, c in zip(symbols[other].tolist(), points[other].tolist())]
    size[other] = [len(f) for f in found]
    out, special = np.repeat(symbols, size), np.zeros(len(symbols), dtype=bool)
    special[other] = True
    out[np.repeat(special, size)] = [k for f in found for k in f]
    return out.astype("<i4"), np.add.reduceat(size, starts)


class _Chunks:
    """Encodes chunks with one vocabulary."""

    def __init__(self, params: DropoutParams):
        self.params, self.pieces = params, load_pieces(params.model or default_model())
        self.pattern = chunk_pattern(self.pieces)

    def encode_row(self, chunks: list[str], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the chunks in a row, how many each has), made from ``BLOCK`` characters at a time."""
        if not chunks:
            return np.zeros(0, "<i4"), np.zeros(0, np.int64)
        length = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        variant = variant_keys(self.params)[draws]
        cuts = np.flatnonzero(np.diff(np.cumsum(length) // BLOCK, prepend=-1, append=-1))
        parts = [_encode_row(chunks[a:b], length[a:b], variant[a:b], self.pieces, self.params.dropout) for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([counts for _, counts in parts])

    def encode(self, chunks: list[str], draws: np.ndarray) -> list[bytes]:
        ids, counts = self.encode_row(chunks, draws)
        stops = np.cumsum(counts)
        return [ids[a:b].tobytes() for a, b in zip((stops - counts).tolist(), stops.tolist())]


_memory: dict = {}


def encode_texts(texts: list[str | None], doc_ids: list[int | None], params: DropoutParams) -> list[bytes]:
    """Ids of each text as little-endian int32 bytes."""
    if _memory.get("params") != params:
        _memory.update(params=params, chunks=_Chunks(params))
    known = _memory["chunks"]
    flat, draws, heads = [], [np.zeros(0, np.uint64)], [0]
    for text, doc in zip(texts, doc_ids):
        chunks = known.pattern.findall(" " + text) if text else []
        flat.extend(chunks)
        draws.append(run_variants(doc, len(chunks), params))
        heads.append(len(flat))
    ids, counts = known.encode_row(flat, np.concatenate(draws))
    raw, stops = ids.tobytes(), (4 * np.concatenate(([0], np.cumsum(counts)))[heads]).tolist()
    return [raw[a:b] for a, b in zip(stops, stops[1:])]


def decode_ids(ids, params: DropoutParams = DropoutParams()) -> str:
    raw = load_pieces(params.model or default_model()).raw
    data = b"".join([raw[i] for i in ids])
    return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def _encode_batches(batches: Iterator[pa.RecordBatch], params: DropoutParams, digest: bool) -> Iterator[pa.RecordBatch]:
    for part in tv.slices(batches, "text", 1 << 20):
        texts = part.column("text").to_pylist()
        blobs = encode_texts(texts, part.column("doc_id").to_pylist(), params)
        counts = np.array([len(b) // 4 for b in blobs], dtype=np.int64)
        if digest:
            exact = [decode_ids(np.frombuffer(b, "<i4").tolist(), params) == (t or "") for b, t in zip(blobs, texts)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts), pa.array([zlib.crc32(b) for b in blobs], pa.int64()), pa.array(exact)],
                ["doc_id", "n_tokens", "ids_crc32", "lossless"])
        else:
            heads = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(heads), pa.array(np.frombuffer(b"".join(blobs), "<i4")))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, pa.array(counts)], ["doc_id", "ids", "n_tokens"])


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, params: DropoutParams = DropoutParams()) -> DataFrame:
    """doc_id, ids, n_tokens for every row."""
    return _source(docs).mapInArrow(partial(_encode_batches, params=params, digest=False), "doc_id long, ids array<int>, n_tokens long")


def encode_digest(docs: DataFrame, params: DropoutParams = DropoutParams()) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (little-endian 32-bit ids), lossless (the ids decode to the text) for every row."""
    return _source(docs).mapInArrow(partial(_encode_batches, params=params, digest=True), "doc_id long, n_tokens long, ids_crc32 long, lossless boolean")


def _decode_batches(batches: Iterator[pa.RecordBatch], params: DropoutParams) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [None if ids is None else decode_ids(ids, params) for ids in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def decode(encoded: DataFrame, params: DropoutParams = DropoutParams()) -> DataFrame:
    """doc_id, text from (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(partial(_decode_batches, params=params), "doc_id long, text string")
