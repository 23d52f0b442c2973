"""Language-model scores by a subword lattice.

Vocabulary and segmentations come from an existing SentencePiece vocabulary; no tokenizer is trained. A word, preceded by a space, can
be cut into pieces in many ways; all of them count: its probability is the sum over all segmentations of the product
of the pieces' probabilities, by a forward recursion in log space. A text's probability is the product over its words and one
end token, so words are scored once for the whole corpus.

Piece probabilities start from the vocabulary's own scores (for a merge vocabulary the score is the negated merge rank r,
read as a weight 1 / (r + 2)) and are re-estimated from the training words by ``rounds`` of expectation-maximisation:
expected piece counts from a forward-backward pass over every distinct training word, times its count. The end token
is one more piece. A character without a piece is the product of its byte pieces.

Corpus statistics are Spark aggregations over all rows. Words with high counts (a bounded number, ``head_words``) are sent to every
task; each text's other words meet their statistics in a shuffle join, so no hot word passes through a shuffle.

Defined results: null or empty text = the end token alone. A row with a null id trains and is not held out. Repeated rows
count and are scored each. Without training rows every base probability is 1 (N = V = 0) and pieces keep their start weights.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .pieces import Pieces, base_power, default_model, load_pieces, running_hash
from .store import id_remainder, written

FLUSH = 200_000  # distinct words that a counting task holds before it passes their counts on


@dataclass(frozen=True)
class LatticeParams:
    model: str | None = None     # path of a SentencePiece model; None: the public 32k model
    rounds: int = 2
    smoothing: float = 0.1       # added to every piece's expected count
    head_words: int = 150_000


# ---- word counts ----------------------------------------------------------------------------

def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, training count, count) sums; words are UTF-8 bytes with A-Z lower-cased."""
    counts = (Counter(), Counter())

    def out():
        train, rest = counts
        words = list(train.keys() | rest.keys())
        batch = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([train[w] for w in words], pa.int64())], ["w", "c"])
        train.clear()
        rest.clear()
        return batch

    for part in tv.slices(batches, "text"):
        for text, held in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("held_out").to_pylist()):
            if text:
                counts[held].update(text.lower().split())
        if len(counts[0]) + len(counts[1]) > FLUSH:
            yield out()
    yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """(w, c): every word of the corpus and its count in training rows (0: held-out rows only)."""
    return docs.select("text", "held_out").mapInArrow(_count_batches, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c"))


# ---- the lattice ----------------------------------------------------------------------------

def start_weights(pieces: Pieces) -> np.ndarray:
    """Log-probability of each piece from the vocabulary's scores; the last entry is the end token."""
    rank = np.empty(pieces.size)
    rank[np.argsort(-pieces.scores, kind="stable")] = np.arange(pieces.size)
    w = 1.0 / (rank + 2.0)
    w[[s is None and not pieces.raw[i] for i, s in enumerate(pieces.strings)]] = 0.0
    w = np.append(w, w.max())
    with np.errstate(divide="ignore"):
        return np.log(w / w.sum())


def _edges(points: np.ndarray, pieces: Pieces, logp: np.ndarray):
    """ids and log-weights [n, L, K]: the piece that ends after character t and has k + 1 characters."""
    n, size = points.shape
    widest = min(pieces.longest, size)
    sums = running_hash(points)
    ids = np.full((n, size, widest), -1, dtype=np.int64)
    table = pieces.substrings()
    for k in range(1, widest + 1):
        ids[:, k - 1:, k - 1] = table.find(sums[:, k:] - sums[:, :size + 1 - k] * base_power(k))
    weight = np.where(ids >= 0, logp[ids], -np.inf)
    bare = np.argwhere(ids[:, :, 0] < 0)  # characters without a piece: their byte pieces
    for i, t in bare:
        weight[i, t, 0] = sum(logp[b] for b in pieces.byte_pieces(chr(points[i, t])))
    return ids, weight, bare


def _forward(weight: np.ndarray) -> np.ndarray:
    """log alpha [n, L + 1]."""
    n, size, widest = weight.shape
    padded = np.full((n, size + 1 + widest), -np.inf)  # alpha[t] stands at t + widest
    padded[:, widest] = 0.0
    for t in range(1, size + 1):
        x = padded[:, t:t + widest][:, ::-1] + weight[:, t - 1, :]
        top = x.max(axis=1)
        padded[:, t + widest] = top + np.log(np.exp(x - top[:, None]).sum(axis=1))
    return padded[:, widest:]


def _backward(weight: np.ndarray) -> np.ndarray:
    n, size, widest = weight.shape
    beta = np.full((n, size + 1 + widest), -np.inf)
    beta[:, size] = 0.0
    for t in range(size - 1, -1, -1):
        k = np.arange(min(widest, size - t))
        x = beta[:, t + 1:t + 1 + len(k)] + weight[:, t + k, k]
        top = x.max(axis=1)
        beta[:, t] = top + np.log(np.exp(x - top[:, None]).sum(axis=1))
    return beta[:, :size + 1]


def _by_length(words: list[str], most: int = 1_000_000):
    """(indexes, code points [n, L]) of words of one length at a time, bounded by ``most`` edges."""
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(length, kind="stable")
    edges = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
    for lo, hi in zip(edges[:-1], edges[1:]):
        size = int(length[order[lo]])
        step = max(1, most // (16 * size))
        for cut in range(lo, hi, step):
            at = order[cut:min(hi, cut + step)]
            yield at, np.frombuffer("".join([words[i] for i in at]).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(at), size)


def _spaced(words: list[bytes]) -> list[str]:
    return [" " + w.decode("utf-8", "replace") for w in words]


def marginal_logs(words: list[bytes], pieces: Pieces, logp: np.ndarray) -> np.ndarray:
    """Natural log of each word's probability over all segmentations."""
    out = np.zeros(len(words))
    for at, points in _by_length(_spaced(words)):
        out[at] = _forward(_edges(points, pieces, logp)[1])[:, -1]
    return out


def expected_counts(words: list[bytes], counts: np.ndarray, pieces: Pieces, logp: np.ndarray) -> np.ndarray:
    """Sum over words of count times the expected number of each piece."""
    total = np.zeros(pieces.size + 1)
    for at, points in _by_length(_spaced(words)):
        ids, weight, bare = _edges(points, pieces, logp)
        alpha, beta = _forward(weight), _backward(weight)
        n, size, widest = weight.shape
        w, t, k = np.nonzero(ids >= 0)
        post = np.exp(alpha[w, t - k] + weight[w, t, k] + beta[w, t + 1] - alpha[w, -1]) * counts[at][w]
        total += np.bincount(ids[w, t, k], weights=post, minlength=pieces.size + 1)
        for i, pos in bare:  # nothing else covers such a character
            for b in pieces.byte_pieces(chr(points[i, pos])):
                total[b] += counts[at[i]]
    return total


def _expect_batches(batches: Iterator[pa.RecordBatch], model: str, logp: np.ndarray) -> Iterator[pa.RecordBatch]:
    pieces = load_pieces(model)
    total = np.zeros(pieces.size + 1)
    for batch in batches:
        total += expected_counts(batch.column("w").to_pylist(), np.asarray(batch.column("c")).astype(float), pieces, logp)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["piece", "e"])


def fit_pieces(words: DataFrame, ends: int, params: LatticeParams) -> np.ndarray:
    """Log-probabilities of the pieces and (last) the end token, from the training words' counts."""
    model = params.model or default_model()
    pieces = load_pieces(model)
    logp = start_weights(pieces)
    usable = np.isfinite(logp)
    for _ in range(params.rounds):
        sums = (words.filter("c > 0").mapInArrow(partial(_expect_batches, model=model, logp=logp), "piece int, e double")
                .groupBy("piece").agg(F.sum("e").alias("e")).toArrow())  # at most one row per piece
        e = np.zeros(pieces.size + 1)
        e[np.asarray(sums.column("piece"))] = np.asarray(sums.column("e"))
        e[-1] = ends
        if not e.any():
            break
        e = np.where(usable, e + params.smoothing, 0.0)
        with np.errstate(divide="ignore"):
            logp = np.log(e / e.sum())
    return logp


def _lattice_batches(batches: Iterator[pa.RecordBatch], model: str, logp: np.ndarray) -> Iterator[pa.RecordBatch]:
    pieces = load_pieces(model)
    for batch in batches:
        lp = marginal_logs(batch.column("w").to_pylist(), pieces, logp)
        yield pa.RecordBatch.from_arrays([batch.column("w"), batch.column("c"), pa.array(lp)], ["w", "c", "lp"])


# ---- texts ----------------------------------------------------------------------------------

def _head_threshold(words: DataFrame, most: int) -> int:
    """The smallest count that at most ``most`` words reach (from a histogram over quarter octaves)."""
    bucket = F.floor(F.log2(F.col("c")) * 4)
    rows = words.filter("c > 0").groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).collect()  # at most 256 rows
    total, least = 0, 1 << 62
    for r in sorted(rows, key=lambda r: -r["b"]):
        if total + r["n"] > most:
            break
        total, least = total + r["n"], r["least"]
    return least


_head: dict = {}


def _head_table(key: str, payload: bytes) -> dict:
    if _head.get("key") != key:
        t = pa.ipc.open_stream(payload).read_all()
        _head.update(key=key, table=dict(zip(t.column("w").to_pylist(), zip(t.column("base").to_pylist(), t.column("lp").to_pylist()))))
    return _head["table"]


def _text_batches(batches: Iterator[pa.RecordBatch], key: str, payload: bytes) -> Iterator[pa.RecordBatch]:
    """Per row: words, sums over its head words, and its other words with their counts."""
    head = _head_table(key, payload)
    for part in tv.slices(batches, "text"):
        n, known, base, lp, tails, tail_counts, heads = [], [], [], [], [], [], [0]
        for text in part.column("text").cast(pa.binary()).to_pylist():
            words = text.lower().split() if text else []
            k, b, p = 0, 0.0, 0.0
            for w, c in Counter(words).items():
                got = head.get(w)
                if got is None:
                    tails.append(w)
                    tail_counts.append(c)
                else:
                    k += c
                    b += c * got[0]
                    p += c * got[1]
            n.append(len(words))
            known.append(k)
            base.append(b)
            lp.append(p)
            heads.append(len(tails))
        offsets = pa.array(heads, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [part.column("rid"), part.column("doc_id"), part.column("held_out"), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(lp, pa.float64()),
             pa.ListArray.from_arrays(offsets, pa.array(tails, pa.binary())), pa.ListArray.from_arrays(offsets, pa.array(tail_counts, pa.int64()))],
            ["rid", "doc_id", "held_out", "n", "known", "base", "lp", "ws", "ns"])


_TEXT_SCHEMA = "rid long, doc_id long, held_out boolean, n long, known long, base double, lp double, ws array<binary>, ns array<long>"


def lattice_scores(docs: DataFrame, params: LatticeParams = LatticeParams()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Rows whose crc32(id) mod 5 is 1 are held out of all counts."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select(
        "doc_id", "text", F.coalesce(id_remainder("doc_id", 5) == 1, F.lit(False)).alias("held_out"))
    model = params.model or default_model()
    words = written(word_counts(src), "lm_words")
    ends = src.filter("not held_out").count()
    size = words.filter("c > 0").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = (size["n"] or 0) + ends, size["v"] + (1 if ends else 0)
    divisor = total + 0.5 * (distinct + 1)
    logp = fit_pieces(words, ends, params)
    stats = written(words.mapInArrow(partial(_lattice_batches, model=model, logp=logp), "w binary, c long, lp double")
                    .withColumn("base", F.log10((F.col("c") + 0.5) / F.lit(divisor))), "lm_stats")
    least = _head_threshold(stats, params.head_words)
    head = stats.filter(F.col("c") >= least).select("w", "base", "lp").toArrow().sort_by("w")  # bounded by head_words
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, head.schema) as out:
        out.write_table(head)
    payload = sink.getvalue().to_pybytes()
    key = hashlib.md5(payload).hexdigest()  # names the table in a worker's memory

    rows = src.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(partial(_text_batches, key=key, payload=payload), _TEXT_SCHEMA)
    rows = written(rows, "lm_rows")
    tail = (rows.select("rid", F.explode(F.arrays_zip("ws", "ns")).alias("x")).select("rid", F.col("x.ws").alias("w"), F.col("x.ns").alias("m"))
            .join(stats, "w")
            .select("rid", F.when(F.col("c") > 0, F.col("m")).otherwise(F.lit(0)).alias("known"), (F.col("m") * F.col("base")).alias("base"), (F.col("m") * F.col("lp")).alias("lp")))
    sums = tail.groupBy("rid").agg(F.sum("known").alias("tail_known"), F.sum("base").alias("tail_base"), F.sum("lp").alias("tail_lp"))
    end_base = math.log10((ends + 0.5) / divisor)
    none = F.lit(0.0)
    return rows.drop("ws", "ns").join(sums, "rid", "left").select(
        "doc_id", "held_out", (F.col("n") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("tail_known", F.lit(0)) + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", none) + F.lit(end_base)).alias("base_score"),
        ((F.col("lp") + F.coalesce("tail_lp", none) + F.lit(float(logp[-1]))) / F.lit(math.log(10.0))).alias("score"))
