"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``passage_words`` words, all of them. Each passage is encoded by a learned
layer over its character-class and repetition statistics; gated attention (tanh times sigmoid) weighs the passages,
with weights learned from document labels alone, and a logistic layer scores the weighted sum.

Training takes a bounded sample of labelled rows (``per_class`` documents of either class) with all of
their passages; scoring reads every passage of every text.

Defined results: a null or empty text is a bag with one empty passage; its score is the model's for it. Without
labels of both classes every score is the share of label 1 (0.5 without any label). Only ``doc_id`` and
``text`` are inputs; a row with a null id is scored and is not held out; repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .store import id_remainder
from .training import labelled_sample

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
COARSE = 8  # lower, upper, digit, space, line end, punctuation, non-ASCII, other control
FINE = COARSE + len(PUNCTUATION)
WORD_STATS = 6
FEATURES = FINE + COARSE * COARSE + WORD_STATS


@dataclass(frozen=True)
class MILParams:
    passage_words: int = 64
    per_class: int = 1500
    hidden: int = 24
    attention: int = 12
    epochs: int = 30
    batch: int = 128
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 7


def _class_tables() -> tuple[np.ndarray, np.ndarray]:
    coarse = np.full(256, 7, dtype=np.uint8)
    coarse[0x61:0x7B] = 0
    coarse[0x41:0x5B] = 1
    coarse[0x30:0x3A] = 2
    coarse[[0x20, 0x09]] = 3
    coarse[[0x0A, 0x0B, 0x0C, 0x0D]] = 4
    coarse[list(PUNCTUATION)] = 5
    coarse[0x80:] = 6
    fine = coarse.copy()
    for k, c in enumerate(PUNCTUATION):
        fine[c] = COARSE + k
    return coarse, fine


_COARSE, _FINE = _class_tables()
_SPACE = tv.whitespace()


def passage_features(data: np.ndarray, offsets: np.ndarray, passage_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(features of each passage, row of each passage) for rows of text; every row has one passage at least."""
    n = len(offsets) - 1
    starts, ends, rows = tv.word_spans(data, offsets, _SPACE)
    words = tv.row_counts(rows, n)
    passages = np.maximum(1, -(-words // passage_words))
    first_passage = np.cumsum(passages) - passages
    first_word = np.cumsum(words) - words
    total = int(passages.sum())
    of_row = np.repeat(np.arange(n), passages)
    of_word = first_passage[rows] + (np.arange(len(starts)) - first_word[rows]) // passage_words
    # a passage's bytes run from its first word to the next passage's first word (or the row's ends)
    begin = offsets[:-1][of_row].copy()
    inner = np.arange(total) - first_passage[of_row]
    later = np.flatnonzero(inner > 0)
    begin[later] = starts[first_word[of_row[later]] + inner[later] * passage_words]
    stop = np.concatenate((begin[1:], offsets[-1:]))
    size = stop - begin
    of_byte = np.repeat(np.arange(total), size)

    x = np.zeros((total, FEATURES), dtype=np.float32)
    x[:, :FINE] = np.bincount(of_byte * FINE + _FINE[data], minlength=total * FINE).reshape(total, FINE)
    pair = _COARSE[data].astype(np.int64) * COARSE
    pair[:-1] += _COARSE[data[1:]]
    x[:, FINE:FINE + COARSE * COARSE] = np.bincount(of_byte * (COARSE * COARSE) + pair, minlength=total * COARSE * COARSE).reshape(total, -1)
    x[:, :FINE + COARSE * COARSE] /= np.maximum(size, 1)[:, None]

    count = np.bincount(of_word, minlength=total).astype(np.float32)
    some = np.maximum(count, 1)
    if len(starts):
        length = ends - starts
        h = tv.span_hashes(tv.prefix_sums(data), starts, ends)
        lag1 = np.zeros(len(h), dtype=bool)
        lag1[1:] = (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])
        lag2 = np.zeros(len(h), dtype=bool)
        lag2[2:] = (h[2:] == h[:-2]) & (of_word[2:] == of_word[:-2])
        code = np.sort((of_word.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
        fresh = np.concatenate(([True], code[1:] != code[:-1]))
        distinct = np.bincount((code[fresh] >> np.uint64(40)).astype(np.int64), minlength=total)
        per = partial(np.bincount, minlength=total)
        x[:, -6] = per(of_word, weights=length) / some / 16
        x[:, -5] = per(of_word, weights=lag1) / some
        x[:, -4] = per(of_word, weights=lag2) / some
        x[:, -3] = distinct / some
        x[:, -2] = per(of_word, weights=length == 1) / some
    x[:, -1] = count / passage_words
    return x, of_row


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _forward(model: dict, x: np.ndarray, bag: np.ndarray, bags: int):
    """Attention-weighted bag vectors; ``bag`` is ascending and every bag has a passage."""
    x = np.clip((x - model["mean"]) / model["scale"], -6, 6)
    h = np.tanh(x @ model["We"] + model["be"])
    a1 = np.tanh(h @ model["V"] + model["bv"])
    a2 = _sigmoid(h @ model["U"] + model["bu"])
    s = (a1 * a2) @ model["w"]
    heads = np.searchsorted(bag, np.arange(bags))
    e = np.exp(s - np.maximum.reduceat(s, heads)[bag])
    a = e / np.add.reduceat(e, heads)[bag]
    z = np.add.reduceat(a[:, None] * h, heads, axis=0)
    return x, h, a1, a2, a, z, heads


def bag_scores(model: dict, x: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
    if "constant" in model:
        return np.full(bags, model["constant"])
    z = _forward(model, x, bag, bags)[5]
    return _sigmoid(z @ model["c"] + model["b"]).astype(np.float64)


def fit_mil(x: np.ndarray, bag: np.ndarray, y: np.ndarray, weight: np.ndarray, params: MILParams = MILParams()) -> dict:
    """Train the encoder, the gated attention and the scorer together (Adam, weighted log loss)."""
    if len(y) == 0 or y.min() == y.max():
        return {"constant": float(y.mean()) if len(y) else 0.5}
    rng = np.random.default_rng(params.seed)
    d, m, k = x.shape[1], params.hidden, params.attention
    net = {"We": rng.normal(0, 1 / np.sqrt(d), (d, m)), "be": np.zeros(m), "V": rng.normal(0, 1 / np.sqrt(m), (m, k)), "bv": np.zeros(k),
           "U": rng.normal(0, 1 / np.sqrt(m), (m, k)), "bu": np.zeros(k), "w": rng.normal(0, 1 / np.sqrt(k), k), "c": rng.normal(0, 1 / np.sqrt(m), m), "b": np.zeros(1)}
    scaler = {"mean": x.mean(axis=0), "scale": x.std(axis=0) + 0.02}
    first = {p: np.zeros_like(v) for p, v in net.items()}
    second = {p: np.zeros_like(v) for p, v in net.items()}
    heads = np.searchsorted(bag, np.arange(len(y) + 1))
    step = 0
    for _ in range(params.epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), params.batch):
            chosen = np.sort(order[lo:lo + params.batch])
            at = np.concatenate([np.arange(heads[i], heads[i + 1]) for i in chosen])
            own = np.repeat(np.arange(len(chosen)), heads[chosen + 1] - heads[chosen])
            xs, h, a1, a2, a, z, _ = _forward(net | scaler, x[at], own, len(chosen))
            miss = weight[chosen] * (_sigmoid(z @ net["c"] + net["b"]) - y[chosen]) / len(chosen)
            dz = miss[:, None] * net["c"]
            dh = a[:, None] * dz[own]
            da = (h * dz[own]).sum(axis=1)
            ds = a * (da - np.bincount(own, weights=a * da)[own])
            d1 = ds[:, None] * net["w"] * a2 * (1 - a1 * a1)
            d2 = ds[:, None] * net["w"] * a1 * a2 * (1 - a2)
            dh = (dh + d1 @ net["V"].T + d2 @ net["U"].T) * (1 - h * h)
            grad = {"We": xs.T @ dh, "be": dh.sum(0), "V": h.T @ d1, "bv": d1.sum(0), "U": h.T @ d2, "bu": d2.sum(0), "w": (a1 * a2).T @ ds, "c": z.T @ miss, "b": miss.sum(keepdims=True)}
            step += 1
            for p, g in grad.items():
                g = g + params.decay * net[p]
                first[p] = 0.9 * first[p] + 0.1 * g
                second[p] = 0.999 * second[p] + 0.001 * g * g
                net[p] -= params.rate * (first[p] / (1 - 0.9 ** step)) / (np.sqrt(second[p] / (1 - 0.999 ** step)) + 1e-8)
    return {p: v.astype(np.float32) for p, v in (net | scaler).items()}


def _sample_features(batches: Iterator[pa.RecordBatch], params: MILParams) -> Iterator[pa.RecordBatch]:
    for part in tv.slices(batches, "text"):
        x, row = passage_features(*tv.text_bytes(part.column("text")), params.passage_words)
        heads = np.searchsorted(row, np.arange(part.num_rows + 1))
        blobs = [x[a:b].astype("<f4").tobytes() for a, b in zip(heads[:-1], heads[1:])]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), part.column("weight"), pa.array(blobs, pa.binary())],
                                         ["doc_id", "y", "weight", "x"])


def train_quality(docs: DataFrame, labels: DataFrame, params: MILParams = MILParams()) -> dict:
    """Fit on the labelled rows that are not held out (crc32 of the id mod 4 is 2)."""
    sample = labelled_sample(docs, labels, "quality", 4, 2, params.per_class)
    t = sample.mapInArrow(partial(_sample_features, params=params), "doc_id long, y int, weight double, x binary").toArrow()
    t = t.sort_by([("doc_id", "ascending"), ("x", "ascending")])
    bags = [np.frombuffer(b, "<f4").reshape(-1, FEATURES) for b in t.column("x").to_pylist()]
    if not bags:
        return fit_mil(np.zeros((0, FEATURES)), np.zeros(0, int), np.zeros(0), np.zeros(0), params)
    bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    return fit_mil(np.concatenate(bags), bag, np.asarray(t.column("y")).astype(float), np.asarray(t.column("weight")), params)


def _text_scores(part: pa.RecordBatch, model: dict, passage_words: int) -> np.ndarray:
    x, row = passage_features(*tv.text_bytes(part.column("text").cast(pa.string())), passage_words)
    return bag_scores(model, x, row, part.num_rows)


def _score_batches(batches: Iterator[pa.RecordBatch], model: dict, passage_words: int) -> Iterator[pa.RecordBatch]:
    for part in tv.slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_text_scores(part, model, passage_words))], ["doc_id", "score"])


def _keep_batches(batches: Iterator[pa.RecordBatch], model: dict, passage_words: int, threshold: float) -> Iterator[pa.RecordBatch]:
    for part in tv.slices(batches, "text"):
        yield part.filter(pa.array(_text_scores(part, model, passage_words) >= threshold))


def score_quality(docs: DataFrame, model: dict, params: MILParams = MILParams(), threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = src.mapInArrow(partial(_score_batches, model=model, passage_words=params.passage_words), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: dict, params: MILParams = MILParams(), threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more."""
    return docs.mapInArrow(partial(_keep_batches, model=model, passage_words=params.passage_words, threshold=threshold), docs.schema)
