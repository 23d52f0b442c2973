"""Toxicity: a factorization machine over hashed terms.

Terms of a text are its words (ASCII letters, digits, non-ASCII bytes; lower case) and their first 4 and 6
bytes, hashed to 2**``bits`` buckets; a text has a bucket or has it not. The score is
sigmoid(w0 + sum w_i + sum_{i<j} <v_i, v_j>): the factors v learn which terms together are worse (or better) than
each alone, such as an insult with the mention of a group.

Training takes a bounded sample of labelled rows and all their buckets; none is left out for standing alone badly. Every bucket's
linear weight pays an L1 penalty of ``caution`` standard deviations of its gradient under chance, so a bucket enters when
what the model still misses on its rows is more than chance; entered weights are then refitted at a tenth of it. Factors
start from the pairs of buckets (of ``pair_rows`` common rows or more, whatever either does alone) whose common rows the linear part misses
beyond the deviations that chance gives somewhere among so many pairs, and are fitted with the weights. Buckets that never enter
have zero weight, so the model is small, at most 2**``bits`` buckets.

Defined results: a null or empty text has no terms and scores sigmoid(w0). Without labels of both
classes every score is the share of label 1 (0.5 without any label). Only ``doc_id`` and ``text`` are inputs; a row
with a null id is scored and is not held out; repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .store import id_remainder, written
from .training import labelled_sample

_SEPARATORS = tv.non_alnum()


@dataclass(frozen=True)
class FMParams:
    bits: int = 20
    per_class: int = 4000
    max_occurrences: int = 8_000_000    # distinct (row, bucket) of the sample; beyond it, fewer rows
    caution: float = 2.0
    pair_margin: float = 1.5            # deviations beyond the highest that chance gives among all pairs
    pair_rows: int = 30                 # common rows that a pair needs
    relax: float = 0.1
    factors: int = 6
    epochs: int = 200
    rate: float = 0.05
    decay: float = 0.5
    seed: int = 11


def term_buckets(col: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every term occurrence."""
    data, offsets = tv.text_bytes(pc.utf8_lower(col.cast(pa.string())))
    starts, ends, rows = tv.word_spans(data, offsets, _SEPARATORS)
    sums = tv.prefix_sums(data)
    shift = np.uint64(64 - bits)
    out_rows, out = [rows], [tv.keyed(tv.span_hashes(sums, starts, ends), 1) >> shift]
    for salt, size in ((2, 4), (3, 6)):
        longer = np.flatnonzero(ends - starts >= size)
        out_rows.append(rows[longer])
        out.append(tv.keyed(tv.span_hashes(sums, starts[longer], starts[longer] + size), salt) >> shift)
    return np.concatenate(out_rows), np.concatenate(out).astype(np.int64)


def _distinct(rows: np.ndarray, buckets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    code = np.unique((rows << bits) | buckets)
    return code >> bits, code & ((1 << bits) - 1)


def _sample_terms(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for part in tv.slices(batches, "text"):
        rows, buckets = _distinct(*term_buckets(part.column("text"), bits), bits)
        heads = np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32)
        terms = pa.ListArray.from_arrays(pa.array(heads), pa.array(buckets.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), part.column("weight"), terms], ["doc_id", "y", "weight", "terms"])


def _fm_logits(model: dict, place: np.ndarray, row: np.ndarray, n: int):
    linear = np.bincount(row, weights=model["w"][place], minlength=n)
    v = model["v"][place]
    s = np.stack([np.bincount(row, weights=v[:, f], minlength=n) for f in range(v.shape[1])], axis=1)
    q = np.bincount(row, weights=(v * v).sum(axis=1), minlength=n)
    return model["w0"] + linear + 0.5 * ((s * s).sum(axis=1) - q), s, v


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class _Incidence:
    """Which of ``n`` rows have which of ``terms`` terms, with sums along either side; ``row`` is sorted."""

    def __init__(self, row: np.ndarray, place: np.ndarray, n: int, terms: int):
        self.row, self.place, self.n, self.terms = row.astype(np.int32), place.astype(np.int32), n, terms
        sizes = np.bincount(row, minlength=n)
        self._rows, self._row_heads = np.flatnonzero(sizes), (np.cumsum(sizes) - sizes)[sizes > 0]
        self._row_of = self.row[np.argsort(self.place, kind="stable")]
        sizes = np.bincount(place, minlength=terms)
        self._places, self._place_heads = np.flatnonzero(sizes), (np.cumsum(sizes) - sizes)[sizes > 0]

    def over_terms(self, w: np.ndarray) -> np.ndarray:
        """For each row, the sum of ``w`` over its terms."""
        out = np.zeros((self.n, *w.shape[1:]))
        if len(self.row):
            out[self._rows] = np.add.reduceat(w[self.place], self._row_heads, axis=0)
        return out

    def over_rows(self, m: np.ndarray) -> np.ndarray:
        """For each term, the sum of ``m`` over its rows."""
        out = np.zeros((self.terms, *m.shape[1:]))
        if len(self.row):
            out[self._places] = np.add.reduceat(m[self._row_of], self._place_heads, axis=0)
        return out

    def only(self, terms: np.ndarray) -> _Incidence:
        """The terms of a mask, numbered anew."""
        keep = terms[self.place]
        return _Incidence(self.row[keep], (np.cumsum(terms) - 1)[self.place[keep]], self.n, int(terms.sum()))


def _logits(x: _Incidence, w0, w: np.ndarray, v: np.ndarray):
    s = x.over_terms(v)
    return w0 + x.over_terms(w) + 0.5 * ((s * s).sum(axis=1) - x.over_terms((v * v).sum(axis=1))), s


def _descend(model: dict, x: _Incidence, active: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: np.ndarray, params: FMParams) -> None:
    """Refit the active terms in place: Adam on the weighted log loss, L1 steps on w, L2 on v."""
    some, cost = x.only(active), penalty[active]
    at = {"w0": model["w0"], "w": model["w"][active], "v": model["v"][active]}
    paired = at["v"].any(axis=0)
    first = {p: np.zeros_like(m) for p, m in at.items()}
    second = {p: np.zeros_like(m) for p, m in at.items()}
    floor = {"w0": 1e-6, "w": cost, "v": 1e-6}
    for step in range(1, params.epochs + 1):
        z, s = _logits(some, at["w0"], at["w"], at["v"])
        miss = weight * (_sigmoid(z) - y)
        grad = {"w0": miss.sum(keepdims=True), "w": some.over_rows(miss)}
        if paired.any():
            grad["v"] = (some.over_rows(miss[:, None] * s) - at["v"] * grad["w"][:, None] + params.decay * at["v"]) * paired
        rate = params.rate * (1 - step / (params.epochs + 1))
        for p, g in grad.items():
            first[p] = 0.9 * first[p] + 0.1 * g
            second[p] = 0.99 * second[p] + 0.01 * g * g
            size = rate / (np.sqrt(second[p] / (1 - 0.99 ** step)) + floor[p])
            at[p] = at[p] - size * first[p] / (1 - 0.9 ** step)
            if p == "w":
                at[p] = np.sign(at[p]) * np.maximum(np.abs(at[p]) - size * cost, 0.0)
    model["w0"] = at["w0"]
    model["w"][active], model["v"][active] = at["w"], at["v"]


def _pairs_beyond_chance(x: _Incidence, miss: np.ndarray, variance: np.ndarray, params: FMParams, block: int = 512) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score): every pair of terms of ``pair_rows`` rows or more whose common rows the model misses to one side by
    more than the largest chance deviation (``variance`` of each row) among all pairs; the scores have the sign of the product that is lacking. Dense blocks of rows by
    512 terms are made as needed, so memory does not depend on the number of terms."""
    able = np.flatnonzero(x.over_rows(np.ones(x.n)) >= params.pair_rows)
    bar = (np.sqrt(2 * np.log(max(2, len(able) * (len(able) - 1) // 2))) + params.pair_margin) ** 2
    number = np.full(x.terms, -1, dtype=np.int32)
    number[able] = np.arange(len(able))
    place = number[x.place]
    order = np.argsort(place, kind="stable").astype(np.int32)
    cuts = np.searchsorted(place[order], np.arange(0, len(able) + block, block))

    def dense(k: int) -> np.ndarray:
        out = np.zeros((x.n, min(block, len(able) - k * block)), dtype=np.float32)
        at = order[cuts[k]:cuts[k + 1]]
        out[x.row[at], place[at] - k * block] = 1.0
        return out

    lacking, spread = -miss.astype(np.float32)[:, None], variance.astype(np.float32)[:, None]
    least = np.sqrt(bar * params.pair_rows * variance.min())  # no pair of enough rows passes with a smaller sum
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for a in range(len(cuts) - 1):
        left = dense(a)
        weighted = left * lacking
        for b in range(a, len(cuts) - 1):
            right = left if a == b else dense(b)
            total = weighted.T @ right
            i, j = np.nonzero(np.abs(total) >= least * 0.999)
            i, j = (i[i < j], j[i < j]) if a == b else (i, j)
            common, chance = np.zeros(len(i)), np.zeros(len(i))
            for c in range(0, len(i), 512):
                both = left[:, i[c:c + 512]] * right[:, j[c:c + 512]]
                common[c:c + 512], chance[c:c + 512] = both.sum(axis=0), (both * spread).sum(axis=0)
            ok = (common >= params.pair_rows) & (total[i, j].astype(float) ** 2 > bar * chance)
            i, j, chance = i[ok], j[ok], chance[ok]
            found.append((able[i + a * block], able[j + b * block], total[i, j].astype(float) / np.sqrt(chance)))
    return tuple(np.concatenate(f) for f in zip(*found))


def _first_factors(pairs: tuple[np.ndarray, np.ndarray, np.ndarray], terms: int, params: FMParams) -> np.ndarray:
    """Factors whose products have the signs of the scores: leading eigenvectors of the pair matrix by subspace iteration."""
    i, j, score = pairs
    used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j, n = at[:len(i)], at[len(i):], len(used)
    k = min(params.factors, n)
    u = np.linalg.qr(np.random.default_rng(params.seed).normal(size=(n, k)))[0]
    shift = np.abs(score).sum() / max(1, n)
    for _ in range(60):
        step = np.stack([np.bincount(i, weights=score * u[j, f], minlength=n) + np.bincount(j, weights=score * u[i, f], minlength=n) for f in range(k)], axis=1)
        u = np.linalg.qr(step + shift * u)[0]
    v = np.zeros((terms, params.factors))
    v[used, :k] = 0.3 * u / np.maximum(np.abs(u).max(axis=0), 1e-12)
    return v


def fit_fm(place: np.ndarray, row: np.ndarray, y: np.ndarray, weight: np.ndarray, terms: int, params: FMParams = FMParams()) -> dict:
    """Factorization machine on rows of both classes; ``place`` are term numbers below ``terms``, ``row`` is sorted."""
    x = _Incidence(row, place, len(y), terms)
    share = (weight * y).sum() / weight.sum()
    variance = weight * weight * share * (1 - share)
    chance = np.sqrt(x.over_rows(variance))
    # sums of few rows are not normal: the second part is Bernstein's for steps up to the largest miss
    penalty = params.caution * chance + params.caution ** 2 / 3 * weight.max() * max(share, 1 - share)
    model = {"w0": np.array([np.log(share / (1 - share))]), "w": np.zeros(terms), "v": np.zeros((terms, params.factors))}
    active = np.zeros(terms, dtype=bool)

    def missed() -> np.ndarray:
        some = x.only(active)
        return weight * (_sigmoid(_logits(some, model["w0"], model["w"][active], model["v"][active])[0]) - y)

    def enter(cost: np.ndarray) -> None:
        nonlocal active
        for _ in range(10):
            fresh = (np.abs(x.over_rows(missed())) > penalty) & ~active
            if not fresh.any():
                return
            active |= fresh
            _descend(model, x, active, y, weight, cost, params)

    enter(penalty)
    active = model["w"] != 0
    _descend(model, x, active, y, weight, penalty * params.relax, params)
    pairs = _pairs_beyond_chance(x, missed(), variance, params)
    if len(pairs[0]):
        model["v"] = _first_factors(pairs, terms, params)
        active |= model["v"].any(axis=1)
        _descend(model, x, active, y, weight, penalty * params.relax, params)
    return model


def _within(terms: DataFrame, most: int) -> DataFrame:
    """The sample's rows, or the first of either class by hash whose buckets number at most ``most`` together."""
    sizes = terms.select("doc_id", "y", F.size("terms").alias("n"), F.xxhash64("doc_id").alias("h")).toArrow().sort_by([("h", "ascending"), ("doc_id", "ascending")])
    y, n = np.asarray(sizes.column("y")), np.asarray(sizes.column("n")).astype(np.int64)
    if n.sum() <= most:
        return terms
    turn = np.zeros(len(y))
    for c in (0, 1):
        turn[y == c] = (np.arange((y == c).sum())) / max(1, (y == c).sum())  # both classes shrink alike
    order = np.argsort(turn, kind="stable")
    keep = order[(np.cumsum(n[order]) <= most) | (turn[order] == 0)]
    ids = terms.sparkSession.createDataFrame([(int(i),) for i in np.asarray(sizes.column("doc_id"))[keep]], "doc_id long")
    return terms.join(F.broadcast(ids), "doc_id", "left_semi")


def train_toxicity(docs: DataFrame, labels: DataFrame, params: FMParams = FMParams()) -> dict:
    """Fit on the labelled rows that are not held out (crc32 of the id mod 5 is 0)."""
    sample = labelled_sample(docs, labels, "toxic", 5, 0, params.per_class)
    terms = written(sample.mapInArrow(partial(_sample_terms, bits=params.bits), "doc_id long, y int, weight double, terms array<int>"), "fm_sample")
    t = _within(terms, params.max_occurrences).toArrow().sort_by([("doc_id", "ascending")])
    y, weight = np.asarray(t.column("y")).astype(float), np.asarray(t.column("weight"))
    if not len(y) or y.min() == y.max():
        return {"constant": float(y.max()) if len(y) else 0.5, "bits": params.bits}
    lists = t.column("terms").combine_chunks()
    buckets = np.asarray(lists.flatten())
    seen = np.zeros(1 << params.bits, dtype=bool)
    seen[buckets] = True
    chosen, place = np.flatnonzero(seen), (np.cumsum(seen, dtype=np.int32) - 1)[buckets]
    row = np.repeat(np.arange(len(y), dtype=np.int32), np.asarray(pc.list_value_length(lists)))
    del t, lists, buckets
    model = fit_fm(place, row, y, weight, len(chosen), params)
    kept = (model["w"] != 0) | model["v"].any(axis=1)
    return {"w0": model["w0"], "w": model["w"][kept], "v": model["v"][kept], "chosen": chosen[kept], "bits": params.bits}


def _text_scores(col: pa.Array, model: dict) -> np.ndarray:
    n = len(col)
    if "constant" in model:
        return np.full(n, model["constant"])
    rows, buckets = term_buckets(col, model["bits"])
    chosen = model["chosen"]
    if not len(chosen):
        return np.full(n, _sigmoid(model["w0"])[0])
    at = np.minimum(np.searchsorted(chosen, buckets), len(chosen) - 1)
    hit = np.flatnonzero(chosen[at] == buckets)
    rows, place = _distinct(rows[hit], at[hit], 32)
    return _sigmoid(_fm_logits(model, place, rows, n)[0])


def _score_batches(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    for part in tv.slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_text_scores(part.column("text"), model))], ["doc_id", "score"])


def _keep_batches(batches: Iterator[pa.RecordBatch], model: dict, threshold: float) -> Iterator[pa.RecordBatch]:
    for part in tv.slices(batches, "text"):
        yield part.filter(pa.array(_text_scores(part.column("text"), model) < threshold))


def score_toxicity(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = src.mapInArrow(partial(_score_batches, model=model), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    return docs.mapInArrow(partial(_keep_batches, model=model, threshold=threshold), docs.schema)
