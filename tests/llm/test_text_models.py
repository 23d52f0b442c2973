"""Lattice scores, ORC tokens, merge-dropout: brute force and round trips."""

import math
import random
import sys
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
import sentencepiece

from ledgerlake.llm import lattice_lm as L
from ledgerlake.llm import merge_dropout as M
from ledgerlake.llm import orc_tokens as O
from ledgerlake.llm.pieces import default_model, load_pieces

from .conftest import ODD_ROWS

TEXTS = [r[1] for r in ODD_ROWS if r[1] is not None] + ["  two  spaces ", "tab\tand\nline\r\n", "The END. don't (x). a,b 12", "a" * 100 + "b" * 60, "́ mark", "½. é. ²! İ. ́."]


# ---- merge dropout --------------------------------------------------------------------------

def test_without_dropout_it_is_the_library_encoding():
    sp = sentencepiece.SentencePieceProcessor(model_file=default_model())
    for t in TEXTS:
        if "▁" not in t:
            got = np.frombuffer(M.encode_texts([t], [3], M.DropoutParams(dropout=0.0))[0], "<i4").tolist()
            assert got == sp.encode(t)


def test_lockstep_agenda_equals_the_heap_agenda_and_decodes():
    pieces, p = load_pieces(default_model()), M.DropoutParams(dropout=0.3)
    changed = 0
    for doc, t in enumerate(TEXTS):
        got = np.frombuffer(M.encode_texts([t], [doc], p)[0], "<i4").tolist()
        chunks = M.chunk_pattern(pieces).findall(" " + t) if t else []
        assert "".join(chunks) == (" " + t if t else "")
        draw = np.repeat(M.run_variants(doc, len(chunks), p), p.run)[:len(chunks)]
        want = []
        for c, v in zip(chunks, draw):
            key = M._chunk_keys(np.frombuffer(c.encode("utf-32-le"), "<u4").reshape(1, -1), M.variant_keys(p)[[v]])[0]
            want += M.encode_agenda(c, int(key), pieces, p.dropout)
        assert got == want and M.decode_ids(got) == t
        changed += got != np.frombuffer(M.encode_texts([t], [doc], M.DropoutParams(dropout=0.0))[0], "<i4").tolist()
    assert changed > len(TEXTS) // 2
    assert M.encode_texts(TEXTS, [1] * len(TEXTS), p) == M.encode_texts(TEXTS, [1] * len(TEXTS), p)
    assert M.encode_texts(TEXTS, [1] * len(TEXTS), p) != M.encode_texts(TEXTS, [1] * len(TEXTS), M.DropoutParams(dropout=0.3, seed=7))


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6, 1.0])
def test_rounds_over_blocks_equal_the_heap_agenda(monkeypatch, dropout):
    monkeypatch.setattr(M, "BLOCK", 64)
    pieces, p = load_pieces(default_model()), M.DropoutParams(dropout=dropout)
    rng = random.Random(5)
    chunks = [" " * rng.randint(0, 2) + "".join(rng.choices("etaoinhrsé▁½漢😀\n", k=rng.randint(1, size))) for size in (3, 9, 48, 49, 130) for _ in range(60)]
    chunks += [" " + "the" * 15 + "th", " " + "the" * 16, "a" * 48, "a" * 49, "😀" * 70]
    draws = M.run_variants(7, len(chunks), p)
    for c, v, got in zip(chunks, draws, M._Chunks(p).encode(chunks, draws)):
        key = M._chunk_keys(np.frombuffer(c.encode("utf-32-le"), "<u4").reshape(1, -1), M.variant_keys(p)[[v]])[0]
        assert np.frombuffer(got, "<i4").tolist() == M.encode_agenda(c, int(key), pieces, dropout)


def test_new_words_need_no_python_calls_of_their_own():
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("etaoinshrdlu", k=7)) for _ in range(5000)) for _ in range(2)]
    M.encode_texts(["warm up"], [0], M.DropoutParams())
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event == "call" else None)
    try:
        M.encode_texts(texts, [1, 2], M.DropoutParams())
    finally:
        sys.setprofile(None)
    assert len(calls) < 5000  # for 10,000 words, nearly all of them new


def test_encode_and_decode_tables(odd_docs, no_docs):
    out = M.encode(odd_docs)
    assert out.columns == ["doc_id", "ids", "n_tokens"]
    assert sorted((r.doc_id, r.text) for r in M.decode(out).collect() if r.doc_id is not None) == sorted((r[0], r[1] or "") for r in ODD_ROWS if r[0] is not None)
    digest = M.encode_digest(odd_docs).collect()
    assert len(digest) == len(ODD_ROWS) and all(r.lossless for r in digest)
    assert M.encode(no_docs).count() == 0 and M.encode_digest(no_docs).count() == 0


# ---- lattice --------------------------------------------------------------------------------

def slow_log_probability(word, pieces, logp):
    @lru_cache(None)
    def total(i):
        if i == len(word):
            return 1.0
        s = 0.0
        for j in range(i + 1, len(word) + 1):
            p = pieces.id_of.get(word[i:j])
            if p is not None:
                s += math.exp(logp[p]) * total(j)
        if word[i] not in pieces.id_of:
            s += math.exp(sum(logp[b] for b in pieces.byte_pieces(word[i]))) * total(i + 1)
        return s

    return math.log(total(0))


def slow_counts(word, pieces, logp):
    """Expected pieces by listing all segmentations."""
    found = []

    def walk(i, ids):
        if i == len(word):
            found.append(ids)
            return
        for j in range(i + 1, len(word) + 1):
            if word[i:j] in pieces.id_of:
                walk(j, [*ids, pieces.id_of[word[i:j]]])
        if word[i] not in pieces.id_of:
            walk(i + 1, [*ids, *pieces.byte_pieces(word[i])])

    walk(0, [])
    weights = [math.exp(sum(logp[x] for x in ids)) for ids in found]
    out = Counter()
    for ids, w in zip(found, weights):
        for x in ids:
            out[x] += w / sum(weights)
    return out


def test_marginals_and_expected_counts_over_all_segmentations():
    pieces = load_pieces(default_model())
    logp = L.start_weights(pieces)
    assert abs(np.exp(logp).sum() - 1) < 1e-9
    words = ["the", "there", "unhappy", "é🙂x", "q", "日本x"]
    got = L.marginal_logs([w.encode() for w in words], pieces, logp)
    assert np.allclose(got, [slow_log_probability(" " + w, pieces, logp) for w in words], rtol=1e-9)
    counts = np.array([2.0, 1, 3, 1, 5, 2])
    want = np.zeros(pieces.size + 1)
    for w, c in zip(words, counts):
        for i, x in slow_counts(" " + w, pieces, logp).items():
            want[i] += c * x
    assert np.allclose(L.expected_counts([w.encode() for w in words], counts, pieces, logp), want)


@pytest.mark.parametrize("head", [0, 5, 1000])
def test_document_scores(spark, odd_docs, no_docs, head):
    rows = [(r[0], r[1]) for r in ODD_ROWS]
    params = L.LatticeParams(rounds=1, head_words=head)
    got = L.lattice_scores(odd_docs, params)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    c = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    total, distinct = sum(c.values()), len(c)
    pieces = load_pieces(default_model())
    logp = L.start_weights(pieces)
    train = [w for w in c if w is not None]
    e = L.expected_counts(train, np.array([float(c[w]) for w in train]), pieces, logp)
    e[-1] = c[None]
    e = np.where(np.isfinite(logp), e + params.smoothing, 0)
    with np.errstate(divide="ignore"):
        logp = np.log(e / e.sum())
    want = []
    for (i, _), ws, h in zip(rows, tokens, held):
        base = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        marks = L.marginal_logs([w for w in ws if w is not None], pieces, logp)
        want.append((i, h, len(ws), sum(c[w] > 0 for w in ws), total, round(base, 6), round((marks.sum() + logp[-1]) / math.log(10), 6)))
    out = [(*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in got.collect()]
    assert sorted(out, key=repr) == sorted(want, key=repr)
    if not head:
        assert L.lattice_scores(no_docs, params).count() == 0
        all_held = odd_docs.filter("doc_id in (1)" if zlib.crc32(b"1") % 5 == 1 else "doc_id = -1")
        assert all(r.base_score == 0 and r.n_known == 0 for r in L.lattice_scores(all_held, params).collect())


def test_every_occurrence_draws_for_itself():
    p = M.DropoutParams(dropout=0.3)
    one = M.encode_texts(["unbelievable" for _ in range(2000)], list(range(2000)), p)
    assert len(set(one)) > 16
    text = "unbelievable " * 31
    parts = M._Chunks(p).encode([" unbelievable"] * 31, M.run_variants(5, 31, p))
    assert len(set(parts)) > 4  # within what was one run
    assert M.decode_ids(np.frombuffer(M.encode_texts([text], [5], p)[0], "<i4").tolist()) == text


# ---- ORC ------------------------------------------------------------------------------------

def test_words_encode_as_the_library_does():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(O.default_tokenizer())  # unaltered
    texts = [*TEXTS, "a <|endoftext|> b", "foo<|startoftext|>bar\n<|endoftext|>", "A <|ENDOFTEXT|> <| endoftext |>", "<|endoftext|>"]
    for text, blob in zip(texts, O.encode_texts([x.encode() for x in texts], O.TokenParams())):
        assert np.frombuffer(blob, "<u4").tolist() == [*t.encode(text, add_special_tokens=False).ids, 1]


def test_files_hold_ascending_ids_and_prune(spark, odd_docs, no_docs, tmp_path):
    rows = O.token_digest(odd_docs).collect()
    want = sorted(ODD_ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    blobs = O.encode_texts([r[1].encode() if r[1] is not None else None for r in want], O.TokenParams())
    start = 0
    expect = []
    for r, b in zip(want, blobs):
        expect.append((r[0], start, len(b) // 4, zlib.crc32(b)))
        start += len(b) // 4
    assert sorted((tuple(r) for r in rows), key=lambda r: r[1]) == expect
    path = str(tmp_path / "orc")
    O.write_tokens(spark.range(5000).selectExpr("id * 2 as doc_id", "concat('text ', id) as text"), path, O.TokenParams(stripe_bytes=1 << 16, index_stride=1000))
    assert [r.doc_id for r in O.lookup(spark, path, [4000, 4001]).collect()] == [4000]
    plan = O.lookup(spark, path, [4000])._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "doc_id" in plan.split("PushedFilters")[1][:120]
    back = O.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in back] == list(range(0, 10000, 2)) and back[1].start == back[0].n_tokens
    assert O.token_digest(no_docs).count() == 0
