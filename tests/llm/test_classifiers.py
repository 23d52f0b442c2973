"""Quality and toxicity classifiers: held-out accuracy, interactions, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import quality_mil as Q
from ledgerlake.llm import toxicity_fm as T
from ledgerlake.llm.store import table

from .conftest import ODD_ROWS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return table(spark, SF, "documents"), table(spark, SF, "labels")


@pytest.mark.parametrize("module, train, score, label, least", [(Q, Q.train_quality, Q.score_quality, "quality", 0.95), (T, T.train_toxicity, T.score_toxicity, "toxic", 0.9)])
def test_held_out_accuracy_and_odd_rows(spark, tables, odd_docs, no_docs, labels_schema, module, train, score, label, least):
    docs, labels = tables
    model = train(docs, labels)
    out = score(docs, model)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == docs.count()
    held = out.join(labels, "doc_id").filter("held_out").select(F.avg((F.col(label) == F.col("predicted")).cast("int")), F.count("*")).first()
    assert held[0] >= least and held[1] > 30
    again = train(docs, labels)  # the same sample and seed give the same model
    assert all(np.array_equal(model[k], again[k]) for k in model)
    odd = score(odd_docs, model).collect()
    assert len(odd) == len(ODD_ROWS) and all(0 <= r.score <= 1 and r.held_out is not None and r.predicted in (0, 1) for r in odd)
    assert len({r.score for r in odd if r.doc_id in (2, 3)}) == 1  # null text = empty text
    assert score(no_docs, model).count() == 0
    none = spark.createDataFrame([], labels_schema)
    assert {r.score for r in score(odd_docs, train(odd_docs, none)).collect()} == {0.5}
    one_sided = spark.createDataFrame([(1, 1, 1), (None, 0, 0), (3, None, None), (1, 1, 1)], labels_schema)
    assert {r.score for r in score(odd_docs, train(odd_docs, one_sided)).collect()} == {1.0}
    keep = Q.keep_good(odd_docs, model) if module is Q else T.drop_toxic(odd_docs, model)
    want = [r.predicted for r in odd].count(1 if module is Q else 0)
    assert keep.schema == odd_docs.schema and keep.count() == want


def test_attention_finds_the_one_bad_passage():
    rng = np.random.default_rng(0)
    bags, y = [], []
    for i in range(300):
        x = rng.normal(0, 1, (rng.integers(1, 8), 6))
        if i % 3 == 0:
            x[rng.integers(len(x)), 2] += 8
        bags.append(x)
        y.append(float(i % 3 != 0))
    bag = np.repeat(np.arange(300), [len(b) for b in bags])
    x, y = np.concatenate(bags), np.array(y)
    model = Q.fit_mil(x, bag, y, np.ones(300), Q.MILParams(epochs=60))
    assert ((Q.bag_scores(model, x.astype(np.float32), bag, 300) > 0.5) == (y > 0.5)).mean() > 0.97


def test_passages_cover_whole_texts():
    import pyarrow as pa

    from ledgerlake.llm import textvec as tv
    texts = ["a b c d e", "", None, "word " * 1000, "  lead", "x"]
    x, row = Q.passage_features(*tv.text_bytes(pa.array(texts)), 2)
    assert np.bincount(row).tolist() == [3, 1, 1, 500, 1, 1]
    assert np.isfinite(x).all() and np.allclose((x[:, -1] * 2).sum(), 5 + 1000 + 2)


def test_factors_learn_what_additive_weights_miss():
    # terms 0 and 1 are harmless apart and toxic together; so are 2 and 3
    rows, y = [], []
    rng = np.random.default_rng(1)
    for _ in range(800):
        on = rng.random(4) < 0.5
        rows.append(np.flatnonzero(on))
        y.append(float((on[0] and on[1]) != (on[2] and on[3])))
    place, row = np.concatenate(rows), np.repeat(np.arange(800), [len(r) for r in rows])
    y = np.array(y)
    fm = T.fit_fm(place, row, y, np.ones(800), 4, T.FMParams(epochs=600, factors=4, seed=3))
    flat = dict(fm, v=np.zeros_like(fm["v"]))
    hit = lambda m: ((T._fm_logits(m, place, row, 800)[0] > 0) == (y > 0.5)).mean()
    assert hit(fm) > 0.85 and hit(fm) > hit(flat) + 0.15


def _toxicity_case(spark, n, words):
    """n rows of filler words plus those that ``words(i, rng)`` gives with a label; ids from 0."""
    rng = np.random.default_rng(4)
    rows, marks = [], []
    for i in range(n):
        extra, toxic = words(i, rng)
        filler = [f"w{k}" for k in rng.integers(0, 300, 12)]
        rows.append((i, " ".join(rng.permutation(filler + extra))))
        marks.append((i, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string").repartition(4), spark.createDataFrame(marks, "doc_id long, toxic int"))


def _naive_score(model, text):
    """The machine's formula by a loop over all pairs of a text's buckets."""
    import pyarrow as pa
    _, buckets = T.term_buckets(pa.array([text]), model["bits"])
    at = [list(model["chosen"]).index(b) for b in sorted(set(buckets.tolist())) if b in set(model["chosen"].tolist())]
    z = float(model["w0"][0]) + sum(model["w"][i] for i in at)
    z += sum(float(model["v"][i] @ model["v"][j]) for a, i in enumerate(at) for j in at[a + 1:])
    return 1 / (1 + np.exp(-z))


def test_training_finds_a_pair_whose_words_say_nothing_alone(spark):
    def words(i, rng):
        a, b = rng.random(2) < 0.5
        return ["zeta"] * int(a) + ["omega"] * int(b), a == b
    docs, labels = _toxicity_case(spark, 2500, words)
    model = T.train_toxicity(docs, labels)
    out = T.score_toxicity(docs, model).join(labels, "doc_id").filter("held_out").collect()
    assert len(out) > 300 and np.mean([r.predicted == r.toxic for r in out]) > 0.97
    texts = {r.doc_id: r.text for r in docs.limit(40).collect()}
    got = {r.doc_id: r.score for r in T.score_toxicity(docs, model).collect()}
    assert all(abs(got[i] - _naive_score(model, t)) < 1e-9 for i, t in texts.items())


def test_a_rare_clear_word_gets_a_weight(spark):
    # "vilest" stands in 10 of about 1,500 toxic rows (those without the common insult) and in no clean one
    def words(i, rng):
        toxic = i % 2 == 1
        return (["vilest"] if toxic and i % 300 == 1 else ["idiot"]) if toxic else [], toxic
    docs, labels = _toxicity_case(spark, 3000, words)
    out = T.score_toxicity(docs, T.train_toxicity(docs, labels)).join(labels, "doc_id").collect()
    rare = [r for r in out if r.doc_id % 300 == 1]
    assert len(rare) == 10 and all(r.predicted for r in rare)
    assert not any(r.predicted for r in out if not r.toxic)


def test_sample_over_its_occurrences_takes_fewer_rows(spark):
    docs, labels = _toxicity_case(spark, 400, lambda i, rng: (["idiot"] if i % 2 else [], i % 2))
    small = T.train_toxicity(docs, labels, T.FMParams(max_occurrences=4000))
    assert "constant" not in small
    out = T.score_toxicity(docs, small).join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in out]) > 0.95
    # a bound below one row still leaves the first row of either class
    assert 0 <= T.score_toxicity(docs, T.train_toxicity(docs, labels, T.FMParams(max_occurrences=1))).first().score <= 1
