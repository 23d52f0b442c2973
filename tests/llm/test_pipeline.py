"""The pipeline against its stages' plain definitions, and on odd rows."""

import numpy as np
import pyarrow as pa

import corpus_pipeline as P
from ledgerlake.llm import merge_dropout as M
from ledgerlake.llm import quality_mil as Q
from ledgerlake.llm import string_tiling as G
from ledgerlake.llm import toxicity_fm as T
from ledgerlake.llm.store import table

from .conftest import ODD_ROWS
from .test_dedup_and_search import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_run_equals_the_stages_by_brute_force(spark):
    assert [n for n, _ in P.STAGES] == ["quality", "toxicity", "near_duplicates", "decontamination", "encode"]
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = {r.doc_id: r.text for r in docs.collect()}

    def scores(score, model, ids):
        df = spark.createDataFrame([(i, rows[i]) for i in ids], "doc_id long, text string")
        return df, {r.doc_id: r.score for r in score(df, model).collect()}

    ids = sorted(rows)
    df, s = scores(Q.score_quality, Q.train_quality(docs, labels), ids)
    ids = [i for i in ids if s[i] >= 0.7]
    left = docs.filter(docs.doc_id.isin(ids))
    df, s = scores(T.score_toxicity, T.train_toxicity(left, labels), ids)
    ids = [i for i in ids if s[i] < 0.5]
    root = slow_components([slow_fingerprint(rows[i]) for i in ids], 4)
    ids = [i for k, i in enumerate(ids) if root[k] == k]
    items = [G.word_hashes(pa.array([r.text]))[0] for r in table(spark, SF, "benchmark").collect()]
    ids = [i for i in ids if not any(G.coverage(b, G.word_hashes(pa.array([rows[i]]))[0], 5)[0] >= 0.6 for b in items)]
    out = {r.doc_id: r for r in P.run(spark, SF).collect()}
    assert sorted(out) == ids
    assert all(out[i].ids == np.frombuffer(M.encode_texts([rows[i]], [i], M.DropoutParams())[0], "<i4").tolist() for i in ids)


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            if name != "encode":
                assert out.schema.names == docs.schema.names
                assert out.count() <= docs.count()
            docs = out
        assert docs.columns == ["doc_id", "ids", "n_tokens"]
        assert docs.count() <= len(ODD_ROWS)
