"""The stages of the corpus pipeline on a small corpus, each against what it claims."""

import collections
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
from brute import components_of, secrets_of
from tokenizers import Tokenizer

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in pipeline.STAGES:
        docs = pipeline.materialize(stage(spark, docs, SF), "test-stage")
        out.append(docs)
    return out


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(spark, stages):
    names = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(s.columns == names for s in stages[:-1])


def test_one_of_each_group_stays(stages):
    before, after = rows_of(stages[0]), rows_of(stages[1])
    want = {i for i, _, c in components_of(before, 5, 80) if i == c}
    assert sorted(i for i, _ in after) == sorted(want)


def test_secrets_are_cut_out(stages):
    before, after = dict(rows_of(stages[1])), dict(rows_of(stages[2]))
    assert before.keys() == after.keys()
    for i, text in before.items():
        spans = secrets_of(text)
        if not spans:
            assert after[i] == text
        else:
            assert "[SECRET]" in after[i] and not any(text[a:b] in after[i] for _, a, b in spans)


def test_copies_and_tokens(spark, stages):
    mixed = rows_of(stages[3])
    assert max(collections.Counter(i for i, _ in mixed).values()) <= 2 and {i for i, _ in mixed} <= {i for i, _ in rows_of(stages[2])}
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = collections.Counter((i, hashlib.sha256(np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()) for i, t in mixed)
    assert collections.Counter((r.doc_id, r.ids_sha256) for r in stages[4].collect()) == want
    assert pipeline.run(spark, SF).count() == len(mixed)


def test_stages_take_odd_and_empty_tables(spark, tricky, nothing):
    for docs in (tricky, nothing):
        for _, stage in pipeline.STAGES:
            assert stage(spark, docs, SF).count() >= 0


def test_stages_take_clashing_columns(spark, documents):
    docs = documents.selectExpr("*", "1 as _tie", "2 as _spans", "3 as _copies", "4 as _copy", "5 as kept", "6 as tie", "7 as _id")
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.where("_tie = 1 and _spans = 2 and _copies = 3").count() > 100
