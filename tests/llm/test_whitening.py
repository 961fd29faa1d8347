"""Whitening against numpy on the whole-number vectors."""

import numpy as np
import pytest

from shelfline.llm import catalog
from shelfline.llm.whitening import whiten

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>"


def expected(vectors):
    """Components, whitened rows and exact deviations of the vectors by plain numpy."""
    x = [tuple(int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), object)
    n, sums = len(fit), fit.sum(axis=0)
    gap = (n * fit - sums).astype(float) / n
    values, axes = np.linalg.eigh(gap.T @ gap / n)
    values, axes = values[::-1], axes[:, ::-1]
    rows = np.array(x, object)
    return n, [int(((n * r - sums) ** 2).sum()) for r in rows], (n * rows - sums).astype(float) / n @ axes / np.sqrt(np.abs(values)), values


def test_query_equals_numpy(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviations, whitened, values = expected([r.embedding for r in table])
    at = {r.vec_id: i for i, r in enumerate(table)}
    rows = catalog.QUERIES["op12_blockmatrix_whitening"](spark, sf).collect()
    assert len(rows) == 16 * len(table)
    got = np.zeros((len(table), 16))
    for r in rows:
        assert (r.n, r.deviation) == (n, deviations[at[r.vec_id]]) and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        got[at[r.vec_id], r.component - 1] = r.whitened
    sign = np.sign((got * whitened[:, :16]).sum(axis=0))
    assert np.abs(got - sign * whitened[:, :16]).max() < 1e-7


def test_copies_count_once_and_bad_rows_go(spark):
    rng = np.random.default_rng(4)
    good = [[float(c) for c in v] for v in rng.normal(size=(40, 3))]
    rows = [(i, v) for i, v in enumerate(good)] + [(100 + i, good[0]) for i in range(60)] + [(None, good[1]), (3, good[2])]
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0]), (203, [float("nan"), 0.0, 0.0]), (204, [float("inf"), 0.0, 0.0]), (205, [3e38, 0.0, 0.0]), (206, [1.0, 2.0])]
    n, deviations, whitened, _ = expected(good)
    found = whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert len(found) == 102 and {r.vec_id for r in found} == {None, *range(40), *range(100, 160)}
    for r in found:
        i = r.vec_id if r.vec_id is not None and r.vec_id < 100 else 0 if r.vec_id is not None else 1
        if i == 3:
            continue
        assert r["_n"] == n and r["_deviation"] == deviations[i] and np.allclose(np.abs(r["_whitened"]), np.abs(whitened[i]), atol=1e-9)
        assert sum(r["_explained"]) == pytest.approx(1)


@pytest.mark.parametrize("vectors, components", [([[1.0, 2.0]] * 5, 0), ([[float(i), 7.0, 2.0 * i] for i in range(9)], 1), ([], 0)])
def test_directions_without_variance_are_left_out(spark, vectors, components):
    found = whiten(spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], SCHEMA)).collect()
    assert len(found) == len(vectors) and all(len(r["_whitened"]) == len(r["_explained"]) == components for r in found)


def test_deviation_beyond_64_bits_is_null_and_names_may_clash(spark):
    rows = [(0, [1e16, 1.0], "a", 1), (1, [-1e16, 2.0], "b", 2), (2, [5.0, 3.0], None, None)]
    table = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, _whitened STRING, index INT")
    found = whiten(table).orderBy("vec_id").collect()
    assert [r["_deviation"] for r in found][:2] == [None, None] and [r["_whitened"] for r in found] == ["a", "b", None]
    assert all(len(r["__whitened"]) >= 1 for r in found)


def test_blocks_of_columns_and_rows(spark, monkeypatch):
    from shelfline.llm import whitening
    monkeypatch.setattr(whitening, "COLS", 2)
    monkeypatch.setattr(whitening, "LEAST_ROWS", 3)
    vectors = [[float(c) for c in v] for v in np.random.default_rng(8).normal(size=(50, 5))]
    _, _, whitened, _ = expected(vectors)
    found = whiten(spark.createDataFrame(list(enumerate(vectors)), SCHEMA).repartition(3)).collect()
    assert all(np.allclose(np.abs(r["_whitened"]), np.abs(whitened[r.vec_id]), atol=1e-8) for r in found)
