"""Cutting ordered groups at a budget against plain sorting."""

import random

import pytest
from pyspark.sql import functions as F

from shelfline.llm.cuts import digits, prefix_cut, within
from shelfline.llm.importance import importance_scores, resample
from shelfline.session import materialize


def values(kind, rng):
    return {"far": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(0, 300), "near": lambda: 17321 + rng.random() * 100,
            "small": lambda: rng.gauss(0, 1e-9), "ties": lambda: float(rng.randint(-3, 3)) * 1e5}[kind]()


@pytest.mark.parametrize("kind", ["far", "near", "small", "ties"])
def test_prefix_of_each_group(spark, kind):
    rng = random.Random(kind)
    rows = [(rng.choice("ab"), values(kind, rng), i, rng.randint(1, 9)) for i in range(3000)]
    rows += [("a", float("inf"), 5000, 1), ("a", float("-inf"), 5001, 1)]
    df = materialize(spark.createDataFrame(rows, "g STRING, x DOUBLE, i INT, size BIGINT"), "rows")
    limits = {"a": 4000, "b": 10**6}
    budgets = spark.createDataFrame([(g, float(n)) for g, n in limits.items()], "g STRING, budget DOUBLE")
    cut = prefix_cut(df, "g", "x", ["i"], "size", budgets)
    got = {r.i for r in df.join(cut, "g").where(within("x", ["i"])).collect()}
    want = set()
    for g, limit in limits.items():
        total = 0
        for _, x, i, size in sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2])):
            total += size
            if total > limit:
                break
            want.add(i)
    assert got == want and {r.g: r.taken for r in cut.collect()}["a"] <= 4000


def test_digits_ascend_and_keep_values_apart(spark):
    rng = random.Random(1)
    xs = sorted({values(k, rng) for k in ("far", "near", "small") for _ in range(500)})
    df = spark.createDataFrame([(x,) for x in xs], "x DOUBLE").select("x", *[c.alias(n) for c, n in zip(digits(F.col("x")), ("a", "b"))])
    pairs = [(r.a, r.b) for r in sorted(df.collect(), key=lambda r: r.x)]
    assert pairs == sorted(pairs)
    assert len({p for p, x in zip(pairs, xs) if 17321 <= x <= 17421}) > 400  # no shared cell for scores far from 0


def test_resampling_keeps_the_highest_keys(spark, documents, labels):
    scored, share = importance_scores(documents, labels)
    order = sorted(scored.collect(), key=lambda r: (-r.key, r.doc_id, r.tie))
    keep = {(r.doc_id, r.tie) for r in order[: int(len(order) * share)]}
    assert {(r.doc_id, r.tie) for r in resample(documents, labels).where("kept").collect()} == keep
