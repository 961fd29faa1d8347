"""Spelling variants against plain dictionaries."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from shelfline.llm import catalog, variants as V
from shelfline.llm.fm_index import LETTER, BidirectionalIndex

SF = "/root/testdata/sf0.001"


def words_of(rows):
    count = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def neighbours(vocabulary):
    """Near words by their common deletions."""
    shared = collections.defaultdict(set)
    for w in vocabulary:
        for i in range(len(w)):
            shared[w[:i] + w[i + 1:]].add(w)
        shared[w].add(w)
    near = collections.defaultdict(set)
    for group in shared.values():
        for a in group:
            near[a] |= {b for b in group if a != b and one_edit(a, b)}
    return near


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(rows):
    n = words_of(rows)
    near = neighbours(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def listed(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert listed(catalog.QUERIES["op11_fm_variants"](spark, sf)) == expected(rows)


def made_up(rng, n):
    roots = ["".join(rng.choice("abcÀß×") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    out = []
    for i in range(n):
        w = list(rng.choice(roots))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randint(0, 1)] = rng.choice(["a", "b", ""])
        out.append((rng.choice([i, 7, None]), " ".join(["".join(w)] * rng.randint(1, 9)) + ", x"))
    return out


def test_small_parts_and_split_groups_change_nothing(spark, monkeypatch):
    rows = made_up(random.Random(1), 1500) + [(None, None), (1, ""), (2, "Abcde abcde ABCDE Àbcde Àbcde Àbcde àbcde")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    want = expected(rows)
    assert len(want) > 200 and max(r[4] for r in want) > 3 and any(r[1] and r[2] != r[1] for r in want)
    for limit in (1 << 16, 400, 60):
        monkeypatch.setattr(V, "SYMBOLS", limit)
        assert listed(V.variants(df.repartition(3))) == want


def test_index_finds_each_near_word_once():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(3, 9))) for _ in range(300)})
    code = {"a": LETTER, "b": LETTER + 1}
    index = BidirectionalIndex([np.array([code[c] for c in w]) for w in words], LETTER + 2)
    for length in range(5, 9):
        group = [w for w in words if len(w) == length]
        queries, half = np.array([[code[c] for c in w] for w in group]), length // 2
        first = [(group[q], words[w]) for q, w in zip(*index.half_exact(queries, half))]
        last = [(group[q], words[w]) for q, w in zip(*index.reversed().half_exact(queries[:, ::-1], length - half))]
        near = {(a, b) for a in group for b in words if one_edit(a, b)}
        assert sorted(first) == sorted((a, b) for a, b in near if b.startswith(a[:half]))
        assert sorted(last) == sorted((a, b) for a, b in near if b.endswith(a[half:]))


def test_one_long_word_empty_table_and_clashing_names(spark, nothing):
    assert V.variants(nothing).count() == 0
    long = "ab" * 4000
    df = spark.createDataFrame([(i, f"{long} {long}c", "w", 1) for i in range(4)], "doc_id BIGINT, text STRING, word STRING, n INT")
    assert listed(V.variants(df)) == expected([(i, f"{long} {long}c") for i in range(4)])
