"""Mixing, quality, licences, sketches and duplicates against brute force."""

import collections
import hashlib
import re

import duckdb
import pytest
from brute import WORD, components_of, grams, jaccard
from pyspark.sql import functions as F

from shelfline.llm import catalog, divergence, licenses, mixing, near_dup, sketches
from shelfline.llm.importance import resample

SF = "/root/testdata/sf0.001"


def on_duckdb(sql):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con.execute(sql).df()


@pytest.mark.parametrize("name", list(catalog.SQL))
def test_queries_equal_their_sql(spark, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    want = on_duckdb(catalog.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda df: sorted(tuple(None if x != x else x for x in r) for r in df[sorted(df.columns)].itertuples(index=False))
    assert [tuple(map(str, r)) for r in key(got)] == [tuple(map(str, r)) for r in key(want)]


# Mixing ---------------------------------------------------------------------------------------------------------


def targets_by_rounds(sizes, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    got, left, open_ = {s: 0.0 for s in sizes}, share * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        extra = {s: left * w[s] / total for s in open_}
        left = 0
        for s, x in extra.items():
            got[s] += x
            if got[s] >= most * sizes[s]:
                left += got[s] - most * sizes[s]
                got[s] = most * sizes[s]
                open_.discard(s)
    return got


def test_mix_meets_its_targets(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(documents).collect()
    assert len(rows) == documents.count()
    size, taken = collections.Counter(), collections.Counter()
    for r in rows:
        assert r["_size"] == len(WORD.findall(r.text)) and 0 <= r["_copies"] <= 2
        size[r.source] += r["_size"]
        taken[r.source] += r["_size"] * r["_copies"]
    want = targets_by_rounds(size)
    for r in rows:
        assert abs(r["_target"] - want[r.source]) < 1e-6 and r["_source_size"] == size[r.source]
    for s in size:
        assert abs(taken[s] - want[s]) <= 0.03 * want[s]
    again = {(r.doc_id, r["_copies"]) for r in mixing.mix(documents.repartition(7)).collect()}
    assert again == {(r.doc_id, r["_copies"]) for r in rows}


def test_mix_of_odd_rows(tricky, nothing, spark):
    rows = mixing.mix(tricky).collect()
    assert len(rows) == tricky.count()
    assert all(r["_copies"] == 0 for r in rows if not WORD.search(r.text or ""))
    assert {r["_target"] for r in rows if r.source is None} and all(r["_copies"] <= 2 for r in rows)
    twins = [r["_copies"] for r in rows if r.doc_id == 6 and r.source == "a"]
    assert len(set(twins)) == 1
    assert mixing.mix(nothing).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id BIGINT, text STRING, source STRING")
    assert [(r["_target"], r["_copies"]) for r in mixing.mix(empty).collect()] == [(0.0, 0), (0.0, 0)]
    clash = mixing.mix(tricky.withColumns({"_copies": F.lit("x"), "_key": F.lit(1), "Size": F.lit(2), "target": F.lit(3)}))
    assert clash.columns[-4:] == ["_size", "_source_size", "_target", "__copies"]
    assert sorted(r["__copies"] for r in clash.collect()) == sorted(r["_copies"] for r in rows)


def test_preferred_documents_are_taken_more_often(spark):
    rows = [(i, "w " * 10, "s", 3.0 if i % 2 else 0.5) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING, liking DOUBLE")
    got = mixing.mix(df, share=0.5, preference="liking").groupBy("liking").agg(F.avg("_copies")).collect()
    mean = {r[0]: r[1] for r in got}
    assert abs(mean[3.0] - 0.857) < 0.06 and abs(mean[0.5] - 0.143) < 0.06


# Quality --------------------------------------------------------------------------------------------------------


def test_resampling_keeps_the_top_share(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fitted = labels.where("doc_id % 2 = 0")
    rows = resample(docs, fitted, rate=0.85).collect()
    assert sum(r.kept for r in rows) == int(0.85 * len(rows))
    held_out = {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1").collect()}
    right = [r.kept == bool(held_out[r.doc_id]) for r in rows if r.doc_id in held_out]
    assert sum(right) / len(right) > 0.93
    again = {(r.doc_id, r.kept) for r in resample(docs.repartition(5), fitted, rate=0.85).collect()}
    assert again == {(r.doc_id, r.kept) for r in rows}


def test_resampling_of_odd_rows(tricky, nothing, labels, spark):
    assert resample(tricky, labels).count() == tricky.count()
    assert resample(nothing, labels).count() == 0
    unlabelled = resample(tricky, labels.where("false"))
    assert unlabelled.where("not kept or log_weight != 0").count() == 0
    odd = spark.createDataFrame([(None, 1), (1, None), (6, 1)], "doc_id BIGINT, quality INT")
    assert resample(tricky.withColumn("kept", F.lit(1)), odd).count() == tricky.count()


def counts_of(text):
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    covered = {j for k in range(len(words) - 4) if windows[tuple(words[k:k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


@pytest.mark.parametrize("table", ["tricky", "documents"])
def test_quality_counts(table, request):
    docs = request.getfixturevalue(table)
    key = lambda i: -1 if i is None else i
    want = sorted((key(r.doc_id), *counts_of(r.text or "")) for r in docs.collect())
    rows = divergence.quality_rules(docs).collect()
    assert sorted((key(r.doc_id), *[r[s] for s in divergence.STATS], r.base_failed) for r in rows) == want
    assert not any(r.kept and r.base_failed for r in rows)


def test_distance_is_jensen_shannon():
    import numpy as np
    d = divergence.distance(np.array([[1, 0], [1, 1], [0, 0]]), np.array([[0, 5], [3, 3], [1, 1]]))
    assert d.tolist() == [1.0, 0.0, 0.0]


def test_strange_documents_go_and_clean_ones_stay(spark, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = divergence.quality_rules(docs).join(labels, "doc_id").where("n_words >= 30 and not base_failed")
    share = {r.quality: r.s for r in rows.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert share[1] > 0.98 and share[0] < 0.1
    assert divergence.quality_rules(nothing).count() == 0


# Licences -------------------------------------------------------------------------------------------------------


def test_whole_licences_in_other_words(spark, tricky, nothing):
    mit = licenses.KNOWN["MIT"][1]
    texts = [mit, "Copyright (c) 1999 Some Body\n" + mit.upper().replace(",", " ;"), mit.replace("sublicense", "sub-license"),
             mit + " and more", "Preface.\n\n" + mit.replace("\n", " "), "Released under the MIT licence", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    assert [got[i]["_whole"] for i in range(8)] == ["MIT", "MIT", "MIT", None, None, "MIT", None, None]
    assert [x["unit"] for x in got[4]["_licenses"]] == ["line", "paragraph"]
    clash = licenses.scan_licenses(df.withColumns({"_licenses": F.lit(1), "_key": F.lit(2), "form": F.lit(3), "license": F.lit(4)}))
    assert {r.doc_id: r["__licenses"] for r in clash.collect()} == {i: r["_licenses"] for i, r in got.items()}
    assert licenses.scan_licenses(tricky).count() == tricky.count() and licenses.scan_licenses(nothing).count() == 0


# Sketches -------------------------------------------------------------------------------------------------------


def test_fingerprints(spark, documents):
    docs = {r.doc_id: r.text for r in documents.collect()}
    ids = sorted(docs)
    rows = {r.doc_id: r for r in catalog.op7_bottom_k(spark, SF).collect()}
    assert len(rows) == len(ids)
    for i, k in enumerate(ids):
        text, after = docs[k], docs[ids[(i + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = rows[k]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, new, nxt = grams(text, 5), grams(edited, 5), grams(after, 5)
        assert abs(r.near_edited - jaccard(own, new)) < 0.2 and abs(r.near_next - jaccard(own, nxt)) < 0.2
        assert abs(r.distinct_shingles - len(own)) <= 0.4 * len(own)
        if len(own | new) < sketches.K:
            assert abs(r.near_edited - jaccard(own, new)) < 1e-9


def test_sketches_merge(spark):
    df = spark.createDataFrame([(" ".join(f"a{i}" for i in range(400)), " ".join(f"a{i}" for i in range(300, 900)), " ".join(f"a{i}" for i in range(900)))], "a STRING, b STRING, c STRING")
    for c in "abc":
        df = sketches.with_sketch(df, c, f"s{c}")
    row = df.select(sketches.merge(F.col("sa"), F.col("sb")).alias("m"), "sa", "sc",
                    sketches.containment(F.col("sa"), F.col("sc")).alias("inside")).first()
    assert set(row.m) <= set(row.sc) | set(row.m) and len(set(row.m) - set(row.sc)) <= 0 and abs(row.inside - 1) < 0.15


def test_fingerprints_of_odd_rows(tricky, nothing, spark):
    rows = sketches.fingerprints(tricky).collect()
    assert len(rows) == tricky.count() and sketches.fingerprints(nothing).count() == 0
    same = collections.defaultdict(set)
    for r, text in ((r, r) for r in rows):
        same[r.n_chars, tuple(r.sketch)].add(tuple(r.sketch))
    alone = spark.createDataFrame([(5, "a b c d")], "doc_id BIGINT, text STRING")
    assert sketches.fingerprints(alone).first().edited == "a b a b"


@pytest.mark.parametrize("blocks", [1, 3, 50])
def test_next_row_across_blocks(spark, blocks):
    rows = [(i * i % 101, f"t{i}") for i in range(60)] + [(None, "last"), (None, "later")]
    df = spark.createDataFrame(rows, "k BIGINT, t STRING").distinct()
    got = {(r.k, r.t): r.next_t for r in sketches.with_next(sketches.dealt_in_order(df, ["k", "t"], blocks), ["k", "t"], ["t"]).collect()}
    order = sorted(got, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    assert [got[x] for x in order] == [x[1] for x in order[1:] + order[:1]]


# Near duplicates ------------------------------------------------------------------------------------------------


def check_components(df, words=3, percent=85):
    want = components_of([(r.doc_id, r.text) for r in df.collect()], words, percent)
    rows = near_dup.near_duplicates(df, words, percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return want


def test_near_duplicates(documents, tricky):
    check_components(documents)
    check_components(tricky.where("doc_id is not null"))


def family(n, hub_words=60):
    """Copies of one text with ever more words changed, and chains of small changes away from it."""
    base = [f"w{i}" for i in range(hub_words)]
    rows = [(7, " ".join(base))]
    for i in range(n):
        words = list(base)
        for k in range(i % 7):
            words[(i * 11 + k * 17) % hub_words] = f"x{i}_{k}"
        rows.append((100 + (i * 37) % n * 3, " ".join(words)))
    words = list(base)
    for i in range(12):
        words = words[:]
        words[i * 5] = f"chain{i}"
        rows.append((5000 - i, " ".join(words)))
    return rows


@pytest.mark.parametrize("tile", [512, 8])
def test_large_groups_lose_no_link(spark, monkeypatch, tile):
    monkeypatch.setattr(near_dup, "TILE", tile)
    df = spark.createDataFrame(family(60), "doc_id BIGINT, text STRING")
    want = check_components(df)
    assert len({c for _, _, c in want}) < 0.7 * len(want)


def test_rows_without_id(tricky, nothing):
    rows = near_dup.near_duplicates(tricky).collect()
    nameless = sorted((r.component_id is None, r.kept) for r in rows if r.doc_id is None)
    assert nameless == [(False, False), (True, True)] and len(rows) == tricky.count()
    assert near_dup.near_duplicates(nothing).count() == 0


def sketched(texts, words=3):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array([0] * len(texts))], names=["a", "b", "c"])
    return near_dup.Sketched.of(pa.Table.from_batches(list(near_dup.signatures(words, 6, 25)(iter([batch])))))


@pytest.mark.parametrize("n", [5, 30, 44, 200, 700, 1000, 1300, 2100, 5000])
@pytest.mark.parametrize("subset", [True, False])
def test_bounds_hold_the_similarity(n, subset):
    """Texts that lose their last words, or have others there, around the thresholds, at all levels of the samples."""
    texts = [" ".join(f"w{i}" for i in range(n))]
    for share in (0.02, 0.08, 0.12, 0.15, 0.17, 0.2, 0.22, 0.3, 0.6):
        cut = max(1, int(n * (1 - share)))
        texts.append(" ".join([f"w{i}" for i in range(cut)] + [f"y{i}" for i in range(0 if subset else int(share * n))]))
    rows = sketched(texts)
    est, high = rows.bounds(rows, pairwise=False)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            true = jaccard(grams(a, 3), grams(b, 3))
            assert high[i, j] >= true - 1e-12 and abs(est[i, j] - true) < 0.1 + (true < 0.5), (n, i, j, true)
    back = list(range(len(texts)))[::-1]
    assert (rows.bounds(rows.at(back), pairwise=True)[0] == est[range(len(texts)), back]).all()


def long_pairs(percent, sizes=(1300, 2100, 3500, 5000)):
    """Pairs of a text and its beginning, or of two texts that overlap, a little above and below the threshold."""
    rows, at = [], 0
    for n in sizes:
        for extra in (-2, -0.5, 0.05, 0.5, 1, 2, 3):
            j = (percent + extra) / 100
            words = [f"t{at}x{i}" for i in range(n + 2)]
            rows += [(2 * at, " ".join(words)), (2 * at + 1, " ".join(words[: round(j * n) + 2]))]
            at += 1
            shift = round(n * (1 - j) / (1 + j))
            words = [f"t{at}x{i}" for i in range(n + shift + 2)]
            rows += [(2 * at, " ".join(words[: n + 2])), (2 * at + 1, " ".join(words[shift:]))]
            at += 1
    return rows


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_long_texts_of_unequal_length_lose_no_link(spark, words, percent):
    df = spark.createDataFrame(long_pairs(percent), "doc_id BIGINT, text STRING").repartition(6)
    rows = near_dup.near_duplicates(df, words, percent).collect()
    got = {r.doc_id: r.component_id for r in rows}
    texts = {r.doc_id: grams(r.text, words) for r in df.collect()}
    linked = 0
    for i in range(0, len(got), 2):
        same = 100 * len(texts[i] & texts[i + 1]) >= percent * len(texts[i] | texts[i + 1])
        linked += same
        assert (got[i], got[i + 1]) == (i, i if same else i + 1)
    assert 20 < linked < len(got) // 2


def near_threshold(n, copies, seed):
    """Short texts that differ in a few words from one another, so that many pairs lie beside the threshold."""
    import random

    rng = random.Random(seed)
    base = [f"w{i}" for i in range(n)]
    rows = []
    for i in range(copies):
        words = list(base)
        for _ in range(rng.randint(0, max(3, n // 25))):
            words[rng.randrange(n)] = f"x{rng.randrange(5)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("n", [40, 46, 62])
def test_short_texts_beside_the_threshold(spark, n):
    check_components(spark.createDataFrame(near_threshold(n, 150, n), "doc_id BIGINT, text STRING"))


@pytest.mark.parametrize("tile, looks", [(512, 2), (16, 1), (16, 0)])
def test_refuted_links_are_looked_at_again(spark, monkeypatch, tile, looks):
    calls, look = [], near_dup.second_look

    def second_look(*args, full):
        calls.append((args[2].count(), full))
        return look(*args, full=full)

    monkeypatch.setattr(near_dup, "TILE", tile)
    monkeypatch.setattr(near_dup, "LOOKS", looks)
    monkeypatch.setattr(near_dup, "second_look", second_look)
    check_components(spark.createDataFrame(near_threshold(300, 120, 5), "doc_id BIGINT, text STRING"))
    assert calls and calls[0][0] > 0 and [full for _, full in calls] == [k == looks for k in range(len(calls))]


def test_group_of_near_copies_proposes_few_links(spark, monkeypatch):
    """Texts one edit from a common one, 0.86 from each other: pairs grow with the group, not with its square."""
    made, links = [], near_dup.candidate_links

    def candidate_links(*args):
        found = near_dup.materialize(links(*args))
        made.append(found.count())
        return found

    monkeypatch.setattr(near_dup, "candidate_links", candidate_links)
    base = [f"w{i}" for i in range(82)]
    rows = [(i, " ".join(base[: 3 + i % 76] + [f"x{i}"] + base[4 + i % 76:])) for i in range(600)]
    out = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), 3, 85).collect()
    assert len({r.component_id for r in out}) == 1 and made[0] < 3000
