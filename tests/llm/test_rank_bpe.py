"""Recursive merges against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from shelfline.llm import catalog, rank_bpe
from shelfline.llm.rank_bpe import RankBpe, decode_ranked, encode_ranked

PATH = P.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(b):
    return hashlib.sha256(b).hexdigest()


def expected(rows, library):
    out = []
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        out.append((-1 if r.doc_id is None else r.doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode_bytes(ids))))
    return sorted(out)


@pytest.mark.parametrize("table", ["tricky", "documents"])
def test_ids_and_decoded_bytes_equal_the_library(table, request, library):
    docs = request.getfixturevalue(table)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_ranked(docs, PATH).collect())
    assert got == expected(docs.select("doc_id", "text").collect(), library)


def test_query_is_whole(spark, library):
    rows = catalog.QUERIES["op13_recursive_bpe"](spark, SF)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = expected(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect(), library)
    assert sorted(map(tuple, rows.collect())) == want


def test_random_words_and_repeats(library):
    rng = random.Random(11)
    words = ["".join(rng.choice(a) for _ in range(rng.randint(1, 50))) for a in ("abcdeinorst", "aé漢😀ing", "xyzXYZ", "=-*_") for _ in range(200)]
    words += ["a" * 999, "ab" * 700, "ing" * 500, "=" * 3000, "\x00\x01\x02" * 9, "".join(rng.choice("ACGT") for _ in range(20000))]
    ids, word = RankBpe(PATH, P.PATTERN).merge([w.encode() for w in words])
    cut = np.searchsorted(word, np.arange(len(words) + 1))
    for i, w in enumerate(words):
        assert ids[cut[i] : cut[i + 1]].tolist() == library._core_bpe.encode_single_piece(w.encode()), w[:50]


def test_pairs_below_their_parts_are_merged_in_order(tmp_path):
    """Ranks in random order, so that contractions yield pairs of lower rank all the time."""
    rng = random.Random(2)
    tokens = ["".join(rng.choice("abc") for _ in range(rng.randint(2, 6))) for _ in range(150)]
    tokens = list(dict.fromkeys(tokens))
    rng.shuffle(tokens)
    ranks = {bytes([b]): b for b in range(256)} | {t.encode(): 256 + i for i, t in enumerate(tokens)}
    path = tmp_path / "ranks.tiktoken"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {r}\n" for t, r in ranks.items()))
    other = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 80))) for _ in range(600)]
    ids, word = RankBpe(str(path), r"\w+").merge([w.encode() for w in words])
    cut = np.searchsorted(word, np.arange(len(words) + 1))
    for i, w in enumerate(words):
        assert ids[cut[i] : cut[i + 1]].tolist() == other.encode_ordinary(w), w


def test_decoding_gives_the_text_back(tricky):
    for r in decode_ranked(encode_ranked(tricky, PATH).join(tricky.select("doc_id", "text"), "doc_id"), PATH).collect():
        assert r.decoded_sha256 == sha(bytes(r.decoded))


def test_null_ids_columns_of_any_name_and_small_cache(spark, nothing, monkeypatch, library):
    assert encode_ranked(nothing, PATH).count() == 0
    rows = spark.createDataFrame([(1, "ids and more", "x"), (2, None, "y")], "doc_id INT, text STRING, ids STRING")
    assert sorted(r.n_tokens for r in encode_ranked(rows, PATH).collect()) == [0, len(library.encode_ordinary("ids and more"))]
    nulls = spark.createDataFrame([(None,), (bytearray(b""),)], "ids BINARY")
    assert [r.decoded for r in decode_ranked(nulls, PATH).collect()] == [None, bytearray(b"")]
    monkeypatch.setattr(rank_bpe, "CACHED_WORDS", 2)
    model = RankBpe(PATH, P.PATTERN)
    for text in ("some words here", "other words there"):
        assert [np.frombuffer(i, "<u4").tolist() for i, _ in model.encode([text])] == [library.encode_ordinary(text)]
