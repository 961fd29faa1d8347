"""BPE ids and token counts against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from shelfline.llm.bpe import WordBpe, decode_documents, encode_documents
from shelfline.llm.token_count import CLASSES, RESET, Counter, count_tokens, cut_positions, scan_states, splitter

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def expected_bpe(texts):
    t = Tokenizer.from_file(WORD)
    for e in t.encode_batch(texts, add_special_tokens=False):
        yield len(e.ids), np.array(e.ids, "<u4").tobytes(), sha(t.decode(e.ids, skip_special_tokens=False).encode())


@pytest.mark.parametrize("table", ["tricky", "documents"])
def test_ids_and_decoded_text_equal_the_library(table, request):
    docs = request.getfixturevalue(table)
    rows = docs.select("doc_id", "text").collect()
    want = sorted(zip([r.doc_id if r.doc_id is not None else -1 for r in rows], expected_bpe([r.text or "" for r in rows])))
    got = sorted((r.doc_id if r.doc_id is not None else -1, (r.n_tokens, bytes(r.ids), r.decoded_sha256)) for r in encode_documents(docs, WORD).collect())
    assert got == want


def test_digest_is_of_the_ids_and_decoding_joins_tokens(tricky):
    for r in decode_documents(encode_documents(tricky, WORD), WORD).collect():
        assert r.ids_sha256 == sha(bytes(r.ids)) and r.decoded_sha256 == sha(r.decoded.encode())


def test_long_words_and_random_bytes_merge_alike():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeinorstéß") for _ in range(rng.randint(1, 60))) for _ in range(300)] + ["a" * 999, "ab" * 700]
    model, t = WordBpe(WORD), Tokenizer.from_file(WORD)
    got = [ids.tolist() for ids, _ in model.encode(words)]
    assert got == [e.ids for e in t.encode_batch(words, add_special_tokens=False)]


def expected_counts(texts):
    t = Tokenizer.from_file(BYTE)
    return [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("table", ["tricky", "documents"])
def test_counts_equal_the_library(table, request):
    docs = request.getfixturevalue(table)
    rows = docs.select("doc_id", "text").collect()
    texts = [r.text or "" for r in rows]
    want = sorted((-1 if r.doc_id is None else r.doc_id, len(t.encode()), n, n > 1024) for r, t, n in zip(rows, texts, expected_counts(texts)))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, BYTE).collect())
    assert got == want


def test_counts_of_random_texts():
    import pyarrow as pa

    rng = random.Random(7)
    alphabet = "aabcdeilnorstv''  \n\t.,!?-09é漢😀 " + "RSTLV"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["".join(rng.choice("'srevldtm x") for _ in range(12)) for _ in range(1500)]
    assert Counter(BYTE).count_texts(pa.array(texts)).tolist() == expected_counts(texts)


def test_forgetting_states_changes_nothing(monkeypatch):
    import pyarrow as pa

    from shelfline.llm import token_count
    monkeypatch.setattr(token_count, "STATE_LIMIT", 10)
    monkeypatch.setattr(token_count, "WORD_LIMIT", 0)
    texts = ["some words to count", "and other words", "then thenceforth 12345"]
    counter = Counter(BYTE)
    for _ in range(2):
        assert counter.count_texts(pa.array(texts)).tolist() == expected_counts(texts)


def test_scan_equals_reading_in_order():
    rng = np.random.default_rng(3)
    classes = rng.integers(0, CLASSES, 5000).astype(np.uint8)
    to, _ = splitter()
    state, want = 0, []
    for c in classes:
        want.append(state)
        state = to[state, c]
    assert scan_states(classes).tolist() == want
    assert not cut_positions(np.full(3, RESET, np.uint8)).any()


def test_empty_tables(nothing):
    assert encode_documents(nothing, WORD).count() == 0 and count_tokens(nothing, BYTE).count() == 0
