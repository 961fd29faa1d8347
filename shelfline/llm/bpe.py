"""BPE encoding and decoding in batched numpy merge rounds.

The distinct words of a batch lie behind each other in one flat array of symbols. In every round the ranks of all
neighbouring pairs are found by binary search over the sorted pair keys, each word picks its lowest rank, and all
leftmost non-overlapping occurrences of that pair are merged; words without a pair leave the array.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import flat

NO_RANK = np.int64(1 << 40)
CACHED_WORDS = 300_000


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    """A byte-level vocabulary file with word ends, lower case and dropped white space."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        letters = byte_letters()
        self.inner = np.array([self.vocab[c] for c in letters], np.int64)
        self.final = np.array([self.vocab[c + self.end] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in merges], np.int64)
        right = np.array([self.vocab[b] for _, b in merges], np.int64)
        made = np.array([self.vocab[a + b] for a, b in merges], np.int64)
        keys = left << 20 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.cache: dict[str, tuple[np.ndarray, str]] = {}

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of many words after all merges; ``word`` is the ascending number of each symbol's word."""
        done_s, done_w = [], []
        while len(symbols):
            at = np.minimum(np.searchsorted(self.keys, symbols[:-1] << 20 | symbols[1:]), len(self.keys) - 1)
            hit = (self.keys[at] == (symbols[:-1] << 20 | symbols[1:])) & (word[:-1] == word[1:])
            rank = np.r_[np.where(hit, self.ranks[at], NO_RANK), NO_RANK]
            starts = flat.first_of_doc(word)
            lengths = np.diff(np.r_[starts, len(word)])
            best = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            live = best < NO_RANK
            done_s.append(symbols[~live])
            done_w.append(word[~live])
            if not live.any():
                break
            chosen = live & (rank == best)
            # In a row of occurrences that overlap (aaa), every second one counts, from the left.
            where = np.flatnonzero(chosen)
            fresh = np.r_[True, np.diff(where) > 1]
            run = where - where[np.maximum.accumulate(np.where(fresh, np.arange(len(where)), 0))] if len(where) else where
            where = where[run % 2 == 0]
            symbols = symbols.copy()
            symbols[where] = self.made[at[where]]
            live[where + 1] = False
            symbols, word = symbols[live], word[live]
        symbols, word = np.concatenate(done_s or [symbols]), np.concatenate(done_w or [word])
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def learn(self, words: list[str]) -> None:
        """Put the ids and the decoded form of ``words`` into the cache."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(r) for r in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.final[data[ends - 1]]
        symbols, word = self.merge(symbols, np.repeat(np.arange(len(words)), lengths))
        cut = np.searchsorted(word, np.arange(len(words) + 1))
        for i, w in enumerate(words):
            ids = symbols[cut[i] : cut[i + 1]]
            self.cache[w] = (ids.astype("<u4"), self.decode(ids))

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens of a text in order."""
        out: list[str] = []
        for part in self.splitter.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(part)
            elif part:
                # Lower case goes by character: a final sigma is not told apart.
                low = unicodedata.normalize("NFC", part)
                low = low.lower() if "Σ" not in low else "".join(c.lower() for c in low)
                out.extend(self.pattern.findall(low))
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """Token ids of each text and what they decode to."""
        split = [self.pieces(t) for t in texts]
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        new = {w for ws in split for w in ws if w not in self.cache}
        for s in new & self.special.keys():
            self.cache[s] = (np.array([self.special[s]], "<u4"), s)
        if new := sorted(new - self.special.keys()):
            self.learn(new)
        for ws in split:
            found = [self.cache[w] for w in ws]
            ids = np.concatenate([f[0] for f in found]) if found else np.zeros(0, "<u4")
            yield ids, " ".join([f[1] for f in found])

    def decode(self, ids) -> str:
        """The tokens of ``ids`` joined by spaces: the vocabulary file names no decoder."""
        return " ".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def encoder(path: str):
    """mapInArrow function: (doc_id, text) to ids and digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path)
        for batch in batches:
            at = 0
            for part in _small(batch.column(1)):
                rows = [(len(ids), ids.tobytes(), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
                        for ids, text in model.encode(part)]
                n, ids, a, b = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(a), pa.array(b)],
                    names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])
                at += len(part)

    return run


def _small(texts: pa.Array) -> Iterator[list[str]]:
    """The texts, null as empty, in lists of about a megabyte."""
    for chunk in flat.chunks(texts):
        yield [t or "" for t in texts.slice(chunk.first, chunk.n).to_pylist()]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids (little-endian unsigned 32-bit), ids_sha256, decoded_sha256`` of every document.

    Null text is empty and has no tokens; ids may be null or repeated, each row is encoded on its own; other
    columns play no part. Special tokens in a text are their own ids, none is added.
    """
    flat.reachable(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(encoder(path), "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string")


def decode_documents(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the text of the binary token ids; null ids give null."""
    flat.reachable(encoded.sparkSession)

    @F.pandas_udf("string")
    def text(ids):
        model = tokenizer(path)
        return ids.map(lambda b: None if b is None else model.decode(np.frombuffer(b, "<u4")))

    return encoded.withColumn("decoded", text(F.col(ids_col)))
