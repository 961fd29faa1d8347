"""Byte-level BPE by merge ranks as recursive DuckDB queries, one database in the memory of each Python worker.

The words of a batch that are not known yet become rows (word, position, token). A recursive query joins neighbouring
tokens with the merge table, contracts the leftmost pair of lowest rank of every word, and goes on with the words
that had one. An ordered aggregation over the tokens' bytes turns ids back into bytes.
"""

from __future__ import annotations

import base64
import hashlib
import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import flat

CACHED_WORDS = 500_000
BATCH_CHARS = 4 << 20
MEMORY = "768MB"

# Rows of the keyed table are replaced when their word is worked on again; -1 stands for a token taken up by its left
# neighbour. Words of up to SHORT bytes contract their leftmost pair of lowest rank in every round; rank, place and width
# of a pair are one number, the least of which is that pair.
SHORT = 48
SHORT_SQL = """
WITH RECURSIVE state(pos, word, id) USING KEY (pos) AS (
    SELECT pos, word, id FROM start
  UNION ALL
    (WITH seen AS (
        SELECT word, pos, id, lead(id) OVER o AS right_id, lead(pos) OVER o AS right_pos, lead(word) OVER o AS right_word
        FROM state WHERE id >= 0 WINDOW o AS (ORDER BY pos)),
     best AS (
        SELECT word, min((made::BIGINT << 40) | (pos::BIGINT << 6) | (right_pos - pos)) AS least
        FROM seen JOIN merges ON left_token = id AND right_token = right_id WHERE word = right_word GROUP BY word),
     pair AS (
        SELECT word, (least >> 40)::INTEGER AS made, ((least >> 6) & ((1::BIGINT << 34) - 1))::INTEGER AS place, (least & 63)::INTEGER AS width FROM best)
     SELECT s.pos, s.word, CASE s.pos WHEN place THEN made WHEN place + width THEN -1 ELSE s.id END
     FROM state s JOIN pair USING (word) WHERE s.id >= 0))
SELECT pos, id FROM state WHERE id >= 0
"""

# Longer words contract all occurrences of their lowest pair in one round, every second one where they overlap. Should
# a contraction yield a pair of a still lower rank (``low`` has those pairs, ``renews`` marks results that do so beside
# their own kind), the word contracts its leftmost occurrence only, and the next round sees the new pair.
LONG_SQL = """
WITH RECURSIVE state(word, pos, id) USING KEY (word, pos) AS (
    SELECT word, pos, id FROM start
  UNION ALL
    SELECT word, pos, next_id FROM (
        WITH seen AS (
            SELECT word, pos, id, lead(id) OVER o AS right_id, lead(id, 2) OVER o AS after_id, lag(id) OVER o AS before_id,
                   row_number() OVER o AS k
            FROM state WHERE id >= 0 WINDOW o AS (PARTITION BY word ORDER BY pos)),
        paired AS (
            SELECT seen.*, made, renews, min(made) OVER (PARTITION BY word) AS best
            FROM seen LEFT JOIN merges ON left_token = id AND right_token = right_id),
        runs AS (
            SELECT *, made IS NOT DISTINCT FROM best AS hit,
                   k - row_number() OVER (PARTITION BY word, made IS NOT DISTINCT FROM best ORDER BY k) AS run
            FROM paired WHERE best IS NOT NULL),
        chosen AS (
            SELECT *, hit AND row_number() OVER (PARTITION BY word, hit, run ORDER BY k) % 2 = 1 AS pick FROM runs),
        weighed AS (
            SELECT c.*, pick AND (c.renews OR coalesce(a.made < best, false) OR coalesce(b.made < best, false)) AS renewing
            FROM chosen c
            LEFT JOIN low a ON pick AND a.left_token = before_id AND a.right_token = c.made
            LEFT JOIN low b ON pick AND b.left_token = c.made AND b.right_token = after_id),
        decided AS (
            SELECT *, pick AND (NOT bool_or(renewing) OVER w OR k = min(CASE WHEN pick THEN k END) OVER w) AS contract
            FROM weighed WINDOW w AS (PARTITION BY word))
        SELECT word, pos, CASE WHEN contract THEN made
                               WHEN lag(contract) OVER (PARTITION BY word ORDER BY k) THEN -1 ELSE id END AS next_id
        FROM decided))
SELECT pos, id FROM state WHERE id >= 0
"""

DECODE_SQL = """
SELECT owner, string_agg(hex, '' ORDER BY place) AS bytes FROM placed JOIN tokens USING (id) GROUP BY owner ORDER BY owner
"""


class RankBpe:
    """A vocabulary of byte strings by rank in a database, and the words encoded so far."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.pattern = regex.compile(pattern)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": os.path.join(tempfile.gettempdir(), f"bpe-{os.getpid()}")})
        rank = self.ranks.get
        parts = [(token[:i], token[i:], made) for token, made in self.ranks.items() for i in range(1, len(token))]
        parts = [(a, b, made) for a, b, made in parts if a in self.ranks and b in self.ranks]
        ids = np.array([(rank(a), rank(b), made) for a, b, made in parts], np.int32).reshape(-1, 3)
        renews = [any(rank(x, made) < made for x in (a + b + a + b, a + b + a, b + a + b)) for a, b, made in parts]
        merges = pa.table({"left_token": ids[:, 0], "right_token": ids[:, 1], "made": ids[:, 2], "renews": renews})
        self.load("merges", merges)
        self.load("low", merges.filter(pa.array((ids[:, 2] < ids[:, 0]) | (ids[:, 2] < ids[:, 1]))))
        self.load("tokens", pa.table({"id": pa.array(list(self.ranks.values()), pa.int32()), "hex": [t.hex() for t in self.ranks]}))
        self.bytes = np.array([rank(bytes([b]), -1) for b in range(256)], np.int32)
        # Two bytes that stand together in no token are never merged across.
        self.together = np.zeros((256, 256), bool)
        for token in self.ranks:
            self.together[list(token[:-1]), list(token[1:])] = True
        self.cache: dict[str, tuple[bytes, bytes]] = {}

    def load(self, name: str, table: pa.Table) -> None:
        self.con.register("incoming", table)
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the words behind each other, and the number of the word each belongs to."""
        lengths = np.array([len(w) for w in words])
        data, word = np.frombuffer(b"".join(words), np.uint8), np.repeat(np.arange(len(words)), lengths)
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int32)
        # A word that is a token stays whole; others fall into stretches with no border that a token could cross.
        fresh = np.r_[True, (word[1:] != word[:-1]) | ~self.together[data[:-1], data[1:]]] if len(data) else np.zeros(0, bool)
        ids = self.bytes[data]
        known = whole[word] >= 0
        starts = np.r_[True, word[1:] != word[:-1]] if len(data) else np.zeros(0, bool)
        ids[known] = whole[word[known]]
        keep = ~known | starts
        ids, fresh, word = ids[keep], (fresh | known)[keep], word[keep]
        stretch = (np.cumsum(fresh) - 1).astype(np.int32)
        size = np.bincount(stretch)[stretch] if len(stretch) else stretch
        place, found = [np.flatnonzero(size == 1)], [ids[size == 1]]
        for query, part in ((SHORT_SQL, (size > 1) & (size <= SHORT)), (LONG_SQL, size > SHORT)):
            if part.any():
                at = np.flatnonzero(part).astype(np.int32)
                self.load("start", pa.table({"word": stretch[at], "pos": at, "id": ids[at]}))
                done = self.con.execute(query).fetchnumpy()
                place.append(done["pos"].astype(np.int64))
                found.append(done["id"].astype(np.int32))
        place, found = np.concatenate(place), np.concatenate(found)
        order = np.argsort(place)
        return found[order], word[place[order]]

    def decode(self, ids: np.ndarray, owner: np.ndarray, n: int) -> list[bytes]:
        """The bytes of the tokens of each of ``n`` owners; ids outside the vocabulary have none."""
        self.load("placed", pa.table({"owner": owner.astype(np.int32), "place": np.arange(len(ids), dtype=np.int32), "id": ids.astype(np.int32)}))
        out = [b""] * n
        for i, text in self.con.execute(DECODE_SQL).fetchall():
            out[i] = bytes.fromhex(text)
        return out

    def learn(self, words: list[str]) -> None:
        """Put ids (little-endian unsigned 32-bit) and decoded bytes of ``words`` into the cache."""
        ids, word = self.merge([w.encode() for w in words])
        decoded = self.decode(ids, word, len(words))
        cut = np.searchsorted(word, np.arange(len(words) + 1))
        raw = ids.astype("<u4")
        for i, w in enumerate(words):
            self.cache[w] = (raw[cut[i] : cut[i + 1]].tobytes(), decoded[i])

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Ids of each text and the bytes they decode to, word by word."""
        split = [self.pattern.findall(t) for t in texts]
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        if new := sorted({w for ws in split for w in ws if w not in self.cache}):
            self.learn(new)
        for ws in split:
            found = [self.cache[w] for w in ws]
            yield b"".join([f[0] for f in found]), b"".join([f[1] for f in found])


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> RankBpe:
    return RankBpe(path, pattern)


def batches_of(texts: pa.Array) -> Iterator[list[str]]:
    """The texts, null as empty, in lists of about ``BATCH_CHARS`` bytes; a longer text stands alone."""
    part, size = [], 0
    for text in texts:
        text = text.as_py() or ""
        if part and size + len(text) > BATCH_CHARS:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def encode_ranked(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids (little-endian unsigned 32-bit), ids_sha256, decoded_sha256`` of every document.

    Every match of ``pattern`` is encoded on its own by the ranks in ``path``; strings of special tokens are ordinary
    text. Null and empty texts have no tokens. Ids may be null or repeated: each row is encoded on its own, equal texts
    alike, whatever other columns are called. Ties do not occur, as ranks are distinct; an empty table gives an empty
    table. Very long texts are read whole; a very long word costs a round of the recursion for each distinct rank that
    it merges.
    """
    flat.reachable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path, pattern)
        for batch in batches:
            at = 0
            for part in batches_of(batch.column(1)):
                rows = [(len(ids) // 4, ids, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()) for ids, text in model.encode(part)]
                n, ids, a, b = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(a), pa.array(b)],
                    names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])
                at += len(part)

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(run, "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string")


def decode_ranked(encoded: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of the binary token ids by ordered aggregation; null ids give null."""
    flat.reachable(encoded.sparkSession)

    @F.pandas_udf("binary")
    def text(ids):
        model = tokenizer(path, pattern)
        arrays = [np.frombuffer(b or b"", "<u4") for b in ids]
        owner = np.repeat(np.arange(len(arrays)), [len(a) for a in arrays])
        decoded = model.decode(np.concatenate(arrays) if arrays else owner, owner, len(arrays))
        return pd.Series([None if b is None else d for b, d in zip(ids, decoded)], dtype=object)

    return encoded.withColumn("decoded", text(F.col(ids_col)))
