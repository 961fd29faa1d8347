"""Token counts from two compiled finite-state transducers.

The splitter reads character classes and marks where the tokenizer's pre-tokens begin. It has a dozen states, so a
chunk of text is a map from the state before it to the state after it. The maps of all chunks of a batch are
computed side by side, composed by a parallel prefix scan, and the transitions replayed from the states so found.

The counter reads the bytes of a pre-token; every transition carries how many tokens the byte adds to the BPE of
what has been read (it may be negative, when a merge closes). Its states are compiled on demand. They rest on a
property of BPE: a prefix has exactly one sequence of tokens in which every neighbouring pair would also come out
of encoding the two alone. So the last token of a prefix decides, for every place where a token may still be open,
what the next byte leads to. A state is the set of open places: the vocabulary trie node reached since, the last
token before, and the token count there relative to now.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import flat
from shelfline.llm.bpe import byte_letters

# Character classes of the splitter.
(OTHER, LETTER, LET_S, LET_R, LET_E, LET_V, LET_L, NUMBER, QUOTE, BLANK, SPACE, RESET) = range(12)
CLASSES = 12
# States: what has been read last. APOS: an apostrophe that begins a pre-token; R, V, L: a letter after that.
(BEGIN, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AT_BLANK, AT_SPACE, APOS, APOS_R, APOS_V, APOS_L, CLOSED) = range(11)
STATES = 11
CUT_HERE, CUT_BEFORE = 1, 2  # a pre-token begins at this character, at the one before it
SPAN = 64
STATE_LIMIT = 60_000  # compiled states kept by a worker
WORD_LIMIT = 500_000  # counted pre-tokens kept by a worker


@lru_cache(maxsize=1)
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, cuts) by state and class.

    The pre-tokens are: 's 't 're 've 'm 'll 'd where an apostrophe begins one; runs of letters, of numbers or of
    other characters, with one blank before; white space up to the last one before something else.
    """
    to, cuts = np.zeros((STATES, CLASSES), np.int64), np.zeros((STATES, CLASSES), np.uint8)
    letters = (LETTER, LET_S, LET_R, LET_E, LET_V, LET_L)

    def fresh(c: int) -> int:
        """State after a character that begins a pre-token."""
        if c in letters:
            return IN_LETTERS
        return {NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: APOS, BLANK: AT_BLANK, SPACE: AT_SPACE}[c]

    inside = {IN_LETTERS: letters, IN_NUMBERS: (NUMBER,), IN_OTHERS: (OTHER, QUOTE)}
    for s in range(STATES):
        for c in range(CLASSES - 1):
            go, cut = fresh(c), CUT_HERE
            if s in inside and c in inside[s]:
                go, cut = s, 0
            elif s in (AT_BLANK, AT_SPACE):
                if c in (BLANK, SPACE):
                    cut = 0
                elif s == AT_BLANK:  # the blank belongs to what follows
                    go, cut = (IN_OTHERS if c == QUOTE else go), CUT_BEFORE
                else:
                    cut = CUT_HERE | CUT_BEFORE
            elif s == APOS:
                if c == LET_S:
                    go, cut = CLOSED, 0
                elif c in (LET_R, LET_V, LET_L):
                    go, cut = {LET_R: APOS_R, LET_V: APOS_V, LET_L: APOS_L}[c], 0
                elif c in (OTHER, QUOTE):
                    go, cut = IN_OTHERS, 0
            elif s in (APOS_R, APOS_V, APOS_L):
                if c == (LET_L if s == APOS_L else LET_E):
                    go, cut = CLOSED, 0
                elif c in letters:  # no contraction: the letters began before this one
                    go, cut = IN_LETTERS, CUT_BEFORE
                else:
                    cut = CUT_HERE | CUT_BEFORE
            to[s, c], cuts[s, c] = go, cut
        to[s, RESET] = BEGIN
        cuts[s, RESET] = CUT_BEFORE if s in (APOS_R, APOS_V, APOS_L) else 0
    return to, cuts


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = NUMBER
    # White_Space of Unicode
    table[[*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    table[32] = BLANK
    table[ord("'")] = QUOTE
    table[[ord(c) for c in "stmd"]] = LET_S
    for letter, c in zip("revl", (LET_R, LET_E, LET_V, LET_L)):
        table[ord(letter)] = c
    return table


def scan_states(classes: np.ndarray) -> np.ndarray:
    """State before every character, by composing the state maps of chunks."""
    to, _ = splitter()
    n = -(-len(classes) // SPAN)
    grid = np.full(n * SPAN, RESET, np.uint8)
    grid[: len(classes)] = classes
    grid = grid.reshape(n, SPAN)
    maps = np.tile(np.arange(STATES), (n, 1))
    for k in range(SPAN):
        maps = to[maps, grid[:, k][:, None]]
    reach = 1
    while reach < n:  # inclusive scan: each map composed with the one `reach` before it
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], axis=1)
        reach *= 2
    state = np.r_[BEGIN, maps[:-1, BEGIN]] if n else np.zeros(0, np.int64)
    out = np.empty((n, SPAN), np.uint8)
    for k in range(SPAN):
        out[:, k] = state
        state = to[state, grid[:, k]]
    return out.ravel()[: len(classes)]


def cut_positions(classes: np.ndarray) -> np.ndarray:
    """Which characters begin a pre-token; RESET stands between segments and begins none."""
    _, cuts = splitter()
    said = cuts[scan_states(classes), classes]
    begins = (said & CUT_HERE) > 0
    begins[:-1] |= (said[1:] & CUT_BEFORE) > 0
    return begins


class Counter:
    """The byte transducer of a vocabulary file, compiled on demand."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        letters = {c: b for b, c in enumerate(byte_letters())}
        raw = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token: rank of its merge, left, right
        for r, (a, b) in enumerate(merges):
            x, y, z = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            self.rank[x, y] = r
            self.parts[z] = (r, x, y)
        self.child: dict[tuple[int, int], int] = {}
        self.token: dict[int, int] = {}
        nodes = 1
        for i, b in raw.items():
            if len(b) > 1 and i not in self.parts:
                continue  # cannot come out of merges
            node = 0
            for byte in b:
                nxt = self.child.get((node, byte))
                if nxt is None:
                    nxt = self.child[node, byte] = nodes
                    nodes += 1
                node = nxt
            self.token[node] = i
        self.inner = {node for node, _ in self.child}  # where a token may still go on
        self.joined: dict[tuple[int, int], bool] = {}
        self._spines: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        self.words: dict[int, int] = {}
        self.forget()

    def forget(self) -> None:
        """Begin with the start state only."""
        self.index: dict[tuple, int] = {((0, -1, 0),): 0}
        self.states: list[tuple] = [((0, -1, 0),)]
        self.to = np.full((1024, 256), -1, np.int32)
        self.adds = np.zeros((1024, 256), np.int16)

    def spine(self, token: int, right: bool) -> list[tuple[int, int]]:
        """(symbol, rank of the merge that consumes it) along one edge of a token, from its byte upwards."""
        found = self._spines.get((token, right))
        if found is None:
            found, above, at = [], 1 << 60, token
            while True:
                found.append((at, above))
                if at not in self.parts:
                    break
                above, a, b = self.parts[at]
                at = b if right else a
            found.reverse()
            self._spines[token, right] = found
        return found

    def stays(self, a: int, b: int) -> bool:
        """Does BPE keep the tokens ``a`` and ``b`` apart when they stand side by side?

        It does unless a merge across the border comes before one of its two symbols is merged inside its token;
        of equal ranks the left one goes first.
        """
        known = self.joined.get((a, b))
        if known is None:
            left, right, i, j, known = self.spine(a, True), self.spine(b, False), 0, 0, True
            while True:
                (x, x_ends), (y, y_ends) = left[i], right[j]
                rank = self.rank.get((x, y))
                if rank is not None and rank < x_ends and rank <= y_ends:
                    known = False
                    break
                if x_ends == y_ends == 1 << 60:
                    break
                if x_ends <= y_ends:
                    i += 1
                else:
                    j += 1
            self.joined[a, b] = known
        return known

    def compile(self, state: int, byte: int) -> None:
        """Add one transition."""
        kept, last, count = [], None, 0
        for node, before, lead in self.states[state]:
            node = self.child.get((node, byte))
            if node is None:
                continue
            kept.append((node, before, lead))
            token = self.token.get(node)
            if last is None and token is not None and (before < 0 or self.stays(before, token)):
                last, count = token, lead + 1
        key = tuple((n, b, c - count) for n, b, c in kept if n in self.inner) + ((0, last, 0),)
        target = self.index.get(key)
        if target is None:
            target = self.index[key] = len(self.states)
            self.states.append(key)
            if target >= len(self.to):
                self.to = np.concatenate([self.to, np.full_like(self.to, -1)])
                self.adds = np.concatenate([self.adds, np.zeros_like(self.adds)])
        self.to[state, byte], self.adds[state, byte] = target, count

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each byte range, all ranges in step, longest first."""
        if len(self.states) > STATE_LIMIT:
            self.forget()
        order = np.argsort(starts - ends, kind="stable")
        s, length = starts[order], (ends - starts)[order]
        state, total = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
        live = len(s)
        for k in range(int(length[0]) if len(s) else 0):
            live = int(np.searchsorted(-length[:live], -k, side="left"))
            at, byte = state[:live], data[s[:live] + k]
            go = self.to[at, byte]
            if (go < 0).any():
                missing = np.unique(at[go < 0] * 256 + byte[go < 0])
                for m in missing.tolist():
                    self.compile(m >> 8, m & 255)
                go = self.to[at, byte]
            total[:live] += self.adds[at, byte]
            state[:live] = go
        out = np.empty(len(s), np.int64)
        out[order] = total
        return out

    def count_texts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of every text; a special token inside a text is one."""
        n = len(texts)
        counts = np.zeros(n, np.int64)
        for special in self.special:
            counts += pc.count_substring(texts, special).to_numpy(zero_copy_only=False)
        # Segments end at a special token and at the end of a text; a NUL after each marks the place.
        marked = texts
        for special in self.special:
            if counts.any():
                marked = pc.replace_substring(marked, special, "\ufdd0")
        text = "\ufdd1".join(marked.to_pylist()) + "\ufdd1"
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        classes = class_table()[code]
        ends_text = code == 0xFDD1
        if int(ends_text.sum()) != n or (counts.sum() != int((code == 0xFDD0).sum())):
            return self._one_by_one(texts)  # a text has one of the two noncharacters itself
        classes[ends_text | (code == 0xFDD0)] = RESET
        begins = cut_positions(classes)
        data = np.frombuffer(text.encode(), np.uint8)
        width = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
        at = np.zeros(len(code) + 1, np.int64)
        np.cumsum(width, out=at[1:])
        # A pre-token ends where the next one or a mark begins.
        edge = np.flatnonzero(begins | (classes == RESET))
        first = begins[edge]
        starts = at[edge[first]]
        ends = at[np.r_[edge[1:], len(code)][first]]
        owner = np.searchsorted(np.flatnonzero(ends_text), edge[first])
        hashes = flat.range_hashes(data, starts, ends)
        keys, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.words) > WORD_LIMIT:
            self.words.clear()
        known = np.fromiter((self.words.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        new = known < 0
        known[new] = self.count(data, starts[where[new]], ends[where[new]])
        self.words.update(zip(keys[new].tolist(), known[new].tolist()))
        return counts + np.bincount(owner, weights=known[back], minlength=n).astype(np.int64)

    def _one_by_one(self, texts: pa.Array) -> np.ndarray:
        """Counts without marks, for texts that hold the marking characters themselves."""
        out = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts.to_pylist()):
            pieces = [text]
            for special in self.special:
                pieces = [p for piece in pieces for p in piece.split(special)]
                out[i] += text.count(special)
            for piece in pieces:
                code = np.frombuffer(piece.encode("utf-32-le"), np.uint32)
                if not len(code):
                    continue
                begins = np.flatnonzero(cut_positions(np.r_[class_table()[code], np.uint8(RESET)])[:-1])
                data = np.frombuffer(piece.encode(), np.uint8)
                at = np.r_[0, np.cumsum(1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF))]
                out[i] += self.count(data, at[begins], np.r_[at[begins[1:]], len(data)]).sum()
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def counting(path: str):
    """mapInArrow function: (doc_id, text) to bytes and tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(path)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for chunk in flat.chunks(texts):
                part = texts.slice(chunk.first, chunk.n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.n), pa.array(np.diff(chunk.bounds).astype(np.int64)),
                     pa.array(model.count_texts(part))], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document.

    Null text is empty and has no tokens; ids may be null or repeated, each row is counted on its own; other
    columns play no part. Pre-tokens are told apart by 64-bit hashes when their counts are reused.
    """
    flat.reachable(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = base.mapInArrow(counting(path), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
