"""Quality rules: repetition counts and distribution divergence from language references.

Three histograms of a document, the classes of its characters, the classes of the first characters of its words and
its common words, are compared with the reference of its language by Jensen-Shannon distance (square root of the
divergence in bits). The references are the same histograms over all documents of the language; documents of other
languages share one reference, without common words. A histogram is judged only if the document has enough
characters or words for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import flat

# Common words of each language.
COMMON: dict[str, tuple[str, ...]] = {
    "de": ("als", "auch", "auf", "aus", "das", "dem", "den", "der", "des", "die", "ein", "eine", "er", "es", "für", "im", "in",
           "ist", "mit", "nicht", "sich", "sie", "und", "von", "zu"),
    "en": ("a", "and", "are", "as", "at", "be", "by", "for", "from", "he", "in", "is", "it", "of", "on", "or", "that", "the", "this",
           "to", "was", "what", "which", "with", "you"),
    "es": ("al", "como", "con", "de", "del", "el", "en", "es", "la", "las", "lo", "los", "no", "para", "por", "que", "se", "son",
           "su", "un", "una", "y"),
    "fr": ("au", "avec", "dans", "de", "des", "du", "elle", "en", "est", "et", "la", "le", "les", "ne", "par", "pas", "pour", "que",
           "qui", "sur", "un", "une"),
}
LANGS = [*COMMON, ""]  # the last stands for all others and null
WORD_BINS = 1 + max(map(len, COMMON.values()))  # the last bin is every other word
# Character classes: lower case, upper case, digit, sentence marks, other marks, white space, beyond ASCII.
CLASS_BINS = 7
PARTS = {"class": slice(0, CLASS_BINS), "initial": slice(CLASS_BINS, 2 * CLASS_BINS), "word": slice(2 * CLASS_BINS, 2 * CLASS_BINS + WORD_BINS)}
WIDTH = 2 * CLASS_BINS + WORD_BINS
_CLASS = np.full(256, 4, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:256] = 0, 1, 2, 6
_CLASS[[ord(c) for c in ".,;:!?'\"-()"]] = 3
_CLASS[flat.SPACE] = 5
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_WORDY = np.zeros(256, bool)
_WORDY[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
WINDOW = 5
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _common_tables() -> list[tuple[np.ndarray, np.ndarray]]:
    """For each language the sorted hashes of its common words and the bin of each."""
    out = []
    for lang in LANGS:
        words = COMMON.get(lang, ())
        raw = [w.encode() for w in words]
        ends = np.cumsum([len(r) for r in raw]).astype(np.int64)
        starts = ends - np.array([len(r) for r in raw], np.int64)
        hashes = flat.range_hashes(np.frombuffer(b"".join(raw), np.uint8), starts, ends)
        order = np.argsort(hashes)
        out.append((hashes[order], order))
    return out


def statistics(chunk: flat.Chunk) -> dict[str, np.ndarray]:
    """The counts in ``STATS`` for every document of a chunk."""
    data, n = chunk.data, chunk.n
    inside = ~flat.SPACE[data]
    starts, ends = flat.runs(inside, chunk.bounds)
    docs, hashes = flat.doc_of(starts, chunk.bounds), flat.range_hashes(data, starts, ends)
    # Lines: maximal stretches without \n; only those with a word count.
    ls, le = flat.runs(data != 10, chunk.bounds)
    words_before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=words_before[1:])
    worded = words_before[le] > words_before[ls]
    ls, le = ls[worded], le[worded]
    line_doc = flat.doc_of(ls, chunk.bounds)
    line = flat.mix(flat.range_hashes(data, ls, le) + line_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(line, return_index=True)
    # Words in windows that occur twice.
    grams, owner = flat.ngrams(hashes, docs, WINDOW)
    keyed = flat.mix(grams + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, back, times = np.unique(keyed, return_inverse=True, return_counts=True)
    heads = np.flatnonzero(docs[: len(docs) - WINDOW + 1] == docs[WINDOW - 1 :]) if len(docs) >= WINDOW else np.zeros(0, np.int64)
    again = heads[times[back] > 1] if len(heads) else heads
    cover = np.zeros(len(docs) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    repeated = np.cumsum(cover[:-1]) > 0
    return {
        "n_words": np.bincount(docs, minlength=n), "word_chars": chunk.per_doc(inside & flat.LEAD[data]),
        "n_symbols": chunk.per_doc(_SYMBOL[data]),
        "n_dup_lines": np.bincount(line_doc, minlength=n) - np.bincount(line_doc[first], minlength=n),
        "n_repeat_words": np.bincount(docs[repeated], minlength=n),
    }


def histograms(chunk: flat.Chunk, lang: np.ndarray) -> np.ndarray:
    """The histograms of every document side by side; ``lang`` is the place of its language in ``LANGS``."""
    owner = np.repeat(np.arange(chunk.n), np.diff(chunk.bounds))
    lead = flat.LEAD[chunk.data]
    cell = owner[lead] * CLASS_BINS + _CLASS[chunk.data[lead]]
    classes = np.bincount(cell, minlength=chunk.n * CLASS_BINS).reshape(chunk.n, CLASS_BINS)
    starts, _ = flat.runs(~flat.SPACE[chunk.data], chunk.bounds)
    cell = flat.doc_of(starts, chunk.bounds) * CLASS_BINS + _CLASS[chunk.data[starts]]
    initials = np.bincount(cell, minlength=chunk.n * CLASS_BINS).reshape(chunk.n, CLASS_BINS)
    data = flat.LOWER[chunk.data]
    starts, ends = flat.runs(_WORDY[data], chunk.bounds)
    docs, hashes = flat.doc_of(starts, chunk.bounds), flat.range_hashes(data, starts, ends)
    place = np.full(len(docs), WORD_BINS - 1)
    for i, (known, bins) in enumerate(_common_tables()):
        mine = np.flatnonzero(lang[docs] == i)
        if len(known) and len(mine):
            at = np.minimum(np.searchsorted(known, hashes[mine]), len(known) - 1)
            hit = known[at] == hashes[mine]
            place[mine[hit]] = bins[at[hit]]
    words = np.bincount(docs * WORD_BINS + place, minlength=chunk.n * WORD_BINS).reshape(chunk.n, WORD_BINS)
    return np.hstack([classes, initials, words])


def _lang_index(column: pa.Array) -> np.ndarray:
    known = {x: i for i, x in enumerate(LANGS)}
    return np.array([known.get(x, len(LANGS) - 1) for x in column.to_pylist()], np.int64)


def count_references(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: (lang, text) to one row (lang, bin, n) per language and bin in a task."""
    total = np.zeros((len(LANGS), WIDTH), np.int64)
    for batch in batches:
        lang = _lang_index(batch.column(0))
        for chunk in flat.chunks(batch.column(1)):
            own = lang[chunk.first : chunk.first + chunk.n]
            np.add.at(total, own, histograms(chunk, own))
    i, j = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["lang", "bin", "n"])


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of every row of counts from its reference row; rows without counts are at 0."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    q = reference / np.maximum(reference.sum(axis=1, keepdims=True), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        part = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    out = np.sqrt(np.maximum(part.sum(axis=1) / 2, 0))
    return np.where((counts.sum(axis=1) > 0) & (reference.sum(axis=1) > 0), out, 0.0)


def judge(reference: np.ndarray, limits: dict[str, float], least: dict[str, int]):
    """mapInArrow function: (doc_id, lang, text) to the counts, distances and verdicts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = _lang_index(batch.column(1))
            for chunk in flat.chunks(batch.column(2)):
                own = lang[chunk.first : chunk.first + chunk.n]
                stats, counts = statistics(chunk), histograms(chunk, own)
                far, strange = {}, np.zeros(chunk.n, bool)
                for name, part in PARTS.items():
                    far[name] = distance(counts[:, part], reference[own, part])
                    judged = counts[:, part].sum(axis=1) >= least[name]
                    if name == "word":
                        judged &= own < len(LANGS) - 1
                    strange |= judged & (far[name] > limits[name])
                failed = (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.n), *[pa.array(stats[s].astype(np.int64)) for s in STATS],
                     *[pa.array(far[name]) for name in PARTS], pa.array(failed), pa.array(~failed & ~strange)],
                    names=["doc_id", *STATS, *[f"{name}_distance" for name in PARTS], "base_failed", "kept"])

    return run


# Largest distance and least number of characters or words for a verdict.
LIMITS = {"class": 0.30, "initial": 0.35, "word": 0.55}
LEAST = {"class": 150, "initial": 30, "word": 60}


def quality_rules(docs: DataFrame, limits: dict[str, float] = LIMITS, least: dict[str, int] = LEAST,
                  id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: ``doc_id``, the counts of ``STATS``, the distances of ``PARTS``, ``base_failed, kept``.

    ``base_failed``: fewer than 10 words, or more than 20 % of them in repeated five-word windows. ``kept``: not that,
    and no histogram that is long enough is farther from its reference than allowed. Null text is empty and fails.
    Null or unknown languages share one reference. Ids may be null or repeated; each row is judged on its own. An
    empty table gives no rows. Lines and windows are compared by 64-bit hashes.
    """
    flat.reachable(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counted = base.select("lang", "text").mapInArrow(count_references, "lang long, bin long, n long")
    reference = np.zeros((len(LANGS), WIDTH))
    for row in counted.groupBy("lang", "bin").agg(F.sum("n")).collect():  # a few hundred rows, whatever the input
        reference[row[0], row[1]] = row[2]
    schema = ", ".join(["doc_id long", *[f"{s} long" for s in STATS], *[f"{p}_distance double" for p in PARTS],
                        "base_failed boolean", "kept boolean"])
    return base.mapInArrow(judge(reference, limits, least), schema)
