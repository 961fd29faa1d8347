"""Spelling variants: words one inserted, deleted or replaced letter apart, led to their most frequent form.

The vocabulary is dealt out so that a word meets, for each half of it, the words that share this half exactly; each part
becomes a bidirectional FM-index in one task, in which its words are searched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm import flat
from shelfline.llm.fm_index import LETTER, BidirectionalIndex
from shelfline.session import materialize

RUN = "[A-Za-z\\u00C0-\\u00FF]"
LEAST_LENGTH = 5
LEAST_COUNT = 3
TYPO = 97
# Symbols, delimiters included, of the words that one index is meant for.
SYMBOLS = 1 << 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: the words of ``docs`` by how often they occur, with the letter lost that ``variants`` describes."""
    runs = F.regexp_extract_all(F.translate(text_col, UPPER, LOWER), F.lit(f"({RUN}{{{LEAST_LENGTH},}})"), F.lit(1))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    gone = F.col("h") % F.length("run")
    cut = F.concat(F.substring("run", F.lit(1), gone.cast("int")), F.substring("run", (gone + 2).cast("int"), F.length("run")))
    words = rows.select(F.when(F.col("h") % TYPO == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def dealt(words: DataFrame) -> DataFrame:
    """``words`` once for each part of the index they belong to: ``side, cut, shard, rows, cols, word, n, asks, stands``.

    A word of length L asks in the group (side, L, its half on that side); it stands in the groups of the lengths one
    less, equal and one more. Groups are packed into shards of about ``SYMBOLS`` symbols; a group that is larger is cut
    into parts of the asking words times parts of the others, so that no task gets it whole.
    """
    length = F.length("word")
    places = F.array(*[F.struct(F.lit(side).alias("side"), (length + d).alias("length")) for side in ("first", "last") for d in (-1, 0, 1)])
    rows = words.select("word", "n", F.explode(places).alias("p")).select("word", "n", "p.side", F.col("p.length").alias("length"))
    half = F.floor(F.col("length") / 2).cast("int")
    key = F.when(F.col("side") == "first", F.substring("word", F.lit(1), half)).otherwise(F.expr("right(word, length - floor(length / 2))"))
    rows = rows.where(f"length >= {LEAST_LENGTH}").withColumns({"key": key, "asks": F.col("length") == length})
    group = ["side", "length", "key"]
    sizes = materialize(rows.groupBy(group).agg(F.sum(length + 1).alias("symbols")), "variant-groups")
    shards = F.lit(max(1, (sizes.agg(F.sum("symbols")).first()[0] or 0) // SYMBOLS)).cast("long")
    parts = F.ceil(F.col("symbols") / SYMBOLS).cast("int").alias("parts")
    rows = rows.join(sizes.where(f"symbols > {SYMBOLS}").select(*group, parts), group, "left")
    place = F.xxhash64(*group)
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    # Tiles (asking part, other part): a word stands in its own column of tiles, and asks along its own row.
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    tiles = F.transform(every, lambda a: F.struct(a.alias("rows"), own.alias("cols"), F.lit(False).alias("asks"), F.lit(True).alias("stands")))
    asking = F.transform(every, lambda b: F.struct(own.alias("rows"), b.alias("cols"), F.lit(True).alias("asks"), F.lit(False).alias("stands")))
    none = F.slice(asking, 1, 0)
    whole = F.array(F.struct(F.lit(0).alias("rows"), F.lit(0).alias("cols"), F.col("asks").alias("asks"), F.lit(True).alias("stands")))
    tile = F.when(F.col("parts").isNull(), whole).otherwise(F.concat(tiles, F.when(F.col("asks"), asking).otherwise(none)))
    shard = F.when(F.col("parts").isNull(), F.pmod(place, shards)).otherwise(place)
    cut = F.coalesce("parts", F.lit(0))
    return rows.select("side", cut.alias("cut"), shard.alias("shard"), "word", "n", F.explode(tile).alias("t")).select(
        "side", "cut", "shard", "t.rows", "t.cols", "word", "n", "t.asks", "t.stands")


PART = ["side", "cut", "shard", "rows", "cols"]
FOUND = "word string, near long, best_n long, best string"


def search(table: pa.Table) -> pa.Table:
    """Per asking word of a part: how many of the words that stand there are near it, and the most frequent of them."""
    last = table.column("side")[0].as_py() == "last"
    words, n = table.column("word").to_pylist(), table.column("n").to_pylist()
    asks, stands = table.column("asks").to_pylist(), table.column("stands").to_pylist()
    count = {w: c for w, c, s in zip(words, n, stands) if s}
    listed, asking = sorted(count), sorted({w for w, a in zip(words, asks) if a})
    if not listed or not asking:
        return pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.int64()), "best_n": pa.array([], pa.int64()), "best": pa.array([], pa.string())})
    code = lambda ws: np.frombuffer("".join(ws).encode("utf-32-le"), np.uint32)
    letters = np.unique(np.r_[code(listed), code(asking)])
    symbols = np.searchsorted(letters, code(listed)) + LETTER
    index = BidirectionalIndex(np.split(symbols, np.cumsum([len(w) for w in listed])[:-1]), len(letters) + LETTER)
    counts = np.array([count[w] for w in listed])
    by_length: dict[int, list[str]] = {}
    for w in asking:
        by_length.setdefault(len(w), []).append(w)
    out: list[tuple] = []
    for length, group in by_length.items():
        queries, half = (np.searchsorted(letters, code(group)) + LETTER).reshape(-1, length), length // 2
        if last:
            query, word = index.reversed().half_exact(queries[:, ::-1], length - half)
            new = ~index.begins_alike(word, queries[query], half)  # the others are found by the first half
            query, word = query[new], word[new]
        else:
            query, word = index.half_exact(queries, half)
        order = np.lexsort((word, -counts[word], query))
        query, word = query[order], word[order]
        first = flat.first_of_doc(query)
        near = np.diff(np.r_[first, len(query)])
        out += [(group[q], int(k), int(counts[w]), listed[w]) for q, k, w in zip(query[first], near, word[first])]
    columns = list(zip(*out)) or [(), (), (), ()]
    return pa.table({"word": pa.array(columns[0], pa.string()), "near": pa.array(columns[1], pa.int64()),
                     "best_n": pa.array(columns[2], pa.int64()), "best": pa.array(columns[3], pa.string())})


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for the links ``word, form``: the last form that following the links leads to.

    Every round doubles the links that are followed. A form is at least twice as frequent as its word, so a chain is
    no longer than the logarithm of the largest count, and the rounds than its logarithm.
    """
    links = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        onward = links.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        links = links.join(onward, F.col("root") == F.col("_at"), "left")
        links = materialize(links.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "variant-roots")
        if not links.where("moved").limit(1).count():
            return links.select("word", "root")
        links = links.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words of ``docs``.

    Words are the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, only A-Z lower-cased. Where the unsigned CRC-32 of
    ``<id>:<run>`` is divisible by 97, the run loses its code point at that number modulo its length. Words of at least
    5 code points that occur at least 3 times count. Two words are near if one code point is inserted, deleted or
    replaced. The form of a word is its most frequent near word (ties: the smallest in code-point order) if that is at
    least twice as frequent, else null; ``root`` is where forms lead in the end, the word itself if it has none.

    Null and empty texts have no words; a null id counts as empty, and repeated rows count again. Other columns play
    no part, whatever their names. An empty table gives an empty table. Very long texts are read whole; an index holds
    words of ``SYMBOLS`` symbols, or one longer word.
    """
    flat.reachable(docs.sparkSession)
    words = materialize(vocabulary(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))), "variant-words")
    found = dealt(words).groupBy(PART).applyInArrow(search, FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    found = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    joined = words.join(found, "word", "left")
    leads: Column = -F.col("best.n") >= 2 * F.col("n")
    table = materialize(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                      F.when(leads, F.col("best.word")).alias("form"), F.when(leads, -F.col("best.n")).alias("form_n")), "variant-forms")
    table = table.join(roots(table.where("form is not null")), "word", "left")
    return table.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
