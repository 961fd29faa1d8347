"""Personal data and the terms that give it away, with built-in functions only.

Patterns find e-mail addresses, IP addresses, card and phone numbers; each distinct value is a protected entity.
Other words can reveal an entity because they keep company with it. How strongly is estimated from the corpus: the
pointwise mutual information of term and entity over the information of the entity itself is 1 if the term implies
the entity and 0 if it says nothing. Terms above a first threshold are generalised, above a second removed.

What counts is the number of distinct texts in which term and entity stand together, anywhere in the text outside
personal data, and a term needs ``support`` of them. Copies of a text are no further evidence, nor are near copies: of
the texts with an entity that share most of their three-word shingles one is counted, and the others count nowhere.
Whether two texts are near copies does not depend on how many others there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm import spans as S
from shelfline.llm.columns import Numbered
from shelfline.session import materialize

# The possessive and look-behind forms match what the plain expressions match, leftmost and without overlap, but
# need no backtracking over long runs.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalise", "remove")
TERM = r"[\p{L}\p{N}]+"
SHINGLE = 3  # words
LEAST, BANDS = 6, 20  # two texts meet if the least shingles of one of the bands are equal: 0.2 % missed at a similarity of 0.8


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, F.lit(9)).otherwise(F.lit(0))))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def personal_spans(text: Column) -> Column:
    """Spans of the four kinds, in the order of ``KINDS`` and then of their starts."""
    numeric = F.regexp_like(text, F.lit("[0-9]"))
    email = S.match_spans(text, EMAIL, "email", 0, guard=F.contains(text, F.lit("@")))
    ip = F.filter(S.match_spans(text, IP, "ip", 1, guard=numeric & F.contains(text, F.lit("."))), lambda s: F.forall(
        F.split(s["value"], r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) < 4) & F.forall(
        F.split(s["value"], r"\."), lambda p: F.coalesce(F.substring(F.concat(F.lit("000"), p), -3, 3).cast("int"), F.lit(0)) <= 255))
    card = F.filter(S.match_spans(text, CARD, "card", 2, guard=F.regexp_like(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){15}"))),
                    lambda s: F.length(_digits(s["value"])).between(16, 19) & luhn(_digits(s["value"])))
    phone = F.filter(S.match_spans(text, PHONE, "phone", 3, guard=F.contains(text, F.lit("+"))),
                     lambda s: F.length(_digits(s["value"])).between(8, 15))
    return F.concat(email, ip, card, phone)


def _entity(span: Column) -> Column:
    """One name for all ways to write a value."""
    return F.when(span["kind"] == "email", F.lower(span["value"])).when(span["kind"] == "ip", span["value"]).otherwise(
        F.concat(span["kind"], F.lit(":"), _digits(span["value"])))


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _shingles(words: Column) -> Column:
    last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    return F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)])))


def _bands(shingles: Column) -> Column:
    """One key for each band: the hash of the ``LEAST`` smallest shingles in the order of the band."""
    least = lambda band: F.slice(F.array_sort(F.transform(shingles, lambda x: F.xxhash64(x, band))), 1, LEAST)
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda band: F.xxhash64(band, least(band)))


def evidence(found: DataFrame, support: int) -> tuple[DataFrame, DataFrame]:
    """Stored (entity, text_key, first): the texts of entities in at least ``support`` texts; (text_key, words) of them.

    Of near copies with the same entity only one is ``first``. Entities in the same texts are one, under the name of
    the least of them. ``found``: text_key, text, spans.
    """
    each = found.select("text_key", F.explode(F.array_distinct(F.transform("spans", _entity))).alias("entity"))
    each = materialize(each.distinct(), "pii-entities")
    texts = each.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("text_key")).alias("d1"),
                                       F.bit_xor(F.xxhash64("text_key", F.lit(1))).alias("d2")).where(F.col("n") >= support)
    named = texts.groupBy("n", "d1", "d2").agg(F.min("entity").alias("entity")).select("entity")
    each = materialize(each.join(named, "entity"), "pii-repeated")
    own = found.join(each.select("text_key").distinct(), "text_key", "left_semi")
    masked = S.replaced(F.col("text"), S.by_start(F.col("spans")), lambda s: F.lit(" "))
    own = materialize(own.select("text_key", _terms(masked).alias("words")), "pii-texts")
    near = materialize(own.select("text_key", _shingles(F.col("words")).alias("shingles")), "pii-shingles")
    keys = each.join(near.select("text_key", F.explode(_bands(F.col("shingles"))).alias("band")), "text_key")
    least = keys.groupBy("entity", "band").agg(F.min("text_key").alias("least"))
    first = keys.join(least, ["entity", "band"]).groupBy("entity", "text_key").agg(F.min(F.col("least") == F.col("text_key")).alias("first"))
    return materialize(first, "pii-evidence"), own.select("text_key", F.array_distinct("words").alias("words"))


def companions(first: DataFrame, words: DataFrame, support: int, generalise: float, texts: DataFrame) -> DataFrame:
    """Stored (entity, term, n_both, n_entity, n) that may reach ``generalise``; ``first``: entity, text_key.

    ``texts``: one row, the number n of texts. A term is in no fewer texts than in those with a repeated entity, and
    with the entity in no more than the entity; a pair whose disclosure stays below even so is left out early.
    """
    entities = first.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).where(F.col("n_entity") >= support)
    terms = words.join(first.select("text_key").distinct(), "text_key", "left_semi").select("text_key", F.explode("words").alias("term"))
    terms = terms.where(~F.col("term").rlike("^[0-9]+$") & (F.length("term") > 2))
    around = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n_around")).where(F.col("n_around") >= support)
    terms = materialize(terms.join(around, "term"), "pii-terms")
    held = first.join(entities, "entity").withColumn("n", texts.scalar())
    most = lambda both: disclosure(both, F.col("n_around"), F.col("n_entity"), F.col("n")) >= generalise
    pairs = held.join(terms, "text_key").where(most(F.col("n_entity")))
    pairs = pairs.groupBy("entity", "term", "n_entity", "n_around", "n").agg(F.count(F.lit(1)).alias("n_both"))
    return materialize(pairs.where((F.col("n_both") >= support) & most(F.col("n_both"))), "pii-candidates")


def disclosure(both: Column, term: Column, entity: Column, n: Column) -> Column:
    """Pointwise mutual information of term and entity over the information of the entity, from counts among n."""
    n = F.greatest(n, entity + 1).cast("double")
    term = F.least(F.greatest(term, both).cast("double"), n)
    return F.log(both * n / (term * entity)) / -F.log(entity / n)


def revealing_terms(pairs: DataFrame, spread: DataFrame, generalise: float, remove: float) -> DataFrame:
    """(term, action, disclosure) of the terms that disclose an entity; ``spread``: (term, n_term), texts with the term."""
    scored = pairs.join(spread, "term").withColumn("disclosure", disclosure(F.col("n_both"), F.col("n_term"), F.col("n_entity"), F.col("n")))
    action = F.when(F.max("disclosure") >= remove, F.lit("remove")).otherwise(F.lit("generalise"))
    return scored.where(F.col("disclosure") >= generalise).groupBy("term").agg(action.alias("action"), F.max("disclosure").alias("disclosure"))


def sanitise(docs: DataFrame, support: int = 3, generalise: float = 0.8, remove: float = 0.95, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_spans`` (start, stop, kind, value, by kind and start) and ``_sanitised``, the text without them.

    Personal data become ``[EMAIL]`` and so on, generalised terms ``[TERM]``, removed terms nothing. Null text is
    empty. Equal texts get equal spans, so repeated rows, ties and null ids do no harm, and columns other than the
    text play no part. An empty table gives no rows. Columns may have any names: a new column whose name is taken
    gets one more leading underscore.
    """
    table = Numbered(docs)
    docs, text_col = table.df, table.at(text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.select(text.alias("text"))
    found = plain.withColumn("spans", personal_spans(F.col("text"))).where(F.size("spans") > 0)
    found = materialize(found.withColumn("text_key", F.xxhash64("text")).dropDuplicates(["text_key"]), "pii-found")
    seen, near = evidence(found, support)
    first = seen.where("first").select("entity", "text_key")
    # Texts that are near copies for each of their entities count nowhere.
    copies = materialize(seen.groupBy("text_key").agg(F.max("first").alias("first")).where("not first").select("text_key"), "pii-copies")
    keys = plain.select(F.xxhash64("text").alias("text_key")).distinct()
    texts = keys.join(copies, "text_key", "left_anti").agg(F.count(F.lit(1)))
    pairs = companions(first, near, support, generalise, texts)
    # Of all words of all texts only those are kept that may be revealing.
    outside = F.when(F.size("spans") > 0, S.replaced(F.col("text"), S.by_start(F.col("spans")), lambda s: F.lit(" "))).otherwise(F.col("text"))
    words = plain.withColumn("spans", personal_spans(F.col("text"))).select(
        F.xxhash64("text").alias("text_key"), F.explode(F.array_distinct(_terms(outside))).alias("term"))
    words = materialize(words.join(pairs.select("term").distinct(), "term").distinct(), "pii-words")
    spread = words.join(copies, "text_key", "left_anti").groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    terms = revealing_terms(pairs, spread, generalise, remove)
    carried = words.join(terms, "term").groupBy("text_key").agg(F.collect_set(F.struct("term", "action")).alias("_marked"))
    carried = materialize(carried, "pii-carriers").withColumnRenamed("text_key", "_key")
    out = docs.withColumn("_key", F.xxhash64(text)).join(carried, "_key", "left")

    def marked(action: str, rank: int) -> Column:
        own = F.transform(F.filter(F.coalesce("_marked", F.array().cast("array<struct<term:string,action:string>>")),
                                   lambda m: m["action"] == action), lambda m: m["term"])
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.array_sort(own), "|"), F.lit(r")(?![\p{L}\p{N}])"))
        return S.match_spans(text, pattern, action, rank, guard=F.size(own) > 0)

    every = F.concat(personal_spans(text), *[marked(k, len(KINDS) + i) for i, k in enumerate(TERM_KINDS)])
    out = out.select(*docs.columns, every.alias("_spans"))
    spans = F.col("_spans")
    mark = lambda s: F.when(s["kind"] == "remove", F.lit("")).when(s["kind"] == "generalise", F.lit("[TERM]")).otherwise(
        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    return table.back(out, _spans=spans, _sanitised=S.replaced(text, S.by_start(spans), mark))
