"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words. A document is expected ``target / source size`` times (its preference may
shift that inside the source): the whole part is given to it for certain, the rest is its inclusion probability p.
Documents are ranked by u / (1 - u) over p / (1 - p), u being uniform and a function of seed and id only, and taken
in that order until the words of the sample have the fixed size. One closing document, the one that fits the
remaining gap best, brings the source as near to its target as whole documents can. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.llm.columns import Numbered
from shelfline.llm.cuts import prefix_cut, within
from shelfline.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
TIES = ["_id", "_tie"]


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters that are not ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: str, *ids: Column) -> Column:
    """Number strictly between 0 and 1 from an MD5 of seed and ids, the same in every engine that has MD5."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(i.cast("string"), F.lit("")) for i in ids])
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_copies: int) -> DataFrame:
    """Targets per source; ``sizes``: one row (source, source_size) per source.

    Sources in code point order, null last, take the weights in turn. Targets are proportional to the weights and
    add up to ``share`` of all words, but stop at ``max_copies`` times the source; the excess goes to the others by
    weight. The water level is found in one pass: sources are sorted by the level at which they fill up. The
    windows run over one row per source.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").isNull(), "source"))
    table = F.array(*[F.lit(float(w)) for w in weights])
    out = sizes.withColumn("_rank", rank).withColumn("weight", F.element_at(table, ((F.col("_rank") - 1) % len(weights) + 1).cast("int")))
    out = out.withColumn("_cap", F.col("source_size").cast("double") * max_copies)
    before = W.orderBy(F.col("_cap") / F.col("weight"), "_rank").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    words = F.sum("source_size").over(whole).cast("double") * share
    level = (words - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    out = out.withColumn("_level", level).withColumn("_full", F.col("_cap") / F.col("weight") <= F.col("_level"))
    out = out.withColumn("_open", F.min(F.when(~F.col("_full"), F.struct(F.col("_cap") / F.col("weight"), "_rank", "_level"))).over(whole))
    target = F.when(F.col("_full") | F.col("_open").isNull(), F.col("_cap")).otherwise(F.col("weight") * F.col("_open")["_level"])
    return out.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_copies: int = 2, seed: str = "mix",
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", preference: str | None = None) -> DataFrame:
    """``docs`` with ``_copies`` (how often the mix takes the document), ``_size``, ``_source_size`` and ``_target``.

    ``preference`` names a column with positive factors that make a document more or less likely than its source
    as a whole (null: 1). Null text has no words; documents without words are never taken, as they add nothing.
    A null id draws as an empty id; rows that repeat id and text draw alike and are taken or left together.
    Null is a source of its own. An empty table, or one without words, gives targets of 0. Columns of ``docs`` may
    have any names: a new column whose name is taken gets one more leading underscore.
    """
    table = Numbered(docs)
    docs, id_col, text_col, source_col = table.df, table.at(id_col), table.at(text_col), table.at(source_col)
    preference = table.at(preference) if preference else None
    source = F.col(source_col)
    # Sources are compared through a key that is never null: joins then need no null-safe equality.
    key = F.coalesce(F.concat(F.lit("="), source), F.lit("0"))
    like = F.coalesce(F.col(preference).cast("double"), F.lit(1.0)) if preference else F.lit(1.0)
    own = {"_key": key, "_id": F.col(id_col), "_tie": F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))),
           "_size": word_count(F.col(text_col)), "_like": like, "_u": uniform(seed, F.col(id_col))}
    # Ids, sizes and draws are stored once; the texts are read again only for the result.
    narrow = materialize(docs.select(*[c.alias(n) for n, c in own.items()], source.alias("source")), "mix-rows")
    totals = narrow.groupBy("_key").agg(F.first("source").alias("source"), F.sum("_size").alias("source_size"),
                                        F.sum(F.col("_size") * F.col("_like")).alias("_liked"))
    planned = source_targets(totals.select("source", "source_size"), weights, share, max_copies)
    planned = planned.withColumn("_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("0"))).drop("source")
    plan = planned.join(totals.select("_key", "_liked"), "_key").withColumn("_rate", F.coalesce(F.try_divide("target", "_liked"), F.lit(0.0)))
    plan = materialize(plan, "mix-plan")

    expected = F.least(F.col("_rate") * F.col("_like"), F.lit(float(max_copies)))
    certain = F.floor(expected)
    p = expected - certain
    odds = (F.col("_u") / (1 - F.col("_u"))) / (p / (1 - p))
    drawn = narrow.join(plan.select("_key", "_rate"), "_key").withColumn("_certain", certain)
    drawn = drawn.withColumn("_q", F.when((p > 0) & (F.col("_size") > 0), F.log(odds)))
    given = drawn.groupBy("_key").agg(F.sum(F.col("_certain") * F.col("_size")).alias("_given"))
    budgets = plan.join(given, "_key").select("_key", (F.col("target") - F.col("_given")).alias("budget"))
    ranked = drawn.where("_q is not null")
    cuts = prefix_cut(ranked, "_key", "_q", TIES, "_size", budgets)
    decided = budgets.join(cuts, "_key", "left").withColumn("_gap", F.col("budget") - F.coalesce("taken", F.lit(0)))
    decided = materialize(decided.drop("budget", "taken"), "mix-cuts")
    # Of the documents left out, the one whose size is nearest to the gap, if taking it makes the gap smaller.
    left_out = ranked.join(decided, "_key").where(~within("_q", TIES)).withColumn("_miss", F.abs(F.col("_gap") - F.col("_size")))
    closing = left_out.where(F.col("_miss") < F.col("_gap")).groupBy("_key").agg(
        F.min(F.struct("_miss", "_q", *TIES))["_q"].alias("_close_q"), F.min(F.struct("_miss", "_q", *TIES)).alias("_close"))
    decided = decided.join(closing, "_key", "left").join(plan.select("_key", "source_size", "target", "_rate"), "_key")
    decided = materialize(decided, "mix-decided")

    out = docs.select("*", *[own[n].alias(n) for n in ("_key", "_id", "_tie", "_size", "_like", "_u")]).join(decided, "_key")
    out = out.withColumn("_certain", certain).withColumn("_q", F.when((p > 0) & (F.col("_size") > 0), F.log(odds)))
    closes = (F.col("_q") == F.col("_close_q")) & F.col("_id").eqNullSafe(F.col("_close")["_id"]) & (F.col("_tie") == F.col("_close")["_tie"])
    drawn_too = F.coalesce(F.col("_q").isNotNull() & (within("_q", TIES) | F.coalesce(closes, F.lit(False))), F.lit(False))
    copies = F.when(F.col("_size") > 0, F.col("_certain") + drawn_too.cast("long")).otherwise(F.lit(0)).cast("long")
    return table.back(out, _size=F.col("_size"), _source_size=F.col("source_size"), _target=F.col("target"), _copies=copies)


# The same draw in SQL, for comparison.
MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    (CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s),
t1 AS (SELECT a.source, a.source_size, a.w, a.cap, ((SELECT 1.5::DOUBLE * sum(source_size) FROM r) - coalesce(sum(b.cap), 0))
      / ((SELECT sum(w) FROM r) - coalesce(sum(b.w), 0)) AS level
  FROM r a LEFT JOIN r b ON b.cap / b.w < a.cap / a.w GROUP BY ALL),
t AS (SELECT source, source_size, CASE WHEN cap / w <= level THEN cap
    ELSE w * (SELECT arg_min(level, cap / w) FROM t1 WHERE cap / w > level) END AS target FROM t1),
m AS (SELECT d.doc_id, d.size, d.u, t.source, t.source_size, t.target, t.target / nullif(t.source_size, 0) AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, floor(rate) AS certain, CASE WHEN rate > floor(rate) AND size > 0
    THEN ln((u / (1 - u)) / ((rate - floor(rate)) / (1 - (rate - floor(rate))))) END AS q FROM m),
b AS (SELECT *, target - sum(certain * size) OVER (PARTITION BY source) AS budget,
    CASE WHEN q IS NOT NULL THEN sum(CASE WHEN q IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY q NULLS LAST, doc_id
      ROWS UNBOUNDED PRECEDING) END AS run FROM q),
g AS (SELECT *, coalesce(run <= budget, false) AS drawn,
    budget - coalesce(max(CASE WHEN run <= budget THEN run END) OVER (PARTITION BY source), 0) AS gap FROM b),
c AS (SELECT *, CASE WHEN q IS NOT NULL AND NOT drawn AND abs(gap - size) < gap
    THEN row_number() OVER (PARTITION BY source, q IS NOT NULL AND NOT drawn AND abs(gap - size) < gap ORDER BY abs(gap - size), q, doc_id) END AS closing FROM g)
SELECT doc_id, size, source_size, coalesce(target, 0) AS target,
  CAST(size * (coalesce(certain, 0) + CASE WHEN drawn OR closing = 1 THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c"""
