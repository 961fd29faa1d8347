"""Secret scan over a trigram index, with built-in functions only.

Every rule is a regular expression. From its syntax tree follows a Boolean query on trigrams that every match
satisfies: an OR of clauses, each an AND of trigrams. The index holds one posting (trigram, document key) for every
trigram of any query that the lower-cased document has. Intersecting the postings of a clause gives the candidate
documents of its rule, and only those are searched with the expression. Rules without mandatory trigrams search
every document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm import spans as S
from shelfline.llm.columns import Numbered
from shelfline.session import materialize


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    part: int = 0  # group that must have ``least`` characters
    least: int = 0


# Matches of the first three that are too short are dropped without a second try. For runs of one class that is the
# same as asking for the length in the pattern; an assignment's value is measured afterwards.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
RULES = BASE + (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)
MOST_STRINGS = 64


def _strings(tree, most: int = MOST_STRINGS) -> set[str] | None:
    """All strings a syntax tree matches, lower-cased, if they are few; None otherwise."""
    out = {""}
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            new = {chr(arg).lower()}
        elif name == "IN" and all(str(o) in ("LITERAL", "RANGE") for o, _ in arg):
            new = set()
            for o, a in arg:
                lo, hi = (a, a) if str(o) == "LITERAL" else a
                if hi - lo > most:
                    return None
                new |= {chr(c).lower() for c in range(lo, hi + 1)}
        elif name == "BRANCH":
            parts = [_strings(t, most) for t in arg[1]]
            if any(p is None for p in parts):
                return None
            new = set().union(*parts)
        elif name == "SUBPATTERN":
            new = _strings(arg[3], most)
        elif name == "MAX_REPEAT" and arg[1] != re._parser.MAXREPEAT and arg[1] <= 2:
            one = _strings(arg[2], most)
            new = None if one is None else {"".join(x) for n in range(arg[0], arg[1] + 1) for x in product(one, repeat=n)}
        else:
            return None
        if new is None or len(out) * len(new) > most:
            return None
        out = {a + b for a, b in product(out, new)}
    return out


def _runs(tree) -> list[set[str]]:
    """Sets of strings of each of which every match contains one."""
    found: list[set[str]] = []
    run = {""}
    for item in tree:
        own = _strings([item])
        if own is not None and len(run) * len(own) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, own)}
            continue
        found.append(run)
        run = own or {""}
        op, arg = str(item[0]), item[1]
        if own is None and op == "SUBPATTERN":
            found.extend(_runs(arg[3]))
        elif own is None and op == "MAX_REPEAT" and arg[0] >= 1:
            found.extend(_runs(arg[2]))
    return [*found, run]


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses of trigrams: a text with a match has, lower-cased, all trigrams of at least one clause.

    An empty list means that there is no mandatory trigram.
    """
    clauses: list[frozenset[str]] = []
    for run in _runs(re._parser.parse(pattern)):
        if min(map(len, run)) < 3:
            continue
        own = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
        own = {c for c in own if not any(o < c for o in own)}  # a clause that contains another adds nothing
        if not clauses:
            clauses = sorted(own, key=sorted)
        elif len(clauses) * len(own) <= MOST_STRINGS:
            clauses = sorted({a | b for a, b in product(clauses, own)}, key=sorted)
    return clauses


def _key(docs: DataFrame, id_col: str, text: Column) -> Column:
    return F.xxhash64(F.col(id_col), text)


def postings(docs: DataFrame, grams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index: one row (gram, key) for each listed trigram in a document."""
    low = docs.select(_key(docs, id_col, F.coalesce(F.col(text_col), F.lit(""))).alias("key"), F.lower(F.col(text_col)).alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select("key", F.explode(present).alias("gram"))


def candidates(index: DataFrame, queries: dict[int, list[frozenset[str]]]) -> DataFrame:
    """(key, rules): bit r is set if the postings of a clause of rule r meet in the document."""
    rows = [F.struct(F.lit(g).alias("gram"), F.lit(1 << r).cast("long").alias("rule"), F.lit(c).alias("clause"),
                     F.lit(1 << i).cast("long").alias("bit"), F.lit((1 << len(grams)) - 1).cast("long").alias("full"))
            for r, clauses in queries.items() for c, grams in enumerate(clauses) for i, g in enumerate(sorted(grams))]
    wanted = index.sparkSession.range(1).select(F.inline(F.array(*rows)))  # a few hundred rows, from the rules alone
    met = index.join(wanted, "gram").groupBy("key", "rule", "clause").agg(F.bit_or("bit").alias("got"), F.first("full").alias("full"))
    return met.where("got = full").groupBy("key").agg(F.bit_or("rule").alias("_rules"))


def _long_enough(spans: Column, least: int) -> Column:
    return F.filter(spans, lambda s: F.length(s["part"]) >= least)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``_spans``: start, stop, kind, value of every secret, ordered by start and kind.

    Null text is empty and has no spans. A document's key is a hash of id and text, so repeated rows, null ids and
    ties share their candidate rules and get equal spans; a chance collision only adds a search. Spans of different
    kinds may overlap. Columns of ``docs`` may have any names: if ``_spans`` is taken, the new column is ``__spans``.
    """
    table = Numbered(docs)
    docs, id_col, text_col = table.df, table.at(id_col), table.at(text_col)
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("_key", _key(docs, id_col, text))
    if queries:
        index = postings(docs, sorted({g for q in queries.values() for c in q for g in c}), id_col, text_col)
        found = materialize(candidates(index, queries), "secret-candidates")
        out = out.join(found.withColumnRenamed("key", "_key"), "_key", "left")
    parts = []
    for i, rule in enumerate(rules):
        guard = None
        if i in queries:
            guard = F.col("_rules").bitwiseAND(F.lit(1 << i).cast("long")) != 0
        one = S.match_spans(text, rule.pattern, rule.kind, i, rule.part, guard)
        parts.append(_long_enough(one, rule.least) if rule.least else one)
    return table.back(out, _spans=S.by_start(F.concat(*parts)))
