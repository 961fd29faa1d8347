"""Licence scan by canonical digest lookup.

A text is put into a canonical form (lower case, no copyright lines, one spelling, words without punctuation) and
its SHA-256 is looked up in the digests of the known licence texts. Units are the whole text, its paragraphs and
its lines, so a licence is found as a document, as a block or as a notice line, but never as a part of a line.
Built-in functions only; the digest table is small and fixed by the parameter.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.columns import Numbered

_MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_BODY = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

# Wordings of well-known licences and licence notices.
KNOWN: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License");',
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD-2-Clause": ("SPDX-License-Identifier: BSD-2-Clause", "Released under the BSD 2-Clause License."),
    "BSD-3-Clause": ("SPDX-License-Identifier: BSD-3-Clause", "Released under the BSD 3-Clause License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC0-1.0": ("Licensed under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"),
    "ISC": (_ISC_BODY, "ISC License\n" + _ISC_BODY, "Released under the ISC License."),
    "MIT": (_MIT_BODY, "MIT License\n" + _MIT_BODY, "The MIT License (MIT)\n" + _MIT_BODY, "Released under the MIT License.",
            "SPDX-License-Identifier: MIT"),
    "MPL-2.0": ("SPDX-License-Identifier: MPL-2.0",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
}

# Spellings taken as equal; the first part are single words, the second pairs of words.
SPELLINGS = (("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
             ("acknowledgement", "acknowledgment"), ("organisation", "organization"), ("favour", "favor"),
             ("merchantibility", "merchantability"), ("v", "version"))
JOINED = (("sub license", "sublicense"), ("non infringement", "noninfringement"))
COPYRIGHT_LINE = r"^[\x20\t]*(?:©|\(c\)\x20|copyright\x20+(?:©|\(c\)|[0-9])).*$"
BLANK_LINE = r"^[\x20\t\r]*$"
PARAGRAPH = "\x01"  # stands for a blank line between canonical lines


def _whole_word(word: str) -> str:
    return rf"(?<![^ ]){word}(?![^ ])"


def canonical_lines(text: Column) -> Column:
    """The canonical form of every line: words of letters and digits between single blanks, or a mark if blank."""
    lines = F.transform(F.split(F.lower(text), "\n", -1), lambda x: F.when(F.regexp_like(x, F.lit(BLANK_LINE)), F.lit(PARAGRAPH)).when(
        F.regexp_like(x, F.lit(COPYRIGHT_LINE)), F.lit("")).otherwise(F.trim(F.regexp_replace(x, r"[^\p{L}\p{N}]+", " "))))
    def spelled(x: Column) -> Column:
        out, found = x, F.contains(F.concat(F.lit(" "), x, F.lit(" ")), F.lit(f" {SPELLINGS[-1][0]} "))
        for a, b in SPELLINGS:
            out = F.regexp_replace(out, _whole_word(a), b)
            # Plain search, which most lines end with.
            found = found if len(a) == 1 else found | F.contains(x, F.lit(a))
        return F.when(found, out).otherwise(x)

    return F.transform(lines, spelled)


def _joined(form: Column) -> Column:
    for a, b in JOINED:
        form = F.replace(form, F.lit(a), F.lit(b))
    return form


def units(lines: Column) -> Column:
    """(unit, position, form) of the text, its paragraphs and its lines, from canonical lines; forms have words.

    A line's position is its number in the text, a paragraph's its number among those with words.
    """
    plain = lambda xs: F.filter(xs, lambda x: (x != "") & (x != PARAGRAPH))
    whole = F.array(_joined(F.array_join(plain(lines), " ")))
    blocks = F.split(F.array_join(F.filter(lines, lambda x: x != ""), " "), rf" ?(?:{PARAGRAPH} ?)+", -1)
    blocks = F.filter(F.transform(blocks, lambda x: _joined(F.trim(x))), lambda x: x != "")

    def named(unit: str, forms: Column) -> Column:
        return F.filter(F.transform(forms, lambda x, i: F.struct(F.lit(unit).alias("unit"), i.cast("long").alias("position"), x.alias("form"))),
                        lambda u: (u["form"] != "") & (u["form"] != PARAGRAPH))

    return F.concat(named("text", whole), named("paragraph", blocks), named("line", F.transform(lines, _joined)))


def longest(known: Mapping[str, tuple[str, ...]]) -> int:
    """A length that no canonical form of a known wording exceeds."""
    return 2 * max(len(t) for texts in known.values() for t in texts)


def digest_table(like: DataFrame, known: Mapping[str, tuple[str, ...]] = KNOWN) -> DataFrame:
    """(digest, license): one row for every known wording, canonicalised by the same expression as the texts."""
    rows = [F.struct(F.lit(k).alias("license"), F.lit(t).alias("wording")) for k, texts in known.items() for t in texts]
    table = like.sparkSession.range(1).select(F.inline(F.array(*rows)))
    forms = table.select("license", F.element_at(units(canonical_lines(F.col("wording"))), 1)["form"].alias("form"))
    return forms.select("license", F.sha2("form", 256).alias("digest")).dropDuplicates(["digest"])


def scan_licenses(docs: DataFrame, known: Mapping[str, tuple[str, ...]] = KNOWN, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_whole`` (the licence that the entire text is, or null) and ``_licenses``.

    ``_licenses`` is an array of (license, unit, position), ordered by them: unit text, paragraph or line, position
    counted from 0. Null or empty texts have none, and units without a word are passed over. Equal texts share their
    finds, so repeated rows and null ids do no harm. Paragraphs are separated by blank lines. Columns of ``docs``
    may have any names: a new column whose name is taken gets one more leading underscore.

    The lookup is a join of the digests of all units with the digest table; only units that meet one come back, and
    they are joined to the documents by a hash of the text. Units longer than any known wording need no digest.
    """
    table = Numbered(docs)
    docs, text_col = table.df, table.at(text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    digests = digest_table(docs, known)
    key = F.xxhash64(text)

    lines = docs.select(key.alias("_key"), F.length(text).alias("_chars"), canonical_lines(text).alias("lines"))
    forms = lines.select("_key", "_chars", F.inline(units(F.col("lines")))).where(F.length("form") <= longest(known))
    hits = forms.withColumn("digest", F.sha2("form", 256)).join(digests, "digest").groupBy("_key", "_chars").agg(
        F.array_sort(F.collect_set(F.struct("license", "unit", "position"))).alias("_licenses"))
    out = docs.withColumn("_key", key).withColumn("_chars", F.length(text)).join(hits, ["_key", "_chars"], "left")
    none = F.array().cast("array<struct<license:string,unit:string,position:bigint>>")
    licenses = F.coalesce("_licenses", none)
    whole = F.get(F.filter(licenses, lambda x: x["unit"] == "text"), F.lit(0))["license"]
    return table.back(out, _whole=whole, _licenses=licenses)


def sql(known: Mapping[str, tuple[str, ...]] = KNOWN) -> str:
    """The same lookup in SQL, for comparison: each unit is brought into its canonical form as a whole."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    wordings = ", ".join(f"({quote(k)}, {quote(t)})" for k, texts in known.items() for t in texts)
    form = f"""' ' || regexp_replace(regexp_replace(lower(part), {quote("(?m)" + COPYRIGHT_LINE)}, '', 'g'), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || ' '"""
    for a, b in (*SPELLINGS, *JOINED):
        form = f"replace({form}, {quote(f' {a.replace(' ', '  ')} ')}, {quote(f' {b} ')})"
    form = f"trim(regexp_replace({form}, '\\x20+', ' ', 'g'))"
    return f"""
WITH k AS (SELECT DISTINCT license, sha256({form}) AS digest FROM (VALUES {wordings}) w(license, part)),
u AS (SELECT doc_id, 'text' AS unit, 0 AS nr, coalesce(text, '') AS part FROM documents
  UNION ALL SELECT doc_id, unit, generate_subscripts(parts, 1) - 1, unnest(parts) FROM (
    SELECT doc_id, 'paragraph' AS unit, string_split_regex(coalesce(text, ''), '\\n(?:[\\x20\\t\\r]*\\n)+') AS parts FROM documents
    UNION ALL SELECT doc_id, 'line', string_split(coalesce(text, ''), chr(10)) FROM documents)),
f AS (SELECT *, {form} AS form FROM u),
n AS (SELECT *, CASE WHEN unit = 'paragraph' THEN row_number() OVER (PARTITION BY doc_id, unit ORDER BY nr) - 1 ELSE nr END AS position FROM f WHERE form <> ''),
h AS (SELECT doc_id, license, unit, position FROM n JOIN k ON sha256(form) = digest),
a AS (SELECT doc_id, max(CASE WHEN unit = 'text' THEN license END) AS whole_license,
    string_agg(license || ':' || unit || ':' || position, ',' ORDER BY license, unit, position) AS places, count(*) AS n_units FROM h GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS licenses FROM (SELECT DISTINCT doc_id, license FROM h) GROUP BY doc_id)
SELECT d.doc_id, whole_license, coalesce(licenses, '') AS licenses, coalesce(n_units, 0) AS n_units, coalesce(places, '') AS places
FROM documents d LEFT JOIN a ON d.doc_id = a.doc_id LEFT JOIN l ON d.doc_id = l.doc_id"""
