"""Licence scan by canonical digest, in DataFrame functions only.

A text is brought to a canonical form: lower case, copyright notices dropped, runs
of anything but letters a-z and digits one space, equivalent spellings alike.
A line of a licence's own words that begins with "copyright" is no notice, so
where a text is wrapped does not change its form.
The SHA-256 of that form is joined with the digests of known licences.  Two
kinds of text are looked up as a whole: each document, and each of its lines (a
notice such as a header is a text of its own).  The known side is a constant
list of the module, some dozens of rows, so its broadcast has a fixed size.

Defined results: a null or empty text, or one that is only copyright lines, has
no digest and matches nothing; repeated rows match one by one; null ids are
carried; a document of a single line can match as document and as line; empty
tables give no rows; texts of any length are digested whole.
"""

from __future__ import annotations

from functools import reduce
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Licence texts and notices, each with its identifier.
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
)

# Equivalent spellings, applied in this order to the canonical words.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("noncommercial", "nc"), ("non commercial", "nc"),
    ("sub license", "sublicense"), ("copyright owner", "copyright holder"), ("version", "v"),
    ("gnu gpl", "gnu general public license"), ("merchantibility", "merchantability"),
    ("non infringement", "noninfringement"),
)

# Entire texts beside the module, and the titles that they stand with or without.
ENTIRE = ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "Unlicense")
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License"),
}
END_OF_TERMS = "END OF TERMS AND CONDITIONS"  # what follows tells how to apply them, and may be left out
# Words after "copyright", or after "(c)" as the mark of a paragraph, in licences themselves.
IN_TEXT = r"""a(?!\.) all and any are as at be by-laws disclaim\w* doctrines? for from have holders? if in include interests? is
it its law laws licen[cs]e\w* may must nor not notices? of on or owner\w* permissions? protection rights? shall
statements? subject such that the this to treat(?:y|ies) under with you your""".split()
NOTICE = (
    r"^[ \t]*(?:copyright[ \t:,]*(?:\(c\)|©|&copy;|[\[<{(]?(?:(?:19|20)\d\d|yyyy|year)\b|by[ \t])"
    r"|copyright[ \t:]+the\b.*\b(?:authors?|contributors?|developers?|foundation|project|regents|team)\b"
    r"|(?:©|\(c\))[ \t]*(?:copyright\b|[\[<{(]?(?:19|20)\d\d\b)"
    rf"|(?:copyright[ \t:]+|(?:©|\(c\))[ \t]*)(?!(?:{'|'.join(IN_TEXT)})\b)[^\W\d_])")


def canonical_line(line: Column) -> Column:
    """Canonical form of one line: words by single spaces; empty for a copyright notice."""
    low = F.lower(line)
    words = F.regexp_replace(F.when(low.rlike(NOTICE), F.lit("")).otherwise(low), "[^a-z0-9]+", " ")
    return _alike(F.trim(words))


def _alike(words: Column) -> Column:
    padded = F.concat(F.lit(" "), words, F.lit(" "))
    return F.trim(reduce(lambda s, pair: F.replace(s, F.lit(f" {pair[0]} "), F.lit(f" {pair[1]} ")), SPELLINGS, padded))


def _whole(lines: Column) -> Column:
    """Canonical form of all lines; spellings may reach over a line's end."""
    return _alike(F.array_join(F.filter(lines, lambda x: x != ""), " "))


def known_texts() -> list[tuple[str, str]]:
    """(licence, text) of the known notices, and of entire texts with each title, without one, and without instructions."""
    texts = [(i, (files(__package__) / "license_texts" / f"{i}.txt").read_text(encoding="utf-8")) for i in ENTIRE]
    texts += [(i, t.removeprefix("MIT License\n\n")) for i, t in KNOWN if "Permission" in t]
    out = [*KNOWN, *texts]
    for i, t in texts:
        out += [(i, f"{title}\n\n{t}") for title in TITLES.get(i, ())]
        terms, end, _ = t.partition(END_OF_TERMS)
        if end:
            out += [(i, terms), (i, terms + end)]
    return out


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, license_id) of the known texts, one row a digest."""
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in known_texts()]))
    texts = spark.range(1).select(rows.alias("k")).select("k.license_id", "k.text")
    lines = texts.select("license_id", F.transform(F.split("text", "\n", -1), canonical_line).alias("lines"))
    return (lines.select(F.sha2(_whole(F.col("lines")), 256).alias("digest"), "license_id")
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, unit, line_no, license_id, digest) of every whole document or line that is a known licence.

    ``unit`` is ``document`` (line_no 0) or ``line`` (line_no from 1).
    """
    lines = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1), canonical_line).alias("lines"))
    units = lines.select("doc_id", F.posexplode(F.concat(F.array(_whole(F.col("lines"))), F.col("lines"))).alias("line_no", "canonical"))
    digests = units.where("canonical <> ''").select(
        "doc_id", F.when(F.col("line_no") == 0, "document").otherwise("line").alias("unit"),
        F.col("line_no").cast("long").alias("line_no"), F.sha2("canonical", 256).alias("digest"))
    return (digests.join(F.broadcast(known_digests(docs.sparkSession)), "digest")
            .select("doc_id", "unit", "line_no", "license_id", "digest"))


def _sql_alike(words: str) -> str:
    out = f"' ' || {words} || ' '"
    for a, b in SPELLINGS:
        out = f"replace({out}, ' {a} ', ' {b} ')"
    return f"trim({out})"


def _sql_notice(low: str) -> str:
    """``NOTICE`` without lookaheads, which DuckDB's expressions don't have."""
    kinds, named = NOTICE.rsplit("|(?:copyright[ \\t:]+|", 1)[0] + ")", r"^[ \t]*(copyright[ \t:]+|(©|\(c\))[ \t]*)"
    words = "|".join(w for w in IN_TEXT if "(?!" not in w)

    def matches(pattern: str) -> str:
        return f"regexp_matches({low}, '{pattern}')"

    own = f"{matches(rf'{named}({words})' + chr(92) + 'b')} OR {matches(named + r'a' + chr(92) + 'b')} AND NOT {matches(named + 'a[.]')}"
    return f"({matches(kinds)} OR {matches(named + '[a-z]')} AND NOT ({own}))"


def oracle_sql() -> str:
    """DuckDB SQL for ``scan_licenses`` over the table ``documents``."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    values = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in known_texts())
    words = "trim(regexp_replace(CASE WHEN " + _sql_notice("lower(x)") + " THEN '' ELSE lower(x) END, '[^a-z0-9]+', ' ', 'g'))"
    line = _sql_alike(words)

    def whole(lines: str) -> str:
        return _sql_alike(f"array_to_string(list_filter({lines}, lambda y: y <> ''), ' ')")

    return f"""
WITH known AS (
  SELECT sha256({whole(f"list_transform(string_split(t, chr(10)), lambda x: {line})")}) AS digest, min(i) AS license_id
  FROM (VALUES {values}) AS k(i, t) GROUP BY 1),
lines AS (
  SELECT doc_id, list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {line}) AS l FROM documents),
units AS (
  SELECT doc_id, 0 AS line_no, {whole('l')} AS canonical FROM lines
  UNION ALL
  SELECT doc_id, unnest(range(1, len(l) + 1)) AS line_no, unnest(l) AS canonical FROM lines)
SELECT doc_id, CASE WHEN line_no = 0 THEN 'document' ELSE 'line' END AS unit, CAST(line_no AS BIGINT) AS line_no,
       license_id, digest
FROM units JOIN known ON digest = sha256(canonical) WHERE canonical <> ''"""
