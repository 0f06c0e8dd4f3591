"""License scan by canonical digests.

A text is normalised (case, equivalent spellings, copyright lines,
punctuation, spacing) and its SHA-256 is looked up among the digests of known
licence texts with a hash join.  Entire texts are compared: a whole document
and each of its lines, as notices usually take a line.  All of it is DataFrame
functions; no text leaves the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Whole notices and short licence texts by SPDX identifier.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", 'MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", 'ISC License Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License v3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

#: Spellings that count as equal, applied in this order to text in lower case.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sub-license", "sublicense"), ("non-infringement", "noninfringement"),
    ("version 2.0", "2.0"), ("version 3", "v3"), ("version 2", "v2"), ("https://", "http://"), ("&", " and "),
)

_COPYRIGHT = ("copyright", "(c)", "©")
_COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*"
_ALL_RIGHTS = "all rights reserved"
_NOT_WORD = r"[^a-z0-9.+\n]+"
_LOOSE_STOP = r"\.+(?=[ \n]|$)"


def normalised_lines(text: Column) -> Column:
    """Lines that are not empty once normalised: lower case, equal spellings, no copyright lines,
    single spaces between runs of a-z, 0-9, + and inner dots."""
    out = F.lower(text)
    has_line = reduce(lambda a, b: a | b, (F.contains(out, F.lit(x)) for x in _COPYRIGHT))
    out = F.when(has_line, F.regexp_replace(out, _COPYRIGHT_LINE, "\n")).otherwise(out)
    out = F.replace(out, F.lit(_ALL_RIGHTS), F.lit(" "))
    out = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, out)
    out = F.regexp_replace(F.regexp_replace(out, _NOT_WORD, " "), _LOOSE_STOP, "")
    return F.filter(F.transform(F.split(out, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def digest(text: Column) -> Column:
    return F.coalesce(F.sha2(text, 256), F.lit(""))  # never null, so no filter works it out a second time


def _whole(lines: Column) -> Column:
    return F.array_join(lines, " ")


def known_licenses(spark, extra: DataFrame | None = None) -> DataFrame:
    """(digest, license): the built-in registry, and further texts (license, text) if given."""
    rows = F.array(*(F.struct(F.lit(k).alias("license"), F.lit(t).alias("text")) for k, t in KNOWN))
    texts = spark.range(1).select(F.inline(rows))
    if extra is not None:
        texts = texts.unionByName(extra.select("license", "text"))
    return texts.select(digest(_whole(normalised_lines(F.col("text")))).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """One row per document: text_digest, text_license, n_license_lines, line_licenses.

    ``text_license`` is the licence whose whole text the document is, else null;
    ``n_license_lines`` counts lines that are a known notice from end to end, and
    ``line_licenses`` lists their licences, sorted, once each, joined by commas ('' if none).

    Null texts are empty texts: no licence.  Rows that share a doc_id are scanned each for
    itself, as are rows without one.  Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    # The built-in registry is of fixed size; one that is handed in is left to the planner, which knows its size.
    known = F.broadcast(known_licenses(spark)) if registry is None else registry
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        normalised_lines(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("lines"),
    )
    # The text as a whole and its lines go through one join; of the lines only those found go on.
    unit = lambda whole, text: F.struct(F.lit(whole).alias("whole"), text.alias("unit"))
    units = docs.select("doc_id", "row", F.inline(F.concat(F.array(unit(True, _whole(F.col("lines")))), F.transform("lines", lambda x: unit(False, x)))))
    found = units.select("doc_id", "row", "whole", digest(F.col("unit")).alias("digest")).join(known, "digest", "left").where("whole or license is not null")
    return (
        found.groupBy("row", "doc_id")
        .agg(
            F.max(F.when(F.col("whole"), F.col("digest"))).alias("text_digest"),
            F.max(F.when(F.col("whole"), F.col("license"))).alias("text_license"),
            F.count(F.when(~F.col("whole"), 1)).alias("n_license_lines"),
            F.array_join(F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license")))), ",").alias("line_licenses"),
        )
        .drop("row")
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_line(line: str) -> str:
    out = f"CASE WHEN regexp_matches({line}, '^[ \\t]*(copyright|\\(c\\)|©)') THEN '' ELSE {line} END"
    out = f"replace({out}, 'all rights reserved', ' ')"
    for a, b in SPELLINGS:
        out = f"replace({out}, {_quoted(a)}, {_quoted(b)})"
    return f"trim(regexp_replace(regexp_replace({out}, '[^a-z0-9.+]+', ' ', 'g'), '\\.+( |$)', ' ', 'g'))"


_SQL_LINES = f"list_filter(list_transform(string_split(lower(coalesce(text, '')), chr(10)), lambda l: {_sql_line('l')}), lambda l: l <> '')"

ORACLE = f"""
WITH known AS (
  SELECT sha256(array_to_string({_SQL_LINES}, ' ')) AS digest, min(license) AS license
  FROM (VALUES {', '.join(f'({_quoted(k)}, {_quoted(t)})' for k, t in KNOWN)}) AS v(license, text) GROUP BY 1),
split AS (SELECT doc_id, {_SQL_LINES} AS lines FROM documents),
whole AS (SELECT doc_id, sha256(array_to_string(lines, ' ')) AS digest FROM split),
pieces AS (SELECT doc_id, unnest(lines) AS line FROM split),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
  FROM pieces JOIN known ON known.digest = sha256(line) GROUP BY 1)
SELECT w.doc_id, w.digest AS text_digest, k.license AS text_license,
       coalesce(f.n, 0) AS n_license_lines, coalesce(f.names, '') AS line_licenses
FROM whole w LEFT JOIN known k USING (digest) LEFT JOIN found f ON f.doc_id = w.doc_id
"""
