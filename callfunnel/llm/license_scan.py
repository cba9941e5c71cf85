"""License scan by canonical digest: whole texts, and whole lines, joined to known licence digests.

A text is canonical after: lower case; lines that state a copyright left out; equivalent spellings
made one; punctuation and white space made single spaces. Two texts with the same canonical form
have the same SHA-256, which is joined by hash to the digests of known licences. A document may
also close with a licence notice of one line, so each line's digest is looked up as well.

Null and empty texts have no digest and match nothing. Repeated rows and ids keep their rows;
columns other than id and text are not read. The known table is a parameter of any size: digests of
texts and lines are exploded and joined to it by hash, and only hits and one row per text go on.

A line that only begins with the word is no statement ("copyright notice and this permission
notice ..." of a wrapped text), yet the SQL's canonical form, which `digest` gives, leaves it out.
So a text is looked up by a second digest as well, that of a form which doesn't depend on wrapping.

The registered query knows KNOWN and the texts in `licenses/` with their usual titles and endings;
the SQL lists KNOWN only.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callfunnel.llm.common import whole

#: Equivalent spellings (from, to), applied in this order to lower-case text.
SPELLINGS = [("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("merchantibility", "merchantability"),
             ("acknowledgement", "acknowledgment"), ("organisation", "organization"), ("authorised", "authorized"), ("favour", "favor"),
             ("copyright holder", "copyright owner"), ("https://", "http://"), (" & ", " and "), ("per cent", "percent")]

#: Well-known licence texts and notices (short name, text).
KNOWN = [
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("MIT-notice", "Released under the MIT License."),
    ("MIT", """MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-notice", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0-notice", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0-notice", "Licensed under CC BY-SA 4.0."),
    ("all-rights-reserved", "All rights reserved."),
]

#: Titles that stand above a text, which itself has none.
TITLES = {"MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"], "ISC": ["ISC License", "The ISC License"],
          "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"],
          "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License"], "Unlicense": ["The Unlicense", "Unlicense"]}

#: Names of files that aren't the short name.
NAMES = {"Artistic": "Artistic-1.0-Perl", **{f"{k}-{v}": f"{k}-{v}.0" for k, v in (("GPL", 1), ("GPL", 2), ("GPL", 3), ("LGPL", 2), ("LGPL", 3))}}


def full_texts() -> list[tuple[str, str]]:
    """(license, text) of whole licences: the files in `licenses/` and their variants."""
    folder = os.path.join(os.path.dirname(os.path.abspath(__file__)), "licenses")
    texts = {}
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name), encoding="utf-8") as f:
            texts[name.removesuffix(".txt")] = f.read()
    regents = texts.pop("BSD")
    owned = (regents.replace("Regents of the University of California", "copyright holder").replace("name of the University", "name of the copyright holder")
             .replace("THE REGENTS AND CONTRIBUTORS", "THE COPYRIGHT HOLDERS AND CONTRIBUTORS").replace("THE REGENTS OR", "THE COPYRIGHT HOLDER OR"))
    bodies = [(NAMES.get(k, k), t) for k, t in texts.items()]
    for three in (regents, owned, owned.replace("the copyright holder nor", "the copyright holder nor\n   ").replace("its contributors", "its\n   contributors")):
        two = re.sub(r"3\. Neither.*?permission\.\n", "", three, flags=re.S)
        for name, text in (("BSD-3-Clause", three), ("BSD-2-Clause", two)):
            for listed in (text, re.sub(r"(?m)^[123]\. ", "* ", text)):
                bodies += [(name, listed), (name, listed.replace("All rights reserved.\n", ""))]
    short = dict(KNOWN)
    bodies += [("MIT", short["MIT"].removeprefix("MIT License ")), ("ISC", short["ISC"])]
    for name, text in list(bodies):
        end = re.search(r"END OF TERMS AND CONDITIONS", text)
        if end:  # without the appendix on how to apply it
            bodies += [(name, text[:end.end()]), (name, text[:end.start()])]
    return bodies + [(name, f"{title}\n\n{text}") for name, text in bodies for title in TITLES.get(name, [])]


#: Lines left out of `digest`, and those among them that state a copyright (a sign or a year follows).
BEGINS = r"(^|\n)[ \t]*(copyright|\(c\)|©)"
STATES = BEGINS + r"[ \t:,]*([0-9]{4}|\(c\)|©|[\[<{](year|yyyy)[\]>}])"


def spelled(text: Column) -> Column:
    for old, new in SPELLINGS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def plain_lines(text: Column) -> Column:
    """The text in lower case with one spelling, without copyright lines and punctuation; lines stay lines."""
    out = F.regexp_replace(spelled(F.lower(text)), BEGINS + r"[^\n]*", "\n")
    return F.regexp_replace(out, r"[\p{P}\p{S}]", " ")


def canonical(text: Column) -> Column:
    """A non-null text's canonical form."""
    return squeezed(plain_lines(text))


def unwrapped(text: Column) -> Column:
    """The form that doesn't depend on where lines break: only statements of a copyright go, and spellings may span lines."""
    out = squeezed(F.regexp_replace(F.lower(text), STATES + r"[^\n]*", "\n"))
    return squeezed(F.regexp_replace(spelled(out), r"[\p{P}\p{S}]", " "))


def squeezed(plain: Column) -> Column:
    return F.trim(F.regexp_replace(plain, "[ \t\n\x0b\x0c\r]+", " "))


def known_licenses(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(license, digest) of texts, two digests where the forms differ; of licences with the same form, the first name."""
    rows = spark.createDataFrame(known or KNOWN + full_texts(), "license string, text string")
    forms = F.array(canonical(F.col("text")), unwrapped(F.col("text")))
    return (rows.select("license", F.explode(F.array_distinct(forms)).alias("form")).filter("form <> ''")
            .select("license", F.sha2("form", 256).alias("digest")).groupBy("digest").agg(F.min("license").alias("license")))


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, digest (null without words), license of the whole text, licenses of whole lines (sorted, distinct)."""
    listed = known.select(F.col("digest").alias("known"), "license")
    raw = whole(docs[text_col])
    text = docs.select(docs[id_col].alias("doc_id"), F.monotonically_increasing_id().alias("row"), plain_lines(raw).alias("plain"), unwrapped(raw).alias("other"))
    sha = lambda c: F.when(c != "", F.sha2(c, 256))
    asked = lambda what, d: F.struct(F.lit(what).alias("what"), d.alias("digest"))
    lines = F.array_distinct(F.filter(F.transform(F.split("plain", "\n"), squeezed), lambda x: x != ""))
    digests = (text.select("doc_id", "row", F.explode(F.concat(
        F.array(asked("text", sha(squeezed(F.col("plain")))), asked("other", sha(F.col("other")))),
        F.transform(lines, lambda x: asked("line", sha(x))))).alias("x")).select("doc_id", "row", "x.what", "x.digest"))
    hits = digests.join(listed, F.col("digest") == F.col("known"), "left").filter("what = 'text' OR license IS NOT NULL")
    of = lambda what, c: F.when(F.col("what") == what, F.col(c))
    return hits.groupBy("row").agg(
        F.any_value("doc_id").alias("doc_id"), F.max(of("text", "digest")).alias("digest"),
        F.coalesce(F.max(of("text", "license")), F.max(of("other", "license"))).alias("license"),
        F.array_sort(F.collect_set(of("line", "license"))).alias("notices")).drop("row")


def license_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: doc_id, digest, license and notices (comma-joined), all empty where there is none."""
    none = F.lit("")
    return scan(docs, known_licenses(spark)).select(
        "doc_id", F.coalesce("digest", none).alias("digest"), F.coalesce("license", none).alias("license"), F.array_join("notices", ",").alias("notices"))


def _sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    out = f"lower({text})"
    for old, new in SPELLINGS:
        out = f"replace({out}, {_sql(old)}, {_sql(new)})"
    out = rf"regexp_replace({out}, '(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*', chr(10), 'g')"
    return rf"regexp_replace({out}, '[\pP\pS]', ' ', 'g')"


_SQUEEZE = r"trim(regexp_replace({}, '[ \t\n\x0b\x0c\r]+', ' ', 'g'))"

ORACLE = f"""
WITH known AS (SELECT min(license) AS license, digest FROM
       (SELECT license, sha256({_SQUEEZE.format(_canonical_sql("text"))}) AS digest
        FROM (VALUES {", ".join(f"({_sql(n)}, {_sql(t)})" for n, t in KNOWN)}) v(license, text)) GROUP BY digest),
t AS (SELECT row_number() OVER () AS r, doc_id, {_canonical_sql("coalesce(text, '')")} AS plain FROM documents),
w AS (SELECT r, doc_id, plain, {_SQUEEZE.format("plain")} AS c FROM t),
l AS (SELECT DISTINCT r, {_SQUEEZE.format("line")} AS c FROM (SELECT r, unnest(string_split(plain, chr(10))) AS line FROM t)),
n AS (SELECT r, string_agg(license, ',' ORDER BY license) AS notices FROM l JOIN known ON known.digest = sha256(c) GROUP BY r)
SELECT doc_id, CASE WHEN c <> '' THEN sha256(c) ELSE '' END AS digest, coalesce(license, '') AS license, coalesce(notices, '') AS notices
FROM w LEFT JOIN known ON known.digest = CASE WHEN c <> '' THEN sha256(c) END LEFT JOIN n ON n.r = w.r
"""
