"""Licence scan: canonical digests of whole texts, looked up among known licences.

A text is brought into a canonical form: ASCII lower case, lines that begin with a copyright
notice removed, every run of punctuation and white space one separator, and equivalent
spellings made one. The SHA-256 of the form is hash-joined with those of known licences.
The same is done with every line that speaks of a licence, to find notices inside documents.

Defined results
* A null text counts as empty; the form of a text without words is empty and has no licence.
* A null doc_id is kept. Repeated rows have equal results. An empty table gives an empty one.
* ``license`` is null if no known text matches; ``notices`` is empty if no line does.
* Two known texts with one canonical form count as the one with the smaller name.
* Other columns of the input are ignored.
* The SQL knows the texts of ``KNOWN`` only, not the files in ``license_texts``.
"""

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.llm.common import compact, query, same, small, table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A notice names a year, a holder after "by" or a sign; wrapped text that begins with the word stays.
COPYRIGHT = (
    r"\n[ \t#*/;-]*(?:copyright[ \t:]*(?:\(c\)|\x{A9}|[0-9<\[{]|by[ \t])|\(c\)[ \t]|\x{A9}|all rights reserved)[^\n]*"
)
#: Letters and digits stay; ASCII marks, spaces, general punctuation and ideographic spaces part words.
SEPARATOR = r"[^a-z0-9\x{AA}-\x{1FFF}\x{2070}-\x{2FFF}\x{3003}-\x{10FFFF}]+"
#: Spellings that licence guidelines treat as equal.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("behaviour", "behavior"),
    ("cancelled", "canceled"),
    ("centre", "center"),
    ("copyright holders", "copyright owners"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("https", "http"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("sub license", "sublicense"),
    ("sub licence", "sublicense"),
    ("whilst", "while"),
    ("wilful", "willful"),
]
#: Public licence texts.
MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"""
MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
KNOWN = [
    ("0BSD", f"{ISC_GRANT}.\n\n{ISC_WARRANTY}"),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", f"{BSD_GRANT}\n\n{BSD_WARRANTY}"),
    ("BSD-3-Clause", f"{BSD_GRANT}\n{BSD_NAMES}\n\n{BSD_WARRANTY}"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", f"{ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{ISC_WARRANTY}"),
    ("MIT", f"{MIT_GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n{MIT_WARRANTY}"),
    ("MIT", f"MIT License\n\n{MIT_GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n{MIT_WARRANTY}"),
    ("MIT", "Released under the MIT License."),
    ("MIT-0", f"{MIT_GRANT}.\n\n{MIT_WARRANTY}"),
    ("Zlib", ZLIB),
]


def whole_texts() -> list[tuple[str, str]]:
    """(name, text) of the files in ``license_texts``, read by the driver."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return [(f.stem, f.read_text(encoding="utf-8")) for f in files]


def canonical(text: Column) -> Column:
    """Words of the canonical form, each between two spaces of its own."""
    plain = F.translate(F.concat(F.lit("\n"), F.coalesce(text, F.lit(""))), UPPER, UPPER.lower())
    plain = F.regexp_replace(plain, COPYRIGHT, "")
    plain = F.concat(F.lit(" "), F.regexp_replace(plain, SEPARATOR, "  "), F.lit(" "))
    plain = F.concat(F.lit(" "), F.trim(plain), F.lit(" "))
    for a, b in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b.replace(' ', '  ')} "))
    return plain


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known=None) -> DataFrame:
    """digest, license of known texts: a list of (name, text) or a DataFrame name, text;
    ``KNOWN`` and the whole texts if there is none."""
    if known is None:
        known = KNOWN + whole_texts()
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame(known, "name string, text string")
    found = known.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("name").alias("license"))
    return compact(found.filter(F.col("digest") != digest(F.lit(""))))


def scan(docs: DataFrame, known=None) -> DataFrame:
    """One row per document: doc_id, digest, license, notices (names, sorted, comma-joined)."""
    names = small(known_digests(docs.sparkSession, known))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("th"), digest(text).alias("digest"))
    rows = rows.join(names, "digest", "left").alias("d")

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("(?i)licen[cs]e"))
    lines = docs.select("doc_id", F.xxhash64(text).alias("th"), F.explode(lines).alias("line"))
    lines = lines.withColumn("digest", digest(F.col("line"))).join(names, "digest")
    lines = lines.groupBy("doc_id", "th").agg(F.array_join(F.sort_array(F.collect_set("license")), ",").alias("notices"))
    lines = lines.alias("n")
    on = same(F.col("d.doc_id"), F.col("n.doc_id")) & (F.col("d.th") == F.col("n.th"))
    return rows.join(lines, on, "left").select(
        "d.doc_id", "digest", "license", F.coalesce("notices", F.lit("")).alias("notices")
    )


def canonical_sql(x: str) -> str:
    sql = f"translate(chr(10) || coalesce({x}, ''), '{UPPER}', '{UPPER.lower()}')"
    sql = f"regexp_replace({sql}, '{COPYRIGHT}', '', 'g')"
    sql = f"' ' || trim(' ' || regexp_replace({sql}, '{SEPARATOR}', '  ', 'g') || ' ') || ' '"
    for a, b in SPELLINGS:
        sql = f"replace({sql}, ' {a.replace(' ', '  ')} ', ' {b.replace(' ', '  ')} ')"
    return sql


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


SCAN_SQL = f"""WITH known AS (
  SELECT sha256({canonical_sql("text")}) AS digest, min(name) AS license
  FROM (VALUES {", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in KNOWN + whole_texts())}) k(name, text) GROUP BY 1),
d AS (SELECT doc_id, text, sha256({canonical_sql("text")}) AS digest FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
n AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM (SELECT doc_id, sha256({canonical_sql("line")}) AS digest FROM l WHERE regexp_matches(line, '(?i)licen[cs]e'))
  JOIN known USING (digest) GROUP BY doc_id)
SELECT d.doc_id, d.digest, known.license, coalesce(n.notices, '') AS notices
FROM d LEFT JOIN known USING (digest) LEFT JOIN n USING (doc_id)"""


@query("op7_license_scan", SCAN_SQL)
def op7_license_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))
