"""Licence scan by canonical digests.

A text is brought to a canonical form: A-Z in lower case, copyright lines
gone, punctuation and blanks one space, equivalent spellings made equal. For
its digest a licence's heading, numbers of clauses and the owner a clause
names go, too. The SHA-256 is looked up among those of known licences, given
as texts or as digests (a hash join with a table whose size the lists fix).

Notices that grant a licence ("under the terms of the GNU GPL, version 2", an
SPDX line) are found anywhere in the same canonical form, so also inside
sentences and over line breaks: one expression finds the phrases, and the
words and the version of each phrase name the licence.

Known texts: MIT, ISC, BSD-2, BSD-3, Zlib, 0BSD, Unlicense, BlueOak,
Apache-2.0, Artistic, CC0, GFDL, GPL, LGPL, MPL. Known notices: ``NOTICES``.
A text that differs by a word has no licence. A mention without "under", "by"
or an SPDX line is no notice; "or later" is not kept apart.

Defined results: null and empty texts have the digest of the empty text and no
licence. Repeated rows are scanned each; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripengine.llm.common import query, table, whole

# Licence texts as published.
_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
"""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
"""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
LICENCES = {
    "MIT": """MIT License
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
""",
    "ISC": """ISC License
Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
""",
    "BSD-2-Clause": _BSD_CONDITIONS + _BSD_WARRANTY,
    "BSD-3-Clause": _BSD_CONDITIONS + _BSD_NAMES + _BSD_WARRANTY,
    "Zlib": """zlib License
This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.
Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not
claim that you wrote the original software. If you use this software
in a product, an acknowledgment in the product documentation would be
appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
""",
}
# Digests of other licences' published texts, by ``digest`` of ``canonical``.
DIGESTS = {
    "52d401c120e1089350c2d0ad77d531130f31c3467b3dadda0b3251ff3e615eb6": "Apache-2.0",
    "f7821e3633fc4d306bc708132bad74806906bae0838a9231fefa3cad7ead7078": "Apache-2.0",
    "0cf6ae2399fbfc48db368af8fa11dd25f5afc27315fa66941e9c2f6ab617676c": "Apache-2.0",
    "2bf9fd04122c885241610f98ca4320fe0892e6ca486cc83e1e2e435d21f24f75": "Apache-2.0",
    "f0cb3551ef20b90eb8e5041383c48f2131630bc7d45d7083469b5930cca6742a": "Artistic-1.0",
    "d63fc6ff508acf4293af9aa637d539336b8bbb2691f50f5cf048208c59bb372c": "CC0-1.0",
    "9114261cb0ec693fcb53a50069e52abba6f9b51a15ae72becbc69431316a1e75": "GFDL-1.2",
    "2d2f0d4aa304aa022232161663c653e5553c93f1300a697417d1b4eea05c19ce": "GFDL-1.3",
    "1fd5bf15b0a363487ba015b42d4a96ded39b6a8b1b1be393f4a15d4fa62dcb11": "GPL-1.0",
    "6de014973a24d36c8d7c2c4d8715dfeab9ec0c200bc6a68ad7d76e20f3577e86": "GPL-2.0",
    "d7d26a4a729533715fde2582daa9856afb1fe74ea94fea54b265c02af49c49b5": "GPL-2.0",
    "d4b2c0998dcae6c15be852e505a1a7764cb89027fc516ad98fa049ae489141e4": "GPL-3.0",
    "3b1f538724cd7d3f88494f85230c2040f545b1b4ad4c254d89ef6a6632cd8ee7": "GPL-3.0",
    "e9ae2aa4635c6ee1c86d43e4dd5d54b7ac2a876de32894dbb9bf8d95c2b9c696": "GPL-3.0",
    "3048b8f949b5c3515bbff60831ca30a05bc2a6e0034e35eb2f7afb188d25fad3": "LGPL-2.0",
    "c836cc95f41a54a50ba9cf80cf6d8363cd7666bbc6f44d5af72d742107c3cd54": "LGPL-2.1",
    "a00b7bb2f16f7bcaf8af37716bdc1d76d5980438eacda785bdc05416a7927244": "LGPL-3.0",
    "38dfd1459422b7d72e6037e88384449b8b399cb79712b8659f005cf3df10464e": "MPL-1.1",
    "275b7fdaa7084fdb9a7110f008120be9c15ea5372b4a9e033a222574c6487674": "MPL-2.0",
    "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c": "0BSD",
    "7a4d92cdb11d254973a073803be1148a5402f1b2ca67808cdb3ef78b596102cd": "Unlicense",
    "0f9cf9ea24fff05333ff965b7fc31b279cb2e8a6d79ad2f197c5cab1901030f7": "BlueOak-1.0.0",
}
# Headings a licence text may carry or leave out, in canonical form.
TITLES = [
    "mit license", "mit expat license", "expat license", "isc license", "zlib license", "zlib libpng license",
    "bsd 2 clause license", "bsd 2 clause simplified license", "simplified bsd license",
    "bsd 3 clause license", "bsd 3 clause new or revised license", "new bsd license", "modified bsd license",
    "bsd license", "apache license", "gnu general public license", "gnu lesser general public license",
    "gnu library general public license", "gnu affero general public license", "mozilla public license version 2 0",
    "boost software license version 1 0", "unlicense", "creative commons legal code", "license",
]
# Names of licences in notices, in canonical form. A name that ends in "-" takes its version.
_VERSION = (r"(?: license)?(?: [al]?gpl| mpl)?(?: as published by the free software foundation)?(?: either)?"
            r"(?: v| version)? ?([0-9])(?: ([0-9]))?(?: license)?")
NOTICES = [
    ("MIT", r"(?:mit|expat|mit expat|mit x11) license"),
    ("ISC", r"isc license"),
    ("Zlib", r"(?:zlib|zlib libpng) license"),
    ("BSD-2-Clause", r"(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: license)?"),
    ("BSD-3-Clause", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: license)?"),
    ("Unlicense", r"unlicense"),
    ("CC0-1.0", r"(?:cc0|creative commons zero|creative commons cc0)(?: 1 0)?(?: v1 0)?(?: universal)?(?: license)?"),
    ("Apache-", r"apache(?: software)?" + _VERSION),
    ("AGPL-", r"(?:affero general public license|affero gpl|agpl)" + _VERSION),
    ("LGPL-", r"(?:lesser general public license|library general public license|lesser gpl|lgpl)" + _VERSION),
    ("GPL-", r"(?:general public license|gpl)" + _VERSION),
    ("MPL-", r"(?:mozilla public license|mpl)" + _VERSION),
    ("EPL-", r"(?:eclipse public license|epl)" + _VERSION),
    ("BSL-", r"(?:boost software license|bsl)" + _VERSION),
    ("CC-BY-NC-SA-", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)" + _VERSION),
    ("CC-BY-NC-ND-", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)" + _VERSION),
    ("CC-BY-NC-", r"(?:cc by nc|creative commons attribution non ?commercial)" + _VERSION),
    ("CC-BY-SA-", r"(?:cc by sa|creative commons attribution share ?alike)" + _VERSION),
    ("CC-BY-ND-", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)" + _VERSION),
    ("CC-BY-", r"(?:cc by|creative commons attribution)" + _VERSION),
]
# Identifiers after "SPDX-License-Identifier" that differ from the names above.
SPDX_ONLY = [("MIT", "mit"), ("ISC", "isc"), ("Zlib", "zlib")]
# Spellings taken as equal, after punctuation has gone.
SPELLINGS = [
    ("licence", "license"), ("organisation", "organization"), ("authorisation", "authorization"),
    ("favour", "favor"), ("honour", "honor"), ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"), ("non infringement", "noninfringement"), ("per cent", "percent"),
    ("whilst", "while"), ("wilful", "willful"), ("sub license", "sublicense"),
    ("copyright owner", "copyright holder"), ("copyright holders", "copyright holder"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A line of the text that only happens to begin with the word "copyright" is kept.
COPYRIGHT_LINE = (r"(^|\n)[ \t#*/;-]*(?:(?:portions )?copyright[ \t:]*(?:\(c\)|©|[0-9]|[<{\[]|by |"
                  r"[^\n]{0,80}(?:\binc\b|\bllc\b|\bltd\b|\bgmbh\b|<|@))|\(c\) |©|all rights reserved)[^\n]*")
PUNCTUATION = "[!-/:-@\\[-`{-~‘’“”–—…]+"
#: Numbers of clauses, and the name a clause against endorsement is written with.
NUMBERS = "(?: [0-9])+ "
OWNER, OWNED = "neither the names? of .{1,80}? nor the names of", "neither the name of the copyright holder nor the names of"
TITLE = "^ (?:the )?(?:" + "|".join(sorted(TITLES, key=len, reverse=True)) + ")(?: (?:mit|isc|zlib))? "
#: A grant and what it names; texts end in a blank, so a name ends where a word does.
NOTICE = ("(?:(?:under|by)(?: the)?(?: terms(?: and conditions)? of)?(?: the)?(?: gnu)? (?:"
          + "|".join(f"(?:{r})" for _, r in NOTICES) + ")|spdx license identifier (?:"
          + "|".join(r for _, r in [*SPDX_ONLY, *NOTICES]) + ")) ")


def canonical(text: Column) -> Column:
    """The canonical form of a text, in one line."""
    text = F.regexp_replace(F.translate(text, UPPER, LOWER), COPYRIGHT_LINE, "\n")
    text = F.regexp_replace(F.regexp_replace(text, PUNCTUATION, " "), r"[\x20\x09-\x0D]+", " ")
    for one, other in SPELLINGS:
        text = F.replace(text, F.lit(one), F.lit(other))
    return F.trim(text)


def digest(text: Column) -> Column:
    """SHA-256 of a canonical text without a licence's heading, list numbers and owner's name."""
    text = F.regexp_replace(F.concat(F.lit(" "), text, F.lit(" ")), TITLE, " ")
    text = F.regexp_replace(F.regexp_replace(text, NUMBERS, " "), OWNER, OWNED)
    return F.sha2(F.trim(text), 256)


def _named(phrase: Column) -> Column:
    """The licence that a notice names: the first whose words it holds."""
    parts = [F.regexp_extract(phrase, r"([0-9])(?: ([0-9]))?(?: license)? $", i) for i in (1, 2)]
    version = F.concat(parts[0], F.lit("."), F.when(parts[1] == "", "0").otherwise(parts[1]))
    found = F.lit(None).cast("string")
    for name, words in reversed([*NOTICES, *SPDX_ONLY]):
        made = F.concat(F.lit(name), version) if name.endswith("-") else F.lit(name)
        found = F.when(phrase.rlike(f" (?:{words}) $"), made).otherwise(found)
    return found


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         licences: dict[str, str] = LICENCES, digests: dict[str, str] = DIGESTS) -> DataFrame:
    """doc_id, canonical_sha256, licence of the whole text, number and names of notices.

    ``licences`` maps names to texts, ``digests`` digests to names; both are
    bounded by what the caller writes down, and the join holds them whole.
    """
    spark = docs.sparkSession
    texts = spark.createDataFrame(list(licences.items()), "licence string, text string")
    known = texts.select(digest(canonical(F.col("text"))).alias("digest"), "licence").unionByName(
        spark.createDataFrame(list(digests.items()), "digest string, licence string"))
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                       canonical(whole(f"`{text_column}`")).alias("text"))
    phrases = F.regexp_extract_all(F.concat("text", F.lit(" ")), F.lit(NOTICE), F.lit(0))
    rows = rows.select("doc_id", digest(F.col("text")).alias("digest"), phrases.alias("phrases"))
    held = F.array_sort(F.array_distinct(F.transform(F.array_distinct("phrases"), _named)))
    return rows.select("doc_id", "digest", held.alias("held")).join(known, "digest", "left").select(
        "doc_id", F.col("digest").alias("canonical_sha256"), "licence",
        F.size("held").cast("long").alias("n_notices"), F.array_join("held", ",").alias("notices"))


def _sql_canonical(text: str) -> str:
    text = f"regexp_replace(translate({text}, '{UPPER}', '{LOWER}'), '{COPYRIGHT_LINE}', chr(10), 'g')"
    text = f"regexp_replace(regexp_replace({text}, '{PUNCTUATION}', ' ', 'g'), '[\\x20\\x09-\\x0D]+', ' ', 'g')"
    for one, other in SPELLINGS:
        text = f"replace({text}, '{one}', '{other}')"
    return f"trim({text})"


def _sql_digest(text: str) -> str:
    text = f"regexp_replace(' ' || {text} || ' ', '{TITLE}', ' ')"
    return f"sha256(trim(regexp_replace(regexp_replace({text}, '{NUMBERS}', ' ', 'g'), '{OWNER}', '{OWNED}', 'g')))"


def _sql_named(phrase: str) -> str:
    tail = r"([0-9])(?: ([0-9]))?(?: license)? $"
    parts = [f"regexp_extract({phrase}, '{tail}', {i})" for i in (1, 2)]
    version = f"{parts[0]} || '.' || CASE {parts[1]} WHEN '' THEN '0' ELSE {parts[1]} END"
    cases = " ".join(
        f"WHEN regexp_matches({phrase}, ' (?:{words}) $') THEN '{name}'"
        + (f" || {version}" if name.endswith("-") else "") for name, words in [*NOTICES, *SPDX_ONLY])
    return f"CASE {cases} END"


def _sql_values(pairs: dict[str, str]) -> str:
    quoted = [tuple(x.replace("'", "''") for x in p) for p in pairs.items()]
    return ", ".join(f"('{a}', '{b}')" for a, b in quoted)


OP3_SQL = f"""
WITH licences AS (
  SELECT name AS licence, {_sql_digest(_sql_canonical('text'))} AS digest
  FROM (VALUES {_sql_values(LICENCES)}) AS l(name, text)
  UNION ALL SELECT name, digest FROM (VALUES {_sql_values(DIGESTS)}) AS d(digest, name)),
own AS (SELECT row_number() OVER () AS r, doc_id, {_sql_canonical("coalesce(text, '')")} AS text FROM documents),
held AS (
  SELECT r, count(DISTINCT name) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names
  FROM (SELECT r, {_sql_named('phrase')} AS name
        FROM (SELECT r, unnest(regexp_extract_all(text || ' ', '{NOTICE}')) AS phrase FROM own)) GROUP BY r)
SELECT doc_id, o.digest AS canonical_sha256, licence, coalesce(n, 0) AS n_notices, coalesce(names, '') AS notices
FROM (SELECT r, doc_id, {_sql_digest('text')} AS digest FROM own) o
LEFT JOIN licences l ON l.digest = o.digest LEFT JOIN held USING (r)
"""


@query("op3_license_scan", OP3_SQL)
def op3(spark, sf_dir):
    """Licence and notices of every document."""
    return scan(table(spark, sf_dir, "documents"))
