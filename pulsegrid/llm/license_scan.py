"""License scans by canonical digest lookup, built from DataFrame functions only.

A text is brought to one canonical form: lower case, no copyright lines, punctuation and
white space as single spaces, equivalent spellings made one. The digest of the whole form is
looked up among the digests of known licence texts and notices, which took the same road. The
same lookup is made for every paragraph and every line as a whole, so a notice set on its own
line or in its own paragraph of a longer document is found too.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

# --- Fixed values: licence names, notice sentences and short licence texts. ---------------

NAMES = {
    "MIT": ["MIT License", "MIT Licence"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 License"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "ISC": ["ISC License"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
}

SENTENCES = [
    "Licensed under {the}{name}.", "Released under {the}{name}.", "Distributed under {the}{name}.",
    "This work is licensed under {the}{name}.", "This project is licensed under {the}{name}.",
    "This software is released under {the}{name}.",
]

TEXTS = {
    "MIT": """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
""",
    "ISC": """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
""",
    "BSD-2-Clause": """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
""",
    "Unlicense": """
This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity
of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>
""",
    "Zlib": """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution.
""",
    "Apache-2.0": """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.
""",
    "GPL-3.0": """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>.
""",
}

TEXTS["BSD-3-Clause"] = TEXTS["BSD-2-Clause"].replace("\n\nTHIS SOFTWARE IS", """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

THIS SOFTWARE IS""")

# Title lines that LICENSE files put before the text.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "BSD-2-Clause": [
        "BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License",
        "FreeBSD License", "BSD License"],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License",
        "Modified BSD License", "Revised BSD License", "BSD License"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}

# (licences, pattern of a passage, what stands there in other editions): each edition is known as well.
EDITIONS = [
    (["BSD-2-Clause", "BSD-3-Clause", "Zlib"], r"(?m)^[0-9]\. ", "* "),
    (["BSD-2-Clause", "BSD-3-Clause"], r"COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR"),
    (["ISC"], r"and/or distribute", "and distribute"),
    (["Unlicense"], r"<https://unlicense\.org>", "<http://unlicense.org>"),
    (["Unlicense"], r"<https://unlicense\.org>", "<http://unlicense.org/>"),
]

# Canonical form: (pattern, replacement), applied in this order to the lower-cased text. Both
# regular-expression dialects in use (Java's and RE2) read these alike.
RULES = [
    # Wrapped lines of a text may begin with these words too: marked, so that they are no copyright lines.
    (r"copyright[ \t]+(holder|notice|owner|interest|law|licen|protect|in |or |and |is |are )", r"copyright-$1"),
    (r"(^|\n)[^\p{L}\p{N}\n]*(copyright|\(c\)|©)[^\n]*([0-9]{4}|\(c\)|©)[^\n]*", r"$1"),  # copyright lines
    (r"(^|\n)[^\p{L}\p{N}\n]*copyright(:|[ \t])[ \t]*[\p{L}<\[{][^\n]*", r"$1"),  # those without a year
    (r"(^|\n)[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*(\n|$)", r"$1"),
    (r"[^\p{L}\p{N}\n]+", " "),  # punctuation and white space, lines kept apart
    (r"https? www", "www"),
    (r"licenc", "licens"),  # equivalent spellings
    (r"(non|sub) (infring|licens)", "$1$2"),
    (r"dgement", "dgment"),
    (r"our( |\n|$)", "or$1"),
    (r"is(e|ed|es|ing|ation|ations)( |\n|$)", "iz$1$2"),
]
BLANK_LINE = r"\n[ \n]*\n"


def known_texts() -> list[tuple[str, str]]:
    """(licence, text): the notices that the sentences make of the names, and the texts in
    their editions, without a title and with each."""
    notices = {
        (licence, s.format(the=the, name=name))
        for licence, names in NAMES.items() for name in names for s in SENTENCES for the in ("", "the ")
    }
    texts = {(k, v.strip()) for k, v in TEXTS.items()}
    for licences, passage, other in EDITIONS:
        texts |= {(k, re.sub(passage, other, t)) for k, t in texts if k in licences}
    titled = {(k, f"{title}\n\n{t}") for k, t in texts for title in TITLES.get(k, ())}
    return sorted(notices) + sorted(texts | titled)


def canonical(text: Column) -> Column:
    """The canonical form, lines still apart; null as empty."""
    out = F.lower(F.coalesce(text, F.lit("")))
    for pattern, replacement in RULES:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def _joined(part: Column) -> Column:
    return F.trim(F.regexp_replace(part, r"[ \n]+", " "))


def _sha(part: Column) -> Column:
    return F.sha2(part.cast("binary"), 256)


def known_digests(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    """(digest, licence): of equal digests the licence first by name. As long as ``known``,
    a list in the program, so it may be broadcast."""
    table = spark.createDataFrame(known, "licence string, text string")
    return table.groupBy(_sha(_joined(canonical(F.col("text")))).alias("digest")).agg(F.min("licence").alias("licence"))


def scan(df: DataFrame, known: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every row of ``df``: ``id_col``, text_digest, whole_license (the licence
    that the entire text is, else null), licenses (sorted list of those that the text, one of
    its paragraphs or one of its lines is), n_parts (distinct matching parts).

    A null or empty text, and one without letters or digits, matches nothing. Repeated rows
    and null ids come out as they came in; other columns are not read.
    """
    spark = df.sparkSession
    table = known_digests(spark, known if known is not None else known_texts())
    digests = F.array(*(F.lit(r.digest) for r in table.select("digest").collect())).cast("array<string>")
    lines = F.transform(F.split("form", "\n"), lambda x: F.trim(x))
    paragraphs = F.transform(F.split("form", BLANK_LINE), _joined)
    parts = F.filter(F.array_union(lines, paragraphs), lambda x: x != "")
    read = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
        canonical(F.col(f"`{text_col}`")).alias("form"))
    hashed = read.select(
        "row", "id", _sha(_joined(F.col("form"))).alias("text_digest"),
        F.transform(parts, _sha).alias("parts"))
    hits = hashed.select(
        "row", "id", "text_digest",
        F.explode_outer(F.array_intersect(F.array_union("parts", F.array("text_digest")), digests)).alias("digest"))
    joined = hits.join(F.broadcast(table), "digest", "left")
    return joined.groupBy("row", "id", "text_digest").agg(
        F.max(F.when(F.col("digest") == F.col("text_digest"), F.col("licence"))).alias("whole_license"),
        F.array_sort(F.collect_set("licence")).alias("licenses"),
        F.count("licence").alias("n_parts"),
    ).select(F.col("id").alias(id_col), "text_digest", "whole_license", "licenses", "n_parts")


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    return found.withColumn("licenses", F.array_join("licenses", ","))


def _sql_form(text: str) -> str:
    out = f"lower(coalesce({text}, ''))"
    for pattern, replacement in RULES:
        back = replacement.replace("$", "\\")
        out = f"regexp_replace({out}, '{pattern}', '{back}', 'g')"
    return out


_SQL_JOINED = r"trim(regexp_replace({}, '[ \n]+', ' ', 'g'), ' ')"
_VALUES = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in known_texts())

OP10_SQL = rf"""
WITH known AS (
  SELECT sha256({_SQL_JOINED.format(_sql_form('text'))}) AS digest, min(licence) AS licence
  FROM (VALUES {_VALUES}) AS v(licence, text) GROUP BY 1
), forms AS (
  SELECT doc_id, {_sql_form('text')} AS form FROM documents
), parts AS (
  SELECT DISTINCT doc_id, sha256(part) AS digest FROM (
    SELECT doc_id, trim(unnest(string_split(form, chr(10))), ' ') AS part FROM forms
    UNION ALL SELECT doc_id, {_SQL_JOINED.format("unnest(regexp_split_to_array(form, '" + BLANK_LINE + "'))")} FROM forms
    UNION ALL SELECT doc_id, {_SQL_JOINED.format('form')} FROM forms
  ) WHERE part <> ''
), found AS (
  SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licenses, count(*) AS n_parts
  FROM parts JOIN known USING (digest) GROUP BY 1
)
SELECT f.doc_id, sha256({_SQL_JOINED.format('form')}) AS text_digest,
       k.licence AS whole_license, coalesce(licenses, '') AS licenses, coalesce(n_parts, 0) AS n_parts
FROM forms f LEFT JOIN found USING (doc_id)
LEFT JOIN known k ON k.digest = sha256({_SQL_JOINED.format('form')})
"""
