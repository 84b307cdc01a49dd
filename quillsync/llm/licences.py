"""Licence scans: canonical digest lookup of entire texts.

Native: DataFrame and SQL functions only.

A text is made canonical: lower case, copyright lines and "all rights
reserved" removed, equivalent spellings unified, every run of characters other
than letters and digits one space (so comment marks go).  The SHA-256 digest of the
canonical text is looked up in a table of known digests.  The entire texts looked up are
the document as a whole, each of its paragraphs and lines, and each run of up to
``PARAGRAPHS`` paragraphs no longer than the longest known text, so a licence that
is a document, a closing line or a few paragraphs of a file is found; no part of a line is.

A copyright line begins, perhaps after comment marks, with the word, the sign or a "(c)" before a
year, and goes on with a year or a holder; "copyright notice", "copyright holders be liable" and
the like are text (``_ABOUT``), wherever a licence is wrapped.

The known table is fixed and small (``KNOWN``), so it is broadcast; a table passed
by the caller (:func:`digests` makes one of licence texts) is joined without a hint.
A digest that stands for several licences gives them all, joined by " OR ".

Null or blank text: the digest of nothing, no licence.  Every row is returned,
also with a null or repeated doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# equivalent spellings, the second standing for both: fixed values, in canonical form
EQUIVALENT = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("calibre", "caliber"), ("cancelled", "canceled"), ("catalogue", "catalog"), ("centre", "center"),
    ("copyright owner", "copyright holder"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"),
    ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"), ("non commercial", "noncommercial"),
    ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("per cent", "percent"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("sub license", "sublicense"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
]

# licence texts and notices: fixed values
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice shall be included in all copies
or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
"""
_ZERO_BSD = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee " \
            "is hereby granted."
_AUTHOR_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING
OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software. Permission is granted to
anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be
misrepresented; you must not claim that you wrote the original software. If you use this software in a
product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered
source versions must be plainly marked as such, and must not be misrepresented as being the original
software. 3. This notice may not be removed or altered from any source distribution."""
_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: """
_BSD_SOURCE = """Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. """
_BSD_BINARY = """Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the distribution. """
_BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission. """
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
_BSD_2 = _BSD_GRANT + "1. " + _BSD_SOURCE + "2. " + _BSD_BINARY + _BSD_WARRANTY
_BSD_2_BULLETS = _BSD_GRANT + _BSD_SOURCE + _BSD_BINARY + _BSD_WARRANTY
_BSD_3 = _BSD_GRANT + "1. " + _BSD_SOURCE + "2. " + _BSD_BINARY + "3. " + _BSD_NAMES + _BSD_WARRANTY
_BSD_3_BULLETS = _BSD_GRANT + _BSD_SOURCE + _BSD_BINARY + _BSD_NAMES + _BSD_WARRANTY
_BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
software and accompanying documentation covered by this license (the "Software") to use, reproduce, display,
distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit
third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in
the Software and this entire statement, including the above license grant, this restriction and the following
disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the
Software, unless such copies or derivative works are solely in the form of machine-executable object code
generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS
OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE,
TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE
FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright
laws, the author or authors of this software dedicate any and all copyright interest in the software to the public
domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future
rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to """
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at {url} Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES
OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License."""
_MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at {url}"""
_GPL_HEADER = """This program is free software{sign} you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation{version} of the License, or (at your option)
any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License
for more details."""
_GPL_END = " You should have received a copy of the GNU General Public License along with this program. If not, see "

KNOWN = [
    ("MIT", "text", _MIT), ("MIT", "text", "MIT License " + _MIT), ("MIT", "text", "The MIT License (MIT) " + _MIT),
    ("ISC", "text", _ISC + _AUTHOR_WARRANTY), ("ISC", "text", "ISC License " + _ISC + _AUTHOR_WARRANTY),
    ("0BSD", "text", _ZERO_BSD + " " + _AUTHOR_WARRANTY), ("Zlib", "text", _ZLIB),
    ("Zlib", "text", "zlib License " + _ZLIB),
    ("MIT", "notice", "Released under the MIT License."), ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "notice", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("Apache-2.0", "notice", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "notice", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "notice", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "notice", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "notice", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "notice", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "notice", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "notice", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "notice", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "notice", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL-2.0", "notice", "SPDX-License-Identifier: MPL-2.0"),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "notice", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "notice", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "notice", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "notice", "This work is licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "notice", "Released under CC0 1.0."),
    ("BSD-2-Clause", "text", _BSD_2), ("BSD-2-Clause", "text", "BSD 2-Clause License " + _BSD_2),
    ("BSD-2-Clause", "text", _BSD_2_BULLETS), ("BSD-3-Clause", "text", _BSD_3),
    ("BSD-3-Clause", "text", "BSD 3-Clause License " + _BSD_3), ("BSD-3-Clause", "text", _BSD_3_BULLETS),
    ("BSL-1.0", "text", _BOOST), ("BSL-1.0", "text", "Boost Software License - Version 1.0 - August 17th, 2003 " + _BOOST),
    ("Unlicense", "text", _UNLICENSE + "<https://unlicense.org>"), ("Unlicense", "text", _UNLICENSE + "<http://unlicense.org/>"),
    ("Apache-2.0", "header", _APACHE_HEADER.format(url="http://www.apache.org/licenses/LICENSE-2.0")),
    ("Apache-2.0", "header", _APACHE_HEADER.format(url="https://www.apache.org/licenses/LICENSE-2.0")),
    ("MPL-2.0", "header", _MPL_HEADER.format(url="https://mozilla.org/MPL/2.0/.")),
    ("MPL-2.0", "header", _MPL_HEADER.format(url="http://mozilla.org/MPL/2.0/.")),
    ("GPL-3.0-or-later", "header", _GPL_HEADER.format(sign=":", version=", either version 3")),
    ("GPL-3.0-or-later", "header", _GPL_HEADER.format(sign=":", version=", either version 3") + _GPL_END
     + "<https://www.gnu.org/licenses/>."),
    ("GPL-3.0-or-later", "header", _GPL_HEADER.format(sign=":", version=", either version 3") + _GPL_END
     + "<http://www.gnu.org/licenses/>."),
    ("GPL-2.0-or-later", "header", _GPL_HEADER.format(sign=";", version="; either version 2")),
]

# what a copyright line begins with after comment marks, and how lines of a licence's text go on that begin so
_MARKS = "^[ #/*;%!<>\"'-]*"
_COPYRIGHT = _MARKS + "(spdx-filecopyrighttext|©|\\(c\\) *[0-9]{4}|copyright *[:(©0-9]|copyright +[\\p{L}\\[<{\"'])"
_ABOUT = _MARKS + ("copyright +(act|and|as|for|holders?|in|interests?|is|laws?|licen[cs]es?|notices?|of|or|owners?"
                   "|protection|rights?|statements?|to|treaty)([^\\p{L}\\p{N}]|$)")
_RESERVED = "all rights reserved\\.?"
_OTHER = "[^\\p{L}\\p{N}]+"

# paragraphs of a run at most; characters of one: no canonical known text is longer, as a spelling gains
# a letter in ten at most
PARAGRAPHS = 8
RUN_CHARS = max(len(" ".join(t.split())) for _, _, t in KNOWN) * 11 // 10


def canonical(line: Column) -> Column:
    """Canonical form of a line of lower-case text; nothing of a copyright line."""
    plain = F.when(line.rlike(_COPYRIGHT) & ~line.rlike(_ABOUT), F.lit("")).otherwise(line)
    # two spaces between words, so that neighbours do not share one
    x = F.concat(F.lit(" "), F.regexp_replace(F.regexp_replace(plain, _RESERVED, " "), _OTHER, "  "), F.lit(" "))
    for other, kept in EQUIVALENT:
        x = F.replace(x, F.lit(f" {other.replace(' ', '  ')} "), F.lit(f" {kept.replace(' ', '  ')} "))
    return F.trim(F.regexp_replace(x, " +", " "))


def digests(texts: DataFrame) -> DataFrame:
    """(digest, license_id) of licence texts (license_id, text), each taken as one line, one row a digest."""
    line = F.lower(F.trim(F.regexp_replace("text", "\\s+", " ")))
    return _distinct(texts.select(F.sha2(canonical(line), 256).alias("digest"), "license_id"))


def _distinct(table: DataFrame) -> DataFrame:
    return table.where("digest IS NOT NULL AND license_id IS NOT NULL").groupBy("digest").agg(
        F.array_join(F.sort_array(F.collect_set(F.col("license_id").cast("string"))), " OR ").alias("license_id"))


def known(spark: SparkSession) -> DataFrame:
    """(digest, license_id) of the known texts."""
    return digests(spark.createDataFrame([(i, t) for i, _, t in KNOWN], "license_id string, text string"))


def _runs(paragraphs: Column, most: int, chars: int) -> Column:
    """Digests of all runs of 2 to ``most`` paragraphs of at most ``chars`` characters."""
    def run(i: Column, k: Column) -> Column:
        part = F.slice(paragraphs, i, k)
        length = F.aggregate(part, k - 1, lambda n, x: n + F.length(x))
        return F.when((i + k - 1 <= F.size(paragraphs)) & (length <= chars), F.sha2(F.array_join(part, " "), 256))

    sizes = F.sequence(F.lit(2), F.lit(most))
    starts = F.when(F.size(paragraphs) >= 2, F.sequence(F.lit(1), F.size(paragraphs) - 1)) \
        .otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(starts, lambda i: F.filter(F.transform(sizes, lambda k: run(i, k)), lambda x: x.isNotNull())))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table: DataFrame | None = None,
         paragraphs: int = PARAGRAPHS, run_chars: int = RUN_CHARS) -> DataFrame:
    """(id, digest, license_id, notices, n_notices) of every row: the canonical digest of the
    whole text and its licence (null if none), the licences that whole paragraphs, runs of
    them or lines are (sorted, comma-joined; empty if none), and how many distinct
    such texts there are.  ``paragraphs`` and ``run_chars`` bound the runs: a table of longer texts needs larger ones.

    A row's parts are put together again by a number of its own, so rows that
    share an id stay apart; they are aggregated before they are shuffled.
    """
    small = F.broadcast(known(docs.sparkSession)) if table is None else _distinct(table)
    text = F.regexp_replace(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), "[\\t\\r\\f]", " ")
    # a generator over one value: the canonical lines are made once, however often they are used
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                       F.explode(F.array(F.transform(F.split(text, "\n"), canonical))).alias("lines"))
    # a paragraph is a run of lines that are not blank
    breaks = F.transform("lines", lambda x: F.when(x == "", "\n").otherwise(x))
    apart = F.filter(F.transform(F.split(F.array_join(breaks, " "), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    rows = rows.select("id", "row", "lines", F.explode(F.array(apart)).alias("paras"))
    texts = F.filter(F.array_distinct(F.concat("lines", "paras")), lambda x: x != "")
    parts = F.array_distinct(F.concat(F.transform(texts, lambda x: F.sha2(x, 256)),
                                      _runs(F.col("paras"), paragraphs, run_chars)))
    whole = F.sha2(F.array_join(F.filter("lines", lambda x: x != ""), " "), 256)
    part = rows.select("id", "row", whole.alias("whole"), F.explode_outer(parts).alias("digest"))
    found = part.join(small, "digest", "left")
    return found.groupBy("row", "id", "whole").agg(
        F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("notices"),
        F.count("license_id").alias("n_notices")) \
        .withColumnRenamed("whole", "digest").join(small, "digest", "left") \
        .select(F.col("id").alias(id_col), "digest", "license_id", "notices", "n_notices")


def oracle_sql() -> str:
    """The same over a view ``documents``, in DuckDB's SQL, by rows: lines, words and paragraphs are
    rows of their own.  It shares the fixed values (licences, spellings) and none of the patterns."""
    def lit(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    marks = lit(" #/*;%!<>-\"'")
    texts = ", ".join(f"({lit(i)}, {lit(' '.join(t.split()))})" for i, _, t in KNOWN)
    single = ", ".join(f"({lit(a)}, {lit(b)})" for a, b in EQUIVALENT if " " not in a)
    pairs = ", ".join(f"({lit(a.split()[0])}, {lit(a.split()[1])}, {lit(b)})" for a, b in EQUIVALENT if " " in a)
    return f"""
WITH single(a, b) AS (VALUES {single}), pairs(a1, a2, b) AS (VALUES {pairs}),
texts AS (SELECT row_number() OVER () AS k, license_id, lower(t) AS t FROM (VALUES {texts}) x(license_id, t)),
docs AS (SELECT row_number() OVER () AS r, doc_id, translate(lower(coalesce(text, '')), chr(9) || chr(13) || chr(12), '   ') AS t
         FROM documents),
ls AS (SELECT r, doc_id, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS n FROM docs
       UNION ALL SELECT -k, -k, t, 1 FROM texts),
bare AS (SELECT *, ltrim(l, {marks}) AS b FROM ls),
told AS (SELECT *, string_split(ltrim(substr(b, 10)), ' ')[1] AS after FROM bare),
kept AS (SELECT r, doc_id, n, CASE
    WHEN starts_with(b, 'spdx-filecopyrighttext') OR starts_with(b, '©') THEN ''
    WHEN starts_with(b, '(c)') AND regexp_full_match(substr(ltrim(substr(b, 4), ' '), 1, 4), '[0-9]{{4}}') THEN ''
    WHEN NOT starts_with(b, 'copyright') THEN l
    WHEN contains(':(©0123456789', substr(ltrim(substr(b, 10), ' '), 1, 1)) AND ltrim(substr(b, 10), ' ') <> '' THEN ''
    WHEN substr(b, 10, 1) <> ' ' OR NOT regexp_matches(after, '^[\\pL\\x5B<{{"'']') THEN l
    WHEN regexp_extract(after, '^[\\pL\\pN]+') IN ('act', 'and', 'as', 'for', 'holder', 'holders', 'in', 'interest', 'interests',
        'is', 'law', 'laws', 'licence', 'licences', 'license', 'licenses', 'notice', 'notices', 'of', 'or', 'owner', 'owners',
        'protection', 'right', 'rights', 'statement', 'statements', 'to', 'treaty') THEN l
    ELSE '' END AS l FROM told),
words AS (SELECT r, n, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (
    SELECT r, n, regexp_extract_all(replace(l, 'all rights reserved', ' '), '[\\pL\\pN]+') AS w FROM kept)),
spelt AS (SELECT r, n, i, coalesce(b, w) AS w FROM words LEFT JOIN single ON a = w),
next AS (SELECT *, lead(w) OVER (PARTITION BY r, n ORDER BY i) AS w2 FROM spelt),
joined AS (SELECT next.*, p.b, lag(p.b) OVER (PARTITION BY r, n ORDER BY i) AS taken
           FROM next LEFT JOIN pairs p ON p.a1 = w AND p.a2 = w2),
lines AS (SELECT r, n, string_agg(coalesce(b, w), ' ' ORDER BY i) AS l FROM joined WHERE taken IS NULL GROUP BY r, n),
known AS (SELECT sha256(l) AS digest, string_agg(DISTINCT license_id, ' OR ' ORDER BY license_id) AS license_id
          FROM lines JOIN texts ON r = -k GROUP BY 1),
whole AS (SELECT kept.r, any_value(doc_id) AS doc_id, sha256(coalesce(string_agg(lines.l, ' ' ORDER BY kept.n), '')) AS digest
          FROM kept LEFT JOIN lines USING (r, n) WHERE kept.r > 0 GROUP BY kept.r),
numbered AS (SELECT kept.r, kept.n, lines.l,
                    count(*) FILTER (lines.l IS NULL) OVER (PARTITION BY kept.r ORDER BY kept.n) AS gap
             FROM kept LEFT JOIN lines USING (r, n) WHERE kept.r > 0),
paras AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY gap) AS p, string_agg(l, ' ' ORDER BY n) AS t
          FROM numbered WHERE l IS NOT NULL GROUP BY r, gap),
runs AS (SELECT a.r, string_agg(z.t, ' ' ORDER BY z.p) OVER (PARTITION BY a.r, a.p ORDER BY z.p) AS t
         FROM paras a JOIN paras z ON z.r = a.r AND z.p BETWEEN a.p AND a.p + {PARAGRAPHS - 1}),
parts AS (SELECT r, sha256(l) AS digest FROM lines WHERE r > 0 UNION SELECT r, sha256(t) FROM runs),
hits AS (SELECT r, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices, count(*) AS n
         FROM parts JOIN known USING (digest) GROUP BY r)
SELECT doc_id, w.digest, k.license_id, coalesce(notices, '') AS notices, coalesce(n, 0) AS n_notices
FROM whole w LEFT JOIN known k ON k.digest = w.digest LEFT JOIN hits h ON h.r = w.r"""
