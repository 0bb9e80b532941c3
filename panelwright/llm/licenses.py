"""License scans by canonical digest lookup, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.common import settled

#: Runs that count as one blank (fixed values): all of ASCII but letters, digits and line ends, and common typography.
BLANKS = "[^a-z0-9\\n\\x{80}-\\x{10FFFF}‘’“”–—•«»· ]+|[‘’“”–—•«»· ]+"
#: What a line that states a copyright says, in lower case.
SAYS = ("copyright", "(c)", "©", "all rights reserved")
#: Words behind "copyright" that speak of one and do not state it, so that wrapped licence texts keep their lines.
SPEAKS = "notices?|holders?|owners?|laws?|licen[cs]es?|statements?|and|or|in|of|to|is|are|act"
#: Marks that may stand before a line, and the line that states a copyright: by a sign, a year or a name in capitals.
MARKS = "[ \\t#*/;!<>-]*"
COPYRIGHT = (
    f"(^|\\n){MARKS}(?:(?:(?i:copyright)[ \\t:]*)?(?:\\((?i:c)\\)|©)|(?i:copyright)[ \\t:]+(?i:by )?(?:[0-9<\\[{{]|(?!(?i:{SPEAKS})\\b)\\p{{Lu}})|(?i:all rights reserved))[^\\n]*"
)
#: A number, letter or sign that marks an item of a list, at the beginning of a line or behind a sentence.
ITEM = f"(^|\\n|[:;.,] ){MARKS}\\(?(?:[0-9]{{1,2}}|[a-z]|i{{2,3}})[.)][ \\t]+"
#: A spelling changes the length of a text by less than this factor, and never the first letters of a word.
FACTOR, FIRST = 1.5, 2
#: Equivalent spellings (fixed values), as they stand after blanks have replaced punctuation.
SPELLINGS = (
    ("licence", "license"), ("licencing", "licensing"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("centre", "center"), ("favour", "favor"), ("fulfil ", "fulfill "), ("fulfilment", "fulfillment"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("merchandise", "merchandize"),
    ("modelling", "modeling"), ("non commercial", "noncommercial"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"),
    ("per cent", "percent"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("sub license", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"), ("http ", "https "),
)
NO_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
ISC_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
BSD_TOP = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
BSD_WARRANTY = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
#: Published licence texts (fixed values): identifier, text.
TEXTS = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n" + NO_WARRANTY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + ISC_WARRANTY),
    ("BSD-2-Clause", BSD_TOP + BSD_WARRANTY),
    ("BSD-3-Clause", BSD_TOP + BSD_THIRD + BSD_WARRANTY),
    ("MIT-0", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.\n" + NO_WARRANTY),
    ("BSD-1-Clause", BSD_TOP[: BSD_TOP.index("2. ")] + BSD_WARRANTY),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution."),
    ("BSL-1.0", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:\nThe copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.\nYou should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
)
#: Titles under which those texts are published (fixed values), by identifier.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "MIT-0": ("MIT No Attribution", "MIT No Attribution License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("Zero-Clause BSD", "BSD Zero Clause License", "Zero-Clause BSD License"),
    "BSD-1-Clause": ("BSD 1-Clause License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "Modified BSD License", "BSD License"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng license"),
    "BSL-1.0": ("Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License 1.0"),
}
#: Those texts with and without their titles, and the usual notices that name a licence (fixed values): identifier, text.
KNOWN = (
    *TEXTS, *((name, f"{title}\n{text}") for name, text in TEXTS for title in TITLES.get(name, ())),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."), ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
)


def plain(text: Column) -> Column:
    """Lower case, without copyright lines and marks of lists, runs of punctuation and blanks as one blank; line ends stay."""
    low = F.lower(text)
    says = low.contains(SAYS[0])
    for word in SAYS[1:]:
        says = says | low.contains(word)
    stated = F.when(says, F.lower(F.regexp_replace(text, COPYRIGHT, "$1"))).otherwise(low)
    return F.regexp_replace(F.regexp_replace(stated, ITEM, "$1"), BLANKS, " ")


def spelled(one_line: Column) -> Column:
    """A plain text of one line in one spelling, with single blanks."""
    form = F.concat(F.lit(" "), one_line, F.lit(" "))
    for given, wanted in SPELLINGS:
        form = F.replace(form, F.lit(given), F.lit(wanted))
    return F.trim(F.regexp_replace(form, " +", " "))


def joined(plain_text: Column) -> Column:
    """The lines of a plain text as one."""
    return F.trim(F.regexp_replace(plain_text, "[ \n]*\n[ \n]*", " "))


def canonical(text: Column) -> Column:
    """A text as licences are compared: without copyright lines, case, punctuation and spelling variants."""
    return spelled(joined(plain(text)))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, license, size, start) of the given texts: canonical length and first letters; of equal ones the first by name."""
    rows = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("_t")) for name, text in known])
    listed = spark.range(1).select(F.inline(rows)).select("license", canonical(F.col("_t")).alias("_form")).filter("_form <> ''")
    return listed.groupBy(F.sha2("_form", 256).alias("digest")).agg(
        F.min("license").alias("license"), F.max(F.length("_form")).alias("size"), F.max(F.left("_form", F.lit(FIRST))).alias("start")
    )


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, license, notices array, n_notices): the licence a whole text is, and those its lines name.

    A text, or a line of it, is a licence if its canonical digest is that of a known one;
    texts are compared whole, with no window or similarity. ``license`` is null and
    ``notices`` empty where nothing matches, as for null and empty texts. Every row gives a
    row; rows that share an id share their notices, and null ids have none. Other columns
    are left out.

    One pass brings texts and lines into plain form; only those that begin and are as long
    as some known text could be before respelling, as no other can match, are spelled and
    digested.
    What is joined is a digest a candidate; a list of known licences above Spark's size
    limit is not broadcast.
    """
    # Pairs of letters and digits at most, whatever the number of known texts.
    known_by = {r["start"]: r for r in known.groupBy("start").agg(F.min("size").alias("lo"), F.max("size").alias("hi")).collect()}
    lo, hi = min((r["lo"] for r in known_by.values()), default=1), max((r["hi"] for r in known_by.values()), default=0)

    def fits(form: Column) -> Column:
        return F.left(form, F.lit(FIRST)).isin(sorted(known_by)) & F.length(form).between(lo / FACTOR, hi * FACTOR)

    forms = docs.select(F.col(id_col), plain(F.coalesce(text_col, F.lit(""))).alias("_plain"))
    forms = forms.select(id_col, joined(F.col("_plain")).alias("_whole"), F.filter(F.transform(F.split("_plain", "\n"), lambda line: F.trim(line)), fits).alias("_lines"))
    # Digests of candidates only: small, and read by both lookups.
    found = settled(forms.select(
        id_col, F.when(fits(F.col("_whole")), F.sha2(spelled(F.col("_whole")), 256)).alias("digest"),
        F.transform("_lines", lambda line: F.sha2(spelled(line), 256)).alias("_lines"),
    ))
    listed = known.select("digest", "license")
    lines = found.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.explode("_lines").alias("digest"))
    named = lines.join(listed, "digest")
    notices = named.groupBy("_id").agg(F.sort_array(F.collect_set("license")).alias("notices"), F.count(F.lit(1)).alias("n_notices"))
    whole = found.select(id_col, "digest").join(listed, "digest", "left")
    return whole.join(notices, F.col(id_col) == F.col("_id"), "left").select(
        F.col(id_col), "license", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"), F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices")
    )


def query(spark, sf_dir: str) -> DataFrame:
    from panelwright.llm.common import table

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), known_digests(spark))
    return found.select("doc_id", "license", F.array_join("notices", ",").alias("notices"), "n_notices")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_plain(text: str) -> str:
    """The plain form line by line and with string functions, so that it is not the pattern of ``plain`` again."""
    marks = "' ' || chr(9) || '#*/;!<>-'"
    body = f"ltrim(line, {marks})"
    rest = f"substr({body}, 10)"
    named = f"ltrim({rest}, ' ' || chr(9) || ':')"
    by = f"CASE WHEN starts_with(lower({named}), 'by ') THEN substr({named}, 4) ELSE {named} END"
    spoken = f"regexp_extract(lower({by}), '^[a-z]*')"
    states = (
        f"(starts_with(lower({body}), '(c)') OR starts_with({body}, '©') OR starts_with(lower({body}), 'all rights reserved') OR starts_with(lower({body}), 'copyright') AND ("
        f"starts_with(lower({named}), '(c)') OR starts_with({named}, '©') OR {named} <> {rest} AND ("
        f"substr({by}, 1, 1) IN ('0', '1', '2', '3', '4', '5', '6', '7', '8', '9', '<', '[', '{{') OR regexp_matches({by}, '^\\p{{Lu}}') AND NOT regexp_full_match({spoken}, {_quoted(SPEAKS)}))))"
    )
    kept = f"lower(array_to_string(list_transform(string_split({text}, chr(10)), lambda line: CASE WHEN {states} THEN '' ELSE line END), chr(10)))"
    return f"regexp_replace(regexp_replace({kept}, {_quoted(ITEM)}, '\\1', 'g'), {_quoted(BLANKS)}, ' ', 'g')"


def _sql_digest(plain_text: str) -> str:
    form = f"' ' || trim(regexp_replace({plain_text}, '[ \\n]*\\n[ \\n]*', ' ', 'g'), ' ') || ' '"
    for given, wanted in SPELLINGS:
        form = f"replace({form}, {_quoted(given)}, {_quoted(wanted)})"
    return f"sha256(nullif(trim(regexp_replace({form}, ' +', ' ', 'g'), ' '), ''))"


SQL = f"""
WITH known AS (
    SELECT {_sql_digest("t")} AS digest, min(name) AS license
    FROM (SELECT name, {_sql_plain("t")} AS t FROM (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in KNOWN)}) AS k(name, t)) GROUP BY 1
), plain AS (
    SELECT doc_id, {_sql_plain("text")} AS t FROM documents
), lines AS (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM plain
), notices AS (
    SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n_notices
    FROM (SELECT doc_id, {_sql_digest("line")} AS digest FROM lines) JOIN known USING (digest) GROUP BY doc_id
)
SELECT d.doc_id, k.license, coalesce(n.notices, '') AS notices, coalesce(n.n_notices, 0) AS n_notices
FROM (SELECT doc_id, {_sql_digest("t")} AS digest FROM plain) d LEFT JOIN known k USING (digest) LEFT JOIN notices n USING (doc_id)
"""
