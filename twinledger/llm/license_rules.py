"""Licence scans by sentence rules, DataFrame functions only.

A text is cut into sentences; those that speak of licences are normalised and
looked up among known licence sentences, which gives a sequence of sentence
identifiers (``?`` for an unknown one). Ordered rules, longest first, then
replace runs of identifiers by a licence, so that a full notice counts once
and not as each of its sentences.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import text_of

#: White space, alike in both regex engines.
SPACE = r"[ \t\n\x0B\f\r]"
#: Words by which a normalised sentence speaks of licences.
TRIGGER = "licen[cs]e|copyright|permission|redistribut|warrant|rights reserved|public domain|as is|be liable|copy of the mpl"
#: A colon ends a sentence only before a list of conditions.
SENTENCE_END = r"([.!?;]|conditions:|met:|restrictions:)" + SPACE + "+"
#: Between two pieces of a text: a blank line.
PARTED = r"\n" + SPACE + r"*\n"
GAP = r"[^\p{L}\p{N}]+"
#: What may stand before the name of a licence; it is cut off.
LEAD = (r"^(?:(?:this|the|our) [a-z]+(?: and the accompanying materials)? (?:is|are) |all [a-z]+ (?:is|are) |code |data )?(?:also )?(?:dual )?"
        r"(?:licen[cs]ed|released|distributed|available|published|provided|made available) under (?:the terms of )?(?:the |an? )?")
NEUTRAL = r"^(?:c )?copyright .*|^all rights reserved$"
#: Changes of a lower-cased sentence before, and of a normalised one after, everything but letters and digits is cut out. Holders and
#: references to a file go, so do exceptions behind "with"; versions are written alike; "or later" becomes one word.
BEFORE = ((r"\(see [^()]*\)", ""), (r"([0-9])\+", "$1 orlater"))
AFTER = (
    (r"\bv ?([0-9])", "version $1"), (r"(general public license version [23]) 0\b", "$1"), (r" or (?:any )?later(?: version)?\b", " orlater"),
    (r" with [a-z0-9 ]*exception(?: [0-9]+)*", ""), (r"^(?:.* )?nor the names? of (?:its|the|their|any) contributors", "nor the names of its contributors"),
    (r"^(?:.* )?as is and any express or implied", "as is and any express or implied"), (r"^(?:.* )?be liable for any direct", "be liable for any direct"),
    (LEAD, "under "),
)
#: Between the licences of a choice or a union.
BETWEEN = " (?:and|or) (?:the )?"
SPDX = "spdx license identifier "

# Names of licences as notices write them, normalised, and their SPDX identifiers.
NAMES = {
    "apache license version 2 0": "Apache-2.0",
    "apache license 2 0": "Apache-2.0",
    "apache 2 0 license": "Apache-2.0",
    "mit license": "MIT",
    "isc license": "ISC",
    "zlib license": "Zlib",
    "bsd 2 clause license": "BSD-2-Clause",
    "bsd 3 clause license": "BSD-3-Clause",
    "boost software license version 1 0": "BSL-1.0",
    "mozilla public license version 2 0": "MPL-2.0",
    "mozilla public license 2 0": "MPL-2.0",
    "eclipse public license version 2 0": "EPL-2.0",
    "eclipse public license 2 0": "EPL-2.0",
    "gnu general public license version 2": "GPL-2.0-only",
    "gnu general public license version 3": "GPL-3.0-only",
    "gnu general public license version 2 or later": "GPL-2.0-or-later",
    "gnu general public license version 3 or later": "GPL-3.0-or-later",
    "gnu lesser general public license version 2 1": "LGPL-2.1-only",
    "gnu lesser general public license version 3": "LGPL-3.0-only",
    "gnu affero general public license version 3": "AGPL-3.0-only",
    "cc0 1 0": "CC0-1.0",
    "cc by 4 0": "CC-BY-4.0",
    "cc by sa 4 0": "CC-BY-SA-4.0",
    "cc by nd 4 0": "CC-BY-ND-4.0",
    "cc by nc 4 0": "CC-BY-NC-4.0",
    "cc by nc sa 4 0": "CC-BY-NC-SA-4.0",
    "cc by nc nd 4 0": "CC-BY-NC-ND-4.0",
    "creative commons attribution 4 0 international license": "CC-BY-4.0",
    "creative commons attribution sharealike 4 0 international license": "CC-BY-SA-4.0",
    "creative commons attribution noncommercial 4 0 international license": "CC-BY-NC-4.0",
}
# Former identifiers and short names.
SHORT = {
    "gpl 2 0": "GPL-2.0-only", "gpl 3 0": "GPL-3.0-only", "lgpl 2 1": "LGPL-2.1-only", "lgpl 3 0": "LGPL-3.0-only", "agpl 3 0": "AGPL-3.0-only",
    "lgpl 2 1 or later": "LGPL-2.1-or-later", "lgpl 3 0 or later": "LGPL-3.0-or-later", "agpl 3 0 or later": "AGPL-3.0-or-later",
    "gplv2": "GPL-2.0-only", "gplv3": "GPL-3.0-only", "gpl version 2": "GPL-2.0-only", "gpl version 3": "GPL-3.0-only",
    "gnu gpl version 2": "GPL-2.0-only", "gnu gpl version 3": "GPL-3.0-only", "gnu lesser general public license version 2 1 or later": "LGPL-2.1-or-later",
    "gnu lesser general public license version 3 or later": "LGPL-3.0-or-later", "gnu affero general public license version 3 or later": "AGPL-3.0-or-later",
    "boost software license 1 0": "BSL-1.0", "unlicense": "Unlicense",
}
# Sentences of published licence texts and notices.
SENTENCES = {
    "mit.grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit.notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit.asis": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit.liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc.grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache.named": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache.comply": "you may not use this file except in compliance with the License.",
    "apache.obtain": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache.asis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache.see": "See the License for the specific language governing permissions and limitations under the License.",
    "bsd.grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd.source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd.binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd.endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd.asis": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "bsd.liability": "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "zlib.asis": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib.grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "lgpl21.terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3.terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl.asis": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "lgpl.see": "See the GNU Lesser General Public License for more details.",
    "agpl3.terms": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl.see": "See the GNU Affero General Public License for more details.",
    "epl.terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "gpl3.terms": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2.terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl.asis": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl.see": "See the GNU General Public License for more details.",
    "mpl.terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl.copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense.domain": "This is free and unencumbered software released into the public domain.",
}
#: Tried in order; each is a run of sentence identifiers and the licence it stands for.
RULES = (
    (("mit.grant", "mit.notice", "mit.asis", "mit.liability"), "MIT"),
    (("mit.grant", "mit.notice", "mit.asis"), "MIT"),
    (("mit.grant", "mit.notice"), "MIT"),
    (("mit.grant",), "MIT"),
    (("isc.grant",), "ISC"),
    (("apache.named", "apache.comply", "apache.obtain", "apache.asis", "apache.see"), "Apache-2.0"),
    (("apache.named", "apache.comply", "apache.obtain", "apache.asis"), "Apache-2.0"),
    (("apache.named", "apache.comply", "apache.obtain"), "Apache-2.0"),
    (("apache.named",), "Apache-2.0"),
    (("bsd.grant", "bsd.source", "bsd.binary", "bsd.endorse", "bsd.asis", "bsd.liability"), "BSD-3-Clause"),
    (("bsd.grant", "bsd.source", "bsd.binary", "bsd.endorse"), "BSD-3-Clause"),
    (("bsd.grant", "bsd.source", "bsd.binary", "bsd.asis", "bsd.liability"), "BSD-2-Clause"),
    (("bsd.grant", "bsd.source", "bsd.binary", "?"), "LicenseRef-BSD"),  # a further condition that is not known
    (("bsd.grant", "bsd.source", "bsd.binary"), "BSD-2-Clause"),
    (("zlib.asis", "zlib.grant"), "Zlib"),
    (("zlib.grant",), "Zlib"),
    (("lgpl21.terms", "lgpl.asis", "lgpl.see"), "LGPL-2.1-or-later"),
    (("lgpl21.terms",), "LGPL-2.1-or-later"),
    (("lgpl3.terms", "lgpl.asis", "lgpl.see"), "LGPL-3.0-or-later"),
    (("lgpl3.terms", "gpl.asis", "lgpl.see"), "LGPL-3.0-or-later"),
    (("lgpl3.terms",), "LGPL-3.0-or-later"),
    (("agpl3.terms", "gpl.asis", "agpl.see"), "AGPL-3.0-or-later"),
    (("agpl3.terms",), "AGPL-3.0-or-later"),
    (("epl.terms",), "EPL-2.0"),
    (("gpl3.terms", "gpl.asis", "gpl.see"), "GPL-3.0-or-later"),
    (("gpl3.terms",), "GPL-3.0-or-later"),
    (("gpl2.terms", "gpl.asis", "gpl.see"), "GPL-2.0-or-later"),
    (("gpl2.terms",), "GPL-2.0-or-later"),
    (("mpl.terms", "mpl.copy"), "MPL-2.0"),
    (("mpl.terms",), "MPL-2.0"),
    (("unlicense.domain",), "Unlicense"),
    *(((f"name.{x}",), x) for x in dict.fromkeys([*NAMES.values(), *SHORT.values()])),
)


def normal(sentence: str) -> str:
    """A sentence as it is looked up; ``_normal`` and ``scan_sql`` say the same in their languages."""
    out = sentence.lower()
    for pattern, to in BEFORE:
        out = re.sub(pattern, to.replace("$", "\\"), out)
    out = re.sub(r"[\W_]+", " ", out).strip()
    for pattern, to in AFTER:
        out = re.sub(pattern, to.replace("$", "\\"), out)
    return out


def known_sentences() -> dict[str, str]:
    """Normalised sentence -> identifier. A sentence whose text holds a sentence end is known by its parts with a trigger."""
    licences = dict.fromkeys([*NAMES.values(), *SHORT.values()])
    names = {normal(x): x for x in licences} | {normal(n): x for n, x in (NAMES | SHORT).items()}
    table = {f"under {name}": f"name.{x}" for name, x in names.items()}
    table |= {SPDX + name: f"name.{x}" for name, x in names.items()}
    for ident, sentence in SENTENCES.items():
        parts = [p for p in map(normal, re.sub(SENTENCE_END, "\\1\n", sentence).split("\n")) if re.search(TRIGGER, p)]
        table[parts[0]] = ident
        for p in parts[1:]:
            table[p] = "-"  # goes with the part before
    return table


#: Each known sentence matches this as it is written, so a text without any is decided at once. Names without a word of
#: TRIGGER count behind "under"; words of a pair may be parted by a line break.
NOTICE = TRIGGER + "|" + "|".join(x.replace(" ", GAP) for x in (
    "public domain", "copy of the mpl", "as is", "be liable",
    "under (?:the terms of )?(?:(?:the|an?) )?(?:gnu )?(?:" + "|".join(sorted({x.lower().split("-")[0] for x in [*NAMES.values(), *SHORT.values()]} | {"gplv2", "gplv3"})) + ")\\b"))


def _normal(sentence: Column) -> Column:
    out = F.lower(sentence)
    for pattern, to in BEFORE:
        out = F.regexp_replace(out, pattern, to)
    return F.trim(F.regexp_replace(out, GAP, " "))


def _looked_up(cut: Column, known: Column) -> Column:
    """Identifiers of those pieces of the text that speak of licences, in order; ``?`` where unknown.

    A choice or a union of licences gives one for each, if any of them is known.
    """
    told = F.filter(cut, lambda s: F.lower(s).rlike(NOTICE))
    plain = F.transform(told, _normal)

    def changed(s: Column) -> Column:
        for pattern, to in AFTER:
            s = F.regexp_replace(s, pattern, to)
        return s

    def identifiers(s: Column) -> Column:
        prefix = F.when(s.startswith(SPDX), F.lit(SPDX)).when(s.startswith("under "), F.lit("under "))
        names = F.split(F.substring(s, F.length(prefix) + 1, F.length(s)), BETWEEN)
        each = F.transform(names, lambda n: F.coalesce(F.try_element_at(known, F.concat(prefix, n)), F.lit("?")))
        one = F.try_element_at(known, s)
        return F.when(one.isNotNull(), F.array(one)).when(_sure(each) > 0, each).otherwise(F.array(F.lit("?")))

    return F.flatten(F.transform(F.transform(F.filter(plain, lambda s: ~s.rlike(NEUTRAL)), changed), identifiers))


def _sure(ids: Column) -> Column:
    return F.size(F.filter(ids, lambda i: i != "?"))


def _identifiers(text: Column, known: Column) -> Column:
    """Identifiers of the sentences of a text.

    A piece between sentence ends or blank lines counts as one sentence if it is known with its
    lines joined, else as its lines.
    """
    pieces = F.split(F.regexp_replace(text, SENTENCE_END, "$1\n\n"), PARTED)

    def choice(piece: Column) -> Column:
        whole = _looked_up(F.array(F.regexp_replace(piece, SPACE + "+", " ")), known)
        return F.when(_sure(whole) > 0, whole).otherwise(_looked_up(F.split(piece, "\n"), known))

    return F.flatten(F.transform(F.filter(pieces, lambda p: F.lower(p).rlike(NOTICE)), choice))


def _joined(text: Column, known: Column) -> Column:
    """The same where white space of any kind, blank lines too, ends nothing."""
    return _looked_up(F.split(F.regexp_replace(F.regexp_replace(text, SPACE + "+", " "), SENTENCE_END, "$1\n"), "\n"), known)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id, licenses, n_matches, n_unknown, sentences.

    ``licenses`` has the licences in order of their first notice, comma-joined;
    ``n_matches`` counts notices, ``n_unknown`` the sentences that speak of licences and
    are not known, ``sentences`` is the sequence of identifiers. What stands between sentence
    ends or blank lines is one sentence if it is known as one (a wrapped notice), else each of its lines is; where
    the text gives more known sentences with blank lines left out, those count.
    A null or empty text has none. Repeated rows come back as often as they
    are given, an empty table gives none; other columns are not read.
    """
    known = F.create_map(*[F.lit(x) for pair in known_sentences().items() for x in pair])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    none = F.array().cast("array<string>")
    rows = rows.withColumn("text", F.when(F.lower("text").rlike(NOTICE), F.col("text")))
    parts = F.filter(_identifiers(F.col("text"), known), lambda i: i != "-")
    joined = F.filter(_joined(F.col("text"), known), lambda i: i != "-")
    rows = rows.withColumn("parts", F.coalesce(parts, none)).withColumn("joined", F.coalesce(joined, none))
    rows = rows.withColumn("ids", F.when(_sure(F.col("joined")) > _sure(F.col("parts")), F.col("joined")).otherwise(F.col("parts")))
    sequence = F.concat(F.lit(","), F.array_join(F.transform("ids", lambda i: F.concat(i, F.lit(","))), ","))
    sequence = F.when(F.size("ids") > 0, sequence).otherwise(F.lit(""))
    for run, licence in RULES:  # every identifier is between commas of its own: ",a,,b,"
        sequence = F.replace(sequence, F.lit("," + ",,".join(run) + ","), F.lit(f",={licence},"))
    rows = rows.withColumn("found", F.regexp_extract_all(sequence, F.lit("=([^,]+)"), F.lit(1)))
    return rows.select(
        "doc_id", F.array_join(F.array_distinct("found"), ",").alias("licenses"), F.size("found").cast("long").alias("n_matches"),
        F.size(F.filter("ids", lambda i: i == "?")).cast("long").alias("n_unknown"), F.array_join("ids", ",").alias("sentences"),
    )


def scan_sql() -> str:
    """The same in DuckDB's SQL, from the same tables and patterns."""
    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def replaced(value: str, changes) -> str:
        for pattern, to in changes:
            value = f"regexp_replace({value}, {q(pattern)}, {q(to.replace('$', chr(92)))}, 'g')"
        return value

    known = known_sentences()
    table = f"map([{', '.join(map(q, known))}], [{', '.join(map(q, known.values()))}])"

    def looked_up(cut: str) -> str:
        told = f"list_filter({cut}, lambda s: regexp_matches(lower(s), {q(NOTICE)}))"
        plain = f"list_transform({told}, lambda s: trim({replaced('lower(s)', (*BEFORE, (GAP, ' ')))}))"
        short = f"list_transform(list_filter({plain}, lambda s: NOT regexp_matches(s, {q(NEUTRAL)})), lambda s: {replaced('s', AFTER)})"
        prefix = f"(CASE WHEN starts_with(s, {q(SPDX)}) THEN {q(SPDX)} WHEN starts_with(s, 'under ') THEN 'under ' END)"
        names = f"string_split_regex(substr(s, length({prefix}) + 1), {q(BETWEEN)})"
        each = f"list_transform({names}, lambda n: coalesce(k.m[{prefix} || n], '?'))"
        one = f"CASE WHEN k.m[s] IS NOT NULL THEN [k.m[s]] WHEN {prefix} IS NOT NULL AND len(list_filter({each}, lambda i: i <> '?')) > 0 THEN {each} ELSE ['?'] END"
        return f"flatten(list_transform({short}, lambda s: {one}))"

    def spaced(text: str) -> str:
        return f"regexp_replace({text}, {q(SPACE + '+')}, ' ', 'g')"

    def ended(text: str, by: str) -> str:
        return f"regexp_replace({text}, {q(SENTENCE_END)}, E'\\\\1{by}', 'g')"

    def kept(ids: str) -> str:
        return f"coalesce(list_filter({ids}, lambda i: i <> '-'), [])"

    pieces = f"list_filter(string_split_regex({ended('text', chr(92) + 'n' + chr(92) + 'n')}, {q(PARTED)}), lambda p: regexp_matches(lower(p), {q(NOTICE)}))"
    whole, lines = looked_up(f"[{spaced('p')}]"), looked_up("string_split(p, E'\\n')")
    choice = f"CASE WHEN len(list_filter({whole}, lambda i: i <> '?')) > 0 THEN {whole} ELSE {lines} END"
    parts = f"flatten(list_transform({pieces}, lambda p: {choice}))"
    joined = looked_up(f"string_split({ended(spaced('text'), chr(92) + 'n')}, E'\\n')")
    sequence = "CASE WHEN len(ids) > 0 THEN ',' || array_to_string(list_transform(ids, lambda i: i || ','), ',') ELSE '' END"
    for run, licence in RULES:
        sequence = f"replace({sequence}, {q(',' + ',,'.join(run) + ',')}, {q(f',={licence},')})"
    return f"""
        WITH k AS (SELECT {table} AS m),
        d AS (SELECT doc_id, CASE WHEN regexp_matches(lower(coalesce(text, '')), {q(NOTICE)}) THEN text END AS text FROM documents),
        s AS (SELECT doc_id, {kept(parts)} AS parts, {kept(joined)} AS joined FROM d, k),
        i AS (SELECT doc_id, CASE WHEN len(list_filter(joined, lambda x: x <> '?')) > len(list_filter(parts, lambda x: x <> '?')) THEN joined ELSE parts END AS ids FROM s),
        f AS (SELECT doc_id, ids, regexp_extract_all({sequence}, '=([^,]+)', 1) AS found FROM i),
        u AS (SELECT doc_id, ids, found, list_filter(found, lambda x, nr: list_position(found, x) = nr) AS firsts FROM f)
        SELECT doc_id, array_to_string(firsts, ',') AS licenses, len(found)::BIGINT AS n_matches,
               len(list_filter(ids, lambda x: x = '?'))::BIGINT AS n_unknown, array_to_string(ids, ',') AS sentences
        FROM u
    """
