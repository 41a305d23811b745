"""Licence scan by canonical digests, with DataFrame functions.

A text's units are the whole text, its paragraphs (between empty lines) and its lines. Each line is brought to a canonical form: lower case, signs
become spaces, copyright statements (not other lines that begin with the word) are dropped, equivalent spellings become one; a larger unit is its lines' forms joined. The SHA-256 of a unit's
form is looked up among the digests of known licence texts, which went through the same form, so a licence is found where a whole unit is that
licence, in any case, punctuation, line breaks or spelling. The known digests are a hash-join table; it is broadcast up to SET_ROWS rows and shuffled beyond.
A unit whose form is longer than the longest known form can't be equal to one, so it isn't hashed.

Defined results: null and empty texts, and texts without words, hold no licence; every row gives its own result row, also where a doc_id repeats or is null; several names
for one digest all count; extra columns are ignored; an empty table gives an empty result, an empty list of known texts finds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most known digests that are broadcast (about 200 bytes each).
SET_ROWS = 100_000

# Spellings that count as one (after signs have become spaces), applied in this order to ` text `.
SPELLINGS = [
    (" licence", " license"), (" sub license", " sublicense"), (" https ", " http "), (" organisation", " organization"), (" favour", " favor"), (" acknowledgement", " acknowledgment"), (" non commercial ", " noncommercial "),
    (" gnu gpl ", " gnu general public license "), (" gnu lgpl ", " gnu lesser general public license "), (" version ", " v "), (" v2 ", " v 2 "), (" v3 ", " v 3 "), (" c ", " "),
]

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
# Public licence texts and notices.
KNOWN = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n" + _WARRANTY),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _ISC_WARRANTY),
    ("BSD-2-Clause", _BSD + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n" + _BSD_WARRANTY),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Licensed under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."), ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "Licensed under CC0 1.0."),
]
KNOWN += [(name, f"SPDX-License-Identifier: {name}") for name in "ISC 0BSD BSD-2-Clause BSD-3-Clause GPL-2.0-only GPL-2.0-or-later GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later MPL-2.0 CC-BY-4.0 CC-BY-SA-4.0 CC0-1.0".split()]

#: Usual headings of files whose text has none of its own.
HEADINGS = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT"], "ISC": ["ISC License", "The ISC License"], "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "0BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License", "Modified BSD License", "BSD License"],
}
#: Full texts in licence_texts, by name.
TEXTS = {
    "Apache-2.0": "Apache-2.0", "Artistic-1.0-Perl": "Artistic", "BSD-3-Clause": "BSD", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1.0": "GPL-1", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3",
    "LGPL-2.0": "LGPL-2", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}
_TERMS_END = "END OF TERMS AND CONDITIONS"


def _full_texts() -> Iterator[tuple[str, str]]:
    """Full texts: as shipped and without the heading, with and without what follows their terms; short ones with each heading and list style."""
    short = [(name, body) for name, body in KNOWN if len(body) > 500]
    for name, file in TEXTS.items():
        whole = (Path(__file__).parent / "licence_texts" / f"{file}.txt").read_text(encoding="utf-8")
        if name in HEADINGS:
            short.append((name, whole))
            continue
        for body in {whole, whole.split(_TERMS_END)[0] + _TERMS_END if _TERMS_END in whole else whole}:
            yield name, body
            yield name, body.strip("\n").split("\n\n", 1)[1]
    for name, body in short:
        for marks in (("1. ", "2. ", "3. "), ("", "", ""), ("a. ", "b. ", "c. ")):
            styled = body
            for old, new in zip(("1. ", "2. ", "3. "), marks, strict=True):
                styled = styled.replace(f"\n{old}", f"\n{new}")
            yield name, styled
            for heading in HEADINGS[name]:
                yield name, f"{heading}\n{styled}"


KNOWN += sorted(set(_full_texts()) - set(KNOWN))

#: A copyright statement: the word or sign with a sign, year or placeholder, or with a holder's name.
_STATEMENT = (
    r"^[^\p{L}\p{N}(©]*(?:(?i:copyright):?\s*(?:(?i:by)\s+)?(?:\([cC]\)|©|[0-9\[<{])|©|\([cC]\)\s*(?:[0-9\[<{©]|(?i:copyright)\b)"
    r"|Copyright:?\s+(?:by\s+)?(?!(?i:holders?|owners?|notices?|licen[cs]es?|laws?|acts?|statements?|disclaimers?|and|or|rights?|interests?)\b)\p{Lu})"
)


def canonical(line: Column) -> Column:
    """The form of one line; empty for copyright statements and lines without words."""
    low = F.lower(line)
    dropped = line.rlike(_STATEMENT) | low.rlike(r"^[^a-z]*all rights reserved[^a-z]*$")
    form = F.concat(F.lit(" "), F.trim(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for old, new in SPELLINGS:
        form = F.replace(form, F.lit(old), F.lit(new))
    return F.when(dropped, F.lit("")).otherwise(F.trim(form))


def _across(form: Column) -> Column:
    """A form of several lines, with the spellings of several words that a line break parts."""
    form = F.concat(F.lit(" "), form, F.lit(" "))
    for old, new in SPELLINGS:
        if " " in old.strip():
            form = F.replace(form, F.lit(old), F.lit(new))
    return F.trim(form)


def _joined(lines: Column) -> Column:
    return _across(F.array_join(F.filter(lines, lambda x: x != ""), " "))


def _units(text: Column) -> Column:
    """The forms of a text's units, the whole text first."""
    return F.transform(F.split(text, r"\r\n|\r|\n"), canonical)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, names array<string>, longest int) of the known texts."""
    rows = spark.createDataFrame(KNOWN if known is None else known, "name string, body string")
    forms = rows.select("name", _joined(_units(F.col("body"))).alias("form")).filter("form <> ''")
    return forms.groupBy(F.sha2(F.col("form").cast("binary"), 256).alias("digest")).agg(F.array_sort(F.collect_set("name")).alias("names"), F.max(F.length("form")).alias("longest"))


def licence_scan(docs: DataFrame, known: list[tuple[str, str]] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, licences (names found, sorted, comma-joined), n_units (units that are a known licence), whole (name of the licence that the whole text is, else null)."""
    spark = docs.sparkSession
    table = known_digests(spark, known)
    size = table.agg(F.count("*").alias("n"), F.coalesce(F.max("longest"), F.lit(0)).alias("longest")).first()
    table = table.select(F.col("digest").alias("known"), "names")
    if size.n <= SET_ROWS:
        table = F.broadcast(table)
    lines = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("long").alias("doc_id"), _units(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("lines"))
    # Paragraphs: lines between empty ones; joined by line breaks, an empty line is two in a row.
    paragraphs = F.filter(F.split(F.array_join("lines", "\n"), r"\n{2,}"), lambda p: p.contains("\n"))
    units = F.concat(F.array(_joined(F.col("lines"))), F.transform(paragraphs, lambda p: _across(F.trim(F.replace(p, F.lit("\n"), F.lit(" "))))), F.when(F.size("lines") > 1, F.col("lines")).otherwise(F.array().cast("array<string>")))
    rows = lines.select("row", "doc_id", F.posexplode(units).alias("at", "form")).filter((F.col("at") == 0) | (F.col("form") != "") & (F.length("form") <= size.longest))
    digest = F.when((F.col("form") != "") & (F.length("form") <= size.longest), F.sha2(F.col("form").cast("binary"), 256))
    found = rows.select("row", "doc_id", "at", digest.alias("digest")).join(table, F.col("digest") == F.col("known"), "left").filter("at = 0 or known is not null")
    per = found.groupBy("row", "doc_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("names")))).alias("names"), F.count("known").alias("n_units"), F.max(F.when(F.col("at") == 0, F.array_join("names", ","))).alias("whole"))
    return per.select("doc_id", F.array_join("names", ",").alias("licences"), "n_units", "whole")
