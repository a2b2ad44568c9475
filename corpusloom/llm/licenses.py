"""License scans by digests of canonical texts."""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

# Texts and notices of public licenses, by their public identifiers.
KNOWN = [
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
]
# Every known text holds one of these words, so no other text can have its digest.
ANCHOR = "(?i)licen[cs]|permission"
COPYRIGHT = r"(?im)^[^\w\n]*(?:copyright\b|\(c\)|©|all rights reserved)[^\n]*$"
SPELLINGS = [
    ("licen[cs]", "licens"),
    ("acknowledgement", "acknowledgment"),
    ("authoris", "authoriz"),
    ("organis", "organiz"),
    ("recognis", "recogniz"),
    ("sub-license", "sublicense"),
    ("non-infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("per cent", "percent"),
    (r"\(c\)|©", "copyright"),
    ("and/or", "and or"),
    ("http:", "https:"),
]


# The four above are what the SQL twin knows. The operator goes on from them with full texts, with
# notices told from other lines that begin with "copyright", and with holders named in a text.
FOLDER = Path(__file__).parent / "license_texts"
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "3-Clause BSD License", "New BSD License", "BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "2-Clause BSD License", "Simplified BSD License", "BSD License"),
}
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
ANCHORS = ANCHOR + "|redistribution"
RULES = [
    (r"(?s)neither\W+the\W+names?\W+of\b.{1,200}?\bnor\W+the\W+names\W+of\W+(?:its|their|any|other)?\W*contributors", "neither the name of the holder nor of contributors"),
    (r"(?s)software\W+is\W+provided\W+by\W.{1,150}?\Was\W+is\b", "software is provided by the holders as is"),
    (r"(?s)in\W+no\W+event\W+shall\W.{1,150}?\Wbe\W+liable\b", "in no event shall the holders be liable"),
]


@cache
def known_texts() -> list[tuple[str, str]]:
    """``KNOWN``, and the full texts with and without title, list marks and what follows the terms."""
    found = list(KNOWN)
    bodies = [("MIT", _MIT), ("MIT", _MIT.replace("this permission notice shall", "this permission notice (including the next paragraph) shall")), ("ISC", _ISC)]
    for path in sorted(FOLDER.glob("*.txt")):
        name, text = path.stem, path.read_text("utf-8")
        if name == "BSD-3-Clause":
            text = text[text.index("Redistribution") :]
            two = re.sub(r"(?s)^3\. .*?\n\n", "\n", text, flags=re.M)
            plain = lambda t: re.sub(r"(?m)^\d\. ", "", t)
            bodies += [("BSD-3-Clause", text), ("BSD-3-Clause", plain(text)), ("BSD-2-Clause", two), ("BSD-2-Clause", plain(two))]
            continue
        ends = [text, *([text[: text.index(END_OF_TERMS) + len(END_OF_TERMS)], text[: text.index(END_OF_TERMS)]] if END_OF_TERMS in text else [])]
        found += [(name.removesuffix(".0") + ".0" if "." not in name else name, t) for end in ends for t in (end, end.split("\n\n", 1)[1])]
    for name, body in bodies:
        found += [(name, body), *((name, f"{title}\n{body}") for title in TITLES[name])]
    return found


@cache
def _notice() -> str:
    """Pattern of copyright notices: lines of them, those of the license texts themselves wherever
    they stand, and those in one line with the license that follows."""
    after = {w.lower() for _, text in known_texts() for w in re.findall(r"(?i)\bcopyright\b\W*(\w+)", text)} - {"c", "yyyy", "the"}
    goes_on = "|".join(sorted(after | {"holder", "holders", "owner", "owners", r"the\s+(?:software|library)"}))
    return (
        r"(?im)(?:^[^\w\n]*)?\b(?:copyright\s+\(c\)\s+[\d,\s]+free\s+software\s+foundation,\s+inc\.?(?:\s*<https?://fsf\.org/>|,?\s+\d+\s+(?:franklin|temple|mass)\b[^<>]{0,60}?\busa\b)?"
        r"|copyright\s+\(c\)\s+<?year>?\s+<?name\s+of\s+author>?|copyright\s+\[yyyy\]\s+\[name\s+of\s+copyright\s+owner\]"
        r"|copyright[^\w\n]*(?:\(c\)|©|\d{4})[^\n]{0,200}?(?=\bpermission\s+(?:is|to)\b|\bredistribution\s+and\s+use\b))"
        rf"|^[^\w\n]*(?:copyright\b(?=[^\n]*\w)(?![^\w\n]*(?:{goes_on})\b)[^\n]*|(?:\(c\)[^\w\n]*(?=copyright\b|\d{{4}})|©)[^\n]*|all rights reserved[^\n]*)$"
    )


def canonical(text: Column) -> Column:
    """The text without copyright notices, in lower case and one spelling, words parted by one space."""
    text = F.lower(F.regexp_replace(text, _notice(), ""))
    for pattern, spelling in SPELLINGS + RULES:
        text = F.regexp_replace(text, pattern, spelling)
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))


def known_digests(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    """``digest, license`` of the known texts."""
    texts = spark.createDataFrame(known, "license string, text string")
    return texts.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license").distinct()


def find_licenses(docs: DataFrame, known: list[tuple[str, str]] | None = None, anchor: str = ANCHORS) -> DataFrame:
    """``doc_id, line_no, license`` for each known license text: the whole document (line_no -1), or
    one of the lines of a document of several; ``known`` are ``known_texts()`` unless given.

    A unit is found if its canonical text is one of the known ones, by their digests. The join
    hashes the known digests, of which there are as many as known texts; documents stay in place.
    Defined results: null and empty texts hold no license; a repeated row gives its finds again;
    a text known under two names gives both.
    """
    rows = docs.select("doc_id", "text").where(F.col("text").rlike(anchor))
    lines = F.split("text", "\n", -1)
    numbered = lambda parts: F.transform(parts, lambda line, i: F.struct(i.alias("line_no"), line.alias("unit")))
    whole = F.array(F.struct(F.lit(-1).alias("line_no"), F.col("text").alias("unit")))
    units = F.when(F.size(lines) > 1, F.concat(whole, F.filter(numbered(lines), lambda u: u["unit"].rlike(anchor)))).otherwise(whole)
    digests = rows.select("doc_id", F.explode(units).alias("u")).select(
        "doc_id", F.col("u.line_no").alias("line_no"), F.sha2(canonical(F.col("u.unit")), 256).alias("digest")
    )
    return digests.join(F.broadcast(known_digests(docs.sparkSession, known or known_texts())), "digest").select("doc_id", "line_no", "license")
