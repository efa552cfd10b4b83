"""License scans by canonical digest.  DataFrame operations only.

A text is made canonical (copyright lines go, lower case, equivalent spellings
become one, every run of other characters becomes one blank) and hashed; the
digests of whole documents and of their single lines are joined with the
digests of known licence texts, made canonical by the same rules.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_of

#: Equivalent spellings, applied to canonical words in this order.
SPELLINGS = (("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
             ("organisation", "organization"), ("whilst", "while"), ("favour", "favor"), ("merchantibility", "merchantability"),
             ("copyright owner", "copyright holder"), ("https", "http"), ("version ", "v"))

#: Names of licences as notices write them.
NAMES = {
    "MIT": ("MIT License", "MIT licence (MIT)", "Expat License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPLv3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL v3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL v3"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "ISC": ("ISC License",),
    "Zlib": ("zlib License",),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, version 2.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
}
NOTICES = ("{}", "Released under the {}", "Released under {}", "Licensed under the {}", "Licensed under {}", "Distributed under the {}",
           "This work is licensed under the {}", "This work is licensed under a {}", "This project is licensed under the {}",
           "This software is released under the {}", "This file is licensed under the {}", "License: {}")

#: Whole texts, without their copyright lines.
TEXTS = {
    "MIT": """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
}

#: Licences whose whole text lies in license_texts.  The others of NAMES (AGPL, EPL, CC BY) are known by their notices only.
WHOLE = ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "CC0-1.0")

_COPYRIGHT = r"(?m)^[^a-z0-9\n]*(copyright( [0-9(\x{a9}]|:| \(c\))|\(c\) |\x{a9}|all rights reserved)[^\n]*$"


def canonical(text: Column) -> Column:
    """Canonical form of a text; the empty string when nothing is left."""
    c = F.regexp_replace(F.lower(text), _COPYRIGHT, "")
    c = F.regexp_replace(c, "[^a-z0-9]+", " ")
    for a, b in SPELLINGS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.trim(c)


def _forms(text: str) -> set[str]:
    """A whole text as documents hold it: with and without its title, appendix, numbers of clauses and line breaks."""
    out = {text, text.strip().split("\n\n", 1)[1]}
    # instructions after the terms, and the notice they show, which has blanks or a name in its copyright line
    out |= {re.split(r"(?<=END OF TERMS AND CONDITIONS)\s", t)[0] for t in out}
    out |= {re.sub(r"(?m)^ *Copyright \[yyyy\].*$", "", t) for t in out}
    out |= {re.sub(r"(?m)^[0-9]\. ", "", t) for t in out}
    if "APPENDIX: How to apply" in text:
        notice = re.split(r"Copyright \[yyyy\].*\n", text)[1]
        out |= {notice, notice.replace("http://", "https://")}
    return out | {re.sub(r"[ \t]*\n[ \t]*(?=\S)", " ", t) for t in out}


def whole_texts() -> list[tuple[str, str]]:
    """(license_id, text) of the licences that have a file, in all their forms; read by the driver."""
    folder = resources.files(__package__) / "license_texts"
    return [(k, t) for k in WHOLE for t in sorted(_forms((folder / f"{k}.txt").read_text("utf-8")))]


def known(spark: SparkSession) -> DataFrame:
    """license_id, digest: a fixed table of notices and texts (some 600 rows)."""
    rows = [(k, n.format(name)) for k, names in NAMES.items() for name in names for n in NOTICES]
    rows += [(k, t) for k, t in TEXTS.items()] + [(k, t.split("\n\n", 1)[1]) for k, t in TEXTS.items()]
    d = spark.createDataFrame(rows + whole_texts(), "license_id string, text string")
    return d.select("license_id", F.sha2(canonical(F.col("text")), 256).alias("digest")).groupBy("digest").agg(
        F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, licenses: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text).

    doc_id, digest (SHA-256 of the canonical text), license_id (of the whole
    text, null if unknown), line_licenses (comma-separated, sorted, distinct;
    empty if none), n_license_lines, n_copyright_lines.  A null text is the
    empty text; nothing known is empty, so it matches nothing.  Rows without a
    doc_id and rows that repeat are scanned like all others.
    """
    table = licenses if licenses is not None else known(docs.sparkSession)
    text = text_of(docs)
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    whole = d.select("doc_id", "text_hash", F.sha2(canonical(F.col("text")), 256).alias("digest"),
                     F.regexp_count(F.lower("text"), F.lit(_COPYRIGHT)).alias("n_copyright_lines"))
    lines = d.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    notices = lines.select("doc_id", "text_hash", "pos", F.sha2(canonical(F.col("line")), 256).alias("digest")).join(table, "digest")
    per = notices.dropDuplicates(["doc_id", "text_hash", "pos"]).groupBy("doc_id", "text_hash").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("l"))
    per = per.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n", "l")
    out = whole.join(table, "digest", "left").join(
        per, whole["doc_id"].eqNullSafe(per["_id"]) & (whole["text_hash"] == per["_hash"]), "left")
    return out.select("doc_id", "digest", "license_id", F.coalesce("l", F.lit("")).alias("line_licenses"),
                      F.coalesce("n", F.lit(0)).alias("n_license_lines"), "n_copyright_lines")
