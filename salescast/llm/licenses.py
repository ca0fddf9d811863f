"""License scans by canonical digest lookup.

A text is normalised (case, punctuation, white space, copyright lines, equivalent spellings) and its SHA-256 joined to the
digests of known licences: the entire text to licence texts, and each line to licence notices. The registry is a
constant of this module, so its broadcast is bounded; the documents are read once and never shuffled. DataFrame functions
only. Cases: a null or empty text matches nothing; null doc_ids and repeated rows are kept; an empty table gives no rows;
other columns are not read; ids that share a text are listed in alphabetical order.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Published licence texts, without copyright lines.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_ZERO_BSD = _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")
_BSD_1 = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
_BSD_2 = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
_BSD_3 = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
_BSD_TAIL = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."

TEXTS: dict[str, list[str]] = {
    "0BSD": [_ZERO_BSD, "BSD Zero Clause License\n" + _ZERO_BSD],
    "BSD-2-Clause": [_BSD_HEAD + "1. " + _BSD_1 + "2. " + _BSD_2 + _BSD_TAIL, "BSD 2-Clause License\n" + _BSD_HEAD + _BSD_1 + _BSD_2 + _BSD_TAIL],
    "BSD-3-Clause": [_BSD_HEAD + "1. " + _BSD_1 + "2. " + _BSD_2 + "3. " + _BSD_3 + _BSD_TAIL, "BSD 3-Clause License\n" + _BSD_HEAD + _BSD_1 + _BSD_2 + _BSD_3 + _BSD_TAIL],
    "ISC": [_ISC, "ISC License\n" + _ISC],
    "MIT": [_MIT, "MIT License\n" + _MIT, "The MIT License (MIT)\n" + _MIT],
}
# Digests of the canonical published texts of longer licences (see canonical_text), with their terms, as
# distributions carry them in /usr/share/common-licenses.
LONG_TEXTS: dict[str, list[str]] = {
    "Apache-2.0": ["65b0f68c514949c962fd2109fe3df5781ff4b306ffd0c293b4b6d2bd90bfca0d"],
    "Artistic-1.0-Perl": ["66e644aafc5ff1de25be918be7e71d1d851bab015f750bc67c5b245e5f33ff39"],
    "BSD-3-Clause": ["21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"],
    "CC0-1.0": ["96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"],
    "GFDL-1.2": ["e340fdbffa8aad1a91ad3d07603ae56e4f976876fde20a8f60ddc2324aaafbf2"],
    "GFDL-1.3": ["24a1eee50a8a03726d0c9df2bda3fc0c810ea16c6cf6bffc69d49fd4c54a6e12"],
    "GPL-1.0": ["8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"],
    "GPL-2.0": ["b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1"],
    "GPL-3.0": ["72835a70e36b7216a23d7ad0423b16c131559708d367edec60d93ad91144bc26"],
    "LGPL-2.0": ["9b0b3105b96203f9d9e4b72d4b77951152156c88139302b5aedf6295e3ceaaa3"],
    "LGPL-2.1": ["cb225061bb71741fe8b31a2092e22fe05b1130438158ae5d16c48fd50186e345"],
    "LGPL-3.0": ["aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"],
    "MPL-1.1": ["9d7f5da9da4a5426e31b30321eb6baaf4958703cb0e358333cbf6370c4bedafc"],
    "MPL-2.0": ["f598b914e0d99024e8b911059f8b851a9af933ec753ba2996bdf842ebcb1db49"],
}
#: Notices, as one line of a document.
_NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"],
    "MIT": ["MIT License", "terms of the MIT License"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "ISC": ["ISC License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GPL version 2", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GPL version 3", "GPLv3"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
}
_LEADS = ("Licensed under", "This work is licensed under", "Released under", "This software is licensed under", "Distributed under", "SPDX-License-Identifier:")
NOTICES: dict[str, list[str]] = {k: [f"{lead} {the}{name}" for lead in _LEADS[:-1] for the in ("", "the ", "a ") for name in names] + [f"{_LEADS[-1]} {k}"] for k, names in _NAMES.items()}

#: (pattern, replacement) in this order. Possessive where a run could be split in many ways; without that, which RE2 doesn't
#: know and doesn't need, they match the same.
RULES = (
    (r"(?:^|\n)[ \t]*+(?:/?\*|#|//)*+[ \t]*+(?:copyright|\(c\)|©|all rights reserved)[^\n]*", "\n"),  # copyright lines
    (r"licence", "license"),
    (r"sub-licens", "sublicens"),
    (r"non-infring", "noninfring"),
    (r"merchantibility", "merchantability"),
    (r"https?://", ""),
    (r"[^a-z0-9]+", " "),
    (r"^ +| +$", ""),
)


def canonical_text(text: str) -> str:
    low = text.translate({i: i + 32 for i in range(65, 91)})
    for pattern, to in RULES:
        low = re.sub(pattern, to, low)
    return low


def canonical(text: Column) -> Column:
    """The normalised text."""
    out = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for pattern, to in RULES:
        out = F.regexp_replace(out, pattern, to)
    return out


def registry() -> list[tuple[str, str, str]]:
    """(unit, digest, ids): one row per known digest."""
    found: dict[tuple[str, str], set[str]] = {}
    for name, digests in LONG_TEXTS.items():
        for digest in digests:
            found.setdefault(("text", digest), set()).add(name)
    for unit, known in (("text", TEXTS), ("line", NOTICES)):
        for name, forms in known.items():
            for form in forms:
                found.setdefault((unit, hashlib.sha256(canonical_text(form).encode()).hexdigest()), set()).add(name)
    return [(unit, digest, ",".join(sorted(ids))) for (unit, digest), ids in sorted(found.items())]


def longest_notice() -> int:
    return max(len(x) for forms in NOTICES.values() for x in forms)


def find_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, text_digest, license (of the entire text, or null), n_notices and notices (distinct, sorted, comma-joined)."""
    spark = docs.sparkSession
    known = registry()
    whole = F.broadcast(spark.createDataFrame([(d, i) for u, d, i in known if u == "text"], "text_digest string, license string"))
    lines = F.create_map(*(F.lit(x) for u, d, i in known if u == "line" for x in (d, i)))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # a notice holds the word, in one spelling or the other; no other line is normalised
    cut = F.filter(F.split(text, "\n"), lambda x: x.rlike("(?i)licen[cs]e"))
    named = F.transform(cut, lambda x: F.try_element_at(lines, F.sha2(canonical(x), 256)))
    held = F.when(text.rlike("(?i)licen[cs]e"), F.array_compact(named)).otherwise(F.expr("cast(array() as array<string>)"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(canonical(text), 256).alias("text_digest"), held.alias("found"))
    return rows.join(whole, "text_digest", "left").select("doc_id", "text_digest", "license", F.size("found").cast("long").alias("n_notices"), F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("notices"))


def _sql() -> str:
    def canon(x: str) -> str:
        x = f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        for pattern, to in RULES:
            pattern = pattern.replace("*+", "*")
            x = f"regexp_replace({x}, '{pattern}', {'chr(10)' if to == chr(10) else chr(39) + to + chr(39)}, 'g')"
        return x

    values = ", ".join(f"('{u}', '{d}', '{i}')" for u, d, i in registry())
    return f"""
WITH known(unit, digest, ids) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
n AS (SELECT l.r, k.ids FROM l JOIN known k ON k.unit = 'line' AND k.digest = sha256({canon("l.line")})),
a AS (SELECT r, count(*) AS n, string_agg(DISTINCT ids, ',' ORDER BY ids) AS ids FROM n GROUP BY r),
t AS (SELECT r, doc_id, sha256({canon("text")}) AS digest FROM d)
SELECT t.doc_id, t.digest AS text_digest, k.ids AS license, coalesce(a.n, 0) AS n_notices, coalesce(a.ids, '') AS notices
FROM t LEFT JOIN known k ON k.unit = 'text' AND k.digest = t.digest LEFT JOIN a ON a.r = t.r
"""


SQL = _sql()
