"""License scans by canonical digest lookup (DataFrame functions only).

A text is normalised (case, punctuation, copyright lines, equivalent spellings) and its digest is
looked up among the digests of known licences by a hash join on the entire text. The same lookup on
single lines finds notices that refer to a licence.
"""

from __future__ import annotations

import json
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import narrow, stored

#: Licence texts (without their copyright lines) and usual notices, by SPDX identifier.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR "
    "IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
    "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "{0} Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "{1} Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "{2} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. "
)
#: What conditions are numbered with; signs are punctuation, so one of them stands for all.
_MARKS = (("1.", "2.", "3."), ("*", "*", "*"), ("a.", "b.", "c."))
TEXTS = {
    "MIT": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies. " + _ISC
    ],
    "0BSD": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC],
    "BSD-2-Clause": [_BSD_HEAD.format(*marks) + _BSD for marks in _MARKS],
    "BSD-3-Clause": [(_BSD_HEAD + _BSD_NAMES).format(*marks) + _BSD for marks in _MARKS],
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a '
        "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
        'under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License."
    ],
}
#: Whole long licences, a file each; what follows ~ in a name tells other wordings of one licence apart.
for _file in sorted(resources.files("barloom.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
    TEXTS.setdefault(_file.name.removesuffix(".txt").split("~")[0], []).append(_file.read_text(encoding="utf-8"))
TITLES = {"MIT": "MIT License", "ISC": "ISC License", "0BSD": "Zero-Clause BSD License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License"}
NOTICES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "MIT License"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", "Apache License, Version 2.0"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 3.",
        "GNU General Public License, version 3",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "Licensed under the BSD 3-Clause License."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0.", "Released under the Mozilla Public License, version 2.0."],
    "CC0-1.0": ["Released under CC0 1.0 Universal."],
}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
for _form, _name in _CC.items():
    for _version, _port in (("4.0", "International"), ("3.0", "Unported")):
        _as = [f"the Creative Commons {_name} {_version} {_port} License", f"a Creative Commons {_name} {_version} {_port} License", f"CC {_form} {_version}"]
        NOTICES[f"CC-{_form}-{_version}"] = [f"{_verb} {_a}." for _verb in ("This work is licensed under", "Licensed under", "Released under") for _a in _as]
for _id, _name in (("LGPL-2.1", "Lesser General Public License, version 2.1"), ("LGPL-3.0", "Lesser General Public License, version 3")):
    NOTICES[_id] = [f"{_verb} the GNU {_name}." for _verb in ("This work is licensed under", "Licensed under", "Released under")]
for _id, _title in TITLES.items():
    NOTICES[_id] = [*dict.fromkeys([*NOTICES.get(_id, []), _title, *(f"{_verb} the {_title}." for _verb in ("Licensed under", "Released under"))])]
    TEXTS[_id] += [f"{n}\n{t}" for n in NOTICES[_id] for t in TEXTS[_id]]  # such a statement can follow the copyright
#: Equivalent spellings, as words of normalised text.
SPELLINGS = (
    *((f"{x}licenc{y}", f"{x}licens{y}") for x in ("", "sub") for y in ("e", "es", "ed")),
    ("merchantibility", "merchantability"), ("noncommercial", "non commercial"), ("copyright owner", "copyright holder"),
)
_YEAR = r"[\[<{(]?(?:[12][0-9]{3}|yyyy|year)\b"
_UNDER = (
    r"(?:licen[sc]ed|released|distributed|published|available) +under\b[^\n]*|this +(?:work|software|file|code|program|document|project|package) +is +\w+ +under\b[^\n]*"
    r"|permission +(?:is +hereby|to +use)\b[^\n]*|redistribution +and +use\b[^\n]*"
)
_NAMED = r"(?:the +)?(?:mit|isc|bsd|apache|gnu|mozilla|creative +commons|cc0|cc +by)\b[^\n]*"
#: Fixed value: a copyright statement up to a licence statement (a group) or the end of its line, and a line that only reserves all rights.
_COPYRIGHT = (
    rf"(?im)^[ \t*#/;-]*(?:(?:copyright[ \t:,]*(?:\(c\)|©|{_YEAR})|\(c\)[ \t]*(?:copyright|©|{_YEAR})|©)"
    rf"(?:[^\n]*?(?:[^\w\n]({_UNDER})|[.;,|][ \t]+({_NAMED}))$|[^\n]*$)|all rights reserved[ \t\r.!;,*/#-]*({_UNDER}|{_NAMED})?$)"
)


#: Characters of words in lower case, letters of ASCII first as most texts have mostly those. Left out are ASCII's other
#: characters and the typographic signs « · » and U+2010 to U+2027 (dashes, quotes, bullets, dots).
WORD_CHARS = r"a-z0-9\x{80}-\x{AA}\x{AC}-\x{B6}\x{B8}-\x{BA}\x{BC}-\x{200F}\x{2028}-\x{10FFFF}"


def canonical_sql(text: str) -> str:
    """The canonical form as a SQL expression over text."""
    statement = _COPYRIGHT.replace("(?im)", "(?imd)").replace("\\", "\\\\")
    out = f"lower(regexp_replace(coalesce({text}, ''), '{statement}', ' $1$2$3'))"
    # Two spaces between words: each word has its own, so plain replacements also see repeated words.
    chars = WORD_CHARS.replace("\\", "\\\\")
    out = f"concat(' ', regexp_replace({out}, '[^{chars}]+', '  '), ' ')"
    for a, b in SPELLINGS:
        out = f"replace({out}, ' {a.replace(' ', '  ')} ', ' {b.replace(' ', '  ')} ')"
    return f"trim(replace({out}, '  ', ' '))"


def canonical(text: str) -> Column:
    return F.expr(canonical_sql(f"`{text}`"))


def catalogue(spark: SparkSession) -> DataFrame:
    """license_id, kind (text or notice), text of each known licence text and notice: a fixed, small table."""
    rows = [(i, "text", t) for i, all_of in TEXTS.items() for t in all_of]
    rows += [(i, "text", f"{TITLES[i]}\n{t}") for i, all_of in TEXTS.items() if i in TITLES for t in all_of]
    rows += [(i, "notice", t) for i, all_of in NOTICES.items() for t in all_of]
    return spark.createDataFrame(rows, "license_id string, kind string, text string")


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None) -> DataFrame:
    """One row per row of df: doc_id, license_id (the entire text is that licence, else null), notices.

    notices: sorted distinct identifiers of licences that single lines of the text refer to, or are.
    known: license_id, kind (text or notice) and text, else catalogue(); it is read by the driver. Where it
    has several identifiers for one text, license_id lists them.
    Null, empty and wholly punctuated texts match nothing. Repeated rows give repeated results.
    """
    docs = narrow(df, doc_id=id_col, text=text_col)
    spark = df.sparkSession
    known = catalogue(spark) if known is None else known
    known = known.select("license_id", "kind", canonical("text").alias("c")).where("c <> ''").select("license_id", "kind", F.sha2("c", 256).alias("digest"))
    whole, line = {}, {}
    for i, kind, digest in sorted(set(map(tuple, known.collect()))):
        if kind == "text":
            whole.setdefault(digest, []).append(i)
        line.setdefault(digest, set()).add(i)
    whole = F.broadcast(spark.createDataFrame([(d, ",".join(ids)) for d, ids in whole.items()], "_whole string, license_id string"))  # a small table
    lookup = F.from_json(F.lit(json.dumps({d: sorted(ids) for d, ids in line.items()})), "map<string,array<string>>")
    digests = F.expr(f"transform(filter(split(coalesce(text, ''), '\\n'), x -> trim(x) <> ''), x -> sha2({canonical_sql('x')}, 256))")
    found = F.flatten(F.filter(F.transform(digests, lambda d: lookup[d]), lambda v: v.isNotNull()))
    return (
        docs.withColumn("_digest", F.sha2(canonical("text"), 256))
        .join(whole, F.col("_digest") == F.col("_whole"), "left")
        .select("doc_id", "license_id", F.concat_ws(",", F.array_sort(F.array_distinct(found))).alias("notices"))
    )


def duckdb_canonical(text: str) -> str:
    """The canonical form written anew for DuckDB: by lines and by words, with patterns of its own."""
    year = r"[\[<{(]?(?:[12]\d\d\d|yyyy|year)\b"
    head = rf"^[ \t*#/;-]*(?:copyright[ \t:,]*(?:\(c\)|©|{year})|\(c\)[ \t]*(?:copyright|©|{year})|©)"
    grant = (
        r"((?:licen[cs]ed|released|distributed|published|available) +under\b.*|this +(?:work|software|file|code|program|document|project|package) +is +\w+ +under\b.*"
        r"|permission +(?:is +hereby|to +use)\b.*|redistribution +and +use\b.*)$"
    )
    name = r"((?:the +)?(?:mit|isc|bsd|apache|gnu|mozilla|creative +commons|cc0|cc +by)\b.*)$"
    rights = r"^[ \t*#/;-]*all rights reserved[ \t\r.!;,*/#-]*"
    line = f"""CASE
        WHEN regexp_matches(l, '{head}', 'is') THEN
            CASE WHEN length(regexp_extract(l, '{head}.*?[^\\w]{grant}', 1, 'is')) >= length(regexp_extract(l, '{head}.*?[.;,|][ \\t]+{name}', 1, 'is'))
            THEN regexp_extract(l, '{head}.*?[^\\w]{grant}', 1, 'is') ELSE regexp_extract(l, '{head}.*?[.;,|][ \\t]+{name}', 1, 'is') END
        WHEN regexp_matches(l, '{rights}$', 'is') THEN ''
        WHEN regexp_matches(l, '{rights}{grant}', 'is') OR regexp_matches(l, '{rights}{name}', 'is') THEN regexp_replace(l, '{rights}', '', 'is')
        ELSE l END"""
    word = """CASE WHEN w IN ('licence', 'licences', 'licenced', 'sublicence', 'sublicences', 'sublicenced') THEN replace(w, 'licenc', 'licens')
        WHEN w = 'merchantibility' THEN 'merchantability' WHEN w = 'noncommercial' THEN 'non commercial' ELSE w END"""
    lines = f"array_to_string(list_transform(string_split(coalesce({text}, ''), chr(10)), lambda l: {line}), ' ')"
    words = f"list_transform(regexp_extract_all(lower({lines}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F«»·‐-‧]+'), lambda w: {word})"
    return f"trim(replace(' ' || array_to_string({words}, ' ') || ' ', ' copyright owner ', ' copyright holder '))"


def duckdb_sql() -> str:
    """license_scan over the table documents, for DuckDB."""
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    texts = [(i, t) for i, all_of in TEXTS.items() for t in all_of] + [(i, f"{TITLES[i]}\n{t}") for i, all_of in TEXTS.items() if i in TITLES for t in all_of]
    notices = [(i, t) for i, all_of in NOTICES.items() for t in all_of]
    values = ", ".join(f"({quote(i)}, {quote(k)}, {quote(t)})" for k, table in (("text", texts), ("notice", notices)) for i, t in table)
    return f"""
        WITH known AS (
            SELECT DISTINCT license_id, kind, {duckdb_canonical('t')} AS c FROM (VALUES {values}) v(license_id, kind, t)
        ), by_line AS (
            SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
            FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) l
            JOIN (SELECT DISTINCT license_id, c FROM known) k ON trim(line) <> '' AND k.c = {duckdb_canonical('line')}
            GROUP BY doc_id
        )
        SELECT d.doc_id, k.license_id, coalesce(b.notices, '') AS notices
        FROM documents d
        LEFT JOIN (SELECT DISTINCT license_id, c FROM known WHERE kind = 'text') k ON k.c = {duckdb_canonical('d.text')}
        LEFT JOIN by_line b USING (doc_id)
    """
