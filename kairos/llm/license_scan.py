"""License scans: MinHash bands over overlapping windows, then exact shingle containment.  DataFrame operations only.

Texts and templates become sequences of 5-word shingles (words: runs of letters
and digits, lower case); a template of fewer words is one shingle of its own
length, and texts are cut into shingles of that length for it.  A template of s
shingles belongs to the scale c = 2**ceil(log2 s); documents are cut into
windows of 2c shingles every c, so every occurrence lies inside one window.
Window and template are sketched by BANDS minimum hashes of one row each; a
shared band retrieves the template.  A window that holds ``containment`` of a
template has a similarity of at least 0.18 to it, thus shares a band with
probability 1 - (1 - 0.18)**BANDS, over 0.998 for 32 bands (an exact occurrence
without the rest of a scale's slack: more).  Each retrieved template is verified
by the exact share of its shingles inside the window.

Two steps save work without losing a match.  Anchor words: a set of words such
that any text holding ``containment`` of a template's shingles must hold one of
them (proved on the templates, see ``anchors``); documents without an anchor can't
match.  And a window that shares no shingle with any template shares no minimum
with one, so it isn't sketched.

Defined cases: null, empty and wordless texts have no finding.  A template
without words is ignored.  Rows equal in id and text are reported once.  Null ids are carried.
Extra columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K, BANDS = 5, 32
#: words of a place at which findings are compared
CELL = 64
#: words of all templates together up to which their tables are broadcast
MAX_BROADCAST_WORDS = 100_000

# Identifiers and titles of public licenses.
TITLES = [
    ("0BSD", "BSD Zero Clause License"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Artistic-2.0", "Artistic License 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSL-1.0", "Boost Software License, Version 1.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("EPL-2.0", "Eclipse Public License 2.0"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("ISC", "ISC License"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("MIT", "MIT License"),
    ("MIT-0", "MIT No Attribution License"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("Unlicense", "Unlicense"),
    ("Zlib", "zlib License"),
]

# Ways in which notices name a license by its title or identifier.
FORMS = ["Licensed under the {title}", "Released under the {title}", "Distributed under the {title}", "Available under the {title}",
         "SPDX-License-Identifier: {id}"]

# Wording of public license notices.
_WARRANTY_OF_GNU = ("This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details.")
_GNU_GRANT = ("This {what} is free software{sep} you can redistribute it and/or modify it under the terms of the GNU {kind} as published by "
              "the Free Software Foundation{sep2} either version {version} of the License, or (at your option) any later version. ")
_PERMISSION = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
               "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
               "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
               "persons to whom the Software is furnished to do so")
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
          "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
          "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
          "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_REDISTRIBUTION = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                   "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
                   "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
                   "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_DISCLAIMER = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
                   "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
                   "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
                   "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
                   "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
                   "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
                   "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC_GRANT = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted")
_ISC_DISCLAIMER = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
                   "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
                   "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
                   "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
                   "THIS SOFTWARE.")


def _gnu(kind: str, version: str, what: str = "program") -> list[str]:
    """The grant alone, and the grant with the warranty notice."""
    grant = _GNU_GRANT.format(what=what, sep=":", sep2=",", kind=kind, version=version)
    return [grant, grant + _WARRANTY_OF_GNU.format(what=what, kind=kind)]


NOTICES = [(id_, f.format(id=id_, title=title)) for id_, title in TITLES for f in FORMS] + [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
     "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License."),
    ("MIT", _PERMISSION + ", subject to the following conditions: The above copyright notice and this permission notice shall be included in "
     "all copies or substantial portions of the Software. " + _AS_IS),
    ("MIT-0", _PERMISSION + ". " + _AS_IS),
    ("BSD-2-Clause", _REDISTRIBUTION + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _REDISTRIBUTION + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
     "or promote products derived from this software without specific prior written permission. " + _BSD_DISCLAIMER),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_DISCLAIMER),
    ("0BSD", _ISC_GRANT + ". " + _ISC_DISCLAIMER),
    *[("GPL-2.0", t) for t in _gnu("General Public License", "2")],
    *[("GPL-3.0", t) for t in _gnu("General Public License", "3")],
    *[("LGPL-2.1", t) for t in _gnu("Lesser General Public License", "2.1", "library")],
    *[("LGPL-3.0", t) for t in _gnu("Lesser General Public License", "3")],
    *[("AGPL-3.0", t) for t in _gnu("Affero General Public License", "3")],
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
     "available at"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
     "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
     "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this "
     "software must not be misrepresented; you must not claim that you wrote the original software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
     "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
     "non-commercial, and by any means."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("All-rights-reserved", "All rights reserved."),
]


def words(text: str) -> list[str]:
    """The word definition of WORDS_SQL, for templates."""
    return re.findall(r"[^\W_]+", text.lower())


#: words of a text column as SQL
WORDS_SQL = r"array_remove(split(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), '')"


def _shingle_words(w: list[str], k: int | None = None) -> list[tuple[str, ...]]:
    k = k or min(K, len(w))
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if k else []


def anchors(notices: list[tuple[str, str]], containment: float) -> list[str]:
    """Words such that, for every template, fewer than ``containment`` of its shingles hold none of them."""
    sets = [set(_shingle_words(words(t))) for _, t in notices]
    sets = [s for s in sets if s]
    chosen: list[str] = []

    def open_(s):
        rest = sum(not any(a in sh for a in chosen) for sh in s)
        return rest >= containment * len(s)

    while left := [s for s in sets if open_(s)]:
        use = Counter(w for s in left for w in {w for sh in s for w in sh} if w not in chosen)
        # longer words first: they are rarer in texts; then the one that serves most templates
        chosen.append(max(use, key=lambda w: (min(len(w), 6), use[w], len(w), w)))
    return chosen


def _scale(n: int) -> int:
    c = 1
    while c < n:
        c *= 2
    return c


def _shingles_sql(w: str, k: str) -> str:
    return (f"case when size({w}) < {k} then cast(array() as array<bigint>) else transform(sequence(0, size({w}) - {k}), "
            f"i -> xxhash64(array_join(slice({w}, i + 1, {k}), ' '))) end")


def _bands_sql(s: str) -> str:
    """(band, minimum hash) pairs of an array of shingles; each band has its own hash of a shingle."""
    return f"transform(sequence(0, {BANDS - 1}), b -> struct(b as band, array_min(transform({s}, x -> xxhash64(x, b))) as low))"


def _best_per_place(found: DataFrame) -> DataFrame:
    """``found`` without findings that another license beats at every place (``CELL`` words) they lie in.

    Where they overlap, a license that holds a greater share of its own template and no fewer words of it wins (a GPL-2.0
    header holds most of a GPL-3.0 one); at equal shares, one that stands there word for word wins over a template of up to
    four shingles inside it (the identifier MIT-0 begins with MIT).
    """
    # each license once per cell: a cell's list is no longer than the list of licenses
    cells = (found.withColumn("cell", F.explode(F.expr(f"sequence(first_word div {CELL}, last_word div {CELL})")))
             .groupBy("row", "id", "cell", "license")
             .agg(F.max(F.struct("share", "held", "first_word", "last_word", "whole", "small")).alias("f")))
    by_cell = cells.groupBy("row", "id", "cell").agg(F.collect_list(F.struct("license", "f")).alias("all"))
    wins = ("exists(all, o -> o.license != a.license and o.f.held >= a.f.held and o.f.first_word <= a.f.last_word "
            "and a.f.first_word <= o.f.last_word and (o.f.share > a.f.share or (o.f.share = a.f.share and o.f.whole and a.f.small "
            "and o.f.held > a.f.held and o.f.first_word <= a.f.first_word and a.f.last_word <= o.f.last_word)))")
    stay = by_cell.select("row", "id", F.expr(f"explode(filter(all, a -> not {wins}))").alias("kept"))
    return stay.select("row", "id", F.col("kept.license").alias("license")).distinct()


def scan(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES, containment: float = 0.8, id_col: str = "doc_id",
         text_col: str = "text", best: bool = False) -> DataFrame:
    """(id, license, containment, first_word, n_windows): per document and license the best window of its templates.

    Several notices may bear one name.  ``best`` leaves out licenses that others beat wherever they are found.
    """
    spark = docs.sparkSession
    known = []
    for name, text in notices:
        if w := words(text):
            k = min(K, len(w))
            known.append((len(known), name, text, len(w), k, _scale(len(_shingle_words(w, k)))))
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    empty = "id {0}, license string, containment double, first_word bigint, n_windows bigint".format(src.schema["id"].dataType.simpleString())
    if not known:
        return spark.createDataFrame([], empty).withColumnRenamed("id", id_col)
    # a table of the given list, broadcast while the list is short
    short = F.broadcast if sum(r[3] for r in known) <= MAX_BROADCAST_WORDS else (lambda df: df)
    templates = (spark.createDataFrame(known, "template int, license string, t string, n_words int, k int, scale int")
                 .select("template", "license", "n_words", "k", "scale",
                         F.expr(f"array_distinct({_shingles_sql(WORDS_SQL.format('t'), 'k')})").alias("ts")))
    kinds = templates.groupBy("k", "scale").agg(F.array_distinct(F.flatten(F.collect_list("ts"))).alias("theirs"))
    bands = templates.select("template", "k", "scale", F.expr(f"inline({_bands_sql('ts')})"))
    holds = " or ".join(f"contains(low, '{a}')" for a in anchors(notices, containment))
    cut = (src.withColumn("low", F.lower("text")).where(holds)
           .select("id", F.xxhash64("text").alias("row"), F.expr(WORDS_SQL.format("low")).alias("w")))
    by_k = F.array(*[F.struct(F.lit(k).alias("k"), F.array(*[F.lit(c) for c in sorted({r[5] for r in known if r[4] == k})]).alias("scales"))
                     for k in sorted({r[4] for r in known})])
    windows = (cut.withColumn("kind", F.explode(by_k))
               .select("id", "row", "kind.k", "kind.scales", F.expr(_shingles_sql("w", "kind.k")).alias("s"))
               .select("id", "row", "k", "s", F.explode("scales").alias("scale"))
               .join(short(kinds), ["k", "scale"]).where("arrays_overlap(s, theirs)")
               .select("id", "row", "k", "scale", "s", "theirs", F.explode(F.expr("sequence(0, (size(s) - 1) div scale)")).alias("no"))
               .select("id", "row", "k", "scale", "theirs", F.expr("no * scale").alias("start"),
                       F.expr("slice(s, cast(no * scale + 1 as int), 2 * scale)").alias("ws"))
               .where("arrays_overlap(ws, theirs)"))
    met = (windows.select("id", "row", "k", "scale", "start", "ws", F.expr(f"inline({_bands_sql('ws')})"))
           .join(short(bands), ["k", "scale", "band", "low"])
           .join(short(templates.drop("k", "scale")), "template"))
    verified = (met.withColumn("common", F.array_intersect("ws", "ts"))
                .withColumn("share", F.size("common") / F.size("ts")).where(F.col("share") >= containment)
                .withColumn("first_word", F.expr("start + array_position(ws, common[0]) - 1"))
                .withColumn("last_word", F.expr("start + array_position(ws, element_at(common, -1)) + k - 2"))
                .withColumn("held", F.col("share") * F.col("n_words"))
                .withColumn("whole", F.expr("share = 1 and last_word - first_word + 1 = n_words"))
                .withColumn("small", F.size("ts") <= 4))
    kept = _best_per_place(verified) if best else None
    found = (verified.groupBy("row", "id", "license", "start")
             .agg(F.max("share").alias("share"), F.min("first_word").alias("first_word"))
             .groupBy("row", "id", "license")
             .agg(F.max("share").alias("containment"), F.min("first_word").alias("first_word"), F.count("*").alias("n_windows")))
    if best:
        same = [F.col(f"f.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("row", "id", "license")]
        found = found.alias("f").join(kept.alias("s"), same, "left_semi")
    return found.select(F.col("id").alias(id_col), "license", "containment", F.col("first_word").cast("bigint").alias("first_word"), "n_windows")
