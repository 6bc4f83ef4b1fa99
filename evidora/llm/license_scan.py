"""Licence scan: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

Words are runs of letters and digits in lower case; a shingle is ``SHINGLE`` words (fewer where a template is shorter).
A template's shingles give a signature of ``HASHES`` minima; so do windows of the texts, as long as the template and
laid every quarter of that, in bands of one row. A window that holds a whole template has a Jaccard similarity of 0.6
or more with it, so it misses all bands with a probability of 0.4 ** HASHES, about 1e-8 (with one that is contained by
0.8 and laid worst, 5e-5). Candidates are verified by exact containment: the share of the template's shingles, as words,
that the window and its overlap have; ``CONTAINMENT`` or more is a match.

A band's bucket is looked up by the shingle that has the template's minimum there: only a window that holds it can have
the same minimum. So windows are laid around these shingles alone, which leaves out no collision; a window then is a
candidate if the minima of a band are equal. Templates are a parameter of bounded size, so their table is broadcast; a
licence may have several.

Everything is a DataFrame operation. Defined cases: a null text counts as empty and has no row in the result, like any
text without a licence; equal rows (doc_id and text) are one document, other rows with equal or null doc_ids are
documents of their own; texts of any length are scanned whole; an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidora.llm.common import let

#: Public licence texts and the notices that licences ask for.
NOTICES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
        SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
        the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
        WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
        LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
        in the documentation and/or other materials provided with the distribution.""",
    "BSD-3-Clause": """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
        from this software without specific prior written permission.""",
    "BSD-disclaimer": """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
        BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
        arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be
        misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the
        product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be
        misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by
        any means.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
        documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to
        prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
        implied. See the License for the specific language governing permissions and limitations under the License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
        this file, You can obtain one at""",
}
#: The notice of the GNU licences, by licence name, version and kind of work.
_GNU = """{work} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation,
    {version} of the License, or (at your option) any later version. {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
    without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."""
_GNU_NAMES = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
#: Names by which a text says what it is under.
_NAMES = {
    "MIT": ("the MIT License", "the MIT licence", "an MIT license", "MIT license"), "ISC": ("the ISC License",), "Unlicense": ("the Unlicense license",), "BSL-1.0": ("the Boost Software License",), "Zlib": ("the zlib License",),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License"), "BSD-3-Clause": ("the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License", "the Modified BSD License"),
    "Apache-2.0": ("the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License", "the Apache-2.0 License", "Apache License 2.0"),
    "MPL-2.0": ("the Mozilla Public License, version 2.0", "the Mozilla Public License, v. 2.0", "the Mozilla Public License 2.0", "the MPL 2.0"),
    "EPL-2.0": ("the Eclipse Public License 2.0", "the Eclipse Public License, version 2.0", "the Eclipse Public License v2.0"),
}


def _templates() -> dict[str, tuple[str, ...]]:
    """The templates by licence: notices, and what a line like "released under ..." says, by the rules here."""
    found: dict[str, list[str]] = {name: [body] for name, body in NOTICES.items()}
    add = lambda name, *bodies: found.setdefault(name, []).extend(bodies)
    for name, said in _NAMES.items():
        add(name, *(f"under {x}" for x in said))
    for short, name in _GNU_NAMES.items():
        for version in ("2", "3") if short == "GPL" else ("2.1", "3") if short == "LGPL" else ("3",):
            own = f"{short}-{version}.0" if len(version) == 1 else f"{short}-{version}"
            add(own, *(_GNU.format(work=work, name=name, version=said) for work in ("This program", "This library") for said in (f"either version {version}",)))
            add(own, *(f"under the {name}{said}" for said in (f", version {version}", f" v{version}", f" {version}.0")), f"under the {short}v{version}", f"under {short}-{version}.0", f"under the {short} version {version}")
    for terms in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        for version in ("3.0", "4.0"):
            add(f"CC-{terms}-{version}", f"under CC {terms} {version}", f"under a CC {terms} {version}", f"under the CC {terms} {version}")
    add("CC0-1.0", "under CC0 1.0", "under the CC0 1.0 Universal", "dedicated to the public domain")
    add("all-rights-reserved", "All rights reserved.")
    return {name: tuple(bodies) for name, bodies in found.items()}


TEMPLATES = _templates()

#: Production parameters.
SHINGLE = 5
HASHES = 20
CONTAINMENT = 0.8
_WORD = r"[\p{L}\p{N}]+"


def _words(text: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[^\W_]+", text)]


def _hash(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(size)])


def _shingles(words: Column, size: int) -> Column:
    """The hashes of all shingles in order; none where the words are too few."""
    places = F.sequence(F.lit(0), F.size(words) - size)
    return F.when(F.size(words) < size, F.array().cast("array<bigint>")).otherwise(F.transform(places, lambda i: _hash(words, i, size)))


def _minima(hashes: Column) -> Column:
    """HASHES minima of a window's hashes, each over another scrambling of them."""
    return F.transform(F.sequence(F.lit(1), F.lit(HASHES)), lambda k: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, k))))


def _class(n_words: int) -> tuple[int, int, int]:
    """(shingle, window, stride) of a template of so many words."""
    return min(SHINGLE, n_words), n_words, max(1, n_words // 4)


def _table(spark, templates: dict[str, str | tuple[str, ...]]) -> DataFrame | None:
    """license, size (of a shingle), window, words, hashes and minima of each template; None if there is none."""
    known = {(name, tuple(words)) for name, bodies in templates.items() for body in ([bodies] if isinstance(bodies, str) else bodies) if (words := _words(body))}
    if not known:
        return None
    rows = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(len(words)).alias("window"), F.lit(" ".join(words)).alias("body")) for name, words in sorted(known)])
    table = spark.range(1).select(F.inline(rows)).withColumn("words", F.split("body", " ")).withColumn("size", F.least(F.lit(SHINGLE), F.col("window")))
    hashes = F.coalesce(*[F.when(F.col("size") == n, _shingles(F.col("words"), n)) for n in sorted({min(SHINGLE, len(w)) for _, w in known})])
    hashed = table.withColumn("hashes", let(hashes, F.array_distinct))
    return hashed.select("license", "size", "window", "words", "hashes", let(F.col("hashes"), _minima).alias("minima"))


def scan(docs: DataFrame, templates: dict[str, str | tuple[str, ...]] | None = None, text: str = "text") -> DataFrame:
    """doc_id, license, containment (the best) and first_word (of the first such window), a row for each document and licence."""
    table = _table(docs.sparkSession, TEMPLATES if templates is None else templates)
    if table is None:
        return docs.select("doc_id", F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).alias("first_word")).filter(F.lit(False))
    lowest = lambda h, k: F.xxhash64(h, k)
    posts = F.filter("hashes", lambda h: F.exists(F.transform("minima", lambda m, k: m == lowest(h, k + 1)), lambda x: x))
    kinds: dict[tuple[int, int, int], set[int]] = {}
    for r in table.select("window", posts.alias("posts")).collect():  # the templates: HASHES posts each at most
        kinds.setdefault(_class(r.window), set()).update(r.posts)
    sizes = sorted({k[0] for k in kinds})
    whole = F.coalesce(F.col(text), F.lit(""))
    keys = [F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), "doc_id", F.octet_length(whole), whole).alias(name) for seed, name in enumerate(("_k1", "_k2"), 1)]
    base = docs.select("doc_id", *keys, F.regexp_extract_all(F.lower(whole), F.lit(_WORD), 0).alias("_words"))

    def windows(words: Column) -> Column:
        """The windows of every class that hold a post of a template of the class: (window, start, words)."""

        def around(found: Column, kind: tuple[int, int, int]) -> Column:
            # a shingle at i lies in the windows that start at multiples of the stride from i + size - window to i
            size, window, stride = kind
            own = F.filter(found, lambda x: x["h"].isin(list(kinds[kind])))
            starts = F.array_distinct(F.flatten(F.transform(own, lambda x: F.sequence(
                F.greatest(F.lit(0), F.floor((x["i"] + size - window - 1) / stride).cast("int")), F.floor(x["i"] / stride).cast("int")))))
            return F.transform(starts, lambda s: F.struct(F.lit(window).alias("window"), (s * stride).cast("int").alias("start"), F.slice(words, s * stride + 1, window + stride).alias("words")))

        def near(size: int) -> Column:
            every = list(set().union(*(posts for kind, posts in kinds.items() if kind[0] == size)))
            hits = F.filter(F.transform(_shingles(words, size), lambda h, i: F.when(h.isin(every), F.struct(i.alias("i"), h.alias("h")))), lambda x: x.isNotNull())
            none = F.array().cast("array<struct<window:int,start:int,words:array<string>>>")
            return let(hits, lambda found: F.when(F.size(found) == 0, none).otherwise(F.concat(*[around(found, kind) for kind in sorted(kinds) if kind[0] == size])))

        return F.concat(*map(near, sizes))

    opened = base.select("doc_id", "_k1", "_k2", F.explode(let(F.col("_words"), windows)).alias("w")).select("doc_id", "_k1", "_k2", "w.*")
    own = F.least(F.lit(SHINGLE), F.col("window"))
    hashes = F.coalesce(*[F.when(own == n, _shingles(F.slice("words", 1, F.col("window")), n)) for n in sizes])
    marked = opened.withColumn("_minima", let(hashes, _minima))
    held = F.broadcast(table.select("license", "size", "window", F.col("words").alias("template"), "minima"))  # templates are bounded
    bands = F.exists(F.zip_with("_minima", "minima", lambda a, b: a == b), lambda x: F.coalesce(x, F.lit(False)))
    candidates = marked.join(held, "window").filter(bands)

    def grams(words: Column, n: int) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.slice(words, i + 1, n)))

    share = F.coalesce(*[F.when(F.col("size") == n, F.size(F.array_intersect(grams(F.col("words"), n), grams(F.col("template"), n))) / F.size(grams(F.col("template"), n))) for n in sizes])
    matched = candidates.filter(F.size("words") >= F.col("size")).withColumn("containment", share).filter(F.col("containment") >= CONTAINMENT)
    found = matched.groupBy("_k1", "_k2", "doc_id", "license").agg(F.max("containment").alias("containment"), F.min("start").cast("int").alias("first_word"))
    return found.drop("_k1", "_k2")
