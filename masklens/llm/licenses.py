"""License scans with DataFrame functions only: TF-IDF cosine to templates, then inheritance by path joins.

The sentences of a file (across its lines), its lines, and windows of words in them are compared with licence notices by sparse
TF-IDF cosine, and the whole text of a licence file with the texts of licences. A template counts only where all the words that
tell its licence (name, version) occur. Where two licences are about as near, or a notice names none that is known,
the answer is ``unknown``. A file without a notice of its own inherits from its nearest ancestor directory that has one:
a directory's licence is that of a licence file in it or of its index page (a path that ends in a slash).
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masklens.llm.common import stored

#: names of software licences as notices write them
SOFTWARE = {
    "0BSD": ("BSD Zero Clause License",),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPLv3"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "BSL-1.0": ("Boost Software License, Version 1.0",),
    "CC0-1.0": ("CC0 1.0 Universal License", "Creative Commons CC0 1.0 Universal License"),
    "EPL-1.0": ("Eclipse Public License 1.0", "Eclipse Public License v1.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPLv3"),
    "ISC": ("ISC License",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPLv2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPLv3"),
    "MIT": ("MIT License", "Expat License"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib License",),
}
CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
            "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
            "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
#: sentences that name no licence
SENTENCES = (
    ("Apache-2.0", "you may not use this file except in compliance with the Apache License, Version 2.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
#: whole licence texts without names and years; longer licences by their titles
_DISCLAIMER = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
               "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
               "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
               "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_NAMES = (" Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
              "from this software without specific prior written permission.")
_BSD_END = (" THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
            "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
            "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
            "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
            "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
            "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
TEXTS = (
    ("MIT", "MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to "
            "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall "
            "be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
            "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
            "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
            "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
            "IN THE SOFTWARE."),
    ("ISC", "ISC License Copyright (c) Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. " + _DISCLAIMER),
    ("0BSD", "BSD Zero Clause License Copyright (c) Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
             "fee is hereby granted. " + _DISCLAIMER),
    ("BSD-2-Clause", "BSD 2-Clause License Copyright (c) All rights reserved. " + _BSD + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License Copyright (c) All rights reserved. " + _BSD + _BSD_NAMES + _BSD_END),
    ("Zlib", "zlib License Copyright (c) This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
             "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of "
             "this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a "
             "product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be "
             "plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered "
             "from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
                  "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and "
                  "by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all "
                  "copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the "
                  "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present "
                  "and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
                  "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
                  "IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
                  "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more "
                  "information, please refer to https://unlicense.org"),
)
TITLES = (
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"), ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"), ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"), ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"), ("EPL-2.0", "Eclipse Public License - v 2.0"),
)
GNU = {"AGPL-3.0": ("Affero General Public License", "3"), "GPL-2.0": ("General Public License", "2"), "GPL-3.0": ("General Public License", "3"),
       "LGPL-2.1": ("Lesser General Public License", "2.1"), "LGPL-3.0": ("Lesser General Public License", "3")}
#: words of any text, and words of licensing that tell no licence
COMMON = frozenset("a all and and/or any are as at by except for in into is it later may new not of option or other out person related right "
                   "rights so terms that the this to use with without work you your".split())
GENERIC = frozenset("commons creative gnu international later license licensed notice option published released software spdx-license-identifier "
                    "universal unported version".split())
LEADS = ("Licensed under", "Released under", "This work is licensed under")
LEAST, MARGIN = 0.6, 0.02
#: windows of up to so many words begin at every place around a key word, longer ones at eight places
EVERY_PLACE, PLACES = 12, 8
#: words; hyphens and dots within join, so that BY-NC, 3-Clause and 2.0 are one word each
TOKEN = r"[\p{L}\p{N}]+(?:[-.][\p{L}\p{N}]+)*"
LICENCE_FILE = r"(?i)^(licen[cs]es?|copying|notice|unlicense)([.-].*)?$"
INLINE = "a|abbr|b|code|em|font|i|small|span|strong|sub|sup|tt|u"
#: where sentences end: at an empty line, and at a mark after two letters before white space ("v. 2.0" goes on)
SENTENCE_END = r"\s*\n\s*\n\s*|(?<=[\p{L}\p{N})\"'][\p{L}\p{N})\"'])[.!?]+(?=\s|$)"
UNKNOWN = "unknown"


def tokens_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[-.][^\W_]+)*", text.lower())


class Template(NamedTuple):
    """A notice; ``telling`` words must all occur where it counts."""

    name: str
    text: str
    telling: frozenset


def notices() -> tuple[Template, ...]:
    """Every form that headers and licence files use, with its telling words: the licence's name and version, and a word of
    licensing where the name might be another word; of a sentence that names none, all but common words."""
    found = [Template(name, text, frozenset(tokens_of(text)) - COMMON) for name, text in SENTENCES]

    def add(name: str, text: str, told: str, *also: str) -> None:
        found.append(Template(name, text, frozenset(tokens_of(told)) - GENERIC - COMMON | frozenset(also)))

    for name, (title, version) in GNU.items():
        add(name, f"you can redistribute it and/or modify it under the terms of the GNU {title} as published by the Free Software Foundation; "
                  f"either version {version} of the License, or (at your option) any later version", f"{title} {version}", "redistribute")
        add(name, f"redistribute it and/or modify it under the terms of the GNU {title}, version {version}", f"{title} {version}", "redistribute")
    for name, text in TITLES:
        add(name, text, text)
    add("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public 2.0")
    add("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "eclipse public 2.0")
    for name, forms in SOFTWARE.items():
        for form in forms:
            word = {"license"} & set(tokens_of(form))  # the German word "mit" is no licence
            for lead in LEADS:
                add(name, f"{lead} the {form}", form, *(word and {tokens_of(lead)[-2]}))
            add(name, form, form, *word)
        for own in (name, f"{name}-only", f"{name}-or-later") if "GPL" in name else (name,):
            found.append(Template(name, f"SPDX-License-Identifier: {own}", frozenset([*tokens_of(own), "spdx-license-identifier"])))
    for kind, words in CREATIVE.items():
        for version, law in (("3.0", "Unported"), ("4.0", "International")):
            name = f"CC-{kind}-{version}"
            add(name, f"This work is licensed under a Creative Commons {words} {version} {law} License", f"{words} {version}", "creative", "commons")
            add(name, f"Licensed under Creative Commons {words} {version}", f"{words} {version}", "creative", "commons")
            for text in (f"Licensed under CC {kind} {version}", f"This work is licensed under CC {kind} {version}", f"CC {kind} {version}"):
                found.append(Template(name, text, frozenset(tokens_of(f"CC {kind} {version}"))))
            found.append(Template(name, f"SPDX-License-Identifier: {name}", frozenset([*tokens_of(name), "spdx-license-identifier"])))
    return tuple(found)


NOTICES = notices()
WHOLE = tuple(Template(name, text, frozenset()) for name, text in TEXTS)


def template_weights(templates: tuple[Template, ...]) -> tuple[dict[str, float], list[dict[str, float]]]:
    """Inverse document frequencies over the templates, and each template's unit vector."""
    words = [tokens_of(t.text) for t in templates]
    idf = {w: math.log((1 + len(words)) / (1 + sum(w in own for own in words))) + 1 for own in words for w in own}
    vectors = []
    for own in words:
        raw = {w: (1 + math.log(own.count(w))) * idf[w] for w in own}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        vectors.append({w: x / norm for w, x in raw.items()})
    return idf, vectors


def key_words(templates: tuple[Template, ...]) -> tuple[list[str], list[str], list[str]]:
    """Of each template's telling words the one that the fewest have; the others of them; and those that stand alone."""
    many = {w: sum(w in t.telling for t in templates) for t in templates for w in t.telling}
    keys = [min(t.telling, key=lambda w: (many[w], w)) for t in templates]
    return (sorted(set(keys)), sorted({w for t, k in zip(templates, keys, strict=True) for w in t.telling if w != k}),
            sorted({k for t, k in zip(templates, keys, strict=True) if len(t.telling) == 1}))


def any_of(words: list[str]) -> str:
    """A pattern of some words that branches by their common beginnings: at a place in a text it tries one way for each first
    character that words have, not one for each word."""
    rest: dict[str, list[str]] = {}
    for w in words:
        if w:
            rest.setdefault(w[0], []).append(w[1:])
    ways = "|".join(re.escape(c) + any_of(own) for c, own in sorted(rest.items()))
    return f"(?:{ways})" + ("?" if "" in words else "") if ways else ""


def can_tell(tokens: Column) -> Column:
    """Whether a segment (its words) has a template's key word, and another telling word unless the key stands alone: without
    them no template counts."""
    keys, others, alone = (F.array(*[F.lit(w) for w in words]).cast("array<string>") for words in key_words(NOTICES))
    return F.arrays_overlap(tokens, alone) | F.arrays_overlap(tokens, keys) & F.arrays_overlap(tokens, others)


def windows(tokens: Column) -> Column:
    """A segment's words, and the windows in it of every template's length that hold a key word: a notice inside a longer
    sentence is compared without the words around it."""
    keys = F.array(*[F.lit(w) for w in key_words(NOTICES)[0]])
    spans = [(n, k) for n in sorted({len(tokens_of(t.text)) for t in NOTICES})
             for k in range(0, n, 1 if n <= EVERY_PLACE else -(-n // PLACES))]
    cuts = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(k).alias("before")) for n, k in spans])

    def cut(line: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(line) - 1), lambda i: F.array_contains(keys, F.get(line, i)))
        around = lambda i: F.transform(F.filter(cuts, lambda c: (c["before"] <= i) & (i - c["before"] + c["n"] <= F.size(line))),
                                       lambda c: F.slice(line, i - c["before"] + 1, c["n"]))
        return F.array_distinct(F.concat(F.array(line), F.flatten(F.transform(places, around))))

    return F.transform(F.array(tokens), cut)[0]


def nearest_templates(segments: DataFrame, templates: tuple[Template, ...], least: float) -> DataFrame:
    """(uid, score, license) of the nearest template at cosine ``least`` or more to any segment (uid, k, words) of a uid that has
    all its telling words; ``unknown`` where another licence is less than ``MARGIN`` further.

    Sparse vectors by join: a segment's words meet the template words (a table of bounded size) and add up to
    one product per template. Words outside the templates count once each at the largest weight.
    """
    idf, vectors = template_weights(templates)
    spark = segments.sparkSession
    known = spark.createDataFrame(
        [(w, idf[w], [(i, own[w], int(w in templates[i].telling)) for i, own in enumerate(vectors) if w in own]) for w in sorted(idf)],
        "word string, idf double, own array<struct<t: int, y: double, told: int>>")
    about = spark.createDataFrame([(i, t.name, len(t.telling)) for i, t in enumerate(templates)], "t int, license string, telling int")
    far = math.log(1 + len(templates)) + 1
    words = (segments.select("uid", "k", F.explode("words").alias("word")).groupBy("uid", "k", "word")
             .agg(F.count(F.lit(1)).cast("double").alias("tf")).join(F.broadcast(known), "word", "left")
             .withColumn("x", F.when(F.col("idf").isNull(), F.lit(far)).otherwise((F.log("tf") + 1.0) * F.col("idf"))))
    square = F.sum(F.col("x") * F.col("x")).alias("square")
    each = F.transform("own", lambda o: F.struct(o["t"].alias("t"), (F.col("x") * o["y"]).alias("y"), o["told"].alias("told")))
    summed = (words.groupBy("uid", "k").agg(square, F.flatten(F.collect_list(each)).alias("own"))
              .select("uid", "k", "square", F.explode("own").alias("own"))
              .groupBy("uid", "k", "square", F.col("own")["t"].alias("t"))
              .agg(F.sum(F.col("own")["y"]).alias("dot"), F.sum(F.col("own")["told"]).alias("told")))
    score = F.round(F.col("dot") / F.sqrt("square"), 6)
    best = (summed.join(F.broadcast(about), "t").where(F.col("told") == F.col("telling")).groupBy("uid", "license").agg(F.max(score).alias("score"))
            .where(F.col("score") >= least)
            # at most as many as there are licences
            .groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("score", "license")), asc=False).alias("near")))
    first = F.col("near")[0]
    # a notice of the LGPL or the AGPL holds all words of the GPL's
    others = F.filter("near", lambda x: ~first["license"].endswith(x["license"]))
    tied = F.coalesce(first["score"] - F.get(others, 0)["score"] < MARGIN, F.lit(False))
    return best.select("uid", first["score"].alias("score"), F.when(tied, UNKNOWN).otherwise(first["license"]).alias("license"))


def scan(files: DataFrame, path: str, *, file_id: str = "page_id", url: str = "url", body: str = "html",
         least: float = LEAST) -> DataFrame:
    """One row per file: ``page_id``, ``host``, ``path``, ``own_license``, ``own_score``, ``license``,
    ``inherited_from`` (directory) and ``status`` (own, unknown, inherited or none).

    Markup is cut out of the whole text (comments stay); its sentences, its lines and the word windows in them (``windows``) are
    compared with ``NOTICES``, and a licence file as a whole with the ``TEXTS`` of licences. The nearest at cosine ``least``
    or more is the file's own licence, a text's before a notice's; it is ``unknown`` if another licence is within ``MARGIN`` of it, or
    if the file says "licensed under" or "released under" and nothing known follows. The directory of a file
    is its path up to the last slash; of several declarations in a directory a licence file comes first, then the larger score,
    then the licence's name; unknown ones declare nothing. Null and empty texts have no notice; a null or odd URL has no
    directory and inherits nothing; repeated rows get equal results; an empty table gives an empty result; other columns are
    not read.

    Scale: texts are read once and never shuffled; only segments that have a template's telling words are. Ancestors are looked up
    once per distinct directory (pre-aggregated), and files join their directory's answer; both sides are stored, so
    that adaptive execution can split a host or directory that holds a third of all files.
    """
    keys, _, _ = key_words(NOTICES)
    hint = r"(?i)(?<![\p{L}\p{N}])" + any_of(keys) + r"(?![\p{L}\p{N}])"
    open_text = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(body), F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>", "\n\n"),
                                 r"<!--|-->", "\n\n")
    plain = F.regexp_replace(F.regexp_replace(open_text, rf"(?i)</?({INLINE})(\s[^>]*)?>", " "), r"<[^>]*>", "\n\n")
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    rows = (files.select(F.col(file_id).alias("page_id"), F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://([^/?#]+)", 1).alias("host"),
                         F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://[^/?#]+([^?#]*)", 1).alias("path"), plain.alias("plain"))
            .withColumn("host", F.when(F.col("host") != "", F.lower("host")))
            .withColumn("path", F.when(F.col("host").isNotNull(), F.when(F.col("path") == "", F.lit("/")).otherwise(F.col("path"))))
            .withColumn("is_file", F.coalesce(name.rlike(LICENCE_FILE), F.lit(False)))
            .withColumn("dir", F.regexp_extract("path", r"^(.*/)[^/]*$", 1)))
    told = lambda x: F.regexp_extract_all(F.lower(x), F.lit(f"({TOKEN})"), 1)
    parts = F.filter(F.array_union(F.split("plain", SENTENCE_END), F.split("plain", r"\R")), lambda x: x.rlike(hint))
    lines = F.filter(F.transform(parts, told), can_tell)
    segments = F.filter(F.flatten(F.transform(lines, windows)), can_tell)
    none = F.array().cast("array<array<string>>")
    # the row number is fixed by the write: every later table goes by it
    cut = stored(rows.select(F.monotonically_increasing_id().alias("uid"), "page_id", "host", "path", "dir", "is_file",
                             F.when(F.col("plain").rlike(hint), segments).otherwise(none).alias("segments"),
                             F.when(F.col("is_file"), told(F.col("plain"))).alias("whole"),
                             F.col("plain").rlike(r"(?i)\b(licensed|released)\s+under\b").alias("says")), f"{path}/cut")
    noted = nearest_templates(cut.select("uid", F.posexplode("segments").alias("k", "words")), NOTICES, least)
    texts = nearest_templates(cut.where("whole is not null").select("uid", F.lit(0).alias("k"), F.col("whole").alias("words")), WHOLE, least)
    found = noted.withColumn("text", F.lit(0)).unionByName(texts.withColumn("text", F.lit(1))).groupBy("uid").agg(
        F.max(F.struct("text", "score", "license")).alias("near"))
    scored = stored(cut.drop("segments", "whole").join(found, "uid", "left").select(
        "page_id", "host", "path", "dir", "is_file",
        F.coalesce(F.col("near")["license"], F.when(F.col("says"), UNKNOWN)).alias("own_license"),
        F.col("near")["score"].alias("own_score")), f"{path}/scored")
    said = (scored.where(F.col("own_license").isNotNull() & (F.col("own_license") != UNKNOWN) & F.col("host").isNotNull()
                         & (F.col("is_file") | F.col("path").endswith("/")))
            .groupBy("host", "dir").agg(F.max(F.struct("is_file", "own_score", "own_license")).alias("said"))
            .select("host", F.col("dir").alias("up"), F.col("said")["own_license"].alias("license")))
    said = stored(said, f"{path}/said")
    steps = F.split(F.col("dir"), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps) - 1),
                        lambda k: F.concat(F.array_join(F.slice(steps, F.lit(1), k), "/"), F.lit("/")))
    dirs = scored.where("host is not null and dir <> ''").select("host", "dir").distinct()
    nearest = stored(dirs.withColumn("up", F.explode(above)).join(said, ["host", "up"])
                     .groupBy("host", "dir").agg(F.max(F.struct(F.length("up").alias("depth"), "up", "license")).alias("near"))
                     .select("host", "dir", F.col("near")["up"].alias("near_dir"), F.col("near")["license"].alias("near_license")),
                     f"{path}/nearest")
    own = F.col("own_license").isNotNull()
    return (scored.join(nearest, ["host", "dir"], "left").select(
        "page_id", "host", "path", "own_license", "own_score", F.coalesce("own_license", "near_license").alias("license"),
        F.when(~own, F.col("near_dir")).alias("inherited_from"),
        F.when(F.col("own_license") == UNKNOWN, UNKNOWN).when(own, "own").when(F.col("near_license").isNotNull(), "inherited")
        .otherwise("none").alias("status")))
