"""Licence scan: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory that holds a licence file."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, forget, small_side, text_or_empty, written

_AS_IS_MIT = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_PERMISSION_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
_CONDITIONS_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code
must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution."""
_NAMES_BSD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_AS_IS_BSD = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_FREE_GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
_HOPE_GPL = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU"
_FSF = "Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."

# Notices, headers and beginnings of licence texts as their publishers give them, by SPDX id where there is one.
NOTICES = (
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("AGPL-3.0", f"GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 {_FSF}"),
    ("AGPL-3.0", f"{_FREE_GPL} Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. {_HOPE_GPL} Affero General Public License for more details."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
    CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("BSD-2-Clause", f"{_CONDITIONS_BSD} {_AS_IS_BSD}"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", f"{_CONDITIONS_BSD} {_NAMES_BSD} {_AS_IS_BSD}"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal Public Domain Dedication"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-2.0", """Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM
    CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT."""),
    ("GPL-2.0", f"{_FREE_GPL} General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. {_HOPE_GPL} General Public License for more details."),
    ("GPL-2.0", """GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA Everyone is permitted to
    copy and distribute verbatim copies of this license document, but changing it is not allowed."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", f"{_FREE_GPL} General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", f"{_FREE_GPL} General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. {_HOPE_GPL} General Public License for more details."),
    ("GPL-3.0", f"GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 {_FSF}"),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in
    all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
    AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
    TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("LGPL-3.0", f"{_FREE_GPL} Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. {_HOPE_GPL} Lesser General Public License for more details."),
    ("LGPL-3.0", f"GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 {_FSF}"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Released under the MIT License."),
    ("MIT", f"MIT License Copyright (c) {_PERMISSION_MIT} {_AS_IS_MIT}"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
    compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to
    anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"""),
    ("proprietary", "All rights reserved."),
)
# Words of which a notice's first or second line has one.
CUES = (
    "licence", "license", "licensed", "licenses", "copyright", "rights", "permission", "permitted", "redistribution", "redistribute", "redistributions", "warranty", "warranties", "unencumbered", "gpl", "lgpl",
    "agpl", "mpl", "epl", "isc", "spdx", "cc", "cc0", "creative", "mozilla", "eclipse",
)
#: Cosine from which a header counts as a notice.
COSINE = 0.7
#: Lines with a word that are joined to a header, from each line with a cue on: a wrapped notice comes close to one of these lengths.
LINES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)
#: Lines that are looked through together; a text of any number of lines with cues takes work in proportion to it.
STRETCH = 64
#: Words beyond which a header is no notice, which have some 300 at most; and the share of its different words that must be in the templates.
MOST_WORDS, KNOWN = 800, 1 / 3
#: A text of so few words with a notice in it is a licence file, whatever its name.
FILE_WORDS = 40
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice)([.\-_].*)?$"
BETWEEN = r"[^\p{L}\p{N}]+"


def tokens_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


VOCABULARY = sorted({t for _, notice in NOTICES for t in tokens_of(notice)})
_ONE_OF = "(^|[^\\p{L}\\p{N}])(" + "|".join(CUES) + ")($|[^\\p{L}\\p{N}])"


def _tokens(col: str | Column) -> Column:
    return F.array_remove(F.split(F.lower(col), BETWEEN), "")


def weights(n: int, found: dict[str, int]) -> dict[str, float]:
    """The weight of each word of the templates by the rows that have it, and of "", which stands for any other word: their mean."""
    out = {t: math.log((n + 1) / (found.get(t, 0) + 1)) + 1 for t in VOCABULARY}
    return out | {"": sum(out.values()) / len(out)}


def notice_vectors(idf: dict[str, float]) -> list[dict[str, float]]:
    """The TF-IDF vector of each notice, of length 1."""
    out = []
    for _, notice in NOTICES:
        words = tokens_of(notice)
        vector = {t: words.count(t) * idf[t] for t in sorted(set(words))}
        length = math.sqrt(sum(x * x for x in vector.values()))
        out.append({t: x / length for t, x in vector.items()})
    return out


def headers(rows: DataFrame) -> DataFrame:
    """(key, at, tokens) of rows (key, text): for each line with a cue that line, and it with the next ones, joined, as far as they may be near a notice."""
    lines = rows.select("key", F.filter(F.split(F.lower("text"), "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]")).alias("lines")).filter(F.size("lines") > 0)
    # Each line with a cue goes on with the lines of its stretch, not with those of the whole text.
    stretch = lambda i: F.struct((i * STRETCH).alias("from"), F.slice("lines", i * STRETCH + 1, STRETCH + LINES[-1] - 1).alias("lines"))
    numbers = F.sequence(F.lit(0), F.floor((F.size("lines") - 1) / STRETCH).cast("int"))
    stretches = lines.select("key", F.size("lines").alias("all"), F.explode(F.transform(numbers, stretch)).alias("s")).select("key", "all", "s.from", "s.lines")
    own = F.sequence(F.lit(0), F.least(F.size("lines"), F.lit(STRETCH)) - 1)
    starts = stretches.select("key", "all", "from", "lines", F.explode(F.filter(own, lambda i: F.get(F.col("lines"), i).rlike(_ONE_OF))).alias("i"))
    starts = starts.select("key", (F.col("from") + F.col("i")).alias("at"), (F.col("all") - F.col("from") - F.col("i")).alias("left"), F.slice("lines", F.col("i") + 1, LINES[-1]).alias("lines"))
    # A length is of use if the next shorter one leaves a line out.
    lengths = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(m).alias("shorter")) for m, n in zip((0, *LINES), LINES, strict=False)])
    useful = F.transform(F.filter(lengths, lambda x: x["shorter"] < F.col("left")), lambda x: x["n"])
    windows = starts.select("key", "at", F.explode(useful).alias("n"), "lines").select("key", "at", "n", _tokens(F.array_join(F.slice("lines", 1, F.col("n")), " ")).alias("tokens"))
    different = F.array_distinct("tokens")
    known = F.size(F.array_intersect(different, F.array(*map(F.lit, VOCABULARY)))) >= KNOWN * F.size(different)
    return windows.filter(F.size("tokens") <= MOST_WORDS).filter(known)


def own_notices(rows: DataFrame, cosine: float = COSINE) -> tuple[DataFrame, DataFrame]:
    """(all rows without text, notices): (key, license, similarity) of the best notice among the headers of each of rows (key, text, ...) that has one.

    Headers are lines with a cue and what follows them, joined over 1 to 32 lines, so that wrapped notices, comment marks and whole short
    licence files come near their templates. A vector has a header's words by their counts times ln((rows + 1) / (rows with the word + 1)) + 1 over all
    rows; words that no template has weigh as much as the templates' mean word. Of equal similarities (6 places) the first name wins. Texts are
    read once: what is written of them is which words of the templates they have, and the texts with a cue themselves.
    """
    spark = rows.sparkSession
    known, cues = F.array(*map(F.lit, sorted({*VOCABULARY, *CUES}))), F.array(*map(F.lit, CUES))
    scan = rows.withColumn("has", F.array_intersect(_tokens("text"), known)).withColumn("text", F.when(F.arrays_overlap("has", cues), F.col("text")))
    scan = written(scan, "license-scan")
    found = {r["token"]: r["n"] for r in scan.select(F.explode("has").alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()}
    idf = weights(scan.stored.rows, found)
    vectors = notice_vectors(idf)
    sent_idf = spark.createDataFrame(sorted(idf.items()), "known string, idf double")
    sent = spark.createDataFrame([(i, t, x) for i, v in enumerate(vectors) for t, x in v.items()], "notice int, token string, weight double")
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(NOTICES)], "notice int, license string")
    words = headers(scan.filter("text is not null").select("key", "text")).select("key", "at", "n", F.explode("tokens").alias("token"))
    header = ["key", "at", "n"]
    terms = words.groupBy(*header, "token").agg(F.count("*").alias("tf")).join(F.broadcast(sent_idf), F.col("token") == F.col("known"), "left")
    terms = written(terms.select(*header, "token", (F.col("tf") * F.coalesce("idf", F.lit(idf[""]))).alias("x")), "license-terms")
    length = terms.groupBy(*header).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    dots = terms.join(F.broadcast(sent), "token").groupBy(*header, "notice").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    near = dots.join(length, header).withColumn("similarity", F.round(F.col("dot") / F.col("length"), 6)).filter(F.col("similarity") >= cosine)
    best = near.join(F.broadcast(names), "notice").groupBy("key").agg(F.min(F.struct((-F.col("similarity")).alias("less"), "license")).alias("best"))
    own = written(best.select("key", F.col("best.license").alias("license"), (-F.col("best.less")).alias("similarity")), "license-own")
    forget(terms)
    return scan.drop("text", "has"), own


def _directory(path: str | Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def license_scan(docs: DataFrame, path: Column, cosine: float = COSINE, file_words: int = FILE_WORDS) -> DataFrame:
    """One row per document: doc_id, path, license, similarity, found ('own', 'inherited' or null), from_dir.

    A document with a notice in any header has that licence. Others take that of the nearest directory above them (their own first)
    that holds a licence file: a text with a notice, of few words or so named; of several in a directory the one of the smallest path (then
    licence) counts. Directories are settled once each, not once per document. Null texts have no notice; a null path has no directory and
    inherits nothing. Repeated rows fare alike. No rows in, no rows out.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), path.alias("path"), text_or_empty().alias("text"))
    short = F.regexp_count("text", F.lit(WORD)) <= file_words
    keyed = keyed.withColumns({"key": F.xxhash64("doc_id", "path", "text"), "dir": _directory("path"), "is_file": short | F.regexp_extract("path", r"([^/]*)$", 1).rlike(FILE_NAMES)})
    rows, own = own_notices(keyed, cosine)
    rows = written(rows.join(small_side(own), "key", "left"), "license-rows")
    forget(own)
    holders = rows.filter("is_file and license is not null and dir is not null").groupBy("dir").agg(F.min(F.struct("path", "license")).alias("file"))
    holders = written(holders.select(F.col("dir").alias("from_dir"), F.col("file.license").alias("held")), "license-holders")
    parts = F.split("dir", "/")
    above = rows.filter("dir is not null").select("dir").distinct().withColumn("depth", F.explode(F.sequence(F.lit(1), F.size(parts))))
    above = above.withColumn("from_dir", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    nearest = above.join(small_side(holders), "from_dir").groupBy("dir").agg(F.max(F.struct("depth", "held", "from_dir")).alias("near"))
    nearest = written(nearest.select("dir", F.col("near.held").alias("held"), F.col("near.from_dir").alias("from_dir")), "license-nearest")
    forget(holders)
    out = rows.join(small_side(nearest), "dir", "left")
    mine = F.col("license").isNotNull()
    return out.select(
        "doc_id",
        "path",
        F.coalesce("license", "held").alias("license"),
        F.round("similarity", 4).alias("similarity"),
        F.when(mine, "own").when(F.col("held").isNotNull(), "inherited").alias("found"),
        F.when(~mine, F.col("from_dir")).alias("from_dir"),
    )


def document_path() -> Column:
    """A path for rows of documents, which have none: source, language, hundreds of doc_id, doc_id."""
    number = F.col("doc_id").cast("long")
    return F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.coalesce(F.floor(number / 100).cast("string"), F.lit("-")), F.concat(F.coalesce(number.cast("string"), F.lit("-")), F.lit(".txt")))


def oracle() -> str:
    notices = ", ".join(f"({i}, '{name}', '{' '.join(tokens_of(text))}')" for i, (name, text) in enumerate(NOTICES))
    shorter = ", ".join(f"({n}, {max((m for m in LINES if m < n), default=0)})" for n in LINES)
    return rf"""
    WITH notices AS (SELECT * FROM (VALUES {notices}) t(notice, license, words)),
    nw AS (SELECT notice, token, count(*) AS tf FROM (SELECT notice, unnest(string_split(words, ' ')) AS token FROM notices) GROUP BY ALL),
    vocab AS (SELECT DISTINCT token FROM nw),
    d AS (SELECT doc_id, coalesce(text, '') AS text,
                 concat(coalesce(source, '-'), '/', coalesce(lang, '-'), '/', CAST(doc_id // 100 AS VARCHAR)) AS dir, CAST(doc_id AS VARCHAR) || '.txt' AS name FROM documents),
    df AS (SELECT token, count(DISTINCT doc_id) AS n FROM (SELECT doc_id, unnest(list_distinct(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'))) AS token FROM d) WHERE token IN (SELECT token FROM vocab) GROUP BY token),
    idf AS (SELECT token, ln(((SELECT count(*) FROM d) + 1)::DOUBLE / (coalesce(n, 0) + 1)) + 1 AS idf FROM vocab LEFT JOIN df USING (token)),
    lengths AS (SELECT * FROM (VALUES {shorter}) t(n, shorter)),
    l AS (SELECT doc_id, list_filter(string_split(lower(text), chr(10)), lambda x: regexp_matches(x, '[\p{{L}}\p{{N}}]')) AS lines FROM d),
    starts AS (SELECT doc_id, lines, pos FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM l) WHERE regexp_matches(lines[pos], '(^|[^\p{{L}}\p{{N}}])({"|".join(CUES)})($|[^\p{{L}}\p{{N}}])')),
    w AS (SELECT doc_id, pos, n, list_filter(string_split_regex(array_to_string(lines[pos:pos + n - 1], ' '), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS tokens FROM starts, lengths WHERE shorter < len(lines) - pos + 1),
    near_w AS (SELECT * FROM w WHERE len(tokens) <= {MOST_WORDS} AND len(list_intersect(list_distinct(tokens), (SELECT list(token) FROM vocab))) >= {KNOWN} * len(list_distinct(tokens))),
    nv AS (SELECT notice, token, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY notice)) AS weight FROM nw JOIN idf USING (token)),
    t AS (SELECT doc_id, pos, n, token, count(*) AS tf FROM (SELECT doc_id, pos, n, unnest(tokens) AS token FROM near_w) GROUP BY ALL),
    lv AS (SELECT doc_id, pos, n, token, tf * coalesce(idf, (SELECT avg(idf) FROM idf)) AS x FROM t LEFT JOIN idf USING (token)),
    len AS (SELECT doc_id, pos, n, sqrt(sum(x * x)) AS length FROM lv GROUP BY ALL),
    sim AS (SELECT doc_id, license, round(sum(x * weight) / any_value(length), 6) AS similarity
            FROM lv JOIN nv USING (token) JOIN len USING (doc_id, pos, n) JOIN notices USING (notice) GROUP BY doc_id, pos, n, notice, license),
    own AS (SELECT doc_id, first(license ORDER BY similarity DESC, license) AS license, max(similarity) AS similarity FROM sim WHERE similarity >= {COSINE} GROUP BY doc_id),
    r AS (SELECT d.*, own.license, own.similarity, len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')) <= {FILE_WORDS} AS is_file FROM d LEFT JOIN own USING (doc_id)),
    holders AS (SELECT dir, first(license ORDER BY dir || '/' || name, license) AS held FROM r WHERE is_file AND license IS NOT NULL GROUP BY dir),
    up AS (SELECT dir, depth, array_to_string(string_split(dir, '/')[1:depth], '/') AS above FROM (SELECT DISTINCT dir FROM r), (SELECT unnest([1, 2, 3]) AS depth)),
    near AS (SELECT up.dir, max_by(held, depth) AS held, max_by(above, depth) AS from_dir FROM up JOIN holders ON up.above = holders.dir GROUP BY up.dir)
    SELECT doc_id, r.dir || '/' || name AS path, coalesce(license, held) AS license, round(similarity, 4) AS similarity,
           CASE WHEN license IS NOT NULL THEN 'own' WHEN held IS NOT NULL THEN 'inherited' END AS found, CASE WHEN license IS NULL THEN from_dir END AS from_dir
    FROM r LEFT JOIN near USING (dir)
    """
