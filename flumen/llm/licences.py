"""License scans by sentence-rule recognition (operator 7). DataFrame operations only.

A text is cut into sentences at line ends, and at white space after ``. ! ? ; :``; each
is normalised to lower-case words and looked up in a table of known licence sentences. A
known sentence may also be wrapped over several lines, as published texts and comment
blocks have it: lines that stand next to each other are tried joined, unless one ends
in ``. ! ? ; :`` or a blank line (or one without a letter or digit) parts them; of known
sentences that begin at the same place the longest counts. The
identifiers of the known ones, in text order, form the text's sequence.
Rules are tried in their order: a rule is a run of identifiers that stand next to each
other in the sequence (unknown sentences between them do not matter); where it matches
it reports its licence and uses these sentences up, so a more specific rule that stands
first leaves nothing for a general one. The sentences that no rule uses are counted.

Everything is an expression over one row: nothing is shuffled, and the tables are part
of the plan (a few dozen sentences). Nulls: a null or empty text has no sentences. Texts
of any length are scanned whole. Repeated rows are scanned alike. An empty table gives an
empty result; columns of the input that clash with the result's give way.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flumen.llm.common import replaced, unused
from flumen.sources.tables import load

# Sentences of well-known licence texts and notices, by identifier.
SENTENCES = {
    1: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    2: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    3: "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    4: "Released under the MIT License.",
    5: "Licensed under the MIT License.",
    6: "Licensed under the Apache License, Version 2.0.",
    7: "Licensed under the Apache License, Version 2.0 (the \"License\");",
    8: "you may not use this file except in compliance with the License.",
    9: "You may obtain a copy of the License at",
    10: "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    11: "This work is licensed under the GNU General Public License, version 3.",
    12: "This program is free software:",
    13: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    14: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    15: "either version 2 of the License, or (at your option) any later version.",
    17: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    18: "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    19: "Licensed under CC BY-NC 4.0.",
    20: "Licensed under CC BY 4.0.",
    21: "Licensed under CC BY-SA 4.0.",
    22: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    23: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    24: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    25: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    26: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    27: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    28: "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    29: "This is free and unencumbered software released into the public domain.",
    30: "All rights reserved.",
    31: "This library is free software;",
    32: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    33: "either version 2.1 of the License, or (at your option) any later version.",
    34: "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    35: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    36: "This software is provided 'as-is', without any express or implied warranty.",
    37: "In no event will the authors be held liable for any damages arising from the use of this software.",
    38: "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    39: "Distributed under the Boost Software License, Version 1.0.",
    40: "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    41: "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    42: "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    43: "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.",
    44: "The ASF licenses this file to You under the Apache License, Version 2.0 (the \"License\");",
    45: "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work.",
    46: "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    47: "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    48: "The licenses for most software are designed to take away your freedom to share and change it.",
    49: "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software.",
    50: "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below.",
    51: "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    52: "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    53: "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    54: "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    55: "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    56: "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    57: "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    58: "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    59: "Licensed under the BSD 3-Clause License.",
    60: "Licensed under the BSD 2-Clause License.",
    61: "Licensed under the GNU Affero General Public License v3.0.",
    62: "Licensed under the GNU Lesser General Public License v3.0.",
    63: "Licensed under the Mozilla Public License 2.0.",
    64: "Licensed under the ISC License.",
}
# Ordered rules, the more specific ones first.
RULES = [
    ("MIT", (1, 2, 3)), ("MIT", (1, 2)), ("MIT", (4,)), ("MIT", (5,)),
    ("Apache-2.0", (43, 44, 8, 9, 10)), ("Apache-2.0", (7, 8, 9, 10)), ("Apache-2.0", (7, 8)), ("Apache-2.0", (6,)),
    ("Apache-2.0", (43, 44)), ("Apache-2.0", (51,)),
    ("GPL-3.0-or-later", (12, 13, 17, 18)), ("GPL-3.0-or-later", (12, 13)), ("GPL-3.0-only", (11,)),
    ("GPL-2.0-or-later", (12, 14, 15, 17, 18)), ("GPL-2.0-or-later", (12, 14, 15)),
    ("LGPL-2.1-or-later", (31, 32, 33, 17, 18)), ("LGPL-2.1-or-later", (31, 32, 33)),
    ("LGPL-3.0-or-later", (12, 35, 17, 18)), ("LGPL-3.0-or-later", (12, 35)),
    ("AGPL-3.0-or-later", (12, 34, 17, 18)), ("AGPL-3.0-or-later", (12, 34)),
    ("GPL-3.0-only", (46, 47)), ("GPL-2.0-only", (46, 48)), ("AGPL-3.0-only", (46, 49)), ("LGPL-3.0-only", (46, 50)),
    ("AGPL-3.0-only", (61,)), ("LGPL-3.0-only", (62,)),
    ("CC-BY-NC-4.0", (19,)), ("CC-BY-4.0", (20,)), ("CC-BY-4.0", (22,)), ("CC-BY-SA-4.0", (21,)),
    ("CC-BY-SA-4.0", (54,)), ("CC-BY-NC-4.0", (55,)), ("CC-BY-ND-4.0", (56,)), ("CC0-1.0", (45,)),
    ("BSD-4-Clause", (23, 24, 25, 53)), ("BSD-3-Clause", (23, 24, 25, 26, 52)), ("BSD-3-Clause", (23, 24, 25, 26)),
    ("BSD-2-Clause", (23, 24, 25, 52)), ("BSD-2-Clause", (23, 24, 25)), ("BSD-3-Clause", (59,)), ("BSD-2-Clause", (60,)),
    ("Zlib", (36, 37, 38)), ("BSL-1.0", (39,)), ("BSL-1.0", (40,)), ("EPL-2.0", (41,)), ("EPL-1.0", (42,)),
    ("ISC", (27,)), ("ISC", (64,)), ("MPL-2.0", (28, 58)), ("MPL-2.0", (28,)), ("MPL-2.0", (63,)),
    ("Unlicense", (29, 57)), ("Unlicense", (29,)), ("Proprietary", (30,)),
]

_ENDS, _OTHER = r"([.!?;:])[ \t\r\f\x0B]+", r"[^\p{L}\p{N}\n]+"


_BREAKS = r"([.!?;:])(?:[ \t\r\f\x0B]+|(?=\n))"


def normal_text(text: Column) -> Column:
    """Lower-case words; a line end is one newline, the end of a sentence two or more."""
    lines = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _BREAKS, "$1\n\n")
    words = F.regexp_replace(lines, _OTHER, " ")
    return F.trim(F.replace(F.replace(words, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n")))


def normalised(sentence: str) -> list[str]:
    """The same for one known sentence, which may hold several ends."""
    lines = re.sub(_ENDS, r"\1\n", sentence.lower())
    return [" ".join(re.findall(r"[^\W_]+", x)) for x in lines.split("\n")]


def sentence_ids(text: Column, sentences: dict[int, str] = SENTENCES) -> Column:
    """array<int> of the known sentences of a text, in its order. A sentence of the
    table that is cut in several is known by its longest part."""
    known = {max(normalised(s), key=len): i for i, s in sentences.items()}
    pairs = [x for k, i in known.items() for x in (F.lit(k), F.lit(i))]
    either = "|".join(k.replace(" ", "[ \\n]") for k in sorted(known, key=len, reverse=True))
    hits = F.regexp_extract_all(normal_text(text), F.lit(f"(?<![^\\n])(?:{either})(?![^\\n])"), F.lit(0))
    return F.transform(hits, lambda s: F.element_at(F.create_map(*pairs), F.replace(s, F.lit("\n"), F.lit(" "))))


def scan(docs: DataFrame, text_col: str = "text", sentences: dict[int, str] = SENTENCES, rules=RULES) -> DataFrame:
    """``docs`` with sentence_ids, licences (sorted array of names) and n_unused (known
    sentences that no rule used); columns of these names give way."""
    own, known = unused(docs, 2)
    ids = docs.withColumn(own, sentence_ids(F.col(text_col), sentences))
    left = ids.withColumn(known, F.array_join(F.transform(own, lambda i: F.concat(F.lit("<"), i.cast("string"), F.lit(">"))), ""))
    marks = []
    rest = F.col(known)
    for name, run in rules:
        pattern = "".join(f"<{i}>" for i in run)
        marks.append(F.when(F.contains(rest, F.lit(pattern)), F.lit(name)))
        rest = F.replace(rest, F.lit(pattern), F.lit("#"))
    found = F.when(F.col(known) != "", F.array_sort(F.array_distinct(F.array_compact(F.array(*marks))))).otherwise(F.array().cast("array<string>"))
    spare = F.when(F.col(known) != "", F.length(rest) - F.length(F.replace(rest, F.lit("<"), F.lit("")))).otherwise(F.lit(0))
    return replaced(left, sentence_ids=F.col(own), licences=found, n_unused=spare.cast("long")).drop(own, known)


def query(spark, sf_dir: str) -> DataFrame:
    """op7: every document's known sentences and licences."""
    found = scan(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
                        F.array_join(F.transform("sentence_ids", lambda i: i.cast("string")), ",").alias("sentence_ids"),
                        F.array_join("licences", ",").alias("licences"), "n_unused")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _oracle() -> str:
    known = ", ".join(f"({_quoted(max(normalised(s), key=len))}, {i})" for i, s in SENTENCES.items())
    steps, left = [], "s"
    for n, (name, run) in enumerate(RULES):
        pattern = "".join(f"<{i}>" for i in run)
        steps.append(f"r{n} AS (SELECT n, replace(s, '{pattern}', '#') AS s, CASE WHEN contains(s, '{pattern}') THEN list_append(l, '{name}') ELSE l END AS l FROM {f'r{n - 1}' if n else 'seq'})")
    return f"""
WITH RECURSIVE known(sentence, id) AS (VALUES {known}),
d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
-- a sentence's end gives blank lines: lines are joined only where none stands between
ended AS (SELECT n, regexp_replace(regexp_replace(lower(text), '{_ENDS}', '\\1' || chr(10) || chr(10), 'g'),
                                   '([.!?;:])\\n', '\\1' || chr(10) || chr(10), 'g') AS t FROM d),
parts AS (SELECT n, list_transform(string_split(regexp_replace(t, '{_OTHER}', ' ', 'g'), chr(10)), lambda x: trim(x)) AS p FROM ended),
one AS (SELECT n, unnest(p) AS line, generate_subscripts(p, 1) AS place FROM parts),
maybe AS (SELECT n, place, sentence, id, unnest(range(1, len(string_split(sentence, ' ')) + 1)) AS m
          FROM one JOIN known ON line <> '' AND starts_with(known.sentence, line)),
fits AS (SELECT n, place, place + m AS behind, sentence, id FROM maybe JOIN parts USING (n)
         WHERE place + m - 1 <= len(p) AND array_to_string(p[place:place + m - 1], ' ') = sentence),
longest AS (SELECT n, place, max_by(behind, length(sentence)) AS behind, max_by(id, length(sentence)) AS id FROM fits GROUP BY n, place),
-- from the left, a sentence begins behind the one before it
ranked AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY place) AS i FROM longest),
walk AS (SELECT n, i, place, id, behind, TRUE AS taken FROM ranked WHERE i = 1
         UNION ALL
         SELECT r.n, r.i, r.place, r.id, CASE WHEN r.place >= w.behind THEN r.behind ELSE w.behind END, r.place >= w.behind
         FROM walk w JOIN ranked r ON r.n = w.n AND r.i = w.i + 1),
hit AS (SELECT n, place, id FROM walk WHERE taken),
seq AS (SELECT n, string_agg('<' || id || '>', '' ORDER BY place) AS s, CAST([] AS VARCHAR[]) AS l FROM hit GROUP BY n),
ids AS (SELECT n, count(*) AS c, string_agg(CAST(id AS VARCHAR), ',' ORDER BY place) AS ids FROM hit GROUP BY n),
{", ".join(steps)}
SELECT doc_id, coalesce(c, 0) AS n_sentences, coalesce(ids, '') AS sentence_ids,
       coalesce(array_to_string(list_sort(list_distinct(l)), ','), '') AS licences,
       CAST(coalesce(length(s) - length(replace(s, '<', '')), 0) AS BIGINT) AS n_unused
FROM d LEFT JOIN ids USING (n) LEFT JOIN r{len(RULES) - 1} USING (n)
"""


ORACLE = _oracle()
