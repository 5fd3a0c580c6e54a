"""Operator 7 (native): licence scan by sentence-rule recognition.

A text is brought to one form: lower case, words with single spaces, sentence ends and blank lines as hard
boundaries, line breaks as soft ones that a wrapped sentence may run across. Comment leaders at line starts go, and
abbreviations such as `v. 2.0` end no sentence. Where a known licence sentence stands whole between two
boundaries, it becomes its identifier; the sequence of identifiers that a document shows is matched against
ordered rules. A rule holds where its identifiers occur in its order with no stretch of more than GAP
characters of other text between two neighbours. Of the rules of one licence the one that ranks first is reported.

DataFrame functions only, one pass, no shuffle: the known sentences (fixed here, or at most MOST given) are one
pattern inside the expression, and each row is judged whole within its task, so hot sources, copies and
frequent lines cannot skew anything. Texts with none of the words that every sentence has are not brought to form.

Nulls: a null or empty text has no sentence and an empty result; a null doc_id, repeated rows and ties
are rows like any other; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ensure

# Sentences of public licence texts and notices, and the rules over them.
SENTENCES = {
    "apache2-licensed": "Licensed under the Apache License, Version 2.0",
    "apache2-licensed-the": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache2-not-use": "you may not use this file except in compliance with the License",
    "apache2-obtain": "You may obtain a copy of the License at",
    "apache2-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache2-see": "See the License for the specific language governing permissions and limitations under the License",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED',
    "cc-by-4": "Licensed under CC BY 4.0",
    "cc-by-4-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0",
    "cc-by-sa-4-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "gpl-free": "This program is free software",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "gpl2-later": "either version 2 of the License, or (at your option) any later version",
    "gpl2-licensed": "This work is licensed under the GNU General Public License, version 2",
    "gpl3-licensed": "This work is licensed under the GNU General Public License, version 3",
    "gpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "isc-as-is": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS',
    "isc-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "lgpl-free": "This library is free software",
    "lgpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "lgpl21-later": "either version 2.1 of the License, or (at your option) any later version",
    "lgpl3-later": "either version 3 of the License, or (at your option) any later version",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "mit-licensed": "Licensed under the MIT License",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-permission": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',
    "mit-released": "Released under the MIT License",
    "mpl2-obtain": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "mpl2-obtain-http": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "spdx-apache2": "SPDX-License-Identifier: Apache-2.0",
    "spdx-bsd2": "SPDX-License-Identifier: BSD-2-Clause",
    "spdx-bsd3": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-gpl2": "SPDX-License-Identifier: GPL-2.0-only",
    "spdx-gpl2-later": "SPDX-License-Identifier: GPL-2.0-or-later",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-only",
    "spdx-gpl3-later": "SPDX-License-Identifier: GPL-3.0-or-later",
    "spdx-isc": "SPDX-License-Identifier: ISC",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-mpl2": "SPDX-License-Identifier: MPL-2.0",
}
#: (licence, rule, identifiers in order); a licence's first rule that holds is its evidence.
RULES = (
    ("Apache-2.0", "header", ("apache2-licensed-the", "apache2-not-use", "apache2-as-is")),
    ("Apache-2.0", "notice", ("apache2-licensed",)),
    ("Apache-2.0", "notice-the", ("apache2-licensed-the",)),
    ("Apache-2.0", "spdx", ("spdx-apache2",)),
    ("BSD-3-Clause", "text", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is")),
    ("BSD-3-Clause", "spdx", ("spdx-bsd3",)),
    ("BSD-2-Clause", "text", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("BSD-2-Clause", "spdx", ("spdx-bsd2",)),
    ("CC-BY-4.0", "notice", ("cc-by-4",)),
    ("CC-BY-4.0", "notice-long", ("cc-by-4-long",)),
    ("CC-BY-NC-4.0", "notice", ("cc-by-nc-4",)),
    ("CC-BY-SA-4.0", "notice", ("cc-by-sa-4",)),
    ("CC-BY-SA-4.0", "notice-long", ("cc-by-sa-4-long",)),
    ("GPL-2.0-or-later", "header", ("gpl-free", "gpl-terms", "gpl2-later", "gpl-hope")),
    ("GPL-2.0-or-later", "spdx", ("spdx-gpl2-later",)),
    ("GPL-2.0", "notice", ("gpl2-licensed",)),
    ("GPL-2.0", "spdx", ("spdx-gpl2",)),
    ("GPL-3.0-or-later", "header", ("gpl-free", "gpl3-terms", "gpl-hope")),
    ("GPL-3.0-or-later", "spdx", ("spdx-gpl3-later",)),
    ("GPL-3.0", "notice", ("gpl3-licensed",)),
    ("GPL-3.0", "spdx", ("spdx-gpl3",)),
    ("ISC", "text", ("isc-permission", "isc-as-is")),
    ("ISC", "spdx", ("spdx-isc",)),
    ("LGPL-2.1-or-later", "header", ("lgpl-free", "lgpl-terms", "lgpl21-later")),
    ("LGPL-3.0-or-later", "header", ("lgpl-free", "lgpl-terms", "lgpl3-later")),
    ("MIT", "text", ("mit-permission", "mit-notice", "mit-as-is")),
    ("MIT", "notice", ("mit-released",)),
    ("MIT", "notice-licensed", ("mit-licensed",)),
    ("MIT", "spdx", ("spdx-mit",)),
    ("MPL-2.0", "header", ("mpl2-subject", "mpl2-obtain")),
    ("MPL-2.0", "header-http", ("mpl2-subject", "mpl2-obtain-http")),
    ("MPL-2.0", "notice", ("mpl2-subject",)),
    ("MPL-2.0", "spdx", ("spdx-mpl2",)),
)
MOST = 2000
#: Characters of other text (in one form) that two neighbours of a rule may have between them.
GAP = 600
#: Every known sentence has one of these, so a text without them needs no look.
TELLING = ("licen", "software", "redistribut", "warrant", "copyright", "mpl")
#: To one form, step by step; the same in Java, RE2 and Python. Hard boundaries are ||, soft ones ~~.
FORM = (
    (r"[|~#]", " "),
    (r"\r\n?", "\n"),
    (r"\n[ \t]*(?:\*+|#+|//+|;+|--+|dnl\b|rem\b)", "\n"),
    (r"^[ \t]*(?:/\*+|\*+|//+|;+|--+|<!--)", " "),
    (r"spdx-license-identifier:", "spdx-license-identifier "),
    (r"([ \t\n(])(v|ver|vers|no|inc|ltd|e\.g|i\.e)\.([ \t\n])", "${1}${2} ${3}"),
    (r"\n[ \t]*\n", "|"),
    (r"[.!?;:]+[\"')\]]*([ \t\n]|$)", "|${1}"),
    (r"\n", "~"),
    (r"[^\p{L}\p{N}|~]+", " "),
    (r"[ ~]*[|][ |~]*", "|"),
    (r"[ ]*~[ ~]*", "~~"),
    (r"[|]", "||"),
    (r"^ +| +$", ""),
)


def formed(text: str) -> str:
    """A text in one form, in plain Python."""
    import regex

    out = " " + text.lower()
    for pattern, new in FORM:
        out = regex.sub(pattern, new.replace("${", r"\g<").replace("}", ">"), out)
    return f"||{out}||"


def normal(sentence: str) -> str:
    return formed(sentence).replace("~~", " ").strip("| ")


def pattern_of(sentences: dict[str, str]) -> str:
    """One pattern for all known sentences, long ones first, each across soft boundaries."""
    if len(sentences) > MOST:
        raise ValueError("too many sentences for one pattern")
    forms = sorted({normal(s) for s in sentences.values()}, key=lambda s: (-len(s), s))
    if bad := [s for s in forms if "|" in s or not any(x in s for x in TELLING)]:
        raise ValueError(f"no single sentence, or without a telling word: {bad[:3]}")
    return "[|~](" + "|".join("(?: |~~)".join(map(re.escape, s.split(" "))) for s in forms) + ")[|~]"


def rule_pattern(rule: tuple[str, ...]) -> str:
    return "(?:[^,!]+,)*".join(f"{x}," for x in rule)


def sequence(text: Column, sentences: dict[str, str]) -> Column:
    """Identifiers of the known sentences in order, each with a comma; `!,` where more than GAP of other text comes between."""
    known = F.create_map(*[F.lit(x) for name, s in sorted(sentences.items(), reverse=True) for x in (normal(s), name)])
    out = F.concat(F.lit(" "), F.lower(text))
    for pattern, new in FORM:
        out = F.regexp_replace(out, pattern, new.replace("${", "$").replace("}", ""))
    marked = F.regexp_replace(F.concat(F.lit("||"), out, F.lit("||")), pattern_of(sentences), "#$1#")
    ids = F.transform(F.regexp_extract_all(marked, F.lit("#([^#]+)#([^#]*)"), F.lit(1)), lambda x: F.element_at(known, F.replace(x, F.lit("~~"), F.lit(" "))))
    gaps = F.transform(F.regexp_extract_all(marked, F.lit("#([^#]+)#([^#]*)"), F.lit(2)), lambda x: F.length(x) > GAP)
    told = F.zip_with(ids, gaps, lambda x, far: F.concat(x, F.when(far, ",!,").otherwise(",")))
    return F.when(text.rlike("(?i)" + "|".join(TELLING)), F.concat(F.lit(","), F.array_join(told, ""))).otherwise(F.lit(","))


def scan(docs: DataFrame, sentences: dict[str, str] | None = None, rules=RULES) -> DataFrame:
    """doc_id, licenses, evidence, sentence_ids, n_sentences of every row of docs."""
    sentences = sentences or SENTENCES
    rows = ensure(docs, doc_id="long", text="string")
    rows = rows.select("doc_id", F.coalesce(sequence(F.col("text"), sentences), F.lit(",")).alias("seq"))
    evidence = []
    for name in dict.fromkeys(name for name, _, _ in rules):
        case = F
        for _, kind, rule in [r for r in rules if r[0] == name]:
            case = case.when(F.col("seq").rlike("," + rule_pattern(rule)), f"{name}/{kind}")
        evidence.append(case)
    # Documents without any known sentence skip all rules.
    proof = F.when(F.length("seq") > 1, F.filter(F.array(*evidence), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))
    ids = F.filter(F.split("seq", ","), lambda x: (x != "") & (x != "!"))
    rows = rows.withColumn("proof", proof).withColumn("ids", ids)
    return rows.select(
        "doc_id",
        F.array_join(F.transform("proof", lambda x: F.substring_index(x, "/", 1)), ",").alias("licenses"),
        F.array_join("proof", ",").alias("evidence"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.size("ids").cast("long").alias("n_sentences"),
    )


def sql(sentences: dict[str, str] | None = None, rules=RULES) -> str:
    """The scan in DuckDB SQL."""
    sentences = sentences or SENTENCES
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(normal(s))}, '{name}')" for name, s in sorted(sentences.items()))
    form = "' ' || lower(text)"
    for pattern, new in FORM:
        form = f"regexp_replace({form}, {quoted(pattern)}, {quoted(new.replace('${', chr(92)).replace('}', ''))}, 'g')"
    marked = f"regexp_replace('||' || {form} || '||', {quoted(pattern_of(sentences))}, '#\\1#', 'g')"
    cases = []
    for name in dict.fromkeys(name for name, _, _ in rules):
        whens = " ".join(f"WHEN regexp_matches(seq, ',{rule_pattern(rule)}') THEN '{name}/{kind}'" for _, kind, rule in [r for r in rules if r[0] == name])
        cases.append(f"CASE {whens} END")
    return f"""
WITH known(norm, id) AS (VALUES {known}),
docs AS (SELECT doc_id, row_number() OVER () AS r, {marked} AS marked FROM documents),
hits AS (
  SELECT r, unnest(regexp_extract_all(marked, '#([^#]+)#([^#]*)', 1)) AS s, unnest(regexp_extract_all(marked, '#([^#]+)#([^#]*)', 2)) AS rest,
         generate_subscripts(regexp_extract_all(marked, '#([^#]+)#([^#]*)', 1), 1) AS pos FROM docs),
told AS (SELECT r, pos, k.id, length(rest) > {GAP} AS far FROM hits JOIN (SELECT norm, min(id) AS id FROM known GROUP BY norm) k ON k.norm = replace(s, '~~', ' ')),
seqs AS (SELECT r, ',' || string_agg(id || CASE WHEN far THEN ',!,' ELSE ',' END, '' ORDER BY pos) AS seq, string_agg(id, ',' ORDER BY pos) AS ids, count(*) AS n FROM told GROUP BY r),
every AS (SELECT d.doc_id, coalesce(s.seq, ',') AS seq, coalesce(s.ids, '') AS ids, coalesce(s.n, 0) AS n FROM docs d LEFT JOIN seqs s USING (r)),
proofs AS (SELECT *, list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL) AS proof FROM every)
SELECT doc_id, array_to_string(list_transform(proof, lambda x: split_part(x, '/', 1)), ',') AS licenses,
       array_to_string(proof, ',') AS evidence, ids AS sentence_ids, CAST(n AS BIGINT) AS n_sentences
FROM proofs
"""
