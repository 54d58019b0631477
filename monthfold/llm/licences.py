"""Licence recognition: known sentences, then ordered rules over their identifiers.

A text is read twice: line by line, and by sentences that run over line ends. Its
sentences are normalised and looked up in a fixed table; what is found, in the
order of the text, is a sequence of identifiers. A rule names identifiers that
must follow one another (others may stand between). Rules are ordered: one that
an earlier matching rule contains is not reported.

Only column expressions: one scan, no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthfold.llm.common import own, whole_text

# Identifiers that may follow "SPDX-License-Identifier:".
SPDX = (
    "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0",
    "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense",
)

# Sentences of public licences and of notices that name them.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-notice": "Licensed under the BSD License.",
    "bsd-2-notice": "Licensed under the BSD 2-Clause License.",
    "bsd-3-notice": "Licensed under the BSD 3-Clause License.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-basis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-grant": "This program is free software:",
    "gpl-3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    # As the splitter cuts it, after "v."
    "mpl-1": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl-2": "2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc0-notice": "Licensed under CC0 1.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd-notice": "Licensed under CC BY-ND 4.0.",
    "reserved": "All rights reserved.",
    "mit-notice-3": "Licensed under MIT.",
    "isc-notice": "Licensed under the ISC License.",
    "apache-notice-2": "Licensed under the Apache License 2.0.",
    "gpl-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl-2-later": "either version 2 of the License, or (at your option) any later version.",
    "gpl-3-later": "either version 3 of the License, or (at your option) any later version.",
    "lgpl-grant": "This library is free software;",
    "lgpl-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    "lgpl-2-1-later": "either version 2.1 of the License, or (at your option) any later version.",
    "gpl-title": "GNU GENERAL PUBLIC LICENSE.",
    "lgpl-title": "GNU LESSER GENERAL PUBLIC LICENSE.",
    "agpl-title": "GNU AFFERO GENERAL PUBLIC LICENSE.",
    "gpl-2-date": "Version 2, June 1991.",
    "lgpl-2-1-date": "Version 2.1, February 1999.",
    "gpl-3-date": "Version 3, 29 June 2007.",
    "agpl-3-date": "Version 3, 19 November 2007.",
    "mpl-title": "Mozilla Public License Version 2.0.",
    "boost-title": "Boost Software License - Version 1.0 - August 17th, 2003.",
    "eclipse-title": "Eclipse Public License - v 2.0.",
    "spdx": "SPDX-License-Identifier:",
    **{f"spdx-{name}": name for name in SPDX},
}

# Rules in order, the more specific first.
RULES = (
    ("MIT", ("mit-grant", "mit-condition", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-title-2",)),
    ("ISC", ("isc-grant",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-3-notice",)),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-2-Clause", ("bsd-2-notice",)),
    ("BSD", ("bsd-notice",)),
    ("Apache-2.0", ("apache-grant", "apache-use", "apache-copy", "apache-basis")),
    ("Apache-2.0", ("apache-grant",)),
    ("Apache-2.0", ("apache-notice",)),
    ("GPL-3.0-or-later", ("gpl-grant", "gpl-3-redistribute", "gpl-warranty")),
    ("GPL-3.0-or-later", ("gpl-grant", "gpl-3-redistribute")),
    ("GPL-3.0", ("gpl-3-notice",)),
    ("GPL-2.0", ("gpl-2-notice",)),
    ("MPL-2.0", ("mpl-1", "mpl-2")),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-notice",)),
    ("all-rights-reserved", ("reserved",)),
    ("MIT", ("mit-notice-3",)),
    ("ISC", ("isc-notice",)),
    ("Apache-2.0", ("apache-notice-2",)),
    ("GPL-2.0-or-later", ("gpl-grant", "gpl-redistribute", "gpl-2-later")),
    ("GPL-3.0-or-later", ("gpl-grant", "gpl-redistribute", "gpl-3-later")),
    ("LGPL-2.1-or-later", ("lgpl-grant", "lgpl-redistribute", "lgpl-2-1-later")),
    ("GPL-2.0", ("gpl-title", "gpl-2-date")),
    ("GPL-3.0", ("gpl-title", "gpl-3-date")),
    ("LGPL-2.1", ("lgpl-title", "lgpl-2-1-date")),
    ("LGPL-3.0", ("lgpl-title", "gpl-3-date")),
    ("AGPL-3.0", ("agpl-title", "agpl-3-date")),
    ("MPL-2.0", ("mpl-title",)),
    ("BSL-1.0", ("boost-title",)),
    ("EPL-2.0", ("eclipse-title",)),
    *[(name, ("spdx", f"spdx-{name}")) for name in SPDX],
)

#: A text with none of these parts has no known sentence; every sentence has one. Each
#: is within a word, so that it stands in the text whatever separates the words.
HINTS = ("licens", "permission", "redistribut", "copyright", "warranty", "reserved", "software", "domain", "2", "mit", "gpl", "isc", "bsd", "bsl", "cc0", "cc", "mpl", "epl")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK = "\x01"
SENTENCE_END = r"([.;:!?])[\x20\x09-\x0D]+"
BLANK_LINE = r"\n[\x20\x09\x0B-\x0D]*\n"


def normal_form(sentence: str) -> str:
    """Letters A-Z lowered, all but a-z and 0-9 turned into single spaces."""
    lowered = "".join(LOWER[UPPER.index(c)] if c in UPPER else c for c in sentence)
    return " ".join("".join(c if c in LOWER or c in "0123456789" else " " for c in lowered).split())


def sentences(lowered: Column, by_line: bool) -> Column:
    """The text's sentences in order, in normal form."""
    if by_line:
        joined = F.replace(lowered, F.lit("\n"), F.lit(MARK))
    else:
        joined = F.replace(F.regexp_replace(lowered, BLANK_LINE, MARK), F.lit("\n"), F.lit(" "))
    parts = F.split(F.regexp_replace(joined, SENTENCE_END, f"$1{MARK}"), MARK)
    return F.transform(parts, lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))


def identifiers(parts: Column) -> Column:
    """What the sentence table knows of a list of sentences, in order."""
    pairs = [x for name, text in SENTENCES.items() for x in (F.lit(normal_form(text)), F.lit(name))]
    found = F.transform(parts, lambda s: F.try_element_at(F.create_map(*pairs), s))
    return F.filter(found, lambda x: x.isNotNull())


def follows(inner: tuple, outer: tuple) -> bool:
    """Whether the identifiers of ``inner`` stand in ``outer`` in this order."""
    rest = iter(outer)
    return all(x in rest for x in inner)


def rule_names(sequences: list[Column]) -> Column:
    """Names of the rules that match any of the identifier sequences, in rule order, each once."""
    flat = [F.concat(F.lit("|"), F.array_join(ids, "||"), F.lit("|")) for ids in sequences]
    hits = []
    for _, wanted in RULES:
        pattern = "%" + "%".join(f"|{x}|" for x in wanted) + "%"
        hit = flat[0].like(pattern)
        for other in flat[1:]:
            hit = hit | other.like(pattern)
        hits.append(hit)
    named = []
    for i, (name, wanted) in enumerate(RULES):
        shown = hits[i]
        for k in range(i):
            if follows(wanted, RULES[k][1]):
                shown = shown & ~hits[k]
        named.append(F.when(shown, F.lit(name)))
    return F.array_distinct(F.array_compact(F.array(*named)))


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, licences, line_ids, sentence_ids (arrays, empty where none).

    Null and empty texts have none; rows that repeat are scanned each; other
    columns are not looked at; no rows: no rows.
    """
    lowered = F.translate(whole_text(), UPPER, LOWER)
    rows = own(docs, "doc_id", "text").select("doc_id", lowered.alias("lowered"))
    hinted = F.lit(False)
    for hint in HINTS:
        hinted = hinted | F.contains("lowered", F.lit(hint))
    none = F.array().cast("array<string>")
    # A text without a hint is empty from here on, so it is not cut into sentences.
    kept = rows.select("doc_id", F.when(hinted, F.col("lowered")).otherwise("").alias("lowered"))
    found = kept.select(
        "doc_id",
        F.coalesce(identifiers(sentences(F.col("lowered"), True)), none).alias("line_ids"),
        F.coalesce(identifiers(sentences(F.col("lowered"), False)), none).alias("sentence_ids"),
    )
    return found.select("doc_id", rule_names([F.col("line_ids"), F.col("sentence_ids")]).alias("licences"), "line_ids", "sentence_ids")


def scan_sql() -> str:
    """The same scan in DuckDB's SQL, with joins in place of list functions."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(normal_form(text))}, {quote(name)})" for name, text in SENTENCES.items())
    rules = ", ".join(
        f"({i}, {quote(name)}, {quote('%' + '%'.join(f'|{x}|' for x in wanted) + '%')})" for i, (name, wanted) in enumerate(RULES)
    )
    hidden = ", ".join(f"({i}, {k})" for i, (_, a) in enumerate(RULES) for k in range(i) if follows(a, RULES[k][1]))
    cut = r"string_split(regexp_replace({}, '([.;:!?])[\x20\x09-\x0D]+', '\1' || chr(1), 'g'), chr(1))"
    lines = cut.format("replace(t, chr(10), chr(1))")
    runs = cut.format(r"replace(regexp_replace(t, '\n[\x20\x09\x0B-\x0D]*\n', chr(1), 'g'), chr(10), ' ')")
    return f"""
WITH known(sentence, name) AS (VALUES {known}), rules(turn, licence, pattern) AS (VALUES {rules}),
hidden(turn, above) AS (VALUES {hidden}),
d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
parts AS (
  SELECT doc_id, 0 AS way, unnest({lines}) AS s, generate_subscripts({lines}, 1) AS pos FROM d
  UNION ALL
  SELECT doc_id, 1, unnest({runs}), generate_subscripts({runs}, 1) FROM d),
ids AS (
  SELECT doc_id, way, string_agg(name, ',' ORDER BY pos) AS names, '|' || string_agg(name, '||' ORDER BY pos) || '|' AS flat
  FROM parts JOIN known ON trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) = sentence GROUP BY 1, 2),
hits AS (SELECT DISTINCT doc_id, turn, licence FROM ids JOIN rules ON flat LIKE pattern),
shown AS (
  SELECT doc_id, licence, min(turn) AS turn FROM hits h
  WHERE NOT EXISTS (SELECT 1 FROM hidden JOIN hits o ON o.turn = hidden.above WHERE hidden.turn = h.turn AND o.doc_id = h.doc_id)
  GROUP BY 1, 2),
named AS (SELECT doc_id, string_agg(licence, ',' ORDER BY turn) AS licences FROM shown GROUP BY 1)
SELECT d.doc_id, coalesce(licences, '') AS licences, coalesce(a.names, '') AS line_ids, coalesce(b.names, '') AS sentence_ids
FROM d LEFT JOIN named USING (doc_id)
LEFT JOIN ids a ON a.doc_id = d.doc_id AND a.way = 0 LEFT JOIN ids b ON b.doc_id = d.doc_id AND b.way = 1
"""
