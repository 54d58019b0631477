from comparing import connect, spark_rows, sql_rows

from monthfold.llm import licences
from monthfold.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


def found(spark, text):
    return licences.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).head().licences


def test_every_sentence_has_a_hint():
    for text in licences.SENTENCES.values():
        assert any(h in text.lower() for h in licences.HINTS), text
    assert {x for _, wanted in licences.RULES for x in wanted} <= licences.SENTENCES.keys()


def test_query_matches_sql(spark):
    got = spark_rows(QUERIES["op5_licences"](spark, SF))
    assert got == sql_rows(connect(SF), ORACLE["op5_licences"])
    assert any("MIT" in row for row in (str(r) for r in got[1]))


def test_wrapped_text_and_rule_order(spark):
    s = licences.SENTENCES
    wrapped = "Title\n\n" + s["bsd-grant"].replace("source and", "source\n   and") + "\n\n * " + s["bsd-source"] + "\n\n * " + s["bsd-binary"]
    assert found(spark, wrapped) == ["BSD-2-Clause"]
    assert found(spark, wrapped + " " + s["bsd-endorse"]) == ["BSD-3-Clause"]
    swapped = s["bsd-source"] + "\n" + s["bsd-grant"] + "\n" + s["bsd-binary"]
    assert found(spark, swapped) == []
    assert found(spark, "x\nreleased under the mit license\nAll rights reserved.") == ["MIT", "all-rights-reserved"]
    assert found(spark, "not released under the MIT License.") == []


def test_odd_rows(odd_docs):
    rows = licences.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.licences == [] and r.line_ids == [] and r.sentence_ids == [] for r in rows)
    assert licences.scan(odd_docs.limit(0)).collect() == []


def test_sentences_are_found_whatever_separates_words(spark):
    texts = [(name, text.replace(" ", gap)) for name, text in licences.SENTENCES.items() for gap in ("\n", "\t", "  ", "\n  ")]
    rows = licences.scan(spark.createDataFrame(texts, "doc_id string, text string")).collect()
    assert [r.doc_id for r in rows if r.doc_id not in r.sentence_ids] == []
    assert found(spark, "All rights\nreserved.") == ["all-rights-reserved"]


def test_hints_are_within_words():
    for text in licences.SENTENCES.values():
        assert any(h in word for h in licences.HINTS for word in licences.normal_form(text).split()), text


def test_every_rule_is_met_by_its_own_sentences(spark):
    docs = [(i, " ".join(licences.SENTENCES[x] for x in wanted)) for i, (_, wanted) in enumerate(licences.RULES)]
    rows = licences.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.licences for r in rows} == {i: [name] for i, (name, _) in enumerate(licences.RULES)}
    header = "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this"
    assert found(spark, header) == ["MPL-2.0"]
    assert found(spark, header.replace("2.0", "9.9")) == []


def test_headers_titles_and_spdx_lines(spark):
    gpl = "This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation; either version 2 of the License, or\n# (at your option) any later version.\n"
    texts = {
        "// SPDX-License-Identifier: MIT\nint main;": ["MIT"],
        "# SPDX-License-Identifier:  GPL-3.0-or-later": ["GPL-3.0-or-later"],
        "SPDX-License-Identifier: Unknown-1.0": [],
        gpl: ["GPL-2.0-or-later"],
        gpl.replace("program", "library").replace("General", "Lesser General").replace("version 2", "version 2.1"): ["LGPL-2.1-or-later"],
        "  GNU AFFERO GENERAL PUBLIC LICENSE\n   Version 3, 19 November 2007\n": ["AGPL-3.0"],
        "Licensed under the ISC License.": ["ISC"],
        "Mozilla Public License Version 2.0\n====": ["MPL-2.0"],
        "Boost Software License - Version 1.0 - August 17th, 2003\n\nx": ["BSL-1.0"],
        "Eclipse Public License - v 2.0\n": ["EPL-2.0"],
        "Licensed under MIT.": ["MIT"],
        "Licensed under the Apache License 2.0.": ["Apache-2.0"],
        "mit\nisc": [],
    }
    rows = licences.scan(spark.createDataFrame([(t, t) for t in texts], "doc_id string, text string")).collect()
    assert {r.doc_id: r.licences for r in rows} == texts
