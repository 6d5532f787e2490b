"""Base phrases by a plain search, the template automaton, and odd rows."""

import re

import pytest

from postlytics.llm import licenses
from postlytics.llm.queries import QUERIES, STATEMENTS
from tests.conftest import SF_DIR

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_base(text):
    words = WORDS.findall((text or "").translate(LOWER))
    places = [
        (i, label)
        for phrase, label in licenses.BASE_PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def check(rows, docs):
    assert len(rows) == len(docs)
    for row in rows:
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == plain_base(docs[row.doc_id])
        assert set(row.base_labels.split(",")) - {""} <= set(row.labels.split(","))
        assert 0 <= row.score <= 1


def test_query_base(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op4_license_scan"](spark, SF_DIR).collect()
    check(rows, docs)
    assert {"mit", "gpl,gpl-3.0", "apache,apache-2.0"} & {r.labels for r in rows}


@pytest.mark.parametrize(
    ("text", "labels", "score"),
    [
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0", 1.0),
        ("Licensed under the terms of the GNU General Public License v2", "gpl,gpl-2.0", 1.0),
        ("licensed under the GNU General Public License, edition 3", "gpl", 0.5),
        ("Licensed under the Apache License, Version 2.0 (the License)", "apache,apache-2.0", 1.0),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0", 1.0),
        ("Licensed under CC BY-SA 3.0.", "cc-by", 0.5),
        ("Copyright 2024 Jane Doe. All rights reserved.", "all-rights-reserved,copyright", 1.0),
        ("cc by cc by MIT  license", "cc-by,mit", 0.5),
        ("the mitx license", "", 0.0),
        ("", "", 0.0),
        (None, "", 0.0),
    ],
)
def test_wordings(spark, text, labels, score):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = licenses.license_report(docs).first()
    assert (row.labels, row.score) == (labels, score)
    check([row], {1: text})


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
GOOD = "Software.\n\nThe Software shall be used for Good, not Evil.\n\nTHE SOFTWARE IS"
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
CONDITION = """, provided that the above copyright notice and this permission notice appear in all copies"""
CLAUSES = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
   disclaimer.
* Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
  disclaimer in the documentation and/or other materials provided with the distribution."""
ADVERTISING = """
3. All advertising materials mentioning features or use of this software must display the following acknowledgement:
   This product includes software developed by the University of Somewhere and its contributors."""
NAMES = """
4. Neither the name of the University nor the names of its contributors may be used to endorse or promote products
   derived from this software without specific prior written permission."""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}
Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any
later version."""
MOZILLA = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
WHOLE = [
    (MIT, "mit"),
    (MIT.replace("THE AUTHORS OR\nCOPYRIGHT HOLDERS", "Jane Doe"), "mit"),
    (MIT.replace("Software.\n\nTHE SOFTWARE IS", GOOD), "json"),
    (MIT[: MIT.index(", including without")], ""),
    (MIT.replace("sublicense, ", ""), ""),
    (ISC, "isc"),
    (ISC.replace(CONDITION, ""), "0bsd"),
    (ISC.replace("INDIRECT, ", ""), ""),
    (CLAUSES + DISCLAIMER, "bsd-2-clause"),
    (CLAUSES + NAMES + DISCLAIMER, "bsd-3-clause"),
    (CLAUSES + ADVERTISING + NAMES + DISCLAIMER, "bsd-4-clause"),
    (CLAUSES, ""),
    (HEADER.format("General", 3), "gpl,gpl-3.0"),
    (HEADER.format("General", 2), "gpl,gpl-2.0"),
    (HEADER.format("Lesser General", "2.1"), "lgpl-2.1"),
    (HEADER.format("Library General", 2), "lgpl-2.0"),
    (HEADER.format("Affero General", 3), "agpl-3.0"),
    (MOZILLA, "mpl-2.0"),
    (MOZILLA[:90], ""),
    ("Licensed under CC BY-NC-SA 4.0", "cc-by,cc-by-nc-sa-4.0"),
    ("licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "cc-by-nc-sa-4.0"),
]


def test_whole_texts_and_their_statement(spark, tmp_path):
    import duckdb

    docs = spark.createDataFrame([(i, f"x {text} y") for i, (text, _) in enumerate(WHOLE)], "doc_id long, text string")
    rows = licenses.license_report(docs).drop("places").orderBy("doc_id").collect()
    assert [r.labels for r in rows] == [labels for _, labels in WHOLE]
    docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet'")
        found = db.sql(f"SELECT * FROM ({STATEMENTS['op4_license_scan']}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in rows] == found


def test_optional_and_replaceable_regions():
    automaton = licenses.compiled((("x", "a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> <<var;match=[0-9]+;max=2>> d"),))
    accepts = {text: automaton.accepted(text.encode().split(), 0) for text in ("a d", "a b c d", "a b 1 2 d", "a c d", "a 1 2 3 d", "a x d")}
    assert accepts == {"a d": {}, "a b c d": {}, "a b 1 2 d": {0: 5}, "a c d": {}, "a 1 2 3 d": {}, "a x d": {}}


@pytest.mark.parametrize("template", ["", "<<beginOptional>>a<<endOptional>> b", "a <<beginOptional>> b"])
def test_bad_markup(template):
    with pytest.raises((ValueError, IndexError)):
        licenses.compiled((("x", template),))


def test_odd_rows(odd_docs, no_docs):
    rows = licenses.license_report(odd_docs).collect()
    assert len(rows) == 8 and all(r.labels == "" for r in rows)
    assert licenses.license_report(no_docs).count() == 0
