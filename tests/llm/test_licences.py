import re

import pytest

from shoreline.llm import licences

MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
TEXTS = [
    "no licence at all", "Some text\nReleased under the MIT License.\nmore", "Text. Licensed under CC BY-NC 4.0. More",
    MIT, BSD2, BSD2 + "\nNeither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "This work is licensed under the GNU General Public License, version 3.", "x. Licensed under the Apache License, Version 2.0.\nReleased under the MIT Licence.",
    MIT.replace("The above", "The  old"), "(c) 2020 X. All rights reserved.", "Redistributions of source code must retain nothing.", None, "", "\n\r\n",
]


def brute(text):
    lowered = (text or "").lower()
    known = {wording: name for name, wording in licences.SENTENCES.items()}

    def found(whole):
        out = []
        for sentence in re.split(licences.SENTENCE_ENDS, whole):
            for pattern, put in licences.NORMAL_STEPS:
                sentence = re.sub(pattern, put, sentence)
            out += [known[sentence.strip()]] if sentence.strip() in known else []
        return out

    paragraphs = re.sub(licences.PARAGRAPH_ENDS, " ; ", lowered)
    views = [found(re.sub(licences.LINE_ENDS, end, whole)) for whole, end in ((lowered, " ; "), (paragraphs, " "))]

    def follows(sequence, names):
        rest = iter(sequence)
        return all(n in rest for n in names)

    hits = [(name, kind) for name, kind, names in licences.RULES if any(follows(v, names) for v in views)]
    return ",".join(views[0] + views[1]), ",".join(sorted({n for n, _ in hits})), *(hits[0] if hits else (None, None))


def test_equals_brute_force(spark, documents):
    got = licences.scan(documents(*enumerate(TEXTS))).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: brute(t) for i, t in enumerate(TEXTS)}
    assert [r.license for r in sorted(got)] == [None, "MIT", "CC-BY-NC-4.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "GPL-3.0", "Apache-2.0", None, "Proprietary", *[None] * 4]


def test_every_sentence_has_an_anchor():
    assert all(any(a in wording for a in licences.ANCHORS) for wording in licences.SENTENCES.values())
    assert all(name in licences.SENTENCES for *_, names in licences.RULES for name in names)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf):
    import duckdb

    from shoreline.llm import registry
    from tools.check_oracle import normal

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/{sf}/documents.parquet'")
    got = registry.op5_licence_scan(spark, f"/root/testdata/{sf}").toPandas()
    assert normal(got) == normal(duck.execute(licences.sql()).df())


def test_awkward_rows_and_no_python(spark, awkward):
    scanned = licences.scan(awkward)
    assert scanned.count() == awkward.count() and licences.scan(awkward.limit(0)).count() == 0
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


GPL3 = """Copyright (C) 2020 Someone

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
GPL2 = """# Copyright (C) 2020 Someone
#
# This program is free software; you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation; either version 2 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details."""
BSD3 = """Copyright (c) 2019-2021, {0}
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of {0} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
NOTICES = [
    (GPL3, "GPL-3.0-or-later"), (GPL2, "GPL-2.0-or-later"), (GPL3.replace("version 3", "version 2"), "GPL-2.0-or-later"), (GPL2.replace("version 2", "version 3"), "GPL-3.0-or-later"),
    (BSD3.format("Acme Corporation"), "BSD-3-Clause"), (BSD3.format("Acme, Inc."), "BSD-3-Clause"), (BSD3.format("the <organization>"), "BSD-3-Clause"), (BSD3.format("the copyright holder"), "BSD-3-Clause"),
    (MIT.replace("Someone\n\n", "Someone\n"), "MIT"), ("To the extent possible under law, Jane B. Doe has waived all copyright and related or neighboring rights to Project X.", "CC0-1.0"),
    ("Copyright 2020 Acme, all rights reserved", "Proprietary"), ("Neither the name of the game nor the names of its players matter to a license.", None),
]


def test_standard_notices_as_they_are(spark, documents):
    texts = [text for text, _ in NOTICES]
    got = {r.doc_id: r for r in licences.scan(documents(*enumerate(texts))).collect()}
    assert [got[i].license for i in range(len(texts))] == [licence for _, licence in NOTICES]
    assert {i: tuple(r)[1:] for i, r in got.items()} == {i: brute(t) for i, t in enumerate(texts)}
    assert got[0].sentences.endswith("gpl3_terms_later,gpl_useful,gpl_implied")
    assert got[1].sentences.endswith("gpl_terms,gpl2_later,gpl_useful,gpl_implied")


def test_sql_names_the_standard_notices_alike():
    duckdb = pytest.importorskip("duckdb")
    with duckdb.connect() as db:
        db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        db.executemany("INSERT INTO documents VALUES (?, ?)", [[i, t] for i, (t, _) in enumerate(NOTICES)])
        got = {r[0]: r[1:] for r in db.execute(licences.sql()).fetchall()}
    assert got == {i: brute(t) for i, (t, _) in enumerate(NOTICES)}
