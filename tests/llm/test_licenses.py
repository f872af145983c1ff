import re

import duckdb
import pytest

from twinledger.llm import license_rules

MIT = "\n".join(license_rules.SENTENCES[k] for k in ("mit.grant", "mit.notice", "mit.asis", "mit.liability"))
APACHE = " ".join(license_rules.SENTENCES[k] for k in ("apache.named", "apache.comply", "apache.obtain"))
GPL = " ".join(license_rules.SENTENCES[k] for k in ("gpl3.terms", "gpl.asis", "gpl.see"))


def wrapped(text, width=60):
    out, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            out.append(line)
            line = ""
        line = f"{line} {w}".strip()
    return "\n".join([*out, line])


CASES = [
    ("Text.\nLicensed under the Apache License, Version 2.0.", "Apache-2.0", 1, 0), ("Released under the MIT License.", "MIT", 1, 0),
    ("This work is licensed under the GNU General Public License, version 3. More.", "GPL-3.0-only", 1, 0), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", 1, 0),
    ("Copyright (c) 2020 A. Person\n" + MIT, "MIT", 1, 0), (wrapped(MIT), "MIT", 1, 0), (wrapped(APACHE), "Apache-2.0", 1, 0), (wrapped(GPL), "GPL-3.0-or-later", 1, 0),
    ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause", 1, 0), ("A new licence for drivers was issued.", "", 0, 1), ("Nothing of the kind.", "", 0, 0), ("", "", 0, 0), (None, "", 0, 0),
    ("Released under the MIT License.\nLicensed under CC BY 4.0.\nReleased under the MIT License.", "MIT,CC-BY-4.0", 3, 0),
    (license_rules.SENTENCES["gpl2.terms"], "GPL-2.0-or-later", 1, 0), ("LICENSED### UNDER THE&&& MIT LICENSE!!", "MIT", 1, 0),
]

VERBS = ("licensed", "licenced", "released", "distributed", "available", "published", "provided", "made available")
BY_VERB = [(f"Text.\n{lead}{verb} under {of}{name}.\nMore text.", x) for name, x in license_rules.NAMES.items() for verb in VERBS for lead in ("", "This work is ") for of in ("", "the terms of the ")]

BSD = [license_rules.SENTENCES[k] for k in ("bsd.grant", "bsd.source", "bsd.binary", "bsd.endorse", "bsd.asis", "bsd.liability")]
HOLDER = [*BSD[:3], BSD[3].replace("the copyright holder nor", "Example Corp. nor"), BSD[4].replace("THE COPYRIGHT HOLDERS", "EXAMPLE CORP."), BSD[5].replace("THE COPYRIGHT HOLDER OR", "EXAMPLE CORP. OR ITS")]
ZLIB = "This software is provided 'as-is', without any express or implied\nwarranty. " + license_rules.SENTENCES["zlib.grant"]


def notice(*keys):
    return " ".join(license_rules.SENTENCES[k] for k in keys)


CASES += [
    ("\n".join(BSD), "BSD-3-Clause", 1, 0), ("\n".join(HOLDER), "BSD-3-Clause", 1, 0), (wrapped(" ".join(HOLDER), 50), "BSD-3-Clause", 1, 0),
    ("\n\n".join(BSD[:3] + BSD[4:]), "BSD-2-Clause", 1, 0), ("\n".join(BSD[:3]), "BSD-2-Clause", 1, 0),
    ("\n".join([*BSD[:3], "Use needs a further permission of the owner.", *BSD[4:]]), "LicenseRef-BSD", 1, 1),
    ("This library is free software; " + notice("lgpl21.terms", "lgpl.asis", "lgpl.see"), "LGPL-2.1-or-later", 1, 0), (notice("agpl3.terms", "gpl.asis", "agpl.see"), "AGPL-3.0-or-later", 1, 0),
    (wrapped(notice("epl.terms")), "EPL-2.0", 1, 0), (ZLIB, "Zlib", 1, 0),
    ("Licensed under the GNU General Public License v3.0.", "GPL-3.0-only", 1, 0), ("Licensed under the GNU General Public License v2.0 or later.", "GPL-2.0-or-later", 1, 0),
    ("// SPDX-License-Identifier: MIT OR Apache-2.0", "MIT,Apache-2.0", 2, 0), ("SPDX-License-Identifier: GPL-2.0", "GPL-2.0-only", 1, 0),
    ("SPDX-License-Identifier: (GPL-2.0+ OR MIT) AND BSD-3-Clause", "GPL-2.0-or-later,MIT,BSD-3-Clause", 3, 0),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0-only", 1, 0), ("Released under the MIT License (see LICENSE).", "MIT", 1, 0),
    ("Dual licensed under MIT and Apache 2.0.", "MIT,Apache-2.0", 2, 0), ("Released under MIT.", "MIT", 1, 0), ("Licensed under MIT or Foo.", "MIT", 1, 1),
    ("Licensed under GPLv3.", "GPL-3.0-only", 1, 0), ("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)", "BSL-1.0", 1, 1),
]


def test_cases(spark):
    docs = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "doc_id long, text string")
    got = {r.doc_id: (r.licenses, r.n_matches, r.n_unknown) for r in license_rules.scan_licenses(docs).collect()}
    for i, (text, *want) in enumerate(CASES):
        assert got[i] == tuple(want), text


def test_every_known_sentence_holds_a_trigger():
    assert all(re.search(license_rules.TRIGGER, s) or s.startswith("under ") or s.startswith("spdx") for s in license_rules.known_sentences())


def test_sql_says_the_same(spark, hard, hard_rows):
    texts = [c[0] for c in CASES] + [t for t, _ in BY_VERB] + [f"Text.\n{t}\n \t\r\n{c[0]}" for c in CASES for t in ("Released under the MIT License", "Filmed under CCTV.")]
    rows = list(enumerate(texts)) + [(r[0], r[1]) for r in hard_rows]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(con.execute(license_rules.scan_sql()).fetchall(), key=repr)
    got = license_rules.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert len(license_rules.scan_licenses(hard).collect()) == len(hard_rows)


def test_no_python_in_the_plan(hard):
    plan = license_rules.scan_licenses(hard)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty_table(none):
    assert license_rules.scan_licenses(none).collect() == []


def test_each_name_is_found_behind_each_verb(spark):
    rows = list(BY_VERB)
    rows += [("Released under CC BY 4.0.", "CC-BY-4.0"), ("This dataset is distributed under the terms of the CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Made available\nunder\nCC0 1.0.", "CC0-1.0")]
    rows += [("This is free and unencumbered software released into the public\ndomain.", "Unlicense")]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: (r.licenses, r.n_matches, r.n_unknown) for r in license_rules.scan_licenses(docs).collect()}
    for i, (text, want) in enumerate(rows):
        assert got[i] == (want, 1, 0), text


def test_every_known_sentence_is_a_notice(spark):
    docs = spark.createDataFrame([(s,) for s in license_rules.known_sentences()], "s string")
    assert docs.filter(~docs.s.rlike(license_rules.NOTICE)).collect() == []


def test_unknown_names_behind_a_verb_count(spark):
    docs = spark.createDataFrame([(1, "Released under CC BY 3.0."), (2, "Filmed under CCTV.")], "doc_id long, text string")
    assert sorted((r.doc_id, r.licenses, r.n_unknown) for r in license_rules.scan_licenses(docs).collect()) == [(1, "", 1), (2, "", 0)]


def test_a_notice_of_one_line_and_a_wrapped_one(spark):
    """One is known only by its line, the other only with its lines joined."""
    line, folded = "Released under the MIT License", wrapped(APACHE, 40)
    rows = [(f"{line}\n\n{folded}", "MIT,Apache-2.0"), (f"{folded}\n\n{line}\n\nmore", "Apache-2.0,MIT"), (f"{folded}\n{line}\nmore", "Apache-2.0,MIT"), (f"{line}\n \t\r\n{wrapped(GPL, 30)}\nCopyright (c) 2020 A\n{line}", "MIT,GPL-3.0-or-later")]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in license_rules.scan_licenses(docs).collect()}
    for i, (text, want) in enumerate(rows):
        assert got[i] == want, text


def test_a_sentence_across_a_blank_line(spark):
    docs = spark.createDataFrame([(1, "Licensed under the Apache\n\nLicense, Version 2.0.")], "doc_id long, text string")
    assert [r.licenses for r in license_rules.scan_licenses(docs).collect()] == ["Apache-2.0"]
