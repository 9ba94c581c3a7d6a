from __future__ import annotations

import textwrap

import pytest

from snapstrata.llm import license_scan
from snapstrata.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return license_scan.learn(table(spark, SF, "documents"))


def families(spark, model, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, findings string")
    return {r.doc_id: (r.n_paragraphs, r.findings) for r in license_scan.scan_licenses(docs, model).collect()}


def test_every_template_is_found_and_confirmed(spark, model):
    rows = [(k, f"first line\n{text}\nlast line", "") for k, (_, text) in enumerate(license_scan.TEMPLATES)]
    got = families(spark, model, rows)
    for k, (family, _) in enumerate(license_scan.TEMPLATES):
        n, findings = got[k]
        assert n == 3
        assert [(f.line, f.family) for f in findings] == [(1, family)]
        assert findings[0].contained == 1.0


def test_notices_inside_long_lines(spark, model):
    fill = "the onble thre er and of thand ing tion " * 40
    got = families(spark, model, [(1, f"{fill} Licensed under the Apache License, Version 2.0. {fill}", ""), (2, fill, "")])
    assert {f.family for f in got[1][1]} <= {"Apache-2.0", license_scan.UNKNOWN} and any(f.family == "Apache-2.0" for f in got[1][1])
    assert got[2][1] == []


def test_every_template_is_found_when_wrapped(spark, model):
    shown = [textwrap.wrap(text, 72) for _, text in license_scan.TEMPLATES]
    assert any(len(lines) > 2 for lines in shown)
    rows = [(k, "\n".join(["some lines before", "", *(f" * {x}\r" for x in lines), "", "and one behind"]), "") for k, lines in enumerate(shown)]
    rows += [(100 + k, "\n".join(lines), "") for k, lines in enumerate(shown)]
    got = families(spark, model, rows)
    for k, (family, _) in enumerate(license_scan.TEMPLATES):
        for row, line in ((k, 2), (100 + k, 0)):
            n, findings = got[row]
            assert n == len(shown[k]) + (2 if line else 0)
            assert [(f.line, f.word, f.family, f.contained) for f in findings] == [(line, 0, family, 1.0)]


def test_usual_headers_are_found_as_wrapped(spark, model):
    headers = {
        "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:",
        "GPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
        "BSD": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
    }
    got = families(spark, model, [(k, text, "") for k, text in enumerate(headers.values())])
    for k, family in enumerate(headers):
        assert [(f.line, f.family) for f in got[k][1] if f.family != license_scan.UNKNOWN] == [(0, family)]


def test_several_notices_in_one_line(spark, model):
    mit = next(t for f, t in license_scan.TEMPLATES if f == "MIT" and t.startswith("Permission"))
    lines = {
        1: ("Code: licensed under the Apache License, Version 2.0. Text: licensed under CC BY 4.0.", ["Apache-2.0", "CC-BY"]),
        2: (f"{mit} All rights reserved.", ["MIT", "all-rights-reserved"]),
        3: ("Licensed under CC BY-SA 4.0. Licensed under CC BY 4.0. Released under the MIT License.", ["CC-BY-SA", "CC-BY", "MIT"]),
        4: ("Released under the MIT License. Licensed under the Frobnicate License.", ["MIT", license_scan.UNKNOWN]),
    }
    got = families(spark, model, [(k, text, "") for k, (text, _) in lines.items()])
    assert {k: [f.family for f in findings] for k, (_, findings) in got.items()} == {k: want for k, (_, want) in lines.items()}


def test_made_up_licenses_are_unknown(spark, model):
    got = families(spark, model, [(1, "Licensed under the Frobnicate License.", ""), (2, "Released under the Quux License, version 2.", "")])
    assert all([f.family for f in findings] == [license_scan.UNKNOWN] for _, findings in got.values())


def test_held_out_documents(spark):
    docs = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    said = {
        "CC-BY-NC": "licensed under cc by-nc 4.0", "GPL-3.0": "licensed under the gnu general public license, version 3",
        "Apache-2.0": "licensed under the apache license, version 2.0", "MIT": "released under the mit license", "all-rights-reserved": "all rights reserved",
    }
    right = total = 0
    for r in QUERIES["op6_license_scan"](spark, SF).collect():
        want = sorted(f for f, text in said.items() if text in docs[r.doc_id].lower())
        total += 1
        right += r.licenses == want
    assert total == len(docs) and right / total > 0.995


def test_edges(spark, model):
    got = families(spark, model, [(1, None, ""), (2, "", ""), (3, "\n\n", ""), (4, "All rights reserved.", ""), (5, "word " * 300_000, "")])
    assert [got[k][0] for k in range(1, 6)] == [0, 0, 0, 1, 1]
    assert [len(got[k][1]) for k in range(1, 6)] == [0, 0, 0, 1, 0]
    repeated = spark.createDataFrame([(1, "All rights reserved.")] * 3, "doc_id long, text string")
    assert license_scan.scan_licenses(repeated, model).count() == 3
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.scan_licenses(empty, license_scan.learn(empty)).count() == 0
