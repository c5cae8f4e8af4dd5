from helpers import ODD, documents

from histoframe.llm.licenses import NOTICES, LicenseMatcher, blocks, scan_licenses


def test_wordings(spark):
    rows = [
        (1, "x. Licensed under CC BY-NC 4.0. y"), (2, "licensed### under&&& the%%% APACHE$$$ License,!! Version 2.0.***"), (3, "A licence to kill, and a license plate."),
        (4, f"Copyright 2020 A. B.\n{NOTICES['MIT']}\nend"), (5, "This work is licensed under the GNU General Public License, version 3. All rights reserved."), (5, "Released under the MIT License"),
    ]
    out = sorted((r.doc_id, r.license) for r in scan_licenses(documents(spark, rows)).collect())
    assert out == [(1, "CC-BY-NC-4.0"), (2, "Apache-2.0"), (4, "MIT"), (5, "GPL-3.0"), (5, "LicenseRef-all-rights-reserved"), (5, "MIT")]
    first = scan_licenses(documents(spark, rows[:1])).first()
    assert rows[0][1][first.start : first.end] == "CC BY-NC 4.0" and first.saved > 0


def test_rank_prefers_the_right_license():
    m = LicenseMatcher()
    block = "this work is licensed under the gnu general public license version 3".split()
    assert "GPL-3.0" in [name for _, name in m.ranked(block)[:2]] and [f.license for f in m.find(block)] == ["GPL-3.0"]
    changed = [w if i % 25 else "odd" for i, w in enumerate(" ".join(NOTICES["ISC"].lower().replace(",", " ").replace("/", " ").split()).split())]
    found = m.find(changed)
    assert [f.license for f in found] == ["ISC"] and found[0].missing > 0


def test_odd_rows(spark):
    assert scan_licenses(documents(spark, ODD)).count() == 0
    assert scan_licenses(documents(spark, [])).count() == 0
    assert blocks("license " * 5000)[0][0].start() == 0
