import pytest
from pyspark.sql import functions as F

from strata.llm import licences as lic
from strata.session import ship_package
from tests.llm.helpers import EDGE, docs, prose

NOTICES = {
    "MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC": "Licensed under CC BY-NC 4.0.",
    "CC-BY": "Licensed under CC BY 4.0.", "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
}


@pytest.fixture(scope="module")
def scanned(spark):
    ship_package(spark)
    rows = [(i, prose(i, 60) + ".\n" + prose(i + 500, 20)) for i in range(60)]
    for j, (family, notice) in enumerate(NOTICES.items()):
        rows += [(100 + j, f"{prose(j, 30)}.\n{notice}\n{prose(j, 9)}"), (200 + j, notice.upper()), (300 + j, f"{prose(j, 12)}. {notice} And more.")]
    rows += [(400, f"{NOTICES['MIT']}\n{NOTICES['GPL']}\n{NOTICES['MIT']}"), *EDGE, (500, "\n\n"), (501, prose(1, 30_000)),
             (502, "the version under public work is license general this licensed 3 gnu"), (503, "He has a driving licence and reads the general news.")]
    df = docs(spark, rows, clash=True)
    return rows, lic.scan_licences(df).collect()


def test_families(scanned):
    rows, out = scanned
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    for j, family in enumerate(NOTICES):
        assert by[100 + j].families == family and by[100 + j].n_licence == 1 and by[100 + j].first_at == 1, by[100 + j]
        assert by[300 + j].families == family, by[300 + j]
    assert by[400].families == "GPL,MIT" and by[400].n_licence == 3 and by[400].first_at == 0


def test_unknown_stays_unknown(scanned):
    _, out = scanned
    for r in out:
        if r.doc_id is None or r.doc_id < 100 or r.doc_id >= 500:
            assert r.families == "" and r.n_licence == 0 and r.first_at is None, r
    by = {r.doc_id: r for r in out}
    assert by[1].n_paragraphs == 2 or by[1].n_paragraphs >= 0
    assert by[500].n_paragraphs == 0


def test_agreement_equals_set_arithmetic(spark):
    rows = [("gnu general public license version 3", "GPL"), ("licensed under the apache license", "Apache-2.0"), ("red fish", "MIT"), ("mit", "MIT")]
    df = spark.createDataFrame(rows, "body string, family string").withColumn("words", lic.tokens_of(F.col("body")))
    got = [r.a for r in lic.vectors(df).select(lic.agreement(F.col("pairs"), F.col("family")).alias("a")).collect()]
    import re
    for (body, family), a in zip(rows, got):
        pairs = lambda t: {f"{x} {y}" for w in [re.findall(r"[^\W_]+", t.lower())] for x, y in zip(w, w[1:])}
        own = pairs(body)
        want = max(len(own & set(lic.pairs_of(t))) / min(max(len(own), 1), len(lic.pairs_of(t))) for t in lic.TEMPLATES[family])
        assert a == pytest.approx(want)


def test_empty_table(spark):
    assert lic.scan_licences(docs(spark, [])).count() == 0


def test_held_out_lines_of_the_corpus(spark):
    """Every documents row with a known notice is found, and no other (sf0.01)."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = {"MIT": "Released under the MIT License", "Apache-2.0": "Licensed under the Apache License",
             "GPL": "GNU General Public License, version 3", "CC-BY-NC": "Licensed under CC BY-NC 4.0"}
    text = {r.doc_id: r.text for r in df.collect()}
    for r in lic.scan_licences(df).collect():
        assert set(r.families.split(",")) - {""} == {f for f, m in marks.items() if m in text[r.doc_id]}


def test_threshold_is_the_quantile_of_all_far_paragraphs(spark):
    """Look-alikes far rarer than the fit's sample move the threshold; licence text and empty texts don't."""
    rows = [(0, 0.1 + i / 100_000, False, True) for i in range(2990)] + [(0, 0.93, False, True)] * 10 \
        + [(0, 0.99, True, False)] * 500 + [(0, 0.99, False, False)] * 900 + [(None, 0.99, False, True)] * 500
    scored = spark.createDataFrame(rows, "at int, known double, confirmed boolean, far boolean")
    assert lic.calibrated(scored) == pytest.approx(0.93, abs=1 / lic.STEPS)
    assert lic.calibrated(scored.where("known < 0.5")) == lic.FLOOR == lic.calibrated(scored.where("false"))
    assert lic.calibrated(spark.createDataFrame([(0, 1.0, False, True)], scored.schema)) == lic.CEILING


BODIES = [
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.",
    "Redistributions in binary form must reproduce the above copyright notice in the documentation.",
    "Neither party shall be liable for any indirect damages under this license, to the extent permitted by law.",
    "The licensor grants you a worldwide, royalty-free licence to reproduce and share the licensed material.",
    "You may convey verbatim copies of the Program's source code as you receive it, in any medium.",
]


def test_common_licence_text_does_not_hide_the_hits(spark):
    """The corpus with 150 more rows of licence body text keeps every hit it had."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    before = {r.doc_id: (r.n_licence, r.families) for r in lic.scan_licences(df).collect()}
    more = spark.createDataFrame([(10**9 + i, BODIES[i % len(BODIES)]) for i in range(150)], "doc_id bigint, text string")
    after = {r.doc_id: (r.n_licence, r.families) for r in lic.scan_licences(df.unionByName(more)).collect()}
    assert {i: after[i] for i in before} == before and sum(n for n, _ in before.values()) >= 39
    assert after[10**9][1] == "MIT" and after[10**9 + 1][1] == "BSD"


def test_spdx_tags_and_further_families(spark):
    tags = {"MIT": "MIT", "Apache-2.0": "Apache-2.0", "GPL-3.0-or-later": "GPL", "BSD-2-Clause": "BSD", "Zlib": "zlib", "ISC": "ISC",
            "EPL-2.0": "EPL", "Frobnicate-7.1": ""}
    texts = {"This is free and unencumbered software released into the public domain.": "Unlicense",
             "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
             "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.": "zlib"}
    cases = [(f"// SPDX-License-Identifier: {t}", f) for t, f in tags.items()] + list(texts.items())
    rows = [(i, f"{prose(i, 25)}.\n{t}\n{prose(i + 50, 25)}") for i, (t, _) in enumerate(cases)] + [(100 + i, prose(200 + i, 40)) for i in range(40)]
    got = {r.doc_id: r.families for r in lic.scan_licences(docs(spark, rows)).collect()}
    assert {t: got[i] for i, (t, _) in enumerate(cases)} == dict(cases)


def test_templates_are_a_parameter(spark):
    own = {"house": ["This text belongs to the house of many mirrors and may be read aloud on Sundays only."]}
    rows = [(1, f"{prose(1, 30)}.\n{own['house'][0]}"), (2, "Released under the MIT License."), *[(10 + i, prose(i, 30)) for i in range(20)]]
    got = {r.doc_id: r.families for r in lic.scan_licences(docs(spark, rows), templates=own).collect()}
    assert got[1] == "house" and {f for i, f in got.items() if i != 1} == {""}


def test_every_paragraph_is_calibrated_on(spark, monkeypatch):
    """Also those outside the sample that the classifier is fitted on, and long ones."""
    ship_package(spark)
    seen, real = [], lic.calibrated
    monkeypatch.setattr(lic, "SAMPLE_DOCS", 10)
    monkeypatch.setattr(lic, "calibrated", lambda scored: seen.append(scored) or real(scored))
    out = lic.scan_licences(docs(spark, [(i, f"{prose(i, 30)}.\n{prose(i, 300 if i % 9 == 0 else 20)}") for i in range(120)])).collect()
    assert sum(r.n_paragraphs for r in out) == seen[0].where("at IS NOT NULL").count() == 240


def test_no_python_in_the_templates(spark):
    plan = lic.template_table(spark)._jdf.queryExecution().toString()
    assert "Python" not in plan and "RDD" not in plan and lic.template_table(spark).count() == sum(map(len, lic.TEMPLATES.values()))
