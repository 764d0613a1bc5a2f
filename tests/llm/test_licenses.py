"""Operator 6: canonical forms and lookups."""

import hashlib
import textwrap

import duckdb
import pandas as pd

from arrears.llm import licenses, sql
from tests.llm.rows import no_documents, odd_documents


def forms(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.c for r in df.orderBy("i").select(licenses.canonical(df["t"]).alias("c")).collect()]


def test_canonical(spark):
    assert forms(spark, [
        "The  LICENCE, (v2)!", "Copyright 2020 X\nCopyright (c) 2021 Y\nthe license v2", "  © me\n(C) you\nAll rights reserved.",
        None, "Sub-licence authorised by an Organisation", "not a copyright line: Copyright", "É à"]) == [
        "the license v2", "the license v2", "", "", "sublicense authorized by an organization", "not a copyright line copyright", "É à"]


def test_whole_texts_and_notices(spark):
    mit = next(t for i, t in licenses.KNOWN if i == "MIT" and len(t) > 500)
    rows = [(1, "Copyright (c) 2024 Somebody\n\n" + mit.upper().replace(" ", "  ")), (2, mit + " Except on Sundays."),
            (3, "Words.\nReleased under the MIT licence!\nLicensed under CC BY 4.0\nreleased under the mit license"),
            (4, None), (5, ""), (3, "Other text"), (6, "Released under the MIT License."), (6, "Released under the MIT License.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = licenses.scan(docs, licenses.known_licenses(spark)).collect()
    assert len(got) == len(rows)
    see = sorted((r.doc_id, r.license or "", r.notices, r.n_notice_lines) for r in got)
    assert see == [(1, "MIT", "", 0), (2, "", "", 0), (3, "", "", 0), (3, "", "CC-BY-4.0,MIT", 3), (4, "", "", 0), (5, "", "", 0),
                   (6, "MIT", "MIT", 1), (6, "MIT", "MIT", 1)]
    assert {r.text_digest for r in got if r.doc_id in (4, 5)} == {hashlib.sha256(b"").hexdigest()} == {licenses.NOTHING}


def test_odd_rows_and_empty(spark):
    known = licenses.known_licenses(spark)
    docs = odd_documents(spark)
    assert licenses.scan(docs, known).count() == docs.count()
    assert licenses.scan(no_documents(spark), known).count() == 0
    assert licenses.scan(docs, known.limit(0)).filter("license is not null or n_notice_lines > 0").count() == 0


def test_entire_texts_with_title_and_inside_other_text(spark):
    mit = next(t for i, t in licenses.KNOWN if i == "MIT" and len(t) > 500).replace("\n", "\n\n")
    full = {name: text for name, text in reversed(licenses.full_texts())}
    named = sorted({"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "MIT", "MPL-2.0"})
    assert sorted(full) == named
    around = "# Project\n\nSome words.\n\n{}\n\nMore words."
    rows = [(i, full[n]) for i, n in enumerate(named)] + [(20 + i, around.format(full[n])) for i, n in enumerate(named)]
    rows += [(40, "MIT License\n\nCopyright (c) 2024 X\n\n" + mit), (41, around.format("Copyright 2024 X\n\n" + mit)),
             (42, around.format(mit.replace("\n\n", "\n"))), (43, around.format(mit.split("\n\n", 1)[1])),
             (44, "/*\n * " + mit.replace("\n\n", "\n *\n * ") + "\n */\n\ncode();")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), licenses.known_licenses(spark)).collect()}
    assert len(got) == len(rows)
    for i, n in enumerate(named):
        assert got[i].license == n and got[20 + i].license is None and n in got[20 + i].notices.split(","), n
    assert got[40].license == "MIT"
    assert [(got[i].license, got[i].notices) for i in (41, 42, 43, 44)] == [(None, "MIT"), (None, "MIT"), (None, ""), (None, "MIT")]


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(" ".join(block.split()), width) for block in text.split("\n\n"))


def test_wrapped_anew(spark):
    full = {name: text for name, text in reversed(licenses.full_texts())}
    texts = [(name, width, wrapped(text, width)) for name, text in full.items() for width in (40, 50, 60, 66, 72, 76, 80, 90, 120, 10 ** 6)]
    texts += [(name, -width, wrapped(text, width)) for name, text in licenses.full_texts() for width in (64, 99)]
    rows = [(i, t) for i, (_, _, t) in enumerate(texts)] + [
        (10_000 + i, "Copyright (c) 2024 Some Body\n\n" + t) for i, (_, _, t) in enumerate(texts)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), licenses.known_licenses(spark)).collect()}
    for i, (name, width, _) in enumerate(texts):
        assert got[i].license == name, (name, width)
        led = got[10_000 + i]                                  # whole, or by its blocks
        assert led.license == name or name in led.notices.split(","), (name, width)
    assert not licenses.scan(spark.createDataFrame([(1, full["MIT"].replace("without limitation", "with limitation"))], "doc_id long, text string"),
                             licenses.known_licenses(spark)).filter("license is not null or notices <> ''").count()


def test_statements_are_not_sentences(spark):
    assert forms(spark, ["the\ncopyright holders and\n(c) you must", "Copyright Some Body\n\nwords", "a\n\n  Copyright by X\n(c) Y\nb"]) == [
        "the copyright holders and c you must", "words", "a b"]


def test_sql_on_entire_texts(spark):
    """The SQL knows the same texts: entire, led by a statement, wrapped anew, and inside other text."""
    full = {name: text for name, text in reversed(licenses.full_texts())}
    rows = []
    for text in full.values():
        rows += [text, wrapped(text, 57), "Copyright 2024 X\n" + text, "# A\n\nWords.\n\n" + wrapped(text, 83) + "\n\nMore.", text[:-30]]
    rows += [None, "", "Words.\nReleased under the MIT licence!", "fulfil\n\nfulfil", "a\x01b"]
    rows = [(i % 50, t) for i, t in enumerate(rows)]
    got = [tuple(r) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), licenses.known_licenses(spark)).collect()]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    want = con.execute(sql.LICENSE_SCAN).fetchall()
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[2] is not None for r in got) >= 20
