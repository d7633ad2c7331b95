"""Licence scans against their SQL statement and by hand."""

from __future__ import annotations

import textwrap

import pandas as pd
import pytest

from newsloom.llm import licences


@pytest.fixture(scope="module")
def docs(spark, messy):
    mit = licences.SENTENCES["mit-grant"] + "\n\n" + licences.SENTENCES["mit-keep"]
    gpl = " ".join(licences.SENTENCES[k] for k in ("gpl-free", "gpl3-or-later", "gpl-hope"))
    texts = [mit, mit.upper(), licences.SENTENCES["mit-keep"] + " " + licences.SENTENCES["mit-grant"], gpl,
             "Words. released under the MIT license!  More.", "Licensed under CC BY-NC 4.0.\n" * 3,
             "Licensed under the Apache License, Version 2.0. Released under the MIT License.",
             "released under the mit licensed", "the MIT License", None, "", "." * 50]
    rows = [(100 + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string").unionByName(
        messy.select("doc_id", "text"))


def test_matches_sql(docs, in_sql, same):
    frame = pd.DataFrame([tuple(r) for r in docs.collect()], columns=["doc_id", "text"]).astype(
        {"doc_id": "Int64"})
    same(licences.report(docs), in_sql(licences.sql(), documents=frame))


def test_rules_take_their_sentences_in_order(docs):
    got = {r.doc_id: (r.rules, r.licences) for r in licences.report(docs).collect() if r.doc_id and r.doc_id >= 100}
    assert got[100] == got[101] == ("mit-text", "MIT")
    assert got[102] == ("mit-grant-only", "MIT")
    assert got[103] == ("gpl3-header", "GPL-3.0-or-later")
    assert got[104] == ("mit-line", "MIT")
    assert got[105] == ("cc-by-nc-line", "CC-BY-NC-4.0")
    assert got[106] == ("mit-line|apache-line", "MIT|Apache-2.0")
    assert all(got[i] == ("", "") for i in range(107, 112))


def _text(*keys: str, numbers: bool = False) -> str:
    body = "\n\n".join((f"{i}. " if numbers and i else "") + licences.SENTENCES[k] for i, k in enumerate(keys))
    return "Some Project\nCopyright (c) 2020 Someone\n\n" + body + "\n\nTHE SOFTWARE IS PROVIDED AS IS\n"


def _wrapped(text: str, mark: str = "") -> str:
    return "\n".join(mark + line for part in text.split("\n") for line in (textwrap.wrap(part, 74) or [""]))


BSD = ("bsd-grant", "bsd-source", "bsd-binary")


@pytest.mark.parametrize("text, licence", [
    (_wrapped(_text("mit-grant", "mit-keep")), "MIT"),
    (_wrapped(_text("mit-grant", "mit-keep"), " * "), "MIT"),
    (_wrapped(_text("mit-grant", "mit-keep"), "# ").replace("\n", "\r\n"), "MIT"),
    (_text("mit-grant", "mit-keep") * 2, "MIT"),
    (_text("mit-grant", "mit-keep", "mit-grant", "mit-keep"), "MIT"),
    (_wrapped(_text(*BSD, numbers=True)), "BSD-2-Clause"),
    (_wrapped(_text(*BSD, "bsd-endorse", numbers=True)), "BSD-3-Clause"),
    (_text(*BSD, "bsd-endorse").replace("\n\nRedistributions", "\n* Redistributions").replace("\n\nN", "\n* N"), "BSD-3-Clause"),
    (_wrapped(_text(*BSD, "bsd-endorse", numbers=True), "// "), "BSD-3-Clause"),
    (" ".join(f"{i}. {licences.SENTENCES[k]}" if i else licences.SENTENCES[k] for i, k in enumerate(BSD)),
     "BSD-2-Clause"),
    (_wrapped(" ".join(licences.SENTENCES[k] for k in ("gpl-free-2", "gpl2-only")), "# "), "GPL-2.0-only"),
    (_wrapped(" ".join(licences.SENTENCES[k] for k in ("gpl-free-2", "gpl2-only-2"))), "GPL-2.0-only"),
    (_wrapped(" ".join(licences.SENTENCES[k] for k in ("gpl-free", "agpl3-or-later"))), "AGPL-3.0-or-later"),
    (_wrapped(" ".join(licences.SENTENCES[k] for k in ("lgpl-free", "lgpl21-or-later"))), "LGPL-2.1-or-later"),
    (_wrapped(_text("unlicense")), "Unlicense"), (_wrapped(_text("cc0-given")), "CC0-1.0"),
    ("a heading\nReleased under the MIT License.\nmore words", "MIT"),
    ("a heading without an end\nreleased under the MIT License", "MIT"),
    ("we said it was Released under the MIT License.", ""),
])
def test_texts_as_they_are_found(spark, in_sql, same, text, licence):
    docs = spark.createDataFrame([(1, text, "x")], "doc_id long, text string, sequence string")
    row = licences.report(docs).first()
    assert row.licences == licence and len(row.rules.split("|")) == 1
    same(licences.report(docs), in_sql(licences.sql(), documents=pd.DataFrame({"doc_id": [1], "text": [text]})))


def test_plan_is_native_and_moves_nothing(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = licences.report(docs)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_empty(no_docs):
    assert licences.report(no_docs).collect() == []
