"""License scans against a plain word-by-word scan."""

import re
from re import _parser

import pytest

from formweave.llm.licenses import BASE_PHRASES, scan_licenses, signature_rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    """Detections found by trying every rule at every place, no gate, no marks."""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    joined = " " + "".join(w + " " for w in words)
    rules = [(label, -1, phrase) for phrase, label in BASE_PHRASES.items()]
    rules += [(label, tier, expression) for label, tier, _, expression in signature_rules()]
    found = []
    for number, (label, tier, expression) in enumerate(rules):
        for m in re.finditer(f"(?<= )(?:{expression})(?= )", joined):
            first = joined.count(" ", 0, m.start()) - 1
            found.append((first, first + m[0].count(" "), tier, number, label))
    labels = set()
    for d in found:
        better = [
            e
            for e in found
            if e is not d and 0 <= e[2] <= d[2] and e[0] <= d[0] and e[1] >= d[1]
            and (e[2] < d[2] or e[1] - e[0] > d[1] - d[0] or e[3] < d[3])
        ]
        if d[2] == -1 or not better:
            labels.add(d[4])
    base = [d for d in found if d[2] == -1]
    return (
        len(words),
        len(base),
        min((d[0] for d in base), default=None),
        max((d[0] for d in base), default=None),
        ",".join(sorted({d[4] for d in base})),
        ",".join(sorted(labels)),
    )


TEXTS = [
    None,
    "",
    "  ... ",
    "Licensed under CC BY-NC 4.0.\nAll rights reserved, all rights reserved.",
    "cc by cc by cc BY 3.0 cc by",
    "GNU General Public License v2.0 or later; see the GNU Affero General Public License version 3",
    "SPDX-License-Identifier: GPL-2.0-or-later and Apache License, Version 2.0",
    "the MIT License (MIT) Copyright (c) 2020 someone. Permission is hereby granted, free of charge, to any person obtaining a copy",
    "public domain; released into the public domain and cc0 1.0 universal",
    "éric GENERAL  public\tlicense\x00x creative commons attribution share alike 4.0",
    "general public licenses are not it; ccby neither",
    "all rights reserved " * 50,
    "under the FreeBSD license, the Simplified BSD License or the AGPL v3",
    "the GNU Affero General Public License; the GNU Library General Public License 2.1 or any later",
    "a M\u0130T license and the \u212aerberos M\u0131T LICENSE; the MIT Licen\u00c7e \u00c9 GPL 2.0",
    "filler text " * 60000 + "licensed under MIT",
]


@pytest.fixture(scope="module")
def scanned(spark):
    rows = [(i, t, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x"), (None, TEXTS[3], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    return scan_licenses(docs).collect()


def test_as_plain_scan(scanned):
    assert len(scanned) == len(TEXTS) + 2
    for row in scanned:
        text = TEXTS[3 if row.doc_id is None else row.doc_id]
        got = (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels)
        assert got == plain(text), text
        assert 0 <= row.score <= 1


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in scan_licenses(docs).collect():
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels) == plain(texts[row.doc_id])


def test_hundreds_of_rules_and_an_empty_table(spark):
    assert len(signature_rules()) > 200
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def samples(parsed):
    """Texts that an expression matches: every alternative of it, optional parts with and without."""
    texts = [""]
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            more = [chr(value)]
        elif name == "SUBPATTERN":
            more = samples(value[3])
        elif name == "BRANCH":
            more = [t for branch in value[1] for t in samples(branch)]
        elif name == "IN":
            low = value[0][1]
            more = [chr(low[0] if isinstance(low, tuple) else low)]
        elif name == "MAX_REPEAT":
            once = samples(value[2])
            more = [""] + once if value[0] == 0 else [t * value[0] for t in once]
        else:
            raise AssertionError(name)
        texts = [a + b for a in texts for b in more]
    return texts


def test_every_rule_passes_its_gate():
    """The keyword is a whole word of everything that the rule matches."""
    for label, _, keyword, expression in signature_rules():
        for text in samples(_parser.parse(expression)):
            assert re.fullmatch(expression, text) and keyword in text.split(), (label, text)
