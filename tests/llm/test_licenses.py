import re

import pytest

from llm_docs import SF_SMALL, collect_by_row, edge, make_docs, nothing  # noqa: F401

from tallyhouse.llm import licenses as L
from tallyhouse.llm.queries import op2_license_scans

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(k, label) for phrase, label in BASE.items() for k in range(len(words))
              if words[k:k + len(phrase.split())] == phrase.split()]
    at = sorted(k for k, _ in places)
    return len(words), at, sorted({label for _, label in places})


def test_edges(edge, nothing):
    for text, found in collect_by_row(edge, L.scan(edge)):
        n, at, labels = brute(text)
        assert (found.n_words, list(found.places), list(found.base_labels)) == (n, at, labels)
        assert set(labels) <= set(found.labels) and 0 <= found.score <= 1
    assert L.scan(nothing).collect() == []


@pytest.mark.parametrize("text", [
    "", "MIT License", "mit mit license", "the Apache-License, Apache License", "CC BY CC BY-NC",
    "GNU\nGeneral. PUBLIC license gnu general public license", "limit license", "apache\xa0license", "x" * 200_000,
    "cc by " * 3000])
def test_phrases(text):
    found = L.scan_text(text)
    assert (found["n_words"], found["places"], found["base_labels"]) == brute(text)


@pytest.mark.parametrize("expression, names, choices, ok", [
    ("MIT", {"mit"}, 1, True),
    ("(MIT OR Apache-2.0) AND BSD-3-Clause", {"mit", "apache-2.0", "bsd-3-clause"}, 2, True),
    ("MIT OR Apache-2.0 AND BSD-3-Clause", {"mit", "apache-2.0", "bsd-3-clause"}, 2, True),
    ("(MIT OR ISC) AND (GPL-2.0 OR Apache-2.0)", {"mit", "isc", "gpl-2.0", "apache-2.0"}, 4, True),
    ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl-2.0-only"}, 1, True),
    ("MIT */", {"mit"}, 1, False), ("MIT OR", {"mit"}, 1, False), ("(MIT", {"mit"}, 1, False), ("", set(), 0, False),
    (")", set(), 0, False), ("AND", set(), 0, False)])
def test_expressions(expression, names, choices, ok):
    assert L.parse_expression(expression)[:2] == (names, choices)
    if "*/" not in expression:
        assert L.parse_expression(expression)[2] == ok


def test_tag_adds_labels():
    found = L.scan_text("// SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note OR MIT\ncode")
    assert found["labels"] == ["gpl", "mit"] and found["base_labels"] == [] and found["alternatives"] == 2


def test_prose_after_a_tag_gives_no_label():
    for text in ["see the LICENSE file", "unknown", "NONE", "a b c", "gpled", "mitt", "see MIT"]:
        found = L.scan_text(f"SPDX-License-Identifier: {text}")
        assert found["labels"] == [] and found["score"] == 0.5, text
    found = L.scan_text("SPDX-License-Identifier: MIT see the file")
    assert found["labels"] == ["mit"]
    for name in ["BSD-3-Clause", "GPL-3.0+", "Zlib", "LicenseRef-Acme-1.0", "CC-BY-4.0", "0BSD", "OFL-1.1", "Python-2.0"]:
        assert L.scan_text(f"SPDX-License-Identifier: {name}")["score"] == 1.0, name


def test_any_number_of_alternatives(spark):
    rows = [(n, "SPDX-License-Identifier: " + " AND ".join(["(MIT OR BSD)"] * n), "en", "a") for n in (1, 70, 3000)]
    got = {r.doc_id: r for r in L.scan(make_docs(spark, rows)).collect()}
    assert got[1].alternatives == 2 and got[70].alternatives == 2.0 ** 70 and got[3000].alternatives == float("inf")
    assert all(r.labels == ["bsd", "mit"] and r.score == 1 for r in got.values())


def test_query_columns(spark):
    rows = op2_license_scans(spark, SF_SMALL).collect()
    assert len(rows) == 200
    assert all((r.first_word is None) == (r.n_base == 0) for r in rows)
