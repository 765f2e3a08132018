"""Licence scan: one Aho-Corasick pass over the words of a text finds notice
phrases and identifier tags; tag expressions go through a shunting-yard parser.

Words are runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z.
A phrase counts wherever its words stand consecutively, overlaps included.
``SPDX-License-Identifier:`` tags are followed by an expression of licence
names with AND, OR, WITH and parentheses; WITH binds closest, then AND, then
OR.  Names are those of known licence families and ``LicenseRef-`` ones; any
other word ends the expression, so prose after a tag gives no label.  The parser
gives the names, and how many alternatives a reader may choose from (a double,
as a product of choices has no bound); an expression that does not parse still
yields the names before the fault.

The score ranks evidence: a tag whose expression parses 1, one that parses in
part 0.9, a base phrase 0.8, a notice phrase 0.6, a tag without a name 0.5.

Edge cases: a null text counts as empty: zero words, no places, null first and
last word, empty labels, score 0.  Repeated rows stay rows, a null doc_id is
carried, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.common import ship_by_value, worker_state

ship_by_value(__name__)

# fixed values: base phrases and their labels
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# further notice phrases of common licences
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "isc license": "isc",
    "the unlicense": "unlicense",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "public domain dedication": "public-domain",
    "all rights reserved": "proprietary",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
}
TAG = "spdx license identifier"
# label of a licence name in an expression: the first prefix that fits, else the name itself
NAME_PREFIXES = ["agpl", "lgpl", "gpl", "apache", "mit", "bsd", "mpl", "epl", "isc", "bsl", "cc0", "cc-by-nc",
                 "cc-by-sa", "cc-by-nd", "cc-by", "unlicense"]

# fixed values: families of licence identifiers; a name is one of these, or goes on after a hyphen or a digit
FAMILIES = set("""
0bsd aal afl agpl apache apsl artistic beerware blueoak boost bsd bsl busl bzip2 cc0 cc-by cddl cecill cpal cpl curl
ecl efl elastic epl eupl fsfap ftl gfdl gpl hpnd icu ijg ipl isc latex2e lgpl libpng lpl lppl mit mpl mpl ms-pl ms-rl
mulanpsl naist ncsa netcdf ntp odbl ofl oldap openssl osl php postgresql psf python ql qpl rpl ruby sgi sissl sleepycat
spl sspl tcl ucl unicode unlicense upl vim w3c watcom wtfpl x11 xfree86 xnet zed zend zlib zpl
""".split())
_NAME = re.compile(r"(?:documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+|[a-z0-9][a-z0-9.+-]*", re.I)
_WORD_SPACE = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
                    else 32 for b in range(256))
_EXPRESSION = re.compile(r"(?i)spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:_-]*")
_RANK = {"or": 1, "and": 2, "with": 3}


def known_name(name: str) -> bool:
    """Whether a lower-case name belongs to a licence."""
    if not _NAME.fullmatch(name):
        return False
    if "licenseref-" in name:
        return True
    cuts = [m.start() for m in re.finditer(r"[-0-9+]", name)] + [len(name)]
    return any(name[:cut] in FAMILIES for cut in cuts)


def parse_expression(text: str) -> tuple[set[str], float, bool]:
    """(licence names, number of alternatives, whether it parsed whole).

    Shunting-yard: names go to the output, operators wait on a stack until one
    that binds less tightly (or a closing parenthesis) comes.  A value is a
    pair (names, alternatives): OR adds alternatives, AND multiplies them, and
    WITH keeps the licence and drops the exception's name.
    """
    output: list[tuple[set[str], float]] = []
    waiting: list[str] = []
    ok, want_name = True, True

    def apply(op: str) -> None:
        right, left = output.pop(), output.pop()
        if op == "with":
            output.append(left)
        elif op == "and":
            output.append((left[0] | right[0], left[1] * right[1]))
        else:
            output.append((left[0] | right[0], left[1] + right[1]))

    end = 0
    for m in _TOKEN.finditer(text):
        if text[end:m.start()].strip():
            ok = False                      # other characters end the expression
            break
        token, low = m[0], m[0].lower()
        if want_name and token == "(":
            waiting.append(token)
        elif want_name and (waiting[-1:] == ["with"] or known_name(low)) and token != ")" and low not in _RANK:
            output.append(({low}, 1.0))     # what follows WITH is an exception's name
            want_name = False
        elif not want_name and low in _RANK:
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[low]:
                apply(waiting.pop())
            waiting.append(low)
            want_name = True
        elif not want_name and token == ")" and "(" in waiting:
            while waiting[-1] != "(":
                apply(waiting.pop())
            waiting.pop()
        else:
            ok = not want_name and not waiting  # prose after a whole expression is no fault
            break
        end = m.end()
    if want_name:
        ok = False
        if waiting and waiting[-1] in _RANK:
            waiting.pop()                   # an operator without its right side
    for op in reversed(waiting):
        if op == "(":
            ok = False
        elif len(output) > 1:
            apply(op)
    names = set().union(*(names for names, _ in output)) if output else set()
    return names, (output[-1][1] if output else 0.0), ok


def name_label(name: str) -> str:
    return next((p for p in NAME_PREFIXES if name.startswith(p)), name)


def _automaton():
    state = worker_state()
    if "licenses" not in state:
        import ahocorasick
        a = ahocorasick.Automaton()
        for phrase in [*BASE, *NOTICES, TAG]:
            a.add_word(f" {phrase} ", phrase)
        a.make_automaton()
        state["licenses"] = a
    return state["licenses"]


def scan_text(text: str | None) -> dict:
    """Places, labels and score of one whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = b" ".join(raw.translate(_WORD_SPACE).split())
    line = f" {words.decode('latin-1')} "
    places, labels, base_labels, score = [], set(), set(), 0.0
    tagged, counted, at = False, 0, 0
    for end, phrase in _automaton().iter(line):
        start = end - len(phrase) - 1          # of the blank before the first word
        if phrase in BASE:
            places.append(start)
            base_labels.add(BASE[phrase])
            score = max(score, 0.8)
        elif phrase == TAG:
            tagged = True
        else:
            labels.add(NOTICES[phrase])
            score = max(score, 0.6)
    starts = []
    for start in sorted(places):               # words before a place, counted onwards
        counted += line.count(" ", at, start)
        at = start
        starts.append(counted)
    alternatives = 0.0
    if tagged:
        for m in _EXPRESSION.finditer(text):
            names, choices, ok = parse_expression(m[1])
            labels |= {name_label(n) for n in names}
            alternatives += choices
            score = max(score, 1.0 if ok and names else 0.9 if names else 0.5)
    return {"n_words": words.count(b" ") + 1 if words else 0, "places": starts, "base_labels": sorted(base_labels),
            "labels": sorted(labels | base_labels), "alternatives": alternatives, "score": score}


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, places (word indexes of base phrases), base_labels,
    labels (arrays), alternatives (licence choices that tags offer), score."""
    id_type = docs.select("doc_id").schema[0].dataType.simpleString()
    schema = ("n_words bigint, places array<bigint>, base_labels array<string>, labels array<string>, "
              "alternatives double, score double")
    kinds = {"n_words": pa.int64(), "places": pa.list_(pa.int64()), "base_labels": pa.list_(pa.string()),
             "labels": pa.list_(pa.string()), "alternatives": pa.float64(), "score": pa.float64()}

    def rows(batches):
        for batch in batches:
            found = [scan_text(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([f[k] for f in found], kind) for k, kind in kinds.items())],
                names=["doc_id", *kinds])

    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {id_type}, {schema}")
