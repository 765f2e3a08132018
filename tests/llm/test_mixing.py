import random
import re
from collections import defaultdict

import pytest
from llm_docs import SF_MID, edge, make_docs, nothing  # noqa: F401

from tallyhouse.llm import mixing as M
from tallyhouse.llm.common import read_table


def targets(sizes, cap=3):
    """Share by weight, stop at the cap, share what is left over, again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > cap * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in above}


def check(docs, salt_rows=M.SALT_ROWS):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    rows = docs.collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += size(r.text)
    want = targets(sizes)
    got = M.mix_plan(docs, salt_rows=salt_rows).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (r.doc_id is None, r.doc_id or 0, size(r.text)) for r in rows)
    source = {r.doc_id: r.source for r in rows if r.doc_id is not None}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert 0 <= r.copies <= 3
        if r.doc_id is not None:
            s = source[r.doc_id]
            assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], abs=1e-6)
    for r in M.mixed(docs, salt_rows=salt_rows).collect():
        taken[r.source] += size(r.text)
    for r in rows:
        largest[r.source] = max(largest[r.source], size(r.text))
    return want, taken, largest


def test_targets_are_met(spark):
    docs = read_table(spark, SF_MID, "documents")
    for salt_rows in (M.SALT_ROWS, 50):
        want, taken, largest = check(docs, salt_rows)
        for s in want:
            assert abs(taken[s] - want[s]) <= 2 * largest[s] + 0.02 * want[s]
    assert sum(taken.values()) == pytest.approx(sum(want.values()), rel=0.05)


def test_edges(edge, nothing):  # noqa: F811
    check(edge)
    mixed = M.mixed(edge)
    assert mixed.columns == edge.columns
    assert M.mix_plan(nothing).collect() == [] and M.mixed(nothing).collect() == []


def test_capped_sources(spark):
    rng = random.Random(1)
    rows = [(k, "w " * rng.randrange(1, 9), "en", "ab"[k % 2] if k < 20 else "c") for k in range(400)]
    rows += [(900, "", "en", "empty"), (901, None, "en", None)]
    want, taken, _ = check(make_docs(spark, rows))
    assert want["empty"] == 0 and want[None] == 0 and taken["a"] <= want["a"] + 30


def test_reruns_agree(spark, edge):  # noqa: F811
    one = sorted(map(str, M.mix_plan(edge).collect()))
    assert one == sorted(map(str, M.mix_plan(edge.repartition(7)).collect()))


def test_helper_tables_do_not_grow_with_rows(spark, monkeypatch):
    """One line per size class of a source, and per salt where a class is large."""
    held = {}
    stored = M.stored

    def noted(df, name):
        held[name] = stored(df, name)
        return held[name]
    monkeypatch.setattr(M, "stored", noted)
    docs = make_docs(spark, [(k, "w " * (k % 9), "en", "ab"[k % 2]) for k in range(6000)])
    plan = M.mix_plan(docs, salt_rows=100)
    assert plan.count() == 6000
    sizes = {r[0]: r[1] for r in held["mix-starts"].groupBy("skey").count().collect()}
    assert held["mix-hot"].count() > 0 and sum(sizes.values()) <= 2 * 9 + 6000 // 100 + held["mix-hot"].count()
    small = M.mix_plan(docs)
    assert small.count() == 6000 and held["mix-hot"].count() == 0 and held["mix-starts"].count() <= 18


def test_classes_of_many_words_have_salts(spark, monkeypatch):
    monkeypatch.setattr(M, "SALT_WORDS", 3000)
    docs = make_docs(spark, [(k, "w " * (900 + k), "en", "ab"[k % 2]) for k in range(60)])
    want, taken, largest = check(docs)
    for s in want:
        assert abs(taken[s] - want[s]) <= 2 * largest[s] + 0.02 * want[s]
