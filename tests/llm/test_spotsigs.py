import hashlib
import random
import re

import pytest
from llm_docs import SF_SMALL, edge, make_docs, nothing  # noqa: F401
from pyspark.sql import functions as F

from tallyhouse.llm import spotsigs as S
from tallyhouse.llm.common import read_table, stored


def signatures(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    anchors = set(S.ANCHORS)
    found = set()
    for k, w in enumerate(words):
        if w in anchors:
            chain = [x for x in words[k + 1:] if x not in anchors][:3]
            if chain:
                found.add((w, *chain))
    return found or ({("whole", *words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: r[0])
    got = {r.doc_id: r for r in S.edited_fingerprints(docs).collect()}
    assert len(got) == len(rows)
    by_print = {}
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        r, half = got[doc_id], len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, other = signatures(text), signatures(edited)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(jaccard(own, other)) and r.near_next == pytest.approx(
            jaccard(own, signatures(following)))
        for p, s in ((r.fingerprint, own), (r.edited_fingerprint, other)):
            assert by_print.setdefault(p, s) == s
    assert len(by_print) == len({frozenset(s) for s in by_print.values()})


def test_tables(spark, edge):  # noqa: F811
    check(edge.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))
    check(read_table(spark, SF_SMALL, "documents"))


def test_edges(spark, edge, nothing):  # noqa: F811
    rows = S.edited_fingerprints(edge).collect()
    assert len(rows) == edge.count()
    assert all(r.near_edited is not None and r.near_next is not None for r in rows)
    # the rows without doc_id come last; the very last is followed by the first
    assert sorted((r.n_chars for r in rows if r.doc_id is None)) == sorted(
        len(r.text or "") for r in edge.collect() if r.doc_id is None)
    assert S.edited_fingerprints(nothing).collect() == []
    one = S.edited_fingerprints(make_docs(spark, [(5, "the quiet river", "en", "a")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_uneven_ids(spark):
    ids = [-5, 0, 1, 2, 3, 10**6, 10**6 + 1, 10**15, 10**18]
    check(make_docs(spark, [(i, f"the river {i} and the stone {i % 3}", "en", "a") for i in ids]))


def test_plan_is_native(edge):  # noqa: F811
    plan = S.edited_fingerprints(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def distinct_sets(docs):
    found = {}
    for r in docs.collect():
        found.setdefault(frozenset(signatures(r.text)), []).append(r.doc_id)
    return found


def near_sets(sets):
    some = [s for s in sets if s]
    return [(a, b) for i, a in enumerate(some) for b in some[:i] if jaccard(a, b) >= 0.8]


def varied(spark):
    """Chains of near copies, whose ends are far apart, and a passage shared by many."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    text = lambda n: [x for _ in range(n) for x in ("the", word())]
    rows, passage = [], text(12)
    for group in range(6):
        words = text(rng.choice([6, 20, 40]))
        for _ in range(25):
            words = list(words)
            words[rng.randrange(len(words))] = word()
            rows.append(" ".join(words))
    rows += [" ".join(passage + text(rng.choice([1, 2, 3, 8]))) for _ in range(60)]
    rng.shuffle(rows)
    return make_docs(spark, [(i, t, "en", "a") for i, t in enumerate(rows + rows[:9])])


@pytest.mark.parametrize("block", [3, S.BLOCK])
def test_classes(spark, edge, block):  # noqa: F811
    for docs in (edge, varied(spark), read_table(spark, SF_SMALL, "documents")):
        sets = distinct_sets(docs)
        root = {s: s for s in sets}

        def top(s):
            while root[s] != s:
                s = root[s]
            return s

        links = near_sets(sets)
        assert links
        for a, b in links:
            root[top(a)] = top(b)
        ids = {}
        for s, some in sets.items():
            ids.setdefault(top(s), []).extend(some)
        want = sorted(((repr(i), min((k for k in some if k is not None), default=None), len(some))
                       for some in ids.values() for i in some), key=repr)
        signed = stored(S.fingerprints(docs).withColumn("rid", F.monotonically_increasing_id()), "signed")
        got = S.with_classes(signed, block=block)
        assert sorted(((repr(r.doc_id), r.near_class, r.near_rows) for r in got.collect()), key=repr) == want


@pytest.mark.parametrize("block", [3, S.BLOCK])
def test_near_duplicates(spark, edge, block):  # noqa: F811
    for docs in (edge, varied(spark), read_table(spark, SF_SMALL, "documents")):
        members, pairs = S.near_duplicates(docs, block=block)
        names = {r.fingerprint for r in members.collect()}
        assert members.count() == docs.count()
        got = pairs.collect()
        assert len(got) == len({(r.a, r.b) for r in got}) == len(near_sets(distinct_sets(docs)))
        assert all(r.a in names and r.b in names and r.likeness >= 0.8 for r in got)


def test_candidates_of_a_large_group(spark, monkeypatch):
    """Copies of one text that all differ too much are no candidates of one another, not a square of pairs."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=7))
    base, rows = [x for _ in range(60) for x in ("the", word())], []
    for _ in range(300):
        words = list(base)
        for at in rng.sample(range(1, 120, 2), 2):
            words[at] = word()
        rows.append(" ".join(words))
    docs = make_docs(spark, [(i, t, "en", "a") for i, t in enumerate(rows)])
    made, keep = [], S.stored

    def counted(df, name):
        table = keep(df, name)
        if name == "candidates":
            made.append(table.count())
        return table

    monkeypatch.setattr(S, "stored", counted)
    signed = keep(S.fingerprints(docs).withColumn("rid", F.monotonically_increasing_id()), "signed")
    assert S.with_classes(signed).count() == 300
    assert made and sum(made) <= 10 * 300


def test_members_of_frequent_keys(spark, monkeypatch):
    """What is filed under frequent keys is told by these keys, not by joins that all that is filed runs through."""
    rng = random.Random(23)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=7))
    base = [x for _ in range(40) for x in ("the", word())]
    rows = [" ".join(base + ["the", word()]) for _ in range(200)]
    rows += [" ".join(x for _ in range(20) for x in ("the", word())) for _ in range(100)]
    docs = make_docs(spark, [(i, t, "en", "a") for i, t in enumerate(rows)])
    plans, keep = [], S.stored

    def planned(df, name):
        if name == "shared-keys":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df, name)

    monkeypatch.setattr(S, "stored", planned)
    signed = keep(S.fingerprints(docs).withColumn("rid", F.monotonically_increasing_id()), "signed")
    sets = S._sets(signed, S.THRESHOLD)
    members, known = S._members(sets, signed)
    assert len(plans) == 1 and "LeftAnti" not in plans[0]
    filed = [(k, r.rid) for r in sets.collect() for k in r.filed]
    sharing = {}
    for k, rid in filed:
        sharing.setdefault(k, []).append(rid)
    want = sorted((k, rid) for k, rid in filed if len(sharing[k]) > 1)
    assert 0 < len(want) < len(filed)
    assert sorted((r.key, r.rid) for r in members.collect()) == want
    assert sorted(r.rid for r in known.collect()) == sorted({rid for _, rid in want})
