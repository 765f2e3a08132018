import random
import re

import numpy as np
import xxhash
from llm_docs import SF_SMALL, collect_by_row, edge, make_docs, nothing  # noqa: F401

from tallyhouse.llm import simhash as H
from tallyhouse.llm.common import read_table
from tallyhouse.llm.components import connected_components


def fingerprint(text, k=4):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, bits):
    """Smallest position reachable, by comparing all pairs."""
    p = np.array(prints, dtype=np.uint64)
    label = np.arange(len(p))
    near = np.bitwise_count(p[:, None] ^ p[None, :]) <= bits
    while True:
        low = np.where(near, label[None, :], len(p)).min(axis=1)
        if (low == label).all():
            return label
        label = low


def check(docs, bits=4):
    rows = H.near_duplicates(docs, 4, bits).collect()
    for text, r in collect_by_row(docs, H.near_duplicates(docs, 4, bits)):
        assert r.fingerprint == f"{fingerprint(text):016x}"
    label = classes([int(r.fingerprint, 16) for r in rows], bits)
    for k in set(label):
        ids = [r.doc_id for r, x in zip(rows, label) if x == k and r.doc_id is not None]
        assert {r.component_id for r, x in zip(rows, label) if x == k} == {min(ids) if ids else None}


def test_tables(spark, edge, nothing):  # noqa: F811
    check(edge)
    check(read_table(spark, SF_SMALL, "documents"))
    assert H.near_duplicates(nothing).collect() == [] and H.keep_one(nothing).collect() == []


def random_prints(n, seed=1):
    """Fingerprints in dense groups: up to nine bits away from a few centres."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(max(1, n // 60))]
    out = []
    for _ in range(n):
        p = rng.choice(centres)
        for _ in range(rng.randrange(10)):
            p ^= 1 << rng.randrange(64)
        out.append(p)
    return out


def test_links_connect_all_that_brute_force_does(spark):
    for bits, block in ((4, 8192), (4, 5), (1, 8192), (8, 40)):
        prints = random_prints(900, bits)
        signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
        links = H.links(spark.createDataFrame(signed, "fingerprint bigint"), bits, block).collect()
        place = {p[0]: k for k, p in enumerate(signed)}
        label = list(range(len(signed)))

        def find(x):
            while label[x] != x:
                x = label[x]
            return x

        for r in links:
            label[find(place[r.a])] = find(place[r.b])
        want = classes(prints, bits)
        got = [find(place[p[0]]) for p in signed]
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_keep_one(spark, edge):  # noqa: F811
    kept = H.keep_one(edge)
    assert kept.columns == edge.columns
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    label = classes([fingerprint(t) for _, t in rows], 4)
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(left) == len(set(label))
    for k in set(label):
        ids = [i for (i, _), x in zip(rows, label) if x == k]
        best = min((i is None, i or 0) for i in ids)
        mine = [i for i, t in left if t in {t for (_, t), x in zip(rows, label) if x == k}]
        assert (best[1] if not best[0] else None) in mine


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1200)] + \
        [(2000, k) for k in range(2001, 2300)] + [(5, 5)]
    label = {}
    def find(x):  # noqa: E306
        while label.setdefault(x, x) != x:
            x = label[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        label[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame([*edges, (None, 3)], "a bigint, b bigint")).collect()
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_hot_run_before_small_runs_keeps_to_the_chunk(monkeypatch):
    import pyarrow as pa
    rng = random.Random(4)
    runs = [(k, f, p) for k, (f, p) in enumerate([(1, 2), (60, 500), (2, 3), (1, 1), (70, 9), (3, 2), (5, 20), (50, 400), (1, 4)])]
    rows = []
    for key, f, p in runs:
        centre = rng.getrandbits(64)
        near = lambda: centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))  # noqa: B023, E731
        rows += [(key, 0, False, near()) for _ in range(f)] + [(key, 0, True, near()) for _ in range(p)]
    key, block, probe, prints = (list(c) for c in zip(*rows))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(block, pa.int64()), pa.array(probe),
         pa.array(np.array(prints, dtype=np.uint64).view(np.int64))], names=["key", "block", "probe", "fingerprint"])
    real, sizes = H._linker(4), []

    def measured(a, b, first):
        sizes.append(len(a))
        return real(a, b, first)

    def edges():
        return {(a, b) for out in H._links(4)([batch]) for a, b in zip(*(c.to_pylist() for c in out.columns))}

    want = edges()
    monkeypatch.setattr(H, "_linker", lambda bits: measured)
    monkeypatch.setattr(H, "CHUNK", 256)
    assert edges() == want and len(want) > 50
    assert max(sizes) <= 256 and sum(sizes) == sum(f * p for _, f, p in runs)


def test_repeated_rows_and_clashing_names_in_keep_one(spark, edge):  # noqa: F811
    """Columns called like the operator's own come back as they were."""
    kept = H.keep_one(edge, H.SHINGLE, H.MAX_BITS)
    assert kept.schema == edge.schema
    assert {r._key for r in kept.collect()} == {"x"} and {r._copy for r in kept.collect()} == {7}
    many = make_docs(spark, [(1, "the same words in every row", "en", "a")] * 3000)
    assert H.keep_one(many, H.SHINGLE, H.MAX_BITS).count() == 1


def test_keep_one_shuffles_whole_rows_once(spark):
    """The join takes the rows as they were dealt out to be told apart."""
    docs = make_docs(spark, [(k, f"text {k} of a few words", "en", "a") for k in range(40)])
    plan = H.keep_one(docs)._jdf.queryExecution().sparkPlan().toString()
    assert "LeftSemi" in plan and "cast(key" not in plan
    shuffled = H.keep_one(docs)._jdf.queryExecution().executedPlan().toString()
    rows = shuffled[:shuffled.index("struct(doc_id, doc_id")]      # from the result down to the rows as they are read
    assert rows.count("Exchange hashpartitioning") == 1 and rows.count("Sort [") == 2
