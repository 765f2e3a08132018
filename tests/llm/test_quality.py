import numpy as np
from llm_docs import SF_MID, edge, nothing  # noqa: F401
from zlib import crc32

from tallyhouse.llm import quality as Q
from tallyhouse.llm.common import read_table
from tallyhouse.llm.queries import op8_quality_classifier


def grams(text, bits=14):
    w = (text or "").lower().encode().split()
    h = [crc32(x) for x in w]
    h += [(a * 0x01000193 + b + 1) % 2**32 for a, b in zip(h, h[1:])]
    return [(x * 2654435761 % 2**32) >> (32 - bits) for x in h]


def test_brute_force(spark):
    docs, labels = read_table(spark, SF_MID, "documents").collect(), read_table(spark, SF_MID, "labels").collect()
    good = {r.doc_id for r in labels if r.quality == 1 and not r.toxic}
    raw, target = np.zeros(1 << 14), np.zeros(1 << 14)
    found = {r.doc_id: grams(r.text) for r in docs}
    for r in docs:
        np.add.at(raw, found[r.doc_id], 1)
        if r.doc_id in good:
            np.add.at(target, found[r.doc_id], 1)
    ratio = np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))
    got = op8_quality_classifier(spark, SF_MID).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.n_features == len(found[r.doc_id])
        assert abs(r.log_weight - ratio[found[r.doc_id]].sum()) < 1e-6 * (1 + r.n_features) and 0 <= r.score <= 1
    k = round(sum(r.quality == 1 for r in labels) / len(labels) * len(docs))
    best = sorted((r.gumbel_key for r in got), reverse=True)
    assert {r.doc_id for r in got if r.kept} == {r.doc_id for r in got if r.gumbel_key >= best[k - 1]}
    # good documents outweigh the others
    quality = {r.doc_id: r.quality for r in labels}
    share = lambda q: np.mean([r.kept for r in got if quality.get(r.doc_id) == q])
    assert share(1) > share(0) + 0.4


def test_edges(spark, edge, nothing):  # noqa: F811
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)] + [(None, 1, None), (3, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    for k in (0, 1, 20, 10_000):
        rows = Q.resample(edge, labels, k=k).collect()
        assert len(rows) == edge.count()
        kept = [r for r in rows if r.kept]
        assert min(k, len(rows)) <= len(kept) <= k + 3 or len(kept) == len(rows)
        assert all(r.gumbel_key >= s.gumbel_key for r in kept for s in rows if not s.kept)
    none = labels.filter("doc_id < 0")
    assert all(r.kept and r.log_weight == 0 for r in Q.resample(edge, none).collect())
    assert Q.resample(nothing, labels).collect() == []


def test_nth_largest(spark):
    rng = np.random.default_rng(1)
    values = [float(x) for x in np.concatenate([rng.normal(0, 1e6, 300), rng.normal(0, 1e-6, 300), [5.0] * 50])]
    df = spark.createDataFrame([(v,) for v in values], "x double").cache()
    order = sorted(values, reverse=True)
    for n in (1, 2, 150, 320, 600, 650):
        assert Q.nth_largest(df, "x", n, bins=16) == (order[n - 1], sum(v > order[n - 1] for v in values))
