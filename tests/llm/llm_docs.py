"""Documents with every awkward case, and helpers of this folder's tests."""

import random
from collections import defaultdict

import pytest

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          # names that the operators use themselves
          "piece int, start bigint, row string, spans string, size bigint, fingerprint string, key string, hash bigint, "
          "component_id bigint, lang_pred string, score double, `range` int, _h bigint, copies bigint, labels string, "
          "_key string, _copy bigint, shard int")


def make_docs(spark, rows):
    """rows: (doc_id, text, lang, source); the clashing columns hold junk."""
    junk = (7, 7, "x", "x", 7, "x", "x", 7, 7, "x", 0.5, 7, 7, 7, "x", "x", 7, 7)
    return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t), *junk) for i, t, lang, src in rows],
                                 SCHEMA).repartition(3)


def edge_rows():
    """Nulls, empty and long texts, repeated rows, copies and near copies."""
    rng = random.Random(5)
    words = ["the", "of", "and", "der", "les", "ñandú", "Straße", "river", "stone", "cloud", "table", "window", "x1",
             "42", "green", "quiet", "harbour", "lantern", "orbit", "puzzle", "!!", "—", "don't", "éclair"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(120)
    near = base.split()
    near[60] = "changed"
    rows = [(k, text(rng.choice([1, 3, 5, 40, 300])), rng.choice(["en", "de", None]), rng.choice(["a", "b", "ü", None]))
            for k in range(40)]
    rows += [(100, None, None, None), (101, "", "en", "a"), (102, "   \t\n", "en", "a"), (103, text(9000), "en", "b"),
             (104, base, "en", "a"), (105, base, "de", "b"), (106, " ".join(near), "en", None), (107, base, "en", "a"),
             (None, base, "en", "a"), (None, text(30), None, "c"), (None, None, None, None), (108, "!!! ... 123", "en", "c"),
             (109, "<|endoftext|> İstanbul ΣΑΣ \u0001 \u00a0x e\u0301", "fr", "c"), (110, "😀 emoji 😀😀 text", "es", "c"),
             (111, "word", "en", "c"), (111, "word", "en", "c"), (111, "other word", "en", "c")]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return make_docs(spark, edge_rows()).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return make_docs(spark, edge_rows()).limit(0)


def collect_by_row(docs, result):
    """(text, result row) for every row; rows of one doc_id are paired in any
    order that the caller's check of equal texts allows, so ids here must not
    have different texts: such rows are left out."""
    texts = defaultdict(set)
    for r in docs.select("doc_id", "text").collect():
        texts[r.doc_id].add(r.text)
    rows = result.collect()
    assert len(rows) == docs.count()
    return [(next(iter(texts[r.doc_id])), r) for r in rows if len(texts[r.doc_id]) == 1]
