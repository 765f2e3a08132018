import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_docs import SF_SMALL, collect_by_row, edge, make_docs, nothing  # noqa: F401

from tallyhouse.llm import periodic as P
from tallyhouse.llm.common import read_table
from tallyhouse.llm.queries import op12_periodic_runs


def brute(words, min_length=12):
    """Runs by comparing the words with themselves at every distance, and the words that stay."""
    best, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e + q - s >= max(min_length, 2 * q):
                best.setdefault((s, e + q), q)
            s = max(e, s + 1)
    runs = sorted((s, e - s, q) for (s, e), q in best.items())
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return runs, [w for i, w in enumerate(words) if i not in gone]


def edited(doc_id, words):
    h, n = (1 if doc_id is None else zlib.crc32(str(doc_id).encode())), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def compare(sequences, min_length=12):
    found = P.scan_texts([None] * len(sequences), [" ".join(w) for w in sequences], min_length)
    for words, (n, runs, collapsed) in zip(sequences, found):
        want, kept = brute(words, min_length)
        assert (n, runs, collapsed.decode()) == (len(words), want, " ".join(kept))
    return sum(len(f[1]) for f in found)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def test_structured_words():
    regions = ["ab" * 40 + "a" + "ab" * 40, "abc" * 30 + "ab" + "abc" * 30, ("aab" * 20 + "b") * 4, "a" * 200,
               "ab" * 30 + "b" + "ab" * 30 + "b" + "ab" * 30, ("abaab" * 15 + "ab") * 3]
    cases = [fibonacci(500), [str(bin(i).count("1") % 2) for i in range(500)], *map(list, regions), [], ["x"], ["x"] * 3]
    assert compare(cases) > 100
    compare(cases, 4)


def test_touching_regions_are_needed(monkeypatch):
    words = list("ab" * 40 + "a" + "ab" * 40)
    runs = brute(words)[0]
    assert len(runs) > 10
    monkeypatch.setattr(P, "_across", lambda text, runs: None)
    assert len(P.scan_texts([1], [" ".join(words)])[0][1]) < len(runs)


@pytest.mark.parametrize("seed", range(4))
def test_random_words(seed):
    rng, cases = random.Random(seed), []
    for _ in range(400):
        n, letters = rng.randrange(220), rng.choice([1, 2, 2, 3, 5, 30])
        words = [str(rng.randrange(letters)) for _ in range(n)]
        for _ in range(rng.randrange(5) if n > 4 else 0):
            a, p, length = rng.randrange(n), rng.randrange(1, max(2, n // 3)), rng.randrange(n)
            for i in range(a + p, min(n, a + length)):
                words[i] = words[i - p]
        cases.append(words)
    assert compare(cases) > 300


def test_long_texts():
    rng = random.Random(9)
    words = [str(rng.randrange(3000)) for _ in range(4000)]
    words[500:1500] = (words[500:833] * 4)[:1000]
    words[1490:2500] = ["z"] * 1010
    words[3000:3999] = (words[2000:2017] * 60)[:999]
    assert compare([words]) >= 3
    (n, runs, collapsed), = P.scan_texts([1], ["same words again " * 400_000])
    assert (n, runs, collapsed) == (1_200_000, [(0, 1_200_000, 3)], b"same words again")


def test_collisions_are_noticed(monkeypatch):
    """Hashes of a few bits propose wrong runs; these are found out and sought again."""
    mix, calls = P._mix, []

    def weak(a, b):
        calls.append(1)
        h = mix(a, b)
        return h & np.uint64(15) if len(calls) < 8 else h
    monkeypatch.setattr(P, "_mix", weak)
    rng = random.Random(2)
    compare([[str(rng.randrange(4)) for _ in range(300)] + list("abcdefgh" * 9) for _ in range(5)])


def expected(doc_id, text):
    words = edited(doc_id, split(text))
    runs, kept = brute(words)
    s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), s, length, q, length and 1000 * length // q,
            sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(kept)))


def test_edges(edge, nothing):  # noqa: F811
    for text, r in collect_by_row(edge, P.digest(P.scan(edge, edit=P.planted))):
        if len(split(text)) < 2000:
            assert tuple(r)[1:] == expected(r.doc_id, text)
    assert P.digest(P.scan(nothing)).collect() == []


def test_query(spark):
    texts = {r.doc_id: r.text for r in read_table(spark, SF_SMALL, "documents").collect()}
    got = op12_periodic_runs(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    short = [r for r in got if len(split(texts[r.doc_id])) < 1500]
    assert len(short) > 150
    for r in short:
        assert tuple(r)[1:] == expected(r.doc_id, texts[r.doc_id])
