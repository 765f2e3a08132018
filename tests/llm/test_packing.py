import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from llm_docs import SF_MID, edge, nothing  # noqa: F401

from tallyhouse.llm import packing as P
from tallyhouse.llm.common import read_table


def check(rows, texts, slack):
    """rows: result; texts: {doc_id: [texts]} of unique ids, all others just counted."""
    tok = Tokenizer.from_file(P.default_tokenizer())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, found in texts.items():
        want = []
        for text in found:
            ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
            for k, at in enumerate(range(0, len(ids), 4096)):
                part = np.array(ids[at:at + 4096], dtype="<u4").tobytes()
                want.append((k, at, len(part) // 4, zlib.crc32(part)))
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc_id]) == sorted(want)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // 4096) + slack


def test_whole_table(spark):
    docs = read_table(spark, SF_MID, "documents")
    rows = P.pack_documents(docs).collect()
    check(rows, {r.doc_id: [r.text] for r in docs.collect()}, slack=3)


def test_edges(edge, nothing):
    texts = defaultdict(list)
    for r in edge.collect():
        texts[r.doc_id].append(r.text)
    check(P.pack_documents(edge).collect(), texts, slack=2)
    assert P.pack_documents(nothing).collect() == []


def test_sequences_hold_the_ids(edge):
    found = P.sequences(edge, max_tokens=512).collect()
    tok = Tokenizer.from_file(P.default_tokenizer())
    want = sum(len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in edge.collect())
    assert sum(len(r.ids) for r in found) == want
    assert max(len(r.ids) for r in found) <= 512


def test_each_placement_is_the_best_square_sum():
    rng = np.random.default_rng(3)
    lengths, capacity = rng.integers(1, 20, 120), 20
    bins, offsets = P.sum_of_squares(lengths, capacity)
    fill = defaultdict(int)
    for n, b, at in zip(lengths, bins, offsets):
        gaps = defaultdict(int)
        for f in fill.values():
            gaps[capacity - f] += f < capacity

        def squares(gap):
            after = dict(gaps)
            if gap < capacity:
                after[gap] -= 1
            if gap > n:
                after[gap - n] = after.get(gap - n, 0) + 1
            return sum(v * v for k, v in after.items() if 0 < k < capacity)

        choices = [g for g in gaps if g >= n and gaps[g]] + [capacity]
        taken = capacity - fill[b] if b in fill else capacity
        assert squares(taken) == min(map(squares, choices)) and at == fill[b]
        fill[b] += n


def test_other_tokenizers_take_whole_texts():
    """A file with other rules is never treated by the default one's word rules."""
    import public_tokenizers
    from tokenizers import Tokenizer
    usual, other = P.default_tokenizer(), public_tokenizers.path("byte_bpe_50k.json")
    assert P.by_words(Tokenizer.from_file(usual)) and not P.by_words(Tokenizer.from_file(other))
    t = Tokenizer.from_file(other)
    for text in ["Plain words Here", "two  spaces\nand lines", ""]:
        assert P.token_bytes(text, other) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_remembered_chunks_are_few_and_right_when_full(monkeypatch):
    """One bounded store for chunks and their pre-tokens, as idle workers keep it."""
    from tokenizers import Tokenizer

    from tallyhouse.llm import packing as P
    monkeypatch.setattr(P, "CACHE_WORDS", 6)
    t = Tokenizer.from_file(P.default_tokenizer())
    chunks = P._Chunks(t)
    for text in ["don't stop", "a,b;c", "x1y22", "'s", "''s", "...", "naïve café", "we'll've"] * 2:
        got = b"".join(chunks[c] for c in text.lower().split())
        assert got == b"".join(i.to_bytes(4, "little") for i in t.encode(text, add_special_tokens=False).ids), text
    assert len(chunks) == 6
    assert not any(isinstance(getattr(v, "__self__", v), dict) and len(getattr(v, "__self__", v)) == 6
                   for k, v in vars(chunks).items() if k != "names")     # no second store beside it
