import hashlib
import random
from collections import Counter

import pytest
from llm_docs import SF_SMALL, edge, make_docs, nothing  # noqa: F401

from tallyhouse.llm import crosstok as C
from tallyhouse.llm.common import read_table
from tallyhouse.llm.queries import op11_cross_tokenizer_alignment


@pytest.fixture(scope="module")
def plain():
    """Whole texts through both tokenizers: (A tokens, B tokens) as (id, bytes)."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    shown = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
    name = {chr(c): c for c in shown}
    for c in range(256):
        if c not in shown:
            name[chr(256 + len(name) - len(shown))] = c

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        one = [(i, bytes(name[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        two = [(i, of_b(i)) for i in b.encode(text)]
        raw = (" " + text).encode()
        if b"".join(t for _, t in one) != raw or b"".join(t for _, t in two) != raw:
            return [], []
        return one, two
    return tokens


def ranges(tokens):
    at, found = 0, []
    for i, t in tokens:
        found.append((i, at, at + len(t)))
        at += len(t)
    return found


def align(tokens):
    a, b = map(ranges, tokens)
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, begin = [], 0
    for cut in cuts:
        groups.append("|".join(",".join(str(i) for i, s, e in side if begin <= s and e <= cut) for side in (a, b)))
        begin = cut
    links, j = [], 0
    for i, s, e in a:
        while j and b[j - 1][2] > s:
            j -= 1
        while j < len(b) and b[j][1] < e:
            if b[j][2] > s:
                links.append((i, b[j][0]))
            j += 1
    return len(a), len(b), groups, links


def expected(texts, plain):
    """Measures of each text, in order; equal texts count as often as they come."""
    found = {t: align(plain(t)) for t in set(texts)}
    counts = Counter(link for t in texts for link in found[t][3])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for t in texts:
        n_a, n_b, groups, links = found[t]
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
        yield (n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
               sum(counts[x] for x in links), sha)


def check(docs, plain, **kw):
    rows = docs.select("doc_id", "text").collect()
    want = Counter((r.doc_id, *m) for r, m in zip(rows, expected([r.text for r in rows], plain)))
    got = C.measures(docs, **kw).collect()
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                   for r in got) == want


STRANGE = ["a  b", " lead", "trail ", "\ttab\tx ", "line\nline \n line", "\r\n", " ", "    ", "▁x y", "x ▁", "é" * 5,
           "<|endoftext|> plain <s> </s> <unk> <0x0A>", "café 　 wide sep", "\U0001f600 a\U0001f600\U0001f600",
           "x\x00y \x1f z", "don't can't 'tis we'll", "1234567890 12 3", "  nbsp  ", "word" * 400, "a b c d",
           "﻿bom ​zero", "日本語 テキスト", "\x85 next \x1c sep"]


def test_chunks_equal_whole_texts(plain):
    aligner = C.Aligner(C.default_a(), C.default_b())
    rng = random.Random(4)
    alphabet = [" ", " ", "  ", "\n", "\t", "a", "B", "the", "ing", "é", "ß", "'s", "1", ".", "—", "▁", " ", "日", "<s>"]
    texts = STRANGE + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40))) for _ in range(1500)]
    for text, found in zip(texts, aligner.align(texts)):
        n_a, n_b, groups, links = align(plain(text))
        assert found[:4] == (n_a, n_b, len(groups), len(links)), repr(text)
        assert found[4].decode() == ";".join(groups)
        assert dict(zip(found[5].tolist(), found[6].tolist())) == Counter(a << 32 | b for a, b in links)


def test_a_chunk_tokenises_the_same_beside_others(plain):
    """White space at a text's end is not tokenised with the next text's."""
    aligner = C.Aligner(C.default_a(), C.default_b())
    chunks = ["trail ", "word", "two  ", "  lead", "tab\t", "plain", " ", "x   ", "end"]
    aligner.learn(chunks)
    for text in chunks:
        n_a, n_b, groups, links = align(plain(text))
        [found] = aligner.align([text])
        assert found[:4] == (n_a, n_b, len(groups), len(links)), repr(text)
        assert found[4].decode() == ";".join(groups)


def test_edges(spark, edge, nothing, plain):  # noqa: F811
    check(edge, plain)
    check(make_docs(spark, [(k, t, "en", "a") for k, t in enumerate(STRANGE * 2)]), plain)
    assert C.measures(nothing).collect() == []


@pytest.mark.parametrize("hot_pairs", [0, 40, 1 << 18])
def test_documents(spark, plain, hot_pairs):
    """The same measures wherever frequent pairs end and rare ones begin."""
    docs = read_table(spark, SF_SMALL, "documents").filter("n_chars < 6000")
    check(docs, plain, hot_pairs=hot_pairs)


def test_groups_are_offered(spark):
    docs = make_docs(spark, [(1, "two words", "en", "a"), (2, "two words", "en", "a"), (3, None, "en", "a")])
    rows = {r.copies: r for r in C.align(C.distinct_texts(docs), with_groups=True).collect()}
    assert hashlib.sha256(rows[2].groups.encode()).hexdigest() == rows[2].groups_sha256
    assert rows[1].groups == "" and rows[1].pairs == []


def test_query_columns(spark):
    df = op11_cross_tokenizer_alignment(spark, SF_SMALL)
    assert dict(df.dtypes) == {c: "bigint" for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best",
                                                     "count_sum")} | {"groups_sha256": "string"}
    assert df.count() == 200
