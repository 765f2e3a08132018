"""Alignment of two tokenizers over a corpus, each distinct text once.

A text, with a space before it, is tokenised by A (byte-level BPE, Hugging Face
file) and by B (SentencePiece BPE with byte fallback).  Byte offsets where
tokens of both end cut them into groups; an A and a B token whose byte ranges
overlap are linked.  How often an id pair is linked in the whole corpus weighs
each text's links.

1. Texts are shuffled whole, and equal ones become one row with their number.
2. Each distinct text is tokenised and aligned once; its distinct pairs and
   their numbers are stored with it.
3. Pair counts are summed, weighted by the number of equal texts, with partial
   sums before the shuffle.
4. The most frequent pairs, at most ``HOT_PAIRS``, are broadcast and looked up
   where the texts lie; links of all other pairs are shuffled to their counts.
5. Measures are joined to the documents by the SHA-256 of the text; texts of
   very many documents are broadcast (``common.join_copies``).

A chunk is what stands between single spaces with other characters on both
sides.  Neither tokenizer joins or splits over the beginning of such a space (A
starts a pre-token there; no piece of B holds a space mark after another
character; both are checked when the files are read, else texts stay whole), so
both cut there, and a chunk's tokens are remembered by the worker.  Alignment is
then one merge of both tokenizers' byte offsets, for many texts at once.

Edge cases: texts that are null, empty, or not given back by the joined bytes of
A's or B's tokens (those that hold U+2581, say) have no tokens: zeros and empty
groups; special tokens' strings are plain text; repeated rows and null doc_ids
are rows of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import join_copies, ship_by_value, stored, text_key, worker_state

ship_by_value(__name__)

HOT_PAIRS = 1 << 18
CACHE_CHUNKS = 400_000   # per worker; when full, it starts anew
BATCH_CHARS = 1 << 21    # texts aligned together; memory grows with the longest text
MEASURES = ["n_a", "n_b", "n_groups", "n_links"]


def default_a() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def default_b() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _bytes_of_names() -> dict[str, int]:
    """A byte-level vocabulary's character -> the byte it stands for: printable
    Latin-1 for itself, the other bytes in order for the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Both tokenizers, and the tokens of the chunks seen so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # one core per task
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of, vocabulary = _bytes_of_names(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for name, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte_of.get(c, 0) for c in name)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_lengths = np.array([len(t) for t in self.a_bytes])
        self.b_lengths = np.array([len(t) for t in self.b_bytes])
        before = json.loads(self.a.to_str()).get("pre_tokenizer") or {}
        self.chunked = bool(before.get("type") == "ByteLevel" and before.get("use_regex")
                            and not any("▁" in p.lstrip("▁") for p in pieces))
        self.uneven = re.compile(r"\s(?: |\Z)|\A\s| \s").search
        self.split = re.compile(r"(?<=\S) (?=\S)").split
        self.of_a: dict[str, bytes | None] = {}     # chunk -> ids, little-endian; None: bytes differ
        self.of_b: dict[str, bytes | None] = {}
        # an id as written in a group, with what follows it
        self.written = [f"{i}{mark}".encode() for i in range(max(len(self.a_bytes), len(pieces))) for mark in ",|;"]

    def parts(self, text: str) -> list[str]:
        """Chunks of the text, each without the space before it."""
        if not self.chunked:
            return [text]
        return self.split(text) if self.uneven(text) else text.split(" ")

    def encode(self, text: str):
        """Ids of space + text by both, and whether both give back its bytes."""
        raw = f" {text}".encode("utf-8", "surrogatepass")
        a, b = self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text)
        same = b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))
        return np.array(a, "<u4"), np.array(b, "<u4"), same

    def learn_alone(self, part: str) -> None:
        a, b, same = self.encode(part)
        self.of_a[part], self.of_b[part] = (a.tobytes(), b.tobytes()) if same else (None, None)

    def learn(self, parts: set[str]) -> None:
        """Tokenise the chunks that are new, many in one go.  Those that begin or
        end a text with white space would join the next one's space: one by one."""
        if len(self.of_a) > CACHE_CHUNKS:
            self.of_a, self.of_b = {}, {}
        new, joined = [p for p in parts if p not in self.of_a], []
        for p in new:
            if self.chunked and not p[0].isspace() and not p[-1].isspace():
                joined.append(p)
            else:
                self.learn_alone(p)
        for at in range(0, len(joined), 128):
            block = joined[at:at + 128]
            a, b, same = self.encode(" ".join(block))
            if not same:
                for p in block:
                    self.learn_alone(p)
                continue
            ends = np.cumsum([1 + len(p.encode("utf-8", "surrogatepass")) for p in block])
            for ids, lengths, known in ((a, self.a_lengths, self.of_a), (b, self.b_lengths, self.of_b)):
                cuts = [0, *(4 * (np.searchsorted(np.cumsum(lengths[ids]), ends) + 1)).tolist()]
                raw = ids.tobytes()
                for p, lo, hi in zip(block, cuts, cuts[1:]):
                    known[p] = raw[lo:hi]

    def align(self, texts: list[str]) -> list[tuple]:
        """Per text: tokens of A, of B, groups, links, the groups written out,
        its distinct pairs (a << 32 | b) and how often each is linked."""
        parts = [self.parts(t) if t else [] for t in texts]
        self.learn({p for found in parts for p in found})
        raw_a, raw_b = [], []
        for found in parts:
            ids = list(map(self.of_a.__getitem__, found))
            whole = None not in ids
            raw_a.append(b"".join(ids) if whole else b"")
            raw_b.append(b"".join(map(self.of_b.__getitem__, found)) if whole else b"")
        n_a, n_b = (np.array([len(r) // 4 for r in raw], np.int64) for raw in (raw_a, raw_b))
        a, b = (np.frombuffer(b"".join(raw), "<u4").astype(np.int64) for raw in (raw_a, raw_b))
        # one long sequence of bytes; True where a token's last byte is
        end_a, end_b = np.cumsum(self.a_lengths[a]) - 1, np.cumsum(self.b_lengths[b]) - 1
        size = int(end_a[-1]) + 1 if len(a) else 0
        last_a, last_b = np.zeros(size, bool), np.zeros(size, bool)
        last_a[end_a], last_b[end_b] = True, True
        before_a, before_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        links = np.flatnonzero(last_a | last_b)        # stretches between ends: one pair each
        both = last_a & last_b
        ends = np.flatnonzero(both)                    # groups
        group = np.cumsum(both) - both
        pairs = a[before_a[links]] << 32 | b[before_b[links]]
        # place of each token in the written groups: after the tokens of earlier groups, A's before B's
        upto_a, upto_b = before_a[ends] + 1, before_b[ends] + 1
        marks = np.empty(len(a) + len(b), np.int64)
        marks[np.arange(len(a)) + np.concatenate([[0], upto_b])[group[end_a]]] = 3 * a + both[end_a]
        marks[np.arange(len(b)) + upto_a[group[end_b]]] = 3 * b + 2 * both[end_b]
        written = list(map(self.written.__getitem__, marks.tolist()))
        stop_a = np.concatenate([[0], np.cumsum(n_a)])
        at_byte = np.concatenate([[0], end_a + 1])[stop_a]
        at_link, at_group = np.searchsorted(links, at_byte).tolist(), np.searchsorted(ends, at_byte).tolist()
        at_mark = (stop_a + np.concatenate([[0], np.cumsum(n_b)])).tolist()
        result = []
        for t in range(len(texts)):
            distinct, times = np.unique(pairs[at_link[t]:at_link[t + 1]], return_counts=True)
            result.append((int(n_a[t]), int(n_b[t]), at_group[t + 1] - at_group[t], at_link[t + 1] - at_link[t],
                           b"".join(written[at_mark[t]:at_mark[t + 1]])[:-1], distinct, times))
        return result


def _aligner(a_path: str, b_path: str) -> Aligner:
    state = worker_state()
    if ("aligner", a_path, b_path) not in state:
        state["aligner", a_path, b_path] = Aligner(a_path, b_path)
    return state["aligner", a_path, b_path]


def distinct_texts(docs: DataFrame) -> DataFrame:
    """text (null counts as empty), copies: how many documents have it."""
    return docs.select(F.coalesce("text", F.lit("")).alias("text")).groupBy("text").agg(
        F.count("*").alias("copies"))


def align(texts: DataFrame, a_path: str | None = None, b_path: str | None = None,
          with_groups: bool = False) -> DataFrame:
    """For each row of ``texts`` (text, copies): key, copies, n_a, n_b, n_groups,
    n_links, groups_sha256, pairs (a << 32 | b, distinct), times [, groups]."""
    a_path, b_path = a_path or default_a(), b_path or default_b()
    fields = [("copies", pa.int64()), *((m, pa.int64()) for m in MEASURES), ("groups_sha256", pa.string()),
              ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
    if with_groups:
        fields.append(("groups", pa.string()))
    types = {pa.int64(): "bigint", pa.string(): "string", pa.list_(pa.int64()): "array<bigint>"}

    def lists(arrays):
        ends = np.cumsum([0, *map(len, arrays)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays), pa.int64()))

    def rows(batches):
        aligner = _aligner(a_path, b_path)
        for batch in batches:
            texts, begin, held = batch.column("text").to_pylist(), 0, 0
            for i, t in enumerate(texts):
                held += len(t)
                if held < BATCH_CHARS and i < len(texts) - 1:
                    continue
                part = batch.slice(begin, i + 1 - begin)
                found = list(zip(*aligner.align(texts[begin:i + 1])))
                sha = [hashlib.sha256(g).hexdigest() if g else "" for g in found[4]]
                columns = [part.column("key"), part.column("copies"), *(pa.array(c, pa.int64()) for c in found[:4]),
                           pa.array(sha, pa.string()), lists(found[5]), lists(found[6])]
                if with_groups:
                    columns.append(pa.array([g.decode() for g in found[4]], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["key", *(n for n, _ in fields)])
                begin, held = i + 1, 0

    return texts.select(text_key().alias("key"), "text", "copies").mapInArrow(
        rows, "key binary, " + ", ".join(f"{n} {types[t]}" for n, t in fields))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair (a << 32 | b), links (in the whole corpus), best (whether no pair of
    the same B id has more)."""
    each = aligned.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    pairs = stored(each.groupBy(F.col("p.pairs").alias("pair")).agg(
        F.sum(F.col("copies") * F.col("p.times")).alias("links")), "crosstok-pairs")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = pairs.groupBy(b_id.alias("b")).agg(F.max("links").alias("most"))     # at most B's vocabulary
    return stored(pairs.join(F.broadcast(most), b_id == F.col("b")).select(
        "pair", "links", (F.col("links") == F.col("most")).alias("best")), "crosstok-counts")


def _hot_limit(counts: DataFrame, most_pairs: int) -> int:
    """The lowest power of two such that at most ``most_pairs`` pairs have that
    many links or more."""
    size = F.floor(F.log2("links")).cast("int")
    taken, limit = 0, 1 << 62
    for c, n in sorted(map(tuple, counts.groupBy(size).count().collect()), reverse=True):   # at most 63 rows
        taken += n
        if taken > most_pairs:
            break
        limit = 1 << c
    return limit


def weigh(aligned: DataFrame, counts: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``aligned`` without its pairs, with n_best and count_sum."""
    limit = _hot_limit(counts, hot_pairs)
    hot = counts.filter(F.col("links") >= limit).orderBy("pair").toPandas()     # at most hot_pairs rows
    table = aligned.sparkSession.sparkContext.broadcast(
        (hot["pair"].to_numpy(np.int64), hot["links"].to_numpy(np.int64), hot["best"].to_numpy(bool)))
    kept = ["key", "copies", *MEASURES, "groups_sha256"]

    def rows(batches):
        keys, links, best = table.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            found, number = pairs.flatten().to_numpy(), np.diff(pairs.offsets.to_numpy())
            text = np.repeat(np.arange(len(batch)), number)
            at = np.minimum(np.searchsorted(keys, found), max(0, len(keys) - 1))
            known = keys[at] == found if len(keys) else np.zeros(len(found), dtype=bool)
            n_best, count_sum = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(n_best, text[known], times[known] * best[at[known]])
            np.add.at(count_sum, text[known], times[known] * links[at[known]])
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(text[~known], minlength=len(batch)))]), pa.int32())
            rest = [pa.ListArray.from_arrays(ends, pa.array(v[~known], pa.int64())) for v in (found, times)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(n_best), pa.array(count_sum), *rest],
                names=[*kept, "n_best", "count_sum", "pairs", "times"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.select(kept).schema)
    near = stored(aligned.select(*kept, "pairs", "times").mapInArrow(
        rows, f"{types}, n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>"), "crosstok-near")
    # links of rarer pairs go to their counts
    rare = near.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "key", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    more = rare.join(counts.filter(F.col("links") < limit), "pair").groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("links")).alias("more_sum"))
    return near.join(more, "key", "left").select(
        *kept, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))


def measures(docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
             hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = stored(docs.select("doc_id", text_key().alias("key")), "crosstok-rows")
    aligned = stored(align(distinct_texts(docs), a_path, b_path), "crosstok-aligned")
    weighed = stored(weigh(aligned, pair_counts(aligned), hot_pairs), "crosstok-weighed")
    return join_copies(rows, weighed, rows.count()).select(
        "doc_id", *MEASURES, "n_best", "count_sum", "groups_sha256")
