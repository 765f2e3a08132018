"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

``token_pieces`` tokenises whole texts and cuts only documents longer than a
sequence.  ``pack`` places each piece, online, in the open bin for which the
sum over residual gaps g of N(g)^2 becomes smallest, N(g) being the number of
open bins with gap g (a new bin is one of the choices, full bins count
nothing; ties go to the smallest gap left).

Distribution: pieces are dealt to shards by a hash of their content, each
shard is packed on its own (state: one counter per gap), and the bins that a
shard left open are taken apart and packed again in ever fewer, larger-grained
rounds, so what remains open at the end does not grow with the shard count.
All state in a task is bounded by the shard size.

Edge cases: a null text counts as empty (one piece, the end token alone); an
empty table gives no rows; a null doc_id is carried as null; repeated rows are
packed as rows of their own; other columns of the input are ignored, whatever
they are called.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ship_by_value, stored, worker_state

ship_by_value(__name__)

MAX_TOKENS = 4096
END_ID = 1
SHARD_PIECES = 4096      # pieces packed together in one group
CACHE_WORDS = 1 << 17    # per worker, which keeps them while idle; further words are tokenised anew each time


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# Texts made of these characters only are split at white space, and each word
# is tokenised once and remembered: in this range lower-casing, NFC and white
# space are the same for Python and for the tokenizer, which never joins
# tokens over white space.  Every other text goes to the tokenizer whole.
_CHARS = [chr(c) for c in range(0x180)
          if c in (9, 10, 13) or (c >= 32 and not 0x7F <= c <= 0xA0 and c not in (0xAD, 0x130, 0x149))]
_PLAIN = "".join(map(re.escape, _CHARS))
_LETTERS = "".join(c for c in _CHARS if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(c for c in _CHARS if unicodedata.category(c)[0] == "N")
# The settings that make this so; a tokenizer with others gets every text whole.
# fixed values: normalizer, pre-tokenizer and model options of the file
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>"}
# fixed: the pre-tokenizer's pattern, over these characters
_SPLIT = f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+"


def _byte_names() -> dict[int, int]:
    """Byte -> the character by which a byte-level vocabulary writes it:
    printable Latin-1 stands for itself, the others count up from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


class _Chunks(dict):
    """White-space delimited lower-case chunk, or one of its pre-tokens (a chunk
    of itself alone) -> its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model = tokenizer.model
        self.names = _byte_names()
        self.split = re.compile(_SPLIT).findall

    def __missing__(self, chunk):
        words = [chunk] if chunk.isalpha() else self.split(chunk)
        if words == [chunk]:
            named = chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(self.names)
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(named)])
        else:
            ids = b"".join(map(self.__getitem__, words))
        if len(self) < CACHE_WORDS:
            self[chunk] = ids
        return ids


def by_words(tokenizer) -> bool:
    """Whether words of plain texts may be tokenised one by one."""
    told = json.loads(tokenizer.to_str())
    return (told.get("normalizer") == _NORMALIZER and told.get("pre_tokenizer") == _PRE_TOKENIZER
            and all(told["model"].get(k) == v for k, v in _MODEL.items()))


def _tokenizer(path: str):
    state = worker_state()
    if ("tokenizer", path) not in state:
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        plain = re.compile(f"[{_PLAIN}]*").fullmatch if by_words(t) else lambda text: None
        state["tokenizer", path] = (t, _Chunks(t).__getitem__, plain)
    return state["tokenizer", path]


def token_bytes(text: str | None, path: str) -> bytes:
    """Ids of the whole text as little-endian unsigned 32-bit bytes."""
    tokenizer, chunk_ids, plain = _tokenizer(path)
    text = text or ""
    if plain(text) and "<|" not in text:
        return b"".join(map(chunk_ids, text.lower().split()))
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def token_pieces(docs: DataFrame, tokenizer_path: str | None = None, max_tokens: int = MAX_TOKENS,
                 end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 [, ids]."""
    path = tokenizer_path or default_tokenizer()
    end = np.array([end_id], dtype="<u4").tobytes()
    id_type = docs.select("doc_id").schema[0].dataType
    schema = f"doc_id {id_type.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"
    if with_ids:
        schema += ", ids array<int>"

    def cut(batches):
        for batch in batches:
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                raw = token_bytes(text.as_py(), path) + end
                for k, at in enumerate(range(0, len(raw), 4 * max_tokens)):
                    part = raw[at:at + 4 * max_tokens]
                    rows.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def sum_of_squares(lengths, capacity: int = MAX_TOKENS):
    """Bin and offset of each length, placed in the given order."""
    counts = np.zeros(capacity + 1, dtype=np.int64)   # open bins per gap; gap 0 (full) stays 0
    stacks: dict[int, list[int]] = {}
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    opened = 0
    for i, n in enumerate(lengths):
        # sum of squares changes by 2*(N(g-n) - N(g)) + 2 where a bin goes from
        # gap g to g-n; less by 2*N+1 alone where it is filled, 2*N+1 more for a new bin
        gaps = np.flatnonzero(counts[n:]) + n
        best, gap = (2 * counts[capacity - n] + 1 if n < capacity else 0), capacity
        if len(gaps):
            left = counts[gaps - n]
            change = 2 * (left - counts[gaps]) + 2
            if gaps[0] == n:
                change[0] -= 1
            k = int(change.argmin())
            if change[k] <= best:
                best, gap = change[k], int(gaps[k])
        if gap == capacity:
            b, opened = opened, opened + 1
        else:
            b = stacks[gap].pop()
            counts[gap] -= 1
        bins[i], offsets[i] = b, capacity - gap
        rest = gap - n
        if rest:
            counts[rest] += 1
            stacks.setdefault(rest, []).append(b)
    return bins, offsets


def _pack_group(capacity: int, number: int):
    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("length", ascending=False, kind="stable", ignore_index=True)
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        fill = np.bincount(bins, weights=rows["length"].to_numpy()).astype(np.int64)
        rows["sequence_id"] = (number << 60) + (rows["shard"].to_numpy() << 32) + bins
        rows["offset"] = offsets
        rows["gap"] = capacity - fill[bins]
        return rows.drop(columns="shard")
    return place


def pack(pieces: DataFrame, capacity: int = MAX_TOKENS, shard_pieces: int = SHARD_PIECES,
         rounds: int = 4) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the rows of ``pieces`` (column
    ``length`` from 1 to ``capacity``; other columns are carried along).

    Within a shard longer pieces come first.  Sequences that are not full
    after a round are dissolved and packed anew with those of other shards.
    """
    carried = pieces.columns
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    left, done = stored(pieces, "pieces"), None
    for number in range(rounds):
        # reading a stored table numbers its rows alike in every attempt of a task
        shards = max(1, -(-left.count() // shard_pieces))
        dealt = left.withColumn("shard", F.expr(f"pmod(xxhash64(monotonically_increasing_id(), {number}), {shards})"))
        placed = stored(dealt.groupBy("shard").applyInPandas(
            _pack_group(capacity, number), f"{types}, sequence_id bigint, offset bigint, gap bigint"), "packed")
        last = number == rounds - 1
        closed = (placed if last else placed.filter("gap = 0")).drop("gap")
        done = closed if done is None else done.unionByName(closed)
        left = placed.filter("gap > 0").select(*carried)
    return done


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, max_tokens: int = MAX_TOKENS,
                   end_id: int = END_ID) -> DataFrame:
    """Tokenise, cut and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(token_pieces(docs, tokenizer_path, max_tokens, end_id), max_tokens)


def sequences(docs: DataFrame, tokenizer_path: str | None = None, max_tokens: int = MAX_TOKENS,
              end_id: int = END_ID) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array<int>), n_pieces."""
    placed = pack(token_pieces(docs, tokenizer_path, max_tokens, end_id, with_ids=True), max_tokens)
    return placed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"),
        F.count("*").alias("n_pieces"))
