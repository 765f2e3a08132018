"""Runs of repeated words: maximal periodic stretches of a text's word sequence.

A run is a stretch with smallest period q, at least 2 q words long, that no
neighbouring word extends.  They are found by string synchronising sets, at
scales tau = 2, 4, 8 ...:

* A hash of every stretch of tau words; position i is selected when the least
  hash among those that start in [i, i + tau] stands at i or i + tau.  Whether i
  is selected depends on the 2 tau words from i alone (its context), so equal
  contexts are selected alike.  Stretches of period up to tau / 3 take no part:
  else a short period would select everything.
* A run of period q, 3 tau <= q < 6 tau, has a selected position whose context
  comes again q words on.  Positions of equal context less than 6 tau apart
  propose their distance; two of them are more than tau / 3 apart, so each has
  at most 18 such partners.
* Highly periodic regions are found apart: periods below 6 by direct comparison,
  others as the runs of smaller scales.  They tell which stretches take no part
  above, and they supply what that leaves out: a run whose one period lies
  wholly in one region and the next in another joins two regions of the same
  period and root that touch; each distance that fits the roots is proposed.

A proposal is extended both ways by binary search on hashes of dyadic lengths,
and what is found is compared word by word (on a collision, with other hashes,
again), so results are exact.  Time is O(n log n); nothing is quadratic in a
text or in a period.

Many texts are handled at once: joined, longest first, each followed by a word
of its own that no run can contain.  Memory grows with the larger of
``BATCH_WORDS`` and the longest text.

Edge cases: a null text has no words, like an empty one: no runs, collapsed to
the empty text; a null doc_id is carried (and never edited by ``planted``);
repeated rows stay rows; an empty table gives no rows; other columns are
ignored, whatever they are called.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ship_by_value

ship_by_value(__name__)

MIN_LENGTH = 12
BATCH_WORDS = 1 << 18
DIRECT = 5               # periods found by direct comparison


def _mix(a: np.ndarray, b) -> np.ndarray:
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


class _Joined:
    """Texts joined to one sequence of word numbers, with hashes of dyadic lengths."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray, seed: int):
        self.words = words
        ends = np.cumsum(lengths + 1)
        self.longest = int(lengths[0]) if len(lengths) else 0
        # the texts of n words or more are the first ones; [..] -> where they end
        self.upto = lambda n: int(ends[k - 1]) if (k := int(np.searchsorted(-lengths, -n, "right"))) else 0
        self.hashes = [_mix(words.astype(np.uint64), np.uint64(seed))]
        tau = 1
        while 2 * tau <= self.longest:
            tau *= 2
            below = self.hashes[-1][:self.upto(tau)]
            self.hashes.append(_mix(below[:-(tau // 2)], below[tau // 2:]))

    def common(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words agree from x and y onwards (or before x and y)."""
        x, y, found = x.copy(), y.copy(), np.zeros(len(x), dtype=np.int64)
        for k in range(len(self.hashes) - 1, -1, -1):
            h, step = self.hashes[k], 1 << k
            at, to = (x - step, y - step) if back else (x, y)
            ok = np.flatnonzero((at >= 0) & (to < len(h)))
            ok = ok[h[at[ok]] == h[to[ok]]]
            found[ok] += step
            x[ok] += -step if back else step
            y[ok] += -step if back else step
        return found


def _selected(text: _Joined, k: int, runs: np.ndarray) -> np.ndarray:
    """The synchronising set of scale 2 ** k."""
    tau = 1 << k
    v = text.hashes[k][:text.upto(6 * tau)] >> np.uint64(1)
    top = np.uint64(np.iinfo(np.uint64).max)
    regions = runs[(3 * runs[:, 2] <= tau) & (runs[:, 1] - runs[:, 0] >= tau) & (runs[:, 0] < len(v))]
    if len(regions):
        change = np.zeros(len(v) + 1, dtype=np.int64)
        np.add.at(change, regions[:, 0], 1)
        np.add.at(change, np.minimum(regions[:, 1] - tau + 1, len(v)), -1)
        v = np.where(np.cumsum(change[:-1]) > 0, top, v)
    least, width = v, 1
    while width < tau:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], least[1:])          # over tau + 1 places
    n = len(least)
    return np.flatnonzero((least != top) & ((v[:n] == least) | (v[tau:tau + n] == least)))


def _equal_contexts(text: _Joined, k: int, places: np.ndarray):
    """Pairs of selected places of equal context, 3 tau to 6 tau words apart."""
    tau = 1 << k
    contexts = text.hashes[k + 1]
    places = places[places < len(contexts)]
    order = places[np.argsort(contexts[places], kind="stable")]
    context = contexts[order]
    first, second = [], []
    here, r = np.arange(len(order)), 1
    while len(here):
        here = here[here + r < len(order)]
        gap = order[here + r] - order[here]
        near = (context[here + r] == context[here]) & (gap < 6 * tau)
        fits = here[near & (gap >= 3 * tau)]
        first.append(order[fits])
        second.append(order[fits + r])
        here, r = here[near], r + 1
    return (np.concatenate(first), np.concatenate(second)) if first else (places[:0], places[:0])


def _extended(text: _Joined, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Runs (start, end, period) of the proposals that places x and y make."""
    before, after = text.common(x, y, back=True), text.common(x, y)
    found = np.stack([x - before, y + after, y - x], axis=1)
    return found[before + after >= y - x]


def _direct(words: np.ndarray) -> np.ndarray:
    """Runs of period up to DIRECT that are 4 words or longer."""
    found = []
    for p in range(1, min(DIRECT, len(words) - 1) + 1):
        same = np.flatnonzero(words[p:] == words[:-p])
        if not len(same):
            continue
        cut = np.flatnonzero(np.diff(same) > 1)
        start = same[np.concatenate([[0], cut + 1])]
        end = same[np.concatenate([cut, [len(same) - 1]])] + 1 + p
        long = end - start >= max(4, 2 * p)
        found.append(np.stack([start[long], end[long], np.full(long.sum(), p)], axis=1))
    return _smallest(np.concatenate(found)) if found else np.empty((0, 3), dtype=np.int64)


def _smallest(runs: np.ndarray) -> np.ndarray:
    """One run per stretch, that of the smallest period: a stretch with periods
    p and q of at least 2 q words has gcd(p, q) too, and is as long for each."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), dtype=bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[new]


def _across(text: _Joined, runs: np.ndarray):
    """Proposals from two touching regions of one period and root."""
    regions = runs[runs[:, 1] - runs[:, 0] >= 9 * runs[:, 2]]
    regions = regions[np.lexsort((regions[:, 0], regions[:, 2]))]
    touch = np.flatnonzero((regions[1:, 2] == regions[:-1, 2]) & (regions[1:, 0] <= regions[:-1, 1]))
    first, second = [], []
    for i in touch:
        (s1, e1, p), (s2, e2, _) = regions[i].tolist(), regions[i + 1].tolist()
        k = p.bit_length() - 1
        h, shift = text.hashes[k], p - (1 << k)         # two hashes cover p words
        y = s2 + np.flatnonzero((h[s2:s2 + p] == h[s1]) & (h[s2 + shift:s2 + shift + p] == h[s1 + shift]))
        for root in y[:1].tolist():
            q = np.arange(9 * p + (root - s1 - 9 * p) % p, min(e1 - s1, e2 - s2) + 1, p)
            first.append(e1 - q)
            second.append(np.full(len(q), e1))
    return (np.concatenate(first), np.concatenate(second)) if first else None


def _agrees(words: np.ndarray, runs: np.ndarray) -> bool:
    """Whether every run has its period, word by word."""
    for s, e, q in runs.tolist():
        if not np.array_equal(words[s:e - q], words[s + q:e]):
            return False
    return True


def find_runs(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All runs (start, end, period) of at least 4 words in texts joined to
    ``words``, in falling order of ``lengths``, a unique word after each."""
    seed = 1
    while True:
        text = _Joined(words, lengths, seed)
        runs, k = _direct(words), 1
        while 6 << k <= text.longest:
            x, y = _equal_contexts(text, k, _selected(text, k, runs))
            if len(x):
                runs = _smallest(np.concatenate([runs, np.unique(_extended(text, x, y), axis=0)]))
            k += 1
        across = _across(text, runs)
        if across:
            runs = _smallest(np.concatenate([runs, _extended(text, *across)]))
        if _agrees(words, runs):
            return runs
        seed += 1


def planted(doc_id, n: int) -> tuple[int, int] | None:
    """(a, p) where the n words of a document are to go on with period p from
    word a on; None where they stay (nine of ten, by the id's CRC)."""
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def scan_texts(ids: list, texts: list, min_length: int = MIN_LENGTH, edit=None):
    """Per text: number of words, its runs (start, length, period) by start and
    period, and the text without repetitions: the words that no run contains
    after its first period, joined by blanks."""
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    words, coded = [], []
    for doc_id, text in zip(ids, texts):
        found = (text or "").encode("utf-8", "surrogatepass").split()   # at the six ASCII white spaces
        code = np.fromiter((number(w, len(numbers)) for w in found), np.int64, len(found))
        change = edit(doc_id, len(found)) if edit else None
        if change:
            a, p = change
            place = np.arange(len(found))
            place[a:] = a + (place[a:] - a) % p
            code, found = code[place], [found[j] for j in place.tolist()]
        words.append(found)
        coded.append(code)
    lengths = np.array([len(c) for c in coded], dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    pieces = [part for k in order.tolist() for part in (coded[k], np.array([len(numbers) + k]))]
    joined = np.concatenate(pieces) if pieces else np.empty(0, dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths[order] + 1)])
    runs = find_runs(joined, lengths[order])
    runs = runs[runs[:, 1] - runs[:, 0] >= np.maximum(min_length, 2 * runs[:, 2])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    change = np.zeros(len(joined) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    dropped = np.cumsum(change)[:-1] > 0
    runs_at = np.searchsorted(runs[:, 0], begins)
    result = [None] * len(words)
    for place, k in enumerate(order.tolist()):
        begin, mine = int(begins[place]), runs[runs_at[place]:runs_at[place + 1]]
        kept = words[k]
        if len(mine):
            kept = [kept[j] for j in np.flatnonzero(~dropped[begin:begin + len(kept)]).tolist()]
        result[k] = (len(words[k]), [(s - begin, e - s, q) for s, e, q in mine.tolist()], b" ".join(kept))
    return result


def scan(docs: DataFrame, min_length: int = MIN_LENGTH, edit=None) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period; words counted from
    0; by start, then period), collapsed (the text without repetitions).

    ``edit(doc_id, n_words)``: where given, changes texts first (``planted``).
    """
    id_type = docs.select("doc_id").schema[0].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def rows(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            begin = held = 0
            for i in range(len(texts)):
                held += len(texts[i].as_py() or "") // 4
                if held >= BATCH_WORDS or i == len(texts) - 1:
                    part = slice(begin, i + 1)
                    found = scan_texts(ids[part].to_pylist(), texts[part].to_pylist(), min_length, edit)
                    yield pa.RecordBatch.from_arrays(
                        [ids[part], pa.array([f[0] for f in found], pa.int64()),
                         pa.array([[dict(zip(run.names, r)) for r in f[1]] for f in found], pa.list_(run)),
                         pa.array([f[2].decode("utf-8", "surrogatepass") for f in found], pa.string())],
                        names=["doc_id", "n_words", "runs", "collapsed"])
                    begin, held = i + 1, 0

    return docs.select("doc_id", "text").mapInArrow(
        rows, f"doc_id {id_type}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
              "collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and SHA-256 of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("longest.before")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.shorter")).alias("period"),
        F.expr("(1000 * longest.length) div -longest.shorter").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
