"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is lower-cased and reduced to words of letters; the subwords of two to
four bytes of each word, its borders included, are hashed to rows of an
embedding table.  The mean of the rows goes through a linear layer and a
softmax.  Both are trained by stochastic gradient descent in numpy, on pieces
of a bounded sample of labelled documents.  A temperature, fitted on documents
kept out of the training, makes the probabilities honest.  Two bounds, each at
the ``FALSE_REJECTS`` quantile of good texts, reject texts in none of the
languages: one on the probability, from the kept-out texts and pieces of them,
one on the share of a text's subwords that the training has seen, from each
trained text against the others (the mean share counts for ``PRIOR`` subwords
more, so that a short text is not judged by one of them).  Below the second
bound the score is 0.

Prediction needs no embedding rows: rows times layer give a table of scores
per hash, so a text costs one look-up per subword.  Scoring covers whole
texts; the sample alone is bounded: ``SAMPLE`` documents, spread evenly over
the languages, and of a document longer than ``SAMPLE_CHARS`` so many
characters, in ``STRETCHES`` stretches spread evenly from its start to its end.

Edge cases: a null text, or one without a letter, is predicted ``und`` with
score 0 and is rejected; without labelled rows all texts with letters get
``und`` too; repeated rows stay rows; a null doc_id is carried and never
trained on; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ship_by_value

ship_by_value(__name__)

BUCKET_BITS = 15
DIMENSIONS = 16
SAMPLE = 2000            # labelled documents that training may use
SAMPLE_CHARS = 20_000    # characters that training may use of a document
STRETCHES = 10           # that a longer document gives
PIECE = 240              # characters of a training piece, about
EPOCHS = 2
RATE = 0.5
FALSE_REJECTS = 0.001    # share of good texts below each bound
PRIOR = 50               # subwords that the mean share of seen ones counts for
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
_ASCII_LETTER = re.compile("[a-z]").search


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray        # per language, the score of each subword hash
    bias: np.ndarray
    temperature: float
    threshold: float         # calibrated probability below which a text is rejected
    seen: np.ndarray         # per subword hash, whether the training has seen it
    usual: float = 1.0       # mean share of seen subwords
    familiar: float = 0.0    # share of them below which a text is rejected


def letters(text: str | None) -> bytes:
    """Words of letters, lower-cased, one blank around each; empty without letters."""
    words = _OTHER.sub(" ", (text or "").lower()).strip(" ")
    if not _ASCII_LETTER(words) and not any(map(str.isalpha, words)):
        return b""                      # numerals such as a raised two are no letters
    return f" {words} ".encode("utf-8", "surrogatepass")


def subwords(line: bytes, bits: int = BUCKET_BITS) -> np.ndarray:
    """Hashes of all runs of two to four bytes with no blank inside."""
    b = np.frombuffer(line, dtype=np.uint8).astype(np.uint32)
    inner = b != 32
    found = []
    code = b
    for n in (2, 3, 4):
        if len(b) < n:
            break
        code = code[:len(b) - n + 1] * np.uint32(257) + b[n - 1:] + np.uint32(1)
        slot = (code * np.uint32(2654435761)) >> np.uint32(32 - bits)
        if n > 2:                       # blanks may stand at the ends only
            whole = inner[1:len(b) - 1] if n == 3 else inner[1:len(b) - 2] & inner[2:len(b) - 1]
            slot = slot[whole]
        found.append(slot)
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)


def train(texts: list[str], langs: list[str], bits: int = BUCKET_BITS, dimensions: int = DIMENSIONS,
          epochs: int = EPOCHS, rate: float = RATE, false_rejects: float = FALSE_REJECTS, seed: int = 7) -> Model:
    """Fit on whole texts, cut into pieces of about PIECE characters; every
    tenth text is kept out for the temperature and the threshold."""
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    number = {name: k for k, name in enumerate(names)}
    pieces, truth, kept_out, whole = [], [], [], []
    for at, (text, lang) in enumerate(zip(texts, langs)):
        if at % 10 == 9:
            kept_out.append((text, number[lang]))
            continue
        line = letters(text)
        words = line.split()
        if words:
            whole.append(subwords(line, bits))
        size = 0
        start = 0
        for k, w in enumerate(words):
            size += len(w) + 1
            if size >= PIECE or k == len(words) - 1:
                pieces.append(subwords(b" " + b" ".join(words[start:k + 1]) + b" ", bits))
                truth.append(number[lang])
                start, size = k + 1, 0
    # embeddings start at zero: what was never seen says nothing
    rows = np.zeros((1 << bits, dimensions), dtype=np.float32)
    layer = rng.normal(0, 1, (dimensions, len(names))).astype(np.float32)
    bias = np.zeros(len(names), dtype=np.float32)
    weight = len(truth) / (len(names) * np.maximum(1, np.bincount(truth, minlength=len(names))))  # languages count alike
    steps, step = max(1, epochs * len(pieces)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(pieces)):
            eta = rate * (1 - step / steps) * min(2.0, weight[truth[k]])
            step += 1
            ids = pieces[k]
            if not len(ids):
                continue
            mean = rows[ids].mean(axis=0)
            score = mean @ layer + bias
            p = np.exp(score - score.max())
            p /= p.sum()
            p[truth[k]] -= 1.0
            back = layer @ p
            layer -= eta * np.outer(mean, p)
            bias -= 0.1 * eta * p
            np.subtract.at(rows, ids, (eta / len(ids) * back).astype(np.float32))
    # one contiguous column of scores per language
    holders = np.zeros(1 << bits, dtype=np.int64)        # trained texts that have the hash
    for ids in whole:
        holders[np.unique(ids)] += 1
    model = Model(names, np.ascontiguousarray((rows @ layer).T), bias, 1.0, 0.0, holders > 0)
    # the kept-out texts whole, and up to four long and four short pieces from all over each
    cut = [(t[at:at + size], y) for t, y in kept_out for size in (PIECE, PIECE // 8)
           for at in np.linspace(0, max(0, len(t) - size), min(4, -(-len(t) // size)), dtype=int)]
    known = [(subwords(letters(t), bits), y) for t, y in kept_out + cut if letters(t)]
    scored = [(raw_scores(ids, model), y) for ids, y in known]
    if scored:
        s, y = np.array([x for x, _ in scored]), np.array([x for _, x in scored])
        loss = []
        grid = np.geomspace(0.25, 8, 40)
        for t in grid:
            z = s / t
            z -= z.max(axis=1, keepdims=True)
            z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
            # as if one text more had each language alike: never surer than so many texts can show
            loss.append(-(z[np.arange(len(y)), y].sum() + z.mean()))
        model.temperature = float(grid[int(np.argmin(loss))])
        good = s[s.argmax(axis=1) == y]
        if len(good):                   # on the scale of log odds, where the tail is even
            odds = low_quantile(np.array([log_odds(x, model) for x in good]), false_rejects)
            # never below a half: some language must be likelier than all others together
            model.threshold = max(0.5, float(1 / (1 + np.exp(-odds))))
    # each trained text against the others: a hash in one text only is new there
    sizes = np.array([len(ids) for ids in whole])
    if sizes.sum():
        fresh = np.array([np.count_nonzero(holders[ids] < 2) for ids in whole])
        model.usual = float(1 - fresh.sum() / sizes.sum())
        model.familiar = low_quantile((sizes - fresh + PRIOR * model.usual) / (sizes + PRIOR), false_rejects)
    return model


def raw_scores(ids: np.ndarray, model: Model) -> np.ndarray:
    if not len(ids):
        return model.bias.astype(np.float64)
    return np.array([column[ids].sum() for column in model.table]) / len(ids) + model.bias


def low_quantile(values: np.ndarray, share: float) -> float:
    """The quantile at ``share``, or below it where few values leave it open:
    that of an exponential tail below the lowest tenth."""
    start = np.quantile(values, 0.1)
    slope = (start - values[values <= start]).mean()
    return float(min(np.quantile(values, share), start + slope * np.log(min(1.0, 10 * share))))


def familiarity(ids: np.ndarray, model: Model) -> float:
    """Share of subwords that the training has seen, PRIOR usual ones added."""
    return float((np.count_nonzero(model.seen[ids]) + PRIOR * model.usual) / (len(ids) + PRIOR))


def probabilities(scores: np.ndarray, model: Model) -> np.ndarray:
    z = scores / model.temperature
    p = np.exp(z - z.max())
    return p / p.sum()


def log_odds(scores: np.ndarray, model: Model) -> float:
    """Log odds of the likeliest language against all others."""
    z = np.sort(scores / model.temperature)[::-1]
    return float(-np.log(np.exp(z[1:] - z[0]).sum())) if len(z) > 1 else 0.0


def predict_text(text: str | None, model: Model) -> tuple[str, float]:
    """(language, calibrated probability; 0 if too few subwords are known)."""
    line = letters(text)
    if not line or not model.languages:
        return UNKNOWN, 0.0
    bits = model.table.shape[1].bit_length() - 1
    ids = subwords(line, bits)
    p = probabilities(raw_scores(ids, model), model)
    return model.languages[int(p.argmax())], float(p.max()) if familiarity(ids, model) >= model.familiar else 0.0


def held_out(doc_id):
    """The fourth of the documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Train on a sample of rows with a language that are not held out."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                         & ~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    per = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not per:
        return Model([], np.zeros((0, 2), np.float32), np.zeros(0, np.float32), 1.0, 0.0, np.zeros(2, bool))
    share = sample / len(per)
    # a document is drawn if its hash falls below its language's share
    draw = F.lit(0.0)
    for lang, n in per.items():
        draw = F.when(F.col("lang") == lang, F.lit(min(1.0, share / n))).otherwise(draw)
    place = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    n, size = F.length("text"), sample_chars // STRETCHES
    begins = [((n - size) * k / (STRETCHES - 1)).cast("int") + 1 for k in range(STRETCHES)]
    spread = F.concat_ws("\n", *(F.substring("text", at, F.lit(size)) for at in begins))
    rows = usable.filter(place < draw).limit(2 * sample).select(
        "doc_id", "lang", F.when(n <= sample_chars, F.col("text")).otherwise(spread).alias("text")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


def _broadcast(docs: DataFrame, model: Model):
    """The model's plain values: executors read them without this package."""
    return docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))


def predict(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """``carry`` (doc_id), lang_pred, score, rejected of every row."""
    carry = carry or ["doc_id"]
    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    known = _broadcast(docs, model)

    def rows(batches):
        m = Model(*known.value)
        for batch in batches:
            found = [predict_text(t.as_py(), m) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[1] < m.threshold or f[0] == UNKNOWN for f in found], pa.bool_())],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "rejected"])

    return docs.select(*carry, F.col("text").alias("_scored")).mapInArrow(
        rows, f"{types}, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text is in a known language."""
    known = _broadcast(docs, model)
    at = docs.columns.index("text")

    def rows(batches):
        m = Model(*known.value)
        for batch in batches:
            found = (predict_text(t.as_py(), m) for t in batch.column(at))
            yield batch.filter(pa.array([lang != UNKNOWN and p >= m.threshold for lang, p in found], pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
