"""Quality by importance resampling of hashed n-gram models.

Words and word pairs are hashed to buckets.  Two generative models are bucket
frequencies: the target model over labelled documents of good quality, the raw
model over all documents.  A document's importance weight is the log of its
probability ratio, target against raw, summed over its n-grams; Gumbel noise
is added and the top k are kept, which draws k documents without replacement
in proportion to their weights.

The raw model counts every document.  The target model is fitted on a bounded
sample of labelled rows (``TARGET_SAMPLE`` documents, drawn by hash).  k is the
share of labelled documents that are good, times the number of documents,
unless given.  The k-th largest key is found by histograms over narrowing
ranges, so no ranked list goes through one task.

Edge cases: a null text counts as empty and has weight 0; repeated rows have
equal noise and are kept or left out together (so ties may exceed k); a null
doc_id is carried and has no label; without labels all weights are 0 and all
rows are kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ship_by_value, stored

ship_by_value(__name__)

BUCKET_BITS = 14
TARGET_SAMPLE = 20_000
SMOOTHING = 1.0
BINS = 4096


def features(text: str | None, bits: int = BUCKET_BITS) -> np.ndarray:
    """Buckets of the words and neighbouring word pairs of a whole text."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    one = np.fromiter(map(crc32, words), dtype=np.uint32, count=len(words))
    two = one[:-1] * np.uint32(0x01000193) + one[1:] + np.uint32(1)
    return (np.concatenate([one, two]) * np.uint32(2654435761)) >> np.uint32(32 - bits)


def _count(bits: int):
    def counts(batches):
        total = np.zeros((2, 1 << bits), dtype=np.int64)
        for batch in batches:
            target = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for chosen in (False, True):
                found = [features(batch.column(0)[int(i)].as_py(), bits) for i in np.flatnonzero(target == chosen)]
                if found:
                    n = np.bincount(np.concatenate(found), minlength=1 << bits)
                    total[0] += n                       # every document is raw text
                    total[1] += n if chosen else 0
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[0][used]), pa.array(total[1][used])],
                                         names=["bucket", "raw", "target"])
    return counts


def log_ratios(docs: DataFrame, labels: DataFrame, sample: int = TARGET_SAMPLE, bits: int = BUCKET_BITS) -> np.ndarray:
    """Log of target over raw probability, per bucket."""
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    n = good.count()
    if not n:
        return np.zeros(1 << bits)
    share = min(1.0, sample / n)
    drawn = good.filter(F.pmod(F.xxhash64("doc_id", F.lit("target")), F.lit(1 << 20)) <= int(share * (1 << 20))) \
        .limit(2 * sample).withColumn("good", F.lit(True))
    # at most twice the sample's ids: broadcast
    marked = docs.select("doc_id", "text").join(F.broadcast(stored(drawn, "targets")), "doc_id", "left").select(
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce("good", F.lit(False)).alias("good"))
    counts = marked.mapInArrow(_count(bits), "bucket int, raw bigint, target bigint") \
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    for r in counts.collect():                         # one row per bucket
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return np.zeros(1 << bits)
    probability = lambda c: (c + SMOOTHING) / (c.sum() + SMOOTHING * len(c))
    return np.log(probability(target)) - np.log(probability(raw))


def weigh(docs: DataFrame, ratios: np.ndarray, seed: str = "gumbel") -> DataFrame:
    """doc_id, n_features, log_weight, score, gumbel_key, tie of each row."""
    bits = int(np.log2(len(ratios)))
    known = docs.sparkSession.sparkContext.broadcast(ratios)
    id_type = docs.select("doc_id").schema[0].dataType.simpleString()

    def rows(batches):
        table = known.value
        for batch in batches:
            n, total = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column(2)):
                found = features(text.as_py(), bits)
                n[i], total[i] = len(found), table[found].sum()
            mean = total / np.maximum(1, n)
            hashed = batch.column(1).to_numpy().view(np.uint64)
            noise = -np.log(-np.log(((hashed >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(total), pa.array(1.0 / (1.0 + np.exp(-mean))),
                 pa.array(total + noise), batch.column(1)],
                names=["doc_id", "n_features", "log_weight", "score", "gumbel_key", "tie"])

    hashed = F.xxhash64("doc_id", "text", F.lit(seed))
    return docs.select("doc_id", hashed.alias("tie"), "text").mapInArrow(
        rows, f"doc_id {id_type}, n_features bigint, log_weight double, score double, gumbel_key double, tie bigint")


def nth_largest(df: DataFrame, column: str, n: int, bins: int = BINS):
    """(the n-th largest value of the column, how many are larger). Each pass
    counts at most ``bins`` ranges and goes on in the one that holds the n-th."""
    low, high, above = *df.agg(F.min(column), F.max(column)).first(), 0
    while low < high:
        width = (float(high) - float(low)) / bins
        place = F.least(F.lit(bins - 1), F.floor((F.col(column).cast("double") - float(low)) / width))
        held = df.filter(F.col(column).between(F.lit(low), F.lit(high))).groupBy(place.alias("bin")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for r in sorted(held, key=lambda r: -r["bin"]):
            if above + r["n"] >= n:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
    return low, above


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, sample: int = TARGET_SAMPLE,
             bits: int = BUCKET_BITS) -> DataFrame:
    """doc_id, n_features, log_weight, score (0 to 1, the mean n-gram's odds),
    gumbel_key, kept (among the k largest keys) of every row."""
    weighed = stored(weigh(docs, log_ratios(docs, labels, sample, bits)), "weights")
    n = weighed.count()
    if k is None:
        good = labels.agg(F.avg((F.col("quality") == 1).cast("int"))).first()[0]
        k = n if good is None else round(good * n)
    kept = F.lit(k > 0)
    if 0 < k < n:
        least, above = nth_largest(weighed, "gumbel_key", k)
        equal = weighed.filter(F.col("gumbel_key") == least)
        last, _ = nth_largest(equal, "tie", k - above)
        kept = (F.col("gumbel_key") > least) | ((F.col("gumbel_key") == least) & (F.col("tie") >= last))
    return weighed.withColumn("kept", kept).drop("tie")
