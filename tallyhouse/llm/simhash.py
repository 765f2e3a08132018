"""SimHash near-duplicates by pigeonring filtering.

A fingerprint has 64 bits, cut into a ring of ``max_bits + 1`` segments.  If
two fingerprints differ in at most t bits, some segment starts a chain along
the ring whose first k segments together differ in at most k*t/(t+1) bits, for
every k.  With m = t + 1 segments: the first is equal and the first two differ
in at most one bit.  So each fingerprint is filed once per ring position under
its two segments there, and looked up under these and their one-bit changes of
the second (about 26 bits of selectivity at t = 4).  What meets is checked
against the whole chain of budgets and then by the full Hamming distance.

Only distinct fingerprints meet.  A lookup key shared by many fingerprints is
split into blocks of bounded size, and a key's links are reduced on the spot
to those that join something new, so dense groups emit a number of links in
proportion to their members and keep every connection.

Edge cases: a null or empty text has fingerprint zero and links like any
other; fewer words than a shingle give one shingle of all words; repeated rows
stay rows; a null doc_id gets its group's smallest id (null if it has none);
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import join_copies, ship_by_value, stored
from tallyhouse.llm.components import connected_components

ship_by_value(__name__)

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCK = 8192       # filed fingerprints compared at once under one key
CHUNK = 1 << 20    # fingerprint pairs compared at once


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit set where it is set in over half of the shingles' XXH64 values."""
    from itertools import repeat

    from xxhash import xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # ASCII case and white space
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), dtype="<u8", count=len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at:at + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (its 64 bits as a signed long) of each row."""
    id_type = docs.select("doc_id").schema[0].dataType.simpleString()

    def prints(batches):
        for batch in batches:
            values = np.fromiter((text_fingerprint(t.as_py(), shingle) for t in batch.column(1)),
                                 dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))],
                                             names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(prints, f"doc_id {id_type}, fingerprint bigint")


def ring(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment; three segments at least."""
    m = max(max_bits + 1, 3)
    edges = [64 * k // m for k in range(m + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def _ring_keys(max_bits: int):
    """Columns: array of filing keys, array of lookup keys of ``fingerprint``.

    A key is the ring position (from bit 58), the first segment (from bit 29)
    and the second.
    """
    segments = ring(max_bits)
    value = lambda s: f"(shiftrightunsigned(fingerprint, {s[0]}) & {(1 << s[1]) - 1}L)"
    own, probes = [], []
    for k, first in enumerate(segments):
        second = segments[(k + 1) % len(segments)]
        key = f"({k << 58}L | shiftleft({value(first)}, 29) | {value(second)})"
        own.append(key)
        probes += [key] + [f"({key} ^ {1 << b}L)" for b in range(second[1])]
    return F.expr(f"array({', '.join(own)})"), F.expr(f"array({', '.join(probes)})")


def _linker(max_bits: int):
    segments = ring(max_bits)
    m = len(segments)
    masks = np.array([((1 << w) - 1) << lo for lo, w in segments], dtype=np.uint64)

    def near(a, b, first):
        """Which pairs pass the chain of budgets from segment ``first`` and the Hamming check."""
        differ = a ^ b
        spent, ok = 0, np.ones(len(differ), dtype=bool)
        for step in range(m):
            spent = spent + np.bitwise_count(differ & masks[(first + step) % m]).astype(np.int64)
            ok &= spent * m <= (step + 1) * max_bits
        return ok & (np.bitwise_count(differ) <= max_bits) & (differ != 0)

    return near


def _groups(runs, at, filed, looked):
    """(runs, first lookup of each, lookups of each) to compare at once: small
    runs together, up to CHUNK pairs; a run of more is alone, cut by its
    lookups, one at least."""
    work = filed * looked
    small = np.flatnonzero(work <= CHUNK)
    total = np.cumsum(work[small])
    done = 0
    while done < len(small):
        upto = int(np.searchsorted(total, CHUNK + (total[done - 1] if done else 0), side="right"))
        take = small[done:upto]
        yield runs[take], at[take], looked[take]
        done = upto
    for k in np.flatnonzero(work > CHUNK):
        step = max(1, CHUNK // int(filed[k]))
        for start in range(0, int(looked[k]), step):
            yield runs[[k]], at[[k]] + start, np.array([min(step, int(looked[k]) - start)])


def _links(max_bits: int):
    """Links within runs of equal (key, block), filed fingerprints before looked-up ones."""
    near = _linker(max_bits)

    def reduced(a, b):
        """Of links a-b those that join something new (smallest-label sweeps)."""
        ends, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = inverse[:len(a)], inverse[len(a):]
        label = np.arange(len(ends))
        while True:
            low = label.copy()
            np.minimum.at(low, x, label[y])
            np.minimum.at(low, y, label[x])
            low = low[low]
            if (low == label).all():
                break
            label = low
        moved = label != np.arange(len(ends))
        return ends[moved], ends[label[moved]]

    def link(batches):
        held = None                              # filed fingerprints of the run that the last batch ended in
        for batch in batches:
            key = batch.column(0).to_numpy()
            block = batch.column(1).to_numpy()
            probe = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            prints = batch.column(3).to_numpy().view(np.uint64)
            if held is not None and len(held[2]):
                n = len(held[2])
                key = np.concatenate([np.full(n, held[0]), key])
                block = np.concatenate([np.full(n, held[1]), block])
                probe = np.concatenate([np.zeros(n, dtype=bool), probe])
                prints = np.concatenate([held[2], prints])
            if not len(key):
                continue
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (block[1:] != block[:-1])]))
            ends = np.append(new[1:], len(key))
            filed = np.add.reduceat((~probe).astype(np.int64), new)
            looked = (ends - new) - filed
            held = (key[new[-1]], block[new[-1]], prints[new[-1]:new[-1] + filed[-1]])
            runs = np.flatnonzero((filed > 0) & (looked > 0))
            found_a, found_b = [], []
            first = key[new] >> 58                       # ring position
            for mine, at, count in _groups(runs, new[runs] + filed[runs], filed[runs], looked[runs]):
                f = filed[mine]
                size = f * count
                run = np.repeat(np.arange(len(mine)), size)
                inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                a = prints[new[mine][run] + inner % f[run]]
                b = prints[at[run] + inner // f[run]]
                ok = near(a, b, first[mine][run])
                found_a.append(a[ok])
                found_b.append(b[ok])
                if sum(map(len, found_a)) > CHUNK:       # links of a dense run are reduced as they come
                    a, b = reduced(np.concatenate(found_a), np.concatenate(found_b))
                    found_a, found_b = [a], [b]
            if found_a:
                a, b = np.concatenate(found_a), np.concatenate(found_b)
                if len(a):
                    a, b = reduced(a, b)
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                                     names=["a", "b"])

    return link


def links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between different fingerprints of ``prints`` that connect
    exactly what links of ``max_bits`` or fewer differing bits connect."""
    # a few bytes each, but each is looked up under many keys: spread before that
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = prints.select("fingerprint").distinct().repartition(tasks, F.xxhash64("fingerprint"))
    own, probes = _ring_keys(max_bits)
    filed = distinct.select(F.explode(own).alias("key"), "fingerprint")
    looked = distinct.select(F.explode(probes).alias("key"), "fingerprint")
    # keys with more fingerprints than one block holds, with their number of blocks
    hot = stored(filed.groupBy("key").count().filter(F.col("count") > block)
                 .select("key", F.ceil(F.col("count") / block).alias("blocks")), "hot-keys")
    many = F.coalesce("blocks", F.lit(1))
    filed = filed.join(hot, "key", "left").select(
        "key", F.pmod(F.xxhash64("fingerprint"), many).alias("block"), F.lit(False).alias("probe"), "fingerprint")
    looked = looked.join(hot, "key", "left").select(
        "key", F.explode(F.sequence(F.lit(0).cast("long"), many - 1)).alias("block"), F.lit(True).alias("probe"),
        "fingerprint")
    return (filed.union(looked).repartition("key", "block").sortWithinPartitions("key", "block", "probe")
            .mapInArrow(_links(max_bits), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    prints = stored(fingerprints(docs, shingle), "prints")
    parts = connected_components(links(prints, max_bits))
    lowest = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("low"), F.count("*").alias("documents"))
    classes = stored(lowest.join(parts, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "low", "documents", F.coalesce("component", "fingerprint").alias("key")), "classes")
    smallest = stored(classes.groupBy("key").agg(F.min("low").alias("component_id"), F.count("*").alias("copies")),
                      "smallest")
    ids = stored(join_copies(classes.select("key", "fingerprint", "documents"), smallest, classes.count()).select(
        F.col("fingerprint").alias("key"), F.col("documents").alias("copies"), "component_id"), "ids")
    return join_copies(prints.select(F.col("fingerprint").alias("key"), "doc_id"), ids, prints.count()).select(
        "doc_id", F.lower(F.lpad(F.hex("key"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest
    doc_id (rows without one come last, then by text hash), once."""
    key = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id"), F.xxhash64("text").alias("hash"))
    groups = near_duplicates(docs.select(key.alias("doc_id"), "text"), shingle, max_bits)
    kept = groups.filter("doc_id = component_id").select(F.col("doc_id").alias("key")).distinct()
    # repeated rows become one before anything is shuffled; with the key in the type it was stored in (all fields
    # nullable), the join takes the rows as they were shuffled for that, else it casts and shuffles them again
    rows = docs.select(key.cast(kept.schema["key"].dataType).alias("key"),
                       F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    once = rows.groupBy("key").agg(F.first("row").alias("row"))
    return once.join(kept, "key", "left_semi").select("row.*")
