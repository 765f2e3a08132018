"""SpotSigs fingerprints, in DataFrame operations only.

An anchor is a common word; its signature is the anchor and the chain of the
next ``CHAIN`` content words (words that are no anchors; fewer at the end of a
text).  A text's signatures are a set of 64-bit hashes, and its fingerprint is
the digest of that set.  A text in which no content word follows an anchor has
one signature, its word sequence; a text without words has none.

As every word is an anchor or content, the j-th anchor at word position p has
p - j content words before it; so chains are slices of the content words, and
a text takes linear time.

Likeness is the Jaccard coefficient of two sets (1 for two empty ones).
Different sets are partitioned by length, so that only sets of one or of
neighbouring lengths that can reach a threshold meet, and each set by the first
bits of its signatures.  It is filed under what its parts hold, the rarest parts
first and only as many as the threshold allows to differ (a pair beyond shares
none of them).  Pairs are pruned by bounds on the lengths and on parity bits of
the sets, and compared exactly.
``with_classes`` finds the classes that all links at the threshold connect,
``near_duplicates`` the pairs themselves.

Edge cases: a null text counts as empty; repeated rows stay rows (in order of
doc_id, then text hash; a null doc_id comes last); an empty table gives no
rows; a single document is its own next document; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import hot_keys, join_copies, scratch, stored
from tallyhouse.llm.components import connected_components

CHAIN = 3
THRESHOLD = 0.8
BUCKETS = 1 << 18  # of parts' contents, by which the frequent ones are told
FREQUENT = 2048    # of these buckets at most, that the driver gets
BLOCK = 4096       # sets of one key that a task holds against as many
PIVOTS = 32        # sets of a key's main component, and of its others, that each other set is held against
BITS = 256         # parities of a set's signatures, a power of 2
# fixed values: common words of English, German, French and Spanish
ANCHORS = """
a an and are as at be but by can for from had has have he his i if in is it not of on or our she that the their they
this to was we were which will with you your
als am auch auf aus bei das dem den der des die durch ein eine für haben ich im ist mit nach nicht oder sich sie sind
um und von war werden wie wir wird zu zum zur
au aux avec ce dans de du elle en est et il je la le les ne nous ou par pas plus pour que qui se son sur un une vous
al como con del el es esta este los más muy no o para pero por si sin su también y
""".split()

RANGES = 256       # doc_id ranges found by their percentiles
PARTS = 1024       # at most so many equal parts of a range: RANGES * PARTS bounds what is broadcast
PART_ROWS = 64     # rows of a part aimed at
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def with_signatures(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add column ``name``: the array of distinct signatures of column ``text``."""
    words, anchors, content = f"{name}_words", f"{name}_anchors", f"{name}_content"
    is_anchor = lambda w: w.isin(sorted(set(ANCHORS)))
    df = df.withColumn(words, F.regexp_extract_all(F.translate(text, *_LOWER), F.lit(_WORD), F.lit(0)))
    df = df.withColumns({
        anchors: F.filter(F.transform(words, lambda w, i: F.when(is_anchor(w), i).otherwise(F.lit(-1))),
                          lambda i: i >= 0),
        content: F.filter(words, lambda w: ~is_anchor(w))})
    chains = F.transform(
        F.filter(F.transform(anchors, lambda p, j: F.struct(p.alias("p"), (p - j).alias("before"))),
                 lambda a: a["before"] < F.size(content)),
        lambda a: F.xxhash64(F.get(words, a["p"]), F.slice(content, a["before"] + 1, F.lit(CHAIN))))
    df = df.withColumn(name, F.array_distinct(chains))
    whole = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.col(name))
    return df.withColumn(name, F.when(F.size(name) > 0, F.col(name)).otherwise(whole)).drop(words, anchors, content)


def fingerprint(signatures: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(signatures).cast("array<string>"), ","), 256)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard coefficient of two arrays of distinct values; 1 for two empty ones."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, F.lit(1.0)).otherwise(common / every)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, signatures, fingerprint of each row."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_signatures(rows, "text", "signatures").select(
        "doc_id", "signatures", fingerprint(F.col("signatures")).alias("fingerprint"))


def _in_order(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text, hash, range, part, guest) in parts that follow one
    another by doc_id, each with the first row of the next part as a guest."""
    known = docs.agg(F.count("*").alias("n"), F.percentile_approx(
        "doc_id", [k / RANGES for k in range(RANGES + 1)], 10_000).alias("bounds")).first()
    edges = sorted(set(known["bounds"] or [0]))
    parts = min(PARTS, max(1, known["n"] // (RANGES * PART_ROWS)))
    bounds = F.array(*(F.lit(int(e)) for e in edges))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text").bitwiseAND(F.lit((1 << 63) - 1)))
    # ranges lie between neighbouring percentiles; rows without doc_id form the last
    rows = rows.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(len(edges))).otherwise(
        F.size(F.filter(bounds, lambda b: b <= F.col("doc_id")))))
    low = F.coalesce(F.get(bounds, F.col("range") - 1), F.lit(edges[0]))
    high = F.greatest(F.coalesce(F.get(bounds, F.col("range")), F.lit(edges[-1] + 1)), low + 1)
    share = F.when(F.col("doc_id").isNull(), F.col("hash") / F.lit(float(1 << 63))) \
        .otherwise((F.col("doc_id") - low) / (high - low))
    rows = rows.withColumn("part", F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.floor(share * parts).cast("int"))))
    # RANGES * PARTS rows at most: the first row of each part, and the part before it
    first = rows.groupBy("range", "part").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "hash")).alias("first"))
    ends = first.groupBy("range").agg(F.max("part").alias("last_part"))
    by_range = Window.orderBy("range")
    around = ends.select("range", F.lag(F.struct("range", "last_part")).over(by_range).alias("before"),
                         F.max(F.struct("range", "last_part")).over(Window.partitionBy()).alias("end"))
    in_range = Window.partitionBy("range").orderBy("part")
    follow = first.join(around, "range").select(
        "range", "part", "first", F.lag("part").over(in_range).alias("part_before"),
        F.coalesce("before", "end").alias("before"))
    follow = stored(follow.select(
        "range", "part", F.col("first.doc_id").alias("doc_id"), F.col("first.hash").alias("hash"),
        F.when(F.col("part_before").isNull(), F.col("before.range")).otherwise(F.col("range")).alias("to_range"),
        F.coalesce("part_before", "before.last_part").alias("to_part")), "first-rows")
    return rows, follow


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each row against its edited text and the next document, by doc_id
    (after the last: the first), and its class of near-duplicates.  The edited
    text has its last floor(n/2) code points replaced by the first as many of
    the next document.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, near_class, near_rows.
    """
    rows, follow = _in_order(docs)
    guests = rows.alias("r").join(F.broadcast(follow.alias("f")), [
        F.col("r.range") == F.col("f.range"), F.col("r.part") == F.col("f.part"), F.col("r.hash") == F.col("f.hash"),
        F.col("r.doc_id").eqNullSafe(F.col("f.doc_id"))]).select(
            "r.doc_id", "r.text", "r.hash", F.col("f.to_range").alias("range"), F.col("f.to_part").alias("part"),
            F.lit(True).alias("guest"))
    placed = rows.select("doc_id", "text", "hash", "range", "part", F.lit(False).alias("guest")).union(guests)
    order = Window.partitionBy("range", "part").orderBy("guest", F.col("doc_id").asc_nulls_last(), "hash")
    placed = placed.withColumn("next_text", F.lead("text").over(order))
    half = F.floor(F.length("text") / 2).cast("int")
    placed = placed.withColumns({
        "n_chars": F.length("text").cast("bigint"),
        "edited": F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                           F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))})
    signed = with_signatures(with_signatures(placed, "text", "own"), "edited", "other").select(
        "range", "part", "guest", "doc_id", "hash", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "other")
    signed = signed.withColumn("next", F.lead("own").over(order)).filter("NOT guest")
    signed = signed.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"), F.col("own").alias("signatures"),
        F.monotonically_increasing_id().alias("rid"))
    return with_classes(stored(signed, "signatures"))


def _most_apart(n: Column, threshold: float) -> Column:
    """In how many signatures a set of ``n`` and its partners differ at most."""
    return F.floor((n + F.floor(n / threshold + 1e-9)) * ((1 - threshold) / (1 + threshold)) + 1e-9).cast("int")


def _tokens(df: DataFrame, scale: str, where: str, name: str) -> DataFrame:
    """Add columns ``name``_starts and ``name``: where the parts of column
    ``ordered`` (sorted signatures) begin, and (size, key) of what each part
    that has signatures holds; both empty but ``where`` the row is filed at
    this scale.  A part has the signatures of equal first ``scale`` bits."""
    starts = f"{name}_starts"
    df = df.withColumn(starts, F.expr(
        f"if({where}, filter(transform(ordered, (v, i) -> if(i = 0 or shiftrightunsigned(v, 64 - {scale}) <> "
        f"shiftrightunsigned(get(ordered, i - 1), 64 - {scale}), i, -1)), i -> i >= 0), array())"))
    return df.withColumn(name, F.expr(
        f"transform(arrays_zip({starts}, slice({starts}, 2, size({starts}))), t -> named_struct("
        f"'size', coalesce(t['1'], size(ordered)) - t['{starts}'], 'key', xxhash64({scale}, slice(ordered, t['{starts}'] + 1, "
        f"coalesce(t['1'], size(ordered)) - t['{starts}']))))"))


def _in_parts(signed: DataFrame, threshold: float) -> DataFrame:
    """Add n, apart and, for both scales, what the parts of each set hold; sets
    that no other set can reach are filed at none."""
    n = F.size("signatures")
    rows = signed.withColumns({"n": n, "apart": _most_apart(n, threshold)})
    rows = rows.withColumns({
        "ordered": F.sort_array("signatures"), "scale": F.length(F.bin("n")) - 1, "above": F.length(F.bin("n")),
        "both": (F.col("apart") > 0) & (F.floor(F.col("n") / threshold + 1e-9) >= F.expr("shiftleft(1, length(bin(n)))"))})
    return _tokens(_tokens(rows, "scale", "apart > 0", "tokens"), "above", "both", "tokens_above")


def _frequent(parted: DataFrame) -> list[list[int]]:
    """Of the ``BUCKETS`` buckets that the keys of parts' contents fall into, up to
    ``FREQUENT`` that hold far more than most do, in groups from the fullest on."""
    each = parted.select(F.explode(F.concat("tokens", "tokens_above")).alias("token")).select(
        F.pmod("token.key", F.lit(BUCKETS)).alias("bucket"))
    counts = stored(each.groupBy("bucket").count(), "buckets")
    usual = (counts.agg(F.sum("count")).first()[0] or 0) / BUCKETS
    full = [r["bucket"] for r in counts.filter(F.col("count") > usual + 4 * math.sqrt(usual) + 4).orderBy(
        F.desc("count"), "bucket").limit(FREQUENT).collect()]
    return [some for some in (full[:FREQUENT // 64], full[FREQUENT // 64:FREQUENT // 8], full[FREQUENT // 8:]) if some]


def _filed(name: str, scale: str, frequent: list[list[int]]) -> Column:
    """Keys of the ``apart`` + 1 parts whose contents are the rarest: what is frequent
    comes late, what is larger before that, empty parts last."""
    level = " ".join(f"when pmod(t.key, {BUCKETS}) in ({', '.join(map(str, some))}) then {len(frequent) - k}"
                     for k, some in enumerate(frequent))
    level = f"case {level} else 0 end" if frequent else "0"
    keys = (f"transform(slice(sort_array(transform({name}, t -> named_struct('level', {level}, 'less', -t.size, "
            f"'key', t.key))), 1, apart + 1), r -> r.key)")
    empty = (f"transform(slice(array_except(sequence(0L, shiftleft(1L, {scale}) - 1), transform({name}_starts, "
             f"i -> shiftrightunsigned(get(ordered, i), 64 - {scale}))), 1, apart + 1 - size({name})), "
             f"p -> xxhash64({scale}, p))")
    return F.expr(f"concat({keys}, if(size({name}) > apart, array(), {empty}))")


def _sets(signed: DataFrame, threshold: float) -> DataFrame:
    """One row per fingerprint: fingerprint, filed, rid, copies, low.

    A set's signatures fall into 2^scale parts by their first bits.  Sets that
    differ in at most d signatures differ in at most d parts; so in any order
    of all contents of parts that both share, the first d + 1 parts of one and
    the other have one in common.  ``filed`` are these, the rarest first.
    Any order that all sets share will do, so counts by bucket are enough."""
    parted = _in_parts(signed, threshold)
    frequent = _frequent(parted)
    none = F.array().cast("array<bigint>")
    filed = F.concat(F.when(F.col("apart") > 0, _filed("tokens", "scale", frequent)).otherwise(none),
                     F.when(F.col("both"), _filed("tokens_above", "above", frequent)).otherwise(none))
    short = parted.select("fingerprint", filed.alias("filed"), "rid", "doc_id")
    return stored(short.groupBy("fingerprint", "filed").agg(
        F.min("rid").alias("rid"), F.count("*").alias("copies"), F.min("doc_id").alias("low")), "sets")


def _members(sets: DataFrame, signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sets under each key that more than one set is filed under (key, rid,
    n, bits), and these sets once each (rid, signatures, n, bits).

    ``bits`` are BITS parities of the signatures: two sets differ in no more of
    them than in signatures."""
    filed = sets.select(F.explode("filed").alias("key"), "rid")
    shared = stored(filed.groupBy("key").agg(F.count("*").alias("copies")).filter("copies > 1"), "shared")
    total = shared.agg(F.sum("copies")).first()[0] or 0
    some = stored(join_copies(filed, shared, total, hot_keys(shared, total)).select("key", "rid"), "shared-keys")
    bits = F.array(*(F.expr(f"aggregate(signatures, 0L, (a, v) -> a ^ if((v & {BITS // 64 - 1}) = {k}, "
                            "shiftleft(1L, cast((v >> 8) & 63 as int)), 0L))") for k in range(BITS // 64)))
    known = stored(signed.join(some.select("rid").distinct(), "rid", "left_semi").select(
        "rid", "signatures", F.size("signatures").alias("n"), bits.alias("bits")), "member-sets")
    return stored(some.join(known.select("rid", "n", "bits"), "rid"), "members"), known


def _differ(x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
    """In how many of their bits two sets differ."""
    return sum((F.bit_count(F.get(x("bits"), F.lit(k)).bitwiseXOR(F.get(y("bits"), F.lit(k))))
                for k in range(BITS // 64)), F.lit(0))


def _may_link(x: Callable[[str], Column], y: Callable[[str], Column], threshold: float) -> Column:
    """Whether n and bits of two sets allow ``threshold``."""
    return (F.least(x("n"), y("n")) >= F.greatest(x("n"), y("n")) * threshold - 1e-9) & (
        _differ(x, y) <= (x("n") + y("n")) * ((1 - threshold) / (1 + threshold)) + 1e-9)


def _of(side: str) -> Callable[[str], Column]:
    return lambda name: F.col(f"{side}.{name}")


def _open(members: DataFrame, block: int) -> DataFrame:
    """The members of keys that hold several components, with the largest one
    (main), and in how many blocks its sets and those of the others fit."""
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("size"))
    keys = stored(sizes.groupBy("key").agg(
        F.max_by("component", F.struct("size", "component")).alias("main"), F.max("size").alias("most"),
        F.sum("size").alias("copies"), F.count("*").alias("components")).filter("components > 1").select(
            "key", "main", "copies", F.ceil((F.col("copies") - F.col("most")) / block).alias("odd_blocks"),
            F.ceil(F.col("copies") / block).alias("blocks")), "open-keys")
    total = members.count()
    return stored(join_copies(members, keys, total, hot_keys(keys, total)), "open-members")


def _nearest(rows: DataFrame, threshold: float) -> DataFrame:
    """A pair (a, b) for each set outside its key's main component that may link
    to a pivot of another component: the pivot whose bits are the nearest."""
    order = F.xxhash64("rid", "key")
    one = rows.groupBy("key", (F.col("component") == F.col("main")).alias("in_main"),
                       F.pmod(order, F.lit(PIVOTS)).alias("slot")).agg(
        F.min(F.struct(order.alias("order"), "rid", "n", "bits", "component")).alias("pivot"), F.count("*").alias("copies"))
    pivots = stored(one.groupBy("key").agg(
        F.collect_list("pivot").alias("pivots"), F.sum("copies").alias("copies")), "pivots")
    odd = rows.filter("component <> main").select("key", "rid", "n", "bits", "component")
    likely = F.filter("pivots", lambda p: (p["component"] != F.col("component")) & _may_link(
        F.col, p.__getitem__, threshold))
    total = rows.count()
    found = join_copies(odd, pivots, total, hot_keys(pivots, total)).select("rid", F.array_min(F.transform(likely, lambda p: F.struct(
        (_differ(F.col, p.__getitem__) / (F.col("n") + p["n"])).alias("apart"), p["rid"].alias("rid")))).alias("pivot"))
    return found.filter("pivot IS NOT NULL").groupBy("rid").agg(F.min("pivot").alias("pivot")).select(
        F.col("pivot.rid").alias("a"), F.col("rid").alias("b"))


def _candidates(rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of sets of different components that share a key they are
    filed under, if their lengths and bits allow ``threshold``.

    Sets of a key's largest component are no partners of each other, so
    the others alone are held against all.  Both sides are dealt into blocks:
    no task holds more than a block by a block of sets of one key."""
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("rid"), F.col(n))
    odd = rows.filter("component <> main").withColumn("odd_block", mine("odd_blocks")).withColumn(
        "block", numbers("blocks"))
    every = rows.withColumn("block", mine("blocks")).withColumn("odd_block", numbers("odd_blocks"))
    columns = ("key", "block", "odd_block", "rid", "n", "bits", "component")
    x, y = odd.select(*columns).alias("x"), every.select(*columns).alias("y")
    pairs = x.join(y, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in columns[:3]] + [
        F.col("x.component") != F.col("y.component"), _may_link(_of("x"), _of("y"), threshold)])
    return pairs.select(F.least("x.rid", "y.rid").alias("a"), F.greatest("x.rid", "y.rid").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) that reach ``threshold``, with their likeness;
    ``sets`` holds rid and signatures.  A set of many pairs is broadcast."""
    pairs = candidates = stored(pairs, "candidates")
    total = pairs.count()
    for side in ("a", "b"):
        often = candidates.groupBy(F.col(side).alias("key")).agg(F.count("*").alias("copies"))
        known = sets.select(F.col("rid").alias("key"), F.col("signatures").alias(f"{side}_set")).join(often, "key")
        pairs = join_copies(pairs.withColumn("key", F.col(side)), known, total, hot_keys(often, total)).drop("key", "copies")
    return stored(pairs.select("a", "b", likeness(F.col("a_set"), F.col("b_set")).alias("likeness"))
                  .filter(F.col("likeness") >= threshold), "links")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, fingerprint) of all rows, and all pairs (a, b,
    likeness) of different fingerprints with a likeness of ``threshold`` or more."""
    signed = stored(fingerprints(docs).withColumn("rid", F.monotonically_increasing_id()), "signatures")
    sets = _sets(signed, threshold)
    members, known = _members(sets, signed)
    pairs = _verified(_candidates(_open(members.withColumn("component", F.col("rid")), block), threshold), known, threshold)
    name = lambda side: sets.select(F.col("rid").alias(side), F.col("fingerprint").alias(f"{side}_print"))
    pairs = pairs.join(name("a"), "a").join(name("b"), "b").select(
        F.least("a_print", "b_print").alias("a"), F.greatest("a_print", "b_print").alias("b"), "likeness")
    return signed.select("doc_id", "fingerprint"), pairs


def _components(sets: DataFrame, signed: DataFrame, threshold: float, block: int) -> DataFrame:
    """(node, component) of the sets (by rid) that any link of ``threshold`` connects.

    First each set is compared with the first one under each of its keys, which
    joins most of a large group in linear work, and each that is still apart with
    its nearest pivot; then only sets still apart are candidates of one another."""
    members, known = _members(sets, signed)
    first = stored(members.groupBy("key").agg(
        F.min(F.struct("rid", "n", "bits")).alias("first"), F.count("*").alias("copies")), "first-sets")
    total = members.count()
    pairs = join_copies(members.withColumn("own", F.struct("rid", "n", "bits")), first, total, hot_keys(first, total)).filter(
        (F.col("rid") != F.col("first.rid")) & _may_link(_of("own"), _of("first"), threshold)) \
        .select(F.col("first.rid").alias("a"), F.col("rid").alias("b")).distinct()
    near = _verified(pairs, known, threshold)
    links = near.select("a", "b")

    def apart() -> DataFrame:
        parts = stored(connected_components(links), "components")
        return _open(stored(members.join(parts, F.col("rid") == F.col("node"), "left").select(
            "key", "rid", "n", "bits", F.coalesce("component", "rid").alias("component")), "apart"), block)

    links = links.union(_verified(_nearest(apart(), threshold), known, threshold).select("a", "b"))
    links = links.union(_verified(_candidates(apart(), threshold), known, threshold).select("a", "b"))
    return stored(connected_components(links), "components")


def with_classes(signed: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``signed`` (a stored table with doc_id, fingerprint, signatures, rid)
    without its signatures, with near_class, the smallest doc_id that links of
    ``threshold`` or more lead to (itself included), and near_rows, the
    number of rows of that class.  Rows without signatures are one class."""
    with scratch(signed.sparkSession):          # all but the last table goes
        sets = _sets(signed, threshold)
        parts = _components(sets, signed, threshold, block)
        classes = stored(sets.join(parts, F.col("rid") == F.col("node"), "left").select(
            "fingerprint", "copies", "low", F.coalesce("component", "rid").alias("key")), "classes")
        total = classes.count()
        whole = stored(classes.groupBy("key").agg(F.min("low").alias("near_class"), F.sum("copies").alias("near_rows"),
                                                  F.count("*").alias("copies")), "class-sizes")
        per = stored(join_copies(classes.withColumnRenamed("copies", "rows"), whole, total, hot_keys(whole, total)).select(
            F.col("fingerprint").alias("key"), F.col("rows").alias("copies"), "near_class", "near_rows"), "class-of")
    rows = signed.drop("signatures", "rid").withColumn("key", F.col("fingerprint"))
    total = signed.count()
    return join_copies(rows, per, total, hot_keys(per, total)).drop("key", "copies")
