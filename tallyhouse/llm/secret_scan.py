"""Secret scan with multipart credential linking, in DataFrame operations only.

Strong kinds are reported wherever they match: ``assign`` (a named secret),
``access`` (an access identifier) and ``hex`` (a long hexadecimal run).  Weak
kinds prove nothing alone: ``key`` (40 or more characters of base64 with
digits, lower and upper case), ``ident`` (a named account or client) and
``endpoint`` (the address of a service).  A weak candidate is reported only if
a complementary part stands within its scope, ``SCOPE`` code points to either
side: a key with an identifier or an endpoint, an identifier or an endpoint
with a secret of any kind.  Candidates that overlap a strong span count as
parts like any other; only those wholly inside one are no spans of their own.

Spans come from one pass per kind: the pieces between matches and the matches
themselves give the positions by running sums, so overlapping rules cost
nothing, and running sums go in blocks, so many spans do not slow down a text.  Linking is
an interval join: parts are filed under the blocks of ``SCOPE`` code points
that they touch, weak ones under the blocks that their scope touches, joined
on document and block, with the overlap as condition.  It is a semi join, so
no pairs come out, and a block holds a bounded number of parts.

Edge cases: a null text counts as empty and has no spans; repeated rows stay
rows, each with all its spans; a null doc_id is carried; an empty table gives
no rows; positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored

SCOPE = 256
MARK = "[secret]"

# fixed values: the base patterns
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"       # a maximal run from the first AKIA, 20 or more in all
HEX = r"[0-9a-f]{24,}"              # a maximal run
# weak patterns of the method
KEY = r"(?<![A-Za-z0-9/+])(?=[A-Za-z/+]*[0-9])(?=[A-Z0-9/+]*[a-z])(?=[a-z0-9/+]*[A-Z])[A-Za-z0-9/+]{40,}"
IDENT = r"""(?<![A-Za-z0-9_])(?i:(?:client_?id|user_?name|user_?id|login|account|access_?key_?id))["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
ENDPOINT = r"(?<![A-Za-z0-9_])(?i:(?:https?|ftps?|jdbc:[a-z]+|mongodb|postgres(?:ql)?|mysql|redis|amqp|s3)://)[^\s\"'<>]{3,}"

KINDS = ["assign", "access", "hex", "key", "ident", "endpoint"]   # in the order in which spans at one place stand
SECRET = ("assign", "hex", "key")
_SPAN = "struct<start:bigint,rank:int,end:bigint>"


def _before(values: Column, merge) -> Column:
    """For each of an array of bigints what ``merge`` makes of all before it,
    from 0.  In blocks of about the square root of their number, as an array
    that grows element by element is copied each time."""
    none = F.array().cast("array<bigint>")
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values).cast("double"))).cast("int"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / width).cast("int")),
                         lambda i: F.slice(values, i * width + 1, width))

    def run(part, begin):
        return F.aggregate(part, F.struct(begin.alias("at"), none.alias("out")), lambda acc, v: F.struct(
            merge(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    zero = F.lit(0).cast("bigint")
    begins = run(F.transform(blocks, lambda b: F.aggregate(b, zero, merge)), zero)
    each = F.flatten(F.zip_with(blocks, begins, run))
    return F.when(F.size(values) > 0, each).otherwise(none)


def _with_spans(rows: DataFrame, patterns: dict) -> DataFrame:
    """Add per kind the array of (start, rank, end) of its pattern's leftmost
    non-overlapping matches; ``patterns``: kind -> (pattern, test of a match).

    The pieces between matches and the matches themselves, in turn, give the
    positions by a running sum of lengths."""
    none = F.array().cast(f"array<{_SPAN}>")
    for kind, (pattern, keep) in patterns.items():
        hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        pieces = F.transform(
            F.arrays_zip(F.split("text", pattern, -1).alias("gap"), hits.alias("hit")),
            lambda p: F.struct(F.length(p["gap"]).cast("bigint").alias("gap"),
                               F.coalesce(F.length(p["hit"]), F.lit(0)).cast("bigint").alias("hit"),
                               (p["hit"].isNotNull() & keep(p["hit"])).alias("good")))
        found = F.regexp_like("text", F.lit(pattern))
        rows = rows.withColumn("_pieces", F.when(found, pieces))
        rows = rows.withColumn("_lengths", F.transform("_pieces", lambda p: p["gap"] + p["hit"]))
        rows = rows.withColumn("_begins", _before(F.col("_lengths"), lambda a, b: a + b))
        spans = F.transform(F.filter(F.arrays_zip(F.col("_pieces").alias("p"), F.col("_begins").alias("at")),
                                     lambda x: x["p"]["good"]),
                            lambda x: F.struct((x["at"] + x["p"]["gap"]).alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                                               (x["at"] + x["p"]["gap"] + x["p"]["hit"]).alias("end")))
        rows = rows.withColumn(kind, F.coalesce(spans.cast(f"array<{_SPAN}>"), none))
    return rows.drop("_pieces", "_lengths", "_begins")


def _any(hit: Column) -> Column:
    return F.lit(True)


def _long_enough(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 2)) >= ASSIGN_MIN


PATTERNS = {"assign": (ASSIGN, _long_enough), "access": (ACCESS, _any), "hex": (HEX, _any),
            "key": (KEY, _any), "ident": (IDENT, _any), "endpoint": (ENDPOINT, _any)}


def _keyed(docs: DataFrame, *carry) -> DataFrame:
    """text and the row's content key _h, _n (equal rows have equal spans), and ``carry``."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(*carry, text.alias("text"), F.xxhash64("doc_id", text).alias("_h"), F.length(text).alias("_n"))


def _linked(found: DataFrame, scope: int) -> DataFrame:
    """_h, _n, linked: weak spans with a complementary part in their scope."""
    is_secret = F.col("part.rank").isin([KINDS.index(k) for k in SECRET])
    weak_from = KINDS.index("key")
    parts = found.filter(F.size("weak") > 0).dropDuplicates(["_h", "_n"]).select("_h", "_n", F.explode(F.concat("strong", "weak")).alias("part")) \
        .select("_h", "_n", "part", is_secret.alias("secret"))
    block = lambda low, high: F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope))).alias("block")
    weak = parts.filter(F.col("part.rank") >= weak_from).select(
        "*", block(F.col("part.start") - scope, F.col("part.end") + scope)).alias("w")
    near = parts.select("*", block(F.col("part.start"), F.col("part.end"))).alias("s")
    joined = weak.join(near, [
        F.col("w._h") == F.col("s._h"), F.col("w._n") == F.col("s._n"), F.col("w.block") == F.col("s.block"),
        F.col("w.secret") != F.col("s.secret"),
        F.col("s.part.start") <= F.col("w.part.end") + scope, F.col("s.part.end") >= F.col("w.part.start") - scope,
    ], "left_semi")
    return joined.groupBy("_h", "_n").agg(F.collect_set("part").alias("linked"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, strong, spans: arrays of (start, rank, end), rank an index of
    KINDS, by start and rank; and the content key _h, _n."""
    rows = _keyed(docs, "doc_id")
    spans = _with_spans(rows, PATTERNS).select(
        "doc_id", "_h", "_n", F.array_sort(F.concat("assign", "access", "hex")).alias("strong"),
        F.concat("key", "ident", "endpoint").alias("weak"))
    found = stored(spans, "secret-spans")
    links = stored(_linked(found, scope), "secret-links")
    # a weak candidate wholly inside a strong span is evidence for others, but no span of its own
    linked = F.filter(F.coalesce("linked", F.array().cast(f"array<{_SPAN}>")), lambda w: ~F.exists(
        "strong", lambda s: (s["start"] <= w["start"]) & (w["end"] <= s["end"])))
    return found.join(links, ["_h", "_n"], "left").select(
        "doc_id", "strong", F.array_sort(F.concat("strong", linked)).alias("spans"), "_h", "_n")


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kind, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    count = lambda k: F.size(F.filter("strong", lambda s: s["rank"] == KINDS.index(k))).cast("bigint")
    return scan(docs, scope).select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(span_text(F.col("strong")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, scope: int = SCOPE, mark: str = MARK) -> DataFrame:
    """All rows of ``docs``, every span of their text replaced by ``mark``;
    n_chars, where there is one, follows the new text."""
    spans = scan(docs, scope).filter(F.size("spans") > 0).select("_h", "_n", "spans").dropDuplicates(["_h", "_n"])
    # spans that begin after all earlier ones have ended, with that end
    spans = spans.withColumn("ends", F.transform("spans", lambda s: s["end"]))
    spans = spans.withColumn("reach", _before(F.col("ends"), lambda a, b: F.greatest(a, b)))
    cuts = F.transform(F.filter(F.arrays_zip(F.col("spans").alias("s"), F.col("reach").alias("r")),
                                lambda x: x["s"]["start"] >= x["r"]),
                       lambda x: F.struct(x["r"].cast("int").alias("low"), x["s"]["start"].cast("int").alias("high")))
    spans = stored(spans.select("_h", "_n", cuts.alias("cuts"), F.array_max("ends").cast("int").alias("last")),
                   "secret-redact")
    # the pieces between, in blocks: each is cut out of its block's text, not of the whole
    joined = _keyed(docs, F.struct(*docs.columns).alias("row")).join(spans, ["_h", "_n"], "left")
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("cuts").cast("double"))).cast("int"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("cuts") - 1) / width).cast("int")),
                         lambda i: F.slice("cuts", i * width + 1, width))
    joined = joined.withColumn("blocks", F.when(F.col("cuts").isNotNull(), F.transform(blocks, lambda b: F.struct(
        b.alias("cuts"), b[0]["low"].alias("low"),
        F.substring(F.col("text"), b[0]["low"] + 1, F.element_at(b, -1)["high"] - b[0]["low"]).alias("part")))))
    pieces = F.flatten(F.transform("blocks", lambda b: F.transform(b["cuts"], lambda c: F.substring(
        b["part"], c["low"] - b["low"] + 1, c["high"] - c["low"]))))
    tail = F.substring(F.col("text"), F.col("last") + 1, F.length("text"))
    joined = joined.withColumn("clean", F.concat(F.array_join(pieces, mark), F.lit(mark), tail))
    out = {c: F.col(f"row.`{c}`") for c in docs.columns}
    out["text"] = F.coalesce("clean", out["text"])
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col("clean").isNull(), out["n_chars"]).otherwise(
            F.length("clean").cast(docs.schema["n_chars"].dataType))
    return joined.select(*(v.alias(c) for c, v in out.items()))
