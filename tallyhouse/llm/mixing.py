"""Mixing sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, its source's
target divided by its size.  The documents of a source stand in a fixed order;
the running sum of expected copies plus one offset per source in [0, 1) gives
each document one copy per integer boundary that it crosses.  As the order
goes by size class, the words taken come within a few documents of the target.

The running sum is a rank times the rate, and the rank is found in three
levels, none of which gathers a source in one task: documents before the size
class, before the salt within the class, and before the document within the
salt.  A size class of a source has one salt for each ``salt_rows`` documents
and for each ``SALT_WORDS`` words, or for each 1 in ``HOT`` of all documents and
words where these are more; so classes of more than one salt are at most twice
``HOT``, whatever the table, and are broadcast.

Targets: sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3, ...
and share the total size; a target stops at ``max_repeat`` times its source's
size, and what is left over goes to the others by weight.  The level that
fills the total is the largest of the levels reached when sources are capped
one after another in order of cap per weight.

Edge cases: a null text has size 0; a source without words has target and rate
0; a null source is a source of its own; repeated rows are rows of their own;
an empty table gives no rows.  Reruns on the same rows agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored

MAX_REPEAT = 3
WEIGHTS = 3           # weights 1 .. WEIGHTS, repeating
SALT_ROWS = 4096
SALT_WORDS = 524_288
HOT = 262_144
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def _unit(text):
    """A number in [0, 1) from the MD5 of a string column."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def sized(docs: DataFrame, carry: list[str]) -> DataFrame:
    """row (struct of ``carry``), source, skey, size, class, key."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"), "source", size.alias("size"),
                       F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), "source", "text")).alias("key"))
    # size class: position of the first bit and the three after it; the first
    # character of skey tells a null source from any other
    return rows.select(
        "row", "source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("skey"), "size",
        F.expr("CASE WHEN size = 0 THEN -1L ELSE 8L * (length(bin(size)) - 1) +"
               " (size * 8) div shiftleft(1L, length(bin(size)) - 1) - 8 END").alias("class"), "key")


def source_targets(rows: DataFrame, max_repeat: int = MAX_REPEAT, weights: int = WEIGHTS) -> DataFrame:
    """skey, source_size, target, rate, offset per source; one row per source."""
    per = rows.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("weight", F.expr(
        f"(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {weights} + 1").cast("bigint"))
    capped = ranked.withColumn("cap", F.col("source_size") * max_repeat)
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = ((F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
             / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("double"))
    filled = capped.withColumn("level", level).withColumn("level", F.max("level").over(whole))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return filled.select(
        "skey", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
        _unit(F.concat(F.lit(SEED), "skey")).alias("offset"))


def _salted(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with their salt: 0 but in the classes of ``hot``."""
    number = F.conv(F.substring("key", 1, 7), 16, 10).cast("bigint")
    return rows.join(F.broadcast(hot), ["skey", "class"], "left").withColumn(
        "salt", number % F.coalesce("salts", F.lit(1))).drop("salts")


def copies(rows: DataFrame, max_repeat: int = MAX_REPEAT, weights: int = WEIGHTS,
           salt_rows: int = SALT_ROWS) -> DataFrame:
    """``sized`` rows with source_size, target and copies."""
    slim = stored(rows.select("skey", "source", "class", "size", "key"), "mix-slim")
    groups = stored(slim.groupBy("skey", "source", "class").agg(F.count("*").alias("n"), F.sum("size").alias("size")),
                    "mix-classes")
    sources = stored(source_targets(groups, max_repeat, weights), "mix-sources")
    documents, words = groups.agg(F.sum("n"), F.sum("size")).first()
    salts = F.greatest(F.ceil(F.col("n") / max(salt_rows, -(-(documents or 0) // HOT))),
                       F.ceil(F.col("size") / max(SALT_WORDS, -(-(words or 0) // HOT)))).cast("bigint")
    hot = stored(groups.select("skey", "class", salts.alias("salts")).filter("salts > 1"), "mix-hot")  # 2 x HOT at most
    upto = (Window.unboundedPreceding, -1)
    classes = groups.select("skey", "class", F.sum("n").over(
        Window.partitionBy("skey").orderBy("class").rowsBetween(*upto)).alias("lower"))
    salts = _salted(slim.join(F.broadcast(hot.select("skey", "class")), ["skey", "class"], "left_semi"), hot) \
        .groupBy("skey", "class", "salt").agg(F.count("*").alias("n"))
    within = salts.select("skey", "class", "salt", F.sum("n").over(
        Window.partitionBy("skey", "class").orderBy("salt").rowsBetween(*upto)).alias("within"))
    starts = classes.join(within, ["skey", "class"], "left").join(sources, "skey").select(
        "skey", "class", F.coalesce("salt", F.lit(0)).alias("salt"),
        (F.coalesce("lower", F.lit(0)) + F.coalesce("within", F.lit(0))).alias("before"),
        "source_size", "target", "rate", "offset")
    rank = F.row_number().over(Window.partitionBy("skey", "class", "salt").orderBy("size", "key"))
    placed = _salted(rows, hot).withColumn("rank", rank).join(stored(starts, "mix-starts"), ["skey", "class", "salt"])
    sum_to = lambda k: F.floor(F.col("rate") * k + F.col("offset"))
    k = F.col("before") + F.col("rank")
    crossed = F.least(sum_to(k) - sum_to(k - 1), F.ceil("rate"))
    return placed.select("row", "size", "source_size", "target", crossed.cast("bigint").alias("copies"))


def mix_plan(docs: DataFrame, max_repeat: int = MAX_REPEAT, weights: int = WEIGHTS,
             salt_rows: int = SALT_ROWS) -> DataFrame:
    """doc_id, size, source_size, target, copies of each row."""
    rows = stored(sized(docs, ["doc_id"]), "mix-sized")
    return copies(rows, max_repeat, weights, salt_rows).select("row.doc_id", "size", "source_size", "target", "copies")


def mixed(docs: DataFrame, max_repeat: int = MAX_REPEAT, weights: int = WEIGHTS,
          salt_rows: int = SALT_ROWS) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as it is taken."""
    planned = copies(sized(docs, docs.columns), max_repeat, weights, salt_rows)
    return planned.filter("copies > 0").select(
        "row", F.explode(F.expr("sequence(1L, copies)")).alias("copy")).select("row.*")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat_ws('|', CAST(doc_id AS VARCHAR), source, text)) AS k
  FROM documents),
c AS (
  SELECT *, CASE WHEN size = 0 THEN -1 ELSE 8 * (length(bin(size)) - 1)
              + (size * 8) // (CAST(1 AS BIGINT) << CAST(length(bin(size)) - 1 AS INTEGER)) - 8 END AS class
  FROM d),
h AS (
  SELECT *, CAST(greatest(1, ceil(count(*) OVER g / greatest(4096.0, ceil(count(*) OVER () / 262144.0))),
                          ceil(sum(size) OVER g / greatest(524288.0, ceil(sum(size) OVER () / 262144.0)))) AS BIGINT) AS salts
  FROM c WINDOW g AS (PARTITION BY source, class)),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM s),
l AS (SELECT *,
        CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS DOUBLE)
        / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS DOUBLE) AS lev
      FROM w WINDOW b AS (ORDER BY CAST(cap AS DOUBLE) / weight, source ASC NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), (SELECT max(lev) FROM l) * weight) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
        CAST(CAST('0x' || substr(md5('mix' || coalesce('=' || source, '')), 1, 8) AS BIGINT) AS DOUBLE)
        / 4294967296.0 AS u FROM t),
o AS (SELECT doc_id, h.size, r.source_size, r.target, rate, u,
        row_number() OVER (PARTITION BY h.source ORDER BY class,
          CAST('0x' || substr(k, 1, 7) AS BIGINT) % salts, h.size, k) AS n
      FROM h JOIN r ON h.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       CAST(size * least(floor(rate * n + u) - floor(rate * (n - 1) + u), ceil(rate)) AS BIGINT) AS taken
FROM o
"""
