"""Data-quality building blocks: keep-first dedup, check routing, audit, FK check.

Dedup (SURVEY W1/W2) is ROW_NUMBER() OVER (PARTITION BY key ORDER BY ...) = 1.
That window would sort each key's rows inside one task, so one hot key (or one
huge group of identical copies) would land on a single executor.  Instead:

* Outputs that need only the first rows (valid rows, latest rows) come from one
  aggregate: the smallest ordering struct of a key is the winning row itself,
  and partial aggregation collapses a hot key before the shuffle.  Per-key
  counts give the split audit and the per-REASON profile (``Routed``).
* Outputs that need every row with its flag (check flags, quarantined rows) rank
  in two stages, in one pass and without a self-join: rows are dealt by key and
  a salt of the row id, and ranked within each salt; a key's salt winners, at
  most as many as there are salts, are then ranked among themselves.  A hot key
  is spread over as many groups as there are shuffle partitions.

The ordering is NULLS LAST in both directions (the reference engine's rule) and
ends with ``_rid``, so ties between rows equal in every column are broken
deterministically; such rows are indistinguishable in the output.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RID = "_rid"
FIRST = "_first"
STATUS = "_status"
REASON = "REASON"
GROUP_ROWS = "_group_rows"
_EPOCH = "1970-01-01"


def with_row_id(df: DataFrame, name: str = RID) -> DataFrame:
    """Attach a row id.  Call directly on a file scan (before any shuffle): scan
    partitions are fixed by the file listing, so a retried task regenerates the
    same ids.  (For parquet scans prefer ``file_row_id``: it is deterministic,
    so Spark can reuse the scan's exchanges across plan branches.)"""
    return df.withColumn(name, F.monotonically_increasing_id())


def file_row_id() -> Column:
    """Deterministic row id of a parquet scan: (hash of the file path, row
    index in the file).  Exact within a file; files are told apart by a
    64-bit path hash."""
    return F.struct(F.xxhash64(F.col("_metadata.file_path")).alias("f"),
                    F.col("_metadata.row_index").alias("r"))


def _descending_key(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    col = F.col(c)
    if isinstance(dt, T.DateType):
        return -F.datediff(col, F.lit(_EPOCH).cast("date"))
    if isinstance(dt, (T.TimestampNTZType, T.TimestampType)):
        return -F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast(dt.simpleString()), col)
    if isinstance(dt, T.NumericType):
        return -col
    raise TypeError(f"descending order on {dt} not supported for column {c}")


def mark_first(df: DataFrame, keys: list[str], order: list[tuple[str, str]],
               rid: str = RID, flag: str = FIRST, salts: int | None = None) -> DataFrame:
    """Add boolean ``flag``: TRUE for the single first row of each key group
    (NULL keys form one group, as in SQL PARTITION BY).

    Two rankings: within (key, salt of the row id), then among a key's salt
    winners.  In the second one the other rows stay apart, each in the group of
    its salt, so no group is larger than in the first."""
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = [F.col(c).asc_nulls_last() if direction == "asc" else F.col(c).desc_nulls_last()
              for c, direction in order] + [F.col(rid)]
    group = [F.col(k) for k in keys]
    near = Window.partitionBy(*group, "_salt").orderBy(*ranked)
    across = Window.partitionBy(*group, F.when(F.col("_ahead"), -1).otherwise(F.col("_salt"))).orderBy(*ranked)
    return (df.withColumn("_salt", F.pmod(F.xxhash64(rid), F.lit(salts)))
            .withColumn("_ahead", F.row_number().over(near) == 1)
            .withColumn(flag, F.col("_ahead") & (F.row_number().over(across) == 1))
            .drop("_salt", "_ahead"))


def keep_first(df: DataFrame, keys: list[str], order: list[tuple[str, str]],
               rid: str = RID, count_col: str | None = None,
               extra_aggs: dict[str, Column] | None = None) -> DataFrame:
    """Rows with row number 1 only, in one aggregate and without a join back.

    The smallest ordering struct *is* the winning row: it holds every ordered
    column once (with its NULLS LAST flag; a descending one also as it was),
    then ``_rid`` and whatever column takes no part in the ordering.
    ``count_col`` adds the key's row count and ``extra_aggs`` further per-key
    aggregates."""
    parts, take = [], {k: F.col(k) for k in keys}
    for i, (c, direction) in enumerate(order):
        parts.append(F.col(c).isNull().alias(f"n{i}"))
        if direction == "asc":
            parts.append(F.col(c).alias(f"s{i}"))
            take[c] = F.col(f"_w.s{i}")
        else:
            parts += [_descending_key(df, c).alias(f"s{i}"), F.col(c).alias(f"v{i}")]
            take[c] = F.col(f"_w.v{i}")
    for c in [rid] + [c for c in df.columns if c not in take and c != rid]:
        parts.append(F.col(c).alias(f"r_{c}"))
        take[c] = F.col(f"_w.r_{c}")
    aggs = [F.min(F.struct(*parts)).alias("_w")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    extra = dict(extra_aggs or {})
    aggs += [a.alias(n) for n, a in extra.items()]
    return (df.groupBy(*[F.col(k) for k in keys]).agg(*aggs)
            .select(*[take[c].alias(c) for c in df.columns], *([count_col] if count_col else []), *extra))


def first_rows(df: DataFrame, keys: list[str], order: list[tuple[str, str]],
               rid: str = RID, flag: str = FIRST,
               extra_aggs: dict[str, Column] | None = None) -> DataFrame:
    """The rows ``mark_first`` flags TRUE, with the flag column and each key's
    row count, computed by the aggregate alone (see ``keep_first``)."""
    return keep_first(df, keys, order, rid, GROUP_ROWS, extra_aggs).withColumn(flag, F.lit(True))


def pre_dedup_category(checks: list["Check"], dedup: str = "dedup") -> tuple[Column, list[str]]:
    """For rows that are not first of their key: the REASON decided before the
    dedup check (first FALSE check ahead of it), NULL when none fails, and the
    list of such reasons."""
    names = [c.name for c in checks]
    pre = checks[:names.index(dedup)]
    cat = None
    for c in pre:
        cond = ~c.predicate
        cat = F.when(cond, c.reason) if cat is None else cat.when(cond, c.reason)
    return (cat if cat is not None else F.lit(None).cast("string")), [c.reason for c in pre]


def profile_aggs(checks: list["Check"], dedup: str = "dedup") -> dict[str, Column]:
    """Per-key counts of rows per pre-dedup REASON (and of rows with none),
    to be computed inside the first-row aggregate."""
    cat, reasons = pre_dedup_category(checks, dedup)
    aggs = {f"_pre{i}": F.count(F.when(cat == r, 1)) for i, r in enumerate(reasons)}
    aggs["_pre_none"] = F.count(F.when(cat.isNull(), 1))
    return aggs


@dataclass(frozen=True)
class Check:
    """One named rule: ``predicate`` TRUE means the row passes; ``reason`` is
    written when this is the first failing rule of a row."""

    name: str
    predicate: Column
    reason: str


@dataclass
class Routed:
    flagged: DataFrame          # every row, check columns, REASON, _status
    valid_cols: list[str]
    invalid_cols: list[str]
    renames: dict = field(default_factory=dict)
    firsts: DataFrame | None = None   # the rn=1 rows only, with checks (no join back)
    audit_from_firsts: bool = False   # firsts carry group sizes of exactly the routed rows
    checks: list = field(default_factory=list)

    def valid(self) -> DataFrame:
        """All checks TRUE.  Valid rows are first rows of their key, so when the
        first rows are known directly they are filtered instead of the flagged
        set (same rows, one pass over the input, no join)."""
        src = self.firsts if self.firsts is not None else self.flagged
        return src.where(F.col(STATUS) == "valid").select(*self._cols(self.valid_cols))

    def invalid(self) -> DataFrame:
        """Rows for which NOT(all checks) is TRUE, with REASON."""
        return self.flagged.where(F.col(STATUS) == "invalid").select(*self._cols(self.invalid_cols))

    def _cols(self, names: list[str]) -> list[Column]:
        return [F.col(c).alias(self.renames.get(c, c)) if isinstance(c, str) else c for c in names]

    def reason_profile(self) -> DataFrame:
        """Invalid rows per REASON.  From the first rows alone when they
        carry per-key counts of the reasons decided before the dedup check: a
        later row's REASON is that pre-dedup reason, else DUPLICATE_PK."""
        f = self.firsts
        if f is None or not self.audit_from_firsts or "_pre_none" not in f.columns:
            return reason_profile(self.invalid())
        cat, reasons = pre_dedup_category(self.checks)
        dup_reason = next(c.reason for c in self.checks if c.name == "dedup")
        later = [F.struct(F.lit(r).alias(REASON),
                          (F.col(f"_pre{i}") - F.when(cat == r, 1).otherwise(0)).alias("n"))
                 for i, r in enumerate(reasons)]
        later.append(F.struct(F.lit(dup_reason).alias(REASON),
                              (F.col("_pre_none") - F.when(cat.isNull(), 1).otherwise(0)).alias("n")))
        first_part = f.where(F.col(STATUS) == "invalid").select(REASON, F.lit(1).cast("bigint").alias("n"))
        later_part = f.select(F.explode(F.array(*later)).alias("x")).select(
            "x." + REASON, F.col("x.n").cast("bigint").alias("n"))
        return (first_part.unionByName(later_part).groupBy(REASON)
                .agg(F.sum("n").alias("n")).where(F.col("n") > 0))

    def audit(self, entity: str) -> DataFrame:
        """D9.  With the first rows and their group sizes known, one aggregate
        suffices: valid and gap rows are always first rows (a later row fails
        the dedup check, and FALSE beats NULL), so every other row is invalid."""
        if self.firsts is None or not self.audit_from_firsts:
            return split_audit(self.flagged, entity)
        st = F.col(STATUS)
        a = self.firsts.agg(
            F.sum(GROUP_ROWS).alias("rows_in"),
            F.count(F.when(st == "valid", 1)).alias("rows_valid"),
            (F.sum(GROUP_ROWS) - F.count(F.lit(1)) + F.count(F.when(st == "invalid", 1))).alias("rows_invalid"),
            F.count(F.when(st == "gap", 1)).alias("rows_gap"))
        return a.select(F.lit(entity).alias("entity"), F.col("rows_in").cast("bigint").alias("rows_in"),
                        "rows_valid", F.col("rows_invalid").cast("bigint").alias("rows_invalid"), "rows_gap")


def route(df: DataFrame, checks: list[Check], valid_cols: list, invalid_cols: list,
          null_policy: str = "parity", firsts: DataFrame | None = None,
          audit_from_firsts: bool = True) -> Routed:
    """Route every row to valid / invalid with the first failing check as REASON.

    SQL three-valued logic is kept: valid = all checks TRUE; invalid = NOT(all)
    is TRUE.  A row whose checks are only TRUE or NULL is in neither output
    ("gap") under ``null_policy='parity'``; ``'quarantine'`` sends it to
    invalid with REASON 'NULL_CHECK'.
    """
    if null_policy not in ("parity", "quarantine"):
        raise ValueError("null_policy must be 'parity' or 'quarantine'")
    out = _apply_checks(df, checks, null_policy)
    first_out = _apply_checks(firsts, checks, null_policy) if firsts is not None else None
    return Routed(out, list(valid_cols), list(invalid_cols) + [REASON], firsts=first_out,
                  checks=list(checks),
                  audit_from_firsts=audit_from_firsts and first_out is not None
                  and GROUP_ROWS in first_out.columns)


def _apply_checks(df: DataFrame, checks: list[Check], null_policy: str) -> DataFrame:
    named = {f"ok_{c.name}": c.predicate for c in checks}
    out = df.withColumns(named)
    all_ok = reduce(lambda a, b: a & b, [F.col(n) for n in named])
    reason = None
    for c in checks:
        cond = ~F.col(f"ok_{c.name}")
        reason = F.when(cond, c.reason) if reason is None else reason.when(cond, c.reason)
    reason = reason.otherwise("NULL_CHECK" if null_policy == "quarantine" else "UNKNOWN")
    status = (F.when(all_ok, "valid").when(~all_ok, "invalid")
              .otherwise("invalid" if null_policy == "quarantine" else "gap"))
    return out.withColumn(STATUS, status).withColumn(
        REASON, F.when(F.col(STATUS) == "invalid", reason))


def split_audit(flagged: DataFrame, entity: str) -> DataFrame:
    """Rows in = valid + invalid + gap, one row per entity (one pass)."""
    return flagged.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count(F.when(F.col(STATUS) == "valid", 1)).alias("rows_valid"),
        F.count(F.when(F.col(STATUS) == "invalid", 1)).alias("rows_invalid"),
        F.count(F.when(F.col(STATUS) == "gap", 1)).alias("rows_gap"),
    ).select(F.lit(entity).alias("entity"), "*")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (SURVEY 7.4 #17: duplicate dimension keys
    fan out star joins).  An aggregation, partial before the shuffle."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def reason_profile(invalid: DataFrame) -> DataFrame:
    """Quarantined rows per REASON."""
    return invalid.groupBy(REASON).agg(F.count(F.lit(1)).alias("n"))


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row."""
    keys = parent.where(F.col(pk).isNotNull()).select(F.col(pk).alias(fk))
    return child.where(F.col(fk).isNotNull()).join(keys, on=fk, how="left_anti")
