"""Manifest data rules (D8) and foreign-key orphan checks (J6) over the feeds.

Rules are compiled to column predicates; each table is checked in one
aggregation pass (partial aggregates, no row reaches the driver).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import exprs as X
from tallyhouse.operators import warehouse as W
from tallyhouse.sources import fixtures as FX
from tallyhouse.sources.manifest import DEFAULT_RULES

# manifest table -> (fixture role view, typed external schema)
TABLE_ROLES = {
    "customers": ("raw_customers", "customers"),
    "employee": ("raw_employees", "employees"),
    "orders": ("raw_orders", "orders"),
    "productCategories": ("raw_categories", "product_categories"),
    "products": ("raw_products", "products"),
    "productSubcategories": ("raw_subcategories", "product_subcategories"),
    "stores": ("raw_stores", "stores"),
    "storesBudget": ("raw_budgets", "stores_budget"),
}


def compile_rule(rule: str) -> Column:
    """Predicate that is TRUE when a row passes ``kind:column`` (NULL fails)."""
    kind, col = rule.split(":", 1)
    if kind == "not_null":
        pred = F.col(col).isNotNull()
    elif kind == "valid_date":
        pred = X.parse_mdy(F.col(col)).isNotNull()
    elif kind == "gte_zero":
        pred = F.col(col) >= 0
    else:
        raise ValueError(f"unknown rule kind {kind!r}")
    return F.coalesce(pred, F.lit(False))


def typed_table(spark: SparkSession, sf: str, table: str) -> DataFrame:
    role, schema = TABLE_ROLES[table]
    return W.typed(FX.RAW[role](spark, sf), schema)


def rule_counts(df: DataFrame, table: str, pk: list[str], rules: list[str]) -> DataFrame:
    """One row per rule: table, rule, n_rows, n_failed.  ``pk_unique`` counts the
    extra copies of every non-NULL key."""
    pk_ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in pk])
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count(F.when(~compile_rule(r), 1)).alias(f"r{i}") for i, r in enumerate(rules)]
    aggs += [F.count(F.when(pk_ok, 1)).alias("pk_rows"),
             F.count_distinct(*[F.col(c) for c in pk]).alias("pk_distinct")]
    wide = df.agg(*aggs)
    items = [F.struct(F.lit(r).alias("rule"), F.col(f"r{i}").alias("n_failed"))
             for i, r in enumerate(rules)]
    items.append(F.struct(F.lit("pk_unique").alias("rule"),
                          (F.col("pk_rows") - F.col("pk_distinct")).alias("n_failed")))
    return wide.select(F.lit(table).alias("table"), "n_rows",
                       F.explode(F.array(*items)).alias("x")).select(
        "table", "x.rule", "n_rows", "x.n_failed")


def manifest_rule_report(spark: SparkSession, sf: str, rules=DEFAULT_RULES) -> DataFrame:
    parts = [rule_counts(typed_table(spark, sf, t), t, pk, dq_rules)
             for t, pk, _fk, dq_rules in rules]
    return reduce(DataFrame.unionByName, parts)


def parent_of(fk: str, rules=DEFAULT_RULES) -> str | None:
    """The first table (manifest order) whose single-column key is ``fk``."""
    for t, pk, _fk, _r in rules:
        if pk == [fk]:
            return t
    return None


def _word(key: str) -> Column:
    """Number of the 64-key word that an integer key falls into."""
    return F.shiftright(F.col(key).cast("bigint"), 6)


def _bit(key: str) -> Column:
    return F.expr(f"shiftleft(1L, cast(`{key}` & 63 AS int))")


def fk_orphan_counts(child: DataFrame, table: str, parents: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """J6 for all foreign keys of one child table in one pass over the child.

    A parent's integer keys become a bitmap, one row per 64 neighbouring keys;
    each child row looks its keys up in the bitmaps (broadcast where their size
    allows, else joined by word) and tests one bit each.  Nothing is multiplied
    and no row is grouped before the one final aggregate."""
    rows, aggs, items = child.select(*parents), [], []
    for i, (fk, (parent, pdf)) in enumerate(parents.items()):
        words = pdf.where(F.col(fk).isNotNull()).groupBy(_word(fk).alias(f"_w{i}")).agg(
            F.bit_or(_bit(fk)).alias(f"_bits{i}"))
        rows = rows.join(words, _word(fk) == F.col(f"_w{i}"), "left")
        known = F.coalesce(F.col(f"_bits{i}"), F.lit(0).cast("bigint")).bitwiseAND(_bit(fk)) != 0
        aggs += [F.count(fk).alias(f"n{i}"), F.count(F.when(F.col(fk).isNotNull() & ~known, 1)).alias(f"o{i}")]
        items.append(F.struct(F.lit(fk).alias("fk"), F.lit(parent).alias("parent"), F.col(f"n{i}").alias("n_checked"),
                              F.col(f"o{i}").alias("n_orphans")))
    return rows.agg(*aggs).select(F.explode(F.array(*items)).alias("x")).select(F.lit(table).alias("table"), "x.*")


def fk_orphan_report(spark: SparkSession, sf: str, rules=DEFAULT_RULES) -> DataFrame:
    """table, fk, parent, n_checked (non-NULL fk rows), n_orphans."""
    parts = []
    for t, _pk, fks, _r in rules:
        parents = {fk: (parent_of(fk, rules), None) for fk in fks}
        parents = {fk: (p, typed_table(spark, sf, p)) for fk, (p, _) in parents.items()
                   if p is not None and p != t}
        if parents:
            parts.append(fk_orphan_counts(typed_table(spark, sf, t), t, parents))
    return reduce(DataFrame.unionByName, parts)


def manifest_checks(table: str, rules=DEFAULT_RULES) -> list:
    """The manifest's rules of ``table`` as routing checks (REASON
    'RULE_<kind>_<column>'); PK uniqueness is the keep-first flag of dq."""
    from tallyhouse.operators.dq import FIRST, Check
    for t, pk, _fk, dq_rules in rules:
        if t == table:
            checks = [Check(r.replace(":", "_"), compile_rule(r),
                            "RULE_" + r.replace(":", "_").upper()) for r in dq_rules]
            return checks + [Check("pk_unique", F.col(FIRST), "DUPLICATE_PK")]
    raise KeyError(table)


def route_by_manifest(df: DataFrame, table: str, order: list[tuple[str, str]], rules=DEFAULT_RULES):
    """Route a typed table (with ``_rid``) by its manifest rules alone."""
    from tallyhouse.operators.dq import mark_first, route
    pk = next(p for t, p, _f, _r in rules if t == table)
    flagged = mark_first(df, pk, order)
    cols = [c for c in df.columns if c != "_rid"]
    return route(flagged, manifest_checks(table, rules), cols, cols)
