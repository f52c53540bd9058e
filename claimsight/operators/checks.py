"""Generic data-quality operators.

Contract (same as the reference's tests): a check returns the violating rows;
an empty result is a pass.  Rules are declared as data and rendered two ways:
as a Spark plan (the product) and as SQL text (the oracle used by the tests).

Scale notes
-----------
* Row-local rules of one table are fused by :func:`fused_row_rules` into a
  single scan: each row produces an array of the rules it breaks, which is
  exploded.  No shuffle, one pass over the table however many rules exist.
* Key checks (:func:`dup_key`) are one hash aggregate with map-side partial
  counts, so a hot key costs one partial row per task, not one row per record.
* Orphan checks (:func:`orphans`) are ``left_anti`` joins.  Catalyst plans a
  broadcast hash join when the parent side is measured small (dimensions) and
  a sort-merge join otherwise; AQE splits skewed partitions at runtime.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.mapping import DEALT_IDS, DEALT_RELATIONS, SPINE_RELATIONS, dealt, stored_spine

# Decimal columns of the raw relations; their values leave as DOUBLE.
DECIMAL_COLS = frozenset("""
amount_claimed amount_approved annual_limit_kes inpatient_limit_kes outpatient_limit_kes
premium_monthly_kes risk_score unit_cost_kes temperature_c weight_kg height_cm bmi
amount_paid_kes fraud_probability estimated_loss_kes amount_recovered_kes auc_roc
precision_at_10pct recall f1_score
""".split())


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_out(c: str, alias: str | None = None, prefix: str = "") -> str:
    name = alias or c
    ref = f"{prefix}{c}"
    return f"CAST({ref} AS DOUBLE) AS {name}" if c in DECIMAL_COLS else f"{ref} AS {name}"


# --------------------------------------------------------------------- generic
def dup_key(df: DataFrame, keys: list[str], reason: str, where: Column | None = None,
            count_col: str = "duplicate_count") -> DataFrame:
    """Keys that occur more than once: ``keys..., count_col, failure_reason``."""
    if where is not None:
        df = df.filter(where)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1)
            .withColumn("failure_reason", F.lit(reason)))


def null_check(df: DataFrame, key: str, columns: list[str], table_name: str,
               key_alias: str = "row_id") -> DataFrame:
    """One row per (row, NULL column) from a single scan of ``df``."""
    flags = F.array(*[F.when(F.col(c).isNull(), F.lit(f"{c} NULL")) for c in columns])
    return (df.select(F.col(key).alias(key_alias), F.explode(F.array_compact(flags)).alias("failure_reason"))
            .select(F.lit(table_name).alias("table_name"), "failure_reason", key_alias))


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str, out_cols: list[str],
            reason: str, allow_null: bool = False) -> DataFrame:
    """Child rows whose foreign key has no parent row (NULL reported unless allowed)."""
    if allow_null:
        child = child.filter(F.col(fk).isNotNull())
    p = parent.select(F.col(pk).alias("__pk"))
    return (child.join(p, child[fk] == p["__pk"], "left_anti")
            .select(*out_cols, F.lit(reason).alias("failure_reason")))


def fused_row_rules(df: DataFrame, table_name: str, key: str, rules: list["RowRule"]) -> DataFrame:
    """All row-local rules of one table in one scan -> (test_id, table_name, row_id, failure_reason)."""
    hits = F.array(*[F.when(F.expr(r.pred), F.struct(F.lit(r.test_id).alias("test_id"),
                                                      F.lit(r.reason).alias("failure_reason")))
                     for r in rules])
    return (df.select(F.col(key).cast("string").alias("row_id"), F.explode(F.array_compact(hits)).alias("h"))
            .select("h.test_id", F.lit(table_name).alias("table_name"), "row_id", "h.failure_reason"))


def spine_for(rel, tables):
    """``rel`` with a stored claim spine when more than two of ``tables`` derive from it (one write then costs less than the joins)."""
    return stored_spine(rel) if len(SPINE_RELATIONS.intersection(tables)) > 2 else rel


def placed(rel, tables, ids) -> tuple[list[DataFrame], tuple[str, ...]]:
    """The relations, and what their rows are dealt by where one of ``ids`` holds it in all of them (:func:`dealt`)."""
    tables = list(tables)
    if DEALT_IDS.intersection(ids) and DEALT_RELATIONS.issuperset(tables):
        return dealt(rel, *tables)
    return [getattr(rel, t) for t in tables], ()


def when(where: str | None) -> Column:
    return F.expr(where) if where else F.lit(True)


def orphan_counts(rel, rules: list["FkRule"]) -> DataFrame:
    """(test_id, table_name, violation_count): orphans of each rule, 0 too.

    Rules that look for one kind of key (``pk``) share one aggregate by key: children are counted for each rule, parents
    set the rule's bit, and children of a key without the bit are orphans, as are those without a key.
    """
    out = None
    for kind in dict.fromkeys(r.pk for r in rules):
        mine = [r for r in rules if r.pk == kind]
        sides = list(dict.fromkeys([(r.child, r.fk) for r in mine] + [(r.parent, r.pk) for r in mine]))
        relations, by = placed(rel, dict.fromkeys(t for t, _ in sides), [kind])
        tables, every = dict(zip(dict.fromkeys(t for t, _ in sides), relations, strict=True)), None
        for table, column in sides:
            key = F.col(column)
            counts = [F.when((when(r.child_where) & (key.isNotNull() | F.lit(not r.allow_null))) if (r.child, r.fk) == (table, column) else F.lit(False), F.lit(1))
                      .otherwise(0).cast("long").alias(f"_c{i}") for i, r in enumerate(mine)]
            bits = F.lit(0).cast("long")
            for i, r in enumerate(mine):
                if (r.parent, r.pk) == (table, column):
                    bits = bits.bitwiseOR(F.when(when(r.parent_where) & key.isNotNull(), F.lit(1 << i)).otherwise(0).cast("long"))
            side = tables[table].select(*by, key.cast("string").alias("_k"), bits.alias("_parents"), *counts)
            every = side if every is None else every.unionByName(side)
        keys = every.groupBy(*by, "_k").agg(F.bit_or("_parents").alias("_parents"), *[F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(mine))])
        sums = keys.agg(*[F.sum(F.when(F.col("_parents").bitwiseAND(F.lit(1 << i)) == 0, F.col(f"_c{i}")).otherwise(0)).alias(f"_c{i}") for i in range(len(mine))])
        rows = sums.select(F.explode(F.array(*[F.struct(F.lit(r.test_id).alias("test_id"), F.lit(r.child).alias("table_name"),
                                                        F.coalesce(F.col(f"_c{i}"), F.lit(0)).alias("violation_count")) for i, r in enumerate(mine)])).alias("r")).select("r.*")
        out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------- declarations
@dataclass(frozen=True)
class RowRule:
    """Row-local predicate on one relation.

    ``pred`` is SQL text valid in both Spark SQL and DuckDB (comparisons, IN,
    BETWEEN, IS NULL, AND/OR); ``duck_pred`` overrides it for the oracle when
    the dialects differ.  ``extra`` adds computed output columns as
    (name, spark_expr, duck_expr).
    """
    test_id: str
    table: str
    key: str
    cols: tuple
    pred: str
    reason: str
    duck_pred: str | None = None
    extra: tuple = ()

    def spark(self, rel) -> DataFrame:
        df = getattr(rel, self.table)
        out = [F.col(c) for c in (self.key, *self.cols)]
        out += [F.expr(s).alias(n) for n, s, _ in self.extra]
        return df.filter(F.expr(self.pred)).select(*out, F.lit(self.reason).alias("failure_reason"))

    def sql(self) -> str:
        outs = [sql_out(c) for c in (self.key, *self.cols)] + [f"{d} AS {n}" for n, _, d in self.extra]
        return (f"SELECT {', '.join(outs)}, {q(self.reason)} AS failure_reason "
                f"FROM {self.table} WHERE {self.duck_pred or self.pred}")


def enum_rule(test_id, table, key, column, values, reason, not_null=False) -> RowRule:
    lst = ", ".join(q(v) for v in values)
    pred = f"{column} NOT IN ({lst})"
    if not_null:
        pred = f"{column} IS NOT NULL AND {pred}"
    return RowRule(test_id, table, key, (column,), pred, reason)


def range_rule(test_id, table, key, column, lo, hi, reason, nullable=True) -> RowRule:
    pred = f"{column} NOT BETWEEN {lo} AND {hi}"
    if nullable:
        pred = f"{column} IS NOT NULL AND {pred}"
    return RowRule(test_id, table, key, (column,), pred, reason)


@dataclass(frozen=True)
class DupRule:
    test_id: str
    table: str
    keys: tuple
    reason: str
    where: str | None = None
    count_col: str = "duplicate_count"

    def spark(self, rel) -> DataFrame:
        w = F.expr(self.where) if self.where else None
        return dup_key(getattr(rel, self.table), list(self.keys), self.reason, w, self.count_col)

    def count(self, rel) -> DataFrame:
        """(test_id, table_name, violation_count): keys that repeat."""
        (rows,), by = placed(rel, [self.table], self.keys)
        found = dup_key(rows, [*by, *self.keys], self.reason, when(self.where), self.count_col)
        return found.agg(F.count(F.lit(1)).alias("violation_count")).select(
            F.lit(self.test_id).alias("test_id"), F.lit(self.table).alias("table_name"), "violation_count")

    def sql(self) -> str:
        k = ", ".join(self.keys)
        where = f" WHERE {self.where}" if self.where else ""
        return (f"SELECT {k}, COUNT(*) AS {self.count_col}, {q(self.reason)} AS failure_reason "
                f"FROM {self.table}{where} GROUP BY {k} HAVING COUNT(*) > 1")


@dataclass(frozen=True)
class NullRule:
    """NULLs in mandatory columns of one or more tables: (table_name, failure_reason, row_id)."""
    test_id: str
    parts: tuple  # ((table, key, (cols...)), ...)

    def spark(self, rel) -> DataFrame:
        rel = spine_for(rel, [t for t, _, _ in self.parts])
        dfs = [null_check(getattr(rel, t), k, list(cs), t) for t, k, cs in self.parts]
        out = dfs[0]
        for d in dfs[1:]:
            out = out.unionByName(d)
        return out

    def sql(self) -> str:
        return " UNION ALL ".join(
            f"SELECT {q(t)} AS table_name, {q(c + ' NULL')} AS failure_reason, {k} AS row_id FROM {t} WHERE {c} IS NULL"
            for t, k, cs in self.parts for c in cs)


@dataclass(frozen=True)
class FkRule:
    """Orphan foreign keys (``left_anti``); ``parent_where`` filters the parent side."""
    test_id: str
    child: str
    fk: str
    parent: str
    pk: str
    out: tuple
    reason: str
    allow_null: bool = False
    child_where: str | None = None
    parent_where: str | None = None

    def spark(self, rel) -> DataFrame:
        c = getattr(rel, self.child)
        p = getattr(rel, self.parent)
        if self.child_where:
            c = c.filter(F.expr(self.child_where))
        if self.parent_where:
            p = p.filter(F.expr(self.parent_where))
        return orphans(c, p, self.fk, self.pk, list(self.out), self.reason, self.allow_null)

    def sql(self) -> str:
        conds = []
        if self.allow_null:
            conds.append(f"c.{self.fk} IS NOT NULL")
        if self.child_where:
            conds.append(f"({self.child_where})")
        pw = f" AND ({self.parent_where})" if self.parent_where else ""
        conds.append(f"NOT EXISTS (SELECT 1 FROM {self.parent} p WHERE p.{self.pk} = c.{self.fk}{pw})")
        outs = ", ".join(sql_out(o, prefix="c.") for o in self.out)
        return f"SELECT {outs}, {q(self.reason)} AS failure_reason FROM {self.child} c WHERE {' AND '.join(conds)}"


@dataclass
class Suite:
    """Ordered collection of declared rules."""
    rules: list = field(default_factory=list)

    def add(self, rule):
        self.rules.append(rule)
        return rule

    def row_rules_by_table(self) -> dict[str, list[RowRule]]:
        out: dict[str, list[RowRule]] = {}
        for r in self.rules:
            if isinstance(r, RowRule):
                out.setdefault(r.table, []).append(r)
        return out
