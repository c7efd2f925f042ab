"""Declared constraints audited over whole tables: one row per violation.

Rules on single rows (not null, allowed values, checks) of a table share one
scan.  Keys are counted with partial aggregation.  References compare distinct
values: a table's own values are reduced before the shuffle, and only those
without a referent are looked up again in its rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ["tbl", "rule", "row_key", "value"]


@dataclass(frozen=True)
class Rules:
    """What a table declares.

    ``key``: columns that name a row in the report; ``one_of``: allowed values
    (null passes); ``unique``: sets of columns (rows with a null in one don't
    count, as in SQL); ``refers``: columns to (table, columns) (null passes);
    ``checks``: name to a condition, which null passes.
    """

    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    one_of: dict[str, tuple] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()
    refers: dict[tuple[str, ...], tuple[str, tuple[str, ...]]] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)


def _text(columns: Iterable[str]) -> Column:
    """Columns as one text, nulls as the word null."""
    return F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")) for c in columns])


def _report(rows: DataFrame, table: str, rule: str, key: Column, value: Column) -> DataFrame:
    return rows.select(F.lit(table).alias("tbl"), F.lit(rule).alias("rule"), key.alias("row_key"), value.alias("value"))


def row_violations(df: DataFrame, table: str, rules: Rules) -> DataFrame:
    """Violations of the rules on single rows, in one scan."""
    col = lambda c: F.col(f"`{c}`")
    hit = lambda broken, rule, value: F.when(broken, F.struct(F.lit(rule).alias("rule"), value.cast("string").alias("value")))
    found = [hit(col(c).isNull(), f"not_null({c})", F.lit(None)) for c in rules.not_null]
    found += [hit(col(c).isNotNull() & ~col(c).isin(*words), f"one_of({c})", col(c)) for c, words in rules.one_of.items()]
    found += [hit(~F.expr(condition), f"check({name})", F.lit(None)) for name, condition in rules.checks.items()]
    broken = df.select(_text(rules.key).alias("row_key"), F.explode(F.filter(F.array(*found), lambda h: h.isNotNull())).alias("h"))
    return broken.select(F.lit(table).alias("tbl"), "h.rule", "row_key", "h.value")


def duplicates(df: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    """One row per key that stands more than once; the value is how often."""
    counted = df.select(*columns).dropna().groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return _report(counted, table, f"unique({','.join(columns)})", _text(columns), F.col("_n").cast("string"))


def dangling(df: DataFrame, parent: DataFrame, table: str, key: tuple[str, ...], columns: tuple[str, ...], target: str, target_columns: tuple[str, ...]) -> DataFrame:
    """One row per row whose reference has no referent; the value is the reference."""
    known = parent.select(*[F.col(f"`{t}`").alias(c) for c, t in zip(columns, target_columns)])
    orphans = df.select(*columns).dropna().distinct().join(known, list(columns), "left_anti")
    rows = df.select(*dict.fromkeys((*key, *columns))).join(orphans, list(columns), "left_semi")
    return _report(rows, table, f"refers({','.join(columns)}->{target})", _text(key), _text(columns))


def violations(tables: dict[str, DataFrame], declared: dict[str, Rules]) -> DataFrame:
    """tbl, rule, row_key and value of every violation in the declared tables.

    A table or column that is declared but not given raises, as the audit would
    otherwise pass by looking away.
    """
    found = []
    for name, rules in declared.items():
        df = tables[name]
        if rules.not_null or rules.one_of or rules.checks:
            found.append(row_violations(df, name, rules))
        found += [duplicates(df, name, columns) for columns in rules.unique]
        found += [dangling(df, tables[target], name, rules.key, columns, target, theirs) for columns, (target, theirs) in rules.refers.items()]
    return reduce(DataFrame.unionAll, found)
