"""Include and exclude lists over ``database.table``."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.model import ROW_OPERATIONS


@dataclass(frozen=True)
class TableFilter:
    """Patterns are searched for anywhere in the name. Both lists empty: all tables. An exclude list alone keeps none, unless exclude_only_keeps_rest."""

    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    exclude_only_keeps_rest: bool = False

    def __post_init__(self) -> None:
        for p in (*self.include, *self.exclude):
            re.compile(p)  # a bad pattern is an error here, not in a task

    def keeps(self, key: Column) -> Column:
        if not self.include and not self.exclude:
            return F.lit(True)
        matches = lambda ps: reduce(Column.__or__, (key.rlike(p) for p in ps), F.lit(False))
        wanted = F.lit(self.exclude_only_keeps_rest) if not self.include else matches(self.include)
        return wanted & ~matches(self.exclude)


def table_key(database: str = "database", table: str = "table") -> Column:
    return F.concat_ws(".", F.col(database), F.col(table))


def tables_kept(df: DataFrame, rule: TableFilter) -> DataFrame:
    """Source filter: rows of tables that the rule keeps; the verdict is an expression that stays in the scan's stage."""
    return df.where(rule.keeps(table_key()))


@dataclass(frozen=True)
class Sink:
    name: str
    rule: TableFilter = field(default_factory=TableFilter)


def for_sink(ops: DataFrame, sink: Sink) -> DataFrame:
    """What a sink gets: row operations of its tables, and all markers; bare queries go to no sink."""
    return ops.where(F.col("op") != "query").where(~F.col("op").isin(*ROW_OPERATIONS) | sink.rule.keeps(table_key()))


def fan_out(ops: DataFrame, sinks: list[Sink]) -> DataFrame:
    """One branch for each configured sink, by name; a later sink of the same name takes the earlier one's place."""
    named = {s.name: s for s in sinks}
    wanted = F.array_compact(F.array(*(F.when(~F.col("op").isin(*ROW_OPERATIONS) | s.rule.keeps(table_key()), F.lit(s.name)) for s in named.values())))
    return ops.where(F.col("op") != "query").withColumn("sink", F.explode(wanted))
