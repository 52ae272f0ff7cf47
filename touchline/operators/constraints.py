"""Rules that rows of a table must keep, checked together in few passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def name(self) -> str:
        return f"{self.column} is not null"

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Accepted:
    """Nulls are accepted; add NotNull if they should not be."""

    column: str
    values: Sequence[object]

    @property
    def name(self) -> str:
        return f"{self.column} is one of {', '.join(map(str, self.values))}"

    def broken(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class Within:
    """At least ``low`` and at most ``high``, either of which may be left out; nulls are fine."""

    column: str
    low: object = None
    high: object = None

    @property
    def name(self) -> str:
        sides = [f"{x} {y}" for x, y in (("at least", self.low), ("at most", self.high)) if y is not None]
        return f"{self.column} is {' and '.join(sides)}"

    def broken(self) -> Column:
        value, none = F.col(self.column), F.lit(False)
        below = none if self.low is None else value < F.lit(self.low)
        return below | (none if self.high is None else value > F.lit(self.high))


@dataclass(frozen=True)
class Unique:
    """No two rows agree in all ``columns``; rows with a null among them don't count."""

    columns: Sequence[str]

    @property
    def name(self) -> str:
        return f"{', '.join(self.columns)} is unique"


@dataclass(frozen=True)
class References:
    """Every value that is not null is in a column of another table."""

    column: str
    table: str
    key: str

    @property
    def name(self) -> str:
        return f"{self.column} is in {self.table}.{self.key}"


Rule = NotNull | Accepted | Within | Unique | References


def _of_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule and violations of all rules on single rows, with one pass over their columns."""
    counts = [F.count(F.when(rule.broken(), 1)).alias(f"n{i}") for i, rule in enumerate(rules)]
    named = [
        F.struct(F.lit(rule.name).alias("rule"), F.col(f"n{i}").alias("violations"))
        for i, rule in enumerate(rules)
    ]
    return df.agg(*counts).select(F.explode(F.array(*named)).alias("x")).select("x.*")


def _repeats(df: DataFrame, rule: Unique) -> DataFrame:
    """Rows beyond the first of each key; counted before the shuffle, so a hot key is one row a task."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.columns])
    copies = df.filter(known).groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("n"))
    found = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return copies.agg(F.lit(rule.name).alias("rule"), found.alias("violations"))


def _dangling(df: DataFrame, rule: References, other: DataFrame) -> DataFrame:
    """Rows whose value the other table lacks; values are counted before they are looked up."""
    values = df.filter(F.col(rule.column).isNotNull()).groupBy(F.col(rule.column).alias("value"))
    counted = values.agg(F.count(F.lit(1)).alias("n"))
    missing = counted.join(other.select(F.col(rule.key).alias("value")), "value", "left_anti")
    return missing.agg(
        F.lit(rule.name).alias("rule"), F.coalesce(F.sum("n"), F.lit(0)).alias("violations")
    )


def violations(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """table_name, rule and violations (rows that break it) of every rule of every table.

    All rules on single rows of a table are counted in one pass over just their columns. Keys
    and references take one grouping each. An empty table breaks no rule.
    """
    parts = []
    for name, of_table in rules.items():
        df = tables[name]
        by_row = [r for r in of_table if not isinstance(r, (Unique, References))]
        found = [_of_rows(df, by_row)] if by_row else []
        found += [_repeats(df, r) for r in of_table if isinstance(r, Unique)]
        found += [_dangling(df, r, tables[r.table]) for r in of_table if isinstance(r, References)]
        parts += [x.select(F.lit(name).alias("table_name"), "rule", "violations") for x in found]
    return reduce(DataFrame.unionByName, parts)


def assert_rules(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]]) -> None:
    """Raise with all rules that are broken and how often; one row for each rule is collected."""
    broken = violations(tables, rules).filter("violations > 0").collect()
    if broken:
        told = "; ".join(f"{r.table_name}: {r.rule} ({r.violations} rows)" for r in sorted(broken))
        raise ValueError(f"rules are broken: {told}")
