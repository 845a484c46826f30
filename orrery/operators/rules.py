"""Data-quality rules as data: declared once, used in four ways.

* `RuleSet.counts(df)`     one row per rule with the number of bad rows
* `RuleSet.report(df)`     the same, brought to the driver as a Report
* `RuleSet.split(df)`      accepted rows and rejected rows (quarantine)
* `RuleSet.invalid_rows(df)`  one row per broken rule and row, for the log

All row rules and table rules of a set are counted in ONE aggregation over the
table; each key or reference rule adds one branch to the same Spark job.  A rule
that evaluates to NULL is not broken; missing values have a rule of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.measures import is_true
from orrery.operators.headers import missing_columns

ERROR, WARNING = "error", "warning"
COUNT_COLUMNS = ("rule", "severity", "bad_rows", "example")
_BROKEN = "broken_rules"


class RuleViolation(ValueError):
    """Raised when a table breaks a rule of severity `error`.

    `offenders` is a frame of all offending values, where the validator offers one.
    """

    offenders: DataFrame | None = None


# ------------------------------------------------------------------ rule kinds
@dataclass(frozen=True)
class RowRule:
    """`bad` is TRUE for a row that breaks the rule; `column` is the one to blame.

    A rule made by `must` also carries the plain condition in `ok`, which Catalyst
    can push down better than its negation.
    """

    name: str
    column: str
    bad: Column
    severity: str = ERROR
    ok: Column | None = None

    def holds(self) -> Column:
        return ~is_true(self.bad) if self.ok is None else self.ok


@dataclass(frozen=True)
class TableRule:
    """`bad` is an aggregate over the whole table: 0 when the rule holds."""

    name: str
    bad: Column
    severity: str = ERROR


@dataclass(frozen=True)
class UniqueRule:
    """No two rows share `keys`.

    `count` says what is reported: "keys" that occur twice or more, "rows" that
    share such a key, or "surplus" rows beyond the first.
    """

    name: str
    keys: tuple[str, ...]
    count: str = "keys"
    skip_null: bool = False
    severity: str = ERROR

    def repeated(self, df: DataFrame) -> DataFrame:
        """The keys that occur more than once; counted per task before the shuffle."""
        rows = df.select(*self.keys)
        if self.skip_null:
            rows = rows.dropna(subset=list(self.keys))
        return rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")

    def counts(self, df: DataFrame) -> DataFrame:
        measure = {
            "keys": F.count(F.lit(1)),
            "rows": F.coalesce(F.sum("n"), F.lit(0)),
            "surplus": F.coalesce(F.sum(F.col("n") - 1), F.lit(0)),
        }[self.count]
        shown = F.concat_ws(", ", *(F.col(k).cast("string") for k in self.keys))
        return self.repeated(df).agg(measure.alias("bad_rows"), F.min(shown).alias("example"))


@dataclass(frozen=True)
class ReferenceRule:
    """Every row's `columns` must occur in `parent` (same column names)."""

    name: str
    columns: tuple[str, ...]
    parent: DataFrame
    distinct: bool = False
    severity: str = ERROR

    def orphans(self, df: DataFrame) -> DataFrame:
        rows = df.select(*self.columns)
        if self.distinct:
            rows = rows.distinct()
        keys = self.parent.select(*self.columns)
        return rows.join(keys, list(self.columns), "left_anti")

    def counts(self, df: DataFrame) -> DataFrame:
        shown = F.concat_ws(", ", *(F.col(c).cast("string") for c in self.columns))
        return self.orphans(df).agg(
            F.count(F.lit(1)).alias("bad_rows"), F.min(shown).alias("example")
        )


@dataclass(frozen=True)
class SameSizeRule:
    """The table has as many rows as `parent` has different `columns`."""

    name: str
    columns: tuple[str, ...]
    parent: DataFrame
    severity: str = ERROR

    def counts(self, df: DataFrame) -> DataFrame:
        expected = self.parent.select(*self.columns).distinct().select(F.lit(-1).alias("w"))
        balance = df.select(F.lit(1).alias("w")).unionByName(expected)
        difference = F.abs(F.coalesce(F.sum("w"), F.lit(0)))
        return balance.agg(
            difference.alias("bad_rows"), F.lit(None).cast("string").alias("example")
        )


Rule = RowRule | TableRule | UniqueRule | ReferenceRule | SameSizeRule


# ---------------------------------------------------------------- rule makers
def must(name: str, column: str, ok: Column, **options) -> RowRule:
    """The condition has to be TRUE; FALSE and NULL both break the rule."""
    return RowRule(name, column, ~is_true(ok), ok=ok, **options)


def not_null(columns: Iterable[str], name: str = "{} is null", **options) -> list[RowRule]:
    return [RowRule(name.format(c), c, F.col(c).isNull(), **options) for c in columns]


def one_of(column: str, allowed: Iterable[str], name: str, **options) -> RowRule:
    return RowRule(name, column, ~F.col(column).isin(list(allowed)), **options)


def outside(column: str, low: float, high: float, name: str, **options) -> RowRule:
    return RowRule(name, column, ~F.col(column).between(low, high), **options)


# -------------------------------------------------------------------- results
@dataclass(frozen=True)
class Finding:
    rule: str
    severity: str
    bad_rows: int
    example: str | None = None

    def text(self) -> str:
        shown = "" if self.example is None else f": {self.example!r}"
        return f"{self.rule} ({self.bad_rows} rows){shown}"


@dataclass(frozen=True)
class Report:
    dataset: str
    row_count: int | None
    findings: list[Finding] = field(default_factory=list)

    def _broken(self, severity: str) -> list[Finding]:
        return [f for f in self.findings if f.severity == severity and f.bad_rows]

    @property
    def errors(self) -> list[str]:
        return [f.text() for f in self._broken(ERROR)]

    @property
    def warnings(self) -> list[str]:
        return [f.text() for f in self._broken(WARNING)]

    @property
    def passed(self) -> bool:
        return not self._broken(ERROR)

    def bad_rows(self, rule: str) -> int:
        return sum(f.bad_rows for f in self.findings if f.rule == rule)

    def raise_first(self) -> None:
        if not self.passed:
            raise RuleViolation(f"{self.dataset}: {self.errors[0]}")

    def raise_all(self) -> None:
        if not self.passed:
            raise RuleViolation(f"{self.dataset} validation failed: " + ", ".join(self.errors))

    def as_dict(self) -> dict:
        return {
            "passed": self.passed,
            "errors": self.errors,
            "warnings": self.warnings,
            "row_count": self.row_count,
        }


# ------------------------------------------------------------------- rule set
@dataclass(frozen=True)
class RuleSet:
    dataset: str
    columns: tuple[str, ...]
    rules: Sequence[Rule]
    types: dict[str, str] = field(default_factory=dict)

    def _of(self, kind) -> list:
        return [rule for rule in self.rules if isinstance(rule, kind)]

    # -- metadata
    def schema_findings(self, df: DataFrame) -> list[Finding]:
        """Missing columns, else wrong types; needs no Spark job."""
        missing = missing_columns(df, self.columns)
        if missing:
            return [Finding(f"{self.dataset}: missing required column(s): {missing}", ERROR, 1)]
        actual = dict(df.dtypes)
        return [
            Finding(f"{c} is {actual[c]}, expected {t}", ERROR, 1)
            for c, t in self.types.items()
            if actual[c] != t
        ]

    # -- counting
    def counts(self, df: DataFrame) -> DataFrame:
        """(rule, severity, bad_rows, example), one row per rule.

        Wrong columns or types are a single row, `schema`: no other rule can be
        evaluated then.
        """
        broken_schema = self.schema_findings(df)
        if broken_schema:
            entry = _entry("schema", ERROR, F.lit(len(broken_schema)), F.lit(broken_schema[0].rule))
            return df.sparkSession.range(1).select(F.inline(F.array(entry)))
        parts = [self._single_pass(df)]
        for rule in self._of((UniqueRule, ReferenceRule, SameSizeRule)):
            parts.append(
                rule.counts(df).select(
                    F.lit(rule.name).alias("rule"),
                    F.lit(rule.severity).alias("severity"),
                    F.col("bad_rows").cast("bigint").alias("bad_rows"),
                    "example",
                )
            )
        result = parts[0]
        for part in parts[1:]:
            result = result.unionByName(part)
        return result

    def _single_pass(self, df: DataFrame) -> DataFrame:
        """Row count, row rules and table rules from one scan of the table."""
        aggregates = [F.count(F.lit(1)).alias("n")]
        entries = [_entry("row_count", "info", F.col("n"))]
        for i, rule in enumerate(self.rules):
            if isinstance(rule, RowRule):
                blamed = F.col(rule.column).cast("string")
                aggregates += [
                    F.count_if(is_true(rule.bad)).alias(f"bad_{i}"),
                    F.min(F.when(rule.bad, blamed)).alias(f"example_{i}"),
                ]
                entries.append(
                    _entry(rule.name, rule.severity, F.col(f"bad_{i}"), F.col(f"example_{i}"))
                )
            elif isinstance(rule, TableRule):
                aggregates.append(rule.bad.cast("bigint").alias(f"bad_{i}"))
                entries.append(_entry(rule.name, rule.severity, F.col(f"bad_{i}")))
        return df.agg(*aggregates).select(F.inline(F.array(*entries)))

    def report(self, df: DataFrame) -> Report:
        """All rules of the set in one Spark job; one row per rule comes back."""
        broken_schema = self.schema_findings(df)
        if broken_schema:
            return Report(self.dataset, None, broken_schema)
        found = {row["rule"]: row for row in self.counts(df).collect()}
        findings = [
            Finding(r.name, r.severity, int(found[r.name]["bad_rows"]), found[r.name]["example"])
            for r in self.rules
        ]
        return Report(self.dataset, int(found["row_count"]["bad_rows"]), findings)

    # -- row level
    def accept(self, df: DataFrame) -> DataFrame:
        """Rows that break no row rule; a plain filter, nothing is shuffled."""
        conditions = [rule.holds() for rule in self._of(RowRule) if rule.severity == ERROR]
        return df.where(reduce(and_, conditions))

    def annotate(self, df: DataFrame, severity: str = ERROR) -> DataFrame:
        """Add `broken_rules`: (column_name, rule, invalid_value) of each broken rule.

        Key and reference rules take part: a row is marked when its key occurs more
        than once, or when its reference does not resolve.
        """
        rules = [r for r in self.rules if getattr(r, "severity", None) == severity]
        marks: list[tuple[str, str, Column]] = []
        marked = df
        helpers = []
        for i, rule in enumerate(rules):
            flag = f"__broken_{i}"
            if isinstance(rule, RowRule):
                marks.append((rule.name, rule.column, is_true(rule.bad)))
            elif isinstance(rule, UniqueRule):
                repeated = rule.repeated(df).select(*rule.keys, F.lit(True).alias(flag))
                marked = _flagged(marked, repeated, rule.keys, null_safe=True)
                marks.append((rule.name, rule.keys[0], F.col(flag).isNotNull()))
                helpers.append(flag)
            elif isinstance(rule, ReferenceRule):
                parent = rule.parent.select(*rule.columns).distinct()
                marked = _flagged(marked, parent.withColumn(flag, F.lit(True)), rule.columns)
                marks.append((rule.name, rule.columns[0], F.col(flag).isNull()))
                helpers.append(flag)
        broken = F.array(
            *(
                F.when(
                    bad,
                    F.struct(
                        F.lit(column).alias("column_name"),
                        F.lit(name).alias("rule"),
                        F.col(column).cast("string").alias("invalid_value"),
                    ),
                )
                for name, column, bad in marks
            )
        )
        return marked.withColumn(_BROKEN, F.array_compact(broken)).drop(*helpers)

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(accepted, rejected): every input row is in exactly one of the two."""
        return halves(self.annotate(df))

    def invalid_rows(self, df: DataFrame) -> DataFrame:
        """(dataset, column_name, rule, invalid_value), one row per broken rule."""
        return (
            self.annotate(df)
            .select(F.inline(_BROKEN))
            .select(F.lit(self.dataset).alias("dataset"), "column_name", "rule", "invalid_value")
        )

    def offenders(self, df: DataFrame, rule: str) -> DataFrame:
        """The different bad values of one row rule, with their row counts."""
        chosen = next(r for r in self._of(RowRule) if r.name == rule)
        return (
            df.where(chosen.bad)
            .groupBy(F.col(chosen.column).cast("string").alias("invalid_value"))
            .agg(F.count(F.lit(1)).alias("bad_rows"))
        )


def halves(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of what `RuleSet.annotate` gives."""
    clean = F.size(_BROKEN) == 0
    return annotated.where(clean).drop(_BROKEN), annotated.where(~clean)


def _flagged(
    df: DataFrame, marks: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Left join to at most one mark per key."""
    names = {key: f"__mark_{key}" for key in keys}
    marks = marks.withColumnsRenamed(names)
    same = [
        F.col(key).eqNullSafe(F.col(mark)) if null_safe else F.col(key) == F.col(mark)
        for key, mark in names.items()
    ]
    return df.join(marks, same, "left").drop(*names.values())


def _entry(name: str, severity: str, bad: Column, example: Column | None = None) -> Column:
    shown = F.lit(None).cast(T.StringType()) if example is None else example
    return F.struct(
        F.lit(name).alias("rule"),
        F.lit(severity).alias("severity"),
        F.coalesce(bad.cast("bigint"), F.lit(0).cast("bigint")).alias("bad_rows"),
        shown.alias("example"),
    )
