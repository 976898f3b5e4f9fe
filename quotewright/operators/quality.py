"""Declarative data-quality checks.

Every check yields a failing and a checked count, and none needs a join. Row rules
and checked counts of one table share one aggregate over one scan. Checks on keys
state what each of their tables counts per key; all checks on the same key columns
then share one grouped aggregate over the union of those counts. Counts combine
map-side, so a hot key is one row per task.

Predicates are SQL text and count rows where they are true.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]
ABOUT = ("check_name", "table_name", "severity", "description")


class Count(NamedTuple):
    """Per key: the sum of ``value`` over the rows of ``table`` where ``where``."""

    table: str
    where: str = "true"
    value: str = "1"


@dataclass(frozen=True)
class Check:
    """Base of all kinds. ``rows`` restricts the checked rows of ``table``."""

    name: str
    table: str
    severity: str
    description: str
    rows: str = "true"


@dataclass(frozen=True)
class RowRule(Check):
    """Rows of the table where ``fails`` is true."""

    fails: str = "false"


@dataclass(frozen=True)
class KeyCheck(Check):
    """Base of the checks on keys.

    ``counts`` are summed per key. ``failing`` and ``checked`` aggregate over the
    keys; they get the sums in that order (NULL where a key has no such row) and
    whether a key column is NULL. Checked rows None means: count ``rows``.
    """

    keys: tuple[str, ...] = ()

    def counts(self) -> tuple[Count, ...]:
        raise NotImplementedError

    def failing(self, sums: Sequence[Column], null_key: Column) -> Column:
        raise NotImplementedError

    def checked(self, sums: Sequence[Column]) -> Column | None:
        return None


@dataclass(frozen=True)
class Unique(KeyCheck):
    """Key values held by more than one row. NULL is a key value."""

    def counts(self):
        return (Count(self.table, self.rows),)

    def failing(self, sums, null_key):
        return F.count_if(sums[0] > 1)


@dataclass(frozen=True)
class ForeignKey(KeyCheck):
    """Rows without a row in ``parent`` sharing the key. A NULL key has none."""

    parent: str = ""

    def counts(self):
        return Count(self.table, self.rows), Count(self.parent)

    def failing(self, sums, null_key):
        rows, parents = sums
        return F.sum(F.when(parents.isNull() | null_key, rows))


@dataclass(frozen=True)
class JoinRule(KeyCheck):
    """Rows times the rows of ``other`` on their key where ``fails`` is true, as an
    inner join would give them."""

    other: str = ""
    fails: str = "false"

    def counts(self):
        return Count(self.table, self.rows), Count(self.other, self.fails)

    def failing(self, sums, null_key):
        rows, others = sums
        return F.sum(F.when(~null_key, rows * others))


@dataclass(frozen=True)
class DistinctForeignKey(KeyCheck):
    """Distinct keys of ``child`` missing from ``table``; checks those keys."""

    child: str = ""

    def counts(self):
        return Count(self.child), Count(self.table)

    def failing(self, sums, null_key):
        child, held = sums
        return F.count_if(child.isNotNull() & (held.isNull() | null_key))

    def checked(self, sums):
        return F.count(sums[0])


@dataclass(frozen=True)
class PairCount(KeyCheck):
    """Absolute difference between compared pairs and rows matching ``expected``."""

    pairs: str = ""
    expected: str = "true"

    def counts(self):
        return Count(self.pairs, value="pairs"), Count(self.table, self.expected)

    def failing(self, sums, null_key):
        pairs, rows = (F.coalesce(F.sum(s), F.lit(0)) for s in sums)
        return F.abs(pairs - rows)

    def checked(self, sums):
        return F.coalesce(F.sum(sums[0]), F.lit(0))


@dataclass(frozen=True)
class PairFlag(KeyCheck):
    """Pairs whose flag differs from the stored one, given by ``stored``."""

    pairs: str = ""
    stored: str = "false"

    def counts(self):
        return (
            Count(self.pairs, "is_flagged = 1", "pairs"),
            Count(self.pairs, "is_flagged = 0", "pairs"),
            Count(self.table, self.stored),
            Count(self.table, f"not coalesce({self.stored}, false)"),
        )

    def failing(self, sums, null_key):
        flagged, plain, stored, not_stored = (F.coalesce(s, F.lit(0)) for s in sums)
        return F.sum(flagged * not_stored + plain * stored)

    def checked(self, sums):
        flagged, plain = (F.coalesce(F.sum(s), F.lit(0)) for s in sums[:2])
        return flagged + plain


def _row(check: Check, failing: Column | None, checked: Column | None) -> Column:
    failing = F.lit(None) if failing is None else F.coalesce(failing, F.lit(0))
    checked = F.lit(None) if checked is None else checked
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.severity).alias("severity"),
        F.lit(check.description).alias("description"),
        failing.cast("bigint").alias("failing_count"),
        checked.cast("bigint").alias("checked_rows"),
    )


def _rows(df: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """The aggregates of ``rows`` over ``df``, one result row each."""
    return df.agg(F.array(*rows).alias("all")).select(F.inline("all"))


def _by_rows(table: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Row rules and checked counts of one table, in one scan."""

    def row(c: Check) -> Column:
        failing = F.count_if(F.expr(c.fails)) if isinstance(c, RowRule) else None
        return _row(c, failing, F.count_if(F.expr(c.rows)))

    return _rows(table, [row(c) for c in checks])


def _by_key(keys: tuple[str, ...], checks: Sequence[KeyCheck], tables: Tables) -> DataFrame:
    """All checks on the same key columns, in one grouped aggregate."""
    names: dict[Count, str] = {}
    for c in checks:
        for count in c.counts():
            names.setdefault(count, f"_{len(names)}")

    def part(table: str) -> DataFrame:
        mine = {count: n for count, n in names.items() if count.table == table}
        counted = reduce(or_, [F.expr(count.where) for count in mine])
        columns = [
            F.when(F.expr(count.where), F.expr(count.value).cast("bigint")).alias(n)
            for count, n in mine.items()
        ]
        return tables[table].where(counted).select(*keys, *columns)

    parts = [part(t) for t in dict.fromkeys(count.table for count in names)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    per_key = union.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names.values()])

    null_key = reduce(or_, [F.col(k).isNull() for k in keys], F.lit(False))
    rows = []
    for c in checks:
        sums = [F.col(names[count]) for count in c.counts()]
        rows.append(_row(c, c.failing(sums, null_key), c.checked(sums)))
    return _rows(per_key, rows)


def check_counts(checks: Sequence[Check], tables: Tables) -> DataFrame:
    """Name, table, severity, description, failing and checked count of every check."""
    by_key: dict[tuple[str, ...], list[KeyCheck]] = {}
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if isinstance(c, KeyCheck):
            by_key.setdefault(c.keys, []).append(c)
        if not isinstance(c, (DistinctForeignKey, PairCount, PairFlag)):
            by_table.setdefault(c.table, []).append(c)
    parts = [_by_key(keys, cs, tables) for keys, cs in by_key.items()]
    parts += [_by_rows(tables[name], cs) for name, cs in by_table.items()]
    # a check may have its failing count in one part and its checked count in another
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy(*ABOUT)
        .agg(F.max("failing_count").alias("failing_count"), F.max("checked_rows").alias("checked_rows"))
    )


def status_of(failing: str | Column, severity: str | Column) -> Column:
    """PASS at zero; else WARN for warn and FAIL for error. NULL is not zero."""
    f = F.col(failing) if isinstance(failing, str) else failing
    s = F.col(severity) if isinstance(severity, str) else severity
    return F.when(f == 0, "PASS").when(s == "warn", "WARN").otherwise("FAIL")


def as_results(counts: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """Result rows of a run out of ``check_counts``."""
    return counts.select(
        F.lit(run_id).alias("run_id"),
        "check_name",
        "table_name",
        "severity",
        status_of("failing_count", "severity").alias("status"),
        "failing_count",
        "checked_rows",
        "description",
        F.lit(at).cast("timestamp").alias("checked_at_utc"),
    )


def run_checks(checks: Sequence[Check], tables: Tables, run_id: str, at: datetime) -> DataFrame:
    return as_results(check_counts(checks, tables), run_id, at)


def status_tally(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


def not_passed(results: DataFrame) -> DataFrame:
    return results.where("status <> 'PASS'").select("check_name", "severity", "status", "failing_count")
