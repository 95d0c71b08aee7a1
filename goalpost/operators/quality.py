"""Declarative data-quality rules evaluated in one Spark action (Q1-Q10).

Rules are data (``Rule``); ``evaluate`` compiles a whole rule set into one
plan that yields one small report row per rule:

* row rules (nulls, range, domain, custom predicate) are ``count_if``
  expressions computed in the same aggregation;
* each duplicate rule groups by its key once (partial aggregation collapses
  hot keys map-side) -- surplus rows = ``sum(n) - number of groups``;
* an orphan rule whose reference keys are proven few becomes a row rule too:
  the distinct keys are broadcast and every row gets a flag before the
  grouping, so nulls, range, domain, duplicates and orphans of a table cost
  one scan and one exchange;
* beyond that bound an orphan rule first counts fact rows per key, then
  anti-joins the *distinct* key counts with the distinct reference keys, so a
  hot key is a single row by the time it reaches the join.

The per-part one-row aggregates are combined with ``unionByName`` + ``sum``,
so the whole rule set costs one action that returns ``len(rules)`` rows.
``gate`` raises naming every failing error rule; warn rules are reported only.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from goalpost.operators.joins import DEFAULT_BROADCAST_ROWS, has_at_most

log = logging.getLogger("goalpost.quality")

ERROR = "error"
WARN = "warn"


class QualityError(ValueError):
    """Raised by ``gate`` when an error-severity rule has violations."""


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str
    columns: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    allowed: tuple = ()
    reference: DataFrame | None = field(default=None, compare=False)
    reference_columns: tuple[str, ...] = ()
    predicate: Column | None = field(default=None, compare=False)
    severity: str = ERROR


def _cols(columns: str | Sequence[str]) -> tuple[str, ...]:
    return (columns,) if isinstance(columns, str) else tuple(columns)


def nulls(name: str, columns: str | Sequence[str], severity: str = ERROR) -> Rule:
    """Rows where any listed column is null; an empty list counts 0 (Q1)."""
    return Rule(name, "nulls", _cols(columns), severity=severity)


def duplicates(name: str, columns: str | Sequence[str], severity: str = ERROR) -> Rule:
    """Surplus rows over the distinct key; null keys equal each other (Q2)."""
    return Rule(name, "duplicates", _cols(columns), severity=severity)


def orphans(name: str, columns: str | Sequence[str], reference: DataFrame,
            reference_columns: str | Sequence[str] | None = None, severity: str = ERROR) -> Rule:
    """Rows whose key is absent from ``reference``; a null key is an orphan (Q3)."""
    cols = _cols(columns)
    ref_cols = _cols(reference_columns) if reference_columns else cols
    return Rule(name, "orphans", cols, reference=reference, reference_columns=ref_cols, severity=severity)


def out_of_range(name: str, column: str, low: float, high: float, severity: str = ERROR) -> Rule:
    """Values outside ``[low, high]``; null passes, NaN fails (Q4)."""
    return Rule(name, "range", (column,), low=low, high=high, severity=severity)


def not_in(name: str, column: str, allowed: Iterable, severity: str = ERROR) -> Rule:
    """Values outside the allowed set; null passes, an empty set fails every row (Q5)."""
    return Rule(name, "domain", (column,), allowed=tuple(allowed), severity=severity)


def count_where(name: str, predicate: Column, severity: str = ERROR) -> Rule:
    """Rows matching a custom predicate (e.g. territory without a parent)."""
    return Rule(name, "predicate", predicate=predicate, severity=severity)


def violation(rule: Rule) -> Column:
    """The row-level predicate of a row rule."""
    if rule.kind == "nulls":
        if not rule.columns:
            return F.lit(False)
        return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in rule.columns])
    if rule.kind == "range":
        c = F.col(rule.columns[0])
        return (c < F.lit(rule.low)) | (c > F.lit(rule.high))
    if rule.kind == "domain":
        return ~F.col(rule.columns[0]).isin(*rule.allowed)
    if rule.kind == "predicate":
        return rule.predicate
    raise ValueError(f"{rule.kind} is not a row rule")


def _alias(i: int) -> str:
    return f"__r{i}"


def _reference(rule: Rule) -> DataFrame:
    """The distinct reference keys of an orphan rule, under the names of the checked columns."""
    return rule.reference.select(*[F.col(rc).alias(c) for rc, c in zip(rule.reference_columns, rule.columns)]).distinct()


def evaluate(df: DataFrame, rules: Sequence[Rule], max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """One-plan report: ``position, rule, severity, violations (bigint), failed (bool)``."""
    if not rules:
        raise ValueError("empty rule set")
    row_rules = [(i, r) for i, r in enumerate(rules) if r.kind in ("nulls", "range", "domain", "predicate")]
    dup_rules = [(i, r) for i, r in enumerate(rules) if r.kind == "duplicates"]
    orphan_rules, flags = [], []
    for i, r in enumerate(rules):
        if r.kind != "orphans":
            continue
        ref = _reference(r).withColumn(f"__has{i}", F.lit(True))
        if has_at_most(ref, max_broadcast_rows):
            df = df.join(F.broadcast(ref), list(r.columns), "left")
            flags.append(F.count_if(F.col(f"__has{i}").isNull()).alias(_alias(i)))
            row_rules.append((i, r))
        else:
            orphan_rules.append((i, r))
    row_counts = [F.count_if(violation(r)).alias(_alias(i)) for i, r in row_rules if r.kind != "orphans"] + flags

    parts: list[DataFrame] = []
    if dup_rules:
        # The first duplicate key carries the row rules through its grouping.
        i0, r0 = dup_rules[0]
        grouped = df.groupBy(*r0.columns).agg(F.count(F.lit(1)).alias("__n"), *row_counts)
        parts.append(grouped.agg(
            (F.sum("__n") - F.count(F.lit(1))).alias(_alias(i0)),
            *[F.sum(_alias(i)).alias(_alias(i)) for i, _ in row_rules]))
        for i, r in dup_rules[1:]:
            g = df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("__n"))
            parts.append(g.agg((F.sum("__n") - F.count(F.lit(1))).alias(_alias(i))))
    elif row_counts:
        parts.append(df.agg(*row_counts))

    for i, r in orphan_rules:
        per_key = df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("__n"))
        ref = _reference(r)
        # both sides are distinct keys by now: Spark's size threshold / AQE pick the join
        missing = per_key.join(ref, list(r.columns), "left_anti")
        parts.append(missing.agg(F.sum("__n").alias(_alias(i))))

    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    wide = wide.agg(*[F.sum(_alias(i)).alias(_alias(i)) for i in range(len(rules))])
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
                 F.coalesce(F.col(_alias(i)), F.lit(0)).cast("bigint").alias("violations"))
        for i, r in enumerate(rules)
    ]
    return (wide.select(F.inline(F.array(*entries)))
                .withColumn("failed", (F.col("severity") == ERROR) & (F.col("violations") > 0)))


def summary(rows: Sequence[Row]) -> str:
    """Violated rules with their counts, then how many rules held."""
    broken = [f"{r.violations} x {r.rule}" for r in rows if r.violations]
    return "; ".join([*broken, f"{len(rows) - len(broken)} of {len(rows)} rules hold"])


def gate(table: str, report: DataFrame | Sequence[Row]) -> list[Row]:
    """Collect the (small) report, log it, raise ``QualityError`` naming all failing error rules."""
    rows = sorted(report.collect() if isinstance(report, DataFrame) else report, key=lambda r: r.position)
    for severity, level in ((ERROR, logging.INFO), (WARN, logging.WARNING)):
        of = [r for r in rows if r.severity == severity]
        if of:
            log.log(level, "%s (%s): %s", table, severity, summary(of))
    broken = [r for r in rows if r.severity == ERROR and r.violations > 0]
    if broken:
        raise QualityError(f"{table} was not written. {summary(broken)}")
    return rows


def check(table: str, df: DataFrame, rules: Sequence[Rule]) -> list[Row]:
    """``gate(table, evaluate(df, rules))`` -- one action for the whole rule set."""
    return gate(table, evaluate(df, rules))
