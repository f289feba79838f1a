"""Event patterns and data-driven rules, compiled to column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from weirworks.operators.ordered import Ordered, next_known, previous, scanned_by_key

MAX_RULES = 10_000  # a rule table is written by people; a larger one is refused, not cut


@dataclass(frozen=True)
class Rule:
    """When ``predicate`` (SQL text) holds, the rule gives the value of ``result`` (SQL text)."""

    rule_id: str
    predicate: str
    result: str


@dataclass(frozen=True)
class Pattern:
    """Predicates (SQL text) that consecutive rows of a key must meet."""

    name: str
    steps: tuple[str, ...]


def _small_table(df: DataFrame) -> list:
    found = df.limit(MAX_RULES + 1).collect()
    if len(found) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return found


def read_rules(table: DataFrame) -> list[Rule]:
    """Rules of a table (rule_id, predicate, result); read at query start or in each micro-batch."""
    return sorted((Rule(r.rule_id, r.predicate, r.result) for r in _small_table(table)), key=lambda r: r.rule_id)


def read_patterns(table: DataFrame) -> list[Pattern]:
    """Patterns of a table (name, step, predicate)."""
    steps: dict[str, list] = {}
    for r in _small_table(table):
        steps.setdefault(r.name, []).append((r.step, r.predicate))
    return [Pattern(name, tuple(p for _, p in sorted(s))) for name, s in sorted(steps.items())]


def holds(predicate: str) -> Column:
    """A predicate as column; unknown counts as false."""
    return F.coalesce(F.expr(predicate), F.lit(False))


def fired(rules: Sequence[Rule], active: Column | None = None) -> Column:
    """Array of (rule_id, result) of all rules that fire on a row."""
    def entry(rule: Rule) -> Column:
        when = holds(rule.predicate) if active is None else active & holds(rule.predicate)
        return F.when(when, F.struct(F.lit(rule.rule_id).alias("rule_id"), F.expr(rule.result).cast("string").alias("result")))

    return F.array_compact(F.array(*[entry(r) for r in rules]))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per firing rule, with ``rule_id`` and ``result``. One pass, no join."""
    return df.withColumn("__f", F.explode(fired(rules))).select(*df.columns, "__f.rule_id", "__f.result")


def apply_rule_versions(df: DataFrame, ts: str, versions: Sequence[tuple[str, Sequence[Rule]]]) -> DataFrame:
    """Rule sets that replace one another: each row meets the set in force at its time."""
    parts = []
    for i, (since, rules) in enumerate(versions):
        active = F.col(ts) >= F.lit(since).cast("timestamp_ntz")
        if i + 1 < len(versions):
            active = active & (F.col(ts) < F.lit(versions[i + 1][0]).cast("timestamp_ntz"))
        parts.append(fired(rules, active))
    return df.withColumn("__f", F.explode(F.concat(*parts))).select(*df.columns, "__f.rule_id", "__f.result")


def followed_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column, then: Column, then_value: Column, out: str, slices: int | None = None) -> DataFrame:
    """Every row meeting ``first`` with the value of the next later row meeting ``then``; unmatched rows drop."""
    scanned = Ordered(df, keys, order, slices).scan(**{out: next_known(F.when(then, then_value))}).result()
    return scanned.filter(first & F.col(out).isNotNull())


def match_patterns(df: DataFrame, keys: Sequence[str], order: Sequence[str], patterns: Sequence[Pattern], slices: int | None = None) -> DataFrame:
    """Rows that complete a pattern on consecutive rows of their key, with ``pattern``; all patterns in one pass per step."""
    depth = max(len(p.steps) for p in patterns)
    columns = list(df.columns)

    def matched(step: int, before: Column | None) -> Column:
        flags = []
        for i, p in enumerate(patterns):
            if step >= len(p.steps):
                flags.append(F.lit(False))
            else:
                here = holds(p.steps[step])
                flags.append(here if before is None else here & F.coalesce(F.get(before, F.lit(i)), F.lit(False)))
        return F.array(*flags)

    def steps(seq):
        seq = seq.with_column("__m0", matched(0, None))
        for step in range(1, depth):
            seq = seq.scan(__p=previous(f"__m{step - 1}")).with_column(f"__m{step}", matched(step, F.col("__p")))
        return seq

    names = [
        F.when(F.get(F.col(f"__m{len(p.steps) - 1}"), F.lit(i)), F.lit(p.name)) for i, p in enumerate(patterns)
    ]
    return scanned_by_key(df, keys, order, steps, slices).withColumn("pattern", F.explode(F.array_compact(F.array(*names)))).select(*columns, "pattern")
