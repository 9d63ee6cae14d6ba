"""Detection rules and the per-interval settings looked up with a default."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podwatch import fixed_values as fv


@dataclass(frozen=True)
class Rule:
    label: str
    length_minutes: int
    threshold: int
    cooldown_minutes: int
    text: str


RULES = tuple(Rule(*row) for row in fv.RULE_ROWS)

RULE_SCHEMA = (
    "rule_order int, time_interval string, length_min int, threshold int, cooldown_min int, label string"
)


def rules_frame(spark: SparkSession, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rules as a table, one row per rule."""
    rows = [
        (order, r.label, r.length_minutes, r.threshold, r.cooldown_minutes, r.text)
        for order, r in enumerate(rules, start=1)
    ]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def _lookup(label: Column, pairs: list[tuple[str, object]], default: object) -> Column:
    expr = None
    for key, value in pairs:
        hit = label == key
        expr = F.when(hit, F.lit(value)) if expr is None else expr.when(hit, F.lit(value))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def cooldown_minutes(label: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Cooldown of an interval; 30 minutes for an unknown one."""
    return _lookup(label, [(r.label, r.cooldown_minutes) for r in rules], fv.DEFAULT_COOLDOWN_MINUTES)


def rule_text(label: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Display text of an interval; '1 hour' for an unknown one."""
    return _lookup(label, [(r.label, r.text) for r in rules], fv.DEFAULT_RULE_TEXT)


def rule_order(label: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Position of an interval in the output; unknown ones come last."""
    return _lookup(label, [(r.label, i) for i, r in enumerate(rules, start=1)], len(rules) + 1)
