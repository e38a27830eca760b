"""Trace conformance: rules that select spans and assert on their attributes."""

from __future__ import annotations

import operator
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions import attributes

MATCHED_COUNT = "matched_spans"
COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "=": operator.eq,
    "!=": operator.ne,
    "<=": operator.le,
    ">=": operator.ge,
    ">": operator.gt,
}


@dataclass(frozen=True)
class Rule:
    """``selector`` are attribute equalities; the assertion compares one attribute, or the value at a
    JSON path inside it, with ``expected``. The attribute ``matched_spans`` asserts on the number of
    selected spans instead. ``name`` and ``kind`` address the span's own fields."""

    rule_id: str
    attribute: str
    op: str
    expected: str | int | float
    selector: Mapping[str, str] = field(default_factory=dict)
    json_path: str | None = None

    def __post_init__(self):
        if self.op != "contains" and self.op not in COMPARISONS:
            raise ValueError(f"unknown operator {self.op!r}")


def _value(key: str) -> Column:
    if key in ("name", "kind"):
        return F.col(key).cast("string")
    return attributes.attribute_text(F.col("attributes"), key)


def _keys(rules: Sequence[Rule]) -> list[str]:
    used = {k for r in rules for k in r.selector} | {r.attribute for r in rules if r.attribute != MATCHED_COUNT}
    return sorted(used)


def _compare(actual: Column, op: str, expected: str | int | float) -> Column:
    if op == "contains":
        return F.contains(actual, F.lit(str(expected)))
    if isinstance(expected, str):
        return COMPARISONS[op](actual, F.lit(expected))
    return COMPARISONS[op](actual.try_cast("double"), F.lit(float(expected)))


def _selected(rule: Rule, values: Mapping[str, Column]) -> Column:
    return reduce(
        operator.and_,
        (F.coalesce(values[k] == F.lit(v), F.lit(False)) for k, v in rule.selector.items()),
        F.lit(True),
    )


def _passes(rule: Rule, values: Mapping[str, Column]) -> Column:
    actual = values[rule.attribute]
    if rule.json_path:
        actual = F.get_json_object(actual, rule.json_path)
    return F.coalesce(_compare(actual, rule.op, rule.expected), F.lit(False))


def check(spans: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """Evaluate all rules in one pass: ``(*by, rule_id, matched, passed, ok)``.

    Rules are a short list written by people, so each becomes two conditional counts of a single
    aggregation; spans are never joined to rules, and each attribute is looked up once. ``by`` = ``["traceId"]`` checks every trace on its own.
    An attribute rule holds when all selected spans pass.
    """
    keys = _keys(rules)
    looked_up = spans.select(*by, *(_value(k).alias(f"_value_{i}") for i, k in enumerate(keys)))
    values = {k: F.col(f"_value_{i}") for i, k in enumerate(keys)}
    counts = []
    for i, rule in enumerate(rules):
        chosen = _selected(rule, values)
        counts.append(F.count_if(chosen).alias(f"matched_{i}"))
        if rule.attribute != MATCHED_COUNT:
            counts.append(F.count_if(chosen & _passes(rule, values)).alias(f"passed_{i}"))
    totals = looked_up.groupBy(*by).agg(*counts)
    verdicts = []
    for i, rule in enumerate(rules):
        matched = F.col(f"matched_{i}")
        if rule.attribute == MATCHED_COUNT:
            ok = _compare(matched.cast("string"), rule.op, rule.expected)
            passed = F.when(ok, matched).otherwise(F.lit(0).cast("bigint"))
        else:
            passed = F.col(f"passed_{i}")
            ok = passed == matched
        verdicts.append(
            F.struct(
                F.lit(rule.rule_id).alias("rule_id"),
                matched.alias("matched"),
                passed.alias("passed"),
                ok.alias("ok"),
            )
        )
    return totals.select(*by, F.inline(F.array(*verdicts)))
