"""Decision trees of Spark ML as plain nodes, rules and column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = re.compile(r"(If|Else) \(feature (\d+) (<=|>) (-?[0-9.]+(?:E-?\d+)?)\)")
_LEAF = re.compile(r"Predict: (-?[0-9.]+(?:E-?\d+)?)")


def read_tree(model) -> tuple:
    """(feature, threshold, left, right) nodes and float leaves, from a tree model's printed form.

    Trees are grown on continuous features only, so each split is one threshold: left is at or below it.
    """
    lines = [x.strip() for x in model.toDebugString.split("\n")[1:] if x.strip()]
    at = 0

    def node():
        nonlocal at
        line = lines[at]
        at += 1
        if m := _LEAF.match(line):
            return float(m[1])
        m = _SPLIT.match(line)
        left = node()
        at += 1  # the matching Else line
        return (int(m[2]), float(m[4]), left, node())

    return node()


def paths(tree, taken: tuple = ()) -> list[tuple[tuple, float]]:
    """(conditions, value) of every leaf; a condition is (feature, "<=" or ">", threshold)."""
    if not isinstance(tree, tuple):
        return [(taken, tree)]
    feature, threshold, left, right = tree
    return paths(left, taken + ((feature, "<=", threshold),)) + paths(right, taken + ((feature, ">", threshold),))


def condition(rule: tuple, value: Callable[[int], Column]) -> Column:
    """Conjunction of a rule's conditions over ``value(feature)``."""
    out = None
    for feature, sign, threshold in rule:
        test = value(feature) <= F.lit(threshold) if sign == "<=" else value(feature) > F.lit(threshold)
        out = test if out is None else out & test
    return F.lit(True) if out is None else out


def predict(tree, value: Callable[[int], Column]) -> Column:
    """A tree's value as one nested CASE expression."""
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    feature, threshold, left, right = tree
    return F.when(value(feature) <= F.lit(threshold), predict(left, value)).otherwise(predict(right, value))
