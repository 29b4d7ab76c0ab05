"""Turning a number or a label into another label by an ordered list of steps or a literal map."""

from __future__ import annotations

import operator
from typing import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.policy import Scale

_COMPARE = {"==": operator.eq, "<=": operator.le, "<": operator.lt}


def first_match(value: Column, steps: Sequence[tuple], otherwise) -> Column:
    """CASE over ``(comparison, bound, result)`` steps; NULL compares as unknown and falls through."""
    case = F
    for comparison, bound, result in steps:
        case = case.when(_COMPARE[comparison](value, F.lit(bound)), F.lit(result))
    return case.otherwise(F.lit(otherwise))


def label(value: Column, scale: Scale) -> Column:
    """Scale label of a unit count; an unknown count keeps an unknown label."""
    return F.when(value.isNotNull(), first_match(value, scale.steps, scale.otherwise))


def translate(key: Column, mapping: Mapping) -> Column:
    """Lookup in a small mapping; keys outside it give NULL.

    Written as CASE branches rather than a map literal: the branches compile into the stage's code,
    and comparisons on the result fold into them.
    """
    case = F
    for word, meaning in mapping.items():
        case = case.when(key == F.lit(word), F.lit(meaning))
    return case.otherwise(F.lit(None))
