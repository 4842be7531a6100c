"""Policy conditions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pednet.functions.normalize import normalize_categorical, parse_number
from pednet.policies.profiles import Condition


def applies(contexts: tuple[str, ...], kind: Column) -> Column:
    """Whether a rule holds for this kind of edge."""
    return kind.isin(*contexts) if contexts else F.lit(True)


def condition(c: Condition, field=F.col) -> Column:
    """True or false, never null (F13). field: how a field's name becomes a column."""
    x = field(c.field)
    if c.operator == "transition_pair":
        kerb, tactile = c.value
        test = F.exists(x, lambda s: (normalize_categorical(s["kerb"]) == kerb) & (normalize_categorical(s["tactile_paving"]) == tactile))
    elif c.operator == "equals" and isinstance(c.value, bool):
        test = x == F.lit(c.value)
    elif c.operator == "equals":
        test = normalize_categorical(x) == c.value
    elif c.operator == "in":
        test = normalize_categorical(x).isin(*c.value)
    elif c.operator == "contains":
        test = F.exists(x, lambda s: normalize_categorical(s) == c.value)
    else:
        n = parse_number(x)
        tests = {
            "lt": lambda: n < c.value,
            "lte": lambda: n <= c.value,
            "gt": lambda: n > c.value,
            "gte": lambda: n >= c.value,
            "abs_gt": lambda: F.abs(n) > c.value,
            "range": lambda: (n > c.low) & (n <= c.high),
            "abs_range": lambda: (F.abs(n) > c.low) & (F.abs(n) <= c.high),
            "negative_range": lambda: (n < 0) & (F.abs(n) > c.low) & (F.abs(n) <= c.high),
        }
        if c.operator not in tests:
            raise ValueError(f"unsupported condition operator: {c.operator}")
        test = tests[c.operator]()
    return F.coalesce(test, F.lit(False))
