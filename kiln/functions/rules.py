"""Row-level rules as ``Column`` expressions (CASE labels, cost rules).

A Python UDF in place of such a rule would hide the predicate from Catalyst (no pushdown,
a ``BatchEvalPython`` node per row batch), so each is a plain expression and a
"named function" is a Python function ``Column -> Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quantity bands and their open bounds: 10, 25 and 40, negatives and NULL fall to 'edge'.
BANDS = (("bulk", 40, None), ("large", 25, 40), ("medium", 10, 25), ("small", 0, 10))
NO_QUANTITY, EDGE = "none", "edge"
LIST_PRICE, REDUCED = "list", "reduced"
LIST_LIMIT = 0.04

# Usage cost rule.
COST_THRESHOLD = 750
HIGH_USAGE_RATE = 0.15
LOW_USAGE_RATE = 0.50


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def quantity_band(quantity: Column | str) -> Column:
    """Six-arm band of a quantity; bounds are open, so a quantity on a bound is 'edge'."""
    q = _c(quantity)
    out = F.when(q == 0, NO_QUANTITY)
    for label, low, high in BANDS:
        out = out.when((q > low) & (q < high) if high else q > low, label)
    return out.otherwise(EDGE)


def quantity_band_sql(quantity: str) -> str:
    """The same rule as SQL text."""
    arms = [f"WHEN {quantity} = 0 THEN '{NO_QUANTITY}'"]
    for label, low, high in BANDS:
        test = f"{quantity} > {low}" + (f" AND {quantity} < {high}" if high else "")
        arms.append(f"WHEN {test} THEN '{label}'")
    return f"CASE {' '.join(arms)} ELSE '{EDGE}' END"


def price_status_sql(discount: str) -> str:
    """Two-arm status; a NULL discount is 'reduced' (the CASE falls through)."""
    return f"CASE WHEN {discount} <= {LIST_LIMIT} THEN '{LIST_PRICE}' ELSE '{REDUCED}' END"


def usage_cost(usage: Column | str) -> Column:
    """Cost of a usage figure: 15% above the threshold, 50% otherwise."""
    u = _c(usage)
    return F.when(u > COST_THRESHOLD, u * F.lit(HIGH_USAGE_RATE)).otherwise(u * F.lit(LOW_USAGE_RATE))


def high_usage(usage: Column | str, limit: int = 900) -> Column:
    """Named predicate: usage above ``limit``."""
    return _c(usage) > limit
