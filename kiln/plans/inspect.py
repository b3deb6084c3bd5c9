"""Plan and schema inspection (show plan / show schema as values).

``plan_text`` captures what ``DataFrame.explain`` prints, so tests and tools
can assert on pushed filters, exchanges and operators using the public API.
"""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints (modes: simple, extended,
    codegen, cost, formatted)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def exchange_count(df: DataFrame) -> int:
    """Shuffles in the physical plan (broadcasts excluded)."""
    text = plan_text(df, "simple")
    return sum(1 for line in text.splitlines() if "Exchange " in line and "BroadcastExchange" not in line)


def schema_text(df: DataFrame) -> str:
    """``printSchema`` output as a string."""
    return df.schema.treeString()
