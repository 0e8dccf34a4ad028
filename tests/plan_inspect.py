"""Plan inspection helpers used by tests and when tuning: the formatted physical plan as text."""
from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, pattern: str) -> int:
    """Operators in the physical plan tree whose line matches ``pattern`` (e.g. 'Exchange hashpartitioning')."""
    text = plan_text(df, "simple")
    tree = text.split("== Physical Plan ==")[-1]
    return len(re.findall(pattern, tree))


def python_nodes(df: DataFrame) -> list[str]:
    text = plan_text(df, "simple")
    return [n for n in PYTHON_NODES if n in text]
