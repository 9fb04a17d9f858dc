"""Plan inspection through the public ``explain`` API (used by tests and the bench notes)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame

PYTHON_UDF_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def plan_string(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def physical_operators(df: DataFrame) -> str:
    """The physical plan section only."""
    text = plan_string(df, "formatted")
    return text.split("\n\n", 1)[0]


def uses_python(df: DataFrame) -> bool:
    text = plan_string(df, "extended")
    return any(n in text for n in PYTHON_UDF_NODES)


def has_cartesian(df: DataFrame) -> bool:
    return "CartesianProduct" in plan_string(df, "formatted")
