"""Names for helper columns that no column of the input has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """The names, behind more underscores than any column of the frame begins with."""
    had = max([0, *(len(c) - len(c.lstrip("_")) for c in frame.columns)])
    return ["_" * (had + 1) + x for x in names]
