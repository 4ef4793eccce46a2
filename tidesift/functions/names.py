"""Names for columns that come and go inside an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, led by underscores until the table has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
