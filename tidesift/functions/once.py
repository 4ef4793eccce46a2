"""Computing a costly column once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` for costly expressions that a later filter may look at.

    Catalyst moves a filter below the projection that makes its column, with the
    whole expression in it, which is then computed for the filter and again for
    the rows. It does not move one below a generator; this one makes one row.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*[c for c in df.columns if c not in columns], F.inline(F.array(row)))
