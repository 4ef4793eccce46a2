"""Small tables as constants inside an expression.

A dictionary lookup per token would normally explode the texts, join and group
them again: a shuffle of every token. When the dictionary is small, and that is
checked before use, it travels inside the plan as one constant instead, so that
a lookup is part of a projection and the texts never move. ``operators.joins``
holds the joins used for dictionaries over the bound.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, DataFrame, Row, functions as F

MAX_ENTRIES = 50_000
MAX_IN_LIST = 200


def read_small(table: DataFrame, limit: int = MAX_ENTRIES) -> list[Row] | None:
    """The rows of a table of at most ``limit`` rows, or None for a larger one."""
    rows = table.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


class LiteralMap:
    """A constant hash map from word to value, read by column expressions.

    Spark searches a map value entry by entry, so the entries are spread over an
    array of little maps by crc32, which Python and Spark compute alike.
    """

    def __init__(self, entries: dict, value_type: str):
        self.entries = {k: v for k, v in entries.items() if k is not None and v is not None}
        self.value_type = value_type
        self.size = max(1, len(self.entries))
        buckets: list[dict] = [{} for _ in range(self.size)]
        for key, value in self.entries.items():
            buckets[zlib.crc32(key.encode()) % self.size][key] = value
        self._constant = json.dumps(buckets, ensure_ascii=False)

    def get(self, key: Column) -> Column:
        """The value of ``key``, null where it has none."""
        buckets = F.from_json(F.lit(self._constant), f"array<map<string,{self.value_type}>>")
        slot = (F.crc32(key.cast("binary")) % F.lit(self.size)).cast("int")
        return F.element_at(F.get(buckets, slot), key)


class LiteralSet:
    """A constant set of words."""

    def __init__(self, words):
        self.words = sorted({w for w in words if w is not None})
        self._map = LiteralMap(dict.fromkeys(self.words, 1), "int") if len(self.words) > MAX_IN_LIST else None

    def contains(self, key: Column) -> Column:
        if not self.words:
            return F.lit(False)
        return key.isin(self.words) if self._map is None else self._map.get(key).isNotNull()


def small_map(table: DataFrame, key: str, value: str, limit: int = MAX_ENTRIES) -> LiteralMap | None:
    """The table as a constant map, or None where it is over the bound."""
    rows = read_small(table.select(key, value), limit)
    if rows is None:
        return None
    return LiteralMap({r[0]: r[1] for r in rows}, table.schema[value].dataType.simpleString())


def small_set(table: DataFrame, column: str, limit: int = MAX_ENTRIES) -> LiteralSet | None:
    """The column's values as a constant set, or None where they are over the bound."""
    rows = read_small(table.select(column), limit)
    return None if rows is None else LiteralSet(r[0] for r in rows)
