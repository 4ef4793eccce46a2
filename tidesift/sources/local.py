"""Tables from driver-side rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def local_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small table held in the plan: it needs no Python worker and no job to be read."""
    struct = StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(struct)
    arrow = to_arrow_schema(struct)
    table = pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, struct)
