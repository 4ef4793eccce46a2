"""Continuous scoring of arriving texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidesift.operators.scoring import Route, Scorer, route_by_model
from tidesift.sources.scratch import scratch_path


def read_requests(
    spark: SparkSession, path: str, schema: StructType, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def score_stream(requests: DataFrame, scorers: dict[str, Scorer | Route], sink: str, checkpoint: str, id_col: str = "doc_id"):
    """Score all requests there are and append the results to a Parquet folder.

    The job keeps no state; the checkpoint and the file sink's log make each
    request appear once, also after a restart.
    """
    scored = route_by_model(requests, scorers, id_col)
    return (
        scored.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )


def score_batches(requests: DataFrame, scorers: dict[str, Scorer | Route], sink: str, checkpoint: str, id_col: str = "doc_id"):
    """``score_stream`` with dictionaries of any size, whose joins regroup texts: each batch is scored as a table.

    A batch is written once to the shared folder, since its texts are read for the lookup and again for its result.
    Results lie in one folder a batch, named by the batch's number: a batch that is repeated after a failure replaces
    its own folder, so each request appears once. ``read_scored`` reads them.
    """
    spark = requests.sparkSession

    def score(batch: DataFrame, number: int) -> None:
        path = scratch_path(spark, "batch")
        batch.write.parquet(path)
        rows = spark.read.schema(batch.schema).parquet(path)
        route_by_model(rows, scorers, id_col).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return requests.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_scored(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink).drop("batch")
