"""Incremental load as a file stream.

The stream's checkpoint knows which files are loaded, so it stands in for the
watermark. Every micro-batch becomes the next batch of the merged table (see
``plans.load``). It is known by the stream's id, which Spark keeps in the checkpoint,
and its epoch: one that was committed before is not loaded again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakeferry.model import MergeSpec
from lakeferry.plans.load import load_epoch


def stream_merge(
    spark: SparkSession,
    in_dir: str,
    target: str,
    spec: MergeSpec,
    checkpoint: str,
    schema: StructType | str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Load the files that are new in ``in_dir`` (a directory or glob), then end."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def apply(batch: DataFrame, epoch: int) -> None:
        # Written before the first batch, and gone with the checkpoint.
        identity = spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
        load_epoch(batch, target, spec, identity, epoch)

    return (
        reader.parquet(in_dir)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
