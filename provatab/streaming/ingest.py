"""Incremental discovery of new manifests: the polled listing as a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provatab.sources.schemas import MANIFESTS


def new_manifests(spark: SparkSession, folder: str, schema: str = MANIFESTS) -> DataFrame:
    """Stream of manifests that appeared in a folder, one JSON object per line."""
    return spark.readStream.schema(schema).json(folder).withColumn("source_key", F.col("_metadata.file_path"))


def ingest_new(stream: DataFrame, state: str, apply: Callable[[DataFrame, int], None]) -> None:
    """Hand everything new to ``apply`` in batches and stop; ``state`` remembers what was seen.

    A batch may be replayed after a failure, so ``apply`` must be an upsert.
    """
    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", state).foreachBatch(apply).start()
    query.awaitTermination()
