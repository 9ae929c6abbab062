"""Sinks: promotion, keyed upserts, routed and partitioned tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from provatab.cluster import first_per_key


def promote_to_parquet(
    spark: SparkSession, source: str, target: str, *, schema=None, lines: bool = False, overwrite: bool = False, dry_run: bool = False
) -> int:
    """Raw JSON -> Parquet, one row out per row in; returns the number of rows.

    ``lines`` reads one object per line instead of one value per file. The rows written are
    counted while they are written and compared with what is read back.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    raw = reader.option("multiLine", not lines).option("mode", "FAILFAST").json(source)
    if dry_run:
        return raw.count()
    seen = Observation()
    (
        raw.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite" if overwrite else "errorifexists")
        .option("compression", "zstd")
        .parquet(target)
    )
    written = seen.get["rows"]
    stored = spark.read.parquet(target).count()
    if stored != written:
        raise RuntimeError(f"{target}: read {written} rows, stored {stored}")
    return stored


def upsert(
    base: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column] | Column, *, stamp: str | None = None
) -> DataFrame:
    """Last write wins. Inside the batch the last row by ``order`` wins, then the batch wins."""
    latest = first_per_key(batch, keys, order, last=True)
    if stamp:
        latest = latest.withColumn(stamp, F.current_timestamp())
    return base.join(latest.select(*keys), list(keys), "left_anti").unionByName(latest, allowMissingColumns=True)


def write_routed(df: DataFrame, path: str, by: Sequence[str], *, mode: str = "append") -> None:
    """One folder per route. Rows of a route spread over tasks, files are bounded in rows."""
    df.write.mode(mode).partitionBy(*by).option("maxRecordsPerFile", 5_000_000).parquet(path)


def write_tables(tables: Mapping[str, DataFrame], path: str, *, mode: str = "overwrite") -> None:
    """Fan one input out to several flat tables."""
    for name, table in tables.items():
        table.write.mode(mode).parquet(f"{path}/{name}")


RUN = ["entity", "document_id", "execution_id"]


def publish_run(validation: DataFrame, rows: DataFrame, audit: DataFrame, path: str, runs: DataFrame | None = None) -> None:
    """Validation report, resolved rows and audit of runs (``entity``, ``document_id``, ``execution_id``).

    Publishing a run again replaces that run in all three tables, where it has no rows left too; all other runs stay.
    ``runs`` names runs that have no rows in any of them. The tables are appended below a folder of this publication;
    the list that says which publication of a run counts is written last, so readers see a run whole or as before.
    """
    publication = uuid.uuid4().hex
    named = [df.select(*RUN) for df in (validation, rows, audit, *([] if runs is None else [runs]))]
    for name, table in (("validation", validation), ("resolved", rows), ("audit", audit)):
        table.sortWithinPartitions(*RUN).write.parquet(f"{path}/{name}/publication={publication}")
    keys = reduce(DataFrame.unionByName, named).distinct()
    known = keys.withColumns({"publication": F.lit(publication), "published_at": F.lit(time.time_ns())})
    known.write.mode("append").parquet(f"{path}/published")


def published(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Rows of table ``name`` (``validation``, ``resolved`` or ``audit``) from the last publication of each run."""
    table = spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")
    latest = spark.read.parquet(f"{path}/published").groupBy(*RUN).agg(F.max_by("publication", "published_at").alias("publication"))
    return table.withColumn("publication", F.col("publication").cast("string")).join(latest, [*RUN, "publication"], "left_semi").drop("publication")


def collection_stats(collections: Mapping[str, DataFrame], key: str = "document_id") -> DataFrame:
    """Record count and field list per document and collection."""
    parts = [
        df.groupBy(key).agg(F.count(F.lit(1)).alias("record_count")).select(
            key, F.lit(name).alias("collection"), "record_count", F.lit(",".join(df.columns)).alias("fields")
        )
        for name, df in collections.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def persist_bundle(collections: Mapping[str, DataFrame], path: str, key: str = "document_id") -> DataFrame:
    """One Parquet table per collection plus their statistics."""
    write_tables(collections, path)
    stats = collection_stats(collections, key)
    stats.write.mode("overwrite").parquet(f"{path}/collection_stats")
    return stats


def bronze_rows(rows: DataFrame, validation: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only rows of runs whose validation says compatible reach the bronze table."""
    admitted = validation.where(F.col("validation_status") == "compativel").select(*keys).distinct()
    return rows.join(admitted, list(keys), "left_semi")
