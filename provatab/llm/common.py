"""What the operators share: the folder every executor sees, tables written once, Arrow batches, text rules."""

from __future__ import annotations

import os
import pathlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space and the letters that the text rules name.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors see.

    Only a local session without that setting gets a temporary folder (kept in the session's own
    settings); on a cluster a missing setting is an error, since local disks are not shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, besides what their own path names."""
    root = str(pathlib.Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut, safe against lost executors."""
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True for the rows no label may be learned from: crc32 of the id as text, modulo ``folds``, is ``fold``."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def text_key(text: Column) -> Column:
    """Stands beside the id, so that rows sharing an id (or having none) are told apart by their text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Each batch in runs of rows whose text is about ``most_bytes`` at most (one longer text makes its own run)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


class Kept(dict):
    """Results a worker keeps: two generations of ``size`` entries, the older of which goes when both are full.

    ``kept[key]`` makes what isn't there; what long keys stand for is made anew each time.
    """

    def __init__(self, size: int, make: Callable | None = None, longest: int = 64) -> None:
        super().__init__()
        self.size, self.make, self.longest, self.old = size, make, longest, {}

    def __missing__(self, key):
        value = self.recall(key)
        if value is None:
            value = self.make(key)
            self.put(key, value)
        return value

    def recall(self, key):
        """The value of an older entry, made young again; None without one."""
        value = self.old.pop(key, None)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = value
