"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import string
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_GROUP_BYTES = 8 << 20
# Text bytes that one step inside a task holds as numpy arrays.
STEP_BYTES = 1 << 20


# Rows that go to Python at once: they may hold whole texts, and both sides keep a batch.
FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. From here on the session sends few rows at once to Python."""
    for key, value in FEW_ROWS.items():
        spark.conf.set(key, value)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new path in the folder that the cluster shares for intermediate data.

    Without ``spark.checkpoint.dir`` (tests on one machine) it lies in the session's
    warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/roadevents-llm/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, no lineage."""
    return Scratch(df.sparkSession, purpose).write(df, "table")


class Scratch:
    """Tables of intermediate data under one new path in the shared folder."""

    # Shuffle files of a finished write are of no more use.
    SETTINGS = FEW_ROWS | {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.path = spark, shared_path(spark, purpose)

    def write(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        """``df`` computed once and read back."""
        path, conf = f"{self.path}/{name}", self.spark.conf
        before = {key: conf.get(key, None) for key in self.SETTINGS}
        for key, value in self.SETTINGS.items():
            conf.set(key, value)
        try:
            # Small row groups: a writer holds one of them in memory.
            writer = df.write.option("parquet.block.size", ROW_GROUP_BYTES)
            writer.parquet(path, compression=compression)
        finally:
            for key, value in before.items():
                conf.unset(key) if value is None else conf.set(key, value)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Removes tables that nothing reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def steps(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of ``column``, a row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = int(np.searchsorted(ends, before + limit, side="right"))
            last = max(last, first + 1)
            yield batch.slice(first, last - first)
            first = last


_held: dict[str, object] = {}


def worker_cache(name: str, make: Callable[[], object]):
    """What an operator keeps in a worker process from task to task.

    A worker holds one such thing at a time: another operator's makes room for it, and
    its memory goes back to the system.
    """
    if name not in _held:
        if _held:
            _held.clear()
            gc.collect()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)
        _held[name] = make()
    return _held[name]


def no_worker_cache() -> None:
    """For operators that keep nothing: what others have kept goes."""
    worker_cache("nothing", object)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
