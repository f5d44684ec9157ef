"""Small helpers that the training-data operators share."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_dir

#: Code points of text that one step of a Python task works on at a time.
CHUNK_CHARS = 1_000_000


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` now and cut its lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back; the folder goes with the session.

    The shuffle files behind the table are not needed any more. Spark removes
    them when the driver collects its garbage, so this asks for it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """At the end of a Python task: free memory that Arrow holds goes back, since workers live on into other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; other columns cannot clash with them."""
    return df.select(*(F.col(f"`{c}`").alias(name) for name, c in columns.items()))


def slices(batch: pa.RecordBatch, column: str, most: int = CHUNK_CHARS) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Consecutive rows of ``batch`` with about ``most`` code points of text (nulls as empty strings)."""
    sizes = pc.fill_null(pc.utf8_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes + 1) - 1) // most
    edges = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), batch.num_rows]
    for begin, end in zip(edges[:-1], edges[1:]):
        if end > begin:
            part = batch.slice(begin, end - begin)
            yield part, [t or "" for t in part.column(part.schema.get_field_index(column)).to_pylist()]
