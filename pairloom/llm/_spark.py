"""Small Spark helpers of this subpackage: lineage cuts, chunked Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 1 << 20


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder, so that a lost executor costs no recomputation.

    The folder is spark.checkpoint.dir; only in local mode, where it may be unset, a temporary one. The driver's garbage is
    collected then: its heap else grows to its limit with the plans and tasks of earlier steps, whose shuffle files stay meanwhile.
    """
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            import tempfile

            where = tempfile.mkdtemp(prefix="pairloom-checkpoint-")
        sc.setCheckpointDir(where)


def chunks(batches: Iterator[pa.RecordBatch], text: int = 1, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows whose texts hold about `size` bytes (one longer text is its own slice)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        lengths = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
        ends = np.cumsum(lengths)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def int_lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """A list<int64> column from flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64()))
