"""Small helpers shared by the operators: Arrow text access, blocks, tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 21  # texts are handled in blocks of about this size, never cut


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark from whatever store holds it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """True on the quarter of the ids that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, one after another, and the offsets; null counts as empty."""
    col = col.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def blocks(off: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) whose texts have at most ``limit`` bytes together, or one row."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | dict | None], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch that returns columns by name."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    want = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            out = fn(b)
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in want], schema=want)

    return df.mapInArrow(run, schema)


class Shared:
    """An object that tasks get through a broadcast of its bytes, made once per task.

    Its class travels with it (pickled by value), so executors need no installation of this package.
    """

    def __init__(self, spark: SparkSession, obj):
        from pyspark import cloudpickle

        self.raw, self.made = spark.sparkContext.broadcast(cloudpickle.dumps(obj)), []

    @property
    def value(self):
        if not self.made:
            import pickle

            self.made.append(pickle.loads(self.raw.value))
        return self.made[0]
