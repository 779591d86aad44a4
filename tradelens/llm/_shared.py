"""Helpers that the operators of this package share: inputs, shared-folder
scratch tables, Arrow batch slicing, file access and piece memos."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Text bytes handled at once inside a task (also the size of emitted batches).
SLICE_BYTES = 4 << 20
#: Upper bound of one Arrow batch that the JVM sends to a Python worker.
ARROW_BYTES = "32m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches to Python workers are cut by bytes, not only by rows, so
    a run of very long texts cannot make one huge batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts
    the lineage, and a lost executor never repeats the work before it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(name: str = "text"):
    """The text column with null as the empty string."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows holding about ``limit`` bytes of ``column``
    (one longer row stands alone)."""
    if batch.num_rows == 0:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = int(size[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(size, done + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def split_uri(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file in the shared store."""
    return pafs.FileSystem.from_uri(uri)


class PieceMemo(dict):
    """piece -> bytes, computed on a miss by ``encode(pieces) -> list[bytes]``.

    Two generations bound the memory: when the young one holds ``cap`` pieces
    it becomes the old one and the previous old one is dropped, so frequent
    pieces stay. Pieces over ``longest`` characters are not kept.
    """

    def __init__(self, encode: Callable[[list[str]], list], cap: int = 350_000, longest: int = 80):
        super().__init__()
        self.encode, self.cap, self.longest, self.old = encode, cap, longest, {}

    def __missing__(self, piece: str):
        value = self.old.get(piece)
        if value is None:
            value = self.encode([piece])[0]
        self.keep(piece, value)
        return value

    def keep(self, piece: str, value) -> None:
        if len(piece) <= self.longest:
            if len(self) >= self.cap:
                self.old = dict(self)
                self.clear()
            self[piece] = value

    def learn(self, pieces: set[str], at_once: int = 4096) -> dict:
        """Encode all unknown pieces in batches; returns those not kept."""
        new = [p for p in pieces if p not in self and p not in self.old]
        rest = {}
        for i in range(0, len(new), at_once):
            part = new[i:i + at_once]
            for piece, value in zip(part, self.encode(part)):
                if len(piece) <= self.longest:
                    self.keep(piece, value)
                else:
                    rest[piece] = value
        return rest
