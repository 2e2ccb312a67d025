"""Small helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mosaica.operators.lineage import checkpoint_dir, cut as checkpoint  # noqa: F401

SLICE_BYTES = 4 << 20  # of text that a task turns into Python objects at a time
_tables: list[str] = []  # paths that stored() wrote and nobody has dropped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """body(value), with the value computed once a row: lambdas would compute it again at every use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def row_key(id_col: str, text: Column) -> Column:
    """16 bytes that tell rows apart by id and text; a null id differs from every other."""
    shown = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("none"))
    return F.unhex(F.left(F.sha2(F.concat(shown, F.lit("\x00"), text), 256), F.lit(32)))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of rows whose texts take about `size` bytes together (one row may take more), so that Python
    objects exist for a few MB of text at a time however many rows Spark sends in a batch."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        low = 0
        while low < b.num_rows:
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + size, "right")))
            yield b.slice(low, high - low)
            low = high
    release_memory()


def release_memory() -> None:
    """Give what a task has freed back to the machine; else a reused worker holds on to the largest task it has seen."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of DataFrames that nobody holds any more; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


ROUTE_BITS, MOST_ROUTE_BITS = 24, 27  # bounds of a routing bitmap: 2**24 bits are 2 MB


def routing_bitmap(hashes: DataFrame, col: str):
    """Broadcast (bits, words): a bitmap of the leading bits of 64-bit hashes, to tell in a scan which rows may be among them. It has some 16 bits for each
    hash, within 2 and 16 MB; beyond, more rows hit than need be, so it only saves work, and an exact join must follow."""
    bits = max(ROUTE_BITS, min(MOST_ROUTE_BITS, int(hashes.count()).bit_length() + 4))
    at = F.shiftrightunsigned(col, 64 - bits)
    words = hashes.groupBy(F.shiftright(at, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({col}, {64 - bits}) & 63 as int))")).alias("b"))
    got = words.toPandas()
    bitmap = np.zeros(1 << (bits - 6), np.uint64)
    bitmap[got["w"].to_numpy(np.int64)] = got["b"].to_numpy(np.int64).view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast((bits, bitmap))


def routed(hashes: np.ndarray, route) -> np.ndarray:
    """Which of the hashes the bitmap has."""
    bits, bitmap = route.value
    at = hashes.astype(np.uint64) >> np.uint64(64 - bits)
    return ((bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def stored(df: DataFrame) -> DataFrame:
    """Materialise df as a table in the shared checkpoint folder: more compact than checkpoint(), same guarantee.
    drop_stored() removes such tables."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _tables.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written() -> int:
    """How many tables stored() has written so far; a mark for drop_stored()."""
    return len(_tables)


def drop_stored(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Remove the tables that stored() has written after the mark `since`, but for the `keep` latest. Only for tables that no pending
    DataFrame reads."""
    gone = _tables[since : len(_tables) - keep]
    del _tables[since : len(_tables) - keep]
    for path in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
