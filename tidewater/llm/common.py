"""Helpers shared by the operators: table access, row keys, Arrow text buffers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package, write_table

#: Words of the contracts: maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: several readers see the same rows,
    and a lost executor costs at most the tasks that were running."""
    return write_table(df, name)


def hash_bucket(seed: int, bits: int, *cols: str | Column) -> tuple[Column, Column]:
    """A seeded 64-bit hash of the columns and its top ``bits`` bits as a bucket. Ordering by
    (bucket, hash) is a seeded shuffle whose ranges are known without sampling."""
    h = F.xxhash64(F.lit(seed), *cols)
    return h, F.shiftrightunsigned(h, 64 - bits).cast("int")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ready(spark: SparkSession) -> None:
    """Python workers can import this package."""
    ship_package(spark)


_KEPT: dict = {"stage": None}


def new_stage() -> None:
    """What a Python worker remembers (tokenizers, words, counts) belongs to one stage. Every task calls this first, so a
    worker that Spark uses again for another stage gives that memory back."""
    task = TaskContext.get()
    stage = task.stageId() if task else None
    if _KEPT["stage"] != stage:
        _KEPT.clear()
        _KEPT["stage"] = stage
        pa.default_memory_pool().release_unused()


def remembered(key: tuple, make: Callable):
    """``make()``, once per Python worker and stage."""
    new_stage()
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


# ------------------------------------------------------------------------------------------------
# Arrow text
# ------------------------------------------------------------------------------------------------
def utf8_buffer(arr) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its n+1 offsets; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks() if arr.num_chunks != 1 else arr.chunk(0)
        if isinstance(arr, pa.ChunkedArray):
            arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.large_string())
    if arr.null_count:
        arr = pc.fill_null(arr, "" if not (pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type)) else b"")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


#: True at the six ASCII white space bytes that separate words.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word of the texts, and the n+1 word offsets by text."""
    inside = ~IS_SPACE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def pieces(data: np.ndarray, off: np.ndarray, most: int = 1 << 20):
    """Runs of whole texts of about ``most`` bytes: (first text, last text + 1). A longer text is a run of its own."""
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_counts(df: DataFrame, text: str, keep: list[str], out: str) -> DataFrame:
    """``keep`` columns and the number of words of ``text`` (null: 0) as long, by one Arrow pass."""
    ready(df.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema) + f", `{out}` long"

    def count(batches):
        new_stage()
        for b in batches:
            data, off = utf8_buffer(b.column(b.num_columns - 1))
            n = np.zeros(b.num_rows, np.int64)
            for i, j in pieces(data, off):
                part = off[i:j + 1] - off[i]
                n[i:j] = np.diff(word_bounds(data[off[i]:off[j]], part)[2])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n)], names=[*keep, out])

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(count, schema)
