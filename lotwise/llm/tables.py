"""Helpers that several operators share: reading, cutting lineage, broadcast bitmaps, skew-safe look-ups."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import types
from collections.abc import Callable, Hashable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits in one row of a bitmap table (4 KB).
CHUNK_BITS = 32_768
#: Keys that are looked up by broadcast because each holds more than this share of all rows: 1000 keys at most.
HEAVY_SHARE = 0.001
#: Separators of words and of normalised text.
BLANKS = r"[\x20\x09-\x0D]+"


Kept = TypeVar("Kept")


def kept_in_process(key: Hashable, make: Callable[[], Kept]) -> Kept:
    """What ``make`` gives, made once per worker process and used by all of its tasks: for what depends on a file alone."""
    memory = sys.modules.setdefault("lotwise_kept", types.ModuleType("lotwise_kept")).__dict__
    if key not in memory:
        memory[key] = make()
    return memory[key]


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for a task of ``mapInArrow`` that gives back, at its end, what its worker process no longer uses. Workers
    wait for further tasks, several beside one executor, and what the allocators of all hold on to adds up."""

    def leaner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return leaner


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that all executors share: that in ``spark.checkpoint.dir``. Only a local master may go without; it gets a
    scratch folder."""
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    folder = sc.getConf().get("spark.checkpoint.dir", "")
    if not folder and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="run-"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder, and read it from there from now on."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def bitmap_size(keys: int, per_key: int, most: int) -> int:
    """Bits for so many keys: a power of two from one chunk up to ``most``."""
    bits = CHUNK_BITS
    while bits < keys * per_key and bits < most:
        bits *= 2
    return bits


def bitmap_table(slots: DataFrame, slot: str) -> DataFrame:
    """(chunk, bits): the set of the slot numbers in ``slots`` as rows of CHUNK_BITS bits."""
    return (
        slots.select(F.expr(f"{slot} div {CHUNK_BITS}").alias("chunk"), (F.col(slot) % CHUNK_BITS).alias("position"))
        .groupBy("chunk")
        .agg(F.bitmap_construct_agg("position").alias("bits"))
    )


def with_bit(rows: DataFrame, slot: str, bitmap: DataFrame, name: str) -> DataFrame:
    """Add boolean ``name``: whether the slot's bit is set. The bitmap, of bounded size, is broadcast; rows stay put."""
    chunk, bits = f"{name}_chunk", f"{name}_bits"
    side = bitmap.select(F.col("chunk").alias(chunk), F.col("bits").alias(bits))
    byte = F.expr(f"conv(hex(substring({bits}, cast(({slot} % {CHUNK_BITS}) div 8 as int) + 1, 1)), 16, 10)").cast("int")
    bit = F.expr(f"shiftleft(1, cast({slot} % 8 as int))")
    return (
        rows.join(F.broadcast(side), F.expr(f"{slot} div {CHUNK_BITS}") == F.col(chunk), "left")
        .withColumn(name, F.coalesce(byte.bitwiseAND(bit) != 0, F.lit(False)))
        .drop(chunk, bits)
    )


def look_up(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, where few keys may hold most rows.

    ``size`` is the column of ``groups`` with the number of rows of the key. Keys above HEAVY_SHARE of all
    rows, so 1000 at most, are broadcast and their rows stay where they are; the others are shuffled by key.
    Both inputs are read twice: pass checkpointed ones.
    """
    total = groups.groupBy(key).agg(F.max(size).alias("n")).agg(F.sum("n")).first()[0] or 0
    limit = max(1000.0, total * HEAVY_SHARE)
    heavy = F.broadcast(groups.filter(F.col(size) > limit))
    light = groups.filter(F.col(size) <= limit)
    return rows.join(heavy, key).unionByName(rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key))
