"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import time
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.session import ensure_checkpoint_dir

#: Words are maximal runs of characters other than the six ASCII white spaces.
WORD = re.compile(r"[^\x20\x09-\x0D]+")

U64 = np.uint64
_M1, _M2, _M3 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the
    lineage ends there, so a lost executor re-reads the table."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget_tables(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, once all that is to be read from
    them is written itself, instead of at the end of the session."""
    for t in tables:
        spark = t.sparkSession
        for folder in {f.rpartition("/")[0] for f in t.inputFiles()}:
            if folder.rpartition("/")[2].startswith("llm-"):
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of jobs that are over and whose plans
    nobody holds any more, instead of at the driver's next full collection.
    What a first collection frees holds further plans, so there are two."""
    for _ in range(2):
        gc.collect()
        time.sleep(0.2)
        spark.sparkContext._jvm.java.lang.System.gc()


def kept_in_worker(name: str, version: int, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once in a Python worker and kept for its later
    tasks, one version of a name at a time. (Functions come to workers by value,
    so that a module's own globals would be made anew in each task.)"""
    home = sys.modules.setdefault("lotguard_worker_state", types.ModuleType("lotguard_worker_state"))
    held = vars(home).get(name)
    if held is None or held[0] != version:
        held = vars(home)[name] = (version, make())
    return held[1]


def release_memory() -> None:
    """Give memory that is free back to the system. A Python worker is kept for
    later tasks, and what a task took at its largest would stay with it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def text_key(text: Column) -> list[Column]:
    """Key of a whole text: 64-bit hash and byte length (null counts as empty)."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("t_hash"), F.octet_length(t).alias("t_len")]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit values (wraps on overflow)."""
    x = (x ^ (x >> U64(30))) * _M2
    x = (x ^ (x >> U64(27))) * _M3
    return x ^ (x >> U64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive 64-bit identifier of a pair of identifiers."""
    x = a * _M1 + b * _M2
    return (x ^ (x >> U64(29))) * _M3


def powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n - 1) modulo 2^64."""
    out = np.ones(max(n, 1), U64)
    out[1:] = U64(base)
    return np.multiply.accumulate(out)[:n]


def runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return start, np.diff(np.append(start, len(values)))


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All integers of the ranges [start, start + length), in order."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) - np.repeat(first - start, length)


def list_array(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def small_batches(batches: Iterable[pa.RecordBatch], text: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Split batches so that each holds about ``limit`` bytes of the text
    column (always one row at least): bounded memory with long texts. Behind
    the last one free memory is given back."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.binary_length(col).fill_null(0), dtype=np.int64)
        part = (np.cumsum(sizes) - sizes) // limit
        for s, n in zip(*runs_of(part), strict=True):
            yield batch.slice(int(s), int(n))
    batch = col = None
    release_memory()


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2^bits bits, set where the first bits of the only column's
    64-bit hashes say. At most 2^(bits - 6) rows come to the driver, 64 bits
    each, whatever the number of hashes."""
    place = F.shiftrightunsigned(F.col(hashes.columns[0]), 64 - bits)
    word = hashes.select(F.shiftright(place, 6).alias("line"), place.bitwiseAND(63).cast("int").alias("bit"))
    lines = word.groupBy("line").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("set"))
    out = np.zeros(1 << (bits - 6), np.int64)
    for r in lines.toLocalIterator():
        out[r["line"]] = r["set"]
    return out


def bodies_of(bodies: DataFrame, wanted: DataFrame, key: list[str], bits: int = 26) -> DataFrame:
    """The rows of ``wanted`` (unique by ``key``, t_hash among it) with their
    texts: ``bodies`` has the key and ``body``, copies included. Texts come
    compressed (``unpacked``), for the shuffles to come. A bitmap of the
    hashes, of one size for any number, spares most other texts the shuffle;
    the join decides."""
    shared = bodies.sparkSession.sparkContext.broadcast(bitmap(wanted.select("t_hash"), bits).tobytes())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, pack = np.frombuffer(shared.value, np.uint8), zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(found, np.asarray(batch.column("t_hash")).view(U64), bits)))
            packed = pa.array([pack(b) for b in batch.column("body").to_pylist()], pa.binary())
            yield batch.set_column(batch.schema.get_field_index("body"), "body", packed)

    return bodies.select(*key, "body").mapInArrow(rows, bodies.select(*key, "body").schema).groupBy(*key).agg(F.first("body").alias("body")).join(wanted, key)


def unpacked(batches: Iterable[pa.RecordBatch], name: str, limit: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches of about ``limit`` bytes of compressed text, and their texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in small_batches(batches, name, limit // 2):
        yield batch, [unpack(b) for b in batch.column(name).to_pylist()]


def in_bitmap(bits: np.ndarray, hashes: np.ndarray, size: int) -> np.ndarray:
    """Which hashes have their bit in the bitmap (its bytes)."""
    at = (hashes >> U64(64 - size)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
