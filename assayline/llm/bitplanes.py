"""Files of token ids: blocks of ids as compressed bit or byte planes, with a chunk index.

A file holds whole sequences, and is laid out as

* the magic number,
* for each block of BLOCK_IDS ids (the last may be shorter) its planes, each compressed by itself:
  four byte planes, or 32 bit planes, lowest first,
* the index, compressed: place of the file in its table, ids and plane lengths of each block, key
  and length of each sequence,
* the length of the compressed index (8 bytes, little-endian), its crc32 (4 bytes), the magic
  number, and a line feed.

Spark's own writer puts the files down and Spark's own reader opens them, so that any file system
will do and a lost task leaves nothing behind.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import bounded_batches, stage

MAGIC = b"BITPLNS1"
BLOCK_IDS = 1 << 16
#: A file is closed after the sequence with which it reaches so many ids.
FILE_IDS = 1 << 20
LEVEL = 3
UNITS = {"byte": 4, "bit": 32}


def planes_of(ids: np.ndarray, unit: str) -> list[bytes]:
    """Planes of one block, lowest first."""
    table = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if unit == "bit":
        table = np.packbits(np.unpackbits(table, axis=1, bitorder="little").T, axis=1)
        return [row.tobytes() for row in table]
    return [np.ascontiguousarray(table[:, k]).tobytes() for k in range(4)]


def ids_of(planes: list[bytes], count: int) -> np.ndarray:
    """The block whose planes these are."""
    if len(planes) == 32:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=count) for p in planes], 1)
        return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")
    return np.stack([np.frombuffer(p, np.uint8) for p in planes], 1).reshape(-1).view("<u4")


def file_bytes(shard: int, place: int, keys: list[int | None], sequences: list[bytes], unit: str = "byte") -> bytes:
    """One file, up to its last line feed."""
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    ids = np.frombuffer(b"".join(sequences), "<u4")
    out, blocks = [MAGIC], []
    for begin in range(0, len(ids), BLOCK_IDS):
        block = ids[begin : begin + BLOCK_IDS]
        planes = [squeeze.compress(p) for p in planes_of(block, unit)]
        blocks.append([len(block), *map(len, planes)])
        out += planes
    index = [
        struct.pack("<qqqqq", shard, place, len(blocks), UNITS[unit], len(keys)), np.array(blocks, "<i8").tobytes(),
        np.array([k is None for k in keys], np.uint8).tobytes(), np.array([k or 0 for k in keys], "<i8").tobytes(), np.array([len(s) // 4 for s in sequences], "<i8").tobytes(),
    ]
    packed = squeeze.compress(b"".join(index))
    return b"".join([*out, packed, struct.pack("<QI", len(packed), zlib.crc32(packed)), MAGIC])


def read_file(content: bytes) -> tuple[int, int, list[int | None], list[bytes]]:
    """What ``file_bytes`` was given.  A damaged file raises ValueError."""
    content = memoryview(content)[: len(content) - (content[-1:] == b"\n")]
    if len(content) < 28 or content[:8] != MAGIC or content[-8:] != MAGIC:
        raise ValueError("not a file of id planes")
    size, check = struct.unpack("<QI", content[-20:-8])
    packed = bytes(content[-20 - size : -20])
    if zlib.crc32(packed) != check:
        raise ValueError("the index is damaged")
    index = zstandard.ZstdDecompressor().decompress(packed)
    shard, place, n_blocks, n_planes, n_keys = struct.unpack_from("<qqqqq", index)
    at = 40
    blocks = np.frombuffer(index, "<i8", n_blocks * (n_planes + 1), at).reshape(n_blocks, n_planes + 1)
    at += blocks.nbytes
    missing = np.frombuffer(index, np.uint8, n_keys, at)
    keys = np.frombuffer(index, "<i8", n_keys, at + n_keys)
    lengths = np.frombuffer(index, "<i8", n_keys, at + 9 * n_keys)
    spread, ids, at = zstandard.ZstdDecompressor(), [], 8
    for count, *sizes in blocks.tolist():
        planes = []
        for s in sizes:
            planes.append(spread.decompress(content[at : at + s]))
            at += s
        ids.append(ids_of(planes, count))
    flat = memoryview(np.concatenate(ids).tobytes() if ids else b"")
    stops = np.cumsum(lengths) * 4
    return shard, place, [None if m else k for m, k in zip(missing.tolist(), keys.tolist())], [bytes(flat[e - 4 * n : e]) for e, n in zip(stops.tolist(), lengths.tolist())]


def _pack_task(unit: str, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place, keys, sequences, held = TaskContext.get().partitionId(), 0, [], [], 0

        def close():
            return pa.RecordBatch.from_arrays([pa.array([file_bytes(shard, place, keys, sequences, unit)], pa.binary())], names=["content"])

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(key)
                sequences.append(ids)
                held += len(ids) // 4
                if held >= file_ids:
                    yield close()
                    place, keys, sequences, held = place + 1, [], [], 0
        if keys:
            yield close()

    return run


def ordered(df: DataFrame, key: str = "doc_id", tie: Column | None = None) -> DataFrame:
    """Rows in ascending order of ``key``, nulls first, by range partitions; ``tie`` orders equal keys."""
    by = [F.col(f"`{key}`"), *([] if tie is None else [tie])]
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def write(df: DataFrame, path: str, key: str = "doc_id", ids: str = "token_ids", unit: str = "byte", file_ids: int = FILE_IDS) -> None:
    """Write the sequences of ``df``, in the order of its partitions and rows, as files below ``path``.

    Null ids are an empty sequence.  A task holds one file's ids.
    """
    bounded_batches(df.sparkSession)
    rows = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{ids}`"), F.lit(b"")).alias("ids"))
    files = rows.mapInArrow(_pack_task(unit, file_ids), "content binary")
    files.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read(spark: SparkSession, path: str, key: str = "doc_id", ids: str = "token_ids") -> DataFrame:
    """One row per sequence: ``shard`` and ``place`` of its file, ``position`` in it, ``offset`` (ids before it in the file), key and ids."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                shard, place, keys, sequences = read_file(content)
                lengths = np.array([len(s) // 4 for s in sequences], np.int64)
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * n, pa.int64()), pa.array([place] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(np.cumsum(lengths) - lengths), pa.array(keys, pa.int64()), pa.array(sequences, pa.binary())],
                    names=["shard", "place", "position", "offset", "key", "ids"],
                )

    bounded_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "shard long, place long, position long, offset long, key long, ids binary").withColumnsRenamed({"key": key, "ids": ids})


def crc32(ids: Column) -> Column:
    return F.crc32(ids)


def with_starts(sequences: DataFrame, count: str = "n_tokens", start: str = "start") -> DataFrame:
    """Add ``start``: ids of all sequences before, in the order of the files.

    Counts are added up per file; only those sums, one row per file, are put in one order.
    """
    sums = sequences.groupBy("shard", "place").agg(F.sum(count).alias("own"))
    before = Window.orderBy("shard", "place").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("shard", "place", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before"))
    return sequences.join(sums, ["shard", "place"]).withColumn(start, F.col("before") + F.col("offset")).drop("before")


def summary(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Key, ``start``, ``n_tokens`` and ``ids_crc32`` of every sequence, read from the files."""
    rows = read(spark, path, key).withColumns({"n_tokens": (F.octet_length("token_ids") / 4).cast("long"), "ids_crc32": crc32(F.col("token_ids"))}).drop("token_ids")
    return with_starts(stage(rows, "sequences")).select(key, "start", "n_tokens", "ids_crc32")
