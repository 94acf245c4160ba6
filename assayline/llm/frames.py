"""What the operators share: reading tables, Arrow tasks that keep columns, staged tables."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline import session

# Arrow batches are worked on in slices of about this many bytes of text, so that what a task
# holds follows the longest row and not the batch.
SLICE_BYTES = 1 << 20
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends, later stages read it many times."""
    return session.materialise(df, name)


def bounded_batches(spark: SparkSession) -> None:
    """Let no Arrow batch of this session be larger than BATCH_ROWS rows or BATCH_BYTES (or one row).

    Whole texts travel in these batches, and both sides hold some of them, so the defaults of
    10,000 rows and 64 MB would decide what an executor needs.  Smaller settings are left alone.
    Frames are run later by the caller, so the setting stays.
    """
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.conf.get(rows))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    if spark.conf.get(size) == "67108864b":
        spark.conf.set(size, BATCH_BYTES)


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy parts of a batch, each of at most ``limit`` bytes in ``column`` or one row."""
    sizes = [x or 0 for x in pc.binary_length(batch.column(column)).to_pylist()]
    begin = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield batch.slice(begin)


def add_columns(
    df: DataFrame,
    inputs: list[Column],
    task: Callable[[Iterator[list[pa.Array]]], Iterator[list[pa.Array]]],
    outputs: str,
    keep: list[str] | None = None,
    sliced: int = 0,
) -> DataFrame:
    """Add the columns ``outputs`` (DDL), computed in Python from ``inputs``, row by row.

    ``task`` maps lists of input arrays to lists of output arrays of the same length; input
    ``sliced`` is a string or binary by whose size batches are cut.  Rows are neither moved nor
    reordered.  All other columns are kept (or those in ``keep``); an existing column with the
    name of an output, in any case of letters, gives way to it.
    """
    bounded_batches(df.sparkSession)
    made = T.StructType.fromDDL(outputs)
    taken = {f.name.lower() for f in made}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    source = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)], *[c.alias(f"i{i}") for i, c in enumerate(inputs)])
    schema = T.StructType(source.schema.fields[: len(kept)] + [T.StructField(f"o{i}", f.dataType) for i, f in enumerate(made)])
    n = len(kept)

    def run(batches):
        waiting: list[list[pa.Array]] = []

        def feed():
            for batch in batches:
                for part in slices(batch, n + sliced):
                    waiting.append(part.columns[:n])
                    yield part.columns[n:]

        for out in task(feed()):
            columns = waiting.pop(0) + out
            yield pa.RecordBatch.from_arrays(columns, names=[f"k{i}" for i in range(n)] + [f"o{i}" for i in range(len(out))])
        give_back()

    result = source.mapInArrow(run, schema)
    return result.toDF(*kept, *[f.name for f in made])


def give_back() -> None:
    """Return what a task needed to the system.

    A worker process stays for other tasks of other stages, and the allocators of Arrow and of C keep
    freed memory for themselves, so that a chain of operators would need the sum of their peaks.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(task):
    """A task of ``mapInArrow`` that gives its memory back at the end."""

    def run(batches):
        yield from task(batches)
        give_back()

    return run


def text_or_empty(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def held_out(remainder: int, name: str = "doc_id") -> Column:
    """Whether crc32 of the id, as text, leaves this remainder on division by five.  A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).cast("binary")) % 5 == remainder
