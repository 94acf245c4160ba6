"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Folders of local sessions without a shared one, by application: the setting itself is fixed when a session starts.
_own_folders: dict[str, str] = {}
_run_folder: contextvars.ContextVar[str] = contextvars.ContextVar("run_folder", default="")

# Settings every job relies on.  All are runtime SQL settings, so they can be put on a
# session that somebody else created.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot samples, files and countries: split the skewed side of a shuffled join even
    # when that costs one more exchange afterwards.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JIT refuses methods above 8000 bytes of bytecode, and a stage that cleans dozens of
    # columns generates larger ones.  Such a stage is faster with its expressions compiled
    # one by one than fused into a method that is only interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}

# For runs that only write tables: what an execution shuffled is removed as soon as it ends.  Otherwise
# it stays until the driver happens to collect its garbage, so disk grows with all that was ever shuffled.
DROP_SHUFFLES = {"spark__sql__classic__shuffleDependency__fileCleanup__enabled": "true"}


# For staged tables of whole rows.
COMPACT = "zstd"


def configure(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "assayline", master: str | None = None, cores: int = 8, **conf: str) -> SparkSession:
    """Create a session.  ``master`` is only given for local runs; a cluster sets its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = (
            builder.master(master)
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.driver.memory", "12g")
            .config("spark.ui.enabled", "false")
        )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a cluster a
    machine-local path would be lost with its executor, so there the setting is required, and
    must name a folder that all machines reach, a mounted one if it is a file path.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="assayline-")
    return _own_folders[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused folder for one run's intermediate table.

    All folders of an application lie below its id, and those of a ``scratch_run`` below a
    folder of its own, so they can be removed together once it has ended.
    """
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{_run_folder.get()}{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder through the file system that holds it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Everything staged inside is removed at the end, through the file system that holds it.

    Results must be written elsewhere before.  Yields the folder.
    """
    run = f"run-{uuid.uuid4().hex}/"
    token = _run_folder.set(_run_folder.get() + run)
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{_run_folder.get()}"
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        remove(spark, folder)


@contextlib.contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Runtime settings (dots spelled as ``__``) for what runs inside; the earlier ones come back."""
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def materialise(df: DataFrame, name: str, codec: str | None = None, path: str | None = None) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back.

    Parquet rather than ``checkpoint()`` because the result stays columnar, can be pruned,
    and tells Catalyst its true size, which is what decides whether it is broadcast.  ``codec`` is by
    default the session's; ``COMPACT`` halves rows that carry a key as text, which snappy leaves as long as they are.
    ``path`` is by default a new folder of the current run.
    """
    spark = df.sparkSession
    path = path or scratch(spark, name)
    schema = df.schema
    df.write.parquet(path, compression=codec)
    return spark.read.schema(schema).parquet(path)
