"""Session and shared-folder helpers."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "riverloom", cores: str = "8", partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # call sites in error messages cost several gateway calls per expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if current is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    if current is not None:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="run-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def run_folder(spark: SparkSession) -> str:
    """Where this application keeps its tables below the shared folder."""
    return f"{shared_folder(spark)}/run-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    """Unused path for one run's tables."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_run_folder(spark: SparkSession) -> None:
    """Free the space of all tables that this application has saved so far.

    The last step of a job, once its output is committed elsewhere: frames,
    models and manifests made before cannot be read any more.
    """
    drop_folder(run_folder(spark))


def saved(df: DataFrame, name: str, together: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For tables used several times with different columns: computed once, cut
    from their lineage, and pruned to the columns each use needs. Spark holds up to
    4096 rows of a row group at a time when it reads them; of a table of wide rows
    (some MB each) ``together`` are a row group.
    """
    path = new_folder(df.sparkSession, name)
    options = {"parquet.block.row.count.limit": str(together)} if together else {}
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_and_counted(
    df: DataFrame, name: str, condition: Column
) -> tuple[DataFrame, int]:
    """Like :func:`saved`, with the number of rows that meet a condition.

    The number is taken while writing. Re-run tasks may raise it, yet never
    from zero, so it serves to tell whether there is more to do.
    """
    seen = Observation()
    watched = df.observe(seen, F.count(F.when(condition, 1)).alias("n"))
    return saved(watched, name), seen.get["n"]


_shipped: set[str] = set()
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the workers, once per application.

    Python tasks refer to functions by module; workers on other machines, or
    started from another folder, need not have the package installed.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(root.rglob("*.py")):
            out.write(module, module.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with a function of this package.

    Batches are kept to a few MB, whatever the length of a row, and as workers
    are reused, a task hands back the memory it has freed.
    """
    spark = df.sparkSession
    ship_package(spark)
    if spark.sparkContext.getConf().get(BATCH_BYTES) is None:  # else the application has set it
        spark.conf.set(BATCH_BYTES, str(8 << 20))

    def run(batches):
        try:
            yield from function(batches)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Return freed memory of this process to the system, where that is possible."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def exists(path: str) -> bool:
    store, place = fs.FileSystem.from_uri(path)
    return store.get_file_info(place).type != fs.FileType.NotFound


def drop_folder(path: str) -> None:
    """Delete a folder that the library has written; nothing if it is gone."""
    store, place = fs.FileSystem.from_uri(path)
    if store.get_file_info(place).type == fs.FileType.Directory:
        store.delete_dir(place)
