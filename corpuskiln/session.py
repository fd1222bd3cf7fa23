"""Session factory and the shared-storage helpers that cut lineage safely."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_STAGED: list[str] = []
_MADE: dict[str, str] = {}


def get_session(app: str = "corpuskiln", master: str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """A session with the settings the engine expects (UTC, AQE, Arrow). A running session is reused."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and the master runs in one process
    (tests, benchmarks) is a temporary folder made; on a cluster an unset folder is an error, because a machine-local
    path would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or _MADE.get(spark.sparkContext.applicationId)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = f"file://{tempfile.mkdtemp(prefix='corpuskiln-')}"
    atexit.register(shutil.rmtree, made[len("file://"):], ignore_errors=True)
    _MADE[spark.sparkContext.applicationId] = made
    return made


def stage_table(df: DataFrame, name: str = "t", by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet in the shared folder, in folders by the columns ``by`` if given, and read it back.

    This cuts lineage like a checkpoint but keeps columns prunable and filters pushable. Files are compressed and are
    removed when the driver process ends, so a plan that reads them survives any executor loss meanwhile.
    """
    ship_package(df.sparkSession)
    path = f"{shared_dir(df.sparkSession)}/staged/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*(by or [])).parquet(path)
    _remember(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over all cores where a scan has fewer partitions than half of them (a few small files).

    For work that costs much per row. A large input has many partitions and is left as it is, without any shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


def _remember(spark: SparkSession, path: str) -> None:
    if not _STAGED:
        atexit.register(_drop_all)
    _STAGED.append(path)


@contextmanager
def staging() -> Iterator[None]:
    """Tables staged within the block are removed at its end: for work that writes its result elsewhere before."""
    before = len(_STAGED)
    try:
        yield
    finally:
        _drop(_STAGED[before:])
        del _STAGED[before:]


def _drop_all() -> None:
    _drop(_STAGED)


def _drop(paths: list[str]) -> None:
    for path in paths:
        local = path[len("file://"):] if path.startswith("file://") else path
        if os.path.isdir(local):
            shutil.rmtree(local, ignore_errors=True)
            continue
        spark = SparkSession.getActiveSession()
        if spark is not None:
            try:
                hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
                hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
            except Exception:  # noqa: BLE001 - the session may already be gone
                pass


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers: once per application, unless PYTHONPATH or the working folder has it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sc = spark.sparkContext
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if sc.applicationId in _SHIPPED or root in known or (sc.master.startswith("local[") and os.getcwd() == root):
        return
    folder = tempfile.mkdtemp(prefix="corpuskiln-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "corpuskiln"), "zip", root, "corpuskiln"))
    _SHIPPED.add(sc.applicationId)
