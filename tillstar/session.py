"""Spark session and lineage helpers.

The library never creates a session on its own inside operators; callers pass one in.
``get_spark`` is for tests, the bench and command-line runs on a single machine.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours wants, local or cluster.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Windows-1252 CSV input needs the JVM's full charset list (Spark 4 restricts it).
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    master: str | None = None,
    app_name: str = "tillstar",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``master`` defaults to ``local[$BENCH_CPUS]`` or ``local[8]``; shuffle partitions default
    to the core count, which suits local runs. On a cluster, pass the master and leave
    ``shuffle_partitions`` to AQE's coalescing by setting it high (e.g. 4x total cores).
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf.setdefault("spark.driver.memory", os.environ.get("TILLSTAR_DRIVER_MEMORY", "16g"))
    if extra_conf:
        conf.update(extra_conf)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must point at shared storage and is left untouched. Only a
    local-mode session without one (tests, the bench) gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
        )
    folder = tempfile.mkdtemp(prefix="tillstar-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and return a frame reading it.

    Used where a plan must be evaluated exactly once (non-deterministic numbering) or where
    lineage would otherwise grow across batches. Survives executor loss, unlike caching; and
    later scans read only the columns and row groups they need, unlike an RDD checkpoint.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    write_parquet(df, path)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return remember(spark.read.schema(df.schema).parquet(path), path)


#: For each ``scratch`` that is open, the folders written in it.
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., None]]:
    """The folders that ``cut_lineage`` writes inside are deleted at the end, but for those that frames given to the yielded
    function read; a ``scratch`` around this one then answers for them."""
    kept: set[str] = set()

    def keep(*frames: DataFrame) -> None:
        kept.update(file.rsplit("/", 2)[-2] for df in frames for file in df.inputFiles())

    _SCRATCH.append([])
    try:
        yield keep
    finally:
        for path in _SCRATCH.pop():
            if path.rsplit("/", 1)[-1] not in kept:
                delete_folder(spark, path)
            elif _SCRATCH:
                _SCRATCH[-1].append(path)


#: Spark removes the shuffle files of a query once it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_parquet(df: DataFrame, path: str) -> None:
    """Write ``df``; once that is done, the shuffle files of the write go, as nothing reads them again. Fingerprints and
    numbers in text take about half the bytes with zstd.

    Without this they stay on the executors' disks until the driver collects the query's objects.
    """
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


#: The folder of each frame that ``remember`` was told of; a frame that is gone is forgotten.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def remember(df: DataFrame, path: str) -> DataFrame:
    """Note that ``df`` reads the folder ``path``, which was written for it, so that ``discard`` can delete it."""
    _FOLDERS[df] = path
    return df


def discard(*frames: DataFrame) -> None:
    """Delete the folders of intermediate frames that nothing reads any more; frames without a folder of their own are left."""
    for df in frames:
        folder = _FOLDERS.pop(df, None)
        if folder is not None:
            delete_folder(df.sparkSession, folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Give Python workers this package (a few small files), once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="tillstar-"), "tillstar.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, os.path.dirname(package)))
        sc.addPyFile(archive)
        _SHIPPED.add(sc.applicationId)
    return spark
