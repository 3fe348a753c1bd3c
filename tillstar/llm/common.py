"""Helpers shared by the operators: table reading, split membership and shared-folder tables."""

from __future__ import annotations

import gc
import importlib.util
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, remember, write_parquet
from ..sources.tables import read_table


def tokenizer_path(name: str) -> str:
    """A public tokenizer file: in $TOKENIZER_DIR if set, else in the installed package."""
    folder = os.environ.get("TOKENIZER_DIR")
    if not folder:
        folder = os.path.dirname(importlib.util.find_spec("public_tokenizers").origin)
    return os.path.join(folder, name)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents table, only the named columns."""
    return read_table(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


def labels(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """One row per labelled document: doc_id and the label. Rows without id or label are
    ignored; of contradicting rows the larger label holds."""
    rows = read_table(spark, sf_dir, "labels", "doc_id", column)
    return (rows.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
            .groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("label")))


def fold(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (a null id falls in fold 0)."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))


_SHIPPED: set[str] = set()
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Give Python workers this package (a few small files), once per application; and let Arrow
    batches hold at most 1,000 rows in this session, because texts are long."""
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= 1000:
        spark.conf.set(BATCH_ROWS, "1000")
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
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


def sampled(df: DataFrame, id_col: str, docs: int) -> DataFrame:
    """About ``docs`` rows (all, if there are fewer), chosen by a hash of the id: the same rows each time."""
    n = df.count()
    if n <= docs:
        return df
    bucket = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20))
    return df.where(bucket < F.lit(int(docs / n * (1 << 20))))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a frame that reads it.

    Cuts lineage like a checkpoint, but keeps columns prunable; a lost executor loses nothing. The write's shuffle
    files go when it is done; ``discard`` deletes the table itself once nothing reads it.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    write_parquet(df, path)
    return remember(spark.read.schema(df.schema).parquet(path), path)


def text_bytes(df: DataFrame, text_col: str = "text") -> int:
    """Total UTF-8 bytes of a text column: one narrow scan, one number to the driver."""
    return df.agg(F.sum(F.octet_length(text_col).cast("long")).alias("b")).first()["b"] or 0


def slices(batch, rows: int = 128):
    """An Arrow batch or array in short slices, so that few of its texts are Python objects at once."""
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)


class TwoGenerations(dict):
    """A bounded memo of a pure function: ``compute`` fills misses; when ``limit`` entries are
    held, they become the older generation, from which entries still in use are taken over."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


_KEPT: dict[str, object] = {}


def release() -> None:
    """Let go of what an earlier stage kept in this worker; for stages that keep nothing themselves."""
    _KEPT.clear()
    gc.collect()


_TASK: list[int] = [-1]


def release_once() -> None:
    """``release``, once for each task; for functions that Spark calls for every group."""
    from pyspark import TaskContext

    task = TaskContext.get().taskAttemptId()
    if _TASK[0] != task:
        _TASK[0] = task
        release()


def per_worker(key: str, make):
    """Keep what ``make`` builds in a Python worker between its tasks, until another key is asked for:
    a worker that goes on to another stage gives the memory back."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]
