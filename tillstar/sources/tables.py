"""Readers for the source tables (one Parquet dataset per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(base_dir: str, name: str) -> str:
    return f"{base_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one source table. Naming columns keeps the scan's ReadSchema narrow even
    before Catalyst prunes the rest of the plan."""
    df = spark.read.parquet(table_path(base_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, base_dir: str, names=SOURCE_TABLES) -> None:
    """Expose source tables as temp views for ``spark.sql`` (A6: query as source)."""
    for name in names:
        read_table(spark, base_dir, name).createOrReplaceTempView(name)


def file_state(spark: SparkSession, base_dir: str, names=("lineitem", "orders", "customer", "part")) -> tuple:
    """Size and time of the files of some tables: changes when they are written anew."""
    state = []
    for name in names:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_path(base_dir, name))
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.listStatus(path) if fs.exists(path) else []
        state.append(tuple((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found))
    return tuple(state)
