"""JDBC edges (A3, A4): parallel full-table reads and truncating overwrites.

Only thin settings over Spark's JDBC source. Reads split on a numeric column when bounds
are given (one query per partition instead of one task for the table). Writes keep the
target's DDL (constraints, indexes) by truncating instead of dropping, in batches.
These are not exercised by the tests: they need a database server, which the test
environment does not run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BATCH_SIZE = 1000  # rows per insert batch, as the reference writers use


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str],
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A3: ``schema.table`` as a DataFrame, split on ``partition_column`` when given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return reader.load()


def write_table(df: DataFrame, url: str, table: str, properties: dict[str, str],
                batch_size: int = BATCH_SIZE) -> None:
    """A4: overwrite by TRUNCATE (the table definition stays), inserts in batches."""
    (df.write.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
     .option("truncate", "true").option("batchsize", batch_size).mode("overwrite").save())
