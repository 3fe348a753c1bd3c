import glob
import os

import pytest
from pyspark.sql import functions as F

from tillstar.session import SHUFFLE_CLEANUP, cut_lineage, discard, ensure_checkpoint_dir


def folders(spark):
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    return set(glob.glob(os.path.join(root, "cut-*")))


def test_discard_deletes_only_the_frames_own_folder(spark):
    before = folders(spark)
    one = cut_lineage(spark.range(10).groupBy((F.col("id") % 3).alias("k")).count())
    two = cut_lineage(spark.range(5))
    assert len(folders(spark) - before) == 2
    discard(one, spark.range(3), one.select("k"))  # frames without a folder of their own are left alone
    assert len(folders(spark) - before) == 1
    assert two.count() == 5
    discard(two)
    assert folders(spark) == before


def test_intermediate_tables_are_written_with_zstd(spark):
    before = folders(spark)
    kept = cut_lineage(spark.range(5))
    (folder,) = folders(spark) - before
    assert glob.glob(os.path.join(folder, "*.zstd.parquet")) and kept.count() == 5


def test_writing_leaves_the_session_as_it_was(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    rows = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    kept = cut_lineage(rows)
    assert sorted(kept.collect()) == sorted(rows.collect())
    with pytest.raises(Exception):
        cut_lineage(spark.range(3).select(F.raise_error(F.lit("no")).alias("x")))
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
