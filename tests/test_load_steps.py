"""What the steps of a load store, and what they read again."""

import itertools
import os

from pyspark.sql import functions as F

from helpers import SF_SMALL, raw_rows
from tillstar import schemas
from tillstar.operators import skew
from tillstar.operators.quality import check_star
from tillstar.operators.stage import extract, first_per_key, stage
from tillstar.plans import etl, warehouse
from tillstar.plans.rawtext import raw_lines
from tillstar.plans.star import SourceStar
from tillstar.session import cut_lineage, ensure_checkpoint_dir, scratch


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rejects_do_not_run_the_lookups_again(spark):
    rows = [{"Order ID": "O-1"}, {"Order ID": "O-2", "Order Date": "zz"}, {"Order ID": "O-3", "Quantity": "0"}]
    snap = warehouse.load_batch(None, stage(extract(raw_rows(spark, *rows))))
    assert "Join" not in plan(snap.fact_rejects) and "Join" not in plan(snap.order_rejects)
    assert {(r["row_id"], r["reject_reason"]) for r in snap.fact_rejects.collect()} == {("0002", "missing_order"), ("0003", "quantity_not_positive")}
    assert [r["order_key"] for r in snap.order_rejects.collect()] == ["O-2"]
    assert "created_at" not in snap.fact_rejects.columns and snap.tables["fact_sales"].count() == 1


def test_raw_staging_is_read_without_storing_the_text(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(etl, "cut_lineage", lambda df: kept.append(df) or df)
    rows = etl.q_conform(SourceStar(spark, SF_SMALL))
    assert not kept and rows.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def test_lines_meet_orders_that_know_their_customers(spark):
    """Two shuffles of the lines: customers join orders, not lines."""
    lines = plan(raw_lines(SourceStar(spark, SF_SMALL))).splitlines()
    at = [k for k, line in enumerate(lines) if "Join Inner" in line and "c_custkey" in line]
    assert len(at) == 1
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    below = itertools.takewhile(lambda line: depth(line) > depth(lines[at[0]]), lines[at[0] + 1:])
    assert not any("l_orderkey" in line for line in below)


def test_first_per_key_breaks_ties_and_keeps_nulls(spark):
    rows = [("a", "2", "x", None), ("a", "1", "z", None), ("a", "1", "y", "q"), ("b", None, "n", "m"), ("b", "0", "k", None), (None, "5", "p", "p")]
    df = spark.createDataFrame(rows, "k string, row_id string, v string, w string")
    picked = first_per_key(df, "k", ["v", "w"])
    assert {tuple(r) for r in picked.collect()} == {("a", "y", "q"), ("b", "n", "m"), (None, "p", "p")}
    assert "min_by" not in plan(picked)  # which carries every value twice
    assert picked.where(F.col("k") == "a").columns == ["k", "v", "w"]


def test_exact_measures_are_read_without_their_text(spark):
    """Raw staging's numbers do not go through text; numbers in text still do, and give the same."""
    rows = [{"Sales": "$1,234.50", "Quantity": "2.7", "Discount": "150", "Profit": "-0.00004"}, {"Sales": "0", "Quantity": "-3", "Discount": "", "Profit": "n/a"},
            {"Sales": "99999999999999999999.12345", "Quantity": "9999999999", "Discount": "0.005", "Profit": "1e3"}]
    raw = extract(raw_rows(spark, *rows))
    lines = stage(raw)["stg_sales_lines"]
    assert "RLIKE" not in plan(lines).upper()
    as_text = raw.select(*(F.col(c).cast("string").alias(c) for c in raw.columns))
    assert "RLIKE" in plan(stage(as_text)["stg_sales_lines"]).upper()
    assert lines.schema == stage(as_text)["stg_sales_lines"].schema
    assert sorted(map(str, lines.collect())) == sorted(map(str, stage(as_text)["stg_sales_lines"].collect()))


def physical(spark, frame) -> str:
    """The plan as first made, under a threshold that every table here is below."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        return frame()._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_growing_dimensions_are_not_broadcast_by_the_size_of_their_files(spark, monkeypatch):
    """Sorted keys take far fewer bytes in files than in the driver: lookups of orders, products and customers go by no threshold."""
    staging = warehouse.stored_staging(extract(raw_rows(spark, {"Order ID": "O-1"}, {"Order ID": "O-1"}, {"Order ID": "O-2", "Customer ID": "C-2"})))
    stored = {name: cut_lineage(df) for name, df in warehouse.load_batch(None, staging).tables.items()}
    candidates = lambda: warehouse.fact_candidates(
        staging["stg_sales_lines"], stored["dim_order"], stored["dim_product"], stored["dim_customer"])
    salted = physical(spark, candidates)  # every key of three lines is hot
    assert not [line for line in salted.splitlines() if "BroadcastHashJoin" in line and "__hot" not in line]
    assert salted.count("SortMergeJoin") >= 3
    monkeypatch.setattr(skew, "hot_keys", lambda df, columns: {c: skew.Hot() for c in columns})
    facts = physical(spark, candidates)
    assert "BroadcastHashJoin" not in facts and facts.count("SortMergeJoin") == 3
    checks = physical(spark, lambda: check_star({"fact_sales": stored["fact_sales"]}, {"fact_sales": schemas.CONSTRAINTS["fact_sales"]}, "fk", stored))
    assert "BroadcastHashJoin" not in checks and "SortMergeJoin" in checks
    monkeypatch.setattr(etl, "two_batch_run", lambda star: (warehouse.Snapshot(stored), warehouse.Snapshot(stored)))
    ids = physical(spark, lambda: etl.q_id_stability(None))
    assert "BroadcastHashJoin" not in ids and ids.count("SortMergeJoin") == 4
    assert {(r["keys_before"], r["keys_after"], r["changed"]) for r in etl.q_id_stability(None).where("table_name = 'dim_order'").collect()} == {(2, 2, 0)}


def stored_folders(spark) -> set[str]:
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {n for n in os.listdir(folder) if n.startswith("cut-")}


def test_a_load_leaves_only_tables_that_are_read(spark, tmpdir_path):
    before = stored_folders(spark)
    for k, order in enumerate(("O-1", "O-2", "O-2")):  # the last is the batch in force again
        snap = warehouse.run_etl(raw_rows(spark, {"Order ID": order}, {"Order ID": "O-3", "Order Date": "zz"}), f"{tmpdir_path}/w")
        left, before = stored_folders(spark) - before, stored_folders(spark)
        read = {f.rsplit("/", 2)[-2] for df in snap.frames() for f in df.inputFiles()}
        assert left == {n for n in read if n.startswith("cut-")} and bool(left) == (k < 2)
        if left:
            assert snap.staging["stg_sales_lines"].count() == 2 and snap.fact_rejects.count() == 1 and snap.order_rejects.count() == 1
    assert snap.tables["fact_sales"].count() == 2
    with scratch(spark):
        warehouse.run_etl(raw_rows(spark, {"Order ID": "O-4"}), f"{tmpdir_path}/w")
    assert stored_folders(spark) == before


def test_two_batches_leave_only_tables_that_are_read(spark, monkeypatch):
    monkeypatch.setattr(warehouse, "_RUNS", {})
    before = stored_folders(spark)
    both = warehouse.two_batch_run(SourceStar(spark, SF_SMALL), True)
    read = {f.rsplit("/", 2)[-2] for snap in both for df in snap.frames() for f in df.inputFiles()}
    assert stored_folders(spark) - before == read
    assert all(df.count() >= 0 for snap in both for df in snap.frames())


def test_sales_lines_are_not_stored_again(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(warehouse, "cut_lineage", lambda df: kept.append(df.columns) or df)
    frames = warehouse.stored_staging(extract(raw_rows(spark, {"Order ID": "O-1"})))
    assert len(kept) == 4 and frames["stg_sales_lines"].columns not in kept


def test_batches_share_the_shuffles_of_their_lines(spark, monkeypatch):
    """Raw staging of both batches is one write, in which the lines dealt by order are shuffled once."""
    kept = []
    monkeypatch.setattr(warehouse, "cut_lineage", lambda df: kept.append(df) or df)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        first, second = warehouse.stage_batches(SourceStar(spark, SF_SMALL), (1, 2), whole=True)
        assert kept[0]._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    for batch, frames in ((1, first), (2, second)):
        alone = stage(extract(raw_lines(SourceStar(spark, SF_SMALL), batch, True)))["stg_sales_lines"]
        got = frames["stg_sales_lines"]
        assert got.schema == alone.schema and got.count() == alone.count()
        assert got.exceptAll(alone).count() == 0
