"""The kept profile: equal to the profile of all rows, whatever the files; earlier files are not read again."""

import os

import pytest
from pyspark.sql import functions as F

from tillstar.operators import profile_state
from tillstar.operators.profile import profile_columns
from tillstar.operators.profile_state import STATE, StoredProfile
from tillstar.session import cut_lineage

TEXT, NUMBERS = ["name", "note"], ["price"]
SCHEMA = "name string, price string, note string"
FIRST = [("Ann", "$1,200.50", None), ("Bob", "3", "NA"), ("Ann", "3", ""), (None, "x", None)]
SECOND = [("Ann", "-7.125", None), ("Christine", "3", "n/a"), ("Bob", None, None)] * 3


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def kept(spark, root, exact=True):
    return StoredProfile(spark, root, TEXT, NUMBERS, exact)


def test_adding_files_equals_the_profile_of_all_rows(spark, tmpdir_path):
    files = [spark.createDataFrame(r, SCHEMA) for r in (FIRST, SECOND, FIRST)] + [spark.createDataFrame([], SCHEMA)]
    store = kept(spark, tmpdir_path)
    for i, df in enumerate(files):
        store.add(f"f{i}", df)
    everything = files[0].unionByName(files[1]).unionByName(files[2])
    expected = profile_columns(everything, TEXT, NUMBERS)
    assert store.profile().columns == expected.columns and rows(store.profile()) == rows(expected)
    assert store.files() == {"f0", "f1", "f2", "f3"}
    found = {r["column_name"]: r for r in store.profile().collect()}
    assert found["name"]["distinct_count"] == 3 and found["price"]["mean_value"] == pytest.approx((2 * 1206.5 + 3 * (-7.125 + 3)) / 12, abs=1e-6)
    assert found["note"]["nulls"] == 17 and found["note"]["distinct_count"] == 0 and found["note"]["maxlen"] is None


def test_profile_reads_state_only(spark, tmpdir_path):
    """The kept profile is read from the state rows: neither the values nor the files."""
    store = kept(spark, f"{tmpdir_path}/p")
    source = f"{tmpdir_path}/source"
    spark.createDataFrame(FIRST, SCHEMA).write.parquet(source)
    store.add("f", spark.read.parquet(source))
    read = store.profile().inputFiles()
    assert read and all("/state/" in f for f in read)
    store.add("g", spark.createDataFrame(SECOND, SCHEMA))
    again = store._read("values", "column_name string, value string")
    assert rows(again) == sorted(set(rows(again)))  # a value is kept once


def test_new_values_are_marked_as_the_pairs_are_stored(spark, tmpdir_path, monkeypatch):
    """The kept values are met once, before the pairs are stored; the stored pairs are not joined with themselves, and go."""
    stored = []
    monkeypatch.setattr(profile_state, "cut_lineage", lambda df: stored.append(cut_lineage(df)) or stored[-1])
    read, values = [], StoredProfile._read
    monkeypatch.setattr(StoredProfile, "_read", lambda self, kind, schema: read.append(kind) or values(self, kind, schema))
    store = kept(spark, tmpdir_path)
    store.add("f", spark.createDataFrame(FIRST, SCHEMA))
    store.add("g", spark.createDataFrame([*SECOND, (None, None, None)], SCHEMA))
    assert read.count("values") == 2 and all("is_new" in df.columns for df in stored) and len(stored) == 2
    assert not any(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for df in stored for f in df.inputFiles())
    state = {(r["file"], r["column_name"]): (r["row_count"], r["nulls"], r["new_values"]) for r in store._read("state", STATE + ", file string").collect()}
    assert state["f", "name"] == (4, 1, 2) and state["g", "name"] == (10, 1, 1) and state["g", "note"] == (10, 10, 0)


def test_same_file_twice_and_unfinished_additions(spark, tmpdir_path):
    store = kept(spark, tmpdir_path)
    store.add("f", spark.createDataFrame(FIRST, SCHEMA))
    with pytest.raises(ValueError):
        store.add("f", spark.createDataFrame(SECOND, SCHEMA))
    before = rows(store.profile())
    with pytest.raises(Exception):  # fails while it is scanned: what it began does not count
        store.add("g", spark.createDataFrame(SECOND, SCHEMA).withColumn("note", F.raise_error(F.lit("broken"))))
    assert rows(store.profile()) == before
    store.add("g", spark.createDataFrame(SECOND, SCHEMA))
    assert rows(store.profile()) != before


def test_an_addition_that_another_overtakes_counts_for_nothing(spark, tmpdir_path, monkeypatch):
    store, other = kept(spark, tmpdir_path), kept(spark, tmpdir_path)
    late = spark.createDataFrame(SECOND, SCHEMA)
    from tillstar.operators import profile_state

    original, done = profile_state.states, []

    def overtaken(*args):
        if not done:
            done.append(1)
            other.add("g", spark.createDataFrame(FIRST, SCHEMA))
        return original(*args)

    monkeypatch.setattr(profile_state, "states", overtaken)
    with pytest.raises(RuntimeError):
        store.add("f", late)
    assert store.files() == {"g"}


def test_sketches_give_counts_within_their_error(spark, tmpdir_path):
    store = kept(spark, tmpdir_path, exact=False)
    df = spark.range(40_000).select(F.col("id").cast("string").alias("name"), F.lit("1").alias("price"), F.lit(None).cast("string").alias("note"))
    store.add("a", df.where("id < 25000"))
    store.add("b", df.where("id >= 15000"))
    found = {r["column_name"]: r["distinct_count"] for r in store.profile().collect()}
    assert abs(found["name"] / 40_000 - 1) < 0.03 and found["price"] == 1 and found["note"] == 0
