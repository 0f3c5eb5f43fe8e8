"""Versioned dimensions of which a run rewrites only the ranges of keys that it changes."""

import os
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from layerloom.context import RunContext
from layerloom.plans import gold
from layerloom.plans.lake import GOLD, Lake
from layerloom.queries.gold import _silver
from tests.test_dimensions import expected_versions

DIM, SIZE = "customer_dim", 4
SCHEMA = "CustomerID int, City string, LastUpdated timestamp, _RecordHash string"


def _run(n):
    at = datetime(2024, 1, 1) + timedelta(days=n)
    return RunContext("R", f"b{n}", at, at.date())


def _load(lake, n, values, *, silver=True, schema=SCHEMA):
    rows = [(k, v, datetime(2024, 1, 1) + timedelta(days=n), v) for k, v in values.items()]
    if silver:
        _silver(lake, "customers", lake.spark.createDataFrame(rows, schema), _run(n))
    return gold.load_versions(lake, lake.metadata.table("customers"), DIM, _run(n), "CustomerID", range_keys=SIZE)


def _rows(df):
    columns = ["CustomerID", "City", "_StartDate", "_EndDate", "_IsCurrent", "CustomerSK"]
    return sorted(map(tuple, df.select(*columns).collect()), key=lambda r: r[-1])


def _written_by(lake, n):
    """Range to batch that wrote it last, after the n-th load."""
    return {r["key_range"]: r["batch_id"] for r in gold.key_ranges(lake, DIM, f"b{n}").collect()}


# Every load sends only what is new or sent again; what is left out stays current.
LOADS = [
    {k: "a" for k in range(1, 13)},
    {2: "b", 3: "a"},  # one range closes a version, the next free one opens one
    {k: "a" for k in (5, 6, 7)},  # nothing changes
    {2: "c", 11: "b", 20: "a"},  # a version opened by another run is closed
    {20: "b"},
    {k: "z" for k in range(1, 13)},  # everything changes
]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("ranges")))
    audits = [_load(lake, n, values) for n, values in enumerate(LOADS)]
    return lake, audits


def _by_hand(loads):
    state, days = {}, []
    for values in loads:
        state = state | values
        days.append(dict(state))
    return expected_versions(days)


def test_versions_equal_those_kept_by_hand(loaded):
    lake, _ = loaded
    assert _rows(gold.versions(lake, DIM)) == _by_hand(LOADS)
    assert _rows(gold.current_versions(lake, DIM)) == [r for r in _by_hand(LOADS) if r[4]]


def test_only_touched_ranges_are_written(loaded):
    lake, audits = loaded
    assert _written_by(lake, 0) == {0: "b0", 1: "b0", 2: "b0"}
    # Customer 2 had key 2 (range 0) and gets key 13 (range 3).
    assert _written_by(lake, 1) == {0: "b1", 1: "b0", 2: "b0", 3: "b1"}
    assert _written_by(lake, 2) == _written_by(lake, 1)
    # Key 13 (range 3) and key 11 (range 2) are closed, keys 14 to 16 opened in range 3.
    assert _written_by(lake, 3) == {0: "b1", 1: "b0", 2: "b3", 3: "b3"}
    assert [a.records_written for a in audits[:4]] == [12, 3 + 1 + 1, 0, 3 + 3 + 2]


def test_folders_hold_the_touched_ranges_alone(loaded):
    lake, _ = loaded
    found = os.listdir(f"{lake.path(GOLD, DIM)}/_LoadBatch=b3/_VersionState=current")
    assert sorted(f for f in found if not f.startswith(".")) == ["_KeyRange=2-b3", "_KeyRange=3-b3"]


def test_keys_are_given_once(loaded):
    lake, _ = loaded
    keys = Counter(r[0] for r in gold.versions(lake, DIM).select("CustomerSK").collect())
    assert sorted(keys) == list(range(1, len(keys) + 1)) and set(keys.values()) == {1}
    current = gold.current_versions(lake, DIM).groupBy("CustomerID").count()
    assert current.where("count > 1").count() == 0


def test_other_ranges_are_not_read_to_be_rewritten(loaded):
    lake, _ = loaded
    part = gold.current_versions(lake, DIM, only=[4])
    assert {(r["CustomerSK"] - 1) // SIZE for r in part.collect()} == {4}
    assert all("_KeyRange=4-" in f or "_VersionState" not in f for f in _files_read(part))


def _files_read(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_a_run_that_fails_before_its_commit_leaves_the_old_state(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    _load(lake, 0, {k: "a" for k in range(1, 7)})
    before = _rows(gold.versions(lake, DIM))
    commit = lake._append_audit

    def lost(row):
        if (row.table_name, row.batch_id) == (DIM, "b1"):
            raise ConnectionError("driver lost")
        commit(row)

    monkeypatch.setattr(lake, "_append_audit", lost)
    with pytest.raises(ConnectionError):
        _load(lake, 1, {1: "b", 9: "a"})
    assert _rows(gold.versions(lake, DIM)) == before
    # The next run, without new silver rows, takes the batch that was left.
    _load(lake, 2, {}, silver=False)
    values = [{k: "a" for k in range(1, 7)}, {}, {1: "b", 9: "a"}]
    assert _rows(gold.versions(lake, DIM)) == _by_hand(values)


def test_nothing_new_writes_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert _load(lake, 0, {}, silver=False) is None
    _load(lake, 1, {1: "a"})
    again = _load(lake, 2, {}, silver=False)
    assert again.records_written == 0 and _written_by(lake, 2) == {0: "b1"}
    assert len(_rows(gold.versions(lake, DIM))) == 1


def test_an_empty_first_batch(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    _load(lake, 0, {})
    assert _rows(gold.versions(lake, DIM)) == []
    _load(lake, 1, {1: "a", 2: "a"})
    assert [r[-1] for r in _rows(gold.versions(lake, DIM))] == [1, 2]


def test_a_new_column_in_a_later_batch(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    _load(lake, 0, {k: "a" for k in range(1, 7)})
    at = datetime(2024, 1, 2)
    wider = spark.createDataFrame([(1, "b", at, "b", "vip")], SCHEMA + ", Tier string")
    _silver(lake, "customers", wider, _run(1))
    _load(lake, 1, {}, silver=False)
    tiers = {r["CustomerID"]: r["Tier"] for r in gold.current_versions(lake, DIM).collect()}
    assert tiers == {1: "vip"} | {k: None for k in range(2, 7)}


def test_ranges_that_share_folders(spark, tmp_path, loaded):
    """Small ranges do not make as many folders, and what is written of them stays the same."""
    lake, audits = Lake(spark, str(tmp_path)), []
    for n, values in enumerate(LOADS):
        rows = [(k, v, datetime(2024, 1, 1) + timedelta(days=n), v) for k, v in values.items()]
        _silver(lake, "customers", spark.createDataFrame(rows, SCHEMA), _run(n))
        config = lake.metadata.table("customers")
        audits.append(gold.load_versions(lake, config, DIM, _run(n), "CustomerID", range_keys=2, folder_ranges=4))
    assert _rows(gold.versions(lake, DIM)) == _by_hand(LOADS)
    assert _rows(gold.current_versions(lake, DIM)) == [r for r in _by_hand(LOADS) if r[4]]
    assert _written_by(lake, 1) == {0: "b1"} | {k: "b0" for k in range(1, 6)} | {6: "b1"}
    assert [a.records_written for a in audits[:3]] == [12, 1 + 1 + 1, 0]
    folders = os.listdir(f"{lake.path(GOLD, DIM)}/_LoadBatch=b0/_VersionState=current")
    assert sorted(f for f in folders if not f.startswith(".")) == ["_KeyRange=0-b0", "_KeyRange=1-b0"]
    some = gold.current_versions(lake, DIM, only=spark.range(7, 9).toDF("key_range"))
    assert {(r["CustomerSK"] - 1) // 2 for r in some.collect()} <= {7, 8}
