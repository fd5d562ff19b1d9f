"""Windows kept up to date load by load, against the analysis of all orders at once."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ordermill import session
from ordermill.operators import windows
from ordermill.plans import loads, reports
from ordermill.sources import writers
from ordermill.streaming import upserts

SCHEMA = "state string, order_date date, status string, size string, qty double, whole_qty int"
OPTIONS = {"cutoff": 60, "short": 2, "long": 4}
COLUMNS = ["state", "window_date", "size", "n", "sum_qty", "sum_qty_sq"]


def orders(spark, seed, n, first=1, last=20, states=("KA", "GOA", ""), month=4):
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        day = dt.date(2022, month, rng.randint(first, last)) if rng.random() < 0.95 else None
        status, qty = rng.choice(["Shipped", "Shipped", "Cancelled"]), rng.choice([0.0, 1.0, 2.0, 2.5])
        made.append((rng.choice(states), day, status, rng.choice(["S", "M", "", None]), qty, int(qty) if qty != 2.5 else 0))
    return spark.createDataFrame(made, SCHEMA)


def at_once(frame, cutoff=60, short=2, long=4):
    daily = windows.daily_totals(frame)
    lengths = windows.window_lengths(windows.volume_of(daily), cutoff, short, long)
    return windows.window_totals(daily, lengths, long)


def same(spark, root, frame):
    assert rows(loads.window_totals(spark, root), *COLUMNS) == rows(at_once(frame), *COLUMNS)
    sizes = reports.popular_sizes(frame, **OPTIONS)
    assert rows(loads.popular_sizes(spark, root)) == rows(sizes, "state", "window_date", "size")


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "windows")


def test_two_loads_equal_one(spark, root):
    first, late = orders(spark, 1, 150), orders(spark, 2, 40, 5, 6)
    loads.add_load(first, root, 0)
    assert loads.refresh(spark, root, **OPTIONS) == [dt.date(2022, 4, 1)]
    same(spark, root, first)
    loads.add_load(late, root, 1)
    assert loads.refresh(spark, root, **OPTIONS) == [dt.date(2022, 4, 1)]
    same(spark, root, first.union(late))
    assert loads.refresh(spark, root, **OPTIONS) == []


def test_the_second_load_reads_only_the_months_it_reaches(spark, root, monkeypatch):
    parts = [orders(spark, n, 60, month=n) for n in (1, 3, 4, 5, 6)]
    for n, frame in enumerate(parts):
        loads.add_load(frame, root, n)
    assert loads.refresh(spark, root, **OPTIONS) == [dt.date(2022, n, 1) for n in (1, 3, 4, 5, 6)]
    late = orders(spark, 2, 40, 27, 30)  # windows of April and May
    loads.add_load(late, root, 5)
    plans, stage = {}, loads.stage

    def spy(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, label)

    monkeypatch.setattr(loads, "stage", spy)
    assert loads.refresh(spark, root, **OPTIONS) == [dt.date(2022, 4, 1), dt.date(2022, 5, 1)]
    scanned = re.search(r"PartitionFilters: \[month#\d+ IN \(([^)]*)\)", plans["windows"])[1]
    assert scanned == "2022-03-01,2022-04-01,2022-05-01"
    whole = late
    for frame in parts:
        whole = whole.union(frame)
    same(spark, root, whole)


def test_months_that_windows_look_back_on():
    first = lambda *months: [dt.date(2022, m, 1) for m in months]
    assert loads._months_behind(first(4), 5) == first(3, 4)
    assert loads._months_behind(first(3, 9), 60) == [dt.date(2021, 12, 1), *first(1, 2, 3), *first(7, 8, 9)]


def test_a_load_added_again_changes_nothing(spark, root):
    first, second = orders(spark, 3, 100), orders(spark, 4, 100)
    for n, frame in enumerate([first, second, second, first]):
        loads.add_load(frame, root, min(n, 3 - n))
        loads.refresh(spark, root, **OPTIONS)
    same(spark, root, first.union(second))


def test_a_corrected_load_takes_the_place_of_the_first(spark, root):
    first, wrong, right = orders(spark, 5, 60, 1, 6), orders(spark, 6, 80, 10, 20), orders(spark, 7, 10, 8, 8)
    loads.add_load(first, root, 0)
    loads.add_load(wrong, root, 1)
    loads.refresh(spark, root, **OPTIONS)
    loads.add_load(right, root, 1)
    loads.refresh(spark, root, **OPTIONS)
    same(spark, root, first.union(right))


def test_a_state_that_passes_the_cutoff_changes_all_its_windows(spark, root):
    few = orders(spark, 8, 60, 1, 20, ["KA"])
    loads.add_load(few, root, 0)
    loads.refresh(spark, root, **OPTIONS)
    more = orders(spark, 9, 200, 19, 20, ["KA"], 7)
    loads.add_load(more, root, 1)
    assert loads.refresh(spark, root, **OPTIONS) == [dt.date(2022, 4, 1), dt.date(2022, 7, 1)]
    same(spark, root, few.union(more))
    loads.add_load(more.limit(0), root, 1)  # and back
    loads.refresh(spark, root, **OPTIONS)
    same(spark, root, few)


@pytest.mark.parametrize("broken", ["replace_folder", "write_parquet"])
def test_a_run_that_dies_is_made_good_by_the_next(spark, root, monkeypatch, broken):
    first, second, third = (orders(spark, seed, 80) for seed in (10, 11, 12))
    loads.add_load(first, root, 0)
    loads.refresh(spark, root, **OPTIONS)

    def die(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        if broken == "replace_folder":  # the days are noted, the totals are not there
            patch.setattr(loads, broken, die)
            loads.add_load(second, root, 1)
        else:  # the windows are built, the lengths and the end of the note are not there
            loads.add_load(second, root, 1)
            patch.setattr(loads, broken, die)
            loads.refresh(spark, root, **OPTIONS)
    loads.add_load(third, root, 2)
    loads.refresh(spark, root, **OPTIONS)
    if broken == "replace_folder":
        same(spark, root, first.union(third))
        loads.add_load(second, root, 1)
        loads.refresh(spark, root, **OPTIONS)
    same(spark, root, first.union(second).union(third))


def test_folded_loads_keep_the_totals(spark, root):
    parts = [orders(spark, 20 + n, 40) for n in range(4)]
    for n, frame in enumerate(parts):
        loads.add_load(frame, root, n)
    loads.refresh(spark, root, **OPTIONS)
    loads.fold_loads(spark, root, 2)
    files, path = session.hadoop_path(spark, f"{root}/daily")
    assert {e.getPath().getName() for e in files.listStatus(path)} - {"_SUCCESS", "._SUCCESS.crc"} == {"load=2", "load=3"}
    with pytest.raises(ValueError, match="folded"):
        loads.add_load(parts[1], root, 1)
    late = orders(spark, 30, 60)
    loads.add_load(late, root, 4)
    loads.refresh(spark, root, **OPTIONS)
    whole = late
    for frame in parts:
        whole = whole.union(frame)
    same(spark, root, whole)


def test_empty_loads(spark, root):
    nothing = orders(spark, 1, 5).limit(0)
    loads.add_load(nothing, root, 0)
    assert loads.refresh(spark, root, **OPTIONS) == [] and loads.window_totals(spark, root).count() == 0
    loads.add_load(orders(spark, 1, 30), root, 1)
    loads.refresh(spark, root, **OPTIONS)
    same(spark, root, orders(spark, 1, 30))


# --- the same over a stream ------------------------------------------------------------------

EVENTS = "state string, ordered_at timestamp, size string, qty int"


def moment(day, hour=12):
    return dt.datetime(2022, 4, day, hour, tzinfo=dt.timezone.utc)


def stream(spark, source, root, checkpoint):
    frame = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
    query = upserts.write_window_updates(upserts.as_window_orders(frame), root, checkpoint, available_now=True, **OPTIONS)
    query.awaitTermination()
    return query


def test_open_windows_and_late_orders(spark, root, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    batches = [
        [("KA", moment(1), "M", 1), ("KA", moment(2, 0), "S", 2), ("GOA", moment(20, 23), "M", 3), ("KA", moment(3), "M", 0)],
        [("KA", moment(28), "L", 1), ("KA", moment(1), "XS", 5)],  # four weeks late
        [("GOA", moment(20, 1), "S", 2)] * 70,  # late, and past the cut-off
    ]
    arrived = []
    for batch in batches:
        spark.createDataFrame(batch, EVENTS).coalesce(1).write.mode("append").parquet(source)
        stream(spark, source, root, checkpoint)
        arrived += batch
        same(spark, root, upserts.as_window_orders(spark.createDataFrame(arrived, EVENTS)))
    found = rows(loads.window_totals(spark, root), "window_date")
    assert (dt.date(2022, 5, 2),) in found  # the last window of the newest order is open, and there


def test_a_batch_that_runs_again_changes_nothing(spark, root, tmp_path):
    source, checkpoint = str(tmp_path / "in"), tmp_path / "checkpoint"
    for day in (1, 2, 3):
        spark.createDataFrame([("KA", moment(day), "M", day)], EVENTS).coalesce(1).write.mode("append").parquet(source)
    stream(spark, source, root, str(checkpoint))
    before = rows(loads.window_totals(spark, root), *COLUMNS)
    # as if the driver had died after the last batch and before its commit
    for name in ("2", ".2.crc"):
        (checkpoint / "commits" / name).unlink()
    assert stream(spark, source, root, str(checkpoint)).lastProgress["batchId"] == 2
    assert rows(loads.window_totals(spark, root), *COLUMNS) == before
    assert before == rows(at_once(upserts.as_window_orders(spark.read.parquet(source))), *COLUMNS)


def test_a_load_that_lost_its_folder_half_way_comes_back(spark, root):
    first, second = orders(spark, 40, 60), orders(spark, 41, 60)
    loads.add_load(first, root, 0)
    loads.add_load(second, root, 1)
    files, path = session.hadoop_path(spark, f"{root}/daily/load=1")
    aside = session.hadoop_path(spark, f"{root}/daily/.load=1.old-{'0' * 32}")[1]
    assert files.rename(path, aside)
    loads.refresh(spark, root, **OPTIONS)
    same(spark, root, first.union(second))


def test_status_and_quantity_of_the_stream(spark):
    frame = spark.createDataFrame([("KA", moment(1, 23), "M", 1), ("KA", None, "M", 1)], EVENTS)
    got = upserts.as_window_orders(frame)
    assert rows(got, "order_date", "status") == [(None, "Shipped"), (dt.date(2022, 4, 1), "Shipped")]
    assert windows.shipped_orders(got).count() == 1 and got.where(F.col("whole_qty") == 1).count() == 2


def test_a_note_that_was_moved_aside_is_read(spark, tmp_path):
    # a note whose replacement stopped half-way is still read
    writers.write_parquet(spark.createDataFrame([(dt.date(2022, 4, 1),)], loads.PENDING), f"{tmp_path}/pending")
    (tmp_path / "pending").rename(tmp_path / f".pending.old-{'a' * 32}")
    assert loads._table(spark, str(tmp_path), "pending", loads.PENDING).count() == 1
