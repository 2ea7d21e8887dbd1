"""Merges read and rewrite the touched months only; journal; one row a key."""
import datetime as dt
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from hourwise.sources import files, months
from hourwise.streaming import ingest

SCHEMA = "zone string, ts timestamp_ntz, v double"


def fresh():
    return tempfile.mkdtemp(prefix="hw-months-", dir="/tmp")


def rows(spark, data):
    return spark.createDataFrame([(z, dt.datetime(*t) if t else None, v) for z, t, v in data], SCHEMA)


def stored(spark, path):
    return sorted(((r.zone, r.ts, r.v) for r in spark.read.parquet(path).collect()), key=str)


def modified(path):
    return {d: max(os.stat(os.path.join(path, d, f)).st_mtime_ns for f in os.listdir(os.path.join(path, d)))
            for d in os.listdir(path) if d.startswith("month=")}


YEAR = [("a", (2024, m, 1, h), float(m)) for m in range(1, 13) for h in range(3)]


def test_two_zones_of_a_month(spark):
    path = fresh() + "/t"
    kw = dict(ts="ts", keys=["zone", "ts"])
    files.write_month_partitions(rows(spark, YEAR), path, **kw)
    before = modified(path)
    files.write_month_partitions(rows(spark, [("b", (2024, 3, 1, 0), 9.0), ("a", (2024, 3, 1, 1), 7.0), (None, None, 1.0)]), path, **kw)
    after = modified(path)
    assert sorted(k for k in after if after[k] != before.get(k)) == ["month=202403", "month=__HIVE_DEFAULT_PARTITION__"]
    want = {(z, t): v for z, t, v in YEAR} | {("b", (2024, 3, 1, 0)): 9.0, ("a", (2024, 3, 1, 1)): 7.0, (None, None): 1.0}
    assert stored(spark, path) == sorted(((z, dt.datetime(*t) if t else None, v) for (z, t), v in want.items()), key=str)
    files.write_month_partitions(rows(spark, [(None, None, 1.0)]), path, **kw)  # NULL keys equal each other
    assert len(stored(spark, path)) == len(want)


@pytest.mark.parametrize("merge", [months.upsert_months, months.append_new])
def test_many_months_in_rounds(spark, merge):
    path = fresh() + "/t"
    merge(rows(spark, YEAR + [("n", None, 0.0)]), path, "ts", ["zone", "ts"], months_a_round=5)
    merge(rows(spark, YEAR + [("n", None, 0.0)]), path, "ts", ["zone", "ts"], months_a_round=1)
    assert len(stored(spark, path)) == 37
    merge(rows(spark, []), path, "ts", ["zone", "ts"])
    assert len(stored(spark, path)) == 37


def test_stated_row_of_equal_keys(spark):
    data = [("a", (2024, 1, 1), v) for v in (2.0, 5.0, None, 3.0)]
    for order in (data, data[::-1]):
        for merge, want in ((months.upsert_months, 5.0), (months.append_new, 5.0)):
            path = fresh() + "/t"
            merge(rows(spark, order), path, "ts", ["zone", "ts"])
            assert [r[2] for r in stored(spark, path)] == [want]
            merge(rows(spark, [("a", (2024, 1, 1), 1.0)]), path, "ts", ["zone", "ts"])
            assert [r[2] for r in stored(spark, path)] == [1.0 if merge is months.upsert_months else 5.0]
    only_keys = months.one_row_a_key(rows(spark, data).select("zone"), ["zone"])
    assert only_keys.count() == 1


def test_plan_lists_the_touched_months_alone(spark):
    """The batch has no filter of its own; its month reaches the target's scan as a literal, with the keys alone."""
    path = fresh() + "/t"
    files.write_month_partitions(rows(spark, YEAR), path, "ts")
    batch = months.with_month(rows(spark, [("b", (2024, 5, 1, 0), 9.0)]), "ts")
    (found,) = list(months.month_lists(batch))
    assert found == ["202405"]
    out = months.unseen(batch, months.stored_table(spark, path), found, ["zone", "ts"])
    assert out.count() == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*month#\d+[^\]]*202405", scan), scan
    assert "ReadSchema: struct<zone:string,ts:timestamp_ntz>" in scan
    old = months.stored_table(spark, path).where(months.month_filter(found))
    files_read = {os.path.basename(os.path.dirname(r[0])) for r in old.select(F.input_file_name()).collect()}
    assert files_read == {"month=202405"}


def test_journal_answers_a_replay_without_the_target(spark):
    base = fresh()
    target, journal = base + "/t", base + "/j"
    batch = rows(spark, YEAR)
    args = (target, journal, ["zone", "ts"], "ts")
    assert ingest.merge_batch(batch, 7, *args) and not ingest.merge_batch(batch, 7, *args)
    assert not ingest.merge_batch(batch, 7, "/nowhere/at/all", journal, ["zone", "ts"], "ts")  # the target is not looked at
    assert ingest.merge_batch(batch, 8, *args)  # no journal entry: found by its rows
    assert len(stored(spark, target)) == len(YEAR)


def test_stream_of_several_batches(spark):
    base = fresh()
    src, target, ck = (os.path.join(base, x) for x in ("src", "t", "ck"))
    os.makedirs(src)
    for i in range(3):
        with open(os.path.join(src, f"{i}.csv"), "w") as fh:
            fh.write("zone,ts,v\n" + "".join(f"z{j},2024-0{i + 1}-01 00:00:00,{j}.0\n" for j in range(i + 1)) + "z0,2024-01-01 00:00:00,0.0\n")
    kw = dict(keys=["zone", "ts"], ts="ts", files_a_batch=1)
    ingest.run_once(spark, src, rows(spark, []).schema, target, ck, **kw)
    assert len(stored(spark, target)) == 6
    assert [ingest.is_merged(spark, f"{ck}/{ingest.JOURNAL}", i) for i in range(4)] == [True, True, True, False]
