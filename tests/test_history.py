"""Load history by file, and the stored history of measurements."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskpipe.operators import quality as Q
from riskpipe.sources import csv_ingest as C
from riskpipe.streaming import ingest as I
from test_streaming import L_HEADER, drop


def by_file(spark, layout):
    cols = ("status", "rows_parsed", "rows_loaded", "rows_rejected", "first_error_row", "first_error_columns")
    return {r.file.rsplit("/", 1)[1]: tuple(r[c] for c in cols) for r in I.load_history(spark, layout).collect()}


def test_history_of_each_file(spark, scratch):
    layout = I.Layout(f"file:{scratch}/tables")
    assert I.load_history(spark, layout).count() == 0
    drop(f"{scratch}/in/CLAIMS_DATA 1+.csv", L_HEADER, ["p1,1,false", "p2,x,maybe", "p3,y,true"])
    drop(f"{scratch}/in/CLAIMS_DATA_2.csv", "fraud_reported,policy_number,claim_amount", ["true,p4,4"])
    drop(f"{scratch}/in/CLAIMS_DATA_3.csv", L_HEADER, [])
    files = C.list_files(spark, f"file:{scratch}/in")
    I.copy_into(spark, files, "claims", layout, buckets=4, on_error="continue")
    want = {"CLAIMS_DATA 1+.csv": ("PARTIALLY_LOADED", 3, 1, 2, 2, "claim_amount,fraud_reported"),
            "CLAIMS_DATA_2.csv": ("LOADED", 1, 1, 0, None, None), "CLAIMS_DATA_3.csv": ("LOADED", 0, 0, 0, None, None)}
    assert by_file(spark, layout) == want
    drop(f"{scratch}/strict/CLAIMS_DATA_4.csv", L_HEADER, ["p1,1,false"] * 5 + ["p2,x,true"])
    drop(f"{scratch}/strict/CLAIMS_DATA_5.csv", L_HEADER, ["p1,1,false"])
    with pytest.raises(C.LoadError):
        I.copy_into(spark, C.list_files(spark, f"file:{scratch}/strict"), "claims", layout, buckets=4)
    want |= {"CLAIMS_DATA_4.csv": ("LOAD_FAILED", 6, 0, 1, 6, "claim_amount"), "CLAIMS_DATA_5.csv": ("LOAD_FAILED", 1, 0, 0, None, None)}
    assert by_file(spark, layout) == want
    assert I.read_raw(spark, layout, "claims").count() == 2


def test_an_uncommitted_load_is_no_history(spark, scratch, monkeypatch):
    from riskpipe.streaming import commits as K
    layout = I.Layout(f"file:{scratch}/tables")
    drop(f"{scratch}/in/CLAIMS_DATA_1.csv", L_HEADER, ["p1,1,false"])
    monkeypatch.setattr(K.Commits, "add", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        I.copy_into(spark, C.list_files(spark, f"file:{scratch}/in"), "claims", layout, buckets=4)
    monkeypatch.undo()
    assert by_file(spark, layout) == {}
    I.copy_into(spark, C.list_files(spark, f"file:{scratch}/in"), "claims", layout, buckets=4)
    assert by_file(spark, layout) == {"CLAIMS_DATA_1.csv": ("LOADED", 1, 1, 0, None, None)}


def test_first_error_in_a_file_read_in_parts(spark, scratch):
    layout = I.Layout(f"file:{scratch}/tables")
    bad = {7000, 7001, 9500}
    drop(f"{scratch}/in/CLAIMS_DATA_1.csv", L_HEADER, [f"p{i},{'x' if i in bad else i % 900},false" for i in range(1, 10_001)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        I.copy_into(spark, C.list_files(spark, f"file:{scratch}/in"), "claims", layout, buckets=4, on_error="continue")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert by_file(spark, layout) == {"CLAIMS_DATA_1.csv": ("PARTIALLY_LOADED", 10_000, 9_997, 3, 7000, "claim_amount")}


def history(spark, values, metric="M", hours=None):
    t0 = dt.datetime(2024, 3, 10)
    rows = [("t", metric, t0 + dt.timedelta(hours=h), v, t0) for h, v in zip(hours or range(len(values)), values, strict=True)]
    return spark.createDataFrame(rows, "table_name string, metric_name string, measurement_time timestamp_ntz, value long, change_commit_time timestamp_ntz")


def episodes(spark, values, hi, lo, **kw):
    th = spark.createDataFrame([("t", "M", hi, lo), ("t", "other", 0, 0)], "table_name string, metric_name string, max_value long, clear_value long")
    rows = Q.alert_episodes(history(spark, values, **kw), th).orderBy("episode").collect()
    t0 = dt.datetime(2024, 3, 10)
    hour = lambda t: None if t is None else int((t - t0).total_seconds() // 3600)
    return [(r.episode, hour(r.opened_at), hour(r.closed_at), r.seconds // 3600, r.peak, r.measurements) for r in rows]


def plain_episodes(values, hi, lo):
    out, cur = [], None
    for h, v in enumerate(values):
        if v is None:
            continue
        if cur is None and v > hi:
            cur = [len(out) + 1, h, None, 0, v, 0]
            out.append(cur)
        if cur is not None:
            if v <= lo:
                cur[2], cur[3], cur = h, h - cur[1], None
            else:
                cur[3], cur[4], cur[5] = h - cur[1], max(cur[4], v), cur[5] + 1
    return [tuple(x) for x in out]


@pytest.mark.parametrize("values", [[0, 5, 11, 8, 6, 4, 12, 3, 20], [20, 20, 4, 4, 20, None, 9, 4], [1, 2, 3], [], [8, 8, 12, None, 8, 5, 5, 11, 11]])
def test_episodes_equal_a_plain_loop(spark, values):
    assert episodes(spark, values, 10, 5) == plain_episodes(values, 10, 5)


def test_as_of_and_trend_over_gaps(spark):
    h = history(spark, [4, 10, 10, None, 7], hours=[0, 2, 3, 5, 105])
    at = lambda s: [(r.value, r.measurement_time.hour) for r in Q.as_of(h, F.lit(s).cast("timestamp_ntz")).collect()]
    assert at("2024-03-09 23:59:59") == [] and at("2024-03-10 02:59:59") == [(10, 2)] and at("2024-03-10 03:00:00") == [(10, 3)]
    rows = Q.stored_trend(h).orderBy("measurement").collect()
    assert [(r.measurement, r.value, r.previous_value, r.change, r.seconds) for r in rows] == [
        (1, 4, None, None, None), (2, 10, 4, 6, 7200), (3, 10, 10, 0, 3600), (4, None, 10, None, 7200), (5, 7, None, None, 360000)]
    assert rows[1].change_per_hour == 3.0


def test_usual_thresholds(spark):
    rows = Q.usual_thresholds(history(spark, [10, 11, None, 13])).collect()
    assert [(r.max_value, r.clear_value) for r in rows] == [(12, 11)]


def test_a_load_sorts_only_rejected_rows_before_the_raw_table(spark, scratch, monkeypatch):
    """Neither the staged rows (by whether they are good) nor the history's counts need a sort of all rows."""
    from pyspark.sql.readwriter import DataFrameWriter
    layout, found, by = I.Layout(f"file:{scratch}/tables"), [], []
    real, part = C.file_history, DataFrameWriter.partitionBy
    monkeypatch.setattr(C, "file_history", lambda *a: found.append(real(*a)) or found[-1])
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *cols: by.extend(cols) or part(self, *cols))
    drop(f"{scratch}/in/CLAIMS_DATA_1.csv", L_HEADER, ["p1,1,false", "p2,x,maybe", "p3,y,true"])
    I.copy_into(spark, C.list_files(spark, f"file:{scratch}/in"), "claims", layout, buckets=4, on_error="continue")
    assert by_file(spark, layout) == {"CLAIMS_DATA_1.csv": ("PARTIALLY_LOADED", 3, 1, 2, 2, "claim_amount,fraud_reported")}
    assert "_good" not in by
    plan = found[0]._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan
    assert not [x for x in plan.split("\n") if "SortAggregate" in x and "count(1)" in x]
