"""Kept value counts: equal to a count over all rows after loads, compactions and repeated loads, and read from new loads only."""

import glob

import pytest
from pyspark.sql import functions as F

from riskpipe.operators import quality as Q
from riskpipe.sources import csv_ingest as C
from riskpipe.streaming import distinct as D
from riskpipe.streaming import ingest as I
from test_streaming import L_HEADER, drop


@pytest.fixture()
def layout(scratch):
    return I.Layout(f"file:{scratch}/tables")


def load(spark, scratch, layout, name, rows, **kw):
    drop(f"{scratch}/{name}/CLAIMS_DATA_{name}.csv", L_HEADER, rows)
    I.copy_into(spark, C.list_files(spark, f"file:{scratch}/{name}"), "claims", layout, buckets=4, **kw)


def check(spark, layout, column="claim_amount"):
    raw = I.read_raw(spark, layout, "claims")
    want = raw.agg(F.count("*"), Q.distinct_count(column), Q.duplicate_count(column), F.max("load_timestamp")).first()
    got = D.DistinctState(spark, layout, "claims", column).measured().first()
    assert tuple(got) == tuple(want)


def test_loads_compaction_and_force(spark, scratch, layout):
    state = D.DistinctState(spark, layout, "claims", "claim_amount")
    assert not state.update() and tuple(state.measured().first()) == (0, 0, 0, None)
    load(spark, scratch, layout, "a", ["p1,1,false", "p2,1,true", "p3,,false", "p4,2.50,"])
    assert state.update() and not state.update()
    check(spark, layout)
    load(spark, scratch, layout, "b", ["p1,2.5,false", "p9,,true", "p9,7,true", "p9,7,true"])
    load(spark, scratch, layout, "c", ["p5,8,false"])
    assert state.update()
    check(spark, layout)
    I.compact_raw(spark, layout, "claims")
    assert state.update()
    check(spark, layout)
    load(spark, scratch, layout, "c", ["p5,9,false", "p6,1,true"])
    load(spark, scratch, layout, "b", ["p1,2.5,false", "p9,,true", "p9,7,true", "p9,7,true"], force=True)
    assert state.update()
    check(spark, layout)


def test_rows_of_earlier_loads_are_not_read(spark, scratch, layout):
    state = D.DistinctState(spark, layout, "claims", "claim_amount")
    load(spark, scratch, layout, "a", ["p1,1,false", "p2,3,true"])
    state.update()
    for f in glob.glob(f"{scratch}/tables/raw/claims/**/*.parquet", recursive=True):
        open(f, "wb").write(b"lost")
    load(spark, scratch, layout, "b", ["p1,3,false", "p1,4,false"])
    state.update()
    assert tuple(state.measured().first())[:3] == (4, 3, 1)


def test_versions_are_merged(spark, scratch, layout, monkeypatch):
    monkeypatch.setattr(D, "MERGE_AT", 2)
    state = D.DistinctState(spark, layout, "claims", "claim_amount")
    for i in range(4):
        load(spark, scratch, layout, f"n{i}", [f"p1,{i % 2},false", f"p{i},,true"])
        assert state.update()
        check(spark, layout)
    assert len(state.manifest()["versions"]) == 1


def test_a_replay_after_a_lost_commit(spark, scratch, layout, monkeypatch):
    state = D.DistinctState(spark, layout, "claims", "claim_amount")
    load(spark, scratch, layout, "a", ["p1,1,false", "p2,1,true"])
    with monkeypatch.context() as m:
        m.setattr(D.CM.Commits, "_create", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            state.update()
    assert tuple(state.measured().first())[:3] == (0, 0, 0)
    assert state.update()
    check(spark, layout)
