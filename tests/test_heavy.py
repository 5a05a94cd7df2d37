"""Frequency sketches of the claim keys, kept at ingest and merged for the join."""

import os

from riskpipe.operators import integrate as integ
from riskpipe.streaming import heavy as H
from riskpipe.streaming import ingest as I
from riskpipe.streaming import refresh as R

from test_streaming import C_HEADER, L_HEADER, batch_truth, drop, run, state

CFG = integ.SkewConfig(rows_per_task=100)


def load(spark, scratch, layout, n, rows, **kw):
    path = f"{scratch}/landing/CLAIMS_DATA_{n}.csv"
    if not os.path.exists(path):
        drop(path, L_HEADER, rows)
    return I.copy_into(spark, [f"file:{path}"], "claims", layout, buckets=4, **kw)


def hot(spark, layout, cfg=CFG):
    found = H.hot_keys(spark, layout.heavy("claims"), I.commits(spark, layout, "claims").state(), cfg)
    return found if isinstance(found, list) or found is None else sorted(map(tuple, found.collect()))


def test_keys_that_only_the_loads_together_make_hot(spark, scratch):
    layout = I.Layout(f"file:{scratch}/tables")
    assert hot(spark, layout) == []
    cold = [f"c{i},{i},false" for i in range(400)]
    for n in range(3):   # no load alone has 200 claims of a key
        load(spark, scratch, layout, n, ["hot,1,false"] * 120 + ["warm,2,true"] * 60 + [",3,false"] * 250 + cold[n::3])
    assert hot(spark, layout) == [("hot", 4)]      # NULL keys join nothing
    assert hot(spark, layout, integ.SkewConfig(rows_per_task=90)) == [("hot", 4), ("warm", 2)]
    assert hot(spark, layout, integ.SkewConfig(mode="off")) == []
    I.compact_raw(spark, layout, "claims")
    assert hot(spark, layout) == [("hot", 4)]
    # a load without keys keeps sketches of nothing
    load(spark, scratch, layout, 9, [",3,false"])
    assert hot(spark, layout) == [("hot", 4)]


def test_every_planted_key_is_found_among_many(spark, scratch):
    layout = I.Layout(f"file:{scratch}/tables")
    planted = {f"hot{i}": 210 + 40 * i for i in range(12)}
    rows = [f"{k},1,false" for k, n in planted.items() for _ in range(n)] + [f"c{i},1,false" for i in range(40_000)]   # more keys than tracked
    load(spark, scratch, layout, 0, rows)
    assert {k for k, _ in hot(spark, layout)} == set(planted)


def test_load_without_sketches_falls_back(spark, scratch):
    layout = I.Layout(f"file:{scratch}/tables")
    load(spark, scratch, layout, 0, ["p,1,false"])
    I.remove(spark, layout.heavy("claims"), I.commits(spark, layout, "claims").state().live, 0)
    assert hot(spark, layout) is None


def customers(spark, scratch, layout, keys):
    drop(f"{scratch}/landing/CUSTOMER_DATA_1.csv", C_HEADER, [f"{k},30,2014-01-01 00:00:00.000,10,500,900,M,College,x" for k in keys])
    I.copy_into(spark, [f"file:{scratch}/landing/CUSTOMER_DATA_1.csv"], "customers", layout, buckets=4)


def test_refresh_splits_what_the_sketches_list(spark, scratch, monkeypatch):
    layout = I.Layout(f"file:{scratch}/tables")
    customers(spark, scratch, layout, ["hot", "p1", "none"])
    for n in range(2):
        load(spark, scratch, layout, n, ["hot,1,false"] * 150 + ["p1,5,true"])
    monkeypatch.setattr(integ, "detect_hot_keys", lambda *a, **k: (_ for _ in ()).throw(AssertionError("the claims were scanned")))
    split = []
    join = integ.left_join_claims
    monkeypatch.setattr(integ, "left_join_claims", lambda c, cl, hot=None, live=False: split.append((hot is not None, live)) or join(c, cl, hot, live))
    keys = spark.read.schema(R.KEY_CHANGES_SCHEMA).parquet(layout.changes("refresh")).select("policy_number", "bucket")
    R.refresh_keys(spark, layout, keys, buckets=4, skew=CFG)
    assert (True, True) in split
    monkeypatch.undo()
    assert state(spark, layout) == batch_truth(spark, layout)
    assert len(state(spark, layout)) == 300 + 2 + 1


def test_one_scan_of_the_claims(spark, scratch):
    layout = I.Layout(f"file:{scratch}/tables")
    customers(spark, scratch, layout, ["hot"])
    load(spark, scratch, layout, 0, ["hot,1,false"] * 300)
    st = I.commits(spark, layout, "claims").state()
    found = H.hot_keys(spark, layout.heavy("claims"), st, CFG)
    cust, claims = I.read_raw(spark, layout, "customers"), I.read_raw(spark, layout, "claims", state=st)
    for live, scans in ((True, 1), (False, 3)):
        df = integ.integrate(cust, claims, hot=found, live=live)
        leaves = df._jdf.queryExecution().sparkPlan().toString().count("FileScan")
        assert leaves - 1 - 2 == scans and df.count() == 300    # the others: customers, and the list on both sides


def test_keys_taken_back_by_force_lose_no_customer(spark, scratch):
    """A compacted load is loaded again without its hot key: the sketch still lists it, its customer stays."""
    layout = I.Layout(f"file:{scratch}/tables")
    customers(spark, scratch, layout, ["hot", "p1"])
    load(spark, scratch, layout, 0, ["hot,1,false"] * 300)
    load(spark, scratch, layout, 1, ["p1,1,false"])
    I.compact_raw(spark, layout, "claims")
    path = f"{scratch}/landing/CLAIMS_DATA_0.csv"
    st = os.stat(path)
    drop(path, L_HEADER, ["p1,90,false"] * 300)
    assert os.stat(path).st_size == st.st_size
    os.utime(path, ns=(st.st_atime_ns, st.st_mtime_ns))   # the same file by path, size and time
    load(spark, scratch, layout, 0, [], force=True)
    now = I.commits(spark, layout, "claims").state()
    assert not H.certain(now) and [k for k, _ in hot(spark, layout)] == ["hot", "p1"]
    run(R.start_refresh(spark, layout, buckets=4))
    found = H.hot_keys(spark, layout.heavy("claims"), now, CFG)
    l1 = integ.integrate(I.read_raw(spark, layout, "customers"), I.read_raw(spark, layout, "claims"), hot=found, live=H.certain(now))
    got = sorted(((r.policy_number, r.has_claim, str(r.claim_amount)) for r in l1.collect()), key=repr)
    assert got == batch_truth(spark, layout) == state(spark, layout)
    assert ("hot", 0, "None") in got


def test_kept_keys_query_makes_two_loads_of_any_number_of_files(spark, monkeypatch):
    from riskpipe.plans import extra_queries as X
    from riskpipe.plans.catalog import raw

    cust, claims = raw(spark, "/root/testdata/sf0.001")
    loads, copy = [], X.I.copy_into
    monkeypatch.setattr(X, "raw", lambda *_: (cust, claims.repartition(3)))
    monkeypatch.setattr(X.I, "copy_into", lambda spark, paths, *a, **kw: loads.append(len(paths)) or copy(spark, paths, *a, **kw))
    got = X.q_l1_kept_keys(spark, "")
    assert loads == [3, 3]
    assert got.count() == _integrated(cust, claims).count()


def _integrated(cust, claims):
    from riskpipe.operators import integrate
    return integrate.integrate(cust, claims)
