"""Launch the continuous jobs on a cluster, or print a report.

    python -m riskpipe start  --landing <dir> --root <dir> [--buckets N] [--lag "1 minute"]
    python -m riskpipe report --root <dir> --report by_state --role PIPELINE_ANALYST [--account X]

``start`` runs the two ingest streams, the keyed refresh of levels 1 and 2 (trigger
= target lag) and the 5-minute quality monitor until they are stopped.
"""

from __future__ import annotations

import argparse

from riskpipe.session import get_session


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="riskpipe")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("start")
    s.add_argument("--landing", required=True)
    s.add_argument("--root", required=True)
    s.add_argument("--buckets", type=int, default=64)
    s.add_argument("--lag", default="1 minute")
    s.add_argument("--quality-every", default="5 minutes")
    s.add_argument("--archive", help="move processed landing files here (keeps the landing listing small)")
    r = sub.add_parser("report")
    r.add_argument("--root", required=True)
    r.add_argument("--report", default="overview",
                   choices=["overview", "by_age_category", "by_state", "by_risk_level", "high_risk_share",
                            "role_summary", "sample", "policy_status"])
    r.add_argument("--role")
    r.add_argument("--account")
    a = p.parse_args(argv)

    spark = get_session()
    from riskpipe.streaming import ingest as I
    layout = I.Layout(a.root)
    if a.cmd == "start":
        from riskpipe.streaming import monitor as M
        from riskpipe.streaming import refresh as R
        trig = {"processingTime": a.lag}
        queries = [I.start_ingest(spark, a.landing, feed, layout, trigger=trig, buckets=a.buckets,
                                  query_name=f"ingest_{feed}", archive_dir=a.archive)
                   for feed in ("claims", "customers")]
        queries.append(R.start_refresh(spark, layout, buckets=a.buckets, trigger=trig, query_name="refresh"))
        queries.append(M.start_quality_monitor(spark, layout, f"{a.root}/quality_results", every=a.quality_every))
        spark.streams.awaitAnyTermination()
        for q in queries:
            q.stop()
        return

    from riskpipe.operators import governance as G
    from riskpipe.plans import reports as RP
    from riskpipe.streaming import refresh as R
    ctx = G.AccessContext(a.role, a.account)
    from riskpipe.streaming import summary as SM
    kept = {"overview": RP.summary_overview, "by_age_category": RP.summary_by_age_category,
            "by_state": RP.summary_by_state, "by_risk_level": RP.summary_by_risk_level}
    if a.report in kept:    # from the maintained sums, brought up to the levels first
        SM.update(spark, layout)
        kept[a.report](RP.governed_summary(SM.summary(spark, layout), ctx)).show(truncate=False)
        return
    matrix = R.level(spark, layout, 2).drop("bucket")
    view = G.broker_view(matrix, ctx)
    gov = G.governed(matrix, ctx)
    out = {
        "high_risk_share": lambda: RP.high_risk_share(gov), "role_summary": lambda: RP.role_summary(view, a.role),
        "sample": lambda: RP.sample(view), "policy_status": lambda: RP.policy_status(view),
    }[a.report]()
    out.show(truncate=False)


if __name__ == "__main__":
    main()
