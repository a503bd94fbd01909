"""Command line: run the Silver, Gold or streaming step.

    python -m medallion silver  --entity matches --bronze B --silver S --date 2024-09-08
    python -m medallion gold    --silver S --gold G --date 2024-09-08
    python -m medallion stream  --entity matches --bronze B/matches --silver S/matches
    python -m medallion seasons --index I --matches M --competition 16 --target T

Under ``spark-submit`` the submitted session (and its ``spark.checkpoint.dir``)
is used; otherwise a local session is built.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .session import apply_defaults, build_session, checkpoint_dir


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        apply_defaults(active)
        checkpoint_dir(active)
        return active
    return build_session()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="medallion")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("silver")
    s.add_argument("--entity", required=True, choices=["matches", "teams", "players"])
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--date", required=True)
    s.add_argument("--per-season", action="store_true")
    s.add_argument("--layout", default="documents", choices=["documents", "records"])
    g = sub.add_parser("gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--gold", required=True)
    g.add_argument("--date", required=True)
    g.add_argument("--fail-on-tests", action="store_true")
    st = sub.add_parser("stream")
    st.add_argument("--entity", required=True, choices=["matches", "teams", "players"])
    st.add_argument("--bronze", required=True)
    st.add_argument("--silver", required=True)
    st.add_argument("--checkpoint")
    se = sub.add_parser("seasons")
    se.add_argument("--index", required=True)
    se.add_argument("--matches", required=True)
    se.add_argument("--competition", type=int, required=True)
    se.add_argument("--target", required=True)
    a = p.parse_args(argv)

    spark = _session()
    from .plans import ingest, jobs
    if a.cmd == "silver":
        verify: dict = {}
        rows = jobs.silver_job(spark, a.entity, a.bronze, a.silver, a.date, a.per_season, verify,
                               a.layout)
        out = {"checks": [r.asDict() for r in rows], "written": verify}
    elif a.cmd == "gold":
        out = [r.asDict() for r in jobs.gold_job(spark, a.silver, a.gold, a.date,
                                                 a.fail_on_tests).collect()]
    elif a.cmd == "stream":
        from .streaming.bronze_stream import run_bronze_to_silver
        e = jobs.ENTITIES[a.entity]
        q = run_bronze_to_silver(spark, a.bronze, a.silver, a.entity, e.doc_schema, e.array_field,
                                 e.flatten, e.checks, checkpoint_location=a.checkpoint)
        out = {"batches": len(q.recentProgress)}
    else:
        log = ingest.season_index_ingest(spark, a.index, a.matches, a.competition, a.target)
        out = [r.asDict() for r in log.collect()]
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
