"""Command line: the registry workflow as Spark jobs.

    python -m tabelion expand  --archives DIR --staged PATH
    python -m tabelion create  --db NAME --location PATH
    python -m tabelion load    --source DIR|PATH [--staged] --db NAME --location PATH
                               [--mode overwrite|append] [--force] [--lenient] [--lenient-rows] [--buckets N]
    python -m tabelion counts  --db NAME
    python -m tabelion latest  --db NAME
    python -m tabelion links   --pages PARQUET [--prefix 20] [--suffix .zip]
    python -m tabelion monitor --folder DIR --checkpoint PATH --output PATH [--interval "30 seconds"]
    python -m tabelion purge   --db NAME --yes

Reports are small DataFrames (one row per table or file) printed with ``show``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from tabelion import schemas
from tabelion.operators import checks, listing
from tabelion.plans import expand, pipeline
from tabelion.plans import tables as tb
from tabelion.session import build_session
from tabelion.sources import links
from tabelion.streaming import live


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tabelion")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("expand")
    e.add_argument("--archives", required=True)
    e.add_argument("--staged", required=True)
    c = sub.add_parser("create")
    c.add_argument("--db", required=True)
    c.add_argument("--location", required=True)
    ld = sub.add_parser("load")
    ld.add_argument("--source", required=True)
    ld.add_argument("--staged", action="store_true")
    ld.add_argument("--db", required=True)
    ld.add_argument("--location", required=True)
    ld.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    ld.add_argument("--force", action="store_true")
    ld.add_argument("--lenient", action="store_true")
    ld.add_argument("--lenient-rows", action="store_true", help="store rejected records in _rejeitados and go on")
    ld.add_argument("--buckets", type=int, default=None, help="default: ~256 MB of input per bucket")
    for name in ("counts", "latest"):
        s = sub.add_parser(name)
        s.add_argument("--db", required=True)
    lk = sub.add_parser("links")
    lk.add_argument("--pages", required=True)
    lk.add_argument("--prefix", default="20")
    lk.add_argument("--suffix", default=".zip")
    m = sub.add_parser("monitor")
    m.add_argument("--folder", required=True)
    m.add_argument("--checkpoint", required=True)
    m.add_argument("--output", required=True)
    m.add_argument("--interval", default="30 seconds")
    pg = sub.add_parser("purge")
    pg.add_argument("--db", required=True)
    pg.add_argument("--yes", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(args.master)
    if args.cmd == "expand":
        expand.stage_archives(spark, args.archives, args.staged).show(truncate=False)
    elif args.cmd == "create":
        tb.create_database(spark, args.db, args.location)
        tb.create_base_tables(spark, args.db)
        checks.presence(spark, schemas.BASE_TABLES, tb.list_tables(spark, args.db)).show()
    elif args.cmd == "load":
        source = pipeline.StagedSource(spark, args.source) if args.staged else args.source
        res = pipeline.run_load(
            spark, source, args.db, args.location, args.mode, args.force, not args.lenient, args.buckets,
            not args.lenient_rows,
        )
        for r in res.state_before:
            print(f"before: {r.table_name:20} {r.state:7} {r.n_rows:>12,}")
        for d in res.decisions:
            print(f"{d['table_name']:20} {d['decision']:22} existing={d['existing']} expected={d['expected']}")
        if res.n_rejected:
            print(f"records rejected (stored in _rejeitados): {res.n_rejected}")
        res.reconciliation.show(truncate=False)
        if res.rejected_capital is not None:
            print(f"amounts rejected (stored as NULL): {res.rejected_capital}")
        pipeline.integrity(spark, args.db).show(truncate=False)
        spark.table(tb.q(args.db, "_referencia")).show()
    elif args.cmd == "counts":
        checks.derived_state(tb.counts(spark, args.db, schemas.STATE_TABLES)).show(truncate=False)
        tb.counts(spark, args.db, schemas.MONITOR_TABLES, with_text=True).show(truncate=False)
    elif args.cmd == "latest":
        est, emp = tb.read(spark, args.db, "estabelecimento"), tb.read(spark, args.db, "empresas")
        if est is not None:
            listing.latest_establishments(est).show(truncate=False)
        if emp is not None:
            listing.latest_companies(emp).show(truncate=False)
    elif args.cmd == "links":
        pages = spark.read.parquet(args.pages)
        links.latest_link(pages, args.prefix).show(truncate=False)
        links.resolved_links(pages, args.suffix).show(truncate=False)
        links.latest_folder_archives(pages, pages, args.prefix, args.suffix).show(truncate=False)
    elif args.cmd == "monitor":
        streams = live.monitor(spark, args.folder, args.checkpoint, args.output, args.interval)
        try:
            while all(q.isActive for q in streams):
                streams[0].awaitTermination(30)
                for df in live.monitor_report(spark, args.output).values():
                    df.show(truncate=False)
            for q in streams:
                if q.exception():
                    raise q.exception()
        except KeyboardInterrupt:
            for q in streams:
                q.stop()
    elif args.cmd == "purge":
        if not args.yes:
            print("purge empties every table of the database; pass --yes to confirm", file=sys.stderr)
            return 2
        report, summary = tb.purge(spark, args.db)
        report.show(truncate=False)
        summary.select("total_left", F.col("tables_with_rows")).show(truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
