"""Run one refresh: ``python -m logloom``, or ``spark-submit logloom/__main__.py`` on a cluster.

    python -m logloom --landing <dir> --warehouse <dir> --tenant "Tenant" \\
        [--batch-id <epoch s>] [--last-run <epoch ms>] [--chunk-size 15000] \\
        [--scope select|skip --combo WS:MODEL ... --target-model MODEL] [--sample LIST ...] [--full-refresh] [--strict]

Prints the run summary as one JSON line.  The session comes from the
cluster (``spark-submit``); only when none is configured does it run locally.
"""

from __future__ import annotations

import argparse
import json
import time

from logloom.plans.refresh import RefreshSettings, run_refresh
from logloom.session import get_session
from logloom.streaming import compact as CP


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="logloom", description="Incremental audit-log refresh on Spark")
    p.add_argument("--landing", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--tenant", required=True)
    p.add_argument("--batch-id", type=int, default=None, help="run stamp, epoch seconds (default: now)")
    p.add_argument("--last-run", type=int, default=None, help="override the saved watermark (epoch ms)")
    p.add_argument("--chunk-size", type=int, default=15000)
    p.add_argument("--scope", choices=["all", "select", "skip"], default="all")
    p.add_argument("--combo", action="append", default=[], help="WORKSPACE_ID:MODEL_ID, repeatable")
    p.add_argument("--target-model", default=None)
    p.add_argument("--sample", action="append", default=[], metavar="LIST",
                   help="write this list as a sample file instead of chunks, repeatable; \"all\" for every list")
    p.add_argument("--full-refresh", action="store_true", help="drop stored events, stream checkpoint and state first")
    p.add_argument("--max-files", type=int, default=None, help="landed files per micro-batch")
    p.add_argument("--accept-pull", action="append", default=[], metavar="RUN", help="take this short pull as it is, repeatable")
    p.add_argument("--accept-short-lists", action="store_true", help="go on although a list has delivered less than it announces")
    p.add_argument("--no-publish", action="store_true", help="write the run's set to look at, commit nothing")
    p.add_argument("--retire-to", default=None, metavar="DIR", help="archive event pages that are done in this folder outside the landing")
    p.add_argument("--compact-batches", type=int, default=CP.MIN_BATCHES,
                   help="rewrite so many stored micro-batches to larger files together (0: never)")
    p.add_argument("--keep-versions", type=int, default=2, help="published sets kept, the newest included")
    p.add_argument("--strict", action="store_true", help="reproduce the source's behaviour (SURVEY D-n)")
    p.add_argument("--master", default=None, help="only for local runs")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> dict:
    a = parse(argv)
    settings = RefreshSettings(
        tenant_name=a.tenant,
        batch_id=a.batch_id if a.batch_id is not None else int(time.time()),
        last_run=a.last_run, chunk_size=a.chunk_size, scope_approach=a.scope,
        scope_combos=[tuple(c.split(":", 1)) for c in a.combo], target_model=a.target_model,
        samples=tuple(a.sample), strict=a.strict, full_refresh=a.full_refresh, max_files=a.max_files,
        accept_pulls=tuple(a.accept_pull), accept_short_lists=a.accept_short_lists,
        publish=not a.no_publish, keep_versions=a.keep_versions,
        retire_to=a.retire_to, compact_batches=a.compact_batches,
    )
    spark = get_session(a.master)
    summary = run_refresh(spark, a.landing, a.warehouse, settings)
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    found = main()
    raise SystemExit(3 if "held" in found or "open" in found else 0)
