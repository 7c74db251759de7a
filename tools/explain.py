"""Summarize the physical plans of registered queries.

Usage: python tools/explain.py [sf_dir] [query ...]

For each query: join strategies, exchanges (shuffles) by kind, pushed
filters and read schemas of the scans, and whether any Python evaluation,
nested-loop join or single-partition exchange appears.  ``--full`` prints
the whole ``explain("formatted")`` text as well.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logloom import catalog  # noqa: E402
from logloom.session import get_session  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> dict:
    tree = text.split("\n\n(1)")[0]
    ops = Counter(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                             r"CartesianProduct|HashAggregate|SortAggregate|ObjectHashAggregate|Window|"
                             r"BatchEvalPython|ArrowEvalPython|MapInPandas|Generate|TakeOrderedAndProject)", tree))
    exchanges = Counter(re.findall(r"Arguments: (hashpartitioning|rangepartitioning|RoundRobinPartitioning|"
                                   r"SinglePartition)", text))
    pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\]]*\])", text)) - {"[]"})
    return {"operators": dict(ops), "exchanges": dict(exchanges), "pushed_filters": pushed,
            "broadcasts": text.count("BroadcastExchange")}


def main() -> None:
    args = [a for a in sys.argv[1:] if a != "--full"]
    full = "--full" in sys.argv
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    names = [a for a in args if a != sf_dir] or ["audit_report", "incremental_filter", "export_chunks",
                                                  "batch_row_index", "resolve_ids", "history_merge"]
    spark = get_session("local[8]")
    for name in names:
        text = formatted(catalog.QUERIES[name](spark, sf_dir))
        print(f"## {name}\n{summarize(text)}\n")
        if full:
            print(text)
    spark.stop()


if __name__ == "__main__":
    main()
