"""Summarise the physical plan of registered queries.

    python tools/plan_report.py [--sf DIR] [name ...]

For each query: shuffle and broadcast exchanges, sorts, window group
limits, Python evaluation nodes, and every scan's read schema and pushed
filters (from ``explain("formatted")`` of the final adaptive plan).
"""

from __future__ import annotations

import argparse
import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(text: str) -> dict:
    final = text.split("+- == Initial Plan ==")[0]
    head = final.split("\n\n")[0]
    count = lambda pat: len(re.findall(pat, head))
    scans = []
    for block in re.findall(r"\(\d+\) Scan parquet[^\n]*\n(.*?)(?=\n\(\d+\)|\Z)", text, re.S):
        rs = re.search(r"ReadSchema: (.*)", block)
        pf = re.search(r"PushedFilters: (.*)", block)
        loc = re.search(r"Location: \S+ \[([^\]]*)\]", block)
        scans.append((os.path.basename(loc.group(1)) if loc else "?", rs.group(1) if rs else "", pf.group(1) if pf else ""))
    return {
        "shuffles": count(r"\bExchange \(") + count(r"ShuffleQueryStage"),
        "broadcasts": count(r"BroadcastExchange") + count(r"BroadcastQueryStage"),
        "reused": count(r"Reused"),
        "sorts": count(r"\bSort \("),
        "group_limits": count(r"WindowGroupLimit"),
        "python": count(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)"),
        "scans": scans,
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from obsengine.plans import registry
    from obsengine.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16)
    registry.load_all()
    for name in args.names or sorted(registry.QUERIES):
        df = registry.QUERIES[name](spark, args.sf)
        df.write.format("noop").mode("overwrite").save()
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        s = summarise(buf.getvalue())
        print(f"{name}: shuffles={s['shuffles']} broadcasts={s['broadcasts']} reused={s['reused']} "
              f"sorts={s['sorts']} group_limits={s['group_limits']} python={s['python']}")
        for loc, rs, pf in s["scans"]:
            print(f"    scan {loc}: {rs}  pushed={pf}")
    spark.stop()


if __name__ == "__main__":
    main()
