"""Write the final (post-AQE) physical plan tree of every check query to PLANS.md.

Usage: python tools/plans.py [sf_dir] > PLANS.md
       python tools/plans.py sf_dir NAME... (only these queries' sections)

Each query is executed with ``collect()`` on its own Dataset so that the
adaptive plan is finalised, then the operator tree of ``explain("formatted")``
is kept, with a one-line summary of shuffles, broadcasts and scans.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from relprep.session import build_session  # noqa: E402


def tree_of(df) -> tuple[str, str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    body = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
    # Keep the final adaptive plan only; also return the subquery section.
    sub = text[text.find("===== Subqueries ====="):] if "===== Subqueries =====" in text else ""
    return body.split("+- == Initial Plan ==")[0], sub


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8, app_name="relprep-plans")
    from relprep.plans import CHECKS

    only = sys.argv[2:]
    if not only:
        preamble(sf_dir)
    for name, c in CHECKS.items():
        if only and name not in only:
            continue
        df = c.fn(spark, sf_dir)
        df.collect()
        tree, sub = tree_of(df)
        shuffles = len(re.findall(r"(?<!Broadcast)Exchange \(", tree))
        reused = len(re.findall(r"Reused", tree))
        bcast = len(re.findall(r"BroadcastExchange", tree))
        scans = len(re.findall(r"Scan ", tree))
        print(f"## {name}\n")
        n_sub = len(re.findall(r"^Subquery:\d+", sub, flags=re.M))
        sub_reuse = sub.count("ReusedExchange [Reuses")
        print(
            f"shuffles: {shuffles}, broadcasts: {bcast}, reused: {reused}, scans: {scans}, "
            f"scalar subqueries: {n_sub} (exchanges reused from the main plan: {sub_reuse})\n"
        )
        print("```\n" + tree.rstrip() + "\n```\n")
        keys = cluster_shape_shuffles(spark, c.fn, sf_dir)
        print("Cluster shape (no broadcast, static plan) shuffles on: " + (", ".join(f"`{k}`" for k in keys) or "none") + "\n")
    spark.stop()


def preamble(sf_dir: str) -> None:
    print("# Physical plans of the check queries\n")
    print(f"Final adaptive plans at `{sf_dir}` (local[8], 8 shuffle partitions), generated by `tools/plans.py`.")
    print("Counts: `Exchange` = shuffle (or reused), `BroadcastExchange` = broadcast side, `Scan` = table reads.")
    print("At this size AQE measures every dimension under the broadcast threshold and broadcasts it; at")
    print("100 TB the same logical plans become shuffled sort-merge joins with skew splitting, except for")
    print("sides whose size is bounded (nation, region, top-n keys, per-partition offsets).\n")


def cluster_shape_shuffles(spark, fn, sf_dir) -> list[str]:
    """Hash-partitioning keys of the plan when no side may be broadcast:
    the shuffles a 100 TB run would do (nation/region aside)."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    keys = re.findall(r"Exchange hashpartitioning\((.+?), \d+\)", plan)
    return ["(" + re.sub(r"#\d+L?", "", k) + ")" for k in keys]


if __name__ == "__main__":
    main()
