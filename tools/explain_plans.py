"""Write PLANS.md: the physical operator trees of the key stages (from
``explain("formatted")``) with the scan details (pushed filters, read schema,
partition filters), for review.

usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mediapanel.plans.chain import Chain  # noqa: E402
from mediapanel.plans.registry import QUERIES  # noqa: E402
from mediapanel.session import checkpoint_dir, get_spark  # noqa: E402


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def condense(plan: str) -> str:
    tree, _, details = plan.partition("\n\n\n")
    keep = []
    for block in details.split("\n\n"):
        head = block.strip().splitlines()[0] if block.strip() else ""
        if "Scan" in head:
            lines = [ln for ln in block.splitlines()
                     if ln.startswith(("(", "PushedFilters", "PartitionFilters", "ReadSchema", "Location"))]
            keep.append("\n".join(lines))
    tree = re.sub(r"\s+$", "", tree, flags=re.M)
    return tree + ("\n\n" + "\n\n".join(keep) if keep else "")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    lazy = Chain(spark, sf_dir, cache_marts=False)
    base = f"{checkpoint_dir(spark).rstrip('/')}/plans-{uuid.uuid4().hex[:8]}"
    landed = Chain(spark, sf_dir, cache_marts=False)
    landed.land_bronze(base)
    landed.materialize(base)
    from dataclasses import replace
    inc = Chain(spark, sf_dir, replace(landed.p, refresh_days=21), cache_marts=False)
    inc.raw = landed.raw
    from mediapanel.operators import panel as P
    sections = [
        ("Sales staging + fact from bronze, 21-day refresh (ingest-partition pruning, dedup, two-level "
         "aggregate, FX broadcast)", inc.fact_platform_sales),
        ("Daily channel panel from the written facts",
         P.daily_channel_panel(landed.fact_platform_sales, landed.fact_onplatform_ads,
                               landed.fact_offplatform_ads, landed.calendar)),
        ("Weekly channel deltas over the written panel (scan prunes date partitions)",
         QUERIES["channel_deltas"](landed)),
        ("Adstock (bounded window fold per market x channel)", QUERIES["adstock"](landed)),
        ("Data-quality suite (one job)", QUERIES["dq_suite"](landed)),
        ("Order-line binding from the driver tables (lazy path)", lazy.raw["shopee_orders"]),
    ]
    out = ["# Physical plans of the key stages", "",
           f"Generated by `tools/explain_plans.py` on `{sf_dir}` (local[8], AQE initial plans). "
           "Trees only, plus scan details.", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", condense(formatted(df)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
