"""Write PLANS.md: the final (adaptive) physical plans of the headline
queries, after execution, at $PLANS_SF_DIR (default sf0.01)."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

KEYS = ["divergences", "validation_summary", "readback_reconcile", "bounded_queue_read",
        "sheet_to_table", "handoff_flat"]


def main() -> None:
    from lotguard.plans.queries import QUERIES
    from lotguard.session import get_session

    sf_dir = os.environ.get("PLANS_SF_DIR", "/root/testdata/sf0.01")
    spark = get_session()
    parts = ["# Physical plans\n",
             f"Final adaptive plans after execution at `{sf_dir}` (local[8]); regenerate with "
             "`python explain_plans.py`.\n"]
    for key in KEYS:
        df = QUERIES[key](spark, sf_dir)
        # Run the plan itself (nothing is collected), so that it is the final adaptive one.
        df._jdf.queryExecution().toRdd().count()
        plan = df._jdf.queryExecution().executedPlan().toString()
        parts.append(f"## {key}\n\n```\n{plan.strip()}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
