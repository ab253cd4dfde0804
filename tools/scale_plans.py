"""Write PLANS.md: physical plans of key jobs as they look at scale.

At the test sizes every dimension is small enough to broadcast.  Here the
star is re-planned with automatic broadcasting off and no known dimension
sizes (as for a 100 TB patient or provider dimension), so joins show as
shuffle joins; only bounded sides (top-k keys, payers, calendar) keep an
explicit broadcast.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOBS = ["brand_leaderboard", "brand_by_state", "condition_encounter_cost", "orphan_checks",
        "bi_encounter", "cost_distribution"]


def main():
    from carestar.operators import joins
    from carestar.registry import JOBS as REG
    from carestar.session import build_session
    from carestar.sources.warehouse import star_for

    spark = build_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    star = star_for(spark, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
    # The patients are too many to broadcast, as at 100 TB.
    joins.MAX_BROADCAST_BYTES = joins.plan_bytes(star.dim_patient.select("patient_key")) - 1
    out = ["# Physical plans at scale", "",
           "Generated by `tools/scale_plans.py`: automatic broadcast off, the patient dimension",
           "above the size that is broadcast (as at 100 TB).  Paths shortened.", ""]
    for name in JOBS:
        df = REG[name](star)
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"file:[^\]\s,]*", "<path>", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        out += [f"## {name}", "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
