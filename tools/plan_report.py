"""Write PLANS.md: the physical shape of the composite pipelines over plain Parquet
inputs with broadcasts off (what a large cluster gets when no side is small),
counted per operator, plus the join/exchange/aggregate skeleton of each plan.

    python tools/plan_report.py [sf_dir]
"""
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from duescore.session import get_session  # noqa: E402

ROLES = ["info", "debts", "simulation", "authentication", "deals", "installments", "interactions", "campaigns",
         "persons", "card_file", "company_lines"]
KINDS = ["Exchange hashpartitioning", "Exchange SinglePartition", "Exchange rangepartitioning", "SortMergeJoin",
         "BroadcastHashJoin", "BroadcastExchange", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
         "TakeOrderedAndProject", "Union", "Generate", "Window", "FileScan", "ReusedExchange", "CartesianProduct",
         "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]
SKELETON = re.compile(r"(Exchange \w+\([^)]*\)|SortMergeJoin \[[^\]]*\], \[[^\]]*\], \w+(, \([^)]*\))?|"
                      r"BroadcastHashJoin \[[^\]]*\], \[[^\]]*\], \w+|HashAggregate\(keys=\[[^\]]{0,60}|"
                      r"SortAggregate\(key=\[[^\]]{0,60}|TakeOrderedAndProject\(limit=\d+|Union|"
                      r"FileScan parquet \[[^\]]{0,60}|ReusedExchange \[[^\]]{0,40})")


def composites(spark, roles, scratch):
    """The composite plans over plain Parquet inputs (as in production)."""
    from duescore import testbed as tb
    from duescore.operators.score import linear_scorer
    from duescore.plans.base import Sources
    from duescore.plans.card import build_card_base
    from duescore.plans.company import build_company_base
    from duescore.plans.daily import stage_at
    from duescore.plans.publish import propensity_scores
    from duescore.queries import CARD_GROUPS, COMPANY_FILE_FIELDS, sfiles

    card_src = Sources(**{k: roles[k] for k in ["info", "debts", "simulation", "authentication", "deals",
                                                  "installments", "interactions"]})
    comp_src = Sources(**{k: roles[k] for k in ["info", "debts", "simulation", "authentication", "campaigns",
                                                  "persons"]})
    card = build_card_base(roles["card_file"], card_src, tb.CARD, tb.FILE_DAY)
    parsed = sfiles.parse_lines(roles["company_lines"], COMPANY_FILE_FIELDS, sep=";")
    company = build_company_base(parsed, comp_src, tb.COMPANY, tb.COMPANY_FILE_NAME, tb.COMPANY_CREDITOR_ID,
                                 tb.FILE_DAY, tb.AS_OF)
    scorer = linear_scorer(tb.CARD_COEFFICIENTS, tb.CARD_INTERCEPT)
    scores = propensity_scores(card, tb.CARD, CARD_GROUPS, scorer, tb.AS_OF, tb.FILE_DAY, tb.AS_OF)
    stage = stage_at(spark, os.path.join(scratch, "joined"))
    staged = build_card_base(roles["card_file"], card_src, tb.CARD, tb.FILE_DAY, stage)
    deals = build_card_base(roles["card_file"], card_src, tb.CARD, tb.FILE_DAY, stage, "deal")
    company_stage = stage_at(spark, os.path.join(scratch, "company-joined"))
    company_staged = build_company_base(parsed, comp_src, tb.COMPANY, tb.COMPANY_FILE_NAME, tb.COMPANY_CREDITOR_ID,
                                        tb.FILE_DAY, tb.AS_OF, stage=company_stage)
    return {"feature_base_card, file x profile join staged (registered query and daily job)": staged,
            "feature_base_card_deals, staged": deals,
            "feature_base_company, staged (registered query and daily job)": company_staged,
            "feature_base_card without a stage": card, "feature_base_company without a stage": company,
            "propensity_scores without a stage": scores}


def main():
    import tempfile

    from duescore import testbed as tb

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    scratch = tempfile.mkdtemp(prefix="plan-report-")
    roles = {}
    for r in ROLES:
        path = os.path.join(scratch, r)
        getattr(tb, r)(spark, sf).write.parquet(path)
        roles[r] = spark.read.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    # Static planning, so that exchange reuse is visible as ReusedExchange (AQE
    # applies the same reuse at run time, when it creates stages).
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = ["# Physical plans of the composite pipelines", "",
           "Generated by `tools/plan_report.py`: the input roles of `testbed.py` are first written as plain",
           f"Parquet tables (from `{sf}`), as production inputs are, and the plans are built over those scans",
           "with `autoBroadcastJoinThreshold=-1`, so no side is broadcast by size, as on a large cluster. The",
           "only broadcasts left are the hot-pair tables of proven size. Planned with AQE off so that shared",
           "subplans show as `ReusedExchange` (AQE reuses the same exchanges at run time, and may also coalesce",
           "partitions, split skewed ones and switch measured-small sides to broadcast).",
           ""]
    for name, df in composites(spark, roles, scratch).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        c = Counter()
        for line in plan.splitlines():
            s = re.sub(r"^\*\(\d+\) ", "", line.strip().lstrip(":-+ "))
            for k in KINDS:
                if s.startswith(k):
                    c[k] += 1
        out += [f"## `{name}`", "", "| operator | count |", "| --- | --- |"]
        out += [f"| {k} | {v} |" for k, v in sorted(c.items())]
        out += ["", "```"]
        for line in plan.splitlines():
            m = SKELETON.search(line)
            if m:
                depth = (len(line) - len(line.lstrip(" :+-"))) // 3
                out.append("  " * depth + re.sub(r"#\d+L?", "", m.group(1))[:110])
        out += ["```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
