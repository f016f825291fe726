"""Physical-plan checks for the composite pipelines: no cartesian products, no
Python in the hot path, pivots without a value-discovery job, filters at the scan."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from duescore import queries
from duescore import testbed as tb
from duescore.plans.base import creditor_contracts, creditor_debts, other_creditor_persons

SF = "/root/testdata/sf0.001"
COMPOSITES = ["feature_base_card", "feature_base_company", "propensity_scores", "propensity_scores_company"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", COMPOSITES)
def test_no_cartesian_or_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "MapInPandas", "FlatMapGroupsInPandas"):
        assert bad not in plan, bad


def lazy_bases(spark):
    """The composites as the library builds them without a stage table."""
    parsed = queries.sfiles.parse_lines(tb.company_lines(spark, SF), queries.COMPANY_FILE_FIELDS, sep=";")
    args = (tb.COMPANY_FILE_NAME, tb.COMPANY_CREDITOR_ID, tb.FILE_DAY, tb.AS_OF)
    card = queries.build_card_base(tb.card_file(spark, SF), tb.card_sources(spark, SF), tb.CARD, tb.FILE_DAY)
    return {"card": card, "company": queries.build_company_base(parsed, tb.company_sources(spark, SF), tb.COMPANY, *args)}


def test_unstaged_bases_without_cartesian_python_or_sorted_aggregates(spark):
    for df in lazy_bases(spark).values():
        plan = plan_of(df)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "MapInPandas", "SortAggregate"):
            assert bad not in plan, bad


def test_staged_card_base_joins_the_wide_rows_once(spark):
    """The registered form: the file and the profile are read for the stage alone, and every grain
    plans one salted join of the staged rows."""
    for name in ("feature_base_card", "feature_base_card_deals"):
        plan = plan_of(entry.queries()[name](spark, SF))
        assert "SortAggregate" not in plan
        wide = [line for line in plan.splitlines() if "FileScan" in line and "tag_telefone" in line or "Scan parquet" in line and "tag_telefone" in line]
        assert len(wide) == 1, wide


def test_pivot_values_given(spark):
    # with explicit values Spark plans the pivot without running a job to find them
    jobs_before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    df = entry.queries()["pivot_activation"](spark, SF)
    jobs_after = spark.sparkContext.statusTracker().getJobIdsForGroup()
    assert len(jobs_after) == len(jobs_before)
    assert df.columns == ["document", "ACION_EMAIL_QTD_ATIVADO", "ACION_SMS_QTD_ATIVADO",
                          "ACION_EMAIL_QTD_NAO_ATIVADO", "ACION_SMS_QTD_NAO_ATIVADO"]


def test_creditor_filter_reaches_the_scan(spark):
    plan = plan_of(entry.queries()["feature_base_card"](spark, SF))
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan


def test_building_a_plan_runs_no_job(spark):
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    lazy_bases(spark)     # the registered composites write a stage table, as the daily jobs do
    for name in ("count_asof_simulation", "activation_label"):
        entry.queries()[name](spark, SF)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == before


def test_existence_of_debts_reads_no_tags(spark):
    """Facts that only ask whether a debt exists do not aggregate the tags joined to the debts,
    and both kinds of tags come from one aggregate over the line items."""
    debts = tb.debts(spark, SF)
    for narrow in (other_creditor_persons(debts, tb.CARD), creditor_contracts(debts, tb.CARD)):
        assert "l_orderkey" not in narrow._jdf.queryExecution().optimizedPlan().toString()
    own = creditor_debts(debts, tb.CARD).select("_id", "contract").distinct()
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, creditor_contracts(debts, tb.CARD).distinct().collect()))


def test_line_tags(spark, tmp_path):
    rows = [(1, 3), (1, 1), (1, 3), (1, None), (2, 9), (2, 0), (3, 7), (None, 2), (4, None), (5, -1), (5, 33)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    out = tb.order_lines(spark, str(tmp_path)).unionByName(spark.createDataFrame([(6, None)], "l_orderkey long, lines int"))
    got = {r[0]: r[1] for r in out.select("l_orderkey", tb.line_tags(tb.RANK_WORDS, F.col("lines"))).collect()}
    assert got == {1: ["rank:a", "rank:c"], 2: [], 3: ["rank:g"], None: ["rank:b"], 4: [], 5: [], 6: None}
    words = tb.line_tags(tb.SKIP_WORDS, F.col("lines"))
    assert {r[0]: r[1] for r in out.select("l_orderkey", words).collect()}[1] == sorted([tb.SKIP_WORDS[0], tb.SKIP_WORDS[2]])
