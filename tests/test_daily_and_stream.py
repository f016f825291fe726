"""End to end: snapshot layout on disk -> daily run -> published scores; landing-folder stream."""

import os

import pytest
from pyspark.sql import functions as F

from duescore import testbed as tb
from duescore.operators import score as sc
from duescore.plans.daily import (CARD_FILE_COLUMNS, Layout, company_layout, read_card_file, run_card_day,
                                  run_card_landing, run_company_day, run_company_landing)
from duescore.queries import CARD_GROUPS, COMPANY_GROUPS, QUERIES
from duescore.sources.commits import newest, read_committed
from duescore.sources.sinks import write_table
from duescore.streaming import portfolio_batch, run_landed_files

SF = "/root/testdata/sf0.001"
CARD_SCORER = sc.linear_scorer(tb.CARD_COEFFICIENTS, tb.CARD_INTERCEPT)
COMPANY_SCORER = sc.linear_scorer(tb.COMPANY_COEFFICIENTS, tb.COMPANY_INTERCEPT)


def _write_layout(spark, root):
    day = F.to_date(F.lit(tb.FILE_DAY))
    for role, name in Layout(root).snapshot_tables.items():
        df = getattr(tb, role)(spark, SF).withColumn("snapshot_date", day)
        write_table(df, os.path.join(root, name), partition_by=["snapshot_date"])
    tb.interactions(spark, SF).write.parquet(os.path.join(root, "interactions"))


def _write_card_file(spark, path):
    pdf = tb.card_file(spark, SF).toPandas()
    pdf.to_csv(path, index=False)


def _expected(spark, name="propensity_scores"):
    return sorted(tuple(r) for r in QUERIES[name](spark, SF).select("Document", "Score").collect())


def _scores(df):
    return sorted(tuple(r) for r in df.select("Document", "Score").collect())


def test_daily_run_matches_the_registered_query(spark, tmp_dir):
    root = os.path.join(tmp_dir, "snapshots")
    _write_layout(spark, root)
    path = os.path.join(tmp_dir, "integracao_card_202401150300.csv")
    _write_card_file(spark, path)
    out_root = os.path.join(tmp_dir, "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = run_card_day(spark, read_card_file(spark, path), Layout(root), tb.CARD, tb.FILE_DAY, tb.FILE_DAY,
                           CARD_GROUPS, CARD_SCORER, tb.AS_OF, tb.AS_OF, out_root)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert _scores(out) == _expected(spark)
    assert os.path.isdir(os.path.join(out_root, "feature_base", f"file_date={tb.FILE_DAY}"))
    export = os.path.join(out_root, "export", f"{tb.CARD.provider}_{tb.AS_OF}")
    assert len([f for f in os.listdir(export) if f.endswith(".csv")]) > 1         # written in parallel


def test_a_committed_day(spark, tmp_dir):
    """With a run id the outputs go to folders of the run and one manifest shows them together."""
    root, out_root, export_root = (os.path.join(tmp_dir, n) for n in ("snapshots", "out", "other"))
    _write_layout(spark, root)
    path = os.path.join(tmp_dir, "integracao_card_202401150300.csv")
    _write_card_file(spark, path)
    args = (Layout(root), tb.CARD, tb.FILE_DAY, tb.FILE_DAY, CARD_GROUPS, CARD_SCORER, tb.AS_OF, tb.AS_OF, out_root, export_root)
    slot = f"file_date={tb.FILE_DAY}"
    for version, run_id in ((1, "first"), (2, "second")):
        out = run_card_day(spark, read_card_file(spark, path), *args, run_id=run_id)
        done = newest(spark, out_root, slot)
        assert (done.version, done.run_id, sorted(done.outputs)) == (version, run_id, ["export", "feature_base", "scores"])
        assert done.outputs["export"].path.startswith(export_root) and done.outputs["export"].rows == done.outputs["scores"].rows
    assert _scores(out) == _expected(spark)
    export = read_committed(spark, out_root, slot, "export").select("Document", F.col("Score").cast("int").alias("Score"))
    assert _scores(export) == _expected(spark)
    with pytest.raises(Exception, match="first"):            # a run's folder is never written twice
        run_card_day(spark, read_card_file(spark, path), *args, run_id="first")


def test_landing_folder_to_scores_card(spark, tmp_dir):
    root, landing = os.path.join(tmp_dir, "snapshots"), os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    _write_layout(spark, root)
    _write_card_file(spark, os.path.join(landing, "integracao_card_202401150300.csv"))
    for name in ("integracao_card_202401140300.csv", "other_209901010000.csv", "integracao_card.csv"):
        with open(os.path.join(landing, name), "w") as f:
            f.write("not,this,one\n1,2,3\n")
    out = run_card_landing(spark, landing, Layout(root), tb.CARD, tb.FILE_DAY, CARD_GROUPS,
                           sc.tree_scorer(tb.CARD_TREES, tb.CARD_TREE_BASE), tb.AS_OF, tb.AS_OF, os.path.join(tmp_dir, "out"))
    assert _scores(out) == _expected(spark, "propensity_scores_trees")
    assert {str(r[0]) for r in out.select("Date").distinct().collect()} == {tb.FILE_DAY}


def _write_company_inputs(spark, tmp_dir):
    root = os.path.join(tmp_dir, "snapshots")
    layout = company_layout(root)
    for role, name in layout.snapshot_tables.items():
        write_table(getattr(tb, role)(spark, SF).withColumn("snapshot_date", F.to_date(F.lit(tb.FILE_DAY))),
                    os.path.join(root, name), partition_by=["snapshot_date"])
    for role, name in layout.undated_tables.items():
        getattr(tb, role)(spark, SF).write.parquet(os.path.join(root, name))
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    path = os.path.join(landing, tb.COMPANY_FILE_NAME)
    with open(path, "w") as f:
        f.write("\n".join(r[0] for r in tb.company_lines(spark, SF).collect()) + "\n")
    return layout, landing, path


def test_company_runs_match_the_registered_query(spark, tmp_dir):
    layout, landing, path = _write_company_inputs(spark, tmp_dir)
    want = _expected(spark, "propensity_scores_company")
    out = run_company_day(spark, path, layout, tb.COMPANY, tb.FILE_DAY, tb.FILE_DAY, tb.COMPANY_CREDITOR_ID,
                          COMPANY_GROUPS, COMPANY_SCORER, tb.AS_OF, tb.AS_OF, os.path.join(tmp_dir, "out"))
    assert _scores(out) == want and len(want) > 0
    out = run_company_landing(spark, landing, layout, tb.COMPANY, tb.FILE_DAY, tb.COMPANY_CREDITOR_ID, COMPANY_GROUPS,
                              COMPANY_SCORER, tb.AS_OF, tb.AS_OF, os.path.join(tmp_dir, "out2"))
    assert _scores(out) == want
    assert {str(r[0]) for r in out.select("Date").distinct().collect()} == {tb.FILE_DAY}    # from the header record


def test_batch_of_two_files_is_refused(spark, tmp_dir):
    files = spark.createDataFrame([("a.csv",), ("b.csv",), ("b.csv",)], "file_path string")
    with pytest.raises(ValueError, match="one file"):
        portfolio_batch(spark, files, CARD_FILE_COLUMNS)
    assert portfolio_batch(spark, files.limit(0), CARD_FILE_COLUMNS) is None


def test_landed_file_is_read_by_its_header(spark, tmp_dir):
    p = os.path.join(tmp_dir, "x.csv")
    with open(p, "w") as f:
        f.write("CONTA,CPF,EXTRA\nk1,1,zz\n")
    rows, name = portfolio_batch(spark, spark.createDataFrame([(p,)], "file_path string"), ["CPF", "CONTA"])
    assert name == "x.csv" and rows.columns == ["CPF", "CONTA", "EXTRA"] and tuple(rows.first()) == ("1", "k1", "zz")


def test_landing_stream_processes_each_file_once(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    _write_card_file(spark, os.path.join(landing, "integracao_card_202401150300.csv"))
    seen = []

    def handle(rows, file_name, batch_id):
        seen.append((file_name, rows.count()))

    ckpt = os.path.join(tmp_dir, "ckpt")
    q = run_landed_files(spark, landing, CARD_FILE_COLUMNS, ckpt, handle)
    q.awaitTermination(120)
    assert [s[0] for s in seen] == ["integracao_card_202401150300.csv"] and seen[0][1] > 0
    _write_card_file(spark, os.path.join(landing, "integracao_card_202401160300.csv"))
    q = run_landed_files(spark, landing, CARD_FILE_COLUMNS, ckpt, handle)
    q.awaitTermination(120)
    assert [s[0] for s in seen] == ["integracao_card_202401150300.csv", "integracao_card_202401160300.csv"]


def test_stream_handler_runs_the_daily_job(spark, tmp_dir):
    from duescore.sources.files import day_of_name

    root = os.path.join(tmp_dir, "snapshots")
    _write_layout(spark, root)
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    _write_card_file(spark, os.path.join(landing, "integracao_card_202401150300.csv"))
    out_root = os.path.join(tmp_dir, "out")

    def handle(rows, file_name, batch_id):
        day = day_of_name(file_name, r"_(\d{8})\d{4}\.csv$", "%Y%m%d")
        run_card_day(spark, rows, Layout(root), tb.CARD, tb.FILE_DAY, day, CARD_GROUPS, CARD_SCORER, tb.AS_OF, tb.AS_OF,
                     out_root)

    q = run_landed_files(spark, landing, CARD_FILE_COLUMNS, os.path.join(tmp_dir, "ckpt"), handle)
    q.awaitTermination(300)
    scores = spark.read.parquet(os.path.join(out_root, "scores"))
    got = sorted(tuple(r) for r in scores.select("Document", "Score").collect())
    assert got == _expected(spark)
