"""Sources and sinks on real files in a temporary folder."""

import datetime as dt
import json
import os

import pytest

from pyspark.sql import functions as F

from duescore.sources import files as sf
from duescore.sources import sinks as sk
from duescore.sources import snapshots as ss


def test_scan_delimited_with_header(spark, tmp_dir):
    p = os.path.join(tmp_dir, "integracao_x_202401150300.csv")
    with open(p, "w") as f:
        f.write("CPF,CONTA,DIAS ATRASO\n00000000001,k1,10\n00000000002,k2,\n")
    df = sf.scan_delimited(spark, p, ["CPF", "CONTA", "DIAS ATRASO"])
    assert dict(df.dtypes) == {"CPF": "string", "CONTA": "string", "DIAS ATRASO": "string"}
    assert [tuple(r) for r in df.orderBy("CPF").collect()] == [("00000000001", "k1", "10"), ("00000000002", "k2", None)]
    named = sf.with_file_name(df)
    assert named.select("file_name").distinct().first()[0] == os.path.basename(p)


def test_scan_delimited_goes_by_header_names(spark, tmp_dir):
    p = os.path.join(tmp_dir, "reordered.csv")
    with open(p, "w") as f:
        f.write("EXTRA,CONTA,CPF\nzz,k1,00000000001\n")
    df = sf.scan_delimited(spark, p, ["CPF", "CONTA"])
    assert df.columns == ["CPF", "CONTA", "EXTRA"] and tuple(df.first()) == ("00000000001", "k1", "zz")
    with pytest.raises(ValueError, match="DIAS ATRASO"):
        sf.scan_delimited(spark, p, ["CPF", "DIAS ATRASO"])


def test_day_of_name_and_header_date(spark):
    assert sf.day_of_name("integracao_x_202401150300.csv", r"_(\d{8})\d{4}\.csv$", "%Y%m%d") == "2024-01-15"
    with pytest.raises(ValueError):
        sf.day_of_name("x.csv", r"_(\d{8})\.csv$", "%Y%m%d")
    rows = spark.createDataFrame([("0", " 2024-01-15 "), ("1", "J")], "Tipo_Registro string, Tipo_Pessoa string")
    assert str(sf.header_date(rows).first()[0]) == "2024-01-15"


def test_day_slice_is_pushed_down(spark, sf_small):
    one = ss.day_slice(spark.read.parquet(f"{sf_small}/events.parquet"), "ts", "2024-01-15")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-15" in plan and "LessThan(ts,2024-01-16" in plan


def test_scan_fixed_schema_and_control_records(spark, tmp_dir):
    p = os.path.join(tmp_dir, "company.txt")
    with open(p, "w") as f:
        f.write("0; 2024-01-15 ;\n1;J;a\n1;F;b\n9;TRAILER;\n")
    df = sf.scan_fixed_schema(spark, p, ["Tipo_Registro", "Tipo_Pessoa", "Nome"])
    out = sf.strip_control_records(df)
    assert [tuple(r) for r in out.collect()] == [("J", "a", dt.date(2024, 1, 15))]


def test_json_scan(spark, tmp_dir):
    p = os.path.join(tmp_dir, "people.json")
    with open(p, "w") as f:
        f.write(json.dumps({"_id": "p1", "deals": [{"dealID": "d1", "creditor": "c"}]}) + "\n")
    df = sf.json_scan(spark, p, "_id string, deals array<struct<dealID: string, creditor: string>>")
    assert df.select(F.col("deals")[0]["dealID"]).first()[0] == "d1"


def test_snapshot_partition_pruning(spark, tmp_dir):
    root = os.path.join(tmp_dir, "snap")
    df = spark.createDataFrame([("a", dt.date(2024, 1, 14)), ("b", dt.date(2024, 1, 15))],
                               "_id string, snapshot_date date")
    sk.write_table(df, os.path.join(root, "Info"), partition_by=["snapshot_date"])
    one = ss.read_snapshot(spark, root, "Info", "2024-01-15", ["_id"])
    assert [r[0] for r in one.collect()] == ["b"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "2024-01-15" in plan


def test_scan_pruned_pushes_filter_and_columns(spark, sf_small):
    df = ss.read_pruned(spark, f"{sf_small}/events.parquet", ["event_id", "event_type"],
                        F.col("event_type") != "error")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,error))]" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_publish_writes_both_destinations(spark, tmp_dir):
    df = spark.createDataFrame([("00000000001", 3, 0.5)], "Document string, Score int, ScoreValue double")
    prov = sk.provenance(df, Provider="p", Date=dt.date(2024, 1, 15))
    primary, secondary = os.path.join(tmp_dir, "scores"), os.path.join(tmp_dir, "export")
    sk.publish(prov, spark, primary, secondary)
    assert spark.read.parquet(primary).count() == 1
    exported = spark.read.option("header", True).option("sep", ";").csv(secondary)
    assert exported.columns == ["Document", "Score", "ScoreValue", "Provider", "Date"]
    assert len([f for f in os.listdir(secondary) if f.endswith(".csv")]) >= 1
    # rerun overwrites instead of appending (Q26)
    sk.publish(prov, spark, primary, secondary)
    assert spark.read.parquet(primary).count() == 1


def test_newest_file_from_listing(spark, tmp_dir):
    for n in ["integracao_x_202401150300.csv", "integracao_x_202401170300.csv", "integracao_x_202401160300.csv",
              "other_202501010000.csv", "full_temp"]:
        p = os.path.join(tmp_dir, n)
        os.makedirs(p) if n == "full_temp" else open(p, "w").write("CPF\n1\n")
    got = sf.newest_file(spark, tmp_dir, "integracao", r"_(\d{12})\.csv$")
    assert got.endswith("integracao_x_202401170300.csv")


def test_stage_path_uses_the_session_checkpoint_folder(spark):
    from duescore.session import checkpoint_root, stage_path
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    assert stage_path(spark, "card", "p").startswith(root)


def test_cluster_settings_size_partitions():
    from duescore.session import cluster_settings
    c = cluster_settings(5 * (1 << 40))
    assert c["spark.sql.shuffle.partitions"] == "40960"
    assert cluster_settings(1)["spark.sql.shuffle.partitions"] == "200"
