"""Runs that become visible together, formats that are refused, bad lines, snapshots by
person and daily partials (S3, S4, S6, S7, S10, S11, JN1, JN8)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from duescore import testbed as tb
from duescore.operators import daily_counts as dc
from duescore.operators import enrich as en
from duescore.sources import by_person as bp
from duescore.sources import commits as co
from duescore.sources import files as sf
from duescore.sources import snapshots as ss

SLOT = "file_date=2024-01-15"


def _scores(spark, value):
    return spark.createDataFrame([(f"{i:011d}", value) for i in range(20)], "Document string, Score int")


def _publish(spark, root, other, value, run_id=None):
    run = co.Run(spark, root, SLOT, run_id)
    scores = run.write("scores", _scores(spark, value))
    run.write("export", scores, root=other, format="csv", header=True, sep=";")
    return run


def _seen(spark, root):
    """What readers of both destinations see."""
    out = {name: {int(r.Score) for r in co.read_committed(spark, root, SLOT, name).collect()} for name in ("scores", "export")}
    assert out["scores"] == out["export"]
    return out["scores"]


def test_a_commit_shows_both_destinations(spark, tmp_dir):
    root, other = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    with pytest.raises(FileNotFoundError):
        co.read_committed(spark, root, SLOT, "scores")
    run = _publish(spark, root, other, 1)
    assert co.newest(spark, root, SLOT) is None                      # written, not yet visible
    first = run.commit()
    assert first.version == 1 and first.outputs["scores"].rows == 20 and _seen(spark, root) == {1}
    assert _publish(spark, root, other, 2).commit().version == 2     # a rerun replaces
    assert _seen(spark, root) == {2}
    assert co.committed(spark, root, SLOT, 1) == first


@pytest.mark.parametrize("step", ["first write", "second write", "audit", "manifest"])
def test_a_run_that_stops_changes_nothing(spark, tmp_dir, monkeypatch, step):
    root, other = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    _publish(spark, root, other, 1).commit()
    run = co.Run(spark, root, SLOT, "stopped")
    broken = _scores(spark, 2).withColumn("Score", F.when(F.col("Document") == f"{7:011d}", F.raise_error(F.lit("lost"))).otherwise(F.col("Score")))
    if step == "first write":
        with pytest.raises(Exception, match="lost"):
            run.write("scores", broken)
    else:
        run.write("scores", _scores(spark, 2))
        if step == "second write":
            with pytest.raises(Exception, match="lost"):
                run.write("export", broken, root=other, format="csv", header=True, sep=";")
        else:
            run.write("export", _scores(spark, 2), root=other, format="csv", header=True, sep=";")
            if step == "audit":
                part = next(f for f in os.listdir(run.outputs["export"].path) if f.endswith(".csv"))
                os.truncate(os.path.join(run.outputs["export"].path, part), 0)
                [os.unlink(os.path.join(run.outputs["export"].path, f)) for f in os.listdir(run.outputs["export"].path) if f.endswith(".crc")]
                with pytest.raises(co.AuditError, match="export"):
                    run.commit()
            else:
                monkeypatch.setattr(co, "_put_text", lambda *a: (_ for _ in ()).throw(OSError("gone")))
                with pytest.raises(OSError):
                    run.commit()
                monkeypatch.undo()
    assert _seen(spark, root) == {1}
    _publish(spark, root, other, 3).commit()
    assert _seen(spark, root) == {3}
    gone = co.sweep(spark, root, SLOT, ["scores", "export"], keep=1, roots=[other])
    assert any(g.endswith("/stopped") for g in gone) and _seen(spark, root) == {3}
    assert co.versions(spark, root, SLOT) == [2]
    assert len(os.listdir(os.path.join(root, "scores", SLOT))) == 1


def test_a_manifest_is_never_replaced(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m", "000000001.json")
    co._put_text(spark, path, "a")
    with pytest.raises(RuntimeError, match="another run"):
        co._put_text(spark, path, "b")
    assert co._read_text(spark, path) == "a" and os.listdir(os.path.dirname(path)).count("000000001.json") == 1
    with pytest.raises(ValueError):
        co.Run(spark, tmp_dir, "a/b")


def test_a_transaction_log_is_not_read_as_plain_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "interactions")
    spark.range(3).write.parquet(path)
    assert ss.read_table(spark, path).count() == 3
    with pytest.raises(ss.WrongFormat, match="no transaction log"):
        ss.read_table(spark, path, "delta")
    os.makedirs(os.path.join(path, "_delta_log"))
    with pytest.raises(ss.WrongFormat, match="'delta'"):
        ss.read_table(spark, path)
    with pytest.raises(ss.WrongFormat, match="no package"):
        ss.read_table(spark, path, "delta")


BAD = "k1;a;b\nk2;a\nk3;a;b;c;d\nk4;\"a;b\nk5;a;\n\nk6;\"a;x\";b\n"


def test_lines_that_do_not_fit(spark, tmp_dir):
    path, bad = os.path.join(tmp_dir, "in.txt"), os.path.join(tmp_dir, "bad")
    open(path, "w").write(BAD)
    scanned = sf.scan_checked(spark, path, ["k", "x", "y"])
    with pytest.raises(sf.TooManyBadLines, match="3 of 6"):
        sf.split_lines(scanned, bad, 0.4)
    good = sf.split_lines(scanned, bad, 0.5)
    assert sorted(map(repr, map(tuple, good.collect()))) == ["('k1', 'a', 'b')", "('k5', 'a', None)", "('k6', 'a;x', 'b')"]
    aside = sf.left_out(scanned, bad).collect()
    assert sorted(r._line for r in aside) == ["k2;a", "k3;a;b;c;d", 'k4;"a;b'] and {r._file for r in aside} == {"in.txt"}
    assert good.count() == 3 and [r.k for r in good.select("k").orderBy("k").collect()] == ["k1", "k5", "k6"]     # pruned to one column


def test_control_records_are_no_bad_lines(spark, tmp_dir):
    path, bad = os.path.join(tmp_dir, "bank.txt"), os.path.join(tmp_dir, "bad")
    open(path, "w").write("0;2024-01-15\n1;J;a;b\n1;J;a\n9;2\n")
    scanned = sf.scan_checked(spark, path, ["t", "p", "x", "y"])
    good = sf.split_lines(scanned, bad, 0.3, "t")
    assert sorted(r.t for r in good.collect()) == ["0", "1", "9"]
    assert [r._line for r in sf.left_out(scanned, bad).collect()] == ["1;J;a"]


def test_header_files_are_checked_by_name(spark, tmp_dir):
    path, bad = os.path.join(tmp_dir, "in.csv"), os.path.join(tmp_dir, "bad")
    open(path, "w").write("Z,B,A\n1,2,3\n4,5\n")
    scanned = sf.scan_checked(spark, path, ["A", "B"], ",", header=True)
    good = sf.split_lines(scanned, bad, 0.5)
    assert good.columns == ["A", "B", "Z"] and [tuple(r) for r in good.collect()] == [("3", "2", "1")]
    assert [r._line for r in sf.left_out(scanned, bad).collect()] == ["4,5"]
    with pytest.raises(ValueError, match="'C'"):
        sf.scan_checked(spark, path, ["C"], ",", header=True)


def test_snapshots_by_person_join_without_a_shuffle(spark, tmp_dir):
    day, key = "2024-01-14", "_id"
    info, debts = tb.info(spark, "/root/testdata/sf0.001"), tb.debts(spark, "/root/testdata/sf0.001")
    sims = tb.simulation(spark, "/root/testdata/sf0.001").withColumnRenamed("personID", key)
    stored = [bp.store_by_person(df, tmp_dir, name, day, buckets=4) for df, name in ((info, "Info"), (debts, "Debts/CPF"), (sims, "Simulation"))]
    ddl = [", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) for df in stored]
    attached = [bp.attach_by_person(spark, tmp_dir, n, day, s, buckets=4) for n, s in zip(("Info", "Debts/CPF", "Simulation"), ddl)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        i, d, s = attached
        joined = en.inner_join_key(i.select(key, "tag_telefone"), d.select(key, "contract", "creditor"), key)
        counted = joined.join(en.count_per_key(s, key, key, "n"), key, "left")
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = en.inner_join_key(info.select(key, "tag_telefone"), debts.select(key, "contract", "creditor"), key) \
            .join(en.count_per_key(sims, key, key, "n"), key, "left")
        rows = sorted(repr(tuple(r)) for r in counted.select(*want.columns).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert rows == sorted(repr(tuple(r)) for r in want.collect()) and rows


def test_daily_partials_equal_the_count_of_all_events(spark, tmp_dir):
    root = os.path.join(tmp_dir, "state")
    people = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "_id string")
    at = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in (0, 0, 1, 24, 30, 47, 48, 71, 72, 72, 95, 24 * 29)]
    events = spark.createDataFrame([("abz"[i % 3], "xy"[i % 2], t) for i, t in enumerate(at)] + [("a", "x", None), (None, "x", at[0])],
                                   "personID string, creditor string, createdAt timestamp")
    path = os.path.join(tmp_dir, "events")
    events.write.parquet(path)
    stored = spark.read.parquet(path)
    one = ss.day_slice(stored, "createdAt", "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert ">= 2024-01-02 00:00:00)" in one and "< 2024-01-03 00:00:00)" in one and "GreaterThanOrEqual(createdAt" in one
    for d in range(1, 32):
        day = f"2024-01-{d:02d}"
        dc.store_day(stored, root, day, "personID", "createdAt")
        state = dc.read_state(spark, root)
        for inclusive in (False, True):
            got = dc.count_from_state(people, state, "_id", "n", day, "x", inclusive)
            want = en.count_asof(people, stored, "personID", "_id", "n", "x", "createdAt", day, inclusive)
            if d in (1, 2, 3, 4, 5, 30, 31):
                assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    plan = dc.count_from_state(people, state, "_id", "n", "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters", 1)[1][:120]
    fixed = events.where("createdAt is null or createdAt < '2024-01-02'")          # the second day is taken back
    dc.store_day(fixed, root, "2024-01-02", "personID", "createdAt")
    left = dc.read_state(spark, root).where("day = '2024-01-02'")
    assert left.count() == 0
    whole = os.path.join(tmp_dir, "whole")
    dc.store_history(events, whole, "personID", "createdAt")
    got = dc.count_from_state(people, dc.read_state(spark, whole), "_id", "n", "2024-01-04", "x")
    want = en.count_asof(people, events, "personID", "_id", "n", "x", "createdAt", "2024-01-04")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
