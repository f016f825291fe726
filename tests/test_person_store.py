"""The person store as a data source: equal rows, files left unopened."""

import os

import pytest
from pyspark.sql import functions as F

from duescore import testbed as tb
from duescore.operators.nested import semi_join_lookup
from duescore.sources import person_store as ps

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def persons(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("persons") / "p")
    tb.persons(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def store(spark, persons, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    ps.write_store(persons, path, files=8)
    return path


def rows(df):
    return sorted(map(repr, df.collect()))


def test_store_holds_the_documents(spark, persons, store):
    assert rows(ps.open_store(spark, store)) == rows(persons)


def test_lookup_through_the_store(spark, persons, store):
    file = tb.card_file(spark, SF)
    got = semi_join_lookup(ps.open_store(spark, store), file, "document", "CPF")
    assert rows(got) == rows(semi_join_lookup(persons, file, "document", "CPF")) and got.count()


def test_filters_open_only_their_files(spark, persons, store):
    all_docs = sorted(r.document for r in persons.select("document").collect())
    cases = [
        (F.col("document") == all_docs[3], 1), (F.col("document").isin(all_docs[0], all_docs[-1], "none"), 2), (F.col("document") > all_docs[-2], 1),
        (F.col("document") >= all_docs[-1], 1), (F.col("document") < all_docs[1], 1), (F.col("document") <= all_docs[0], 1), (F.col("document") == "none", 0),
        (F.col("_id") == "id3", 8), ((F.col("document") <= all_docs[5]) & (F.col("info").isNull()), 1),
    ]
    for condition, files in cases:
        df = ps.open_store(spark, store).where(condition)
        assert rows(df) == rows(persons.where(condition))
        assert df.rdd.getNumPartitions() == max(files, 1) if files != 8 else df.rdd.getNumPartitions() > 2


def test_reader_alone():
    ranges = [{"file": "a", "least": "1", "most": "3"}, {"file": "b", "least": "4", "most": "6"}]
    r = ps.StoreReader(None, "k", ranges)
    other = ps.EqualTo(("x",), "1")
    assert list(r.pushFilters([ps.In(("k",), ("0", "5", None)), other])) == [other]
    assert [p.file for p in r.partitions()] == ["b"]


def test_unreadable_folder(spark, tmp_path):
    with pytest.raises(Exception):
        ps.open_store(spark, os.path.join(tmp_path, "none"))


def test_no_documents(spark, tmp_path):
    ps.write_store(tb.persons(spark, SF).limit(0), str(tmp_path), files=2)
    assert ps.open_store(spark, str(tmp_path)).count() == 0
