"""A person holding a third of the portfolio rows: the hot pair is salted over
several tasks, with the same result as the plain shuffle join."""

from pyspark.sql import functions as F

from duescore import testbed as tb
from duescore.plans.card import build_card_base
from duescore.plans.company import build_company_base
from duescore.queries import COMPANY_FILE_FIELDS, sfiles

SF = "/root/testdata/sf0.001"


def _skewed_card_file(spark):
    cf = tb.card_file(spark, SF)
    n = cf.filter(F.col("DATA PAGAMENTO").isNull()).count()          # open rows
    hot = cf.filter(F.col("DATA PAGAMENTO").isNull()).orderBy("CONTA").limit(1)
    copies = spark.range(n // 2).crossJoin(hot) \
        .withColumn("CONTA", F.concat(F.lit("X"), F.col("id").cast("string"))).drop("id")
    return cf.unionByName(copies), n


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_hot_person_split_gives_same_rows(spark):
    skewed, n = _skewed_card_file(spark)
    src = tb.card_sources(spark, SF)
    plain = build_card_base(skewed, src, tb.CARD.with_(hot_rows=10 ** 12), tb.FILE_DAY)
    split = build_card_base(skewed, src, tb.CARD.with_(hot_rows=n // 4), tb.FILE_DAY)
    assert _rows(split) == _rows(plain)
    assert split.count() == n + n // 2
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "__salt" in plan


def test_hot_split_company(spark):
    parsed = sfiles.parse_lines(tb.company_lines(spark, SF), COMPANY_FILE_FIELDS, sep=";")
    src = tb.company_sources(spark, SF)
    args = (tb.COMPANY_FILE_NAME, tb.COMPANY_CREDITOR_ID, tb.FILE_DAY, tb.AS_OF)
    a = build_company_base(parsed, src, tb.COMPANY.with_(hot_rows=10 ** 12), *args)
    b = build_company_base(parsed, src, tb.COMPANY.with_(hot_rows=1), *args)   # every pair hot
    assert _rows(a) == _rows(b)


def test_salted_join_spreads_a_hot_key(spark):
    from duescore.operators.enrich import hot_keys, salted_left_join

    left = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"))
    facts = left.select("k").distinct().withColumn("f", F.length("k"))
    counts = left.groupBy("k").count()
    hot = hot_keys(counts.withColumnRenamed("k", "fk"), ["fk"], "count", 100, 10)   # named like the fact keys
    out = salted_left_join(left, facts.withColumnRenamed("k", "fk"), ["k"], ["fk"], hot)
    plain = left.join(facts, "k", "left")
    assert sorted(map(tuple, out.select("k", "v", "f").collect())) == sorted(map(tuple, plain.select("k", "v", "f").collect()))
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = out.filter("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    assert parts > 1                          # the hot key's 1000 rows are not in one task


def test_more_hot_keys_than_top_k(spark):
    """Keys are hot from a share of all rows on, so none that holds it is left out."""
    from duescore.operators.enrich import hot_keys, salted_left_join

    left = spark.range(1000).select((F.col("id") % 8).cast("string").alias("k"), F.col("id").alias("v"))
    counts = left.groupBy(F.col("k").alias("fk")).count()
    assert hot_keys(counts, ["fk"], "count", 10, 8).count() == 8                    # 125 rows each = a top_k-th
    assert {r["__salts"] for r in hot_keys(counts, ["fk"], "count", 10, 1000).collect()} == {13}
    hot = hot_keys(counts, ["fk"], "count", 10, 3)                                  # 8 keys over min_rows, none a third
    assert hot.count() == 0
    facts = counts.select("fk", F.length("fk").alias("f"))
    assert salted_left_join(left, facts, ["k"], ["fk"], hot).count() == 1000


def test_outcome_grains(spark):
    src = tb.card_sources(spark, SF)
    person = build_card_base(tb.card_file(spark, SF), src, tb.CARD, tb.FILE_DAY)
    deal = build_card_base(tb.card_file(spark, SF), src, tb.CARD, tb.FILE_DAY, outcome_grain="deal")
    assert set(person.columns) == set(deal.columns)
    assert deal.count() > person.count()
    keys = ["CPF", "CONTA", "DT_ACORDO"]
    assert person.filter("VARIAVEL_RESPOSTA_ACORDO").select(keys).exceptAll(deal.select(keys).distinct()).count() == 0


def test_fill_zero_switch(spark):
    src = tb.card_sources(spark, SF)
    cols = ["ACION_EMAIL_QTD_ATIVADO", "ACION_SMS_QTD_ATIVADO", "ACION_EMAIL_QTD_NAO_ATIVADO",
            "ACION_SMS_QTD_NAO_ATIVADO"]
    keep = build_card_base(tb.card_file(spark, SF), src, tb.CARD, tb.FILE_DAY)
    zero = build_card_base(tb.card_file(spark, SF), src, tb.CARD.with_(fill_zero=True), tb.FILE_DAY)
    nulls = keep.filter(F.col(cols[0]).isNull()).count()
    assert nulls > 0                                              # persons without contacts stay null (Q12)
    assert zero.filter(F.col(cols[0]).isNull()).count() == 0
    assert zero.filter(F.col(cols[0]) == 0).count() >= nulls


def test_strict_sign_switch_in_company_rows(spark):
    from duescore.plans.company import company_base_rows
    parsed = sfiles.parse_lines(tb.company_lines(spark, SF), COMPANY_FILE_FIELDS, sep=";")
    args = (tb.persons(spark, SF), tb.COMPANY, tb.COMPANY_FILE_NAME, tb.COMPANY_CREDITOR_ID, tb.AS_OF)
    lenient = company_base_rows(parsed, *args)
    strict = company_base_rows(parsed, *args, strict_sign=True)
    assert lenient.filter(F.col("Taxa_Padrao") < 0).count() > 0                 # '-' amounts read (default)
    assert strict.filter(F.col("Taxa_Padrao") < 0).count() == 0                 # old rule: null (Q22)
    assert strict.filter(F.col("Taxa_Padrao").isNull()).count() == lenient.filter(F.col("Taxa_Padrao") < 0).count()


def test_inclusive_day_switch(spark):
    src = tb.card_sources(spark, SF)
    a = build_card_base(tb.card_file(spark, SF), src, tb.CARD, tb.FILE_DAY)
    b = build_card_base(tb.card_file(spark, SF), src, tb.CARD.with_(inclusive_day=True), tb.FILE_DAY)
    sa = a.agg(F.sum("QTD_SIMU"), F.sum("QTD_AUTH")).first()
    sb = b.agg(F.sum("QTD_SIMU"), F.sum("QTD_AUTH")).first()
    assert sb[0] >= sa[0] and sb[1] >= sa[1]           # the whole file date counts (Q5)
    assert a.count() == b.count()
