"""Golden micro-fixtures, one per quirk of the file rules (FIXTURES.md section 2).

All values are invented.
"""

import datetime as dt

from pyspark.sql import functions as F

from duescore.functions import arrays as fa
from duescore.functions import dates as fd
from duescore.functions import text as fx
from duescore.operators import contact as ct
from duescore.operators import enrich as en
from duescore.operators import features as fe
from duescore.operators import nested as ns
from duescore.operators import outcomes as oc
from duescore.operators import score as sc
from duescore.sources import files as sf
from duescore.spec import CONTACT_TAGS, RANK_VALUES


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_amounts(spark):
    vals = ["+000123,45", "123,45", "-12,00", "+1.234,56", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "a string")
    out = df.select("a", fx.parse_signed_decimal("a").alias("x"),
                    fx.parse_signed_decimal("a", strict_sign=True).alias("s"))
    got = {r["a"]: (r["x"], r["s"]) for r in out.collect()}
    assert got["+000123,45"] == (123.45, 123.45)
    assert got["123,45"] == (123.45, None)          # unsigned: null in strict mode (Q22)
    assert got["-12,00"] == (-12.0, None)           # negative: null in strict mode
    assert got["+1.234,56"] == (None, None)         # thousands point is not removed
    assert got[""] == (None, None)
    assert got[None] == (None, None)


def test_coerce_numeric_first_comma_only(spark):
    df = spark.createDataFrame([("12,5",), ("1,2,3",), ("abc",), ("7",)], "a string")
    got = [r[0] for r in df.select(fx.coerce_numeric("a")).collect()]
    assert got == [12.5, None, None, 7.0]


def test_documents(spark):
    df = spark.createDataFrame([("12.345.678/0001-90",), ("00123",), ("123456789012345",), (None,)], "d string")
    out = df.select(fx.clean_document("d").alias("c"), fx.pad_document(fx.clean_document("d"), 14).alias("p"),
                    fx.document_fits(fx.clean_document("d"), 14).alias("fits"))
    assert rows(out, "c", "p", "fits") == [
        ("12345678000190", "12345678000190", True),
        ("00123", "00000000000123", True),
        ("123456789012345", "12345678901234", False),   # cut, and flagged (Q17)
        (None, None, None),
    ]


def test_dates(spark):
    df = spark.createDataFrame([("20240115", "15/01/2024", "2024-1-5", "2024-01-15T23:10:00", "2024-02-31", "")],
                               "a string, b string, c string, d string, e string, f string")
    r = df.select(fd.parse_date("a", "yyyyMMdd"), fd.parse_date("b", "dd/MM/yyyy"), fd.parse_date("c", "yyyy-M-d"),
                  fd.parse_day_prefix("d"), fd.parse_date("e"), fd.parse_date("f")).first()
    assert list(r) == [dt.date(2024, 1, 15), dt.date(2024, 1, 15), dt.date(2024, 1, 5), dt.date(2024, 1, 15),
                       None, None]


def test_fallback_day(spark):
    df = spark.createDataFrame([("2021-03-04T10:00:00", "2021-03-09T00:00:00"), (None, "2021-03-09T00:00:00")],
                               "paid string, due string")
    assert [r[0] for r in df.select(fd.fallback_day("paid", "due")).collect()] == ["2021-03-04", "2021-03-09"]


def test_age_years(spark):
    df = spark.createDataFrame([(dt.datetime(2000, 1, 1),), (None,)], "b timestamp")
    got = [r[0] for r in df.select(fd.age_years(F.to_timestamp(F.lit("2024-01-16")), "b")).collect()]
    assert got == [24, 0]


def test_control_records(spark):
    lines = ["0; 2024-01-15 ;x", "1;J;a", "1;J;b", "1;F;c", "10;J;d", "9;TRAILER;", ";J;e"]
    df = sf.parse_lines(spark.createDataFrame([(v,) for v in lines], "value string"),
                        ["Tipo_Registro", "Tipo_Pessoa", "Nome"], sep=";")
    out = sf.strip_control_records(df).orderBy("Nome")
    assert rows(out, "Nome", "Data_Arquivo") == [
        ("a", dt.date(2024, 1, 15)), ("b", dt.date(2024, 1, 15)), ("d", dt.date(2024, 1, 15))]  # type 10 kept (Q20)


def test_latest_file_by_stamp(spark):
    names = ["integracao_202401150300.csv", "integracao_202401170300.csv", "integracao_202401160300.csv",
             "other_202501010000.csv", "full_temp"]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "file_name string, i int")
    out = sf.latest_snapshot(df, "file_name", r"_(\d{12})\.csv$", "integracao")
    assert rows(out, "file_name") == [("integracao_202401170300.csv",)]
    d = df.select(sf.file_date("file_name", r"_(\d{8})\d{4}\.csv$", "yyyyMMdd").alias("d")).collect()
    assert d[0]["d"] == dt.date(2024, 1, 15) and d[4]["d"] is None


def test_slot_flags(spark):
    schema = "id int, t array<array<string>>"
    data = [(1, None), (2, []), (3, [None]), (4, [["skip:hot"]]), (5, [["x:other"]]), (6, [[None, "x"]]),
            (7, [["skip:alto"], ["skip:hot"]])]
    df = spark.createDataFrame(data, schema)
    out = df.select("id", *fa.slot_tag_flags("t", 2, CONTACT_TAGS, "T")).orderBy("id").collect()
    f = {r["id"]: r for r in out}
    assert f[1]["T1_sem_tags"] and not f[1]["T1_skip:hot"]          # missing array
    assert f[2]["T1_sem_tags"]                                       # empty array, missing slot
    assert f[3]["T1_sem_tags"]                                       # null slot
    assert f[4]["T1_skip:hot"] and not f[4]["T1_sem_tags"]
    assert not any(f[5][f"T1_{t}"] for t in CONTACT_TAGS)            # only unlisted tags: all false (Q9)
    assert f[6]["T1_sem_tags"]                                       # null element, no hit: null test is true
    assert f[7]["T2_skip:hot"] and f[7]["T1_skip:alto"] and not f[7]["T2_sem_tags"]


def test_state_slots(spark):
    df = spark.createDataFrame([(["sp", "!!!<<Cadastrar>>!!!"],), (None,)], "s array<string>")
    out = df.select(*fa.state_slots("s", 3, "!!!<<Cadastrar>>!!!")).collect()
    assert tuple(out[0]) == ("SP", None, None) and tuple(out[1]) == (None, None, None)


def test_nested_debts_and_rank(spark):
    schema = ("_id string, document string, info struct<gender:string, birthDate:timestamp>, "
              "debts array<struct<creditor:string, contract:string, createdAt:timestamp, tags:array<string>>>")
    t = dt.datetime(2023, 5, 1)
    data = [
        ("p1", "d1", None, None),                                                      # no debts
        ("p2", "d2", ("M", t), [("other", "c0", t, ["rank:a"])]),                      # other creditor only
        ("p3", "d3", None, [("cr", "c1", t, ["rank:c", "rank:b"]), ("cr", "c2", t, ["skip:x"]),
                            ("cr", "c3", t, None)]),                                   # two ranks, none, missing
    ]
    p = spark.createDataFrame(data, schema)
    e = ns.explode_debts(ns.person_projection(p, "cr", "2024-01-16"))
    r = e.select("document", "contract", fa.single_rank("tags", RANK_VALUES[:-1], RANK_VALUES[-1]).alias("r"))
    got = sorted(rows(r, "document", "contract", "r"), key=str)
    assert got == sorted([("d1", None, "sem_skip"), ("d2", None, "sem_skip"), ("d3", "c1", "rank:b"),
                          ("d3", "c2", "sem_skip"), ("d3", "c3", "sem_skip")], key=str)
    oh = ns.rank_columns(e, "tags", RANK_VALUES).filter("contract = 'c1'").first()
    assert oh["rank:b"] and not oh["rank:c"] and not oh["sem_skip"]


def test_earliest_debt_ties_and_nulls(spark):
    d = spark.createDataFrame([("a", "x", "c1", dt.date(2020, 1, 1)), ("a", "x", "c2", dt.date(2020, 1, 1)),
                               ("a", "x", "c3", dt.date(2021, 1, 1)), ("b", "x", "c4", None),
                               ("c", "x", "c5", dt.date(2019, 1, 1))],
                              "_id string, creditor string, contract string, d date")
    out = en.earliest_per_group(d, ["_id", "creditor"], "d")
    assert sorted(r["contract"] for r in out.collect()) == ["c1", "c2", "c5"]


def test_other_debt_flags(spark):
    rows_ = spark.createDataFrame([("a", "k1"), ("b", "k3"), (None, "k9")], "_id string, CONTA string")
    own = spark.createDataFrame([("a", "k1"), ("a", "k2"), ("a", "k2b"), ("b", "k3")], "_id string, contract string")
    out = en.exists_same_creditor(rows_, own, "same")
    assert sorted(rows(out, "_id", "same"), key=str) == sorted([("a", True), ("b", False), (None, False)], key=str)
    assert out.count() == 3                                                         # one row per row (Q4)
    others = spark.createDataFrame([("a",), ("a",)], "_id string")
    flagged = en.exists_flag(rows_, others, ["_id"], ["_id"], "other")
    assert sorted(rows(flagged, "_id", "other"), key=str) == sorted([("a", True), ("b", False), (None, False)], key=str)


def test_activity_cutoff(spark):
    ev = spark.createDataFrame([
        ("p1", "cr", dt.datetime(2024, 1, 14, 12)), ("p1", "cr", dt.datetime(2024, 1, 15, 0, 0)),
        ("p1", "cr", dt.datetime(2024, 1, 15, 9)), ("p1", "cr", dt.datetime(2024, 1, 16)),
        ("p1", "other", dt.datetime(2024, 1, 1))], "personID string, creditor string, createdAt timestamp")
    people = spark.createDataFrame([("p1",), ("p2",)], "_id string")
    strict = en.count_asof(people, ev, "personID", "_id", "n", "cr", "createdAt", "2024-01-15")
    assert dict(rows(strict, "_id", "n")) == {"p1": 2, "p2": 0}                      # later that day left out (Q5)
    whole = en.count_asof(people, ev, "personID", "_id", "n", "cr", "createdAt", "2024-01-15", inclusive_day=True)
    assert dict(rows(whole, "_id", "n")) == {"p1": 3, "p2": 0}


def test_deal_labels(spark):
    deals = spark.createDataFrame([
        ("d1", "c1", "cr", "open", dt.date(2024, 1, 10)), ("d2", "c1", "cr", "expired", dt.date(2024, 1, 12)),
        ("d3", "c2", "cr", "broken", dt.date(2024, 1, 5)), ("d4", "c3", "cr", "error", dt.date(2024, 1, 20)),
        ("d5", "c4", "cr", None, dt.date(2024, 1, 20)), ("d6", "c5", "cr", "open", dt.date(2019, 1, 1))],
        "dealID string, document string, creditor string, status string, createdAt date")
    dr = oc.deal_rows(deals, "cr", "2020-01-01")
    assert sorted(r["dealID"] for r in dr.collect()) == ["d1", "d2", "d3"]        # error, null status, old: out (Q6)
    days = spark.createDataFrame([("c1", dt.date(2024, 1, 11), "email"), ("c1", dt.date(2024, 1, 13), "sms"),
                                  ("c2", dt.date(2024, 1, 6), "sms"), ("c9", None, "email")],
                                 "document string, DT_INTERACAO date, type string")
    lab = ct.activation_label(ct.pivot_channel_day(days, ["email", "sms"]), ct.latest_deal(dr), ["email", "sms"])
    got = {(r["document"], r["DT_INTERACAO"]): r["ATIVACAO"] for r in lab.collect()}
    assert got[("c1", dt.date(2024, 1, 11))] == "ATIVADO"           # before the latest deal
    assert got[("c1", dt.date(2024, 1, 13))] == "ATIVADO"           # after it, latest deal expired
    assert got[("c2", dt.date(2024, 1, 6))] == "ATIVADO"            # after it, broken
    assert got[("c9", None)] == "ATIVADO"                           # no deal
    act = ct.pivot_activation(lab, [("email", "EMAIL"), ("sms", "SMS")])
    c1 = act.filter("document = 'c1'").first()
    assert (c1["ACION_EMAIL_QTD_ATIVADO"], c1["ACION_SMS_QTD_ATIVADO"], c1["ACION_SMS_QTD_NAO_ATIVADO"]) == (1, 1, 0)


def test_installments(spark):
    deals = spark.createDataFrame([("c1", dt.date(2024, 1, 1), "d1", "open", True)],
                                  "CPF string, DT_ACORDO date, dealID string, status string, VARIAVEL_RESPOSTA_ACORDO boolean")
    inst = spark.createDataFrame([("d1", "cr", "2024-02-01T10:00:00", "2024-02-05T00:00:00", 1),
                                  ("d1", "cr", None, "2024-03-05T00:00:00", 2),
                                  ("d9", "cr", None, "2024-03-05T00:00:00", 1)],
                                 "dealID string, creditor string, paidAt string, dueAt string, QTD_PARCELAS int")
    ir = oc.installment_rows(inst, "cr", "2020-01-01")
    out = oc.payment_outcome(deals, ir)
    assert sorted(rows(out, "DT_PAGAMENTO", "PAGTO", "has_payment")) == [
        ("2024-02-01", True, True), ("2024-03-05", True, False)]                # unpaid but due counts (Q7)
    per = oc.outcome_per_person(deals, ir).first()
    assert per["QTD_PARCELAS"] == 2 and per["PAGTO"] and per["DT_PAGAMENTO"] == dt.date(2024, 3, 5)


def test_campaign_counts(spark):
    camp = spark.createDataFrame([("a", "sms", ["NOVO_x"]), ("a", "sms", ["y"]), ("a", "call", None),
                                  ("a", "email", ["p", "NOVO"]), ("a", "push", ["z"])],
                                 "document string, type string, campaign_name array<string>")
    out = ct.channel_counts(camp, [("sms", "SMS"), ("call", "VOICE"), ("email", "EMAIL")], "NOVO").first()
    assert (out["ACION_SMS_QTD_ATIVADO"], out["ACION_SMS_QTD_NAO_ATIVADO"]) == (1, 1)
    assert out["ACION_VOICE_QTD_ATIVADO"] == 1                                   # missing name = activation (Q29)
    assert (out["ACION_EMAIL_QTD_ATIVADO"], out["ACION_EMAIL_QTD_NAO_ATIVADO"]) == (0, 1)


def test_scores_roll_up_numerically(spark):
    pre = spark.createDataFrame([("123", "0.8", 4), ("123", "9.5e-05", 0), ("0123", "0.1", 0), ("9", None, None)],
                                "Chave string, P_1 string, GH int")
    out = sc.score_rollup(pre, 11, "prov", "2024-01-15", "2024-01-16").orderBy("Document").collect()
    assert out[0]["Document"] == "00000000009" and out[0]["Score"] is None
    r = [x for x in out if x["Document"] == "00000000123"][0]
    assert r["ScoreValue"] == 0.8 and r["Score"] == 4                            # numeric max, not text (Q1)
    assert abs(r["ScoreAvg"] - (0.8 + 9.5e-05 + 0.1) / 3) < 1e-12               # leading zeros merge (Q17)


def test_band_edges_right_closed_and_null(spark):
    edges = (0.1, 0.5)
    df = spark.createDataFrame([(0.1,), (0.10000001,), (0.5,), (0.9,), (None,)], "p double")
    assert [r[0] for r in df.select(sc.score_band("p", edges)).collect()] == [0, 1, 1, 2, None]   # Q16


def test_feature_vector(spark):
    base = spark.createDataFrame([
        ("1", "10,5", "SP", dt.date(2020, 2, 3), True, "gmail.com"),
        ("1", "10,5", "SP", dt.date(2020, 2, 3), True, "gmail.com"),                # duplicate row (E7)
        ("2", "x", None, None, None, None),
        ("3", "1", "ZZ", dt.date(2021, 1, 1), False, "other.com")],
        "CPF string, VALOR string, UF1 string, D date, `Telefone1_skip:hot` boolean, Email1_dominio string")
    groups = fe.FeatureGroups(numeric=("VALOR",), categorical=("UF1",), dates=("D",))
    names = ["VALOR", "UF1_SP", "UF1_RJ", "ano_D", "delta_D", "Telefone1_skip:hot", "Email1_dominio_gmail.com",
             "absent"]
    out = fe.feature_vector(base, "CPF", names, groups, "2021-01-01")
    assert out.columns == ["CPF", *names]
    got = {r["CPF"]: r for r in out.collect()}
    assert out.count() == 3
    assert got["1"]["VALOR"] == 10.5 and got["1"]["UF1_SP"] == 1.0 and got["1"]["ano_D"] == 2020.0
    assert got["1"]["Telefone1_skip:hot"] == 1.0 and got["1"]["Email1_dominio_gmail.com"] == 1.0
    assert got["2"]["VALOR"] is None and got["2"]["UF1_SP"] == 0.0 and got["2"]["ano_D"] is None
    assert got["3"]["UF1_SP"] == 0.0 and got["3"]["UF1_RJ"] == 0.0                  # unseen category
    assert all(r["absent"] is None for r in got.values())                          # missing feature (E6)
    assert abs(got["1"]["delta_D"] - 333 / 365.25) < 1e-12


def test_composite_key_nulls_never_match(spark):
    left = spark.createDataFrame([("d1", "k1"), ("d2", None), (None, "k3")], "document string, Contrato_Altair string")
    right = spark.createDataFrame([("d1", "k1", 1), ("d2", None, 2), (None, "k3", 3)],
                                  "document string, contract string, v int")
    out = ns.merge_composite_key(left, right, ["document", "Contrato_Altair"], ["document", "contract"])
    got = sorted(rows(out, "document", "Contrato_Altair", "v"), key=str)
    assert got == sorted([("d1", "k1", 1), ("d2", None, None), (None, "k3", None)], key=str)   # Q18


def test_zip_explode(spark):
    df = spark.createDataFrame([("p1", ["a", "b"], ["cr", "other"], [["k1", "k2"], ["k3"]]), ("p2", [], [], [])],
                               "_id string, dealID array<string>, creditor array<string>, debts array<array<string>>")
    out = ns.zip_explode(df, ["_id"], ["dealID", "creditor", "debts"], "debts", "contract")
    assert sorted(rows(out, "_id", "dealID", "creditor", "contract")) == [
        ("p1", "a", "cr", "k1"), ("p1", "a", "cr", "k2"), ("p1", "b", "other", "k3")]


def test_semi_join_lookup_keeps_persons_once(spark):
    persons = spark.createDataFrame([("p1", "d1"), ("p2", "d2"), ("p3", "d3")], "_id string, document string")
    wanted = spark.createDataFrame([("d1",), ("d1",), ("d3",), (None,)], "document string")
    out = ns.semi_join_lookup(persons, wanted)
    assert sorted(r["_id"] for r in out.collect()) == ["p1", "p3"]


def test_first_and_latest_per_key_total_order(spark):
    d = spark.createDataFrame([("c", dt.date(2024, 1, 1), "2", "x"), ("c", dt.date(2024, 1, 1), "10", "y"),
                               ("c", None, "9", "z"), ("e", None, "1", "w")],
                              "k string, d date, id string, s string")
    last = en.first_per_key(d, ["k"], [F.col("d"), F.col("id")], ["id", "s"], latest=True)
    assert dict(rows(last, "k", "s")) == {"c": "x", "e": "w"}      # date tie: larger id ("2" > "10" as text)
    first = en.first_per_key(d, ["k"], [F.col("d"), F.col("id")], ["id", "s"])
    assert dict(rows(first, "k", "s")) == {"c": "z", "e": "w"}     # ascending puts a null date first


def test_outcome_until(spark):
    deals = spark.createDataFrame([("d1", "c1", "cr", "open", dt.date(2024, 1, 10)),
                                   ("d2", "c1", "cr", "open", dt.date(2024, 3, 1))],
                                  "dealID string, document string, creditor string, status string, createdAt date")
    assert oc.deal_rows(deals, "cr", "2020-01-01").count() == 2                      # no upper bound (Q8)
    assert [r["dealID"] for r in oc.deal_rows(deals, "cr", "2020-01-01", until="2024-01-15").collect()] == ["d1"]
    inst = spark.createDataFrame([("d1", "cr", None, "2024-01-20T00:00:00", 1)],
                                 "dealID string, creditor string, paidAt string, dueAt string, QTD_PARCELAS int")
    assert oc.installment_rows(inst, "cr", "2020-01-01", until="2024-01-15").count() == 0
