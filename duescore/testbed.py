"""Role views over the driver's test tables (TPC-H-like), for queries and tests.

The reference's own inputs are not available, so each input role is mapped to
the test tables (SURVEY section 2.13).  The same mapping is written in DuckDB
SQL in ``testbed_sql.py`` for the oracles; the two must stay in step.

| role | from |
| --- | --- |
| person | customer: ``_id = 'id' || custkey``, document = 11-digit custkey |
| document type | segment BUILDING or MACHINERY is ``cnpj``, else ``cpf`` |
| debt | orders: creditor = priority, contract = 12-digit orderkey |
| tags of a debt | lineitem line numbers 1..7 mapped to tag words |
| profile slots | per person, tag arrays of their orders by orderkey (e-mail: descending) |
| states | nation names of the person's region by key, in lower case |
| simulation / authentication | events ``view`` / ``click``; creditor from the value |
| deals / installments | orders / lineitem moved forward by 9,000 days |
| interactions, campaigns | events by user |
| card file | the creditor's orders rendered as the card file |
| company file | the creditor's open orders rendered as ``;`` lines with header and trailer |
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators.score import Split
from .spec import COMPANY_FILE_FIELDS, card_spec, company_spec

# Fixed parameters of the test mapping.
CREDITOR = "1-URGENT"
OTHER_SIM_CREDITOR = "2-HIGH"
FILE_DAY = "2024-01-15"
AS_OF = "2024-01-16"
SHIFT_DAYS = 9000
PAID_EARLY_DAYS = 5
ARREARS_BASE = "2002-01-01"
SKIP_WORDS = ("skip:hot", "skip:alto", "skip:medio", "skip:baixo", "skip:nhot", "skip:morno", "skip:frio")
RANK_WORDS = ("rank:a", "rank:b", "rank:c", "rank:d", "rank:e", "rank:f", "rank:g")
CNPJ_SEGMENTS = ("BUILDING", "MACHINERY")
STATE_PLACEHOLDER = "nation_5"
CAMPAIGN_MARKER = "5"
CARD_FILE_NAME = "integracao_card_202401150300.csv"
COMPANY_FILE_NAME = "bank_portfolio_20240115.txt"
COMPANY_CREDITOR_ID = "std"

CARD = card_spec(CREDITOR, "card_propensity_v1", state_placeholder=STATE_PLACEHOLDER)
COMPANY = company_spec(CREDITOR, "company_propensity_v1", state_placeholder=STATE_PLACEHOLDER,
                       campaign_marker=CAMPAIGN_MARKER)


# Declared schemas of the test tables: a scan with a schema runs no inference job.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def _doc(c) -> F.Column:
    return F.lpad(c.cast("string"), 11, "0")


def _pid(c) -> F.Column:
    return F.concat(F.lit("id"), c.cast("string"))


def _contract(c) -> F.Column:
    return F.lpad(c.cast("string"), 12, "0")


def _words(words, idx) -> F.Column:
    return F.get(F.array(*[F.lit(w) for w in words]), idx - 1)


def _amount(c) -> F.Column:
    return F.replace(c.cast("decimal(15,2)").cast("string"), F.lit("."), F.lit(","))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, lines): each order's distinct line numbers with a word, as the bits of one
    number, which adds up in place and shuffles as an int; the same aggregate serves all tags."""
    line = F.col("l_linenumber")
    bit = F.when(line.between(1, len(SKIP_WORDS)), F.call_function("shiftleft", F.lit(1), line)).otherwise(F.lit(0))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.bit_or(bit).alias("lines"))


def line_tags(words: tuple[str, ...], lines: F.Column) -> F.Column:
    """The words of the line numbers in ``lines``, sorted; null for an order without lines."""
    each = [F.when(lines.bitwiseAND(F.lit(2 << i)) != 0, F.lit(w)) for w, i in sorted((w, i) for i, w in enumerate(words))]
    return F.when(lines.isNotNull(), F.filter(F.array(*each), lambda w: w.isNotNull()))


def info(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    orders = table(spark, sf_dir, "orders")
    states = nation.groupBy("n_regionkey").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", F.lower("n_name").alias("s")))),
                    lambda x: x["s"]).alias("state"))
    # Only the slots that are read: the rank filter keeps a few rows of a person in
    # each task before the shuffle, so the lists below are bounded.
    def first_orders(order: F.Column, n: int, kind: str) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy(order))
        return orders.select("o_orderkey", "o_custkey").withColumn("nth", nth).filter(F.col("nth") <= n) \
            .withColumn("kind", F.lit(kind))

    picked = first_orders(F.col("o_orderkey").asc(), CARD.phone_slots, "phone") \
        .unionByName(first_orders(F.col("o_orderkey").desc(), CARD.email_slots, "email"))
    tagged = picked.join(order_lines(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")

    def slot_list(kind: str) -> F.Column:
        row = F.when(F.col("kind") == kind, F.struct("nth", "lines"))
        return F.transform(F.array_sort(F.collect_list(row)), lambda x: line_tags(SKIP_WORDS, x["lines"]))

    slots = tagged.groupBy("o_custkey").agg(slot_list("phone").alias("tag_telefone"), slot_list("email").alias("tag_email"))
    c = cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(states, "n_regionkey") \
        .join(slots, F.col("c_custkey") == F.col("o_custkey"), "left")
    return c.select(
        _pid(F.col("c_custkey")).alias("_id"), _doc(F.col("c_custkey")).alias("document"),
        F.when(F.col("c_mktsegment").isin(*CNPJ_SEGMENTS), "cnpj").otherwise("cpf").alias("documentType"),
        "tag_telefone", "state", "tag_email",
        F.array(F.concat(F.lower("c_mktsegment"), F.lit(".com.br")),
                F.concat(F.lower("n_name"), F.lit(".com"))).alias("domain"),
    )


def debts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(order_lines(spark, sf_dir),
                                            F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return o.select(
        _pid(F.col("o_custkey")).alias("_id"), _doc(F.col("o_custkey")).alias("document"),
        F.col("o_orderpriority").alias("creditor"), _contract(F.col("o_orderkey")).alias("contract"),
        F.to_date("o_orderdate").alias("INICIO_DIVIDA"), line_tags(RANK_WORDS, F.col("lines")).alias("tag_divida"),
        F.col("o_totalprice").alias("originalAmount"),
    )


def _event_creditor() -> F.Column:
    return F.when(F.col("value") < 20, F.lit(OTHER_SIM_CREDITOR)).otherwise(F.lit(CREDITOR))


def simulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    return e.select(_pid(F.col("user_id")).alias("personID"), _event_creditor().alias("creditor"),
                    F.col("ts").alias("createdAt"))


def authentication(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "click")
    token = F.struct(_doc(F.col("user_id")).alias("document"), F.col("props").alias("contact"),
                     F.col("event_id").cast("string").alias("contract"), _event_creditor().alias("creditor"))
    return e.select(token.alias("tokenData"), F.col("ts").alias("createdAt"))


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "P", "error") \
        .when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 200000), "broken") \
        .when(F.col("o_orderstatus") == "F", "expired").otherwise("open")
    return o.select(F.col("o_orderkey").cast("string").alias("dealID"), _doc(F.col("o_custkey")).alias("document"),
                    F.col("o_orderpriority").alias("creditor"), status.alias("status"),
                    F.date_add(F.to_date("o_orderdate"), SHIFT_DAYS).alias("createdAt"))


def installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    ship = F.to_date("l_shipdate")
    paid = F.concat(F.date_format(F.date_add(ship, SHIFT_DAYS - PAID_EARLY_DAYS), "yyyy-MM-dd"), F.lit("T10:30:00"))
    due = F.concat(F.date_format(F.date_add(ship, SHIFT_DAYS), "yyyy-MM-dd"), F.lit("T00:00:00"))
    return j.select(F.col("l_orderkey").cast("string").alias("dealID"), F.col("o_orderpriority").alias("creditor"),
                    F.when(F.col("l_linestatus") == "F", paid).alias("paidAt"), due.alias("dueAt"),
                    F.col("l_linenumber").alias("QTD_PARCELAS"))


def _channel(call_type: str | None) -> F.Column:
    t = F.col("event_type")
    expr = F.when(t == "click", "email").when(t == "view", "sms")
    if call_type:
        expr = expr.when(t == call_type, "call")
    return expr.otherwise(t)


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(_doc(F.col("user_id")).alias("document"),
                    F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("sentAt"),
                    _channel(None).alias("type"),
                    F.when(F.col("event_type") == "error", "not_received").otherwise("received").alias("status"))


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(_doc(F.col("user_id")).alias("document"),
                    F.date_format("ts", "yyyy-MM-dd").alias("interactionDate"),
                    _channel("purchase").alias("type"), F.col("event_type").alias("channel"),
                    F.col("props").alias("campaign_name"))


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders").join(order_lines(spark, sf_dir),
                                            F.col("o_orderkey") == F.col("l_orderkey"), "left")
    debt = F.struct(F.col("o_orderpriority").alias("creditor"), _contract(F.col("o_orderkey")).alias("contract"),
                    F.col("o_orderdate").alias("createdAt"), line_tags(RANK_WORDS, F.col("lines")).alias("tags"))
    per = o.groupBy("o_custkey").agg(F.collect_list(debt).alias("debts"))
    c = cust.join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    info_struct = F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.struct(
        F.substring("c_mktsegment", 1, 1).alias("gender"),
        F.make_date(F.col("c_nationkey") + 1950, F.lit(1), F.lit(1)).cast("timestamp").alias("birthDate")))
    return c.select(_pid(F.col("c_custkey")).alias("_id"), _doc(F.col("c_custkey")).alias("document"),
                    info_struct.alias("info"), "debts")


def card_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The creditor's orders as the raw card file: header names, all strings."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == CREDITOR)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    day = F.to_date("o_orderdate")
    paid = F.col("o_orderstatus") == "F"
    return j.select(
        _doc(F.col("o_custkey")).alias("CPF"), _contract(F.col("o_orderkey")).alias("CONTA"),
        F.col("c_name").alias("NOME CLIENTE"),
        F.datediff(F.to_date(F.lit(ARREARS_BASE)), day).cast("string").alias("DIAS ATRASO"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("DATA DIVIDA"),
        F.date_format(F.date_add(day, 30), "yyyy-MM-dd").alias("DATA ULTIMA FATURA"),
        F.lit(None).cast("string").alias("DATA INTERROMPE COBRANCA"),
        F.lit(None).cast("string").alias("DATA RETORNO COBRANCA"),
        _amount(F.col("o_totalprice")).alias("VALOR ULTIMA FATURA"),
        F.when(paid, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("DATA PAGAMENTO"),
        F.when(paid, _amount(F.col("o_totalprice"))).alias("VALOR PAGO"),
    )


def company_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail records of the company file as fields (before rendering)."""
    o = table(spark, sf_dir, "orders").filter((F.col("o_orderpriority") == CREDITOR) & (F.col("o_orderstatus") != "F"))
    c = table(spark, sf_dir, "customer")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    d = _doc(F.col("o_custkey"))
    formatted = F.concat(F.substring(d, 1, 3), F.lit("."), F.substring(d, 4, 3), F.lit("."), F.substring(d, 7, 3),
                         F.lit("-"), F.substring(d, 10, 2))
    sign = F.when(F.col("c_acctbal") < 0, F.lit("-")).otherwise(F.lit("+"))
    values = {
        "Tipo_Registro": F.lit("1"),
        "Tipo_Pessoa": F.when(F.col("c_mktsegment").isin(*CNPJ_SEGMENTS), "J").otherwise("F"),
        "Numero_Documento": formatted,
        "Nome": F.col("c_name"),
        "Cep1": F.lpad(F.col("c_nationkey").cast("string"), 8, "0"),
        "Cep2": F.lit("01000000"),
        "Indicador_Correntista": F.when(F.col("c_acctbal") > 5000, "S").otherwise("N"),
        "Contrato_Altair": F.concat(F.lit("ALT"), d, _contract(F.col("o_orderkey"))),
        "Numero_Operacao_LY": F.col("o_orderkey").cast("string"),
        "Descricao_Produto": F.lower("c_mktsegment"),
        "Saldo_Devedor_Contrato": F.concat(F.lit("+"), _amount(F.col("o_totalprice"))),
        "Dias_Atraso": F.datediff(F.to_date(F.lit(ARREARS_BASE)), F.to_date("o_orderdate")).cast("string"),
        "Codigo_Politica": F.col("o_orderstatus"),
        "Taxa_Padrao": F.concat(sign, _amount(F.abs(F.col("c_acctbal")))),
        "Desconto_Padrao": F.lit("+10,00"),
        "Percentual_Min_Entrada": F.lit("+5,00"),
        "Valor_Min_Parcela": F.lit("+150,00"),
        "Qtde_Min_Parcelas": F.lit("1"),
        "Qtde_Max_Parcelas": F.lit("24"),
        "Qtde_Parcelas_Padrao": F.col("c_nationkey").cast("string"),
        "Forma_Pgto_Padrao": F.col("c_mktsegment"),
        "Total": F.lit("1"),
    }
    return j.select(*[(values.get(f, F.lit(""))).alias(f) for f in COMPANY_FILE_FIELDS])


def company_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company file as text lines: a header record, the details, a trailer record."""
    details = company_fields(spark, sf_dir).select(F.concat_ws(";", *COMPANY_FILE_FIELDS).alias("value"))
    n = len(COMPANY_FILE_FIELDS)
    header = ";".join(["0", f" {FILE_DAY} "] + [""] * (n - 2))
    trailer = ";".join(["9", "TRAILER"] + [""] * (n - 2))
    control = spark.createDataFrame([(header,), (trailer,)], "value string")
    return control.unionByName(details)


def card_sources(spark: SparkSession, sf_dir: str):
    from .plans.base import Sources
    return Sources(info=info(spark, sf_dir), debts=debts(spark, sf_dir), simulation=simulation(spark, sf_dir),
                   authentication=authentication(spark, sf_dir), deals=deals(spark, sf_dir),
                   installments=installments(spark, sf_dir), interactions=interactions(spark, sf_dir))


def company_sources(spark: SparkSession, sf_dir: str):
    from .plans.base import Sources
    return Sources(info=info(spark, sf_dir), debts=debts(spark, sf_dir), simulation=simulation(spark, sf_dir),
                   authentication=authentication(spark, sf_dir), campaigns=campaigns(spark, sf_dir),
                   persons=persons(spark, sf_dir))


# A published coefficient list for the card model (our own), so that scoring
# has an exact oracle.  Names follow the feature-base columns.
CARD_COEFFICIENTS = {
    "DIAS_ATRASO": -0.0004, "VALOR_ULTIMA_FATURA": 0.000002, "QTD_AUTH": 0.3, "QTD_SIMU": 0.2,
    "ACION_EMAIL_QTD_ATIVADO": 0.05, "ACION_SMS_QTD_ATIVADO": 0.04, "ACION_EMAIL_QTD_NAO_ATIVADO": -0.03,
    "ACION_SMS_QTD_NAO_ATIVADO": -0.02, "UF1_NATION_0": 0.1, "UF2_NATION_6": -0.1, "ano_DATA_DIVIDA": 0.02,
    "mes_DATA_DIVIDA": 0.01, "delta_DATA_DIVIDA": -0.1, "delta_PRIMEIRO_ACIONAMENTO": -0.5,
    "Telefone1_skip:hot": 0.5, "Telefone1_sem_tags": -0.4, "Telefone2_skip:alto": 0.2, "SkipDivida_rank:a": 0.3,
    "SkipDivida_sem_tags": -0.2, "Divida_Outro_Credor": -0.3, "Divida_Mesmo_Credor": 0.1,
    "Email1_skip:medio": 0.1, "Email1_dominio_household.com.br": 0.2, "feature_not_in_base": 0.7,
}
CARD_INTERCEPT = -39.5   # offsets the year term, so scores spread over all six bands


# Our own coefficient list for the company model (9 bands between 0.071 and 0.11).
COMPANY_COEFFICIENTS = {
    "Taxa_Padrao": 0.00002, "Saldo_Devedor_Contrato": -0.000001, "Dias_Atraso": 0.0001, "originalAmount": 0.0000005,
    "QTD_AUTH": 0.05, "QTD_SIMU": 0.04, "ACION_SMS_QTD_ATIVADO": 0.02, "ACION_EMAIL_QTD_NAO_ATIVADO": -0.02,
    "Forma_Pgto_Padrao_BUILDING": 0.1, "Descricao_Produto_machinery": -0.1, "UF1_NATION_0": 0.05,
    "ano_DATA_ENTRADA_DIVIDA": 0.001, "delta_PRIMEIRO_ACIONAMENTO": -0.2, "Telefone1_skip:hot": 0.1,
    "SkipDivida_rank:a": 0.05, "Divida_Outro_Credor": -0.05, "rank:b": 0.08, "sem_skip": -0.03,
    "feature_not_in_base": 0.5,
}
COMPANY_INTERCEPT = -4.5

# Our own list of boosted trees for the card model, so that tree scoring has an exact oracle.
CARD_TREES = (
    Split("DIAS_ATRASO", 8000.0, Split("QTD_AUTH", 1.0, -0.4, 0.3), Split("delta_DATA_DIVIDA", 25.0, 0.2, -0.1)),
    Split("Telefone1_skip:hot", 0.5, -0.1, 0.5),
    Split("VALOR_ULTIMA_FATURA", 150000.0, Split("UF1_NATION_0", 0.5, 0.05, -0.2), 0.25, missing_left=False),
    Split("Email1_dominio_household.com.br", 0.5, 0.0, 0.15),
    Split("ACION_SMS_QTD_ATIVADO", 2.0, Split("Divida_Outro_Credor", 0.5, 0.2, -0.3), 0.35),
    Split("feature_not_in_base", 1.0, 0.1, 0.9, missing_left=False),
)
CARD_TREE_BASE = -0.8


# A model of the size that trainers write: complete trees whose splits and leaves follow a rule.
FOREST_RANGES = {"c_acctbal": (-999.0, 9999.0), "c_nationkey": (0.0, 24.0), "n_orders": (0.0, 30.0),
                 "max_price": (1000.0, 500000.0), "min_price": (1000.0, 300000.0), "days_since": (0.0, 3000.0)}
FOREST_TREES, FOREST_DEPTH, FOREST_BASE = 500, 6, -0.25


def forest_dump(trees: int = FOREST_TREES, depth: int = FOREST_DEPTH) -> str:
    """The rule's trees in a trainer's JSON dump format; node i has the children 2i + 1 and 2i + 2."""
    import json
    names, inner = list(FOREST_RANGES), 2 ** depth - 1

    def node(t: int, i: int) -> dict:
        if i >= inner:
            return {"nodeid": i, "leaf": ((41 * t + 29 * i) % 83 - 41) / 4000.0}
        feature = names[(5 * t + 3 * i + i * i) % len(names)]
        lo, hi = FOREST_RANGES[feature]
        yes, no = 2 * i + 1, 2 * i + 2
        return {"nodeid": i, "split": feature, "split_condition": lo + (hi - lo) * ((37 * t + 53 * i) % 97 + 1) / 98.0,
                "yes": yes, "no": no, "missing": yes if (t + i) % 3 else no, "children": [node(t, yes), node(t, no)]}

    return json.dumps([node(t, 0) for t in range(trees)])


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model features of every customer, null where there is no order."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.count("*").alias("n_orders"), F.max("o_totalprice").alias("max_price"), F.min("o_totalprice").alias("min_price"),
        F.date_diff(F.lit(AS_OF).cast("date"), F.max(F.to_date("o_orderdate"))).alias("days_since"))
    c = table(spark, sf_dir, "customer")
    return c.join(o, c.c_custkey == o.k, "left").select("c_custkey", *[F.col(n).cast("double").alias(n) for n in FOREST_RANGES])
