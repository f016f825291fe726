"""Registered queries: one per operator of the inventory, each with its DuckDB oracle.

Every query reads the test tables through the role views of ``testbed.py`` and
runs the library operator over the whole tables.  Date columns are rendered as
ISO text in the final projection of both engines, so that the cross-engine
comparison does not depend on how each client library represents dates.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import testbed as tb
from .session import ensure_checkpoint_dir, stage_path
from .testbed_sql import forest_sql, with_roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return render_dates(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def render_dates(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text (final projection only)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            cols.append(F.col(f"`{f.name}`").cast("string").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


# Section 2.3 - JN8: as-of activity counts -----------------------------------

from .operators.enrich import count_asof  # noqa: E402


def _card_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per person holding a debt at the creditor: (_id, CPF)."""
    d = tb.debts(spark, sf_dir).filter(F.col("creditor") == tb.CREDITOR)
    return d.select("_id", F.col("document").alias("CPF")).distinct()


_CARD_PERSONS_SQL = f"SELECT DISTINCT _id, document AS CPF FROM debts WHERE creditor = '{tb.CREDITOR}'"


@register("count_asof_simulation", with_roles("debts", "simulation", extra=[("p", _CARD_PERSONS_SQL)]) + f"""
SELECT p._id, p.CPF, COALESCE(s.n, 0) AS QTD_SIMU
FROM p LEFT JOIN (
    SELECT personID, count(*) AS n FROM simulation
    WHERE creditor = '{tb.CREDITOR}' AND createdAt <= DATE '{tb.FILE_DAY}'
    GROUP BY personID) s ON p._id = s.personID""")
def q_count_asof_simulation(spark, sf_dir):
    """Simulations per person up to the file date, 0 when none (JN8, F5, F6, A1, X17)."""
    return count_asof(_card_persons(spark, sf_dir), tb.simulation(spark, sf_dir), "personID", "_id", "QTD_SIMU",
                      tb.CREDITOR, "createdAt", tb.FILE_DAY)


# Section 2.1 - sources, snapshot choice, provenance ---------------------------

from .functions import dates as fd  # noqa: E402
from .functions import text as fx  # noqa: E402
from .sources import files as sfiles  # noqa: E402
from .sources import sinks as ssinks  # noqa: E402
from .sources import snapshots as ssnap  # noqa: E402
from .spec import COMPANY_FILE_FIELDS  # noqa: E402
from .testbed_sql import amount as _amt_sql  # noqa: E402
from .testbed_sql import doc as _doc_sql  # noqa: E402

_STAMP = r"_(\d{8})\.csv$"


@register("latest_snapshot", f"""
WITH e AS (SELECT event_id, user_id, event_type, 'Base_' || strftime(ts, '%Y%m%d') || '.csv' AS file_name
           FROM events)
SELECT * FROM e
WHERE CAST(regexp_extract(file_name, '{_STAMP}', 1) AS BIGINT) =
      (SELECT max(CAST(regexp_extract(file_name, '{_STAMP}', 1) AS BIGINT)) FROM e WHERE contains(file_name, 'Base_'))""")
def q_latest_snapshot(spark, sf_dir):
    """Rows of the newest daily file, chosen by the stamp in the name."""
    e = tb.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type",
        F.concat(F.lit("Base_"), F.date_format("ts", "yyyyMMdd"), F.lit(".csv")).alias("file_name"))
    return sfiles.latest_snapshot(e, "file_name", _STAMP, "Base_")


@register("file_date", r"""
SELECT DISTINCT file_name,
       CAST(CAST(try_strptime(regexp_extract(file_name, '_(\d{8})\d{4}\.csv$', 1), '%Y%m%d') AS DATE) AS VARCHAR) AS file_date
FROM (SELECT 'integracao_' || strftime(ts, '%Y%m%d%H%M') || '.csv' AS file_name FROM events)""")
def q_file_date(spark, sf_dir):
    """File date from the stamp in its name, without the HHMM digits."""
    e = tb.table(spark, sf_dir, "events").select(
        F.concat(F.lit("integracao_"), F.date_format("ts", "yyyyMMddHHmm"), F.lit(".csv")).alias("file_name"))
    return e.distinct().select("file_name", sfiles.file_date("file_name", r"_(\d{8})\d{4}\.csv$", "yyyyMMdd")
                               .alias("file_date"))


def file_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for files that a query writes and reads."""
    ensure_checkpoint_dir(spark)
    return stage_path(spark, "files", name, uuid.uuid4().hex)


def company_file(spark: SparkSession, sf_dir: str) -> str:
    """The bank's portfolio as text files."""
    path = file_folder(spark, "company")
    tb.company_lines(spark, sf_dir).select("value").write.text(path)
    return path


_SUPPLIER_FIELDS = ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@register("scan_delimited", """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
       CAST(CAST(s_acctbal AS DECIMAL(15,2)) AS VARCHAR) AS s_acctbal
FROM supplier""")
def q_scan_delimited(spark, sf_dir):
    """Comma-separated files with a header in another order, read by its names, every column as string (S3)."""
    s = tb.table(spark, sf_dir, "supplier")
    path = file_folder(spark, "suppliers")
    s.select("s_nationkey", "s_name", F.col("s_acctbal").cast("decimal(15,2)"), "s_suppkey").write.option("header", True).csv(path)
    return sfiles.scan_delimited(spark, path, _SUPPLIER_FIELDS, sep=",")


def _company_lines_sql() -> str:
    d = _doc_sql("o.o_custkey")
    return f"""
SELECT '1' AS Tipo_Registro,
       CASE WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'J' ELSE 'F' END AS Tipo_Pessoa,
       substring({d}, 1, 3) || '.' || substring({d}, 4, 3) || '.' || substring({d}, 7, 3) || '-' || substring({d}, 10, 2)
           AS Numero_Documento,
       'ALT' || {d} || lpad(CAST(o.o_orderkey AS VARCHAR), 12, '0') AS Contrato_Altair,
       '+' || {_amt_sql('o.o_totalprice')} AS Saldo_Devedor_Contrato,
       (CASE WHEN c.c_acctbal < 0 THEN '-' ELSE '+' END) || {_amt_sql('abs(c.c_acctbal)')} AS Taxa_Padrao,
       CAST(NULL AS VARCHAR) AS Cep3
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderpriority = '{tb.CREDITOR}' AND o.o_orderstatus <> 'F'"""


_S4_COLS = ("Tipo_Registro", "Tipo_Pessoa", "Numero_Documento", "Contrato_Altair", "Saldo_Devedor_Contrato",
            "Taxa_Padrao", "Cep3")


@register("scan_fixed_schema", f"""
{_company_lines_sql()}
UNION ALL SELECT '0', ' {tb.FILE_DAY} ', NULL, NULL, NULL, NULL, NULL
UNION ALL SELECT '9', 'TRAILER', NULL, NULL, NULL, NULL, NULL""")
def q_scan_fixed_schema(spark, sf_dir):
    """Headerless ';' files parsed with the fixed field list, control records included."""
    return sfiles.scan_fixed_schema(spark, company_file(spark, sf_dir), COMPANY_FILE_FIELDS).select(*_S4_COLS)


@register("strip_control_records", f"""
SELECT Tipo_Pessoa, Numero_Documento, Contrato_Altair, '{tb.FILE_DAY}' AS Data_Arquivo
FROM ({_company_lines_sql()}) WHERE Tipo_Pessoa = 'J'""")
def q_strip_control_records(spark, sf_dir):
    """Detail records of type J with the file date from the trimmed header record."""
    parsed = sfiles.parse_lines(tb.company_lines(spark, sf_dir), COMPANY_FILE_FIELDS, sep=";")
    return sfiles.strip_control_records(parsed).select("Tipo_Pessoa", "Numero_Documento", "Contrato_Altair",
                                                       "Data_Arquivo")


@register("snapshot_slice", f"""
SELECT event_id, user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS snapshot_date
FROM events WHERE CAST(ts AS DATE) = DATE '{tb.FILE_DAY}'""")
def q_snapshot_slice(spark, sf_dir):
    """One dated snapshot."""
    e = ssnap.day_slice(tb.table(spark, sf_dir, "events"), "ts", tb.FILE_DAY)
    return e.select("event_id", "user_id", "event_type", F.to_date("ts").alias("snapshot_date"))


@register("scan_pruned", """
SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'""")
def q_scan_pruned(spark, sf_dir):
    """Three columns and a filter pushed into the Parquet scan."""
    return ssnap.scan_pruned(tb.table(spark, sf_dir, "events"), ["event_id", "user_id", "event_type"],
                             F.col("event_type") != "error")


@register("semi_join_lookup", with_roles("card_file") + f"""
SELECT 'id' || CAST(c_custkey AS VARCHAR) AS _id, {_doc_sql('c_custkey')} AS document
FROM customer WHERE {_doc_sql('c_custkey')} IN (SELECT CPF FROM card_file)""")
def q_semi_join_lookup(spark, sf_dir):
    """Persons of the file's documents from the nested store, one semi join."""
    from .operators.nested import semi_join_lookup
    found = semi_join_lookup(tb.persons(spark, sf_dir), tb.card_file(spark, sf_dir), "document", "CPF")
    return found.select("_id", "document")


@register("lookup_in_store", with_roles("card_file") + f"""
SELECT 'id' || CAST(c_custkey AS VARCHAR) AS _id, {_doc_sql('c_custkey')} AS document
FROM customer WHERE {_doc_sql('c_custkey')} IN (SELECT CPF FROM card_file)""")
def q_lookup_in_store(spark, sf_dir):
    """Persons of the file's documents from the store as a data source of id ranges."""
    from .operators.nested import semi_join_lookup
    from .sources.person_store import open_store, write_store
    path = file_folder(spark, "store")
    write_store(tb.persons(spark, sf_dir), path, files=8)
    found = semi_join_lookup(open_store(spark, path), tb.card_file(spark, sf_dir), "document", "CPF")
    return found.select("_id", "document")


@register("json_scan", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_json_scan(spark, sf_dir):
    """JSON files read with a declared schema."""
    path = file_folder(spark, "events")
    lines = F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(',"props":'), F.coalesce("props", F.lit("null")), F.lit("}"))
    tb.table(spark, sf_dir, "events").select(lines.alias("value")).write.text(path)
    return sfiles.json_scan(spark, path, "event_id BIGINT, props STRUCT<k: INT>").select("event_id", F.col("props.k").alias("k"))


@register("provenance", with_roles("card_file") + f"""
SELECT CPF, CONTA, '{tb.CARD_FILE_NAME}' AS Nome_Arquivo, '{tb.FILE_DAY}' AS Data_Arquivo,
       '{tb.CARD.provider}' AS Provider, '{tb.AS_OF}' AS CreatedAt
FROM card_file""")
def q_provenance(spark, sf_dir):
    """Constant provenance columns on every row."""
    import datetime as dt
    rows = tb.card_file(spark, sf_dir).select("CPF", "CONTA")
    return ssinks.provenance(rows, Nome_Arquivo=tb.CARD_FILE_NAME, Data_Arquivo=dt.date.fromisoformat(tb.FILE_DAY),
                             Provider=tb.CARD.provider, CreatedAt=dt.date.fromisoformat(tb.AS_OF))


@register("split_lines", f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 10 = 3 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 10 = 3 THEN 'line' ELSE 'row' END AS kind
FROM events""")
def q_split_lines(spark, sf_dir):
    """Lines that do not fit the fields are set aside with their text, the others go on."""
    e = tb.table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event_id"), "event_type")
    path, stage = file_folder(spark, "lines"), file_folder(spark, "split")
    short = F.col("event_id").cast("bigint") % 10 == 3
    e.select(F.when(short, F.col("event_id")).otherwise(F.concat_ws(";", "event_id", "event_type")).alias("value")).write.text(path)
    scanned = sfiles.scan_checked(spark, path, ["event_id", "event_type"])
    rows = sfiles.split_lines(scanned, stage, most_share=0.5).withColumn("kind", F.lit("row"))
    aside = sfiles.left_out(scanned, stage).select(F.col("_line").alias("event_id"), F.lit(None).cast("string").alias("event_type"), F.lit("line").alias("kind"))
    return rows.unionByName(aside)


# Section 2.2 - projections and filters ----------------------------------------

from .operators import enrich as en  # noqa: E402
from .plans import card as pcard  # noqa: E402


@register("open_items", with_roles("card_file") + """
SELECT CPF, CONTA FROM card_file WHERE DATA_PAGAMENTO IS NULL""")
def q_open_items(spark, sf_dir):
    """Rows without a payment date; payment columns dropped (F1)."""
    return pcard.open_items(tb.card_file(spark, sf_dir)).select("CPF", "CONTA")


@register("rename_columns", with_roles("card_file") + """
SELECT CPF, CONTA, NOME_CLIENTE, DIAS_ATRASO_TXT AS DIAS_ATRASO, DATA_DIVIDA_TXT AS DATA_DIVIDA,
       DATA_ULTIMA_FATURA_TXT AS DATA_ULTIMA_FATURA, VALOR_ULTIMA_FATURA_TXT AS VALOR_ULTIMA_FATURA
FROM card_file WHERE DATA_PAGAMENTO IS NULL""")
def q_rename_columns(spark, sf_dir):
    """File header names to clean names in one call (F2)."""
    from .spec import CARD_FILE_RENAMES
    df = pcard.open_items(tb.card_file(spark, sf_dir)).withColumnsRenamed(CARD_FILE_RENAMES)
    return df.select("CPF", "CONTA", "NOME_CLIENTE", "DIAS_ATRASO", "DATA_DIVIDA", "DATA_ULTIMA_FATURA",
                     "VALOR_ULTIMA_FATURA")


def _company_raw_sql() -> str:
    """Every text field of the company detail records, as the file holds them."""
    d = _doc_sql("o.o_custkey")
    amt = _amt_sql
    vals = {
        "Tipo_Pessoa": "CASE WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'J' ELSE 'F' END",
        "Numero_Documento": (f"substring({d}, 1, 3) || '.' || substring({d}, 4, 3) || '.' || substring({d}, 7, 3)"
                             f" || '-' || substring({d}, 10, 2)"),
        "Nome": "c.c_name",
        "Cep1": "lpad(CAST(c.c_nationkey AS VARCHAR), 8, '0')",
        "Cep2": "'01000000'",
        "Indicador_Correntista": "CASE WHEN c.c_acctbal > 5000 THEN 'S' ELSE 'N' END",
        "Contrato_Altair": f"'ALT' || {d} || lpad(CAST(o.o_orderkey AS VARCHAR), 12, '0')",
        "Numero_Operacao_LY": "CAST(o.o_orderkey AS VARCHAR)",
        "Descricao_Produto": "lower(c.c_mktsegment)",
        "Saldo_Devedor_Contrato": f"'+' || {amt('o.o_totalprice')}",
        "Dias_Atraso": f"CAST(date_diff('day', CAST(o.o_orderdate AS DATE), DATE '{tb.ARREARS_BASE}') AS VARCHAR)",
        "Codigo_Politica": "o.o_orderstatus",
        "Taxa_Padrao": f"(CASE WHEN c.c_acctbal < 0 THEN '-' ELSE '+' END) || {amt('abs(c.c_acctbal)')}",
        "Desconto_Padrao": "'+10,00'", "Percentual_Min_Entrada": "'+5,00'", "Valor_Min_Parcela": "'+150,00'",
        "Qtde_Min_Parcelas": "'1'", "Qtde_Max_Parcelas": "'24'",
        "Qtde_Parcelas_Padrao": "CAST(c.c_nationkey AS VARCHAR)", "Forma_Pgto_Padrao": "c.c_mktsegment",
        "Total": "'1'",
    }
    cols = [f"'{tb.FILE_DAY}' AS Data_Arquivo", f"'{tb.COMPANY_FILE_NAME}' AS Nome_Arquivo"]
    cols += [f"{vals.get(f, 'CAST(NULL AS VARCHAR)')} AS {f}" for f in COMPANY_FILE_FIELDS[1:]]
    return f"""SELECT {", ".join(cols)}
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderpriority = '{tb.CREDITOR}' AND o.o_orderstatus <> 'F'"""


COMPANY_PROJECTION = ("Data_Arquivo", "Nome_Arquivo", *COMPANY_FILE_FIELDS[1:])


@register("project_columns", f"SELECT * FROM ({_company_raw_sql()}) WHERE Tipo_Pessoa = 'J'")
def q_project_columns(spark, sf_dir):
    """The fixed, ordered column list of the bank file's detail records."""
    parsed = sfiles.parse_lines(tb.company_lines(spark, sf_dir), COMPANY_FILE_FIELDS, sep=";")
    rows = sfiles.strip_control_records(parsed).withColumn("Nome_Arquivo", F.lit(tb.COMPANY_FILE_NAME))
    return rows.select(*COMPANY_PROJECTION)


@register("struct_fields", with_roles("authentication") + """
SELECT document, contact, contract, creditor FROM authentication""")
def q_struct_fields(spark, sf_dir):
    """Leaves of a struct column as columns."""
    a = tb.authentication(spark, sf_dir)
    return a.select("tokenData.document", "tokenData.contact", "tokenData.contract", "tokenData.creditor")


@register("filter_creditor", with_roles("debts") + f"""
SELECT _id, contract FROM debts WHERE creditor = '{tb.CREDITOR}'""")
def q_filter_creditor(spark, sf_dir):
    """Debts of one creditor."""
    return en.filter_equals(tb.debts(spark, sf_dir), "creditor", tb.CREDITOR).select("_id", "contract")


@register("asof_cutoff", with_roles("simulation") + f"""
SELECT personID, creditor FROM simulation WHERE createdAt <= DATE '{tb.FILE_DAY}'""")
def q_asof_cutoff(spark, sf_dir):
    """Events up to midnight of the file date."""
    return en.asof_cutoff(tb.simulation(spark, sf_dir), "createdAt", tb.FILE_DAY).select("personID", "creditor")


@register("since_date", with_roles("deals") + """
SELECT dealID, CAST(createdAt AS VARCHAR) AS createdAt FROM deals WHERE createdAt >= DATE '2020-01-01'""")
def q_since_date(spark, sf_dir):
    """Deals from a lower-bound date on."""
    return en.since_date(tb.deals(spark, sf_dir), "createdAt", "2020-01-01").select("dealID", "createdAt")


@register("exclude_status", with_roles("deals") + """
SELECT dealID, status FROM deals WHERE status <> 'error'""")
def q_exclude_status(spark, sf_dir):
    """Status exclusion, null status dropped too (F8, Q6)."""
    return en.filter_not_equals(tb.deals(spark, sf_dir), "status", "error").select("dealID", "status")


@register("contains_filter", """
SELECT event_id, props FROM events WHERE NOT contains(props, '5') AND NOT contains(props, '9')""")
def q_contains_filter(spark, sf_dir):
    """Rows whose text holds none of the given substrings."""
    return en.exclude_containing(tb.table(spark, sf_dir, "events").select("event_id", "props"), "props", ["5", "9"])


@register("like_flags", with_roles("campaigns") + f"""
SELECT document, interactionDate, type, campaign_name,
       NOT (campaign_name LIKE '%{tb.CAMPAIGN_MARKER}%') AS activated
FROM campaigns""")
def q_like_flags(spark, sf_dir):
    """LIKE and NOT LIKE on the campaign name."""
    c = tb.campaigns(spark, sf_dir)
    return c.select("document", "interactionDate", "type", "campaign_name",
                    (~fx.has_marker("campaign_name", tb.CAMPAIGN_MARKER)).alias("activated"))


# Section 2.7 - scalar functions ------------------------------------------------

@register("substring_fields", """
SELECT c_custkey, substring(c_name, 10, 9) AS c_code, substring(c_name, 1, 8) AS c_prefix FROM customer""")
def q_substring_fields(spark, sf_dir):
    """1-based substrings."""
    c = tb.table(spark, sf_dir, "customer")
    return c.select("c_custkey", fx.slice_text("c_name", 10, 9).alias("c_code"),
                    fx.slice_text("c_name", 1, 8).alias("c_prefix"))


@register("pad_document", """
SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS doc11,
       lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS doc14,
       lpad(CAST(c_custkey * 1000000 AS VARCHAR), 8, '0') AS doc8_cut,
       length(CAST(c_custkey * 1000000 AS VARCHAR)) <= 8 AS fits8
FROM customer""")
def q_pad_document(spark, sf_dir):
    """Zero padding to a width, longer input cut, with the length check."""
    c = tb.table(spark, sf_dir, "customer")
    big = F.col("c_custkey") * 1000000
    return c.select("c_custkey", fx.pad_document("c_custkey", 11).alias("doc11"),
                    fx.pad_document("c_custkey", 14).alias("doc14"), fx.pad_document(big, 8).alias("doc8_cut"),
                    fx.document_fits(big, 8).alias("fits8"))


@register("concat_key", f"""
SELECT o_orderkey, {_doc_sql('o_custkey')} || ':' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS chave FROM orders""")
def q_concat_key(spark, sf_dir):
    """Composite text key document:contract."""
    o = tb.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", fx.concat_key(F.lpad(F.col("o_custkey").cast("string"), 11, "0"),
                                                F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("chave"))


_RAW_AMOUNT_SQL = f"""CASE WHEN l_linenumber = 1 THEN {_amt_sql('l_extendedprice')}
            WHEN l_linenumber = 2 THEN '-' || {_amt_sql('l_extendedprice')}
            ELSE '+' || {_amt_sql('l_extendedprice')} END"""


@register("parse_signed_decimal", f"""
SELECT l_orderkey, l_linenumber, raw,
       TRY_CAST(replace(regexp_replace(trim(raw), '^\\+', ''), ',', '.') AS DOUBLE) AS amount,
       TRY_CAST(replace(split_part(raw, '+', 2), ',', '.') AS DOUBLE) AS amount_strict
FROM (SELECT l_orderkey, l_linenumber, {_RAW_AMOUNT_SQL} AS raw FROM lineitem)""")
def q_parse_signed_decimal(spark, sf_dir):
    """Signed decimal-comma amounts to double; strict mode needs a '+' (X6, X8, X9, Q22)."""
    li = tb.table(spark, sf_dir, "lineitem")
    a = F.replace(F.col("l_extendedprice").cast("decimal(15,2)").cast("string"), F.lit("."), F.lit(","))
    raw = F.when(F.col("l_linenumber") == 1, a).when(F.col("l_linenumber") == 2, F.concat(F.lit("-"), a)) \
        .otherwise(F.concat(F.lit("+"), a))
    r = li.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return r.select("*", fx.parse_signed_decimal("raw").alias("amount"),
                    fx.parse_signed_decimal("raw", strict_sign=True).alias("amount_strict"))


@register("clean_document", f"""
SELECT c_custkey, formatted, regexp_replace(formatted, '[.,\\-/]', '', 'g') AS document
FROM (SELECT c_custkey,
             substring(d, 1, 2) || '.' || substring(d, 3, 3) || '.' || substring(d, 6, 3) || '/' ||
             substring(d, 9, 4) || '-' || substring(d, 13, 2) AS formatted
      FROM (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS d FROM customer))""")
def q_clean_document(spark, sf_dir):
    """Formatted company document to digits."""
    c = tb.table(spark, sf_dir, "customer")
    d = F.lpad(F.col("c_custkey").cast("string"), 14, "0")
    f = F.concat(F.substring(d, 1, 2), F.lit("."), F.substring(d, 3, 3), F.lit("."), F.substring(d, 6, 3),
                 F.lit("/"), F.substring(d, 9, 4), F.lit("-"), F.substring(d, 13, 2))
    r = c.select("c_custkey", f.alias("formatted"))
    return r.select("*", fx.clean_document("formatted").alias("document"))


@register("coerce_numeric", """
SELECT p_partkey, TRY_CAST(regexp_replace(CAST(p_size AS VARCHAR) || ',5,0', '^([^,]*),', '\\1.') AS DOUBLE) AS a,
       TRY_CAST(regexp_replace(CAST(p_size AS VARCHAR) || ',25', '^([^,]*),', '\\1.') AS DOUBLE) AS b,
       TRY_CAST(regexp_replace(p_type, '^([^,]*),', '\\1.') AS DOUBLE) AS c
FROM part""")
def q_coerce_numeric(spark, sf_dir):
    """Text to number, first comma as the point, bad text null."""
    p = tb.table(spark, sf_dir, "part")
    s = F.col("p_size").cast("string")
    return p.select("p_partkey", fx.coerce_numeric(F.concat(s, F.lit(",5,0"))).alias("a"),
                    fx.coerce_numeric(F.concat(s, F.lit(",25"))).alias("b"), fx.coerce_numeric("p_type").alias("c"))


@register("yes_no_flag", """
SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN TRUE WHEN c_acctbal < 0 THEN FALSE END AS correntista
FROM customer""")
def q_yes_no_flag(spark, sf_dir):
    """S/N text to boolean; other text null (X11)."""
    c = tb.table(spark, sf_dir, "customer")
    t = F.when(F.col("c_acctbal") > 5000, "S").when(F.col("c_acctbal") < 0, "N").otherwise("X")
    return c.select("c_custkey", fx.yes_no_flag(t).alias("correntista"))


@register("parse_dates", """
SELECT o_orderkey,
       CAST(CAST(try_strptime(strftime(d, '%Y%m%d'), '%Y%m%d') AS DATE) AS VARCHAR) AS d_compact,
       CAST(CAST(try_strptime(strftime(d, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS VARCHAR) AS d_br,
       CAST(CAST(try_strptime(strftime(d, '%Y-%-m-%-d'), '%Y-%-m-%-d') AS DATE) AS VARCHAR) AS d_short,
       CAST(CAST(try_strptime(substring(strftime(d, '%Y-%m-%d') || 'T12:00:00', 1, 10), '%Y-%-m-%-d') AS DATE) AS VARCHAR) AS d_iso_cut,
       CAST(CAST(try_strptime(strftime(d, '%Y') || '-02-31', '%Y-%m-%d') AS DATE) AS VARCHAR) AS d_bad
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def q_parse_dates(spark, sf_dir):
    """Text to date in the four patterns; 31 February is null."""
    o = tb.table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return o.select(
        "o_orderkey",
        fd.parse_date(F.date_format("d", "yyyyMMdd"), "yyyyMMdd").alias("d_compact"),
        fd.parse_date(F.date_format("d", "dd/MM/yyyy"), "dd/MM/yyyy").alias("d_br"),
        fd.parse_date(F.date_format("d", "yyyy-M-d"), "yyyy-M-d").alias("d_short"),
        fd.parse_day_prefix(F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit("T12:00:00"))).alias("d_iso_cut"),
        fd.parse_date(F.concat(F.date_format("d", "yyyy"), F.lit("-02-31")), "yyyy-MM-dd").alias("d_bad"),
    )


@register("format_dates", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') AS d_br FROM orders""")
def q_format_dates(spark, sf_dir):
    """Date to dd/MM/yyyy text."""
    o = tb.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", fd.format_date(F.to_date("o_orderdate"), "dd/MM/yyyy").alias("d_br"))


@register("date_parts", f"""
SELECT o_orderkey, CAST(year(d) AS INTEGER) AS ano_d, CAST(month(d) AS INTEGER) AS mes_d,
       CAST(day(d) AS INTEGER) AS dia_d, date_diff('day', d, DATE '{tb.AS_OF}') / 365.25 AS delta_d
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def q_date_parts(spark, sf_dir):
    """Year, month, day and elapsed years of a date, in one projection."""
    from .operators.features import date_features
    o = tb.table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return date_features(o, ["d"], tb.AS_OF).drop("d")


@register("age_years", with_roles("order_tags", "person_debts") + f"""
SELECT DISTINCT _id,
       CAST(floor((epoch_ms(TIMESTAMP '{tb.AS_OF} 00:00:00')
                   - epoch_ms(COALESCE(birthDate, TIMESTAMP '{tb.AS_OF} 00:00:00'))) / 31540000000) AS BIGINT)
           AS faixa_etaria
FROM person_debts""")
def q_age_years(spark, sf_dir):
    """Age in whole 31,540,000,000 ms years; no birth date gives 0."""
    p = tb.persons(spark, sf_dir)
    return p.select("_id", fd.age_years(F.to_timestamp(F.lit(tb.AS_OF)), F.col("info.birthDate"))
                    .alias("faixa_etaria"))


# Section 2.3 - joins -------------------------------------------------------------

from .operators import contact as ct  # noqa: E402
from .operators import nested as ns  # noqa: E402
from .operators import outcomes as oc  # noqa: E402
from .plans.base import email_flags, phone_flags  # noqa: E402
from .spec import (CONTACT_TAGS, DEBT_TAGS, FIRST_TOUCH, RANK_VALUES)  # noqa: E402

C = tb.CREDITOR
_P = ("p", _CARD_PERSONS_SQL)
_OPEN_FILE = ("f", "SELECT * FROM card_file WHERE DATA_PAGAMENTO IS NULL")
_DEAL_ROWS = ("dr", f"""SELECT document AS CPF, createdAt AS DT_ACORDO, dealID, status, TRUE AS VARIAVEL_RESPOSTA_ACORDO
    FROM deals WHERE creditor = '{C}' AND status <> 'error' AND createdAt >= DATE '2020-01-01'""")
_INST_ROWS = ("ir", f"""SELECT substring(COALESCE(paidAt, dueAt), 1, 10) AS DT_PAGAMENTO, dealID, QTD_PARCELAS,
           paidAt IS NOT NULL AS has_paid_date
    FROM installments WHERE substring(COALESCE(paidAt, dueAt), 1, 10) >= '2020-01-01' AND creditor = '{C}'""")


def _open_file(spark, sf_dir):
    return pcard.open_items(tb.card_file(spark, sf_dir))


def _deal_rows(spark, sf_dir):
    return oc.deal_rows(tb.deals(spark, sf_dir), C, "2020-01-01")


def _inst_rows(spark, sf_dir):
    return oc.installment_rows(tb.installments(spark, sf_dir), C, "2020-01-01")


@register("inner_join_key", with_roles("info", "debts") + f"""
SELECT i._id, i.document, d.contract FROM info i JOIN debts d ON i._id = d._id
WHERE i.documentType = 'cpf' AND d.creditor = '{C}'""")
def q_inner_join_key(spark, sf_dir):
    """Profile x the creditor's debts on the person id (JN1)."""
    i = en.filter_equals(tb.info(spark, sf_dir), "documentType", "cpf").select("_id", "document")
    d = en.filter_equals(tb.debts(spark, sf_dir), "creditor", C).select("_id", "contract")
    return en.inner_join_key(i, d, "_id")


@register("inner_join_by_person", with_roles("info", "debts") + f"""
SELECT i._id, i.document, d.contract FROM info i JOIN debts d ON i._id = d._id
WHERE i.documentType = 'cpf' AND d.creditor = '{C}'""")
def q_inner_join_by_person(spark, sf_dir):
    """The same join over snapshots stored by person, which needs no shuffle (JN1, S6)."""
    from .sources.by_person import store_by_person
    root = file_folder(spark, "by-person")
    info, debts = (store_by_person(df, root, name + uuid.uuid4().hex, tb.FILE_DAY, buckets=8)
                   for df, name in ((tb.info(spark, sf_dir), "info"), (tb.debts(spark, sf_dir), "debts")))
    i = en.filter_equals(info, "documentType", "cpf").select("_id", "document")
    return en.inner_join_key(i, en.filter_equals(debts, "creditor", C).select("_id", "contract"), "_id")


@register("left_join_two_keys", with_roles("card_file", "debts", extra=[_OPEN_FILE]) + f"""
SELECT f.CPF, f.CONTA, CAST(d.INICIO_DIVIDA AS VARCHAR) AS INICIO_DIVIDA, d.originalAmount
FROM f LEFT JOIN (SELECT * FROM debts WHERE creditor = '{C}') d ON f.CONTA = d.contract AND f.CPF = d.document""")
def q_left_join_two_keys(spark, sf_dir):
    """File rows left-joined on (contract, document) with differently named keys (JN2)."""
    d = en.filter_equals(tb.debts(spark, sf_dir), "creditor", C).select("document", "contract", "INICIO_DIVIDA",
                                                                        "originalAmount")
    out = en.left_join_keys(_open_file(spark, sf_dir).select("CPF", "CONTA"), d, ["CONTA", "CPF"],
                            ["contract", "document"])
    return out


@register("left_join_renamed_key", with_roles("card_file", "interactions", extra=[_OPEN_FILE]) + """
SELECT f.CPF, f.CONTA, n.n FROM f
LEFT JOIN (SELECT document, count(*) AS n FROM interactions GROUP BY document) n ON f.CPF = n.document""")
def q_left_join_renamed_key(spark, sf_dir):
    """Left join on a key named differently on each side, right key dropped (JN3)."""
    n = en.count_per_key(tb.interactions(spark, sf_dir), "document", "document", "n")
    return en.left_join_keys(_open_file(spark, sf_dir).select("CPF", "CONTA"), n, ["CPF"], ["document"])


@register("exists_other_creditor", with_roles("debts", extra=[_P]) + f"""
SELECT p._id, p.CPF, EXISTS (SELECT 1 FROM debts d WHERE d._id = p._id AND d.creditor <> '{C}') AS Divida_Outro_Credor
FROM p""")
def q_exists_other_creditor(spark, sf_dir):
    """Flag: the person owes another creditor (JN4, W3)."""
    others = en.filter_not_equals(tb.debts(spark, sf_dir), "creditor", C)
    return en.exists_flag(_card_persons(spark, sf_dir), others, ["_id"], ["_id"], "Divida_Outro_Credor")


@register("debts_not_in_file", with_roles("card_file", "debts", extra=[_OPEN_FILE]) + f"""
SELECT d._id, d.contract FROM debts d
WHERE d.creditor = '{C}' AND NOT EXISTS (SELECT 1 FROM f WHERE f.CPF = d.document AND f.CONTA = d.contract)""")
def q_debts_not_in_file(spark, sf_dir):
    """The creditor's debts absent from the file, as an anti join (JN5)."""
    d = en.filter_equals(tb.debts(spark, sf_dir), "creditor", C)
    out = en.anti_join(d, _open_file(spark, sf_dir), ["document", "contract"], ["CPF", "CONTA"])
    return out.select("_id", "contract")


@register("exists_same_creditor", with_roles("card_file", "debts", extra=[_OPEN_FILE, _P, (
    "r", "SELECT f.CPF, f.CONTA, p._id FROM f JOIN p ON f.CPF = p.CPF")]) + f"""
SELECT r.CPF, r.CONTA, EXISTS (
    SELECT 1 FROM debts d WHERE d.creditor = '{C}' AND d._id = r._id
    AND NOT EXISTS (SELECT 1 FROM r r2 WHERE r2._id = d._id AND r2.CONTA = d.contract)) AS Divida_Mesmo_Credor
FROM r""")
def q_exists_same_creditor(spark, sf_dir):
    """Flag: the person has another debt at the creditor that is not in the file (JN6)."""
    rows = _open_file(spark, sf_dir).select("CPF", "CONTA").join(_card_persons(spark, sf_dir), "CPF")
    own = en.filter_equals(tb.debts(spark, sf_dir), "creditor", C)
    out = en.exists_same_creditor(rows, own, "Divida_Mesmo_Credor", person="_id", row_contract="CONTA")
    return out.select("CPF", "CONTA", "Divida_Mesmo_Credor")


@register("earliest_debt", with_roles("debts") + """
SELECT d._id, d.creditor, d.contract, CAST(d.INICIO_DIVIDA AS VARCHAR) AS INICIO_DIVIDA FROM debts d
JOIN (SELECT _id, creditor, min(INICIO_DIVIDA) AS m FROM debts GROUP BY _id, creditor) g
  ON d._id = g._id AND d.creditor = g.creditor AND d.INICIO_DIVIDA = g.m""")
def q_earliest_debt(spark, sf_dir):
    """Earliest debt per (person, creditor), ties kept (JN7, A2)."""
    d = tb.debts(spark, sf_dir).select("_id", "creditor", "contract", "INICIO_DIVIDA")
    return en.earliest_per_group(d, ["_id", "creditor"], "INICIO_DIVIDA")


@register("count_asof_auth", with_roles("debts", "authentication", extra=[_P]) + f"""
SELECT p._id, p.CPF, COALESCE(a.n, 0) AS QTD_AUTH
FROM p LEFT JOIN (
    SELECT document, count(*) AS n FROM authentication
    WHERE creditor = '{C}' AND createdAt <= DATE '{tb.FILE_DAY}' GROUP BY document) a ON p.CPF = a.document""")
def q_count_asof_auth(spark, sf_dir):
    """Authentications per document up to the file date, 0 when none (JN8, F4)."""
    auth = tb.authentication(spark, sf_dir).select("tokenData.document", "tokenData.creditor", "createdAt")
    return en.count_asof(_card_persons(spark, sf_dir), auth, "document", "CPF", "QTD_AUTH", C, "createdAt",
                         tb.FILE_DAY)


@register("count_asof_state", with_roles("debts", "simulation", extra=[("p", _CARD_PERSONS_SQL)]) + f"""
SELECT p._id, p.CPF, COALESCE(s.n, 0) AS QTD_SIMU
FROM p LEFT JOIN (
    SELECT personID, count(*) AS n FROM simulation
    WHERE creditor = '{tb.CREDITOR}' AND createdAt <= DATE '{tb.FILE_DAY}'
    GROUP BY personID) s ON p._id = s.personID""")
def q_count_asof_state(spark, sf_dir):
    """Simulations per person up to the file date from daily partials, one day counted again (JN8, A1)."""
    from .operators import daily_counts as dc
    root, events = file_folder(spark, "simulation-days"), tb.simulation(spark, sf_dir)
    dc.store_history(events, root, "personID", "createdAt")
    dc.store_day(events, root, tb.FILE_DAY, "personID", "createdAt")
    return dc.count_from_state(_card_persons(spark, sf_dir), dc.read_state(spark, root), "_id", "QTD_SIMU", tb.FILE_DAY, tb.CREDITOR)


@register("deal_outcome", with_roles("debts", "deals", extra=[_P, _DEAL_ROWS]) + """
SELECT p.CPF, CAST(dr.DT_ACORDO AS VARCHAR) AS DT_ACORDO, dr.dealID, dr.status,
       COALESCE(dr.VARIAVEL_RESPOSTA_ACORDO, FALSE) AS VARIAVEL_RESPOSTA_ACORDO
FROM p LEFT JOIN dr ON p.CPF = dr.CPF""")
def q_deal_outcome(spark, sf_dir):
    """1:N left join of the creditor's deals (JN9, F7, F8, X21)."""
    return oc.deal_outcome(_card_persons(spark, sf_dir).select("CPF"), _deal_rows(spark, sf_dir))


@register("payment_outcome", with_roles("deals", "installments", extra=[_DEAL_ROWS, _INST_ROWS]) + """
SELECT dr.CPF, dr.dealID, ir.DT_PAGAMENTO, COALESCE(ir.QTD_PARCELAS, 0) AS QTD_PARCELAS,
       ir.DT_PAGAMENTO IS NOT NULL AS PAGTO, COALESCE(ir.has_paid_date, FALSE) AS has_payment
FROM dr LEFT JOIN ir ON dr.dealID = ir.dealID""")
def q_payment_outcome(spark, sf_dir):
    """1:N left join of installments by deal; paid date else due date (JN10, X20, Q7)."""
    out = oc.payment_outcome(_deal_rows(spark, sf_dir).select("CPF", "dealID"), _inst_rows(spark, sf_dir))
    return out.select("CPF", "dealID", "DT_PAGAMENTO", "QTD_PARCELAS", "PAGTO", "has_payment")


@register("inner_join_deals", with_roles("deals", "installments", extra=[_DEAL_ROWS, _INST_ROWS]) + """
SELECT dr.dealID, dr.CPF, ir.DT_PAGAMENTO, ir.QTD_PARCELAS FROM dr JOIN ir ON dr.dealID = ir.dealID""")
def q_inner_join_deals(spark, sf_dir):
    """Inner join of deals to payments on the deal id (JN13)."""
    out = oc.inner_join_deals(_deal_rows(spark, sf_dir), _inst_rows(spark, sf_dir))
    return out.select("dealID", "CPF", "DT_PAGAMENTO", "QTD_PARCELAS")


# Section 2.8 - arrays and nested ---------------------------------------------------

def _flag_sql(slot: str, tag: str, none_tag: str = "sem_tags") -> str:
    if tag == none_tag:
        return f"list_contains({slot}, '{tag}') IS NULL"
    return f"COALESCE(list_contains({slot}, '{tag}'), FALSE)"


def phone_flags_sql(col: str = "tag_telefone", slots: int = 10) -> list[str]:
    return [f'{_flag_sql(f"{col}[{i + 1}]", t)} AS "Telefone{i + 1}_{t}"' for i in range(slots) for t in CONTACT_TAGS]


def email_flags_sql(col: str = "tag_email", slots: int = 3) -> list[str]:
    out = []
    for i in range(slots):
        out += [f'{_flag_sql(f"{col}[{i + 1}]", t)} AS "Email{i + 1}_{t}"' for t in CONTACT_TAGS]
        out.append(f'domain[{i + 1}] AS "Email{i + 1}_dominio"')
    return out


def state_slots_sql(slots: int = 3) -> list[str]:
    return [f"upper(NULLIF(state[{i + 1}], '{tb.STATE_PLACEHOLDER}')) AS UF{i + 1}" for i in range(slots)]


def debt_flags_sql(col: str = "tag_divida") -> list[str]:
    return [f'{_flag_sql(col, t)} AS "SkipDivida_{t}"' for t in DEBT_TAGS]


@register("phone_tag_flags", with_roles("info") + f"""
SELECT _id, {", ".join(phone_flags_sql())} FROM info""")
def q_phone_tag_flags(spark, sf_dir):
    """10 phone slots x 6 tags in one projection."""
    return phone_flags(tb.info(spark, sf_dir), tb.CARD)


@register("email_tag_flags", with_roles("info") + f"""
SELECT _id, {", ".join(email_flags_sql())} FROM info""")
def q_email_tag_flags(spark, sf_dir):
    """3 e-mail slots x 6 tags plus each slot's domain."""
    return email_flags(tb.info(spark, sf_dir), tb.CARD)


@register("state_slots", with_roles("info") + f"""
SELECT _id, {", ".join(state_slots_sql())} FROM info""")
def q_state_slots(spark, sf_dir):
    """Three state slots, placeholder to null, upper case."""
    from .functions.arrays import state_slots
    return tb.info(spark, sf_dir).select("_id", *state_slots("state", 3, tb.STATE_PLACEHOLDER))


@register("debt_rank_flags", with_roles("debts") + f"""
SELECT _id, contract, {", ".join(debt_flags_sql())} FROM debts""")
def q_debt_rank_flags(spark, sf_dir):
    """Rank flags a..e plus none, from the debt tag array."""
    from .functions.arrays import tag_flags
    d = tb.debts(spark, sf_dir)
    return d.select("_id", "contract", *tag_flags("tag_divida", DEBT_TAGS, "SkipDivida_"))


_CRED_DEBTS = ("nd", f"SELECT * FROM person_debts WHERE creditor = '{C}'")
_PEOPLE = ("pp", "SELECT DISTINCT _id, document FROM person_debts")


@register("filter_nested", with_roles("person_debts", extra=[_PEOPLE, _CRED_DEBTS]) + """
SELECT pp._id, CAST(count(nd.contract) AS INTEGER) AS n_debts
FROM pp LEFT JOIN nd ON pp._id = nd._id GROUP BY pp._id""")
def q_filter_nested(spark, sf_dir):
    """Keep one creditor's debts inside the nested array."""
    p = tb.persons(spark, sf_dir)
    return p.select("_id", F.size(ns.filter_nested(F.col("debts"), C)).alias("n_debts"))


def _exploded(spark, sf_dir):
    proj = ns.person_projection(tb.persons(spark, sf_dir), C, tb.AS_OF)
    return ns.explode_debts(proj, ("contract", "createdAt", "tags"))


@register("explode_debts", with_roles("person_debts", extra=[_PEOPLE, _CRED_DEBTS]) + """
SELECT pp.document, nd.contract, CAST(nd.createdAt AS VARCHAR) AS createdAt
FROM pp LEFT JOIN nd ON pp._id = nd._id""")
def q_explode_debts(spark, sf_dir):
    """One row per nested debt, persons without debts kept."""
    return _exploded(spark, sf_dir).drop("tags")


_RANK_SQL = "CASE " + " ".join(f"WHEN list_contains(nd.tags, '{r}') THEN '{r}'" for r in RANK_VALUES[:-1]) + \
    f" ELSE '{RANK_VALUES[-1]}' END"


@register("single_rank", with_roles("person_debts", extra=[_PEOPLE, _CRED_DEBTS]) + f"""
SELECT pp.document, nd.contract, {_RANK_SQL} AS rank
FROM pp LEFT JOIN nd ON pp._id = nd._id""")
def q_single_rank(spark, sf_dir):
    """One rank per debt, smallest listed rank, else sem_skip."""
    from .functions.arrays import single_rank
    e = _exploded(spark, sf_dir)
    return e.select("document", "contract", single_rank("tags", RANK_VALUES[:-1], RANK_VALUES[-1]).alias("rank"))


@register("one_hot_fixed", with_roles("person_debts", extra=[_PEOPLE, _CRED_DEBTS]) + f"""
SELECT document, contract, {", ".join(f"rank = '{r}' AS \"{r}\"" for r in RANK_VALUES)}
FROM (SELECT pp.document, nd.contract, {_RANK_SQL} AS rank FROM pp LEFT JOIN nd ON pp._id = nd._id)""")
def q_one_hot_fixed(spark, sf_dir):
    """One boolean column per listed rank."""
    return ns.rank_columns(_exploded(spark, sf_dir), "tags", RANK_VALUES).drop("createdAt")


@register("zip_explode", """
SELECT 'id' || CAST(o.o_custkey AS VARCHAR) AS _id, CAST(o.o_orderkey AS VARCHAR) AS dealID,
       o.o_orderpriority AS creditor, CAST(l.l_partkey AS VARCHAR) AS contract
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def q_zip_explode(spark, sf_dir):
    """Parallel arrays zipped and exploded, then an inner array exploded."""
    li = tb.table(spark, sf_dir, "lineitem")
    parts = li.groupBy("l_orderkey").agg(F.collect_list(F.col("l_partkey").cast("string")).alias("debts"))
    o = tb.table(spark, sf_dir, "orders").join(parts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    per = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct(
        F.col("o_orderkey").cast("string").alias("dealID"), F.col("o_orderpriority").alias("creditor"),
        "debts"))).alias("d"))
    nested = per.select(F.concat(F.lit("id"), F.col("o_custkey").cast("string")).alias("_id"),
                        F.col("d.dealID").alias("dealID"), F.col("d.creditor").alias("creditor"),
                        F.col("d.debts").alias("debts"))
    return ns.zip_explode(nested, ["_id"], ["dealID", "creditor", "debts"], "debts", "contract")


@register("merge_composite_key", with_roles("company_fields", "person_debts", extra=[_CRED_DEBTS]) + f"""
SELECT '{tb.COMPANY_CREDITOR_ID}' AS ID_Credor, cf.document AS ID_DEVEDOR, cf.Contrato_Altair,
       '{tb.AS_OF}' AS data_referencia, CAST(CAST(nd.createdAt AS DATE) AS VARCHAR) AS DATA_ENTRADA_DIVIDA,
       CASE cf.Indicador_Correntista_TXT WHEN 'S' THEN TRUE WHEN 'N' THEN FALSE END AS Indicador_Correntista,
       cf.Cep1, cf.Cep2, cf.Cep3, cf.Forma_Pgto_Padrao, cf.Taxa_Padrao, cf.Desconto_Padrao,
       cf.Qtde_Min_Parcelas, cf.Qtde_Max_Parcelas, cf.Qtde_Parcelas_Padrao, cf.Valor_Min_Parcela,
       cf.Codigo_Politica, cf.Saldo_Devedor_Contrato, cf.Dias_Atraso, cf.Descricao_Produto,
       {", ".join(f"CASE WHEN nd.document IS NULL THEN NULL ELSE ({_RANK_SQL}) = '{r}' END AS \"{r}\"" for r in RANK_VALUES)}
FROM company_fields cf LEFT JOIN nd ON cf.document = nd.document AND cf.Contrato_Altair = nd.contract
WHERE cf.Tipo_Pessoa = 'J'""")
def q_merge_composite_key(spark, sf_dir):
    """Company file rows merged with their nested debts on (document, contract) (JN12, J1 stage)."""
    from .plans.company import company_base_rows
    parsed = sfiles.parse_lines(tb.company_lines(spark, sf_dir), COMPANY_FILE_FIELDS, sep=";")
    return company_base_rows(parsed, tb.persons(spark, sf_dir), tb.COMPANY, tb.COMPANY_FILE_NAME,
                             tb.COMPANY_CREDITOR_ID, tb.AS_OF)


# Section 2.4 / 2.5 - aggregations, first and latest ----------------------------------

_DAYS_SQL = ("days", """SELECT document, CAST(try_strptime(substring(sentAt, 1, 10), '%Y-%-m-%-d') AS DATE) AS DT_INTERACAO,
           type FROM interactions WHERE status <> 'not_received'""")
_DC_SQL = ("dc", """SELECT document, DT_INTERACAO,
           CAST(sum(CASE WHEN type = 'email' THEN 1 END) AS BIGINT) AS email,
           CAST(sum(CASE WHEN type = 'sms' THEN 1 END) AS BIGINT) AS sms
    FROM days GROUP BY document, DT_INTERACAO""")
_LD_SQL = ("ld", """SELECT CPF, DT_ACORDO, dealID, status FROM (
        SELECT *, row_number() OVER (PARTITION BY CPF ORDER BY DT_ACORDO DESC NULLS LAST, dealID DESC) AS rn FROM dr)
    WHERE rn = 1""")
_LAB_SQL = ("lab", """SELECT dc.document, dc.DT_INTERACAO, COALESCE(dc.email, 0) AS email, COALESCE(dc.sms, 0) AS sms,
           CASE WHEN dc.DT_INTERACAO <= ld.DT_ACORDO
                  OR (dc.DT_INTERACAO > ld.DT_ACORDO AND ld.status IN ('expired', 'broken'))
                  OR ld.DT_ACORDO IS NULL THEN 'ATIVADO' ELSE 'NAO_ATIVADO' END AS ATIVACAO
    FROM dc LEFT JOIN ld ON dc.document = ld.CPF""")
_PIVOT_ACT_SQL = ("act", """SELECT document,
           CAST(COALESCE(sum(CASE WHEN ATIVACAO = 'ATIVADO' THEN email END), 0) AS BIGINT) AS ACION_EMAIL_QTD_ATIVADO,
           CAST(COALESCE(sum(CASE WHEN ATIVACAO = 'ATIVADO' THEN sms END), 0) AS BIGINT) AS ACION_SMS_QTD_ATIVADO,
           CAST(COALESCE(sum(CASE WHEN ATIVACAO = 'NAO_ATIVADO' THEN email END), 0) AS BIGINT) AS ACION_EMAIL_QTD_NAO_ATIVADO,
           CAST(COALESCE(sum(CASE WHEN ATIVACAO = 'NAO_ATIVADO' THEN sms END), 0) AS BIGINT) AS ACION_SMS_QTD_NAO_ATIVADO
    FROM lab GROUP BY document""")
_CONTACT_CTES = [_DEAL_ROWS, _DAYS_SQL, _DC_SQL, _LD_SQL, _LAB_SQL]


def _days(spark, sf_dir):
    return ct.interaction_days_raw(tb.interactions(spark, sf_dir))


def _labelled(spark, sf_dir):
    dc = ct.pivot_channel_day(_days(spark, sf_dir), ["email", "sms"])
    return ct.activation_label(dc, ct.latest_deal(_deal_rows(spark, sf_dir)), ["email", "sms"])


@register("pivot_channel_day", with_roles("interactions", extra=[_DAYS_SQL, _DC_SQL]) + """
SELECT document, CAST(DT_INTERACAO AS VARCHAR) AS DT_INTERACAO, email, sms FROM dc""")
def q_pivot_channel_day(spark, sf_dir):
    """Interactions per person and day, one column per channel."""
    return ct.pivot_channel_day(_days(spark, sf_dir), ["email", "sms"])


@register("activation_label", with_roles("interactions", "deals", extra=_CONTACT_CTES) + """
SELECT document, CAST(DT_INTERACAO AS VARCHAR) AS DT_INTERACAO, email, sms, ATIVACAO FROM lab""")
def q_activation_label(spark, sf_dir):
    """Interaction day labelled by the person's latest deal (A7, JN11, W2, F11, F12)."""
    return _labelled(spark, sf_dir)


@register("pivot_activation", with_roles("interactions", "deals", extra=_CONTACT_CTES + [_PIVOT_ACT_SQL]) + """
SELECT * FROM act""")
def q_pivot_activation(spark, sf_dir):
    """Per person: e-mail and sms sums by activation label, null as 0."""
    return ct.pivot_activation(_labelled(spark, sf_dir), tb.CARD.channels)


@register("first_touch", with_roles("interactions", extra=[_DAYS_SQL]) + """
SELECT document, CAST(min(DT_INTERACAO) AS VARCHAR) AS PRIMEIRO_ACIONAMENTO FROM days GROUP BY document""")
def q_first_touch(spark, sf_dir):
    """First contact date per person."""
    return ct.first_touch(_days(spark, sf_dir), "DT_INTERACAO", FIRST_TOUCH)


_CHANNEL_SQL = ", ".join(
    f"CAST(count_if(NOT (campaign_name LIKE '%{tb.CAMPAIGN_MARKER}%') AND type = '{v}') AS BIGINT) "
    f"AS ACION_{t}_QTD_ATIVADO, "
    f"CAST(count_if((campaign_name LIKE '%{tb.CAMPAIGN_MARKER}%') AND type = '{v}') AS BIGINT) "
    f"AS ACION_{t}_QTD_NAO_ATIVADO"
    for v, t in tb.COMPANY.channels)


@register("channel_counts", with_roles("campaigns") + f"""
SELECT document, {_CHANNEL_SQL} FROM campaigns GROUP BY document""")
def q_channel_counts(spark, sf_dir):
    """Conditional counts per person: 3 channels x activated or not, one pass."""
    return ct.channel_counts(tb.campaigns(spark, sf_dir), tb.COMPANY.channels, tb.CAMPAIGN_MARKER)


@register("distinct_rows", with_roles("debts") + f"""
SELECT DISTINCT _id, creditor, {", ".join(debt_flags_sql())} FROM debts""")
def q_distinct_rows(spark, sf_dir):
    """Distinct rows."""
    from .functions.arrays import tag_flags
    d = tb.debts(spark, sf_dir).select("_id", "creditor", *tag_flags("tag_divida", DEBT_TAGS, "SkipDivida_"))
    return en.distinct_rows(d)


@register("dedupe_by_key", with_roles("debts") + f"""
SELECT _id, creditor, contract FROM (
    SELECT *, row_number() OVER (PARTITION BY _id ORDER BY INICIO_DIVIDA ASC NULLS FIRST, contract ASC) AS rn
    FROM debts WHERE creditor <> '{C}') WHERE rn = 1""")
def q_dedupe_by_key(spark, sf_dir):
    """One other-creditor debt per person, the earliest, by a total order."""
    d = en.filter_not_equals(tb.debts(spark, sf_dir), "creditor", C)
    return en.first_per_key(d, ["_id"], [F.col("INICIO_DIVIDA"), F.col("contract")], ["creditor", "contract"])


@register("row_count", with_roles("card_file") + """
SELECT count(*) AS n_rows FROM card_file WHERE DATA_PAGAMENTO IS NULL""")
def q_row_count(spark, sf_dir):
    """Row count as a one-row result (A10)."""
    return en.row_count(_open_file(spark, sf_dir))


# Section 2.9 / 2.10 - features and scoring -----------------------------------------

from .operators import features as fe  # noqa: E402
from .operators import score as sc  # noqa: E402
from .spec import CARD_BAND_EDGES, COMPANY_BAND_EDGES  # noqa: E402


def _band_sql(p: str, edges) -> str:
    return "CASE WHEN " + p + " IS NULL THEN NULL " + " ".join(
        f"WHEN {p} <= {float(e)!r} THEN {i}" for i, e in enumerate(edges)) + f" ELSE {len(edges)} END"


_PRE_SQL = ("pre", f"""SELECT {_doc_sql('o_custkey')} AS Chave,
           1.0 / (1.0 + exp(-(o_totalprice / 100000.0 - 2.0))) AS P_1
    FROM orders""")
_PRE_GH_SQL = ("pre_gh", f"SELECT Chave, P_1, {_band_sql('P_1', CARD_BAND_EDGES)} AS GH FROM pre")


def _pre(spark, sf_dir):
    o = tb.table(spark, sf_dir, "orders")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("o_totalprice") / F.lit(100000.0) - F.lit(2.0))))
    return sc.with_band(o.select(F.lpad(F.col("o_custkey").cast("string"), 11, "0").alias("Chave"), p.alias("P_1")),
                        CARD_BAND_EDGES)


@register("score_rollup", with_roles(extra=[_PRE_SQL, _PRE_GH_SQL]) + f"""
SELECT lpad(Chave, 11, '0') AS Document, max(GH) AS Score, round(max(P_1), 9) AS ScoreValue,
       round(avg(P_1), 9) AS ScoreAvg, '{tb.CARD.provider}' AS Provider, '{tb.FILE_DAY}' AS Date,
       '{tb.AS_OF}' AS CreatedAt
FROM pre_gh GROUP BY lpad(Chave, 11, '0')""")
def q_score_rollup(spark, sf_dir):
    """One published row per person: max band, max and mean probability, provenance (A3, M4, Q1)."""
    r = sc.score_rollup(_pre(spark, sf_dir), 11, tb.CARD.provider, tb.FILE_DAY, tb.AS_OF)
    return r.withColumns({"ScoreValue": F.round("ScoreValue", 9), "ScoreAvg": F.round("ScoreAvg", 9)})


@register("publish_committed", with_roles(extra=[_PRE_SQL, _PRE_GH_SQL]) + f"""
, s AS (SELECT lpad(Chave, 11, '0') AS Document, max(GH) AS Score FROM pre_gh GROUP BY lpad(Chave, 11, '0'))
SELECT Document, Score, 'scores' AS output FROM s UNION ALL SELECT Document, Score, 'export' FROM s""")
def q_publish_committed(spark, sf_dir):
    """Scores and their delimited export, written by one run, audited, committed and read back from the manifest."""
    from .sources.commits import Run, read_committed
    scores = sc.score_rollup(_pre(spark, sf_dir), 11, tb.CARD.provider, tb.FILE_DAY, tb.AS_OF)
    root, slot = file_folder(spark, "published"), f"file_date={tb.FILE_DAY}"
    run = Run(spark, root, slot)
    run.write("export", run.write("scores", scores), root=root + "-export", format="csv", header=True, sep=";")
    run.commit()
    seen = [read_committed(spark, root, slot, name).select("Document", F.col("Score").cast("int").alias("Score"), F.lit(name).alias("output"))
            for name in ("scores", "export")]
    return seen[0].unionByName(seen[1])


@register("sorted_output", with_roles(extra=[_PRE_SQL, _PRE_GH_SQL]) + """
SELECT lpad(Chave, 11, '0') AS Document, max(GH) AS Score FROM pre_gh GROUP BY 1 ORDER BY Score DESC, Document""")
def q_sorted_output(spark, sf_dir):
    """Final output sorted on two keys, descending then ascending (O1); sorting only at the end."""
    r = _pre(spark, sf_dir).groupBy(F.lpad("Chave", 11, "0").alias("Document")).agg(F.max("GH").alias("Score"))
    return r.orderBy(F.col("Score").desc(), F.col("Document").asc())


@register("band_histogram", with_roles(extra=[_PRE_SQL, _PRE_GH_SQL]) + """
SELECT GH, count(*) AS n FROM pre_gh GROUP BY GH""")
def q_band_histogram(spark, sf_dir):
    """Rows per band."""
    return sc.band_histogram(_pre(spark, sf_dir))


@register("score_bands_6", f"""
SELECT o_orderkey, {_band_sql('o_totalprice / 600000.0', CARD_BAND_EDGES)} AS GH FROM orders""")
def q_score_bands_6(spark, sf_dir):
    """Probability to band 0..5 with the card edges (M3, Q30)."""
    o = tb.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", sc.score_band(F.col("o_totalprice") / F.lit(600000.0), CARD_BAND_EDGES).alias("GH"))


@register("score_bands_9", f"""
SELECT o_orderkey, {_band_sql('o_totalprice / 4000000.0', COMPANY_BAND_EDGES)} AS GH FROM orders""")
def q_score_bands_9(spark, sf_dir):
    """Probability to band 0..8 with the company edges (M3, Q30)."""
    o = tb.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", sc.score_band(F.col("o_totalprice") / F.lit(4000000.0), COMPANY_BAND_EDGES)
                    .alias("GH"))


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@register("one_hot_values", f"""
SELECT c_custkey, {", ".join(f"CAST(COALESCE(seg = '{v}', FALSE) AS INTEGER) AS seg_{v}" for v in _SEGMENTS if v != "HOUSEHOLD")}
FROM (SELECT c_custkey, NULLIF(c_mktsegment, 'HOUSEHOLD') AS seg FROM customer)""")
def q_one_hot_values(spark, sf_dir):
    """``<column>_<value>`` 0/1 columns from a value list; null is all 0."""
    c = tb.table(spark, sf_dir, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("seg"))
    return c.select("c_custkey", *fe.one_hot_values("seg", [v for v in _SEGMENTS if v != "HOUSEHOLD"]))


_PRIOS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@register("one_hot_drop_first", f"""
SELECT o_orderkey, {", ".join(f'CAST(COALESCE(o_orderpriority = {v!r}, FALSE) AS INTEGER) AS "o_orderpriority_{v}"' for v in _PRIOS[1:])}
FROM orders""")
def q_one_hot_drop_first(spark, sf_dir):
    """One-hot without the first level."""
    o = tb.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", *fe.one_hot_drop_first("o_orderpriority", _PRIOS))


_FV_GROUPS = fe.FeatureGroups(numeric=("price_txt", "c_acctbal"), categorical=("c_mktsegment",), dates=("d",),
                              binary_prefixes=("is_",), one_hot_prefixes=("Email",))
_FV_NAMES = ("price_txt", "c_acctbal", "c_mktsegment_BUILDING", "c_mktsegment_HOUSEHOLD", "ano_d", "mes_d", "dia_d",
             "delta_d", "is_open", "Email1_dominio_building.com", "not_in_data")
_FV_COEF = {"price_txt": 0.000004, "c_acctbal": -0.0001, "c_mktsegment_BUILDING": 0.3,
            "c_mktsegment_HOUSEHOLD": -0.2, "ano_d": 0.01, "mes_d": -0.02, "dia_d": 0.005, "delta_d": -0.05,
            "is_open": 0.4, "Email1_dominio_building.com": 0.1, "not_in_data": 1.0}


def _fv_frame(spark, sf_dir):
    o = tb.table(spark, sf_dir, "orders")
    c = tb.table(spark, sf_dir, "customer")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    return j.select(
        "o_orderkey",
        F.replace(F.col("o_totalprice").cast("decimal(15,2)").cast("string"), F.lit("."), F.lit(",")).alias("price_txt"),
        "c_acctbal", "c_mktsegment", F.to_date("o_orderdate").alias("d"),
        (F.col("o_orderstatus") == "O").alias("is_open"),
        F.concat(F.lower("c_mktsegment"), F.lit(".com")).alias("Email1_dominio"))


_FV_SQL = ("fv", f"""SELECT DISTINCT CAST(o.o_orderkey AS VARCHAR) AS o_orderkey,
           TRY_CAST(CAST(CAST(o.o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS DOUBLE) AS price_txt,
           c.c_acctbal AS c_acctbal,
           CAST(c.c_mktsegment = 'BUILDING' AS DOUBLE) AS c_mktsegment_BUILDING,
           CAST(c.c_mktsegment = 'HOUSEHOLD' AS DOUBLE) AS c_mktsegment_HOUSEHOLD,
           CAST(year(o.o_orderdate) AS DOUBLE) AS ano_d, CAST(month(o.o_orderdate) AS DOUBLE) AS mes_d,
           CAST(day(o.o_orderdate) AS DOUBLE) AS dia_d,
           date_diff('day', CAST(o.o_orderdate AS DATE), DATE '{tb.AS_OF}') / 365.25 AS delta_d,
           CAST(o.o_orderstatus = 'O' AS DOUBLE) AS is_open,
           CAST(lower(c.c_mktsegment) || '.com' = 'building.com' AS DOUBLE) AS "Email1_dominio_building.com",
           CAST(NULL AS DOUBLE) AS not_in_data
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")


@register("feature_vector", with_roles(extra=[_FV_SQL]) + "SELECT * FROM fv")
def q_feature_vector(spark, sf_dir):
    """Model features in the model's order: numeric, one-hot, date parts, flags, absent as null."""
    return fe.feature_vector(_fv_frame(spark, sf_dir), "o_orderkey", _FV_NAMES, _FV_GROUPS, tb.AS_OF)


_LINEAR_SQL = " + ".join(f'{float(w)!r} * COALESCE("{n}", 0.0)' for n, w in _FV_COEF.items())


@register("score_linear", with_roles(extra=[_FV_SQL]) + f"""
SELECT o_orderkey AS Chave, round(1.0 / (1.0 + exp(-(-1.0 + {_LINEAR_SQL}))), 9) AS P_1 FROM fv""")
def q_score_linear(spark, sf_dir):
    """Probability from a published coefficient list (M2)."""
    feats = fe.feature_vector(_fv_frame(spark, sf_dir), "o_orderkey", _FV_NAMES, _FV_GROUPS, tb.AS_OF)
    s = sc.score_linear(feats, "o_orderkey", _FV_COEF, -1.0)
    return s.withColumn("P_1", F.round("P_1", 9))


@register("score_gbt")
def q_score_gbt(spark, sf_dir):
    """Boosted-tree probability for every document, model trained on the labelled ones (M1, rows-only)."""
    docs = tb.table(spark, sf_dir, "documents")
    langs = ("en", "fr", "de", "es")
    feats = docs.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"),
                        *[(F.col("lang") == v).cast("double").alias(f"lang_{v}") for v in langs],
                        F.length("text").cast("double").alias("text_len"))
    names = ["n_chars", *[f"lang_{v}" for v in langs], "text_len"]
    labels = tb.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    model = sc.fit_gbt(feats.join(labels, "doc_id"), names, "label", max_iter=10, max_depth=3)
    return sc.score_model(model, feats, "doc_id").withColumn("Chave", F.col("Chave").cast("string"))


@register("score_forest", forest_sql())
def q_score_forest(spark, sf_dir):
    """Probability of every customer from a trainer's dump of 500 trees of depth 6, as flat node arrays (M1)."""
    from .operators.forest import forest_of_dump, score_forest
    model = forest_of_dump(tb.forest_dump(), tb.FOREST_BASE, tuple(tb.FOREST_RANGES))
    scores = score_forest(tb.customer_features(spark, sf_dir), "c_custkey", model)
    return scores.withColumn("P_1", F.round("P_1", 9))


# Section 2.11 - composite pipelines ----------------------------------------------

from . import composite_sql as csql  # noqa: E402
from .plans.card import build_card_base  # noqa: E402
from .plans.company import build_company_base  # noqa: E402
from .plans.daily import stage_at  # noqa: E402
from .plans.publish import propensity_scores  # noqa: E402
from .spec import (CARD_CATEGORICAL, CARD_DATES, CARD_NUMERIC, COMPANY_CATEGORICAL, COMPANY_DATES,  # noqa: E402
                   COMPANY_NUMERIC)

CARD_GROUPS = fe.FeatureGroups(numeric=CARD_NUMERIC, categorical=CARD_CATEGORICAL, dates=CARD_DATES)
COMPANY_GROUPS = fe.FeatureGroups(numeric=COMPANY_NUMERIC, categorical=COMPANY_CATEGORICAL, dates=COMPANY_DATES)


def run_stage(spark: SparkSession, name: str) -> Callable[[DataFrame], DataFrame]:
    """A stage table of its own for each call, as the daily jobs write one per run."""
    ensure_checkpoint_dir(spark)
    return stage_at(spark, stage_path(spark, name, uuid.uuid4().hex))


def card_base(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return build_card_base(tb.card_file(spark, sf_dir), tb.card_sources(spark, sf_dir), tb.CARD, tb.FILE_DAY,
                           run_stage(spark, "card"), **kw)


def company_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = sfiles.parse_lines(tb.company_lines(spark, sf_dir), COMPANY_FILE_FIELDS, sep=";")
    return build_company_base(parsed, tb.company_sources(spark, sf_dir), tb.COMPANY, tb.COMPANY_FILE_NAME,
                              tb.COMPANY_CREDITOR_ID, tb.FILE_DAY, tb.AS_OF, stage=run_stage(spark, "company"))


def _published(base: DataFrame, spec, groups: fe.FeatureGroups, scorer: sc.Scorer) -> DataFrame:
    written = run_stage(base.sparkSession, "base")(base)      # scored from the written base, as in the daily jobs
    out = propensity_scores(written, spec, groups, scorer, tb.AS_OF, tb.FILE_DAY, tb.AS_OF)
    return out.withColumns({"ScoreValue": F.round("ScoreValue", 9), "ScoreAvg": F.round("ScoreAvg", 9)})


@register("feature_base_card", csql.feature_base_card_sql())
def q_feature_base_card(spark, sf_dir):
    """Card feature base: file x profile x debts x activity x outcomes x contacts."""
    return card_base(spark, sf_dir)


@register("feature_base_card_deals", csql.feature_base_card_deals_sql())
def q_feature_base_card_deals(spark, sf_dir):
    """Card feature base with one row per file row, deal and installment (C1, JN9, JN10)."""
    return card_base(spark, sf_dir, outcome_grain="deal")


@register("feature_base_company", csql.feature_base_company_sql())
def q_feature_base_company(spark, sf_dir):
    """Company feature base: parsed bank file x nested debts x profile x activity x campaigns."""
    return company_base(spark, sf_dir)


@register("propensity_scores", csql.propensity_scores_sql())
def q_propensity_scores(spark, sf_dir):
    """Published scores: base -> features -> probability -> band -> one row per person (C3, flagship)."""
    return _published(card_base(spark, sf_dir), tb.CARD, CARD_GROUPS,
                      sc.linear_scorer(tb.CARD_COEFFICIENTS, tb.CARD_INTERCEPT))


@register("propensity_scores_trees", csql.propensity_scores_trees_sql())
def q_propensity_scores_trees(spark, sf_dir):
    """Published scores from a published list of boosted trees."""
    return _published(card_base(spark, sf_dir), tb.CARD, CARD_GROUPS, sc.tree_scorer(tb.CARD_TREES, tb.CARD_TREE_BASE))


@register("propensity_scores_company", csql.propensity_scores_company_sql())
def q_propensity_scores_company(spark, sf_dir):
    """Published company scores: 9 bands, 14-digit documents, company provider (C3 on C2)."""
    return _published(company_base(spark, sf_dir), tb.COMPANY, COMPANY_GROUPS,
                      sc.linear_scorer(tb.COMPANY_COEFFICIENTS, tb.COMPANY_INTERCEPT))
