"""Company feature base (C2): parse the bank file, attach nested debts, enrich."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.text import clean_document, has_marker, parse_signed_decimal, yes_no_flag
from ..operators.nested import explode_debts, merge_composite_key, person_projection, rank_columns
from ..sources.files import strip_control_records
from ..spec import (ACTIVATED, AUTH_COUNT, COMPANY_AMOUNT_FIELDS, COMPANY_BASE_COLUMNS, COMPANY_INT_FIELDS,
                    FIRST_TOUCH, NOT_ACTIVATED, PortfolioSpec)
from .base import Sources, auth_rows, build_base, combine_facts, is_kind, tagged


def clean_company_file(parsed: DataFrame, file_name: str, strict_sign: bool = False) -> DataFrame:
    """Detail records with typed amounts, counts, clean document and contract."""
    df = strip_control_records(parsed)
    typed = {f: parse_signed_decimal(f, strict_sign) for f in COMPANY_AMOUNT_FIELDS}
    typed.update({f: F.col(f).try_cast("int") for f in COMPANY_INT_FIELDS})
    typed["Numero_Documento"] = clean_document("Numero_Documento")
    typed["Contrato_Altair"] = F.substring(F.col("Contrato_Altair"), 15, 12)
    typed["Nome_Arquivo"] = F.lit(file_name)
    return df.withColumns(typed)


def company_rows(clean: DataFrame, creditor_id: str, as_of: str) -> DataFrame:
    """The file columns of the company base."""
    return clean.select(
        F.lit(creditor_id).alias("ID_Credor"),
        F.col("Numero_Documento").alias("document"),
        "Contrato_Altair",
        F.to_date(F.lit(as_of)).alias("data_referencia"),
        yes_no_flag("Indicador_Correntista").alias("Indicador_Correntista"),
        "Cep1", "Cep2", "Cep3", "Forma_Pgto_Padrao", "Taxa_Padrao", "Desconto_Padrao",
        "Qtde_Min_Parcelas", "Qtde_Max_Parcelas", "Qtde_Parcelas_Padrao", "Valor_Min_Parcela",
        "Codigo_Politica", "Saldo_Devedor_Contrato", "Dias_Atraso", "Descricao_Produto",
    )


def nested_debts(persons: DataFrame, spec: PortfolioSpec, as_of: str) -> DataFrame:
    """The persons' debts at the creditor, one row per debt, with rank columns.

    Other creditors' debts are dropped inside the arrays before anything is
    shuffled; which persons the file holds is decided by the one join that follows.
    """
    proj = person_projection(persons, spec.creditor, as_of).filter(F.size("debts") > 0)
    debts = explode_debts(proj, ("contract", "createdAt", "tags"))
    debts = debts.withColumn("createdAt", F.to_date("createdAt"))
    return rank_columns(debts, "tags", spec.rank_values)


def company_base_rows(parsed: DataFrame, persons: DataFrame, spec: PortfolioSpec, file_name: str,
                      creditor_id: str, as_of: str, strict_sign: bool = False) -> DataFrame:
    """Stage 1 of the company base (J1): file rows merged with their nested debts (JN12)."""
    rows = company_rows(clean_company_file(parsed, file_name, strict_sign), creditor_id, as_of)
    debts = nested_debts(persons, spec, as_of)
    merged = merge_composite_key(rows, debts, ["document", "Contrato_Altair"], ["document", "contract"])
    merged = merged.withColumnRenamed("createdAt", "DATA_ENTRADA_DIVIDA")
    cols = [("document" if c == "ID_DEVEDOR" else c) for c in COMPANY_BASE_COLUMNS]
    return merged.select(*[F.col(f"`{c}`") for c in cols]).withColumnRenamed("document", "ID_DEVEDOR")


def build_company_base(parsed: DataFrame, src: Sources, spec: PortfolioSpec, file_name: str,
                       creditor_id: str, file_day: str, as_of: str, strict_sign: bool = False,
                       stage=None) -> DataFrame:
    """The company feature base."""
    rows = company_base_rows(parsed, src.persons, spec, file_name, creditor_id, as_of, strict_sign)
    camp = src.campaigns.select(
        "document", parse_date("interactionDate", "yyyy-MM-dd").alias("DT_CAMPANHA"), "type",
        has_marker("campaign_name", spec.campaign_marker).alias("marked"))
    any_camp = F.count_if(is_kind("camp")) > 0
    counts = []
    for value, tgt in spec.channels:
        is_type = is_kind("camp") & (F.col("type") == F.lit(value))
        counts.append(F.when(any_camp, F.count_if(is_type & ~F.col("marked"))).alias(f"ACION_{tgt}_QTD_{ACTIVATED}"))
        counts.append(F.when(any_camp, F.count_if(is_type & F.col("marked"))).alias(f"ACION_{tgt}_QTD_{NOT_ACTIVATED}"))
    parts = [auth_rows(src, spec, file_day), tagged(camp, "document", "camp", "DT_CAMPANHA", "type", "marked")]
    aggs = [F.count_if(is_kind("auth")).alias(AUTH_COUNT), F.min("DT_CAMPANHA").alias(FIRST_TOUCH), *counts]
    arq = build_base(rows, src, spec, file_day, lambda documents: combine_facts(parts, aggs, documents),
                     {AUTH_COUNT: 0}, stage)
    if spec.fill_zero:
        arq = arq.fillna(0, subset=[f"ACION_{t}_QTD_{lb}" for lb in (ACTIVATED, NOT_ACTIVATED) for _, t in spec.channels])
    return arq
