"""DuckDB oracles of the composite pipelines (C1, C2, C3), built from the same fixed lists."""

from __future__ import annotations

from . import testbed as tb
from .operators.score import Split, tree_features
from .spec import CARD_CATEGORICAL, CARD_DATES, CARD_NUMERIC, DEBT_TAGS, RANK_VALUES
from .testbed_sql import with_roles

C = tb.CREDITOR


def _flag(slot: str, tag: str) -> str:
    if tag == "sem_tags":
        return f"list_contains({slot}, '{tag}') IS NULL"
    return f"COALESCE(list_contains({slot}, '{tag}'), FALSE)"


def profile_cols() -> list[str]:
    from .spec import CONTACT_TAGS
    cols = [f'{_flag(f"tag_telefone[{i + 1}]", t)} AS "Telefone{i + 1}_{t}"' for i in range(10) for t in CONTACT_TAGS]
    for i in range(3):
        cols += [f'{_flag(f"tag_email[{i + 1}]", t)} AS "Email{i + 1}_{t}"' for t in CONTACT_TAGS]
        cols.append(f'domain[{i + 1}] AS "Email{i + 1}_dominio"')
    cols += [f"upper(NULLIF(state[{i + 1}], '{tb.STATE_PLACEHOLDER}')) AS UF{i + 1}" for i in range(3)]
    return cols


def profile_names() -> list[str]:
    from .spec import CONTACT_TAGS
    names = [f"Telefone{i + 1}_{t}" for i in range(10) for t in CONTACT_TAGS]
    for i in range(3):
        names += [f"Email{i + 1}_{t}" for t in CONTACT_TAGS] + [f"Email{i + 1}_dominio"]
    return names + [f"UF{i + 1}" for i in range(3)]


def _qn(names) -> str:
    return ", ".join(f'"{n}"' for n in names)


def enrichment_ctes(doc_type: str, file_cte: str, doc: str, contract: str) -> list[tuple[str, str]]:
    """CTEs of the shared enrichment, over a file CTE with columns ``doc`` and ``contract``."""
    debt_flags = ", ".join(f'{_flag("tag_divida", t)} AS "SkipDivida_{t}"' for t in DEBT_TAGS)
    debt_names = _qn([f"SkipDivida_{t}" for t in DEBT_TAGS])
    return [
        ("inf", f"SELECT _id, document, documentType, {', '.join(profile_cols())} FROM info "
                f"WHERE documentType = '{doc_type}'"),
        ("dflag", f"SELECT DISTINCT _id, document, creditor, contract, INICIO_DIVIDA, originalAmount, {debt_flags} "
                  f"FROM debts"),
        ("dearly", "SELECT d.* FROM dflag d JOIN (SELECT _id, creditor, min(INICIO_DIVIDA) AS m FROM dflag "
                   "GROUP BY _id, creditor) g ON d._id = g._id AND d.creditor = g.creditor AND d.INICIO_DIVIDA = g.m"),
        ("own", f"SELECT * FROM dearly WHERE creditor = '{C}'"),
        ("base", f"SELECT inf.*, own.contract, own.INICIO_DIVIDA, own.originalAmount, {debt_names} "
                 f"FROM inf JOIN own ON inf._id = own._id"),
        ("arq0", f"SELECT DISTINCT ff.*, base.* EXCLUDE (document, contract) FROM {file_cte} ff "
                 f"LEFT JOIN base ON ff.{contract} = base.contract AND ff.{doc} = base.document"),
        ("oth", f"SELECT DISTINCT _id FROM debts WHERE creditor <> '{C}' AND INICIO_DIVIDA IS NOT NULL"),
        ("pres", f"SELECT DISTINCT _id, {contract} AS c FROM arq0"),
        ("miss", "SELECT DISTINCT o._id FROM own o WHERE NOT EXISTS "
                 "(SELECT 1 FROM pres WHERE pres._id = o._id AND pres.c = o.contract)"),
        ("sim", f"SELECT personID, count(*) AS n FROM simulation WHERE creditor = '{C}' "
                f"AND createdAt <= DATE '{tb.FILE_DAY}' GROUP BY personID"),
        ("au", f"SELECT document, count(*) AS n FROM authentication WHERE creditor = '{C}' "
               f"AND createdAt <= DATE '{tb.FILE_DAY}' GROUP BY document"),
        ("arq1", f"""SELECT a.*, oth._id IS NOT NULL AS Divida_Outro_Credor, miss._id IS NOT NULL AS Divida_Mesmo_Credor,
                   COALESCE(sim.n, 0) AS QTD_SIMU, COALESCE(au.n, 0) AS QTD_AUTH
            FROM arq0 a LEFT JOIN oth ON a._id = oth._id LEFT JOIN miss ON a._id = miss._id
            LEFT JOIN sim ON a._id = sim.personID LEFT JOIN au ON a.{doc} = au.document"""),
    ]


CARD_FILE_CTE = ("cf", r"""SELECT CPF, CONTA, NOME_CLIENTE, TRY_CAST(DIAS_ATRASO_TXT AS INTEGER) AS DIAS_ATRASO,
           CAST(try_strptime(substring(DATA_DIVIDA_TXT, 1, 10), '%Y-%-m-%-d') AS DATE) AS DATA_DIVIDA,
           CAST(try_strptime(substring(DATA_ULTIMA_FATURA_TXT, 1, 10), '%Y-%-m-%-d') AS DATE) AS DATA_ULTIMA_FATURA,
           CAST(NULL AS VARCHAR) AS DATA_INTERROMPE_COBRANCA, CAST(NULL AS VARCHAR) AS DATA_RETORNO_COBRANCA,
           TRY_CAST(regexp_replace(VALOR_ULTIMA_FATURA_TXT, '^([^,]*),', '\1.') AS DOUBLE) AS VALOR_ULTIMA_FATURA
    FROM card_file WHERE DATA_PAGAMENTO IS NULL""")


def card_base_ctes() -> list[tuple[str, str]]:
    from .queries import _DAYS_SQL, _DC_SQL, _DEAL_ROWS, _INST_ROWS, _LAB_SQL, _LD_SQL, _PIVOT_ACT_SQL
    return [CARD_FILE_CTE, *enrichment_ctes("cpf", "cf", "CPF", "CONTA"), _DEAL_ROWS, _INST_ROWS,
            ("perdeal", """SELECT dealID, max(CAST(try_strptime(DT_PAGAMENTO, '%Y-%m-%d') AS DATE)) AS DT_PAGAMENTO, max(QTD_PARCELAS) AS QTD_PARCELAS,
                   bool_or(has_paid_date) AS has_payment FROM ir GROUP BY dealID"""),
            ("outc", """SELECT dr.CPF, dr.DT_ACORDO, pd.DT_PAGAMENTO, pd.QTD_PARCELAS, pd.DT_PAGAMENTO IS NOT NULL AS PAGTO,
                   COALESCE(pd.has_payment, FALSE) AS has_payment
            FROM dr LEFT JOIN perdeal pd ON dr.dealID = pd.dealID
            QUALIFY row_number() OVER (PARTITION BY dr.CPF ORDER BY dr.DT_ACORDO DESC, dr.dealID DESC) = 1"""),
            _DAYS_SQL, _DC_SQL, _LD_SQL, _LAB_SQL, _PIVOT_ACT_SQL,
            ("ft", "SELECT document, min(DT_INTERACAO) AS PRIMEIRO_ACIONAMENTO FROM lab GROUP BY document"),
            ("cbase", """SELECT a.* EXCLUDE (_id), outc.DT_ACORDO, outc.CPF IS NOT NULL AS VARIAVEL_RESPOSTA_ACORDO,
                   outc.DT_PAGAMENTO, COALESCE(outc.QTD_PARCELAS, 0) AS QTD_PARCELAS,
                   COALESCE(outc.PAGTO, FALSE) AS PAGTO, COALESCE(outc.has_payment, FALSE) AS has_payment,
                   ft.PRIMEIRO_ACIONAMENTO, act.* EXCLUDE (document)
            FROM arq1 a LEFT JOIN outc ON a.CPF = outc.CPF LEFT JOIN ft ON a.CPF = ft.document
            LEFT JOIN act ON a.CPF = act.document"""),
            ("cdeal", """SELECT c.* EXCLUDE (DT_ACORDO, VARIAVEL_RESPOSTA_ACORDO, DT_PAGAMENTO, QTD_PARCELAS, PAGTO, has_payment),
                   dr.DT_ACORDO, dr.CPF IS NOT NULL AS VARIAVEL_RESPOSTA_ACORDO, ir.DT_PAGAMENTO,
                   COALESCE(ir.QTD_PARCELAS, 0) AS QTD_PARCELAS, ir.DT_PAGAMENTO IS NOT NULL AS PAGTO,
                   COALESCE(ir.has_paid_date, FALSE) AS has_payment
            FROM cbase c LEFT JOIN dr ON c.CPF = dr.CPF LEFT JOIN ir ON dr.dealID = ir.dealID""")]


CARD_ROLES = ("card_file", "info", "debts", "simulation", "authentication", "deals", "installments", "interactions")
CARD_DATE_COLS = ("DATA_DIVIDA", "DATA_ULTIMA_FATURA", "INICIO_DIVIDA", "DT_ACORDO", "DT_PAGAMENTO", "PRIMEIRO_ACIONAMENTO")


def feature_base_card_sql() -> str:
    casts = ", ".join(f'CAST({c} AS VARCHAR) AS {c}' for c in CARD_DATE_COLS)
    return with_roles(*CARD_ROLES, extra=card_base_ctes()) + \
        f"SELECT * REPLACE ({casts}) FROM cbase"


def feature_base_card_deals_sql() -> str:
    casts = ", ".join(f'CAST({c} AS VARCHAR) AS {c}' for c in CARD_DATE_COLS)
    return with_roles(*CARD_ROLES, extra=card_base_ctes()) + \
        f"SELECT * REPLACE ({casts}) FROM cdeal"


def company_base_ctes() -> list[tuple[str, str]]:
    from .queries import _CHANNEL_SQL, _CRED_DEBTS, _RANK_SQL
    ranks = ", ".join(f"CASE WHEN nd.document IS NULL THEN NULL ELSE ({_RANK_SQL}) = '{r}' END AS \"{r}\""
                      for r in RANK_VALUES)
    rows = ("crow", f"""SELECT '{tb.COMPANY_CREDITOR_ID}' AS ID_Credor, cf.document AS ID_DEVEDOR, cf.Contrato_Altair,
           DATE '{tb.AS_OF}' AS data_referencia, CAST(nd.createdAt AS DATE) AS DATA_ENTRADA_DIVIDA,
           CASE cf.Indicador_Correntista_TXT WHEN 'S' THEN TRUE WHEN 'N' THEN FALSE END AS Indicador_Correntista,
           cf.Cep1, cf.Cep2, cf.Cep3, cf.Forma_Pgto_Padrao, cf.Taxa_Padrao, cf.Desconto_Padrao,
           cf.Qtde_Min_Parcelas, cf.Qtde_Max_Parcelas, cf.Qtde_Parcelas_Padrao, cf.Valor_Min_Parcela,
           cf.Codigo_Politica, cf.Saldo_Devedor_Contrato, cf.Dias_Atraso, cf.Descricao_Produto, {ranks}
    FROM company_fields cf LEFT JOIN nd ON cf.document = nd.document AND cf.Contrato_Altair = nd.contract
    WHERE cf.Tipo_Pessoa = 'J'""")
    return [_CRED_DEBTS, rows, *enrichment_ctes("cnpj", "crow", "ID_DEVEDOR", "Contrato_Altair"),
            ("cft", "SELECT document, min(CAST(try_strptime(interactionDate, '%Y-%m-%d') AS DATE)) AS PRIMEIRO_ACIONAMENTO "
                    "FROM campaigns GROUP BY document"),
            ("ccnt", f"SELECT document, {_CHANNEL_SQL} FROM campaigns GROUP BY document"),
            ("kbase", """SELECT a.* EXCLUDE (_id), cft.PRIMEIRO_ACIONAMENTO, ccnt.* EXCLUDE (document)
            FROM arq1 a LEFT JOIN cft ON a.ID_DEVEDOR = cft.document LEFT JOIN ccnt ON a.ID_DEVEDOR = ccnt.document""")]


COMPANY_ROLES = ("company_fields", "person_debts", "info", "debts", "simulation", "authentication", "campaigns")
COMPANY_DATE_COLS = ("data_referencia", "DATA_ENTRADA_DIVIDA", "INICIO_DIVIDA", "PRIMEIRO_ACIONAMENTO")


def feature_base_company_sql() -> str:
    casts = ", ".join(f'CAST({c} AS VARCHAR) AS {c}' for c in COMPANY_DATE_COLS)
    return with_roles(*COMPANY_ROLES, extra=company_base_ctes()) + f"SELECT * REPLACE ({casts}) FROM kbase"


def _feature_sql(name: str, numeric, dates, categorical, bool_cols: set[str], string_cols: set[str]) -> str:
    import re
    if name in numeric:
        return f'CAST("{name}" AS DOUBLE)'
    m = re.fullmatch(r"(ano|mes|dia|delta)_(.+)", name)
    if m and m.group(2) in dates:
        d = m.group(2)
        if m.group(1) == "delta":
            return f"date_diff('day', {d}, DATE '{tb.AS_OF}') / 365.25"
        fn = {"ano": "year", "mes": "month", "dia": "day"}[m.group(1)]
        return f"CAST({fn}({d}) AS DOUBLE)"
    if name in bool_cols:
        return f'CAST(CAST("{name}" AS INTEGER) AS DOUBLE)'
    for c in (*categorical, *sorted(x for x in string_cols if x.startswith("Email"))):
        if name.startswith(c + "_"):
            v = name[len(c) + 1:]
            return f"COALESCE(CAST(\"{c}\" = '{v}' AS DOUBLE), 0.0)"
    return "CAST(NULL AS DOUBLE)"


def _profile_bools() -> set[str]:
    from .spec import CONTACT_TAGS
    cols = {f"Telefone{i + 1}_{t}" for i in range(10) for t in CONTACT_TAGS}
    cols |= {f"Email{i + 1}_{t}" for i in range(3) for t in CONTACT_TAGS}
    return cols | {f"SkipDivida_{t}" for t in DEBT_TAGS} | {"Divida_Outro_Credor", "Divida_Mesmo_Credor"}


def linear_sql(coefficients: dict, intercept: float) -> str:
    return f"{float(intercept)!r} + " + " + ".join(f'{float(w)!r} * COALESCE("{n}", 0.0)' for n, w in coefficients.items())


def tree_sql(node) -> str:
    """The leaf value of a published tree."""
    if not isinstance(node, Split):
        return repr(float(node))
    left, right = tree_sql(node.left), tree_sql(node.right)
    return (f'(CASE WHEN "{node.feature}" IS NULL THEN {left if node.missing_left else right} '
            f'WHEN "{node.feature}" < {float(node.threshold)!r} THEN {left} ELSE {right} END)')


def scores_sql(roles, ctes, base_cte: str, id_col: str, names, margin: str, edges, width: int,
               provider: str, numeric, dates, categorical, bool_cols: set[str]) -> str:
    """Oracle of ``propensity_scores`` over a feature-base CTE: ``margin`` over the features ``names``."""
    from .queries import _band_sql
    string_cols = {f"Email{i + 1}_dominio" for i in range(3)}
    feats = ", ".join(f'{_feature_sql(n, numeric, dates, categorical, bool_cols, string_cols)} AS "{n}"'
                      for n in names)
    ctes = ctes + [
        ("fv", f"SELECT DISTINCT {id_col}, {feats} FROM {base_cte}"),
        ("pre", f"SELECT {id_col} AS Chave, 1.0 / (1.0 + exp(-({margin}))) AS P_1 FROM fv"),
        ("pre_gh", f"SELECT Chave, P_1, {_band_sql('P_1', edges)} AS GH FROM pre"),
    ]
    return with_roles(*roles, extra=ctes) + f"""
SELECT lpad(Chave, {width}, '0') AS Document, max(GH) AS Score, round(max(P_1), 9) AS ScoreValue,
       round(avg(P_1), 9) AS ScoreAvg, '{provider}' AS Provider, '{tb.FILE_DAY}' AS Date,
       '{tb.AS_OF}' AS CreatedAt
FROM pre_gh GROUP BY lpad(Chave, {width}, '0')"""


def propensity_scores_sql() -> str:
    from .spec import CARD_BAND_EDGES
    return scores_sql(CARD_ROLES, card_base_ctes(), "cbase", "CPF", tb.CARD_COEFFICIENTS,
                      linear_sql(tb.CARD_COEFFICIENTS, tb.CARD_INTERCEPT), CARD_BAND_EDGES, 11, tb.CARD.provider, CARD_NUMERIC, CARD_DATES, CARD_CATEGORICAL,
                      _profile_bools())


def propensity_scores_trees_sql() -> str:
    from .spec import CARD_BAND_EDGES
    margin = " + ".join([repr(tb.CARD_TREE_BASE), *map(tree_sql, tb.CARD_TREES)])
    return scores_sql(CARD_ROLES, card_base_ctes(), "cbase", "CPF", tree_features(tb.CARD_TREES), margin,
                      CARD_BAND_EDGES, 11, tb.CARD.provider, CARD_NUMERIC, CARD_DATES, CARD_CATEGORICAL,
                      _profile_bools())


def propensity_scores_company_sql() -> str:
    from .spec import COMPANY_BAND_EDGES, COMPANY_CATEGORICAL, COMPANY_DATES, COMPANY_NUMERIC
    bools = _profile_bools() | set(RANK_VALUES) | {"Indicador_Correntista"}
    return scores_sql(COMPANY_ROLES, company_base_ctes(), "kbase", "ID_DEVEDOR", tb.COMPANY_COEFFICIENTS,
                      linear_sql(tb.COMPANY_COEFFICIENTS, tb.COMPANY_INTERCEPT), COMPANY_BAND_EDGES, 14, tb.COMPANY.provider, COMPANY_NUMERIC,
                      COMPANY_DATES, COMPANY_CATEGORICAL, bools)
