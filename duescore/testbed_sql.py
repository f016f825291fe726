"""The test-role mapping of ``testbed.py`` in DuckDB SQL, for the oracles.

``with_roles("debts", "info")`` returns a ``WITH`` clause defining the named
roles (and the roles they depend on) over the pre-registered test tables.
"""

from __future__ import annotations

from . import testbed as tb
from .testbed import (ARREARS_BASE, CNPJ_SEGMENTS, CREDITOR, OTHER_SIM_CREDITOR, PAID_EARLY_DAYS,
                      RANK_WORDS, SHIFT_DAYS, SKIP_WORDS)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def doc(c: str) -> str:
    return f"lpad(CAST({c} AS VARCHAR), 11, '0')"


def pid(c: str) -> str:
    return f"('id' || CAST({c} AS VARCHAR))"


def contract(c: str) -> str:
    return f"lpad(CAST({c} AS VARCHAR), 12, '0')"


def amount(c: str) -> str:
    return f"replace(CAST(CAST({c} AS DECIMAL(15,2)) AS VARCHAR), '.', ',')"


SEGS = ", ".join(q(s) for s in CNPJ_SEGMENTS)
EVENT_CREDITOR = f"CASE WHEN value < 20 THEN {q(OTHER_SIM_CREDITOR)} ELSE {q(CREDITOR)} END"

ROLES: dict[str, tuple[tuple[str, ...], str]] = {
    "order_tags": ((), f"""
        SELECT l_orderkey,
               list_sort(list_distinct(list({_list(RANK_WORDS)}[l_linenumber]))) AS rank_tags,
               list_sort(list_distinct(list({_list(SKIP_WORDS)}[l_linenumber]))) AS skip_tags
        FROM lineitem GROUP BY l_orderkey"""),
    "info": (("order_tags",), f"""
        SELECT {pid('c.c_custkey')} AS _id, {doc('c.c_custkey')} AS document,
               CASE WHEN c.c_mktsegment IN ({SEGS}) THEN 'cnpj' ELSE 'cpf' END AS documentType,
               sl.tag_telefone, st.state, sl.tag_email,
               [lower(c.c_mktsegment) || '.com.br', lower(n.n_name) || '.com'] AS domain
        FROM customer c
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN (SELECT n_regionkey, list(lower(n_name) ORDER BY n_nationkey) AS state
              FROM nation GROUP BY n_regionkey) st ON st.n_regionkey = n.n_regionkey
        LEFT JOIN (SELECT o.o_custkey,
                          list(t.skip_tags ORDER BY o.o_orderkey) AS tag_telefone,
                          list(t.skip_tags ORDER BY o.o_orderkey DESC) AS tag_email
                   FROM orders o LEFT JOIN order_tags t ON o.o_orderkey = t.l_orderkey
                   GROUP BY o.o_custkey) sl ON sl.o_custkey = c.c_custkey"""),
    "debts": (("order_tags",), f"""
        SELECT {pid('o.o_custkey')} AS _id, {doc('o.o_custkey')} AS document,
               o.o_orderpriority AS creditor, {contract('o.o_orderkey')} AS contract,
               CAST(o.o_orderdate AS DATE) AS INICIO_DIVIDA, t.rank_tags AS tag_divida,
               o.o_totalprice AS originalAmount
        FROM orders o LEFT JOIN order_tags t ON o.o_orderkey = t.l_orderkey"""),
    "simulation": ((), f"""
        SELECT {pid('user_id')} AS personID, {EVENT_CREDITOR} AS creditor, ts AS createdAt
        FROM events WHERE event_type = 'view'"""),
    "authentication": ((), f"""
        SELECT {doc('user_id')} AS document, props AS contact, CAST(event_id AS VARCHAR) AS contract,
               {EVENT_CREDITOR} AS creditor, ts AS createdAt
        FROM events WHERE event_type = 'click'"""),
    "deals": ((), f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS dealID, {doc('o_custkey')} AS document,
               o_orderpriority AS creditor,
               CASE WHEN o_orderstatus = 'P' THEN 'error'
                    WHEN o_orderstatus = 'F' AND o_totalprice >= 200000 THEN 'broken'
                    WHEN o_orderstatus = 'F' THEN 'expired' ELSE 'open' END AS status,
               CAST(o_orderdate AS DATE) + {SHIFT_DAYS} AS createdAt
        FROM orders"""),
    "installments": ((), f"""
        SELECT CAST(l.l_orderkey AS VARCHAR) AS dealID, o.o_orderpriority AS creditor,
               CASE WHEN l.l_linestatus = 'F'
                    THEN strftime(CAST(l.l_shipdate AS DATE) + {SHIFT_DAYS - PAID_EARLY_DAYS}, '%Y-%m-%d') || 'T10:30:00'
               END AS paidAt,
               strftime(CAST(l.l_shipdate AS DATE) + {SHIFT_DAYS}, '%Y-%m-%d') || 'T00:00:00' AS dueAt,
               l.l_linenumber AS QTD_PARCELAS
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    "interactions": ((), f"""
        SELECT {doc('user_id')} AS document, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS sentAt,
               CASE event_type WHEN 'click' THEN 'email' WHEN 'view' THEN 'sms' ELSE event_type END AS type,
               CASE WHEN event_type = 'error' THEN 'not_received' ELSE 'received' END AS status
        FROM events"""),
    "campaigns": ((), f"""
        SELECT {doc('user_id')} AS document, strftime(ts, '%Y-%m-%d') AS interactionDate,
               CASE event_type WHEN 'click' THEN 'email' WHEN 'view' THEN 'sms' WHEN 'purchase' THEN 'call'
                    ELSE event_type END AS type,
               event_type AS channel, props AS campaign_name
        FROM events"""),
    "card_file": ((), f"""
        SELECT {doc('o.o_custkey')} AS CPF, {contract('o.o_orderkey')} AS CONTA, c.c_name AS NOME_CLIENTE,
               CAST(date_diff('day', CAST(o.o_orderdate AS DATE), DATE '{ARREARS_BASE}') AS VARCHAR) AS DIAS_ATRASO_TXT,
               strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS DATA_DIVIDA_TXT,
               strftime(CAST(o.o_orderdate AS DATE) + 30, '%Y-%m-%d') AS DATA_ULTIMA_FATURA_TXT,
               {amount('o.o_totalprice')} AS VALOR_ULTIMA_FATURA_TXT,
               CASE WHEN o.o_orderstatus = 'F' THEN strftime(o.o_orderdate, '%Y-%m-%d') END AS DATA_PAGAMENTO
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        WHERE o.o_orderpriority = {q(CREDITOR)}"""),
    "company_fields": ((), f"""
        SELECT '1' AS Tipo_Registro,
               CASE WHEN c.c_mktsegment IN ({SEGS}) THEN 'J' ELSE 'F' END AS Tipo_Pessoa,
               {doc('o.o_custkey')} AS document,
               lpad(CAST(c.c_nationkey AS VARCHAR), 8, '0') AS Cep1, '01000000' AS Cep2,
               CAST(NULL AS VARCHAR) AS Cep3,
               CASE WHEN c.c_acctbal > 5000 THEN 'S' ELSE 'N' END AS Indicador_Correntista_TXT,
               {contract('o.o_orderkey')} AS Contrato_Altair,
               lower(c.c_mktsegment) AS Descricao_Produto,
               TRY_CAST(CAST(CAST(o.o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS DOUBLE) AS Saldo_Devedor_Contrato,
               CAST(date_diff('day', CAST(o.o_orderdate AS DATE), DATE '{ARREARS_BASE}') AS INTEGER) AS Dias_Atraso,
               o.o_orderstatus AS Codigo_Politica,
               TRY_CAST((CASE WHEN c.c_acctbal < 0 THEN '-' ELSE '' END)
                        || CAST(CAST(abs(c.c_acctbal) AS DECIMAL(15,2)) AS VARCHAR) AS DOUBLE) AS Taxa_Padrao,
               10.0::DOUBLE AS Desconto_Padrao, 5.0::DOUBLE AS Percentual_Min_Entrada,
               150.0::DOUBLE AS Valor_Min_Parcela,
               1 AS Qtde_Min_Parcelas, 24 AS Qtde_Max_Parcelas, c.c_nationkey AS Qtde_Parcelas_Padrao,
               c.c_mktsegment AS Forma_Pgto_Padrao
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        WHERE o.o_orderpriority = {q(CREDITOR)} AND o.o_orderstatus <> 'F'"""),
    "person_debts": (("order_tags",), f"""
        SELECT {pid('c.c_custkey')} AS _id, {doc('c.c_custkey')} AS document,
               CASE WHEN c.c_mktsegment <> 'AUTOMOBILE' THEN substring(c.c_mktsegment, 1, 1) END AS gender,
               CASE WHEN c.c_mktsegment <> 'AUTOMOBILE'
                    THEN CAST(make_date(c.c_nationkey + 1950, 1, 1) AS TIMESTAMP) END AS birthDate,
               o.o_orderpriority AS creditor, {contract('o.o_orderkey')} AS contract,
               o.o_orderdate AS createdAt, t.rank_tags AS tags
        FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
        LEFT JOIN order_tags t ON o.o_orderkey = t.l_orderkey"""),
}


def with_roles(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """A ``WITH`` clause defining ``names`` (dependencies first) plus ``extra`` CTEs."""
    order: list[str] = []

    def visit(n: str) -> None:
        for dep in ROLES[n][0]:
            visit(dep)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({ROLES[n][1]}\n)" for n in order]
    parts += [f"{n} AS (\n{body}\n)" for n, body in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n"


def forest_sql() -> str:
    """The rule's trees walked node by node from a table of nodes, for every customer."""
    names = list(tb.FOREST_RANGES)
    lows = ", ".join(repr(lo) for lo, _ in tb.FOREST_RANGES.values())
    highs = ", ".join(repr(hi) for _, hi in tb.FOREST_RANGES.values())
    inner = 2 ** tb.FOREST_DEPTH - 1
    return f"""
WITH RECURSIVE o AS (
  SELECT o_custkey, CAST(count(*) AS DOUBLE) AS n_orders, max(o_totalprice) AS max_price, min(o_totalprice) AS min_price,
    CAST(date_diff('day', max(CAST(o_orderdate AS DATE)), DATE '{tb.AS_OF}') AS DOUBLE) AS days_since
  FROM orders GROUP BY o_custkey),
c AS (SELECT c_custkey, [{", ".join(f"CAST({n} AS DOUBLE)" for n in names)}] AS f FROM customer LEFT JOIN o ON c_custkey = o_custkey),
q AS (SELECT t, i, (5 * t + 3 * i + i * i) % {len(names)} + 1 AS place FROM range({tb.FOREST_TREES}) r(t), range({inner}) s(i)),
nodes AS (
  SELECT t, i, place, ([{lows}])[place] + (([{highs}])[place] - ([{lows}])[place]) * ((37 * t + 53 * i) % 97 + 1) / CAST(98 AS DOUBLE) AS threshold,
    (t + i) % 3 <> 0 AS missing_left FROM q),
walk(k, t, i) AS (
  SELECT c_custkey, t, CAST(0 AS BIGINT) FROM c, range({tb.FOREST_TREES}) r(t)
  UNION ALL
  SELECT w.k, w.t, 2 * w.i + CASE WHEN coalesce(c.f[n.place] < n.threshold, n.missing_left) THEN 1 ELSE 2 END
  FROM walk w JOIN c ON c.c_custkey = w.k JOIN nodes n ON n.t = w.t AND n.i = w.i),
z AS (
  SELECT k, {tb.FOREST_BASE!r} + sum(((41 * t + 29 * i) % 83 - 41) / CAST(4000 AS DOUBLE)) AS margin
  FROM walk WHERE i >= {inner} GROUP BY k)
SELECT CAST(k AS VARCHAR) AS Chave, round(1.0 / (1.0 + exp(-margin)), 9) AS P_1 FROM z"""
